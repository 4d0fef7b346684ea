"""Physical plans: what reaches the scan, what is computed once, what shuffles."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from checks import registry, views
from colloquy.functions.text import explode_tokens
from colloquy.operators import rates, subsets, terms, trips, users
from colloquy.operators.sentiment import comment_sentiment, sentiment_by
from colloquy.staging import stage


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return stage(views.features(spark, sf_dir), "features")


@pytest.fixture(scope="module")
def text_base(features):
    return stage(subsets.nlp_text_base(features), "text-base")


def exchanges(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


def test_membership_filter_reaches_parquet(features):
    text = plan(subsets.filter_members(features, "subreddit", ["view", "click"]))
    assert re.search(r"PushedFilters: \[.*In\(subreddit, \[", text)


def test_rate_reads_two_columns_and_shuffles_once(features):
    text = plan(rates.rate_by(features, ["subreddit"]))
    assert re.search(r"ReadSchema: struct<subreddit:string,controversiality:int>", text)
    assert exchanges(text) == 1


def test_year_is_a_pushed_range(spark, sf_dir):
    items = views.table(spark, sf_dir, "lineitem")
    text = plan(trips.daily_summary(items, 1997, registry.LINEITEM_TRIPS))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate.*LessThan\(l_shipdate", text)
    assert "l_orderkey" not in text


def test_subset_sizes_are_one_pass(features):
    text = plan(subsets.subset_row_counts(features))
    assert text.count("Scan parquet") == 2  # outline and details of one scan
    assert re.search(r"ReadSchema: struct<is_removed_or_deleted:int,is_deleted_author:int>", text)


def test_text_is_cleaned_once(spark, sf_dir):
    """No pushed-down filter repeats the cleaning."""
    base = subsets.nlp_text_base(views.features(spark, sf_dir))
    frames = [
        base,
        terms.term_counts(explode_tokens(base, ["subreddit"]), ["subreddit"]),
        comment_sentiment(base),
        sentiment_by(comment_sentiment(base), "subreddit"),
    ]
    for df in frames:
        assert plan(df).count("regexp_replace") == 1


def test_sentiment_needs_no_shuffle(text_base):
    assert exchanges(plan(comment_sentiment(text_base))) == 0


def test_top_terms_limit_each_task_before_the_shuffle(text_base):
    counts = stage(terms.term_counts(explode_tokens(text_base, ["subreddit"]), ["subreddit"]), "counts")
    for df in (terms.top_terms(counts, "subreddit"), terms.distinctive_terms(counts, "subreddit", 5)):
        text = plan(df)
        assert len(re.findall(r"^\(\d+\) WindowGroupLimit", text, re.M)) == 2
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_comment_summaries_do_not_join(features):
    typed = users.typed_activity(users.author_activity(subsets.subset(features, "user")))
    for df in (users.user_type_comment_summary(typed), users.community_user_type_summary(typed)):
        assert "Join" not in plan(df)


def test_user_profile_aggregates_before_each_shuffle(features):
    text = plan(users.user_profile(features))
    assert exchanges(text) == 2
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text
    assert "body:" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_top_groups_keep_k_rows_per_task(features):
    assert "TakeOrderedAndProject" in plan(subsets.top_groups(features, "subreddit", 3))


def test_no_query_runs_python_or_crosses_tables(spark, sf_dir):
    for name in ("user_labeled", "ml_model_base", "community_pairs", "distinctive_terms_by_community",
                 "top_terms_by_user_type", "sentiment_by_label", "class_weights"):
        text = plan(registry.QUERIES[name](spark, sf_dir))
        for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, name


def test_views_differ_from_each_other_only_by_nulls(spark, sf_dir):
    plain, nulls = (views.comments(spark, sf_dir, n).count() for n in (False, True))
    assert plain == nulls == views.table(spark, sf_dir, "events").count() == 1000
    counts = subsets.null_profile(views.comments(spark, sf_dir, True), registry.PROFILED).first()
    assert all(counts[c] > 0 for c in ("author", "subreddit", "body", "controversiality"))
    sizes = {r.metric: r.value for r in subsets.subset_row_counts(views.features(spark, sf_dir)).collect()}
    assert sizes == {"all_df": 1000, "text_df": 884, "user_df": 961, "text_user_df": 845}
    assert subsets.valid_text_rows(views.features(spark, sf_dir)).count() == 817
    assert views.features(spark, sf_dir).agg(F.sum("controversiality")).first()[0] == 92


def test_terms_are_not_dealt_out_by_group(spark, text_base):
    counts = stage(terms.term_counts(explode_tokens(text_base, ["controversiality"]), ["controversiality"]), "counts")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(terms.distinctive_terms(counts, "controversiality", 5))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    before_rank = text[: text.index("(1) Scan")]
    assert "BroadcastHashJoin" in before_rank
    # The totals and the ranking are the only exchanges on the group; both are reduced before.
    grouped = re.findall(r"Arguments: hashpartitioning\(controversiality#\d+, \d+\)", text)
    assert len(grouped) <= 2


def test_bodies_are_cleaned_below_the_author_exchange(spark, sf_dir):
    rows = registry.text_users(spark, sf_dir)
    types = stage(users.user_types(rows), "types")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = registry.typed_terms(rows, types, broadcast_limit=0)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = text.index("Join")
    assert "regexp_replace" not in text[:joins] and "regexp_replace" in text[joins:]


def test_stop_words_are_tested_in_compiled_filters(spark, sf_dir, text_base):
    """Not in a lambda over the array, which is interpreted."""
    rows = registry.text_users(spark, sf_dir)
    types = stage(users.user_types(rows), "types")
    for df in (registry.typed_terms(rows, types), terms.group_totals(explode_tokens(text_base, ["subreddit"]), "subreddit")):
        text = plan(df)
        assert "lambdafunction" not in text and " INSET " in text


def test_sentiment_writes_no_pieces_that_are_no_terms(text_base):
    text = comment_sentiment(text_base)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(body_clean") == 1 and not re.search(r"split\(body_clean#\d+,  , -1\) AS", text)


def test_comments_are_not_coalesced_by_what_was_shuffled(spark, sf_dir):
    """A narrow event becomes a whole text: tasks as many as cores, or one more, would run in two waves."""
    assert views.comments(spark, sf_dir).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["term_counts_by_community", "top_terms_by_community", "top_terms_by_label"])
def test_terms_are_cleaned_after_they_are_counted_and_shuffled_without_their_group(spark, sf_dir, name):
    text = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    below = text[text.index("Aggregate [piece"):].split("\n", 1)[1]
    assert below.count("regexp_replace") == 1 and "CASE WHEN (octet_length(piece" in below
    shuffled = plan(registry.QUERIES[name](spark, sf_dir))
    assert re.search(r"hashpartitioning\(piece#\d+, \d+\)", shuffled) and re.search(r"hashpartitioning\(token#\d+, \d+\)", shuffled)
    assert not re.search(r"hashpartitioning\((subreddit|controversiality)#\d+, (token|piece)#", shuffled)


def test_groups_of_terms_are_read_without_a_join_and_hold_all_of_the_comments(spark, sf_dir):
    every = views.dimensions(spark, sf_dir)
    assert "Join" not in plan(every)
    for dim in ("subreddit", "controversiality"):
        assert set(terms.few_groups(every, dim)) >= set(terms.few_groups(views.comments(spark, sf_dir), dim))


def test_blank_bodies_are_told_without_counting_characters(features):
    text = subsets.valid_text_rows(features.select("body", "is_removed_or_deleted", "is_deleted_author"))._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length(trim(body" in text and "(length(trim(body" not in text
