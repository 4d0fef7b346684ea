"""Every query by name: the Spark callable and, where SQL can say it, the SQL."""

from __future__ import annotations

import zipfile
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.find_spark_home import _find_spark_home
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from colloquy.functions.calendar import with_local_hour, with_time_parts, with_weekday_name, with_year_month
from colloquy.functions.text import clean_text, explode_tokens, tokens_of
from colloquy.operators import evaluation, intervals, models, sketches, subsets, terms, timeline, trips, users
from colloquy.operators.model_base import community_features, feature_rows, model_base, model_input, user_features
from colloquy.operators.rates import by_rate, rate_by
from colloquy.operators.sentiment import comment_sentiment, sentiment_by
from colloquy.plans import increments
from colloquy.schema import LOCAL_ZONE, NEGATIVE_WORDS, NUMERIC_FEATURES, POSITIVE_WORDS
from colloquy.sources import bucketed
from colloquy.sources.sinks import preview, schema_report, write_summary_csv, write_table
from colloquy.sources.tables import month_paths, query_view, read_files, read_month, read_summary_csv, read_table
from colloquy.staging import new_path, stage
from colloquy.streaming import rates as rates_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, Callable[[], str]] = {}

MEMBERS = ("view", "purchase", "signup")
# Scale-bound threshold of distinctive terms: 500 suits tens of millions of comments.
MIN_COUNT = 25
YEAR = 1997
LINEITEM_TRIPS = {
    "pickup": "l_shipdate",
    "distance": "l_quantity",
    "tax": "l_tax",
    "fare": "l_extendedprice",
    "tip": "l_discount",
    "passengers": "l_linenumber",
}


def query(name: str, sql: str | Callable[[], str] | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql if callable(sql) else lambda: sql
        return fn

    return register


@cache
def stop_words() -> tuple[str, ...]:
    """Spark's English stop words, read without a running session."""
    jar = next(Path(_find_spark_home(), "jars").glob("spark-mllib_*.jar"))
    with zipfile.ZipFile(jar) as archive:
        return tuple(archive.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split())


def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# --- tables and counts ------------------------------------------------------------

BASE = v.with_sql(v.comments_sql(), v.FEATURES_SQL)
BASE_NULLS = v.with_sql(v.comments_sql(nulls=True), v.FEATURES_SQL)
USER_ROWS = "features where is_deleted_author = 0"
SUBSET_WHERE = {
    "all": "true",
    "text": "is_removed_or_deleted = 0",
    "user": "is_deleted_author = 0",
    "text_user": "is_removed_or_deleted = 0 and is_deleted_author = 0",
}
FEATURE_COLUMNS = """id, author, subreddit, body, controversiality, created_utc, score, link_id, parent_id,
  created_ts, year, month, day, hour, weekday, body_length_chars, body_length_words,
  is_removed_or_deleted, is_deleted_author"""


def plain_time(df: DataFrame, *cols: str) -> DataFrame:
    """UTC wall time without a zone, so both engines hand out the same value."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("feature_base", BASE + f"select {FEATURE_COLUMNS} from features")
def _(spark, sf_dir):
    return plain_time(v.features(spark, sf_dir), "created_ts")


@query("feature_base_nulls", BASE_NULLS + f"select {FEATURE_COLUMNS} from features")
def _(spark, sf_dir):
    return plain_time(v.features(spark, sf_dir, nulls=True), "created_ts")


@query("roundtrip_feature_base", BASE + f"select {FEATURE_COLUMNS} from features")
def _(spark, sf_dir):
    df = v.features(spark, sf_dir)
    path = new_path(spark, "feature_base")
    write_table(df, path, partition_by=("year", "month"))
    return plain_time(read_table(spark, path).select(*df.columns), "created_ts")


@query(
    "filter_communities",
    BASE + f"""select id, author, subreddit, controversiality, score from comments
               where subreddit in ({sql_list(MEMBERS)})""",
)
def _(spark, sf_dir):
    kept = subsets.filter_members(v.comments(spark, sf_dir), "subreddit", MEMBERS)
    return kept.select("id", "author", "subreddit", "controversiality", "score")


@query("top_communities", BASE + "select subreddit, count(*) as count from features group by 1 order by 2 desc, 1 limit 3")
def _(spark, sf_dir):
    return subsets.top_groups(v.features(spark, sf_dir), "subreddit", 3)


@query(
    "subset_row_counts",
    BASE + " union all ".join(
        f"select '{k}_df' as metric, count(*) as value from features where {w}" for k, w in SUBSET_WHERE.items()
    ),
)
def _(spark, sf_dir):
    return subsets.subset_row_counts(v.features(spark, sf_dir))


def _register_community_counts(kind: str, where: str) -> None:
    @query(
        f"community_counts_{kind}",
        BASE + f"select subreddit, count(*) as count from features where {where} group by 1",
    )
    def _(spark, sf_dir):
        return subsets.group_counts(subsets.subset(v.features(spark, sf_dir), kind), "subreddit")


for _kind, _where in SUBSET_WHERE.items():
    _register_community_counts(_kind, _where)


@query(
    "community_counts_by_subset",
    BASE + " union all ".join(
        f"select subreddit, '{k}' as subset, count(*) as count from features where {w} group by 1"
        for k, w in SUBSET_WHERE.items()
    ),
)
def _(spark, sf_dir):
    return subsets.subset_group_counts(v.features(spark, sf_dir), "subreddit")


@query("label_distribution", BASE + "select controversiality, count(*) as count from features group by 1")
def _(spark, sf_dir):
    return subsets.distribution(v.features(spark, sf_dir), "controversiality")


@query(
    "label_distribution_by_subset",
    BASE + " union all ".join(
        f"select controversiality, '{k}' as subset, count(*) as count from features where {w} group by 1"
        for k, w in SUBSET_WHERE.items()
    ),
)
def _(spark, sf_dir):
    return subsets.subset_group_counts(v.features(spark, sf_dir), "controversiality")


FLAGS = ("is_removed_or_deleted", "is_deleted_author", "controversiality")


@query(
    "flag_distributions",
    BASE + " union all ".join(
        f"select '{c}' as \"column\", {c} as value, count(*) as count from features group by 2" for c in FLAGS
    ),
)
def _(spark, sf_dir):
    return subsets.distributions(v.features(spark, sf_dir), FLAGS)


PROFILED = ("author", "subreddit", "body", "controversiality", "created_utc")


@query(
    "null_profile",
    BASE_NULLS + "select " + ", ".join(f"count(*) - count({c}) as {c}" for c in PROFILED) + " from comments",
)
def _(spark, sf_dir):
    return subsets.null_profile(v.comments(spark, sf_dir, nulls=True), PROFILED)


@query("sql_view_count", "select count(*) as n, count(distinct event_type) as types from events")
def _(spark, sf_dir):
    events = v.table(spark, sf_dir, "events")
    return query_view(
        events, "colloquy_events",
        "select count(*) as n, count(distinct event_type) as types from colloquy_events",
    )


# The filter on even values is the operator here.
@query("even_doubled", "select event_id * 2 as doubled from events where event_id % 2 = 0")
def _(spark, sf_dir):
    events = v.table(spark, sf_dir, "events")
    return events.filter(F.col("event_id") % 2 == 0).select((F.col("event_id") * 2).alias("doubled"))


# --- scans ------------------------------------------------------------------------

ORDER_MONTHS = """select o_orderkey, o_orderpriority from orders
  where year(o_orderdate) = 1996 and month(o_orderdate) {which}"""


def order_months(spark, sf_dir) -> DataFrame:
    return v.table(spark, sf_dir, "orders").withColumns({"yyyy": F.year("o_orderdate"), "mm": F.month("o_orderdate")})


@query("scan_one_month", ORDER_MONTHS.format(which="= 3"))
def _(spark, sf_dir):
    path = new_path(spark, "months")
    write_table(order_months(spark, sf_dir), path, ("yyyy", "mm"))
    return read_month(spark, path, 1996, 3).select("o_orderkey", "o_orderpriority")


def order_files(spark, sf_dir) -> str:
    """One folder per year and month, named like monthly files."""
    root = new_path(spark, "files")
    parts = order_months(spark, sf_dir).filter("yyyy = 1996 and mm in (2, 3, 5)")
    for month in (2, 3, 5):
        (path,) = month_paths(root, 1996, [month], "orders")
        write_table(parts.filter(F.col("mm") == month).drop("yyyy", "mm"), path)
    return root


@query("scan_month_list", ORDER_MONTHS.format(which="in (2, 5)"))
def _(spark, sf_dir):
    root = order_files(spark, sf_dir)
    return read_files(spark, *month_paths(root, 1996, [2, 5], "orders")).select("o_orderkey", "o_orderpriority")


@query("scan_glob", ORDER_MONTHS.format(which="in (2, 3, 5)"))
def _(spark, sf_dir):
    root = order_files(spark, sf_dir)
    return read_table(spark, f"{root}/yyyy=1996/orders_1996-*.parquet").select("o_orderkey", "o_orderpriority")


@query("row_count", "select count(*) as rows from documents")
def _(spark, sf_dir):
    return subsets.row_count(v.table(spark, sf_dir, "documents"))


# The limit is the preview itself; a missing column is left out.
@query(
    "preview_documents",
    """select doc_id, lang, case when length(text) > 40 then substr(text, 1, 37) || '...' else text end as text
       from documents order by doc_id limit 10""",
)
def _(spark, sf_dir):
    docs = v.table(spark, sf_dir, "documents").orderBy("doc_id")
    return preview(docs, ("doc_id", "no_such_column", "lang", "text"), 10, 40)


@query(
    "schema_of_documents",
    """select cast(ordinal_position - 1 as int) as position, column_name as "column",
         case data_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' else lower(data_type) end as type, true as nullable
       from information_schema.columns where table_name = 'documents'""",
)
def _(spark, sf_dir):
    return schema_report(v.table(spark, sf_dir, "documents"))


# --- rates ------------------------------------------------------------------------


def rate_sql(dims: str, source: str = "features") -> str:
    return BASE + f"""select {dims}, count(*) as total_comments,
      cast(sum(controversiality) as bigint) as controversial_comments,
      round(sum(controversiality) / nullif(count(*), 0), 4) as controversy_rate
      from {source} group by all"""


@query("rate_by_community", rate_sql("subreddit"))
def _(spark, sf_dir):
    return by_rate(rate_by(v.features(spark, sf_dir), ["subreddit"]), "subreddit")


@query("roundtrip_summary_csv", rate_sql("subreddit"))
def _(spark, sf_dir):
    path = new_path(spark, "summary")
    frame = by_rate(rate_by(v.features(spark, sf_dir), ["subreddit"]), "subreddit")
    write_summary_csv(frame, path)
    return read_summary_csv(spark, path, frame.schema)


@query("rate_by_month", rate_sql("year, month"))
def _(spark, sf_dir):
    return rate_by(v.features(spark, sf_dir), ["year", "month"]).orderBy("year", "month")


@query("rate_by_year_month", rate_sql("concat(year, '-', lpad(cast(month as varchar), 2, '0')) as year_month"))
def _(spark, sf_dir):
    monthly = rate_by(v.features(spark, sf_dir), ["year", "month"])
    return with_year_month(monthly).drop("year", "month").orderBy("year_month")


@query(
    "rate_by_hour_local",
    rate_sql(f"cast(hour(timezone('{LOCAL_ZONE}', timezone('UTC', created_ts))) as int) as hour_est"),
)
def _(spark, sf_dir):
    local = with_local_hour(v.features(spark, sf_dir), "created_ts", LOCAL_ZONE)
    return rate_by(local, ["hour_est"]).orderBy("hour_est")


@query("rate_by_weekday", rate_sql("weekday, dayname(created_ts) as weekday_name"))
def _(spark, sf_dir):
    return with_weekday_name(rate_by(v.features(spark, sf_dir), ["weekday"])).orderBy("weekday")


@query("rate_by_community_month", rate_sql("subreddit, year, month"))
def _(spark, sf_dir):
    return rate_by(v.features(spark, sf_dir), ["subreddit", "year", "month"]).orderBy("subreddit", "year", "month")


# Orders span several years, events one month.
@query(
    "order_rate_by_month",
    """select o_orderpriority, year(o_orderdate)::int as year, month(o_orderdate)::int as month, count(*) as total_comments,
         count(*) filter (where o_orderstatus = 'F') as controversial_comments,
         round(count(*) filter (where o_orderstatus = 'F') / count(*), 4) as controversy_rate
       from orders group by 1, 2, 3""",
)
def _(spark, sf_dir):
    orders = with_time_parts(v.table(spark, sf_dir, "orders"), "o_orderdate")
    flagged = orders.withColumn("failed", (F.col("o_orderstatus") == "F").cast("int"))
    return rate_by(flagged, ["o_orderpriority", "year", "month"], "failed").orderBy("o_orderpriority", "year", "month")


# --- users ------------------------------------------------------------------------

TYPE = "case when count(distinct subreddit) = 1 then 'single_subreddit' else 'multi_subreddit' end as user_type"
PROFILE_SQL = f"""
profile as (
  select author, count(distinct subreddit) as distinct_subreddits, count(*) as total_comments,
         cast(sum(controversiality) as bigint) as controversial_comments, avg(score) as avg_score, {TYPE}
  from {USER_ROWS} group by author
),
typed as (
  select f.*, p.user_type, p.distinct_subreddits
  from (select * from {USER_ROWS}) f join profile p on f.author = p.author
)"""


def user_sql(tail: str, nulls: bool = False) -> str:
    return v.with_sql(v.comments_sql(nulls), v.FEATURES_SQL, PROFILE_SQL) + tail


def user_rows(spark, sf_dir, nulls=False) -> DataFrame:
    return subsets.subset(v.features(spark, sf_dir, nulls), "user")


def typed(spark, sf_dir, extra=(), nulls=False) -> DataFrame:
    return users.typed_activity(users.author_activity(user_rows(spark, sf_dir, nulls), extra))


PROFILE_COLUMNS = "author, distinct_subreddits, total_comments, controversial_comments, avg_score, user_type"
COMMENT_SUMMARY = """select user_type, count(*) as total_comments,
  cast(sum(controversiality) as bigint) as controversial_comments,
  round(avg(score), 2) as avg_score, round(avg(body_length_chars), 2) as avg_body_length_chars,
  round(avg(body_length_words), 2) as avg_body_length_words,
  round(sum(controversiality) / count(*), 4) as controversy_rate from typed group by 1"""
TYPE_COUNTS = "select user_type, count(*) as count from profile group by 1"


@query("distinct_users", BASE + f"select count(*) as distinct_author from (select distinct author from {USER_ROWS})")
def _(spark, sf_dir):
    return subsets.distinct_count(user_rows(spark, sf_dir), "author")


@query("user_profile", user_sql(f"select {PROFILE_COLUMNS} from profile"))
def _(spark, sf_dir):
    return users.user_profile(user_rows(spark, sf_dir))


@query("user_profile_nulls", user_sql(f"select {PROFILE_COLUMNS} from profile", nulls=True))
def _(spark, sf_dir):
    return users.user_profile(user_rows(spark, sf_dir, nulls=True))


@query("user_type_counts", user_sql(TYPE_COUNTS))
def _(spark, sf_dir):
    return users.user_type_counts(users.user_profile(user_rows(spark, sf_dir)))


@query("user_type_counts_nulls", user_sql(TYPE_COUNTS, nulls=True))
def _(spark, sf_dir):
    return users.user_type_counts(users.user_profile(user_rows(spark, sf_dir, nulls=True)))


@query("user_labeled", user_sql("select id, author, subreddit, distinct_subreddits, user_type from typed"))
def _(spark, sf_dir):
    rows = user_rows(spark, sf_dir).select("id", "author", "subreddit")
    return users.with_user_type(rows, keep=("distinct_subreddits", "user_type"))


@query("user_type_comment_summary", user_sql(COMMENT_SUMMARY))
def _(spark, sf_dir):
    return users.user_type_comment_summary(typed(spark, sf_dir))


@query("user_type_comment_summary_nulls", user_sql(COMMENT_SUMMARY, nulls=True))
def _(spark, sf_dir):
    return users.user_type_comment_summary(typed(spark, sf_dir, nulls=True))


@query(
    "user_type_user_summary",
    user_sql("""select user_type, count(*) as num_users, round(avg(distinct_subreddits), 2) as avg_distinct_subreddits,
      round(avg(total_comments), 2) as avg_comments_per_user,
      round(avg(controversial_comments), 2) as avg_controversial_comments_per_user,
      round(avg(avg_score), 2) as avg_user_mean_score from profile group by 1"""),
)
def _(spark, sf_dir):
    return users.user_type_user_summary(users.user_profile(user_rows(spark, sf_dir)))


@query(
    "community_user_type_summary",
    user_sql("""select subreddit, user_type, count(*) as total_comments,
      cast(sum(controversiality) as bigint) as controversial_comments, round(avg(score), 2) as avg_score,
      round(sum(controversiality) / count(*), 4) as controversy_rate from typed group by 1, 2"""),
)
def _(spark, sf_dir):
    return users.community_user_type_summary(typed(spark, sf_dir))


@query(
    "cross_community_over_time",
    user_sql("select year, month, user_type, count(*) as total_comments from typed group by 1, 2, 3"),
)
def _(spark, sf_dir):
    return users.cross_community_over_time(typed(spark, sf_dir, ("year", "month")))


@query("user_community_pairs", user_sql("select distinct author, subreddit from typed"))
def _(spark, sf_dir):
    return users.user_community_pairs(user_rows(spark, sf_dir))


PAIRS_SQL = """select a.subreddit as subreddit_a, b.subreddit as subreddit_b, count(distinct a.author) as shared_users
  from (select distinct author, subreddit from typed) a
  join (select distinct author, subreddit from typed) b on a.author = b.author and a.subreddit < b.subreddit
  group by 1, 2"""


@query("community_pairs", user_sql(PAIRS_SQL))
def _(spark, sf_dir):
    return users.community_pairs(users.user_community_pairs(user_rows(spark, sf_dir)))


@query("community_pairs_nulls", user_sql(PAIRS_SQL, nulls=True))
def _(spark, sf_dir):
    return users.community_pairs(users.user_community_pairs(user_rows(spark, sf_dir, nulls=True)))


# --- text -------------------------------------------------------------------------

TEXT = v.with_sql(v.comments_sql(), v.FEATURES_SQL, v.VALID_SQL, v.TEXT_BASE_SQL)
TEXT_COLUMNS = """id, author, subreddit, controversiality, score, created_utc, created_ts as created_ts_utc,
  year, month, day, hour, weekday, body, body_clean, body_length_chars, body_length_words,
  clean_char_count, clean_word_count"""


def tokens_cte(source: str, keys: str) -> str:
    return rf"""
tokens as (
  select * from (select {keys}, unnest(regexp_split_to_array(body_clean, '\s+')) as token from {source})
  where length(token) >= 3 and not regexp_full_match(token, '[0-9]+') and token not in ({sql_list(stop_words())})
)"""


def text_base(spark, sf_dir) -> DataFrame:
    return subsets.nlp_text_base(v.features(spark, sf_dir))


def text_users(spark, sf_dir) -> DataFrame:
    """Rows with text and a known author: the universe of lengths and common terms."""
    return subsets.subset(v.features(spark, sf_dir), "text_user").filter(F.col("author").isNotNull())


@query("nlp_text_base", TEXT + f"select {TEXT_COLUMNS} from text_base")
def _(spark, sf_dir):
    return plain_time(text_base(spark, sf_dir), "created_ts_utc")


@query(
    "tokens",
    lambda: v.with_sql(v.comments_sql(), v.FEATURES_SQL, v.VALID_SQL, v.TEXT_BASE_SQL)
    + rf"""select id, cast(len(kept) as int) as token_count, array_to_string(kept, ' ') as tokens
      from (select id, list_filter(regexp_split_to_array(body_clean, '\s+'), lambda t: length(t) >= 3
              and not regexp_full_match(t, '[0-9]+') and not list_contains([{sql_list(stop_words())}], t)) as kept
            from text_base)""",
)
def _(spark, sf_dir):
    kept = text_base(spark, sf_dir).select("id", tokens_of("body_clean").alias("kept"))
    return kept.select("id", F.size("kept").alias("token_count"), F.array_join("kept", " ").alias("tokens"))


LENGTHS = """{dim}, count(*) as total_comments,
  round(avg(body_length_chars), 2) as avg_body_length_chars,
  quantile_disc(body_length_chars, 0.5) as median_body_length_chars,
  round(avg(body_length_words), 2) as avg_body_length_words,
  quantile_disc(body_length_words, 0.5) as median_body_length_words
  from features where is_removed_or_deleted = 0 and is_deleted_author = 0 and author is not null group by 1"""


@query("length_stats_by_label", BASE + "select " + LENGTHS.format(dim="controversiality"))
def _(spark, sf_dir):
    rows = subsets.subset(v.features(spark, sf_dir), "text_user")
    return subsets.length_stats(rows, "controversiality").orderBy("controversiality")


@query("length_stats_by_community", BASE + "select " + LENGTHS.format(dim="subreddit"))
def _(spark, sf_dir):
    rows = subsets.subset(v.features(spark, sf_dir), "text_user")
    return subsets.length_stats(rows, "subreddit").orderBy(F.desc("total_comments"), "subreddit")


@query(
    "clean_length_by_community",
    TEXT + """select subreddit, round(avg(clean_char_count), 2) as avg_clean_char_count,
              round(avg(clean_word_count), 2) as avg_clean_word_count from text_base group by 1""",
)
def _(spark, sf_dir):
    return subsets.clean_length_by(text_base(spark, sf_dir), "subreddit")


# --- terms ------------------------------------------------------------------------

SPOKEN_SQL = f"""
spoken as (
  select f.*, {v.CLEAN_SQL} as body_clean from features f
  where is_removed_or_deleted = 0 and is_deleted_author = 0 and author is not null
),
types as (select author as type_author, {TYPE} from spoken group by author),
spoken_types as (select s.*, t.user_type from spoken s join types t on s.author = t.type_author)"""


def top_sql(dim: str) -> Callable[[], str]:
    return lambda: (
        v.with_sql(v.comments_sql(), v.FEATURES_SQL, SPOKEN_SQL, tokens_cte("spoken_types", dim))
        + f"""select * from (
            select *, row_number() over (partition by {dim} order by count desc, token) as rank
            from (select {dim}, token, count(*) as count from tokens group by 1, 2)) where rank <= 20"""
    )


def counted(spark, sf_dir, rows: DataFrame, dim: str) -> DataFrame:
    """Term counts by a column with few values; those are read without the texts, of all events."""
    return terms.counted_terms(rows, dim, terms.few_groups(v.dimensions(spark, sf_dir), dim))


def spoken_counts(spark, sf_dir, dim: str) -> DataFrame:
    return counted(spark, sf_dir, text_users(spark, sf_dir), dim)


@query("top_terms_by_label", top_sql("controversiality"))
def _(spark, sf_dir):
    return terms.top_terms(spoken_counts(spark, sf_dir, "controversiality"), "controversiality")


@query("top_terms_by_community", top_sql("subreddit"))
def _(spark, sf_dir):
    return terms.top_terms(spoken_counts(spark, sf_dir, "subreddit"), "subreddit")


@query("top_terms_by_user_type", top_sql("user_type"))
def _(spark, sf_dir):
    rows = text_users(spark, sf_dir)
    types = stage(users.user_types(rows), "user-types")
    return terms.top_terms(terms.term_counts(typed_terms(rows, types), ["user_type"]), "user_type")


def typed_terms(rows: DataFrame, types: DataFrame, **join) -> DataFrame:
    """Terms with their author's type. Cleaned texts meet the types; terms are told apart after
    the explode, where the tests are compiled."""
    cleaned = rows.select("id", "author", clean_text("body").alias("body_clean"))
    return explode_tokens(users.with_user_type(cleaned, types, **{"wide": True, **join}), ["user_type"])


def nlp_counts(spark, sf_dir, dim: str) -> DataFrame:
    return counted(spark, sf_dir, subsets.valid_text_rows(v.features(spark, sf_dir)), dim)


@query(
    "term_counts_by_community",
    lambda: TEXT.rstrip() + "," + tokens_cte("text_base", "subreddit")
    + "\nselect subreddit, token, count(*) as count from tokens group by 1, 2",
)
def _(spark, sf_dir):
    return nlp_counts(spark, sf_dir, "subreddit")


@query(
    "overall_term_share",
    lambda: TEXT.rstrip() + "," + tokens_cte("text_base", "subreddit")
    + """
select token, count(*) as overall_count, count(*) / (select count(*) from tokens) as overall_share
from tokens group by 1""",
)
def _(spark, sf_dir):
    counts = terms.counted_terms(subsets.valid_text_rows(v.features(spark, sf_dir)))
    return terms.term_share(stage(counts, "term-counts"))


@query(
    "group_term_totals",
    lambda: TEXT.rstrip() + "," + tokens_cte("text_base", "subreddit")
    + "\nselect subreddit, count(*) as group_total_tokens from tokens group by 1",
)
def _(spark, sf_dir):
    tokens = explode_tokens(text_base(spark, sf_dir), ["subreddit"])
    return terms.group_totals(tokens, "subreddit")


def distinctive_sql(dim: str) -> Callable[[], str]:
    return lambda: (
        TEXT.rstrip() + "," + tokens_cte("text_base", dim) + f""",
counted as (select {dim}, token, count(*) as group_count from tokens group by 1, 2),
totals as (select {dim} as total_of, count(*) as group_total from tokens group by 1),
overall as (select token as term, count(*) / (select count(*) from tokens) as overall_share from tokens group by 1),
scored as (
  select c.*, group_count / group_total as group_share,
         round((group_count / group_total) / overall_share, 4) as lift
  from counted c left join totals on {dim} = total_of left join overall on token = term
  where group_count >= {MIN_COUNT}
)
select {dim}, rank, token, round(group_share, 6) as group_share, group_count, lift
from (select *, row_number() over (partition by {dim} order by lift desc, group_count desc, token) as rank from scored)
where rank <= 20"""
    )


def _register_distinctive(name: str, dim: str) -> None:
    @query(f"distinctive_terms_by_{name}", distinctive_sql(dim))
    def _(spark, sf_dir):
        counts = stage(nlp_counts(spark, sf_dir, dim), "term-counts")
        return terms.distinctive_terms(counts, dim, min_count=MIN_COUNT)


_register_distinctive("label", "controversiality")
_register_distinctive("community", "subreddit")

SCORED_KEYS = "id, author, subreddit, controversiality, score, year, month, hour, weekday"


def sentiment_cte() -> str:
    return (
        TEXT.rstrip() + "," + tokens_cte("text_base", SCORED_KEYS) + f""",
hits as (
  select {SCORED_KEYS},
         cast(sum(case when token in ({sql_list(POSITIVE_WORDS)}) then 1 else 0 end) as bigint) as positive_token_count,
         cast(sum(case when token in ({sql_list(NEGATIVE_WORDS)}) then 1 else 0 end) as bigint) as negative_token_count,
         count(*) as token_count
  from tokens group by all
),
scored as (
  select *, positive_token_count - negative_token_count as sentiment_score,
         round((positive_token_count - negative_token_count) / token_count, 4) as sentiment_score_per_token
  from hits
)
"""
    )


@query("comment_sentiment", lambda: sentiment_cte() + "select * from scored")
def _(spark, sf_dir):
    return comment_sentiment(text_base(spark, sf_dir))


def _register_sentiment(name: str, dim: str) -> None:
    @query(
        f"sentiment_by_{name}",
        lambda: sentiment_cte() + f"""select {dim}, count(*) as total_comments,
          round(avg(positive_token_count), 2) as avg_positive_tokens,
          round(avg(negative_token_count), 2) as avg_negative_tokens,
          round(avg(sentiment_score), 2) as avg_sentiment_score,
          round(avg(sentiment_score_per_token), 4) as avg_sentiment_score_per_token from scored group by 1""",
    )
    def _(spark, sf_dir):
        return sentiment_by(comment_sentiment(text_base(spark, sf_dir)), dim)


_register_sentiment("label", "controversiality")
_register_sentiment("community", "subreddit")


# --- models -----------------------------------------------------------------------


def model_ctes(nulls: bool = False) -> str:
    return v.with_sql(
        v.comments_sql(nulls), v.FEATURES_SQL, v.VALID_SQL,
        """
by_user as (
  select author, count(distinct subreddit) as distinct_subreddits_per_user, count(*) as total_comments_per_user,
         avg(score) as avg_score_per_user,
         cast(sum(controversiality) as bigint) as total_controversial_comments_per_user,
         case when count(distinct subreddit) > 1 then 1 else 0 end as is_multi_subreddit_user
  from valid group by author
),
by_community as (
  select subreddit, count(*) as subreddit_total_comments, avg(score) as subreddit_avg_score,
         avg(body_length_chars) as subreddit_avg_body_length_chars,
         avg(body_length_words) as subreddit_avg_body_length_words,
         avg(controversiality) as subreddit_controversy_rate
  from valid group by subreddit
),
base as (
  select v.id, v.author, v.subreddit, v.body, v.controversiality as label, v.controversiality,
         v.score as score_rounded, v.year, v.month, v.day, v.hour, v.weekday,
         v.body_length_chars as body_length_chars_rounded, v.body_length_words as body_length_words_rounded,
         round(ln(1 + v.body_length_words), 4) as log_body_length_words,
         u.distinct_subreddits_per_user, u.total_comments_per_user,
         round(ln(1 + u.total_comments_per_user), 4) as log_total_comments_per_user,
         round(u.avg_score_per_user, 2) as avg_score_per_user_rounded,
         u.total_controversial_comments_per_user, u.is_multi_subreddit_user,
         c.subreddit_total_comments, round(c.subreddit_avg_score, 2) as subreddit_avg_score_rounded,
         c.subreddit_avg_body_length_chars, c.subreddit_avg_body_length_words,
         round(c.subreddit_controversy_rate, 4) as subreddit_controversy_rate_rounded
  from valid v left join by_user u on v.author = u.author left join by_community c on v.subreddit = c.subreddit
),
sides as (
  select id, label, case when cast('0x' || substr(md5(concat('42:', id)), 1, 8) as bigint) % 10000 < 8000
                         then 'train' else 'test' end as side
  from base
)""",
    )


def valid_activity(spark, sf_dir) -> DataFrame:
    return users.author_activity(subsets.valid_text_rows(v.features(spark, sf_dir)))


def labelled(spark, sf_dir) -> DataFrame:
    rows = subsets.valid_text_rows(v.features(spark, sf_dir))
    return rows.withColumn("label", F.col("controversiality").cast("int"))


@query("ml_user_features", model_ctes() + "select * from by_user")
def _(spark, sf_dir):
    return user_features(valid_activity(spark, sf_dir))


@query("ml_community_features", model_ctes() + "select * from by_community")
def _(spark, sf_dir):
    return community_features(users.community_activity(subsets.valid_text_rows(v.features(spark, sf_dir))))


TRAIN_SQL = "cast('0x' || substr(md5(concat('42:', id)), 1, 8) as bigint) % 10000 < 8000"


@query(
    "ml_user_features_train",
    model_ctes() + f"""select author, count(distinct subreddit) as distinct_subreddits_per_user, count(*) as total_comments_per_user,
      avg(score) as avg_score_per_user, cast(sum(controversiality) as bigint) as total_controversial_comments_per_user,
      case when count(distinct subreddit) > 1 then 1 else 0 end as is_multi_subreddit_user
      from valid where {TRAIN_SQL} group by author""",
)
def _(spark, sf_dir):
    return user_features(users.author_activity(feature_rows(subsets.valid_text_rows(v.features(spark, sf_dir)), "train")))


FILLED = ", ".join(f"coalesce({c}, 0) as {c}" for c in NUMERIC_FEATURES)


@query("model_input_nulls", model_ctes(nulls=True) + f"select id, label, subreddit, {FILLED} from base")
def _(spark, sf_dir):
    return models.fill_inputs(model_input(v.features(spark, sf_dir, nulls=True)))


@query(
    "category_index",
    model_ctes() + """select cast(row_number() over (order by count(*) desc, subreddit) - 1 as int) as position, subreddit as value
      from base join sides using (id) where side = 'train' group by subreddit""",
)
def _(spark, sf_dir):
    train, _test = evaluation.split(labelled(spark, sf_dir))
    return models.fitted_index(train, "subreddit")


SLOTS_SQL = """,
known as (select subreddit, row_number() over (order by count(*) desc, subreddit) - 1 as position
          from base join sides using (id) where side = 'train' group by subreddit)
select b.id, cast(k.position as int) as category_slot, b.score_rounded as score_value,
       b.hour as hour_value, b.total_comments_per_user as user_comments_value
from base b join known k on b.subreddit = k.subreddit"""


@query("slot_values", lambda: model_ctes().rstrip() + SLOTS_SQL)
def _(spark, sf_dir):
    base = stage(model_input(v.features(spark, sf_dir)), "slots")
    train, _test = evaluation.split(base)
    assembled = Pipeline(stages=models.feature_stages()).fit(train).transform(models.fill_inputs(base))
    slots = models.slot_names(assembled)
    values = vector_to_array("features")
    width = len(slots) - len(NUMERIC_FEATURES)

    def number(name: str):
        return F.get(values, F.lit(slots.index(name))).cast("long")

    return assembled.select(
        "id",
        (F.array_position(F.slice(values, 1, width), 1.0) - 1).cast("int").alias("category_slot"),
        number("score_rounded").alias("score_value"),
        number("hour").alias("hour_value"),
        number("total_comments_per_user").alias("user_comments_value"),
    )


@query(
    "rule_roc_area",
    model_ctes().rstrip() + """,
ranked as (select controversiality as label, rank() over (order by body_length_words) + (count(*) over (partition by body_length_words) - 1) / 2.0 as r from valid)
select round((sum(r) filter (where label = 1) - count(*) filter (where label = 1) * (count(*) filter (where label = 1) + 1) / 2.0)
       / (count(*) filter (where label = 1) * count(*) filter (where label = 0)), 4) as auc_roc from ranked""",
)
def _(spark, sf_dir):
    scored = labelled(spark, sf_dir).select("label", F.col("body_length_words").cast("double").alias("rawPrediction"))
    return spark.createDataFrame([(models.roc_area(stage(scored, "scores")),)], "auc_roc double")


@query("ml_model_base", model_ctes() + "select * from base")
def _(spark, sf_dir):
    return model_base(v.features(spark, sf_dir, source=True), bodies=v.bodies(spark, sf_dir), source=v.SOURCE)


@query("ml_model_base_nulls", model_ctes(nulls=True) + "select * from base")
def _(spark, sf_dir):
    return model_base(v.features(spark, sf_dir, True, source=True), bodies=v.bodies(spark, sf_dir, True), source=v.SOURCE)


@query(
    "multi_community_user_distribution",
    model_ctes() + "select is_multi_subreddit_user, count(*) as count from base group by 1",
)
def _(spark, sf_dir):
    return subsets.distribution(model_base(v.features(spark, sf_dir)), "is_multi_subreddit_user")


@query("split_counts", model_ctes() + "select side, label, count(*) as count from sides group by 1, 2")
def _(spark, sf_dir):
    return evaluation.split_counts(labelled(spark, sf_dir))


@query(
    "class_weights",
    model_ctes() + """select label, count(*) as rows,
      (select count(*) from sides where side = 'train') / (2 * count(*)) as weight
      from sides where side = 'train' group by 1""",
)
def _(spark, sf_dir):
    train, _test = evaluation.split(labelled(spark, sf_dir))
    return evaluation.class_weights(train)


# A fixed rule stands in for a model, so that SQL can count its hits.
RULE_SQL = "select controversiality as label, case when body_length_words > 300 then 1.0 else 0.0 end as prediction from valid"


def rule_predictions(spark, sf_dir) -> DataFrame:
    rule = F.when(F.col("body_length_words") > 300, 1.0).otherwise(0.0)
    return labelled(spark, sf_dir).select("label", rule.alias("prediction"))


@query(
    "rule_confusion_counts",
    model_ctes() + f"select label, cast(prediction as double) as prediction, count(*) as count from ({RULE_SQL}) group by 1, 2",
)
def _(spark, sf_dir):
    return evaluation.confusion(rule_predictions(spark, sf_dir))


@query(
    "confusion_summary",
    model_ctes() + f"""select 'rule' as model, tn as true_negatives, fp as false_positives, fn as false_negatives,
      tp as true_positives, coalesce(round(tp / nullif(tp + fp, 0), 4), 0) as positive_precision,
      coalesce(round(tp / nullif(tp + fn, 0), 4), 0) as positive_recall,
      coalesce(round(tn / nullif(tn + fp, 0), 4), 0) as specificity
      from (select count(*) filter (where label = 0 and prediction = 0) as tn,
                   count(*) filter (where label = 0 and prediction = 1) as fp,
                   count(*) filter (where label = 1 and prediction = 0) as fn,
                   count(*) filter (where label = 1 and prediction = 1) as tp from ({RULE_SQL}))""",
)
def _(spark, sf_dir):
    return evaluation.confusion_summary(evaluation.confusion(rule_predictions(spark, sf_dir)), "rule")


RULE_METRICS_SQL = f"""
cells as (select label, prediction, count(*) as n from ({RULE_SQL}) group by 1, 2),
classes as (
  select a.label, support, hits / support as r, coalesce(hits / nullif(predicted, 0), 0) as p, hits
  from (select label, sum(n) as support, sum(case when label = prediction then n else 0 end) as hits
        from cells group by 1) a
  left join (select prediction, sum(n) as predicted from cells group by 1) b on a.label = b.prediction
),
metrics as (
  select round(sum(hits) / sum(support), 4) as accuracy,
         round(sum(coalesce(2 * p * r / nullif(p + r, 0), 0) * support) / sum(support), 4) as f1,
         round(sum(p * support) / sum(support), 4) as weighted_precision,
         round(sum(r * support) / sum(support), 4) as weighted_recall
  from classes
)
"""


@query("rule_metrics", model_ctes().rstrip() + "," + RULE_METRICS_SQL + "select * from metrics")
def _(spark, sf_dir):
    return evaluation.classification_metrics(evaluation.confusion(rule_predictions(spark, sf_dir)))


@query(
    "rule_metrics_long",
    model_ctes().rstrip() + "," + RULE_METRICS_SQL
    + " union all ".join(f"select 'rule' as model, '{m}' as metric, {m} as value from metrics" for m in models.METRICS[1:]),
)
def _(spark, sf_dir):
    one = evaluation.classification_metrics(evaluation.confusion(rule_predictions(spark, sf_dir)))
    return models.metrics_long(one.withColumn("model", F.lit("rule")))


def rule_metrics_of(limit: int) -> str:
    return RULE_METRICS_SQL.replace("body_length_words > 300", f"body_length_words > {limit}")


@query(
    "rule_metrics_stacked",
    " union all ".join(
        f"select * from ({model_ctes().rstrip()}, {rule_metrics_of(limit)} select 'longer than {limit}' as model, metrics.* from metrics)" for limit in (100, 300)
    ),
)
def _(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    found = []
    for limit in (100, 300):
        rule = F.when(F.col("body_length_words") > limit, 1.0).otherwise(0.0)
        counts = evaluation.confusion(rows.select("label", rule.alias("prediction")))
        found.append(evaluation.classification_metrics(counts).select(F.lit(f"longer than {limit}").alias("model"), "*"))
    return found[0].unionByName(found[1])


# What is known of fitted models without their values: slot names, the rows they judge, sums.
@query(
    "fitted_model_checks",
    model_ctes() + f"""select 'Logistic Regression' as model, (select count(distinct subreddit) from base join sides using (id) where side = 'train') + {len(NUMERIC_FEATURES)} as slots,
      count(*) filter (where label = 0) as test_rows_0, count(*) filter (where label = 1) as test_rows_1, cast(null as double) as importance
      from sides where side = 'test'
      union all select 'Random Forest', (select count(distinct subreddit) from base join sides using (id) where side = 'train') + {len(NUMERIC_FEATURES)},
      count(*) filter (where label = 0), count(*) filter (where label = 1), 1.0 from sides where side = 'test'""",
)
def _(spark, sf_dir):
    found = None
    for model in trained(spark, sf_dir, models.LOGISTIC, models.FOREST):
        weights = model.weights()
        of = F.round(F.sum("importance"), 6) if "importance" in weights.columns else F.lit(None).cast("double")
        one = weights.agg(F.lit(model.name).alias("model"), F.count("*").alias("slots"), of.alias("importance"))
        rows = [F.coalesce(F.sum(F.when(F.col("label") == c, F.col("count"))), F.lit(0)).alias(f"test_rows_{c}") for c in (0, 1)]
        one = one.crossJoin(F.broadcast(model.confusion().agg(*rows)))
        found = one if found is None else found.unionByName(one)
    return found


def trained(spark, sf_dir, *names: str) -> list[models.Trained]:
    return models.train_models(model_input(v.features(spark, sf_dir)), names)


def both_metrics(spark, sf_dir) -> DataFrame:
    lr, rf = trained(spark, sf_dir, models.LOGISTIC, models.FOREST)
    return lr.metrics().unionByName(rf.metrics())


@query("logreg_metrics")
def _(spark, sf_dir):
    return trained(spark, sf_dir, models.LOGISTIC)[0].metrics()


@query("rf_metrics")
def _(spark, sf_dir):
    return trained(spark, sf_dir, models.FOREST)[0].metrics()


@query("model_metrics")
def _(spark, sf_dir):
    return both_metrics(spark, sf_dir)


@query("model_metrics_long")
def _(spark, sf_dir):
    return models.metrics_long(both_metrics(spark, sf_dir))


@query("confusion_counts")
def _(spark, sf_dir):
    return trained(spark, sf_dir, models.LOGISTIC)[0].confusion()


@query("logreg_coefficients")
def _(spark, sf_dir):
    return trained(spark, sf_dir, models.LOGISTIC)[0].weights()


@query("rf_importances")
def _(spark, sf_dir):
    return trained(spark, sf_dir, models.FOREST)[0].weights()


# --- trips ------------------------------------------------------------------------

DAILY_SQL = f"""select cast(year(l_shipdate) as int) as dt_year, cast(month(l_shipdate) as int) as dt_month,
  cast(day(l_shipdate) as int) as dt_day, count(*) as num_trips, avg(l_quantity) as mean_trip_distance,
  max(l_tax) as max_mta_tax, quantile_disc(l_extendedprice, 0.95) as q95_fare_amount,
  min(l_discount) as min_tip_amount, cast(ceil(avg(l_linenumber)) as bigint) as mean_passenger_count
  from lineitem where l_shipdate >= timestamp '{YEAR}-01-01' and l_shipdate < timestamp '{YEAR + 1}-01-01'
  group by 1, 2, 3"""


def daily(spark, sf_dir) -> DataFrame:
    return trips.daily_summary(v.table(spark, sf_dir, "lineitem"), YEAR, LINEITEM_TRIPS)


@query("daily_summary", DAILY_SQL)
def _(spark, sf_dir):
    return daily(spark, sf_dir)


@query(
    "daily_rollup",
    f"""select count(*) as days, cast(sum(num_trips) as bigint) as total_trips,
      round(avg(num_trips), 0) as avg_daily_trips,
      strftime(min(make_date(dt_year, dt_month, dt_day)), '%Y-%m-%d') as first_day,
      strftime(max(make_date(dt_year, dt_month, dt_day)), '%Y-%m-%d') as last_day from ({DAILY_SQL})""",
)
def _(spark, sf_dir):
    return trips.daily_rollup(daily(spark, sf_dir))


# --- along time -------------------------------------------------------------------


@query(
    "author_course",
    BASE + """select id, author, row_number() over w as place, created_utc - lag(created_utc) over w as seconds_since_last,
      cast(sum(controversiality) over w as bigint) as flags_so_far
      from comments where author is not null window w as (partition by author order by created_utc, id)""",
)
def _(spark, sf_dir):
    return timeline.author_course(v.comments(spark, sf_dir))


@query(
    "last_purchase_before",
    """select e.event_id, e.user_id, p.event_id as purchase_id, p.value as purchase_value
       from events e asof left join (select * from events where event_type = 'purchase') p on e.user_id = p.user_id and e.ts > p.ts""",
)
def _(spark, sf_dir):
    events = v.table(spark, sf_dir, "events")
    purchases = events.filter("event_type = 'purchase'")
    values = {"purchase_id": "event_id", "purchase_value": "value"}
    found = timeline.as_of(events.select("event_id", "user_id", "ts"), purchases, "user_id", "ts", "ts", values, ("event_id",), inclusive=False)
    return found.select("event_id", "user_id", *values)


@query(
    "user_sessions",
    """select user_id, session, min(ts) as session_start, max(ts) as session_end, count(*) as events,
         count(*) filter (where event_type = 'purchase') as purchases
       from (select *, cast(sum(starts) over (partition by user_id order by ts, event_id) as bigint) as session
             from (select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval 3 hours then 0 else 1 end as starts from events))
       group by 1, 2""",
)
def _(spark, sf_dir):
    events = v.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return timeline.sessions(events, "user_id", "ts", ("event_id",), 3 * 3600, {"purchases": F.count_if(F.col("event_type") == "purchase")})


SPANS_SQL = "select l_orderkey, min(l_shipdate) as first_ship, max(l_shipdate) as last_ship from lineitem group by 1"


@query(
    "orders_during_shipping",
    f"""select a.o_orderkey as order_key, b.o_orderkey as shipping_key, b.first_ship, b.last_ship
        from orders a join (select o_orderkey, o_custkey, first_ship, last_ship from orders join ({SPANS_SQL}) on o_orderkey = l_orderkey) b
          on a.o_custkey = b.o_custkey and a.o_orderdate between b.first_ship and b.last_ship""",
)
def _(spark, sf_dir):
    """A customer's orders placed while another of their orders was being shipped."""
    orders = v.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("placed"))
    lines = v.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    # Both sides grow with the data: compressed files say little of the rows that a broadcast would hold.
    spans = orders.join(lines.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    spans = spans.withColumns({"from": F.unix_seconds(F.col("first_ship").cast("timestamp")), "to": F.unix_seconds(F.col("last_ship").cast("timestamp"))})
    spans = stage(spans.select("o_orderkey", "o_custkey", "first_ship", "last_ship", "from", "to"), "spans")
    met = intervals.interval_join(orders, spans, ("placed", "placed"), ("from", "to"), ["o_custkey"])
    columns = [F.col("left.o_orderkey").alias("order_key"), F.col("right.o_orderkey").alias("shipping_key")]
    return met.select(*columns, F.col("right.first_ship").alias("first_ship"), F.col("right.last_ship").alias("last_ship"))


# Windows that the watermark has closed when all files are read.
@query(
    "stream_flag_rate",
    BASE.rstrip() + """,
closed as (
  select cast(date_trunc('day', make_timestamp(created_utc * 1000000)) as timestamp) as window_start, subreddit as community, controversiality as flag from comments
)
select window_start, window_start + interval 1 day as window_end, community, count(*) as total_comments, cast(sum(flag) as bigint) as controversial_comments,
  round(sum(flag) / count(*), 4) as controversy_rate
from closed where window_start + interval 1 day <= (select max(make_timestamp(created_utc * 1000000)) - interval 6 hours from comments) group by 1, 2, 3""",
)
def _(spark, sf_dir):
    source, table, checkpoint = (new_path(spark, name) for name in ("arrivals", "closed-windows", "stream-state"))
    arriving = v.comments(spark, sf_dir).select(F.timestamp_seconds("created_utc").alias("at"), F.col("subreddit").alias("community"), F.col("controversiality").cast("long").alias("flag"))
    # Files in the order of time: what one trigger reads is never late for the next.
    arriving.repartitionByRange(4, "at").write.parquet(source)
    stream = rates_stream.comment_stream(spark, source, "at timestamp, community string, flag long")
    rates_stream.write_closed_windows(rates_stream.windowed_flags(stream, "1 day", "6 hours"), table, checkpoint).awaitTermination()
    return plain_time(rates_stream.read_rates(spark, table), "window_start", "window_end")


# --- roll-ups ---------------------------------------------------------------------


@query(
    "term_grains",
    lambda: TEXT.rstrip() + "," + tokens_cte("text_base", "subreddit")
    + """
select case grouping(subreddit, token) when 0 then 'group and term' when 1 then 'group' when 2 then 'term' else 'all' end as grain,
  subreddit, token, count(*) as count
from tokens group by grouping sets ((subreddit, token), (token), (subreddit), ())""",
)
def _(spark, sf_dir):
    return terms.count_grains(nlp_counts(spark, sf_dir, "subreddit"), "subreddit")


ROLL_UPS = {"community": ["subreddit"], "month": ["year", "month"], "all": []}


@query(
    "distinct_author_sketches",
    BASE + "select * from (" + " union all ".join(
        f"""select '{name}' as grain, {'subreddit' if 'subreddit' in dims else 'null'} as subreddit, {'month' if 'month' in dims else 'null'} as month,
            count(distinct author) as authors, true as within_bound from features where is_deleted_author = 0 {'group by ' + ', '.join(dims) if dims else ''}"""
        for name, dims in ROLL_UPS.items()
    ) + ")",
)
def _(spark, sf_dir):
    """Estimates by sketches of community and month, held against exact counts: within four deviations."""
    rows = stage(user_rows(spark, sf_dir).select("author", "subreddit", "year", "month"), "authors")
    stored = stage(sketches.distinct_sketches(rows, "author", ["subreddit", "year", "month"]), "sketches")
    found = []
    for name, dims in ROLL_UPS.items():
        exact = rows.groupBy(*dims).agg(F.count_distinct("author").alias("authors"))
        estimated = sketches.estimate_by(stored, dims)
        both = exact.join(estimated, dims) if dims else exact.withColumn("estimate", estimated.select("estimate").scalar())
        near = F.abs(F.col("estimate") - F.col("authors")) <= F.ceil(4 * sketches.ERROR * F.col("authors"))
        shown = [F.col(c) if c in dims else F.lit(None).cast(kind).alias(c) for c, kind in (("subreddit", "string"), ("month", "int"))]
        found.append(both.select(F.lit(name).alias("grain"), *shown, "authors", near.alias("within_bound")))
    return found[0].unionByName(found[1]).unionByName(found[2])


# --- stored by key, and period by period ------------------------------------------

BUCKETS = 8


def stored_users(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Comments and user types, both stored by author."""
    rows = user_rows(spark, sf_dir).select("id", "author", "subreddit").filter(F.col("author").isNotNull())
    comments = bucketed.stage_by_key(rows, "comments-by-author", "author", BUCKETS)
    return comments, bucketed.stage_by_key(users.user_types(comments), "types-by-author", "author", BUCKETS)


@query("user_labeled_stored", user_sql("select id, author, subreddit, distinct_subreddits, user_type from typed"))
def _(spark, sf_dir):
    comments, types = stored_users(spark, sf_dir)
    return comments.join(types.drop("author_rows").hint("merge"), "author").select("id", "author", "subreddit", "distinct_subreddits", "user_type")


ACTIVITY_SQL = """select author, subreddit, count(*) as comments, cast(sum(score) as bigint) as score_sum, count(score) as score_n,
  cast(sum(body_length_chars) as bigint) as body_length_chars_sum, count(body_length_chars) as body_length_chars_n,
  cast(sum(body_length_words) as bigint) as body_length_words_sum, count(body_length_words) as body_length_words_n,
  cast(sum(controversiality) as bigint) as controversiality_sum, count(controversiality) as controversiality_n
  from features where is_deleted_author = 0 group by 1, 2"""


@query("activity_from_increments", BASE + ACTIVITY_SQL)
def _(spark, sf_dir):
    """The comments hold one month: periods are days. They come in three deliveries, one of them twice."""
    raw = stage(v.comments(spark, sf_dir), "raw")
    features, activity = new_path(spark, "features"), new_path(spark, "activity")
    day = F.dayofmonth(F.timestamp_seconds("created_utc"))
    for delivered in (day <= 12, day.between(13, 20), day > 20, day.between(13, 20)):
        increments.add_comments(spark, raw.filter(delivered), features, activity, ("year", "month", "day"))
    return increments.total_activity(spark, activity)


# --- fitted models, proved --------------------------------------------------------


@query(
    "model_proofs",
    model_ctes() + """select 'slopes of the ridge loss are near 0' as proof, true as holds, count(*) as train_rows from sides where side = 'train'
      union all select 'importances do not depend on placement', true, count(*) from sides where side = 'train'""",
)
def _(spark, sf_dir):
    base = stage(model_input(v.features(spark, sf_dir)), "proved")
    (lr,) = models.train_models(base, [models.LOGISTIC])
    steepest = models.ridge_gradient(lr.model.stages[-1], lr.train).agg(F.max(F.abs("slope"))).first()[0]
    found = [models.train_models(stage(base.repartition(parts), "placed"), [models.FOREST])[0].model.stages[-1].featureImportances for parts in (3, 7)]
    rows = [("slopes of the ridge loss are near 0", steepest < 1e-3), ("importances do not depend on placement", found[0] == found[1])]
    counted = base.filter(evaluation.split_bucket("id", 42) < 8000).agg(F.count("*")).scalar()
    return spark.createDataFrame(rows, "proof string, holds boolean").withColumn("train_rows", counted)
