"""The command-line chain on stored tables, and one-pass reports against direct forms."""

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks import views
from colloquy.operators import rates, subsets, terms, users
from colloquy.plans import cli, reports
from colloquy.sources.tables import read_summary_csv

MEMBERS = ["politics", "worldnews", "news", "conspiracy"]
NAMES = dict(zip(["view", "purchase", "signup", "error", "click"], [*MEMBERS, "elsewhere"]))


@pytest.fixture(scope="module")
def chain(spark, sf_dir, tmp_path_factory):
    """Raw comments in the yyyy=/mm= layout, run through all jobs."""
    root = tmp_path_factory.mktemp("chain")
    named = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    raw = (
        views.comments(spark, sf_dir)
        .withColumn("subreddit", named[F.col("subreddit")])
        # Every second comment moves to the next month.
        .withColumn("created_utc", F.col("created_utc") + (F.col("score") % 2) * 31 * 86400)
    )
    at = F.timestamp_seconds("created_utc")
    layout = raw.withColumns({"yyyy": F.year(at), "mm": F.date_format(at, "MM")})
    layout.write.partitionBy("yyyy", "mm").parquet(f"{root}/raw")

    def run(job, source, *more):
        cli.main([job, "--input", f"{root}/{source}", "--output", f"{root}/{job}", *more])

    run("list", "raw", "--year", "2024", "--months", "1")
    run("filter", "raw")
    run("explore", "filter")
    run("features", "filter")
    for job in ("subsets", "time", "communities", "text", "text-base", "model-base"):
        run(job, "features")
    run("filter-checks", "filter")
    run("feature-checks", "features")
    run("text-base-checks", "text-base", "--features", f"{root}/features")
    run("nlp", "text-base", "--min-count", "5")
    run("model-base-checks", "model-base", "--features", f"{root}/features")
    run("models", "model-base")
    return root


def csv(spark, path, schema):
    return [tuple(r) for r in read_summary_csv(spark, str(path), schema).collect()]


def test_list_covers_one_month_and_every_community(spark, chain):
    listed = csv(spark, chain / "list/subreddits", "subreddit string, count long")
    month = spark.read.parquet(f"{chain}/raw").filter("yyyy = 2024 and mm = 1")
    assert sum(n for _, n in listed) == month.count()
    assert {name for name, _ in listed} == set(NAMES.values())
    assert [n for _, n in listed] == sorted((n for _, n in listed), reverse=True)


def test_filter_keeps_members_and_layout(spark, chain):
    kept = spark.read.parquet(f"{chain}/filter")
    assert {r[0] for r in kept.select("subreddit").distinct().collect()} == set(MEMBERS)
    assert (chain / "filter/yyyy=2024/mm=1").exists() or (chain / "filter/yyyy=2024/mm=01").exists()


def test_feature_table_is_laid_out_by_month(spark, chain):
    months = sorted(p.name for p in (chain / "features/year=2024").iterdir() if p.is_dir())
    assert months[:2] == ["month=1", "month=2"]


def test_every_summary_file_exists(chain):
    expected = {
        "explore": ["row_count", "schema", "subreddit_counts", "null_profile", "sample", "controversiality_distribution"],
        "subsets": ["subset_row_counts", "controversy_rate_by_subreddit",
                    *[f"{k}_subreddit_counts" for k in subsets.SUBSETS]],
        "time": ["controversy_by_subreddit", "controversy_by_month", "controversy_by_hour", "controversy_by_weekday",
                 "controversy_over_time_by_subreddit"],
        "communities": ["user_type_counts", "user_type_comment_summary", "user_type_user_summary",
                        "subreddit_user_type_summary", "cross_community_over_time", "subreddit_pair_counts"],
        "text": ["text_length_by_controversy", "text_length_by_subreddit", "top_terms_by_controversy",
                 "top_terms_by_subreddit", "top_terms_by_user_type"],
        "nlp": ["sentiment_by_controversy", "sentiment_by_subreddit", "top_distinctive_terms_by_controversy",
                "top_distinctive_terms_by_subreddit", "notes"],
        "filter-checks": ["subreddit_counts"],
        "feature-checks": ["row_count", "flag_distributions", "sample"],
        "text-base-checks": ["notes", "avg_clean_text_length_by_subreddit"],
        "model-base-checks": ["notes", "label_distribution"],
        "models": ["notes", "split_counts", "class_weights", "model_metrics", "logreg_confusion_counts", "rf_confusion_counts", "logreg_feature_coefficients",
                   "rf_feature_importances", "confusion_summary"],
    }
    for job, names in expected.items():
        for name in names:
            parts = [p for p in Path(chain, job, name).iterdir() if p.name.startswith("part-")]
            assert len(parts) == 1 or name in cli.GROWING, (job, name)


def test_summary_files_keep_their_order(spark, chain):
    top = csv(spark, chain / "text/top_terms_by_subreddit", "subreddit string, token string, count long, rank int")
    assert [(s, r) for s, _, _, r in top] == [(s, r) for s in sorted(MEMBERS) for r in range(1, 21)]
    rated = csv(spark, chain / "time/controversy_by_subreddit", "s string, n long, f long, rate double")
    assert [r[3] for r in rated] == sorted((r[3] for r in rated), reverse=True)


def test_notes(chain):
    part = next(p for p in (chain / "subsets/subset_row_counts").iterdir() if p.name.startswith("part-"))
    lines = part.read_text().splitlines()
    assert [line.split(": ")[0] for line in lines] == ["all_df", "text_df", "user_df", "text_user_df"]


def read_notes(path) -> dict:
    part = next(p for p in path.iterdir() if p.name.startswith("part-"))
    return dict(line.split(": ") for line in part.read_text().splitlines())


def test_notes_of_tables_and_models(spark, chain):
    rows_of = {name: spark.read.parquet(f"{chain}/{name}").count() for name in ("features", "text-base", "model-base")}
    text, model = read_notes(chain / "text-base-checks/notes"), read_notes(chain / "model-base-checks/notes")
    assert int(text["feature_base_rows"]) == rows_of["features"] and int(text["text_base_rows"]) == rows_of["text-base"]
    assert int(text["valid_rows"]) == int(model["model_base_rows"]) == rows_of["model-base"]
    fitted = read_notes(chain / "models/notes")
    assert int(fitted["rows"]) == rows_of["model-base"] and int(fitted["rows_without_label"]) == 0
    assert 0.5 < float(fitted["Random Forest auc_roc"]) <= 1


def test_text_job_on_clean_text_gives_the_same(spark, chain, features):
    base = spark.read.parquet(f"{chain}/text-base")
    direct, stored = reports.text_report(features), reports.text_report(features, base)
    for name in direct:
        assert rows(direct[name]) == rows(stored[name]), name


def test_filter_writes_few_files(spark, chain):
    for month in (chain / "filter/yyyy=2024").iterdir():
        if month.is_dir():
            assert len([p for p in month.iterdir() if p.name.startswith("part-")]) == 1


@pytest.fixture(scope="module")
def features(spark, chain):
    return spark.read.parquet(f"{chain}/features")


def test_conservation(spark, chain, features):
    """Every breakdown adds up to the table it breaks down."""
    total, flagged = features.count(), features.agg(F.sum("controversiality")).first()[0]
    for name, frame in reports.time_report(features).items():
        sums = frame.agg(F.sum("total_comments"), F.sum("controversial_comments")).first()
        assert tuple(sums) == (total, flagged), name
    community = reports.community_report(features)
    with_user = subsets.subset(features, "user").count()
    for name in ("user_type_comment_summary", "subreddit_user_type_summary", "cross_community_over_time"):
        assert community[name].agg(F.sum("total_comments")).first()[0] == with_user, name
    n = len(MEMBERS)
    assert community["subreddit_pair_counts"].count() == n * (n - 1) // 2
    both = subsets.subset(features, "text_user").count()
    text = reports.text_report(features)
    for name in ("text_length_by_controversy", "text_length_by_subreddit"):
        assert text[name].agg(F.sum("total_comments")).first()[0] == both, name


def test_one_pass_reports_equal_direct_operators(spark, features):
    sizes = rows(reports.subset_report(features)["subset_row_counts"])
    assert sizes == rows(subsets.subset_row_counts(features))
    by_month = reports.time_report(features)["controversy_by_month"]
    assert rows(by_month) == rows(rates.rate_by(features, ["year", "month"]))
    user_rows = subsets.subset(features, "user")
    community = reports.community_report(features)
    assert rows(community["user_type_user_summary"]) == rows(users.user_type_user_summary(users.user_profile(user_rows)))
    pairs = users.community_pairs(users.user_community_pairs(user_rows))
    assert rows(community["subreddit_pair_counts"]) == rows(pairs)
    for kind in subsets.SUBSETS:
        direct = subsets.group_counts(subsets.subset(features, kind), "subreddit")
        assert rows(reports.subset_report(features)[f"{kind}_subreddit_counts"]) == rows(direct)


def test_nlp_report_equals_direct_operators(spark, chain):
    from colloquy.functions.text import explode_tokens
    from colloquy.operators.sentiment import comment_sentiment, sentiment_by

    base = spark.read.parquet(f"{chain}/text-base")
    report = reports.nlp_report(base, min_count=5)
    assert rows(report["sentiment_by_subreddit"]) == rows(sentiment_by(comment_sentiment(base), "subreddit"))
    counts = terms.term_counts(explode_tokens(base, ["controversiality"]), ["controversiality"])
    direct = terms.distinctive_terms(counts, "controversiality", 5)
    assert rows(report["top_distinctive_terms_by_controversy"]) == rows(direct)
    assert direct.count() == 40


def test_trips(spark, sf_dir, tmp_path):
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"), F.col("l_quantity").alias("trip_distance"),
        F.col("l_tax").alias("mta_tax"), F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"), F.col("l_linenumber").cast("double").alias("passenger_count"),
    )
    for month in (1, 2):
        part = items.filter((F.year("tpep_pickup_datetime") == 1997) & (F.month("tpep_pickup_datetime") == month))
        part.write.parquet(f"{tmp_path}/yyyy=1997/yellow_tripdata_1997-{month:02d}.parquet")
    cli.main(["trips", "--input", str(tmp_path), "--output", f"{tmp_path}/out", "--year", "1997", "--months", "1", "2"])
    daily = csv(spark, tmp_path / "out/daily_averages",
                "y int, m int, d int, n long, dist double, tax double, q double, tip double, p long")
    assert [r[:3] for r in daily] == sorted((r[:3] for r in daily), reverse=True)
    assert {r[1] for r in daily} == {1, 2}
    rollup = csv(spark, tmp_path / "out/rollup", "days long, total long, mean double, first string, last string")[0]
    assert rollup[0] == len(daily) and rollup[1] == sum(r[3] for r in daily)
