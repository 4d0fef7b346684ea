"""Tables stored by key, by period, and as sketches."""

import random
from pathlib import Path

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from checks import registry, views
from colloquy.operators import sketches, terms, users
from colloquy.plans import increments
from colloquy.sources import bucketed
from colloquy.staging import stage
from tests.conftest import rows
from tests.test_plan_shape import exchanges, plan


def test_tables_by_author_meet_without_a_shuffle(spark, sf_dir):
    comments, types = registry.stored_users(spark, sf_dir)
    joined = comments.join(types.hint("merge"), "author")
    text = plan(joined)
    assert "SortMergeJoin" in text and exchanges(text) == 0 and "Sort [" not in text
    assert exchanges(plan(users.user_types(comments))) == 0
    assert exchanges(plan(users.author_activity(comments))) == 0
    # Tables that were not stored so do shuffle.
    plain = spark.createDataFrame(comments.collect(), comments.schema)
    assert exchanges(plan(plain.join(types.hint("merge"), "author"))) > 0
    assert joined.count() == comments.count()


def test_a_stored_table_is_opened_by_another_name(spark, tmp_path):
    df = spark.createDataFrame([(i, f"a{i % 7}") for i in range(100)], "id int, author string")
    bucketed.write_by_key(df, "written_by_author", str(tmp_path / "t"), "author", 4)
    again = bucketed.open_by_key(spark, "id int, author string", "opened_by_author", str(tmp_path / "t"), "author", 4)
    assert exchanges(plan(again.groupBy("author").count())) == 0
    assert rows(again.select("id", "author")) == rows(df)


def test_a_delivery_replaces_its_periods_alone(spark, sf_dir, tmp_path):
    raw = views.comments(spark, sf_dir)
    day = F.dayofmonth(F.timestamp_seconds("created_utc"))
    features, activity = str(tmp_path / "features"), str(tmp_path / "activity")
    periods = ("year", "month", "day")
    increments.add_comments(spark, raw.filter(day <= 10), features, activity, periods)
    first = rows(increments.total_activity(spark, activity))
    assert first == rows(users.author_activity(views.features(spark, sf_dir).filter("day <= 10 and is_deleted_author = 0")))
    # Sent again, and a wrong delivery put right.
    increments.add_comments(spark, raw.filter(day.between(3, 5)), features, activity, periods)
    assert rows(increments.total_activity(spark, activity)) == first
    increments.add_comments(spark, raw.filter(day == 11).withColumn("score", F.lit(999)), features, activity, periods)
    increments.add_comments(spark, raw.filter(day >= 11), features, activity, periods)
    whole = views.features(spark, sf_dir)
    assert rows(increments.total_activity(spark, activity)) == rows(users.author_activity(whole.filter("is_deleted_author = 0")))
    assert spark.read.parquet(features).count() == whole.count()


def test_sketches_unite_like_sets(spark):
    rng = random.Random(5)
    made = [(f"c{rng.randrange(4)}", rng.randrange(6), f"a{rng.randrange(9000)}" if rng.random() > 0.1 else None) for _ in range(30_000)]
    df = spark.createDataFrame(made, "community string, month int, author string")
    stored = sketches.distinct_sketches(df, "author", ["community", "month"])
    for dims in (["community"], ["month"], []):
        exact = {tuple(r)[:-1]: tuple(r)[-1] for r in df.groupBy(*dims).agg(F.count_distinct("author")).collect()}
        got = {tuple(r)[:-1]: tuple(r)[-1] for r in sketches.estimate_by(stored, dims).collect()}
        assert set(got) == set(exact)
        assert all(abs(got[k] - exact[k]) <= 4 * sketches.ERROR * exact[k] for k in exact)
    # Uniting what is united already changes nothing.
    by_community = stored.groupBy("community").agg(F.hll_union_agg("sketch").alias("sketch"))
    assert rows(sketches.estimate_by(by_community, [])) == rows(sketches.estimate_by(stored, []))


def test_all_grains_from_one_expansion(spark):
    tokens = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), (None, "x"), (None, "z")], "g string, token string")
    grains = terms.term_grains(tokens, "g")
    text = plan(grains)
    assert exchanges(text) == 1 and text.count("(1) ") and len([line for line in text.splitlines() if line.startswith("(") and " Expand" in line]) == 1
    assert rows(grains.filter("grain = 'all'")) == [("all", None, None, 6)]
    assert rows(grains.filter("grain = 'group'")) == sorted([("group", "a", None, 3), ("group", "b", None, 1), ("group", None, None, 2)], key=repr)
    assert rows(grains.filter("grain = 'term'")) == [("term", None, "x", 4), ("term", None, "y", 1), ("term", None, "z", 1)]
    assert grains.filter("grain = 'group and term'").count() == 5


def test_grains_expand_counts_not_terms(spark):
    tokens = spark.createDataFrame([("a", "x")] * 50 + [(None, "x")], "g string, token string")
    grains = terms.term_grains(tokens, "g")
    assert all("/term-counts-" in file for file in grains.inputFiles()) and grains.inputFiles()
    assert rows(grains.filter("grain = 'group and term'")) == sorted([("group and term", "a", "x", 50), ("group and term", None, "x", 1)], key=repr)
    assert rows(grains.filter("grain in ('term', 'all')")) == [("all", None, None, 51), ("term", None, "x", 51)]
    assert rows(terms.term_grains(tokens.limit(0), "g")) == []


def test_periods_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """A task keeps a file open for each period; the setting holds for that write alone."""
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *args: (seen.append(int(spark.conf.get(key))), write(self, *args)))
    df = spark.range(200).select("id", F.lit(2020).alias("year"), (F.col("id") % 12).cast("int").alias("month"))
    before = spark.conf.get(key)
    increments.replace_periods(df, str(tmp_path / "periods"))
    assert seen == [increments.OPEN_FILES] and spark.conf.get(key) == before
    assert rows(spark.read.parquet(str(tmp_path / "periods")).select("id", "year", "month")) == rows(df)


def test_written_texts_are_packed(spark, tmp_path):
    words = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(80)), lambda i: F.substring(F.md5((F.col("id") * i).cast("string")), 1, 3)), " ")
    df = spark.range(3000).select("id", words.alias("body"), F.lit(2020).alias("year"), F.lit(1).alias("month"))
    size = lambda path: sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))
    df.write.option("compression", "snappy").parquet(str(tmp_path / "plain"))
    increments.replace_periods(df, str(tmp_path / "periods"))
    staged = stage(df, "texts").inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert max(size(tmp_path / "periods"), size(staged)) < 0.8 * size(tmp_path / "plain")
