"""The model table joins narrow rows; bodies come last, from where comments have them."""

import functools

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks import registry, views
from colloquy.operators import model_base as mb
from tests.test_plan_shape import plan


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Documents with repeated and absent identifiers and texts, events with repeated and absent fields."""
    folder = str(tmp_path_factory.mktemp("odd"))
    documents = [(i, f"text  {i} of\tmany {'word ' * (i % 9)}") for i in range(40)]
    documents += [(3, "another third"), (3, "another third"), (4, None), (5, ""), (None, "nobody's"), (None, None)]
    spark.createDataFrame(documents, "doc_id long, text string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    n = F.col("n")
    events = spark.range(900).select((F.col("id") % 700).alias("n")).select(
        F.when(n % 97 != 1, n).alias("event_id"),
        F.expr("timestamp_ntz '2024-01-01 10:00:00' + make_interval(0, 0, 0, cast(n % 9 as int))").alias("ts"),
        F.when(n % 53 != 2, n % 31).alias("user_id"),
        F.when(n % 41 != 3, F.concat(F.lit("c"), (n % 4).cast("string"))).alias("event_type"),
        F.when(n % 37 != 4, n / 7).alias("value"),
        F.when(n % 29 != 5, F.concat(F.lit('{"k": '), (n * 13 % 100).cast("string"), F.lit("}"))).alias("props"),
    )
    events.write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_late_bodies_give_the_rows_of_early_ones(spark, odd_dir, nulls, limit):
    early = mb.model_base(views.features(spark, odd_dir, nulls), broadcast_limit=limit)
    late = mb.model_base(views.features(spark, odd_dir, nulls, True), bodies=views.bodies(spark, odd_dir, nulls), source=views.SOURCE, broadcast_limit=limit)
    assert late.schema == early.schema or late.dtypes == early.dtypes
    found = rows(early)
    assert len(found) > 400 and len({r[3] for r in found}) > 40
    assert rows(late) == found


def test_comments_are_the_same_with_their_source(spark, odd_dir):
    plain, source = views.comments(spark, odd_dir), views.comments(spark, odd_dir, source=True)
    assert source.columns == [*plain.columns, *views.SOURCE]
    assert rows(source.drop(*views.SOURCE)) == rows(plain)


@pytest.mark.parametrize("name", ["ml_model_base", "ml_model_base_nulls"])
def test_bodies_are_not_dealt_out_by_author(spark, sf_dir, monkeypatch, name):
    monkeypatch.setattr(mb, "attach_by_key", functools.partial(mb.attach_by_key, broadcast_limit=0))
    text = plan(registry.QUERIES[name](spark, sf_dir))
    assert "hashpartitioning(author" not in text
    # Texts and rows meet on the text's identifier; nothing else is shuffled with them.
    assert text.count("hashpartitioning(doc_id") == text.count("hashpartitioning(source_id") >= 1
    assert text.count("hashpartitioning(") == 2 * text.count("hashpartitioning(doc_id")


def test_tasks_of_the_join_follow_the_size_of_documents(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(views, "TASK_BYTES", 2048)
    assert views.comments(spark, sf_dir).rdd.getNumPartitions() > views.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
