"""Hot keys: the salted join, pre-aggregation, and whole results."""

import itertools

import pytest
from conftest import rows
from pyspark.sql import functions as F

from colloquy.operators import users
from colloquy.operators.keyed_join import attach_by_key
from colloquy.staging import stage
from tests.test_plan_shape import plan


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows belong to one author, a sixth to nobody."""
    n = F.col("id")
    author = F.when(n % 3 == 0, "hot").when(n % 6 != 1, F.concat(F.lit("u"), (n % 997).cast("string")))
    return stage(
        spark.range(30_000).select(
            "id", author.alias("author"), F.concat(F.lit("c"), ((n * 7) % 11).cast("string")).alias("subreddit")
        ),
        "fact",
    )


@pytest.fixture(scope="module")
def dim(spark, fact):
    return stage(fact.groupBy("author").agg(F.count("*").alias("n"), F.max("id").alias("top")), "dim")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_every_strategy_gives_the_plain_join(fact, dim, how, limit):
    got = attach_by_key(fact, dim, "author", "n", how, broadcast_limit=limit, slots=16)
    plain = fact.join(dim, "author", how)
    assert got.columns == plain.columns
    assert got.count() == plain.count()
    assert got.exceptAll(plain).isEmpty()


def test_an_even_table_is_joined_without_salts(spark, capsys):
    fact = spark.range(1000).select("id", (F.col("id") % 500).alias("author"))
    dim = fact.groupBy("author").agg(F.count("*").alias("n"))
    attach_by_key(fact, dim, "author", "n", broadcast_limit=0, slots=16).explain()
    assert "_salt" not in capsys.readouterr().out


def test_a_hot_key_spreads_over_its_share_of_the_slots(spark, fact, dim):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = attach_by_key(fact, dim, "author", "n", "left", broadcast_limit=0, slots=64)
        sizes = joined.groupBy(F.spark_partition_id(), F.col("author")).count()
        largest = {r.author: r.most for r in sizes.groupBy("author").agg(F.max("count").alias("most")).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Unsalted, each would sit in one of the 8 partitions.
    assert largest["hot"] < 10_000 / 3
    assert largest[None] < 5_000 / 3


def test_salted_types_and_features_are_whole(spark, fact):
    typed = users.with_user_type(fact, broadcast_limit=0, slots=32)
    plain = fact.join(users.user_types(fact).select("author", "user_type"), "author")
    assert typed.count() == plain.count() == 25_000
    assert typed.select(plain.columns).exceptAll(plain).isEmpty()


def test_pairs_equal_brute_force(spark):
    """Many communities for one author, the same set for many, and lone ones."""
    member = {"bot": {f"c{i:02}" for i in range(40)}}
    member |= {f"twin{i}": {"c01", "c02", "c03"} for i in range(300)}
    member |= {f"u{i}": {f"c{i % 40:02}", f"c{(i * i) % 40:02}"} for i in range(200)}
    want = {}
    for names in member.values():
        for pair in itertools.combinations(sorted(names), 2):
            want[pair] = want.get(pair, 0) + 1
    data = [(a, c) for a, names in member.items() for c in names]
    got = users.community_pairs(spark.createDataFrame(data, "author string, subreddit string"))
    assert {(a, b): n for a, b, n in rows(got)} == want


def test_staged_tables_go_to_the_configured_folder(spark, fact):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in fact.inputFiles())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_wide_rows_are_not_sorted(spark, fact, dim, how):
    """Rows with texts meet a hashed table of keys, salted or not."""
    got = attach_by_key(fact, dim, "author", "n", how, broadcast_limit=0, slots=16, wide=True)
    text = plan(got)
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text
    assert rows(got) == rows(fact.join(dim, "author", how))
    even = spark.range(1000).select("id", (F.col("id") % 500).alias("author"))
    few = stage(even.groupBy("author").agg(F.count("*").alias("n")), "even")
    assert "ShuffledHashJoin" in plan(attach_by_key(even, few, "author", "n", broadcast_limit=0, slots=4, wide=True))
