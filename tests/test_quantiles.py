"""Exact quantiles by narrowing histograms, against sorted lists."""

import math
import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import quantiles as q
from colloquy.staging import stage
from tests.conftest import rows
from tests.test_plan_shape import plan

INF, NAN = float("inf"), float("nan")
ODD = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1023, 1.0, 2.0, 4.0, 8.0, 1 - 2**-53, 1 + 2**-52, 1.7976931348623157e308, -1.7976931348623157e308, INF, -INF, 0.1, 1e-300, -3.5, 1023.9999999999999, 1024.0]


def test_codes_keep_the_order(spark):
    rng = random.Random(1)
    values = sorted({*ODD, *(rng.uniform(-1, 1) * 10 ** rng.randrange(-308, 308) for _ in range(3000)), *(2.0**e for e in range(-1074, 1024))})
    df = spark.createDataFrame([(v,) for v in [*values, NAN]], "v double")
    codes = {r.v: r.code for r in df.select("v", q.order_code(F.col("v"), "double").alias("code")).collect() if r.v == r.v}
    nan = df.filter(F.isnan("v")).select(q.order_code(F.col("v"), "double")).first()[0]
    in_order = [codes[v] for v in values] + [nan]
    assert all(a < b for a, b in zip(in_order, in_order[1:], strict=False))


def expected(made, shares):
    groups = {}
    for group, value in made:
        groups.setdefault(group, []).append(value)
    out = []
    for group, values in groups.items():
        known = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))
        out.append((group, *[known[max(-(-a * len(known) // b), 1) - 1] + 0.0 if known else None for a, b in shares.values()]))
    return sorted(out, key=repr)


SHARES = {"least": (0, 1), "median": (1, 2), "q95": (95, 100), "most": (1, 1)}


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_equals_sorted_lists(spark, parts):
    rng = random.Random(2)
    made = [(rng.choice(["a", "b", None]), rng.choice([*ODD, rng.gauss(0, 1), rng.expovariate(1e-9), None])) for _ in range(3000)]
    made += [("none", None), ("one", -7.25), ("same", 3.0), ("same", 3.0), ("nan", NAN), ("nan", 1.0)]
    df = spark.createDataFrame(made, "g string, v double").repartition(parts)
    got = q.quantiles(df, ["g"], "v", SHARES)
    assert got.columns == ["g", *SHARES]
    plus = sorted((tuple(x + 0.0 if isinstance(x, float) else x for x in r) for r in got.collect()), key=repr)
    assert list(map(repr, plus)) == list(map(repr, expected(made, SHARES)))  # NaN equals nothing


def test_whole_numbers_of_any_size(spark):
    values = [-(2**63), 2**63 - 1, 0, -1, 2**53 + 1, 2**53, 2**53 + 2]
    df = spark.createDataFrame([(1, v) for v in values], "g int, v long")
    wanted = {f"q{i}": (i + 1, len(values)) for i in range(len(values))}
    assert list(q.quantiles(df, ["g"], "v", wanted).first())[1:] == sorted(values)
    assert q.quantiles(df.limit(0), ["g"], "v", wanted).count() == 0


def test_several_columns_name_a_group(spark):
    df = spark.createDataFrame([(i % 2, None if i % 3 else "x", i) for i in range(120)], "a int, b string, v int")
    got = q.quantiles(df, ["a", "b"], "v", {"m": (1, 2)})
    want = [(a, b, sorted(v)[(len(v) + 1) // 2 - 1]) for (a, b) in [(0, None), (0, "x"), (1, None), (1, "x")] for v in [[i for i in range(120) if i % 2 == a and (i % 3 == 0) == (b == "x")]]]
    assert rows(got) == sorted(want, key=repr)


def test_cells_are_shuffled_not_rows(spark):
    """All rows in one group, all values different: what a round keeps of them is a bounded histogram."""
    known = spark.range(200_000).select(F.lit(1).alias("of g"), F.rand(3).alias("value")).withColumn("code", q.order_code(F.col("value"), "double"))
    known = stage(known.withColumns({"group": F.xxhash64("of g"), "at": F.monotonically_increasing_id()}), "known")
    state = known.groupBy("group", "of g").agg(F.count("*").alias("rows"), F.min("code").alias("low"), F.max("code").alias("high"), F.min("value").alias("found"))
    state = stage(state.withColumns({"name": F.lit("m"), "rank": F.lit(100_000).cast("long")}), "state")
    narrowed = q._narrowed(known, state, ["of g"])
    text = plan(narrowed)
    # The window and the shuffle see partial counts by cell.
    assert text.index("Window") < text.index("HashAggregate") < text.index("Scan parquet")
    bounds = state.select("low", "high", q._shift(F.col("low"), F.col("high")).alias("bits")).first()
    assert (bounds.high >> bounds.bits) - (bounds.low >> bounds.bits) <= 2**q.BITS
    assert (bounds.high >> (bounds.bits - 1)) - (bounds.low >> (bounds.bits - 1)) > 2 ** (q.BITS - 2)
