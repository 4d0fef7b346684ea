"""Interval joins against all pairs, and their plan."""

import random

import pytest

from colloquy.operators.intervals import interval_join, levels_of
from colloquy.staging import stage
from tests.conftest import rows
from tests.test_plan_shape import plan


def spans(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randrange(-500, 5000)
        length = rng.choice([0, 0, 1, 2, 3, 7, 8, 50, 300, rng.randrange(4000)])
        out.append((i, rng.choice(["a", "a", "b", None]), None if rng.random() < 0.03 else start, None if rng.random() < 0.03 else start + (length if rng.random() > 0.03 else -5)))
    return out


SCHEMA = "id int, k string, s int, e int"


@pytest.mark.parametrize("on", [["k"], []])
def test_each_overlap_once(spark, on):
    a, b = spans(1, 250), spans(2, 250)
    got = interval_join(spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA), ("s", "e"), ("s", "e"), on)
    fine = lambda x: None not in (x[2], x[3]) and x[2] <= x[3]
    want = [(x[0], y[0]) for x in a for y in b if fine(x) and fine(y) and x[2] <= y[3] and y[2] <= x[3] and (not on or x[1] is not None and x[1] == y[1])]
    pairs = [tuple(r) for r in got.select("left.id", "right.id").collect()]
    assert sorted(pairs) == sorted(want) and len(pairs) == len(set(pairs)) > 1000


def test_far_apart_lengths_make_few_copies(spark):
    """One interval a million times as long as the others is copied by level, not by their width."""
    short = [(i, "k", i * 10, i * 10 + 3) for i in range(2000)]
    long = [(9999, "k", 0, 10_000_000)]
    a, b = spark.createDataFrame(short, SCHEMA), spark.createDataFrame(short[:50] + long, SCHEMA)
    got = interval_join(a, b, ("s", "e"), ("s", "e"), ["k"])
    assert got.count() == 50 + 2000
    assert len(levels_of(b, "s", "e")) == 2


def test_no_nested_loops(spark):
    a = spark.createDataFrame(spans(1, 20), SCHEMA)
    for on in (["k"], []):
        text = plan(interval_join(a, a, ("s", "e"), ("s", "e"), on))
        assert "NestedLoop" not in text and "Cartesian" not in text and "Join" in text
    assert rows(interval_join(a.limit(0), a, ("s", "e"), ("s", "e"))) == []


def test_copies_are_not_broadcast(spark):
    """Sizes that Spark estimates from files say nothing of the copies."""
    a = stage(spark.createDataFrame(spans(1, 20), SCHEMA), "few")
    for on in (["k"], []):
        assert "BroadcastHashJoin" not in plan(interval_join(a, a, ("s", "e"), ("s", "e"), on))
