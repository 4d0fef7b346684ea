"""As-of joins and sessions against plain Python, with keys that hold a third of the rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from colloquy.operators import timeline as t
from tests.conftest import rows


def made(seed, n=600, hot=0.4):
    rng = random.Random(seed)
    return [(i, None if rng.random() < 0.03 else "hot" if rng.random() < hot else f"k{rng.randrange(40)}", None if rng.random() < 0.03 else rng.randrange(200)) for i in range(n)]


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("slots", [2, 16])
def test_as_of_equals_search(spark, inclusive, slots):
    left, right = made(1), [(i, k, at, None if i % 9 == 0 else i * 10) for i, k, at in made(2, 300)]
    a = spark.createDataFrame(left, "id int, who string, at int")
    b = spark.createDataFrame(right, "rid int, owner string, since int, price int").withColumnRenamed("owner", "who")
    got = t.as_of(a, b, "who", "at", "since", {"found": "rid", "paid": "price"}, ("rid",), inclusive, slots)
    want = []
    for i, who, at in left:
        earlier = [] if who is None or at is None else [(since, rid, price) for rid, k, since, price in right if k == who and since is not None and (since <= at if inclusive else since < at)]
        last = max(earlier, key=lambda r: r[:2], default=(None, None, None))
        want.append((i, who, at, last[1], last[2]))
    assert rows(got) == sorted(want, key=repr)
    assert sum(r[3] is not None for r in want) > 300


def test_as_of_of_nothing(spark):
    a = spark.createDataFrame([(1, "x", 5)], "id int, who string, at int")
    b = spark.createDataFrame([], "rid int, who string, since int")
    assert rows(t.as_of(a, b, "who", "at", "since", {"found": "rid"})) == [(1, "x", 5, None)]
    assert t.as_of(a.limit(0), b, "who", "at", "since", {"found": "rid"}).count() == 0


@pytest.mark.parametrize("slots", ["2", "16"])
def test_sessions_equal_gaps_and_islands(spark, slots):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    events = [(i, rng.choice(["hot", "hot", f"k{rng.randrange(30)}", None]), None if i % 50 == 0 else start + timedelta(seconds=rng.randrange(40_000))) for i in range(800)]
    # A gap of exactly the limit does not end a session, a microsecond more does.
    events += [(900, "edge", start), (901, "edge", start + timedelta(seconds=60)), (902, "edge", start + timedelta(seconds=120, microseconds=1))]
    df = spark.createDataFrame(events, "id int, who string, at timestamp_ntz")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", slots)
    try:
        got = rows(t.sessions(df, "who", "at", ("id",), 60, {"ids": F.sum("id")}))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want, by = [], {}
    for i, who, at in sorted((e for e in events if e[1] and e[2]), key=lambda e: (e[1], e[2], e[0])):
        if who not in by or at - by[who][2] > timedelta(seconds=60):
            by[who] = [by[who][0] + 1 if who in by else 1, at, at, 0, 0]
            want.append((who, by[who]))
        by[who][2:] = [at, by[who][3] + 1, by[who][4] + i]
    assert got == sorted(((who, *s) for who, s in want), key=repr)
    assert [r[4] for r in got if r[0] == "edge"] == [2, 1]


def test_course_of_authors(spark):
    rng = random.Random(6)
    made_ = [(str(i), rng.choice(["[deleted]"] * 3 + [f"a{rng.randrange(50)}", None]), rng.randrange(300), rng.randrange(2)) for i in range(500)]
    got = rows(t.author_course(spark.createDataFrame(made_, "id string, author string, created_utc long, controversiality int")))
    want, state = [], {}
    for i, author, at, flag in sorted((m for m in made_ if m[1]), key=lambda m: (m[1], m[2], m[0])):
        n, last, flags = state.get(author, (0, None, 0))
        state[author] = (n + 1, at, flags + flag)
        want.append((i, author, n + 1, None if last is None else at - last, flags + flag))
    assert got == sorted(want, key=repr)
