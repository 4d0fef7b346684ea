"""Running totals, last rows and last values along each key, with keys of all sizes."""

import random

import pytest
from pyspark.sql import functions as F

from colloquy.operators import running as r
from colloquy.staging import stage
from tests.conftest import rows

NAMES = ("total", "count", "before", "known")


def table(spark, sizes, seed=1):
    rng = random.Random(seed)
    made = [(key, rng.randrange(40) if rng.random() > 0.05 else None, i, rng.choice([None, 1, 2, 5])) for i, key in enumerate(k for k, n in sizes.items() for _ in range(n))]
    rng.shuffle(made)
    return made, spark.createDataFrame(made, "author string, at int, id int, score int")


def expected(made):
    out, state = [], {}
    for key, at, number, score in sorted(made, key=lambda x: (x[1] is not None, x[1] or 0, x[2])):
        total, count, before, known, first = state.get(key, (0, 0, None, None, True))
        known_now = score if score is not None else known
        out.append((key, at, number, score, total + (score or 0), count + 1, None if first else before, known_now))
        state[key] = (total + (score or 0), count + 1, score, known_now, False)
    return sorted(out, key=repr)


def run(df, slots):
    return r.running(
        df, "author", ("at", "id"), slots=slots,
        sums={"total": F.col("score"), "count": F.lit(1).cast("long")}, lags={"before": F.col("score")}, lasts={"known": F.col("score")},
    )


@pytest.mark.parametrize("sizes", [{"a": 300, "b": 40, None: 200, "c": 1}, {f"k{i}": 3 for i in range(50)}, {None: 30}, {}])
def test_equals_plain_python(spark, sizes):
    made, df = table(spark, sizes)
    for slots in (1, 4, 16):
        got = run(df, slots)
        assert got.columns == ["author", "at", "id", "score", *NAMES]
        assert rows(got) == expected(made)


def test_hot_key_covers_many_partitions(spark):
    """An author with a third of the rows is in no one task."""
    made, df = table(spark, {"hot": 4000, **{f"k{i}": 4 for i in range(2000)}})
    hot = r.hot_keys(df, "author", 16)
    assert [x[0] for x in hot.collect()] == ["hot"]
    placed = stage(df.join(F.broadcast(hot), F.col("author") == F.col("hot key"), "left_semi").repartitionByRange(16, "author", "at", "id"), "placed")
    counts = [x[1] for x in placed.groupBy(F.input_file_name()).count().collect()]
    assert len(counts) >= 12 and max(counts) < 3 * 4000 / 16
    assert rows(run(df, 16)) == expected(made)
