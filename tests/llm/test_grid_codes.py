"""Nearest entries through the grid against all distances; codes of awkward vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import grid_codes as g

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("scale", [1, 3, 40, 5000, 1 << 24])
def test_nearest_equals_all_distances(scale):
    rng = np.random.default_rng(scale)
    book = rng.integers(-scale, scale + 1, (60, 5))
    book[7] = book[3]
    memo = g.GridMemo(book)
    for _ in range(2):  # the second time from memory
        rows = np.concatenate([rng.integers(-scale, scale + 1, (800, 5)), book, np.full((1, 5), scale * 3)])
        squares = ((rows[:, None, :] - book[None]) ** 2).sum(2)
        entry, distance = memo.nearest(rows)
        assert (entry == squares.argmin(1)).all() and (distance == squares.min(1)).all()


def test_cells_leave_few_entries_and_are_kept():
    rng = np.random.default_rng(1)
    book = rng.normal(0, 130, (256, 16)).astype(np.int64)
    rows = np.repeat(rng.normal(0, 130, (200, 16)).astype(np.int64), 5, axis=0)
    memo = g.GridMemo(book)
    memo.nearest(rows)
    assert 2 <= memo.bits <= 7 and len(memo.cells) <= 200
    assert np.mean([len(kept) for kept in memo.cells.values()]) < 128


def test_a_full_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(g, "MEMO_CELLS", 3)
    monkeypatch.setattr(g, "PAIRS_AT_ONCE", 7)
    test_nearest_equals_all_distances(40)


def brute(rows, parts=4, entries=256, rounds=4):
    """(identifier, label, vector) rows; all kept ones in plain Python."""
    kept = [(i, label, [min(max(math.floor(x * 1024), -g.LARGEST), g.LARGEST) for x in v]) for i, label, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max(len(v) for _, _, v in kept) // parts)
    kept = [(i, label, v + [0] * (parts * width - len(v))) for i, label, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[v[p * width : (p + 1) * width] for _, _, v in first] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * width : (p + 1) * width], c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for _, _, v in kept:
                of.setdefault(nearest(p, v)[1], []).append(v[p * width : (p + 1) * width])
            books[p] = [[sum(x) // len(of[e]) for x in zip(*of[e], strict=True)] if e in of else c for e, c in enumerate(books[p])]
    coded = [(i, label, [nearest(p, v) for p in range(parts)]) for i, label, v in kept]
    errors = {}
    for _, label, found in coded:
        errors[label] = errors.get(label, 0) + sum(d for d, _ in found)
    return sorted(((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), errors[label], g.digest(np.array(books))) for i, label, found in coded), key=repr)


def awkward():
    rng = np.random.default_rng(3)
    rows = [(i, i % 4 if i % 5 else None, [float(x) for x in rng.normal(0, 0.2, 9)]) for i in range(330)]
    rows += [(400, 1, None), (401, 1, []), (402, 1, [0.1, None]), (403, 2, [NAN] * 9), (404, 2, [INF] + [0.0] * 8), (405, None, [0.5, -0.25])]
    rows += [(None, 3, [0.1] * 9), (7, 3, rows[7][2]), (7, 3, rows[7][2]), (500, 1, [1e30] * 9), (501, 1, [-1e30] * 9)]
    return rows


def test_codes_equal_plain_python(spark):
    schema = "vec_id long, label int, embedding array<double>"
    rows = awkward()
    df = spark.createDataFrame(rows, schema).withColumn("code", F.lit("clash")).withColumn("error", F.lit(0))
    assert sorted(map(tuple, g.compress(df).collect()), key=repr) == brute(rows)
    few = rows[:40]
    for parts in (1, 5):
        got = g.compress(spark.createDataFrame(few, schema).repartition(parts)).collect()
        assert sorted(map(tuple, got), key=repr) == brute(few)
    assert g.compress(spark.createDataFrame([], schema)).count() == 0
    assert g.compress(spark.createDataFrame([(1, 1, None)], schema)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
