"""Vector code compression: product quantisation with memoised grid cells.

A vector is cut into equal parts; each part is coded by the nearest entry of that part's
codebook. The nearest entry is looked up through a grid: a part falls into a coarse cell (its components
shifted right), and for a cell the entries are cached that are not dominated across its box: an
entry goes whose least distance to the box exceeds the least of the entries' greatest
distances. Only the cached entries are then evaluated exactly, for all parts in that cell.
Coarse cells are as wide as the entries are apart, so few entries are left in each. The cache of a task is emptied
when it holds ``MEMO_CELLS`` cells; that costs time, not results.

Codebooks are fitted to all vectors: tasks add up the parts of each entry, the sums of tasks are
added in Spark, and the driver holds the codebooks alone. All arithmetic is on whole numbers.

Rows: a vector that is null, empty, or holds a null or non-finite component is dropped. Components are
floor(1024 x), at most 2 ** 24 in size; larger ones count as that. Vectors shorter than the longest, and parts
that do not come out even, are filled up with zeros. The first entries are the vectors of the smallest identifiers, null
last, ties by components; with fewer vectors than entries there are as many entries as vectors. Repeated rows are coded alike. An
empty table gives no rows. Columns but the identifier, the vector and the label are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import batch_rows
from colloquy.operators.keyed_join import attach_by_key
from colloquy.staging import stage

SCALE, LARGEST = 1024, 1 << 24
PARTS, ENTRIES, ROUNDS = 4, 256, 4
MEMO_CELLS = 50_000
# Rows worked on at once, and (part, entry) pairs evaluated at once.
ROWS_AT_ONCE, PAIRS_AT_ONCE = 4096, 1 << 18


class GridMemo:
    """Nearest entries of one codebook (entries x components, whole numbers)."""

    def __init__(self, book: np.ndarray):
        self.book = book.astype(np.int64)
        self.bits = _cell_bits(self.book)
        self.cells: dict[bytes, np.ndarray] = {}

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each row and its squared distance; of equally near entries the first."""
        cells, owner = np.unique(rows >> self.bits, axis=0, return_inverse=True)
        kept = self._kept(cells)
        sizes = np.array([len(k) for k in kept])
        spans = sizes[owner.ravel()]
        entry, distance = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        until = np.cumsum(spans)
        start = 0
        while start < len(rows):
            end = max(start + 1, int(np.searchsorted(until, until[start] - spans[start] + PAIRS_AT_ONCE, side="right")))
            mine = owner.ravel()[start:end]
            tried = np.concatenate([kept[c] for c in mine])
            lines = np.repeat(rows[start:end], spans[start:end], axis=0) - self.book[tried]
            squares = np.einsum("ij,ij->i", lines, lines)
            first = until[start:end] - spans[start:end] - (until[start] - spans[start])
            least = np.minimum.reduceat(squares, first)
            # Entries of a cell ascend: the first that is as near is the one of the lowest index.
            hits = np.flatnonzero(squares == np.repeat(least, spans[start:end]))
            entry[start:end] = tried[hits[np.searchsorted(hits, first)]]
            distance[start:end] = least
            start = end
        return entry, distance

    def _kept(self, cells: np.ndarray) -> list[np.ndarray]:
        """Entries that are not dominated, of each cell."""
        names = [cell.tobytes() for cell in cells]
        if len(self.cells) > MEMO_CELLS:
            self.cells.clear()
        new = [i for i, name in enumerate(names) if name not in self.cells]
        for at in range(0, len(new), 1024):
            some = new[at : at + 1024]
            near, far = self._bounds(cells[some])
            open_ = near <= far.min(1)[:, None]
            for i, mask in zip(some, open_, strict=True):
                self.cells[names[i]] = np.flatnonzero(mask)
        return [self.cells[name] for name in names]

    def _bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared distance of each entry to each cell's box, summed up by component:
        cells that agree in one share its share."""
        near = np.zeros((len(cells), len(self.book)), np.int64)
        far = np.zeros_like(near)
        for j in range(cells.shape[1]):
            values, which = np.unique(cells[:, j], return_inverse=True)
            low = (values << self.bits)[:, None]
            high = low + (1 << self.bits) - 1
            entries = self.book[None, :, j]
            near += (np.maximum(np.maximum(low - entries, entries - high), 0) ** 2)[which]
            far += (np.maximum(entries - low, high - entries) ** 2)[which]
        return near, far


def _cell_bits(book: np.ndarray) -> int:
    """Cells so wide that their diagonal is half of what entries are apart (in the median)."""
    squares = (book.astype(np.float64) ** 2).sum(1)
    apart = squares[:, None] + squares[None, :] - 2.0 * (book.astype(np.float64) @ book.T.astype(np.float64))
    np.fill_diagonal(apart, np.inf)
    spacing = float(np.sqrt(max(np.median(apart.min(1)), 0.0))) if len(book) > 1 else 0.0
    edge = spacing / (2 * max(book.shape[1], 1) ** 0.5)
    return int(np.log2(edge)) if 1 <= edge < np.inf else 0


def whole_numbers(vectors: DataFrame, vector: str, key: str, label: str) -> DataFrame:
    """Rows that are kept, with components as whole numbers in ``v``."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def scaled(x: Column) -> Column:
        return F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int")

    kept = vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, finite))
    return kept.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.transform(vector, scaled).alias("v"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Rows of a batch, filled up with zeros to ``width``."""
    column = batch.column(batch.schema.get_field_index("v"))
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _sums(books: np.ndarray):
    """Per task: rows, and the sum of the parts, of each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        memos = [GridMemo(book) for book in books]
        count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            rows = _matrix(batch, parts * width)
            for p, memo in enumerate(memos):
                part = rows[:, p * width : (p + 1) * width]
                entry, _ = memo.nearest(part)
                count[p] += np.bincount(entry, minlength=entries)
                np.add.at(total[p], entry, part)
        at = np.argwhere(count > 0)
        columns = [pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()), pa.array(count[count > 0])]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(total[count > 0]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    return run


def _codes(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, width = books.shape
        memos = [GridMemo(book) for book in books]
        for batch in batches:
            rows = _matrix(batch, parts * width)
            found = [memo.nearest(rows[:, p * width : (p + 1) * width]) for p, memo in enumerate(memos)]
            codes = np.stack([entry for entry, _ in found], 1).astype(np.uint8)
            error = sum(distance for _, distance in found)
            columns = [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return run


def fit(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (parts x entries x components) after ``rounds`` over all rows of ``whole``, a
    written table of :func:`whole_numbers`; None if it is empty."""
    if not 0 < entries <= 256:
        raise ValueError(f"entries: {entries}")
    longest = whole.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return None
    width = -(-longest // parts)
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    filled = np.zeros((len(first), parts * width), np.int64)
    for line, row in zip(filled, first, strict=True):
        line[: len(row.v)] = row.v
    books = filled.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    sums = [F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)]
    with batch_rows(whole.sparkSession, ROWS_AT_ONCE):
        for _ in range(rounds):
            added = whole.select("v").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
            for part, entry, n, *total in added.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
                books[part, entry] = [t // n for t in total]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """``vec_id``, ``code`` (two hexadecimal digits a part), ``error``, ``label_error`` (errors added up by equal
    labels, null being one) and ``codebooks_sha256``, one row per vector that is kept."""
    spark = vectors.sparkSession
    whole = stage(whole_numbers(vectors, vector, key, label), "whole-numbers")
    books = fit(whole)
    if books is None:
        books = np.zeros((PARTS, 0, 0), np.int64)
    schema = f"vec_id {whole.schema['vec_id'].dataType.simpleString()}, label {whole.schema['label'].dataType.simpleString()}, code string, error long"
    with batch_rows(spark, ROWS_AT_ONCE):
        coded = whole.select("vec_id", "label", "v").mapInArrow(_codes(books), schema)
        # A name for each label that is never null, for the join.
        name = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
        coded = stage(coded.withColumn("_label", name), "codes")
    errors = stage(coded.groupBy("_label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows")), "label-errors")
    joined = attach_by_key(coded, errors, "_label", "_rows", spread_by=("vec_id", "code"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
