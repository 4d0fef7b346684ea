"""Spelling variants of words: k-d trees over letter counts.

Words are counted over the whole corpus, and each common one looks for words that differ by one
letter added, left out or replaced. One replaced letter changes the vector of letter counts by two
(one up, one down), one more letter by one. So words of a length search the tree of their own
length for vectors at L1 distance two, and the tree of the next length at distance one. A branch is
pruned when its box is farther away; what is left is verified letter by letter.

The trees are distributed. The upper levels of a length's tree, split at medians of a bounded sample
of words (``SAMPLE``), go to all tasks; each of its leaves is a group of words that one task
holds. A word goes to its home leaf, and as a query to all leaves whose boxes are near enough:
those that moving two letters can reach. Inside a leaf a task builds the lower levels with tight boxes.
The sample places splits only; all words are in a leaf, and every leaf near enough is searched.

A variant is grouped with the near word that is far more common (``RATIO`` times at least), and
with what that one is grouped with; forms are followed by pointer doubling.

Rows: a null text has no words, a null identifier counts as empty in the checksum. Repeated rows count again. Of
near words equally common the first in code-point order is taken. An empty table, or one without common words, gives no
rows. Columns but the identifier and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import ascii_lower, batch_rows
from colloquy.staging import stage

LETTERS = r"A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
# One run in so many, by a checksum, loses a letter.
SLIP = 199
# Words from whose letter counts the upper levels are split, about; the least for a leaf.
SAMPLE, LEAST_SAMPLE = 65_536, 12
# Letters of the words of a leaf, and words of a bucket of the lower levels.
LEAF_LETTERS, BUCKET = 32_768, 24
CELLS_AT_ONCE = 1 << 22
# What a word is in a leaf: at home, a visitor of its own length, one letter shorter.
HOME, VISITOR, SHORTER = 0, 1, 2
DIMENSIONS = 26 + 64
FOUND = "word string, near long, best_n long, best string"


def word_counts(docs: DataFrame, text: str = "text", key: str = "doc_id", least_length: int = MIN_LENGTH, least_count: int = MIN_COUNT) -> DataFrame:
    """``word``, ``n``: runs of letters in lower case (A-Z only), some with a letter less, that are long and common enough."""
    # A run never gets longer: shorter ones are left out before they are told apart.
    runs = F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0)))
    found = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), runs.alias("run"))
    found = found.select("key", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(ascii_lower(F.col("run"))).alias("run"))
    mark = F.crc32(F.concat_ws(":", "key", "run").cast("binary"))
    found = found.select("run", mark.alias("mark")).select("run", "mark", (F.col("mark") % F.length("run")).cast("int").alias("at"))
    shorter = F.concat(F.col("run").substr(F.lit(1), F.col("at")), F.col("run").substr(F.col("at") + 2, F.length("run")))
    words = found.select(F.when(F.col("mark") % SLIP == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") >= least_count)


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all words in a row, and their numbers of letters."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.array([len(w) for w in words], np.int64)


def count_letters(words: list[str]) -> np.ndarray:
    """Vectors of letter counts: a to z, then the 64 letters from U+00C0 on."""
    points, sizes = letters_of(words)
    place = np.where(points < 128, points.astype(np.int64) - ord("a"), points.astype(np.int64) - 0xC0 + 26)
    owner = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(owner * DIMENSIONS + place, minlength=len(words) * DIMENSIONS).reshape(len(words), DIMENSIONS)
    return counts.astype(np.int16 if sizes.max(initial=0) < 1 << 14 else np.int64)


def _split(vectors: np.ndarray) -> tuple[int, int] | None:
    """The letter with the widest spread and the count at which its words fall into halves: those up to it
    and those above. None if all vectors are equal."""
    low, high = vectors.min(0), vectors.max(0)
    if (low == high).all():
        return None
    axis = int(vectors.var(0).argmax())
    at = int(np.median(vectors[:, axis]))
    return axis, min(at, int(high[axis]) - 1)


def upper_levels(vectors: np.ndarray, leaves: int) -> tuple | int:
    """Splits as nested (letter, count, below, above); leaves are numbered from 0."""
    numbers = iter(range(leaves * 4 + 4))
    least = max(len(vectors) / max(leaves, 1), LEAST_SAMPLE)

    def grow(some: np.ndarray) -> tuple | int:
        cut = _split(some) if len(some) >= 2 * least else None
        if cut is None:
            return next(numbers)
        below = some[:, cut[0]] <= cut[1]
        return (*cut, grow(some[below]), grow(some[~below]))

    return grow(vectors)


def route(tree: tuple | int, vectors: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and the leaves whose boxes they are within ``radius`` of, and whether it is the row's home."""
    found: list[tuple[np.ndarray, int, np.ndarray]] = []

    def visit(node: tuple | int, rows: np.ndarray, away: dict[int, np.ndarray], distance: np.ndarray) -> None:
        near = distance <= radius
        if not near.any():
            return
        rows, distance, away = rows[near], distance[near], {axis: far[near] for axis, far in away.items()}
        if not isinstance(node, tuple):
            found.append((rows, node, distance == 0))
            return
        axis, at, below, above = node
        value, before = vectors[rows, axis].astype(np.int64), away.get(axis, 0)
        for child, outside in ((below, value - at), (above, at + 1 - value)):
            far = np.maximum(np.maximum(outside, 0), before)
            visit(child, rows, away | {axis: far}, distance - before + far)

    visit(tree, np.arange(len(vectors)), {}, np.zeros(len(vectors), np.int64))
    rows = np.concatenate([r for r, _, _ in found] or [np.empty(0, np.int64)])
    leaves = np.concatenate([np.full(len(r), leaf) for r, leaf, _ in found] or [np.empty(0, np.int64)])
    return rows, leaves, np.concatenate([home for _, _, home in found] or [np.empty(0, bool)])


def within(points: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) pairs at L1 distance ``radius`` exactly, by a k-d tree over the points."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    used = (points.max(0, initial=0) > 0) | (queries.max(0, initial=0) > 0)
    points, queries = np.ascontiguousarray(points[:, used]), np.ascontiguousarray(queries[:, used])

    def visit(mine: np.ndarray, asking: np.ndarray) -> None:
        vectors, wanted = points[mine], queries[asking]
        beyond = np.maximum(vectors.min(0) - wanted, 0) + np.maximum(wanted - vectors.max(0), 0)
        asking = asking[beyond.sum(1) <= radius]
        if not len(asking):
            return
        cut = _split(vectors) if len(mine) > BUCKET else None
        if cut is not None:
            below = vectors[:, cut[0]] <= cut[1]
            visit(mine[below], asking)
            visit(mine[~below], asking)
            return
        step = max(1, CELLS_AT_ONCE // max(vectors.size, 1))
        for at in range(0, len(asking), step):
            some = asking[at : at + step]
            apart = np.abs(queries[some][:, None, :] - vectors[None, :, :]).sum(2)
            q, p = np.nonzero(apart == radius)
            found.append((some[q], mine[p]))

    if len(points) and len(queries):
        visit(np.arange(len(points)), np.arange(len(queries)))
    return tuple(np.concatenate([pair[i] for pair in found] or [np.empty(0, np.int64)]) for i in (0, 1))


def _rows_of(words: list[str], length: int) -> np.ndarray:
    return letters_of(words)[0].reshape(len(words), length)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of letters of equal length: whether they differ in one place."""
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether a row of ``b`` is that of ``a`` with one letter more: what they share at the start and
    at the end covers ``a``."""
    head = np.cumprod(a == b[:, :-1], axis=1).sum(1)
    tail = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= a.shape[1]


def _verified(check, a: np.ndarray, b: np.ndarray, q: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = max(1, CELLS_AT_ONCE // max(b.shape[1], 1))
    true = [check(a[q[at : at + step]], b[p[at : at + step]]) for at in range(0, len(q), step)]
    keep = np.concatenate(true or [np.empty(0, bool)])
    return q[keep], p[keep]


def _best(asking: list[str], mine: np.ndarray, others: list[str], theirs: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """Per word with near words: how many, and the most common one."""
    rank = np.empty(len(others), np.int64)
    rank[sorted(range(len(others)), key=others.__getitem__)] = np.arange(len(others))
    order = np.lexsort((rank[theirs], -n[theirs], mine))
    who, first, near = np.unique(mine[order], return_index=True, return_counts=True)
    best = theirs[order][first]
    return pd.DataFrame({"word": [asking[i] for i in who], "near": near, "best_n": n[best], "best": [others[i] for i in best]})


def search_leaf(length: int, rows: pd.DataFrame) -> pd.DataFrame:
    """Near words within a leaf of the tree of words of ``length`` letters."""
    kind = rows["kind"].to_numpy()
    parts = {name: rows[mask] for name, mask in (("home", kind == HOME), ("same", kind != SHORTER), ("short", kind == SHORTER))}
    words = {name: part["word"].tolist() for name, part in parts.items()}
    n = {name: part["n"].to_numpy() for name, part in parts.items()}
    found = []
    if words["home"]:
        points, letters = count_letters(words["home"]), _rows_of(words["home"], length)
        q, p = within(points, count_letters(words["same"]), 2)
        q, p = _verified(one_replaced, _rows_of(words["same"], length), letters, q, p)
        found.append(_best(words["same"], q, words["home"], p, n["home"]))
        if words["short"]:
            q, p = within(points, count_letters(words["short"]), 1)
            q, p = _verified(one_inserted, _rows_of(words["short"], length - 1), letters, q, p)
            found.append(_best(words["short"], q, words["home"], p, n["home"]))
            found.append(_best(words["home"], p, words["short"], q, n["short"]))
    empty = pd.DataFrame({"word": pd.Series(dtype=str), "near": pd.Series(dtype="int64"), "best_n": pd.Series(dtype="int64"), "best": pd.Series(dtype=str)})
    return pd.concat([f for f in found if len(f)] or [empty], ignore_index=True)


def upper_trees(words: DataFrame) -> dict[int, tuple | int]:
    """The upper levels for each length there is, from about ``SAMPLE`` words by a hash."""
    sized = words.withColumn("length", F.length("word"))
    sizes = {row["length"]: row["words"] for row in sized.groupBy("length").agg(F.count(F.lit(1)).alias("words")).collect()}
    every = max(1, -(-sum(sizes.values()) // SAMPLE))
    drawn: dict[int, list[str]] = {length: [] for length in sizes}
    for row in words.filter(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word").sort("word").collect():
        drawn[len(row["word"])].append(row["word"])
    return {length: upper_levels(count_letters(drawn[length]), -(-n * length // LEAF_LETTERS)) if drawn[length] else 0 for length, n in sizes.items()}


def _routed(trees: dict[int, tuple | int]):
    """Words dealt out to the leaves they live in or search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            lengths = np.array([len(w) for w in words], np.int64)
            for length in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == length)
                vectors = count_letters([words[i] for i in own])
                for tree, radius in ((length, 2), (length + 1, 1)):
                    if tree not in trees:
                        continue
                    rows, leaves, home = route(trees[tree], vectors, radius)
                    kind = np.where(home, HOME, VISITOR) if tree == length else np.full(len(rows), SHORTER)
                    who = own[rows]
                    columns = [
                        pa.array(np.full(len(rows), tree), pa.int32()), pa.array(leaves, pa.int32()), pa.array(kind, pa.int32()),
                        pa.array([words[i] for i in who], pa.string()), pa.array(n[who], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["length", "leaf", "kind", "word", "n"])

    return run


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (``n`` negative, then the word) of words (a written table) that have near ones."""
    trees = upper_trees(words)

    def leaf(of: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return search_leaf(int(of[0]), rows)

    with batch_rows(words.sparkSession, 8192):
        routed = words.select("word", "n").mapInArrow(_routed(trees), "length int, leaf int, kind int, word string, n long")
        found = stage(routed.groupBy("length", "leaf").applyInPandas(leaf, FOUND), "near-words")
    best = F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best)


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: where the forms of words lead in the end. Each step is over :data:`RATIO` times as
    common as the one before, so paths are short, and each round halves them."""
    links = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        links = stage(links, "forms")
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.drop("moved")


def variants(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per common word: ``word``, ``form`` (the near word it is a variant of, or null), ``root``, ``n``, ``n_near``, ``form_n``."""
    words = stage(word_counts(docs, text, key), "words")
    known = words.join(near_words(words), "word", "left")
    more: Column = -F.col("best.minus_n")
    is_variant = more >= RATIO * F.col("n")
    known = known.select(
        "word",
        F.when(is_variant, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_variant, more).alias("form_n"),
    )
    known = stage(known, "variants")
    led = roots(known.filter(F.col("form").isNotNull()))
    return known.join(led, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
