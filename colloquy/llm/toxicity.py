"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of hashed embeddings of its character n-grams (``ORDERS``), scaled by the root of
their number, beside a hashed embedding of the whole word. Two gated recurrent units read each
window of ``WINDOW`` words from either end, attention pools their states, and a linear layer gives
the window's logit. All overlapping windows of a text are scored, one from each word on that has
``WINDOW`` words from there; the highest logit is the text's. A shorter text is one window.

The network is trained in numpy on the driver from a bounded sample of labelled documents: at
most ``TRAIN_DOCS`` of each label, in the order of a hash, whole texts of any length. Training scores all their
windows, too, and passes the loss to those that score highest. Scoring reads every document whole.

Rows: null counts as the empty text; a text without words is scored as one window of padding.
Scores depend on the text alone. Labels that are null, or of no document, are not trained on; without
documents of either label, or without labels of one, every score is 0. Labels of both of which only
one has documents are an error. An empty table gives no rows. Columns called like a
result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.common import WORD, append_columns, texts

WINDOW = 16
# Lengths of the character n-grams.
ORDERS = (3, 4)
CHAR_ROWS, CHAR_DIM = 1 << 15, 16
WORD_ROWS, WORD_DIM = 1 << 14, 8
HIDDEN, ATTENTION = 6, 4
# Most documents of label 0 and of label 1 to train on.
TRAIN_DOCS = (2400, 800)
EPOCHS, BATCH_DOCS, RATE = 6, 32, 6e-3
TOP_WINDOWS = 2
THRESHOLD = 0.7
# Words a worker remembers before it starts anew.
REMEMBERED = 150_000
SCORED_AT_ONCE = 2048
# Windows whose states are held at once: they stay in a core's cache.
SLID_AT_ONCE = 2048
NOT_LETTERS = re.compile(r"[\W_]+")
# Weights of a word's letters in its hash, by their place.
POWERS = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))


def _plain(word: str) -> str:
    lower = word.lower()
    return lower if lower.isalpha() else NOT_LETTERS.sub("", lower) or "_"


def _rows_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the character table for the n-grams of all words in order, where each word's begin (every word has
    one), and rows of the word table. All are hashes of code points, worked out for all words at once."""
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words])
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(points)) - np.repeat(ends - lengths, lengths)
    whole = np.add.reduceat((points + np.uint64(1)) * POWERS[place % len(POWERS)], ends - lengths)
    buckets, owners, value = [], [], np.zeros(len(points), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        value = value[: len(points) - n + 1] * np.uint64(0x100000001B3) ^ points[n - 1 :]
        if n in ORDERS:
            at = np.flatnonzero(place[: len(value)] + n <= lengths[owner[: len(value)]])
            buckets.append(_bucket(value[at] ^ np.uint64(n), CHAR_ROWS))
            owners.append(owner[at])
    order = np.argsort(np.concatenate(owners), kind="stable")
    begins = np.searchsorted(np.concatenate(owners)[order], np.arange(len(words)))
    return np.concatenate(buckets)[order], begins, _bucket(whole, WORD_ROWS)


def _bucket(value: np.ndarray, rows: int) -> np.ndarray:
    return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % rows


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Weights, and the network forward and backward. Arrays of both directions are stacked."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def draw(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        inputs = CHAR_DIM + WORD_DIM
        return cls(
            {
                "chars": draw(CHAR_ROWS, CHAR_DIM, scale=0.1),
                "words": draw(WORD_ROWS, WORD_DIM, scale=0.1),
                "input": draw(2, inputs, 3 * HIDDEN, scale=inputs**-0.5),
                "input_bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
                "state": draw(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
                "attend": draw(2 * HIDDEN, ATTENTION, scale=(2 * HIDDEN) ** -0.5),
                "attend_bias": np.zeros(ATTENTION, np.float32),
                "attend_out": draw(ATTENTION, scale=1.0),
                "out": draw(2 * HIDDEN, scale=0.5),
                "out_bias": np.zeros(1, np.float32),
            }
        )

    def embed(self, buckets: np.ndarray, begins: np.ndarray, word_rows: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(begins, len(buckets)))
        chars = np.add.reduceat(self.weights["chars"][buckets], begins, axis=0) / np.sqrt(counts)[:, None].astype(np.float32)
        return np.concatenate([chars, self.weights["words"][word_rows]], 1)

    def project(self, embedded: np.ndarray) -> np.ndarray:
        """Inputs of the gates of both directions; the last row is padding, which keeps a state."""
        inputs = embedded[None] @ self.weights["input"] + self.weights["input_bias"]
        padding = np.zeros((2, 1, 3 * HIDDEN), np.float32)
        padding[:, :, :HIDDEN] = 30
        return np.concatenate([inputs, padding], 1)

    def forward(self, projected: np.ndarray, windows: np.ndarray, real: np.ndarray, keep: bool = False):
        """Logit of each window (rows of word numbers; ``real`` marks those that are not padding)."""
        w, (n, steps) = self.weights, windows.shape
        state = np.zeros((2, n, HIDDEN), np.float32)
        states = np.empty((n, steps, 2 * HIDDEN), np.float32)
        memory = []
        for t in range(steps):
            inputs = np.stack([projected[0][windows[:, t]], projected[1][windows[:, steps - 1 - t]]])
            carried = state @ w["state"]
            gates = _gate(inputs[..., : 2 * HIDDEN] + carried[..., : 2 * HIDDEN])
            update, reset = gates[..., :HIDDEN], gates[..., HIDDEN:]
            fresh = np.tanh(inputs[..., 2 * HIDDEN :] + reset * carried[..., 2 * HIDDEN :])
            if keep:
                memory.append((state, update, reset, fresh, carried[..., 2 * HIDDEN :]))
            state = fresh + update * (state - fresh)
            states[:, t, :HIDDEN] = state[0]
            states[:, steps - 1 - t, HIDDEN:] = state[1]
        hidden = np.tanh(states.reshape(-1, 2 * HIDDEN) @ w["attend"] + w["attend_bias"]).reshape(n, steps, ATTENTION)
        scores = hidden @ w["attend_out"] + np.where(real, np.float32(0), np.float32(-1e9))
        share = np.exp(scores - scores.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", share, states)
        logits = pooled @ w["out"] + w["out_bias"][0]
        return (logits, (memory, states, hidden, share, pooled)) if keep else logits

    def slide(self, projected: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Logits of the windows from each word on of a row of words: those of ``forward``. Neighbours
        share their inputs, which are laid out once by word and read shifted by a step."""
        w, count = self.weights, len(numbers) - WINDOW + 1
        # A gate is (1 + tanh) / 2 of half its input: the halves are in the weights.
        state_weights = np.ascontiguousarray(0.5 * w["state"].transpose(0, 2, 1))
        read = np.concatenate([w["attend"], w["out"][:, None]], 1).T.copy()
        logits = np.empty(max(count, 0), np.float32)
        for at in range(0, count, SLID_AT_ONCE):
            n = min(SLID_AT_ONCE, count - at)
            inputs = np.ascontiguousarray(projected[:, numbers[at : at + n + WINDOW - 1]].transpose(0, 2, 1))
            inputs[:, : 2 * HIDDEN] *= 0.5
            state = np.zeros((2, HIDDEN, n), np.float32)
            states = np.empty((WINDOW, 2, HIDDEN, n), np.float32)
            for t in range(WINDOW):
                back = WINDOW - 1 - t
                shifted = (inputs[0, :, t : t + n], inputs[1, :, back : back + n])
                carried = state_weights @ state
                gates, fresh = carried[:, : 2 * HIDDEN], carried[:, 2 * HIDDEN :]
                for side in (0, 1):
                    gates[side] += shifted[side][: 2 * HIDDEN]
                np.tanh(gates, out=gates)
                gates += 1
                update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
                fresh *= reset
                for side in (0, 1):
                    fresh[side] += shifted[side][2 * HIDDEN :]
                np.tanh(fresh, out=fresh)
                update *= 0.5
                state -= fresh
                state *= update
                state += fresh
                states[t, 0] = state[0]
                states[back, 1] = state[1]
            hidden = read @ states.reshape(WINDOW, 2 * HIDDEN, n)
            value, hidden = hidden[:, ATTENTION], hidden[:, :ATTENTION]
            hidden += w["attend_bias"][:, None]
            np.tanh(hidden, out=hidden)
            scores = w["attend_out"] @ hidden
            share = np.exp(scores - scores.max(0))
            logits[at : at + n] = (share * value).sum(0) / share.sum(0) + w["out_bias"][0]
        return logits

    def backward(self, projected: np.ndarray, windows: np.ndarray, kept, slope: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights above the embedding, and of the projected words."""
        memory, states, hidden, share, pooled = kept
        w, (n, steps) = self.weights, windows.shape
        grads = {"out": pooled.T @ slope, "out_bias": slope.sum(keepdims=True)}
        d_pooled = slope[:, None] * w["out"]
        d_states = share[..., None] * d_pooled[:, None, :]
        d_share = np.einsum("nth,nh->nt", states, d_pooled)
        d_scores = share * (d_share - (share * d_share).sum(1, keepdims=True))
        grads["attend_out"] = np.einsum("nt,nta->a", d_scores, hidden)
        d_hidden = (d_scores[..., None] * w["attend_out"]) * (1 - hidden**2)
        flat = d_hidden.reshape(-1, ATTENTION)
        grads["attend"] = states.reshape(-1, 2 * HIDDEN).T @ flat
        grads["attend_bias"] = flat.sum(0)
        d_states += (flat @ w["attend"].T).reshape(n, steps, 2 * HIDDEN)

        d_projected = np.zeros_like(projected)
        grads["state"] = np.zeros_like(w["state"])
        d_state = np.zeros((2, n, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            state, update, reset, fresh, carried = memory[t]
            d_state = d_state + np.stack([d_states[:, t, :HIDDEN], d_states[:, steps - 1 - t, HIDDEN:]])
            d_fresh = d_state * (1 - update) * (1 - fresh**2)
            d_update = d_state * (state - fresh) * update * (1 - update)
            d_reset = d_fresh * carried * reset * (1 - reset)
            d_inputs = np.concatenate([d_update, d_reset, d_fresh], 2)
            d_carried = np.concatenate([d_update, d_reset, d_fresh * reset], 2)
            grads["state"] += state.transpose(0, 2, 1) @ d_carried
            d_state = d_state * update + d_carried @ w["state"].transpose(0, 2, 1)
            np.add.at(d_projected[0], windows[:, t], d_inputs[0])
            np.add.at(d_projected[1], windows[:, steps - 1 - t], d_inputs[1])
        return grads, d_projected


def _windows(numbers: list[np.ndarray], padding: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows from each word on of texts given as word numbers, what in them is not padding, and where
    each text's windows begin. A text of up to ``WINDOW`` words, or none, has one."""
    sizes = np.array([len(n) for n in numbers])
    counts = np.maximum(sizes - WINDOW + 1, 1)
    begins = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(numbers)), counts)
    at = (np.arange(len(owner)) - begins[owner])[:, None] + np.arange(WINDOW)
    real = at < sizes[owner][:, None]
    flat = np.concatenate([*numbers, np.zeros(1, np.int64)])
    first = np.cumsum(sizes) - sizes
    windows = np.where(real, flat[np.where(real, first[owner][:, None] + at, 0)], padding)
    real[sizes[owner] == 0, 0] = True
    return windows, real, begins


def every_logit(net: Network, projected: np.ndarray, numbers: list[np.ndarray], padding: int) -> tuple[np.ndarray, np.ndarray]:
    """Logits of all overlapping windows of texts given as word numbers, and where each text's begin."""
    sizes = np.array([len(n) for n in numbers])
    counts = np.maximum(sizes - WINDOW + 1, 1)
    begins = np.cumsum(counts) - counts
    logits = np.empty(counts.sum(), np.float32)
    whole = sizes >= WINDOW
    if short := [n for n, is_whole in zip(numbers, whole, strict=True) if not is_whole]:
        windows, real, _ = _windows(short, padding)
        parts = [slice(at, at + SCORED_AT_ONCE) for at in range(0, len(windows), SCORED_AT_ONCE)]
        logits[begins[~whole]] = np.concatenate([net.forward(projected, windows[part], real[part]) for part in parts])
    if whole.any():
        # Longer texts are read as one row; windows over a border are left out.
        slid = net.slide(projected, np.concatenate([n for n, is_whole in zip(numbers, whole, strict=True) if is_whole]))
        ends = np.cumsum(sizes[whole])
        inside = np.ones(len(slid), bool)
        over = (ends[:-1, None] - np.arange(1, WINDOW)).ravel()
        inside[over] = False
        logits[np.repeat(whole, counts)] = slid[inside]
    return logits, begins


def _cut(numbers: list[np.ndarray], starts: list[int], padding: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each text that begins at ``starts``, and what in it is not padding."""
    windows = np.full((len(numbers), WINDOW), padding)
    for row, words, start in zip(windows, numbers, starts, strict=True):
        part = words[start : start + WINDOW]
        row[: len(part)] = part
    return windows, windows != padding


def train(texts_: list[str], labels: list[int], seed: int = 7) -> Network:
    """A network fitted to labelled texts, by Adam on the windows that score highest."""
    rng = np.random.default_rng(seed)
    net = Network.new(seed)
    index: dict[str, int] = {}
    numbers = [np.array([index.setdefault(_plain(w), len(index)) for w in t.split()], np.int64) for t in texts_]
    vocabulary = list(index) or ["_"]
    buckets, begins, word_rows = _rows_of(vocabulary)
    ends = np.append(begins[1:], len(buckets))
    labels_ = np.array(labels, np.float32)
    sides = [np.flatnonzero(labels_ == side) for side in (1, 0)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.weights.items()}
    step = 0
    rounds = max(1, max(len(s) for s in sides) * 2 // BATCH_DOCS)
    for epoch in range(EPOCHS):
        # Both labels weigh the same: the smaller side is gone through again.
        dealt = [np.resize(rng.permutation(side), rounds * BATCH_DOCS // 2) for side in sides]
        for at in range(rounds):
            part = slice(at * BATCH_DOCS // 2, (at + 1) * BATCH_DOCS // 2)
            chosen = np.concatenate([d[part] for d in dealt])
            # Only the words at hand are embedded.
            sizes = [len(numbers[i]) for i in chosen]
            used, local = np.unique(np.concatenate([numbers[i] for i in chosen]), return_inverse=True)
            if not len(used):
                continue
            renamed = np.split(local, np.cumsum(sizes)[:-1])
            spans = ends[used] - begins[used]
            grams = buckets[np.repeat(begins[used] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())]
            own_begins = np.cumsum(spans) - spans
            embedded = net.embed(grams, own_begins, word_rows[used])
            projected = net.project(embedded)
            logits, first = every_logit(net, projected, renamed, len(used))
            starts, weight = [], []
            for d, (a, b) in enumerate(zip(first, np.append(first[1:], len(logits)), strict=True)):
                top = np.argsort(-logits[a:b], kind="stable")[:TOP_WINDOWS]
                starts += top.tolist()
                weight += [(d, 1 / len(top))] * len(top)
            best, real = _cut([renamed[d] for d, _ in weight], starts, len(used))
            chosen_logits, kept = net.forward(projected, best, real, keep=True)
            target = labels_[chosen][[d for d, _ in weight]]
            slope = ((_gate(chosen_logits) - target) * np.array([s for _, s in weight]) / len(chosen)).astype(np.float32)
            grads, d_projected = net.backward(projected, best, kept, slope)

            d_inputs = d_projected[:, :-1]
            grads["input"] = embedded.T[None] @ d_inputs
            grads["input_bias"] = d_inputs.sum(1, keepdims=True)
            d_embedded = (d_inputs @ net.weights["input"].transpose(0, 2, 1)).sum(0)
            grads["words"] = np.zeros_like(net.weights["words"])
            np.add.at(grads["words"], word_rows[used], d_embedded[:, CHAR_DIM:])
            grads["chars"] = _scatter(grams, np.repeat(d_embedded[:, :CHAR_DIM] / np.sqrt(spans)[:, None].astype(np.float32), spans, axis=0))
            step += 1
            rate = RATE * (1 - epoch / EPOCHS) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            for name, grad in grads.items():
                mean, square = moments[name]
                mean += 0.1 * (grad - mean)
                square += 0.001 * (grad * grad - square)
                net.weights[name] -= (rate * mean / (np.sqrt(square) + 1e-8)).astype(np.float32)
    return net


def _scatter(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of values by row of the character table."""
    total = np.zeros((CHAR_ROWS, values.shape[1]), np.float32)
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    total[ordered[begins]] = np.add.reduceat(values[order], begins, axis=0)
    return total


class _Numbers(dict):
    """Words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class Scorer:
    """Scores of whole texts, with a bounded memory of the words' projections."""

    def __init__(self, net: Network):
        self.net = net
        self.forget()

    def forget(self) -> None:
        # Many words are written in several ways: each way has a number, each word that enters a row.
        self.written = _Numbers()
        self.plain: dict[str, int] = {}
        self.row_of = np.zeros(0, np.int64)
        self.rows = np.zeros((2, 4096, 3 * HIDDEN), np.float32)
        # Row 0 is padding.
        self.rows[:, 0] = self.net.project(np.zeros((0, CHAR_DIM + WORD_DIM), np.float32))[:, 0]

    def learn(self) -> None:
        """Rows for the words that have been written since the last time."""
        plain = list(map(_plain, islice(self.written, len(self.row_of), None)))
        fresh = list(set(plain).difference(self.plain))
        for part in range(0, len(fresh), 20_000):
            some = fresh[part : part + 20_000]
            projected = self.net.project(self.net.embed(*_rows_of(some)))[:, :-1]
            start = len(self.plain) + 1
            while start + len(some) > self.rows.shape[1]:
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)], 1)
            self.rows[:, start : start + len(some)] = projected
            self.plain.update(zip(some, range(start, start + len(some)), strict=True))
        self.row_of = np.append(self.row_of, np.fromiter(map(self.plain.__getitem__, plain), np.int64, len(plain)))

    def scores(self, bodies: list[str]) -> np.ndarray:
        if len(self.written) > REMEMBERED:
            self.forget()
        words = [body.split() for body in bodies]
        sizes = np.array([len(w) for w in words])
        numbers = np.fromiter(map(self.written.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum())
        self.learn()
        read = np.split(self.row_of[numbers], np.cumsum(sizes)[:-1])
        logits, begins = every_logit(self.net, self.rows, read, 0)
        return _gate(np.maximum.reduceat(logits, begins).astype(np.float64))


def held_out(key: str) -> Column:
    """A third of the documents, by a checksum of the identifier; never trained on."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> list[tuple[str, int]]:
    """At most ``TRAIN_DOCS`` labelled texts. Labels are drawn among those whose document has a word; the
    draw, not the table, is what is joined with texts and collected."""
    known = labels.select(key, F.col(label).cast("int").alias("_label"))
    known = known.filter(F.col("_label").isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).distinct()
    order = [F.xxhash64(F.col(key)), F.col(key)]
    worded = docs.filter(F.col(text).rlike(WORD)).select(key, text)
    present = known.join(worded.select(key), key, "left_semi")
    drawn = [present.filter(F.col("_label") == side).orderBy(*order).limit(TRAIN_DOCS[side]) for side in (0, 1)]
    found = worded.join(F.broadcast(drawn[0].union(drawn[1])), key)
    chosen = [found.filter(F.col("_label") == side).orderBy(*order, F.xxhash64(text), text).limit(TRAIN_DOCS[side]) for side in (0, 1)]
    sample = [(row["_text"], row["_label"]) for row in chosen[0].union(chosen[1]).select(F.col(text).alias("_text"), "_label").collect()]
    if len(sides := {side for _, side in sample}) == 1 and not known.filter(~F.col("_label").isin(*sides)).isEmpty():
        raise ValueError(f"only documents labelled {sides.pop()} have text to train on, though there are labels of both kinds")
    return sample


def score(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", corpus: DataFrame | None = None, keep_text: bool = False
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``, without the text unless ``keep_text``.
    The network is trained on ``corpus`` (default: ``docs``) and ``labels`` when this is called."""
    sample = training_sample(docs if corpus is None else corpus, labels, text, key, label)
    net = train(*map(list, zip(*sample, strict=True))) if len({side for _, side in sample}) == 2 else None

    def compute(batches: Iterator[pa.RecordBatch]):
        scorer = Scorer(net) if net else None
        for batch in batches:
            bodies = texts(batch, text)
            yield [scorer.scores(bodies) if scorer and bodies else np.zeros(len(bodies))]

    scored = append_columns(docs, [T.StructField("score", T.DoubleType())], compute, () if keep_text else (text,))
    return scored.withColumn("held_out", held_out(key)).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
