"""Quality rules on how well public vocabularies cover a text.

Two vocabularies encode the words of every text: a sentencepiece one with byte fallback and a
byte-level one for many languages. From the tokens follow characters per token, the share of
byte-fallback tokens and the entropy of the tokens in bits, and each must lie in the band of the
text's language and length, or of its script where the language has none.

Beside them stand the usual counts of words, symbols, repeated lines and repeated passages, and
a base verdict on length and repetition. Words are runs of anything but ASCII white space.

Rows: null counts as the empty text, which has no words, fails the base rule and has no
measures. Texts are read whole. Every measure is a function of one row, so ties and
repeated rows need no rule. An empty table gives no rows. Columns called like a result are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.common import append_columns, texts

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\r\x0b\x0c"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# Words a worker remembers before it starts anew.
REMEMBERED = 300_000


@dataclass(frozen=True)
class Band:
    """Accepted ranges. ``floors`` holds the least characters per token and the least entropy by the
    least number of sentencepiece tokens they count from, ascending from 0: short texts spread wider
    and cannot reach much entropy."""

    max_chars_per_token: float
    max_byte_share: float
    floors: tuple[tuple[int, float, float], ...]

    def fits(self, tokens: int, per_token: float, byte_share: float, entropy: float) -> bool:
        least, bits = [floor[1:] for floor in self.floors if floor[0] <= tokens][-1]
        return least <= per_token <= self.max_chars_per_token and byte_share <= self.max_byte_share and entropy >= bits


# Bands by language, then by script, then for everything else. Characters per token are
# those of whole words without white space, averaged over both vocabularies.
#
# The floors of the four languages lie 0.03 to 0.04 characters and 0.09 to 0.16 bits below the lowest
# value among the documents labelled clean that pass the base rule (check_s and sf0.1 together: 20,544
# documents). For English these lowest values are, from 100, 250, 500, 1,000 and 2,000 tokens on, 1.76,
# 1.97, 1.97, 2.08 and 2.16 characters and 5.46, 5.99, 6.34, 6.52 and 6.75 bits. Below 100 tokens there are
# few such documents, so characters are let down 0.12 to 0.38 below the lowest and entropy does not count.
# The tables have no text in other languages: those floors are wide, below one passage of each script.
BANDS: Mapping[str, Band] = {
    "en": Band(7.0, 0.05, ((0, 1.50, 0), (100, 1.72, 5.35), (250, 1.93, 5.90), (500, 1.94, 6.25), (1000, 2.05, 6.40), (2000, 2.13, 6.65))),
    "fr": Band(7.0, 0.05, ((0, 1.50, 0), (100, 1.62, 5.30), (250, 1.76, 5.85), (500, 1.85, 6.05), (1000, 1.88, 6.20), (2000, 1.93, 6.35))),
    "de": Band(7.0, 0.05, ((0, 1.50, 0), (100, 1.97, 5.40), (250, 1.98, 5.80), (500, 1.98, 6.15), (1000, 2.09, 6.30), (2000, 2.17, 6.45))),
    "es": Band(7.0, 0.05, ((0, 1.50, 0), (100, 1.77, 5.30), (250, 1.80, 5.80), (500, 1.85, 6.05), (1000, 1.85, 6.25), (2000, 1.91, 6.50))),
    "latin": Band(7.0, 0.10, ((0, 1.30, 0), (100, 1.30, 5.0))),
    "cyrillic": Band(6.0, 0.20, ((0, 0.9, 0), (100, 0.9, 4.5))),
    "greek": Band(5.0, 0.40, ((0, 0.6, 0), (100, 0.6, 3.5))),
    "arabic": Band(5.0, 0.50, ((0, 0.5, 0), (100, 0.5, 3.5))),
    "han": Band(3.0, 0.80, ((0, 0.3, 0), (100, 0.3, 3.5))),
    "other": Band(8.0, 0.95, ((0, 0.2, 0), (100, 0.2, 2.5))),
}
# Code point ranges that tell the scripts apart.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "han": ((0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)),
}

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("chars_per_token", T.DoubleType()),
    T.StructField("byte_share", T.DoubleType()),
    T.StructField("token_entropy", T.DoubleType()),
    T.StructField("band", T.StringType()),
    T.StructField("kept", T.BooleanType()),
]


class Vocabularies:
    """Tokens of words in both vocabularies, remembered by word."""

    def __init__(self, pieces: str, ranks: str, pattern: str):
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.byte_level = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.packed: list[bytes] = []
        self.others = np.zeros(1024, np.int32)

    def learn(self, words: set[bytes]) -> None:
        """Encode the words that are new; to be called for many texts at once."""
        if len(self.numbers) > REMEMBERED:
            self.forget()
        if not (new := list(words.difference(self.numbers))):
            return
        start = len(self.packed)
        spelled = [word.decode() for word in new]
        self.packed += [np.array(ids, np.int32).tobytes() for ids in self.pieces.encode(spelled, out_type=int, num_threads=1)]
        while len(self.packed) > len(self.others):
            self.others = np.concatenate([self.others, np.zeros_like(self.others)])
        # A word stands after a space in running text.
        encode = self.byte_level.encode_ordinary
        self.others[start : len(self.packed)] = [len(encode(" " + word)) for word in spelled]
        self.numbers.update(zip(new, range(start, len(self.packed)), strict=True))

    def words(self, words: list[bytes]) -> np.ndarray:
        """A number for each word, the same for equal words until the next ``learn``."""
        return np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))

    def tokens(self, numbers: np.ndarray) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.packed.__getitem__, numbers.tolist())), np.int32)


@lru_cache(maxsize=1)
def _vocabularies(pieces: str, ranks: str, pattern: str) -> Vocabularies:
    return Vocabularies(pieces, ranks, pattern)


def repeated_words(numbers: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in windows found twice or more. Windows are compared in full: numbers of
    pairs, of pairs of pairs and so on stand for their contents exactly."""
    count = len(numbers) - window + 1
    if count < 2:
        return 0
    # Most texts repeat nothing, which equal hashes of windows cannot hide.
    mixed = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(count, np.uint64)
    for i in range(window):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + mixed[i : i + count]
    ordered = np.sort(hashes)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    names, width = np.unique(numbers, return_inverse=True)[1].astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        left, right = names[: len(names) - step], names[step:]
        names = np.unique(left * (names.max() + 1) + right, return_inverse=True)[1].astype(np.int64)
        width += step
    repeated = np.bincount(names)[names] > 1
    covered = np.zeros(len(numbers) + 1, np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def script_of(text: str) -> str:
    """The script most letters of the text belong to."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    counts = {name: sum(int(((points >= a) & (points <= b)).sum()) for a, b in ranges) for name, ranges in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


def _entropy(tokens: np.ndarray) -> float:
    ordered = np.sort(tokens)
    ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
    counts = np.diff(ends, prepend=-1)
    return float(np.log2(len(tokens)) - (counts * np.log2(counts)).sum() / len(tokens))


def _measure(text: str, raw: bytes, words: list[bytes], lang: str | None, own: Vocabularies, bands: Mapping[str, Band]) -> tuple:
    chars = len(text) - sum(map(text.count, SPACE))
    numbers = own.words(words)
    repeated = repeated_words(numbers)
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words)
    name = lang if lang in bands else script_of(text)
    band = bands.get(name, bands["other"])
    base = (len(words), chars, sum(map(text.count, SYMBOLS)), duplicate_lines(raw), repeated, failed)
    if not words:
        return (*base, None, None, None, name, False)
    tokens = own.tokens(numbers)
    per_token = 2 * chars / (len(tokens) + int(own.others[numbers].sum()))
    byte_share = float(own.bytes[tokens].mean())
    entropy = _entropy(tokens)
    return (*base, per_token, byte_share, entropy, name, band.fits(len(tokens), per_token, byte_share, entropy) and not failed)


def measure_all(bodies: list[str], langs: list[str | None], own: Vocabularies, bands: Mapping[str, Band] = BANDS) -> list[tuple]:
    """One tuple of ``FIELDS`` per text."""
    raws = [body.encode() for body in bodies]
    words = [raw.split() for raw in raws]
    own.learn(set().union(*words))
    return [_measure(*row, own, bands) for row in zip(bodies, raws, words, langs, strict=True)]


def judge(
    docs: DataFrame,
    pieces: str,
    ranks: str,
    pattern: str,
    text: str = "text",
    lang: str = "lang",
    bands: Mapping[str, Band] = BANDS,
    keep_text: bool = False,
) -> DataFrame:
    """``docs`` with ``FIELDS``, without the text unless ``keep_text``."""

    def compute(batches: Iterator[pa.RecordBatch]):
        own = _vocabularies(pieces, ranks, pattern)
        for batch in batches:
            rows = measure_all(texts(batch, text), batch.column(lang).to_pylist(), own, bands)
            yield [list(column) for column in zip(*rows, strict=True)] if rows else [[] for _ in FIELDS]

    return append_columns(docs, FIELDS, compute, () if keep_text else (text,))
