"""Byte-level BPE through a sentencepiece model made from a rank file.

The model is written straight from the vocabulary: every byte is mapped to a printable
character, each token becomes a piece with the score minus its rank, and normalisation is
the identity. sentencepiece merges the neighbours whose joined piece scores highest, that is
ranks lowest, which is the merge order of byte-level BPE. Texts are cut into pre-tokens
first, so no merge crosses one. A pre-token that is itself in the vocabulary is its own token.

Rows: a null text counts as empty; an empty text has no ids. Texts are encoded whole. Ids are
a function of the text alone, so ties and repeated rows need no rule. Columns of the input
called like an output are replaced.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.common import append_columns, texts

# Different pre-tokens a worker remembers before it starts anew.
REMEMBERED = 300_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else the
    next unused code point from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ``i`` is the token of rank ``i``; the piece for
    unknown input, which 256 byte pieces never leave to be used, comes last."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    characters = byte_characters()
    model = pb.ModelProto()
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        piece = model.pieces.add()
        piece.piece = "".join(characters[b] for b in token)
        piece.score = -float(rank)
        piece.type = pb.ModelProto.SentencePiece.NORMAL
    unknown = model.pieces.add()
    unknown.piece, unknown.score, unknown.type = "<unk>", 0.0, pb.ModelProto.SentencePiece.UNKNOWN
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(model.pieces) - 1
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class PieceCodec:
    """Encoder and decoder of one rank file, with a bounded memory of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        if sorted(self.ranks.values()) != list(range(len(self.ranks))) or any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("ranks must run from 0 without gaps and contain all single bytes")
        self.tokens = sorted(self.ranks, key=self.ranks.get)
        self.split = regex.compile(pattern).findall
        self.mapped = dict(enumerate(byte_characters()))
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(self.ranks))
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        """Ids of one whole text as int32."""
        words = self.split(text)
        known = self.known
        if new := list(set(words).difference(known)):
            self._learn(new)
        packed = b"".join(map(known.__getitem__, words))
        if len(known) > REMEMBERED:
            known.clear()
        return np.frombuffer(packed, np.int32)

    def _learn(self, words: list[str]) -> None:
        rest = []
        for word in words:
            rank = self.ranks.get(word.encode())
            if rank is None:
                rest.append(word)
            else:
                self.known[word] = np.int32(rank).tobytes()
        spelled = [word.encode().decode("latin-1").translate(self.mapped) for word in rest]
        for word, ids in zip(rest, self.model.encode(spelled, out_type=int, num_threads=1), strict=True):
            self.known[word] = np.array(ids, np.int32).tobytes()

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of a list of ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> PieceCodec:
    return PieceCodec(path, pattern)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int32)))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep_text: bool = False) -> DataFrame:
    """``docs`` with the token ids of ``text`` in the array column ``ids``, and without the
    text unless ``keep_text``."""

    def compute(batches: Iterator[pa.RecordBatch]):
        own = codec(path, pattern)
        for batch in batches:
            yield [_lists([own.encode(t) for t in texts(batch, text)])]

    return append_columns(docs, [T.StructField(ids, T.ArrayType(T.IntegerType()))], compute, () if keep_text else (text,))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass, one worker per task: ``docs`` without its text, with both columns."""

    def compute(batches: Iterator[pa.RecordBatch]):
        own = codec(path, pattern)
        for batch in batches:
            encoded = [own.encode(t) for t in texts(batch, text)]
            yield [_lists(encoded), [own.decode(e.tolist()) for e in encoded]]

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.BinaryType())]
    return append_columns(docs, fields, compute, (text,))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the decoded bytes of ``ids`` in the binary column ``out``; null ids give
    no bytes."""

    def compute(batches: Iterator[pa.RecordBatch]):
        own = codec(path, pattern)
        for batch in batches:
            yield [[own.decode(row or []) for row in batch.column(ids).to_pylist()]]

    return append_columns(encoded, [T.StructField(out, T.BinaryType())], compute)
