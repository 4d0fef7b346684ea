r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are its context, its
reply alone is trained on. Examples of a conversation are prefixes of one another, so the formatted
conversation is written once, a row per turn, and an example is the row of its reply: the example's
text is what the conversation holds up to ``chars``, its loss mask the code points from
``loss_start`` to ``loss_end``. That keeps the expansion as long as the conversations; written out, it would
grow with the square of their turns. :func:`render` writes examples out.

A turn is ``### role: text</turn>`` and a line feed. In texts and roles a backslash is doubled; one is put before
a ``#`` that another follows, and inside ``</turn>`` before its slash (and, in a role, before a space
after a colon). So no text holds ``###`` or ``</turn>``, and each backslash begins a pair that
stands for its second character: :func:`read_turn` gives role and text back.

Offsets are running totals along the conversation; a conversation with very many turns is spread over tasks.

Rows: turns are ordered by ``turn`` (null first), ties by role and text. A null text or role is empty.
A null ``conv_id`` is a conversation of its own. Repeated rows are turns like others. A conversation without an assistant turn is
formatted and yields no example. An empty table gives no rows. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.common import small_batches
from colloquy.operators.running import running
from colloquy.staging import stage

# Fixed: marks of the template.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
TARGET_ROLE = "assistant"
IN_TEXT = r"\\|#(?=#)|(?<=<)/(?=turn>)"
IN_ROLE = IN_TEXT + r"|(?<=:) "
PAIR = re.compile(r"\\(.)", re.DOTALL)

DIGESTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


def _escape(text: Column, controls: str) -> Column:
    return F.regexp_replace(text, controls, r"\\$0")


def expand(conversations: DataFrame, target: str = TARGET_ROLE) -> DataFrame:
    """One row per turn: ``conv_id``, ``position`` (from 1), ``segment`` (the formatted turn), ``chars``
    (code points of the conversation up to and with it) and, for turns of the ``target`` role, ``loss_start`` and
    ``loss_end``. Rows with a ``loss_start`` are the examples."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    header = F.concat(F.lit(OPEN), _escape(role, IN_ROLE), F.lit(AFTER_ROLE))
    body = _escape(text, IN_TEXT)
    turns = conversations.select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.md5(text).alias("mark"),
        F.length(header).alias("before"),
        F.length(body).alias("within"),
        F.concat(header, body, F.lit(CLOSE)).alias("segment"),
    )
    turns = stage(turns, "formatted-turns")
    placed = running(
        turns, "conv_id", ("turn", "role", "mark"), sums={"position": F.lit(1).cast("long"), "chars": F.length("segment").cast("long")}
    )
    body_start = F.col("chars") - F.length("segment") + F.col("before")
    start = F.when(F.col("role") == target, body_start)
    return placed.select("conv_id", "position", "segment", "chars", start.alias("loss_start"), (start + F.col("within")).alias("loss_end"))


def examples(expanded: DataFrame) -> DataFrame:
    """One row per example: ``conv_id``, the ``position`` of its reply, ``chars`` of its text, its mask."""
    return expanded.filter(F.col("loss_start").isNotNull()).select("conv_id", "position", "chars", "loss_start", "loss_end")


def render(expanded: DataFrame) -> DataFrame:
    """:func:`examples` with their whole ``text``: all turns before the reply as its context, then the reply. A conversation of n
    turns yields up to n texts of up to n turns each; it is gathered once, as one text, and what is shuffled does not grow
    with its examples."""
    parts = F.array_sort(F.collect_list(F.struct("position", "segment")))
    joined = F.array_join(F.transform(parts, lambda part: part["segment"]), "")
    whole = expanded.groupBy(F.col("conv_id").alias("of")).agg(joined.alias("whole"))
    found = examples(expanded).join(whole.hint("merge"), F.col("conv_id").eqNullSafe(F.col("of")))
    return found.select("conv_id", "position", "chars", "loss_start", "loss_end", _part("whole", F.lit(0), F.col("chars")).alias("text"))


def _part(text: str, start: Column, end: Column) -> Column:
    """Code points of ``text`` from ``start`` to ``end``."""
    return F.col(text).substr((start + 1).cast("int"), (end - start).cast("int"))


def unescape(text: str) -> str:
    return PAIR.sub(r"\1", text)


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, _, rest = segment.removeprefix(OPEN).partition(AFTER_ROLE)
    return unescape(role), unescape(rest.removesuffix(CLOSE))


def read_back(expanded: DataFrame) -> DataFrame:
    """Per conversation, from the written rows and the examples rendered of them: the number and a digest of its turns, and
    of all that its examples train on; code points of the formatted text.

    What is trained on is cut out of each example's text, and each text is held by its digest against the conversation up to
    its reply. A digest runs over a conversation in order, so its rows pass through one task, one batch at a time.
    """
    small_batches(expanded.sparkSession)
    slots = int(expanded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    masked = _part("text", F.col("loss_start"), F.col("loss_end"))
    read = render(expanded).select(F.col("conv_id").alias("of"), F.col("position").alias("at"), F.sha2("text", 256).alias("example"), masked.alias("masked"))
    turns = expanded.select("conv_id", "position", "segment", "chars")
    both = turns.join(read.hint("merge"), F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("position") == F.col("at")), "left")
    in_order = both.repartition(slots, "conv_id").sortWithinPartitions("conv_id", "position")
    return in_order.select("conv_id", "segment", "chars", "example", "masked").mapInArrow(_digest, DIGESTS)


class _Conversation:
    """What has been read of a conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.chars, self.trained = conv_id, 0, 0, 0
        self.all, self.loss, self.formatted = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, chars: int, example: str | None, masked: str | None) -> None:
        if chars != self.chars + len(segment):
            raise ValueError(f"conversation {self.conv_id}: turn {self.turns + 1} does not follow the one before")
        role, text = read_turn(segment)
        self.all.update(f"{role}\n{text}\n".encode())
        self.formatted.update(segment.encode())
        if example is not None:
            if example != self.formatted.hexdigest():
                raise ValueError(f"conversation {self.conv_id}: the example of turn {self.turns + 1} is not the conversation up to it")
            trained = unescape(masked)
            self.trained += len(trained)
            self.loss.update(trained.encode())
        self.turns += 1
        self.chars = chars

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.trained, self.loss.hexdigest(), self.chars


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current: _Conversation | None = None
    done: list[tuple] = []

    def rows() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [()] * len(DIGESTS)
        kinds = [pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in DIGESTS]
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=DIGESTS.names)

    for batch in batches:
        for conv_id, *turn in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    done.append(current.row())
                current = _Conversation(conv_id)
            current.add(*turn)
        yield rows()
    if current is not None:
        done.append(current.row())
        yield rows()
