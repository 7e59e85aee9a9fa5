"""Chat formatting of typed content parts.

A turn has a role and content parts: text, image, audio or document. A visitor flattens the
parts in order: text is escaped, every other part becomes a numbered placeholder, and its
reference and expanded token count are recorded as an attachment. The template marks where a
turn, its content and its end are; the loss mask covers the text parts of assistant turns.

Control strings within a text get a backslash behind their first character, and backslashes
are doubled, so the formatted text can be read back exactly and no text can open or end a turn.

A conversation is formatted turn by turn, and turns stay rows: a conversation of any length is
never held in one cell. Reading back streams through them in order; a digest of a whole
conversation is sequential by its nature, so one conversation is one task's work, in bounded
memory.

Results for odd input: null text, role or parts are empty; turns of equal number are ordered
by role and text, null numbers come first; repeated rows are turns of their own; rows of a
null conversation id are one conversation; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartulary.llm.shared import partitions, read

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
PARTS = f"array<{PART}>"
# fixed values: the template's marks, and control strings of common templates
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDER = "<|{kind}:{number}|>"
CONTROL = re.compile(r"<(?=\||/?s>|/?unk>|/?pad>|<SYS>>|</SYS>>)|\[(?=/?INST\]|/?TOOL|/?AVAILABLE)|\|(?=>)")
UNESCAPE = re.compile(r"\\(\\?)")
TILE, TILE_TOKENS, TOKENS_A_SECOND, TOKENS_A_PAGE = 512, 85, 25, 600


class Attachment(NamedTuple):
    number: int
    kind: str
    ref: str
    n_tokens: int


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1", text)


class Flatten:
    """Visits the parts of one turn in order."""

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.attachments: list[Attachment] = []

    def visit(self, part: dict) -> None:
        kind = part.get("type") or "text"
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(part.get("text") or ""))

    def visit_image(self, part: dict) -> None:
        tiles = -(-(part.get("width") or TILE) // TILE) * -(-(part.get("height") or TILE) // TILE)
        self._attach("image", part, tiles * TILE_TOKENS)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part, -int(-(part.get("seconds") or 0) * TOKENS_A_SECOND // 1))

    def visit_document(self, part: dict) -> None:
        self._attach("document", part, (part.get("pages") or 1) * TOKENS_A_PAGE)

    def visit_other(self, part: dict) -> None:
        """A part of unknown type is kept as an attachment without tokens."""
        self._attach("other", part, 0)

    def _attach(self, kind: str, part: dict, n_tokens: int) -> None:
        number = len(self.attachments)
        self.attachments.append(Attachment(number, kind, part.get("ref") or "", n_tokens))
        self.pieces.append(PLACEHOLDER.format(kind=kind, number=number))


FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("formatted", pa.string()),
    ("mask", pa.list_(pa.list_(pa.int32()))),
    ("attachments", pa.list_(pa.struct([("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("n_tokens", pa.int32())]))),
])
FORMATTED_DDL = "conv_id long, turn long, role string, formatted string, mask array<array<int>>, attachments array<struct<number:int,kind:string,ref:string,n_tokens:int>>"


def format_turn(role: str, parts: list[dict]) -> tuple[str, list[list[int]], list[Attachment]]:
    """The formatted turn, the spans of it under the loss mask, and the attachments."""
    visitor = Flatten()
    head, mask = TURN + escape(role) + BODY, []
    at = len(head)
    for part in parts:
        visitor.visit(part)
        size = len(visitor.pieces[-1])
        if role == "assistant" and (part.get("type") or "text") == "text" and size:
            mask.append([at, at + size])
        at += size
    return head + "".join(visitor.pieces) + END, mask, visitor.attachments


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            role = row["role"] or ""
            text, mask, attachments = format_turn(role, [p or {} for p in row["parts"] or []])
            rows.append({"conv_id": row["conv_id"], "turn": row["turn"], "role": role, "formatted": text, "mask": mask, "attachments": [a._asdict() for a in attachments]})
        yield pa.RecordBatch.from_pylist(rows, FORMATTED)


def chat_format(turns: DataFrame) -> DataFrame:
    """A row for each of ``turns`` (``conv_id, turn, role, parts``), with ``formatted``, ``mask`` and ``attachments``.

    The formatted conversation is its turns' texts one after another, in the order of
    ``ordered``; ``mask`` has spans of code points of the turn's own text.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("parts").cast(PARTS).alias("parts"))
    return rows.mapInArrow(_format, FORMATTED_DDL)


def ordered(formatted: DataFrame) -> DataFrame:
    """Conversations whole in a partition, their turns in order."""
    return formatted.repartition(partitions(formatted.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")


def text_parts(text: str = "text") -> Column:
    """One text part made of a column."""
    values = {"type": F.lit("text"), "text": F.coalesce(F.col(text), F.lit(""))}
    fields = [f.split(":")[0] for f in PART[7:-1].split(",")]
    return F.array(F.struct(*[values.get(f, F.lit(None)).alias(f) for f in fields])).cast(PARTS)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn of text parts."""
    role, body = formatted.removeprefix(TURN).removesuffix(END).split(BODY, 1)
    return unescape(role), unescape(body)


class Digest:
    """Of one conversation, from its formatted turns."""

    def __init__(self, conv_id: int | None):
        self.row = {"conv_id": conv_id, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "n_attachments": 0, "attachment_tokens": 0}
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, mask: list[list[int]], attachments: list[dict]) -> None:
        role, text = read_turn(formatted)
        self.turns.update(f"{role}\n{text}\n".encode())
        for start, stop in mask:
            part = unescape(formatted[start:stop])
            self.loss.update(part.encode())
            self.row["loss_chars"] += len(part)
        self.row["n_turns"] += 1
        self.row["formatted_chars"] += len(formatted)
        self.row["n_attachments"] += len(attachments)
        self.row["attachment_tokens"] += sum(a["n_tokens"] for a in attachments)

    def done(self) -> dict:
        return self.row | {"turns_sha256": self.turns.hexdigest(), "loss_sha256": self.loss.hexdigest()}


DIGEST_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long, attachment_tokens long"
DIGESTS = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in DIGEST_DDL.split(", ")])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current = None
    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if current is None or row["conv_id"] != current.row["conv_id"]:
                if current is not None:
                    done.append(current.done())
                current = Digest(row["conv_id"])
            current.add(row["formatted"], row["mask"], row["attachments"])
        yield pa.RecordBatch.from_pylist(done, DIGESTS)
    if current is not None:
        yield pa.RecordBatch.from_pylist([current.done()], DIGESTS)


def digests(formatted: DataFrame) -> DataFrame:
    """One row a conversation, read back from its formatted turns."""
    rows = formatted.select("conv_id", "turn", "role", "formatted", "mask", "attachments")
    return ordered(rows).select("conv_id", "formatted", "mask", "attachments").mapInArrow(_digest, DIGEST_DDL)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", both), (-7, 1, "assistant", both)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return digests(chat_format(rows.select("conv_id", "turn", "role", text_parts().alias("parts"))))
