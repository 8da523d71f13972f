"""Chat formatting with typed content parts.

A turn is a list of parts. A visitor flattens them in order: text as it is but with control
strings escaped, images, audio and documents as placeholders, with a record of the
attachment and of the tokens the placeholder stands for. A turn becomes

    <|im_start|>ROLE newline CONTENT <|im_end|> newline

In contents and roles, a backslash goes between ``<`` and ``|``, behind the backslashes that
are there already, so that no content can form a control string and reading can undo it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Turns of this role are what a model learns to say.
LEARNED_ROLE = "assistant"
#: What placeholders stand for: an image's token per square of pixels, a second of audio, a page.
IMAGE_SQUARE, AUDIO_TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 256

PART = (
    "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
)
_PARTS = f"array<{PART}>"
_ATTACHMENTS = "array<struct<ordinal:int,type:string,ref:string,tokens:bigint>>"

_OPENING = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)


def escape(text: str) -> str:
    return _OPENING.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass
class Flattened:
    """What a visitor makes of a turn's parts."""

    content: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)


def _size(value: float | None) -> float:
    """A width, length or number of pages; null, negative and non-finite ones are nothing."""
    return value if value is not None and 0 < value < math.inf else 0


class PartVisitor:
    """Flattens parts of known types; subclass it for others.

    Null parts and parts of null type are left out; parts of unknown type fail.
    """

    def visit(self, parts: list[dict | None]) -> Flattened:
        out = Flattened()
        for part in parts:
            if part is None or part["type"] is None:
                continue
            handler: Callable | None = getattr(self, f"visit_{part['type']}", None)
            if handler is None:
                raise ValueError(f"no such type of content: {part['type']}")
            handler(part, out)
        return out

    def visit_text(self, part: dict, out: Flattened) -> None:
        out.content.append(escape(part["text"] or ""))

    def visit_image(self, part: dict, out: Flattened) -> None:
        squares = math.ceil(_size(part["width"]) / IMAGE_SQUARE) * math.ceil(_size(part["height"]) / IMAGE_SQUARE)
        self._place(part, squares, out)

    def visit_audio(self, part: dict, out: Flattened) -> None:
        self._place(part, math.ceil(_size(part["seconds"]) * AUDIO_TOKENS_PER_SECOND), out)

    def visit_document(self, part: dict, out: Flattened) -> None:
        self._place(part, _size(part["pages"]) * TOKENS_PER_PAGE, out)

    def _place(self, part: dict, tokens: int, out: Flattened) -> None:
        out.attachments.append(
            {"ordinal": len(out.attachments), "type": part["type"], "ref": part["ref"], "tokens": tokens}
        )
        out.content.append(f"<|{part['type']}|>")


def text_parts(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) as turns of one text part each; a null text is empty."""
    kinds = {f.split(":")[0]: f.split(":")[1] for f in PART[len("struct<"):-1].split(",")}
    value = {"type": F.lit("text"), "text": F.coalesce(F.col("text").cast("string"), F.lit(""))}
    part = F.struct(*[value.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in kinds.items()])
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def formatted(turns: DataFrame, visitor: PartVisitor | None = None) -> DataFrame:
    """(conv_id, turn, role, segment, loss_start, loss_length, attachments, n_tokens), one row per turn of
    (conv_id, turn, role, parts).

    A conversation's text is the segments by turn; rows come by conversation in that order,
    each conversation in one partition. Equal turns come by role and content; a null turn
    first. The loss mask covers ``loss_length`` characters of the segment from
    ``loss_start`` on, none in turns that are not learned. ``n_tokens`` is what the
    placeholders expand to. A null role or list of parts is empty; a null conv_id is a
    conversation too. No conversation is held in memory.
    """
    chosen = visitor or PartVisitor()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for role, parts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                flat = chosen.visit(parts or [])
                content, head = "".join(flat.content), f"{START}{escape_role(role or '')}\n"
                learned = len(content) if role == LEARNED_ROLE else 0
                out.append((
                    f"{head}{content}{END}\n", len(head), learned, flat.attachments,
                    sum(a["tokens"] for a in flat.attachments),
                ))
            if out:
                kinds = (
                    pa.string(), pa.int64(), pa.int64(),
                    pa.list_(pa.struct([
                        ("ordinal", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())
                    ])),
                    pa.int64(),
                )
                made = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], *made],
                    names=["conv_id", "turn", "role", "segment", "loss_start", "loss_length", "attachments", "n_tokens"],
                )

    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.col("parts").cast(_PARTS),
    )
    made = rows.mapInArrow(
        work, "conv_id long, turn long, role string, segment string, loss_start long, loss_length long, "
        f"attachments {_ATTACHMENTS}, n_tokens long",
    )
    return made.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")


@dataclass
class _Reading:
    turns: int = 0
    chars: int = 0
    loss_chars: int = 0

    def __post_init__(self) -> None:
        self.said, self.learned = hashlib.sha256(), hashlib.sha256()

    def read(self, segment: str, start: int, length: int) -> None:
        turn = _TURN.fullmatch(segment)
        if turn is None:
            raise ValueError("a segment is no turn")
        role, text = unescape_role(turn[1]), unescape(turn[2])
        self.said.update(f"{role}\n{text}\n".encode())
        masked = unescape(segment[start: start + length])
        self.learned.update(masked.encode())
        self.turns += 1
        self.chars += len(segment)
        self.loss_chars += len(masked)


def read_back(segments: DataFrame) -> DataFrame:
    """What the segments of ``formatted`` say, one row per conversation, read from the text alone.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars): digests of
    role, newline, text, newline of each turn, and of the text under the loss mask.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        this, reading = None, None
        for batch in batches:
            done = []
            for conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reading is None or conv != this:
                    if reading is not None:
                        done.append((this, reading))
                    this, reading = conv, _Reading()
                reading.read(*row)
            yield _digests(done)
        if reading is not None:
            yield _digests([(this, reading)])

    return segments.select("conv_id", "segment", "loss_start", "loss_length").mapInArrow(
        work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long",
    )


def _digests(done: list[tuple]) -> pa.RecordBatch:
    columns = [
        pa.array([c for c, _ in done], pa.int64()), pa.array([r.turns for _, r in done], pa.int64()),
        pa.array([r.said.hexdigest() for _, r in done], pa.string()),
        pa.array([r.loss_chars for _, r in done], pa.int64()),
        pa.array([r.learned.hexdigest() for _, r in done], pa.string()),
        pa.array([r.chars for _, r in done], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(
        columns, names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    )
