"""Chat formatting: typed content parts flattened into ordered text with placeholders.

A visitor walks the parts of a message.  Text is escaped; an image, an audio clip or a
document becomes a numbered placeholder, and what it refers to and how many tokens it
will expand to are recorded beside the text.  The format of a turn is

    <|im_start|>ROLE\\n BODY <|im_end|>\\n

without the blanks.  Inside bodies and roles every ``<``, backslashes, ``|`` gets one more
backslash, so no text can hold a control string, and taking one backslash away undoes it.
In roles, backslashes and line ends are escaped too.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_TOKEN = re.compile(r"\w+|[^\w\s]")
_PLACE = re.compile(r"<\|(image|audio|document):(\d+)\|>")
LEARNED_ROLE = "assistant"

PIECE = (
    "conv_id long, turn long, formatted string, loss_start long, loss_end long, n_tokens long, "
    "attachments array<struct<number:long,kind:string,reference:string,tokens:long>>"
)


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    plain = re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", role)
    return unescape(plain)


@dataclass
class Flattener:
    """Visitor of the content parts of one message; ``text`` and ``attachments`` are what it made.

    Token counts: one per patch of 28 by 28 pixels, 25 per second of sound, 600 per page of
    a document, one at least each; words and marks count one each in text.
    """

    text: list[str] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    tokens: int = 0

    def visit(self, part: object) -> None:
        """A part is a mapping with a ``type``; anything else, and an unknown type, is text."""
        kind = part.get("type") if isinstance(part, dict) else None
        if kind in ("image", "audio", "document"):
            getattr(self, f"visit_{kind}")(part)
        else:
            text = part.get("text", json.dumps(part, ensure_ascii=False)) if isinstance(part, dict) else part
            self.visit_text("" if text is None else str(text))

    def visit_text(self, text: str) -> None:
        self.text.append(escape(text))
        self.tokens += sum(1 for _ in _TOKEN.finditer(text))

    def visit_image(self, part: dict) -> None:
        self.place(part, -(-_size(part, "width") // 28) * -(-_size(part, "height") // 28))

    def visit_audio(self, part: dict) -> None:
        self.place(part, -(-_size(part, "seconds") * 25 // 1))

    def visit_document(self, part: dict) -> None:
        self.place(part, _size(part, "pages") * 600)

    def place(self, part: dict, tokens: float) -> None:
        number, tokens = len(self.attachments) + 1, max(1, int(tokens))
        self.text.append(f"<|{part['type']}:{number}|>")
        reference = part.get("ref")
        self.attachments.append(
            {
                "number": number,
                "kind": part["type"],
                "reference": None if reference is None else str(reference),
                "tokens": tokens,
            }
        )
        self.tokens += tokens


def _size(part: dict, name: str) -> float:
    value = part.get(name)
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    return value if number and 0 < value < float("inf") else 1


def content_parts(content: str | None, typed: bool) -> list:
    """The parts of a message: the text itself, or when ``typed`` the list that its JSON holds."""
    if typed and content:
        try:
            parts = json.loads(content)
        except ValueError:
            return [content]
        return parts if isinstance(parts, list) else [content]
    return [content]


def format_message(role: str | None, content: str | None, typed: bool = False) -> dict:
    """One turn: formatted text, the span of it under the loss mask, tokens and attachments."""
    flat = Flattener()
    for part in content_parts(content, typed):
        flat.visit(part)
    head, body = f"{START}{escape_role(role or '')}\n", "".join(flat.text)
    learned = role == LEARNED_ROLE
    return {
        "formatted": f"{head}{body}{END}",
        "loss_start": len(head) if learned else 0,
        "loss_end": len(head) + len(body) if learned else 0,
        "n_tokens": flat.tokens,
        "attachments": flat.attachments,
    }


def formatted_turns(turns: DataFrame, typed: bool = False) -> DataFrame:
    """One row per row of (conv_id, turn, role, text), formatted; each row by itself.

    Null roles and texts count as empty, null turns come first, null conversations form one
    conversation, and repeated rows stay.  ``loss_start`` to ``loss_end`` are code points
    of ``formatted`` that a model is to learn, for assistant turns their body.
    With ``typed`` a text that is a JSON list holds content parts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [format_message(*pair, typed) for pair in zip(*(batch.column(c).to_pylist() for c in ("role", "text")))]
            kind = pa.list_(
                pa.struct(
                    [("number", pa.int64()), ("kind", pa.string()), ("reference", pa.string()), ("tokens", pa.int64())]
                )
            )
            made = [pa.array([r[c] for r in rows], pa.string() if c == "formatted" else pa.int64()) for c in _MADE]
            listed = pa.array([r["attachments"] for r in rows], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), *made, listed],
                ["conv_id", "turn", *_MADE, "attachments"],
            )

    wanted = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return wanted.mapInArrow(run, PIECE)


_MADE = ["formatted", "loss_start", "loss_end", "n_tokens"]


class _Reader:
    """What is read back from the formatted turns of one conversation, turn after turn."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str, loss_start: int, loss_end: int) -> None:
        self.chars += len(piece)
        end = 0
        for match in _TURN.finditer(piece):
            if match.start() != end:
                break
            end = match.end()
            self.turns += 1
            self.all.update(f"{unescape_role(match[1])}\n{unescape(match[2])}\n".encode())
        if end != len(piece):
            raise ValueError(f"conversation {self.conv_id}: not a sequence of turns")
        learned = unescape(piece[loss_start:loss_end])
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def conversation_digests(pieces: DataFrame) -> DataFrame:
    """Per conversation what its formatted turns hold, read back from their text.

    The turns of a conversation are streamed in order through one task, a turn at a time,
    because a digest of a text has to be taken from its start; nothing of a conversation
    is kept but the state of two digests and three counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in DIGEST.split(", ")]
        reader = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss_start", "loss_end")]
            for conv_id, piece, start, end in zip(*columns):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv_id)
                reader.add(piece, start, end)
            if done:
                yield _digest_batch(done, names)
        if reader is not None:
            yield _digest_batch([reader.row()], names)

    ordered = (
        pieces.select("conv_id", "turn", "formatted", "loss_start", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "formatted")
    )
    return ordered.mapInArrow(run, DIGEST)


def _digest_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string() if "sha256" in name else pa.int64() for name in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
