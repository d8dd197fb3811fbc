"""Personal data: fixed patterns, and what a character tagger finds beyond them.

The tagger learns from windows of documents in which the patterns have labelled spans.
Texts are read in overlapping windows; each window is decoded by itself, and for every
character the window in which it lies most centrally decides.  A span of any kind holds a
digit or an at sign, so windows without either are outside by definition and are not run.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import broadcast, received, unused
from meterline.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
WINDOW = 64
STRIDE = 32
# Windows the tagger learns from at most, half of them with a labelled span, and rounds.
MOST_WINDOWS = 1_600
ROUNDS = 12
# What the scores of a span must be above those of the outside on average, and its least length.
MARGIN = 4.0
SHORTEST = 7
# Windows run through the network at once.
ROWS = 2_048

# The base patterns.  Looking behind for a digit changes no match, as a run of
# digits always matches from its start, and keeps long runs from being tried at every digit.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """An at sign is in no local part, so each is tried once, with the whole run before it."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and _LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            yield start, match.end()
            last = match.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, leftmost and non-overlapping per kind."""
    if not _TRIGGER.search(text):
        return []
    found = [(start, 0, end) for start, end in _emails(text)]
    for match in _IP.finditer(text):
        parts = [part.lstrip("0") for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            found.append((match.start(), 1, match.end()))
    for match in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", match[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), 2, match.end()))
    for match in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(match[0])) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


# characters and tags --------------------------------------------------------------

# Classes: 0 beside the text, 1 digit, 2 lower, 3 upper, 4 beyond ASCII, 5 white space, 6
# other control, and one for each remaining mark.
_MARKS = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
CLASSES = 7 + len(_MARKS)
_CLASS = np.full(128, 6, np.int8)
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 1, 2, 3
_CLASS[[9, 10, 11, 12, 13, 32]] = 5
for _i, _mark in enumerate(_MARKS):
    _CLASS[ord(_mark)] = 7 + _i
_AT = int(_CLASS[ord("@")])

# Tag 0 is outside; kind k has 1 + 2k for its first character and 2 + 2k for the others.
TAGS = 1 + 2 * len(KINDS)
ALLOWED = np.ones((TAGS + 1, TAGS), bool)
for _k in range(len(KINDS)):
    ALLOWED[:, 2 + 2 * _k] = False
    ALLOWED[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = True
    # a window may begin inside a span
    ALLOWED[TAGS, 2 + 2 * _k] = True


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], 4).astype(np.int8)


def window_starts(classes: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold a digit or an at sign."""
    triggers = np.flatnonzero((classes == 1) | (classes == _AT))
    steps = np.unique(triggers // STRIDE)
    per = WINDOW // STRIDE
    starts = np.unique((steps[:, None] - np.arange(per)).ravel())
    return starts[starts > -per] * STRIDE


def windows_of(classes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([np.zeros(WINDOW, np.int8), classes, np.zeros(WINDOW, np.int8)])
    return padded[starts[:, None] + WINDOW + np.arange(WINDOW)]


def tags_of(size: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Tags of a text; where spans of two kinds overlap, the earlier kind has it."""
    tags = np.zeros(size, np.int8)
    for start, kind, end in sorted(spans, key=lambda s: (-s[1], s[0])):
        tags[start:end] = 2 + 2 * kind
        tags[start] = 1 + 2 * kind
    return tags


def labelled_windows(text: str) -> Iterator[tuple[bytes, bytes, bool]]:
    """Windows of a text with their tags and whether they hold a labelled span."""
    if not _TRIGGER.search(text):
        return
    classes = classes_of(text)
    starts = window_starts(classes)
    padded = np.concatenate([np.zeros(WINDOW, np.int8), tags_of(len(classes), base_spans(text)), np.zeros(WINDOW, np.int8)])
    tags = padded[starts[:, None] + WINDOW + np.arange(WINDOW)]
    for row, tag in zip(windows_of(classes, starts), tags):
        yield row.tobytes(), tag.tobytes(), bool(tag.any())


def tagged_spans(tags: np.ndarray, margins: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of one kind whose scores are ``MARGIN`` above the outside on average."""
    kinds = (tags.astype(int) + 1) // 2
    new = np.ones(len(tags), bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (tags[1:] % 2 == 1)
    edges = np.append(np.flatnonzero(new), len(tags))
    for start, end in zip(edges[:-1], edges[1:]):
        if kinds[start] and end - start >= SHORTEST and margins[start:end].mean() >= MARGIN:
            yield int(start), int(kinds[start]) - 1, int(end)


def _stitched(pieces: list[np.ndarray], tagger: Tagger) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its tags and margins, each character's from the window that has it most centrally."""
    starts = [window_starts(classes) for classes in pieces]
    rows = np.concatenate([windows_of(*pair) for pair in zip(pieces, starts)])
    decoded, scores = map(
        np.concatenate, zip(*(tagger.decode(rows[low : low + ROWS], ALLOWED) for low in range(0, len(rows), ROWS)))
    )
    # a window decides for its middle; the ends of it are asked only where no other window is
    middle = slice((WINDOW - STRIDE) // 2, (WINDOW + STRIDE) // 2)
    done = 0
    for classes, own in zip(pieces, starts):
        tags, margins = np.zeros(len(classes) + 2 * WINDOW, np.int8), np.zeros(len(classes) + 2 * WINDOW)
        at = own[:, None] + WINDOW + np.arange(WINDOW)
        mine = slice(done, done + len(own))
        for part in (slice(None), middle):
            tags[at[:, part]] = decoded[mine, part]
            margins[at[:, part]] = scores[mine, part]
        done += len(own)
        yield tags[WINDOW:-WINDOW], margins[WINDOW:-WINDOW]


def read_texts(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Spans that the tagger finds in each text, windows of many texts run together."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    waiting: list[int] = []
    pieces: list[np.ndarray] = []

    def finish() -> None:
        for i, classes, (tags, margins) in zip(waiting, pieces, _stitched(pieces, tagger)):
            triggers = np.append(0, np.cumsum((classes == 1) | (classes == _AT)))
            found[i] = [s for s in tagged_spans(tags, margins) if triggers[s[2]] > triggers[s[0]]]
        waiting.clear()
        pieces.clear()

    for i, text in enumerate(texts):
        if _TRIGGER.search(text):
            waiting.append(i)
            pieces.append(classes_of(text))
            if sum(map(len, pieces)) >= ROWS * STRIDE:
                finish()
    if pieces:
        finish()
    return found


def all_spans(base: list[tuple[int, int, int]], more: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Base spans and those of the tagger that overlap none of them, by start and kind."""
    ordered = sorted(base)
    starts, ends = [b[0] for b in ordered], [0, *accumulate((b[2] for b in ordered), max)]
    # of the base spans that start before the end of a span, the one that ends last may reach into it
    apart = [s for s in more if ends[bisect_left(starts, s[2])] <= s[0]]
    return sorted([*base, *apart])


# jobs -----------------------------------------------------------------------------


def learned_tagger(docs: DataFrame, most: int = MOST_WINDOWS) -> Tagger | None:
    """A tagger fitted on at most ``most`` windows, chosen by hash; None without labelled spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row for text in batch.column("text").to_pylist() if text for row in labelled_windows(text)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["row", "tags", "labelled"])

    windows = docs.select("text").filter(F.col("text").rlike("[0-9@]"))
    windows = windows.mapInArrow(run, "row binary, tags binary, labelled boolean")
    chosen = []
    for labelled in (True, False):
        some = windows.filter(F.col("labelled") == labelled).dropDuplicates(["row", "tags"])
        chosen += some.orderBy(F.xxhash64("row"), "row", "tags").limit(most // 2).collect()
    if not any(row["labelled"] for row in chosen):
        return None
    tagger = Tagger(CLASSES, TAGS)
    rows, tags = (
        np.array([np.frombuffer(bytes(row[name]), np.int8) for row in chosen]).astype(np.int64) for name in ("row", "tags")
    )
    tagger.fit(rows, tags, ROUNDS)
    tagger.weights = {name: weight.astype(np.float32) for name, weight in tagger.weights.items()}
    return tagger


def personal_data(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` with ``_private``: base and all spans (start, kind, end) in code points.

    Null texts count as empty.  Rows are read by themselves, so repeated ones have equal spans.
    Other columns stay as they are; the new one gets underscores behind its name until no column has it.
    """
    kind = "struct<base:array<struct<start:long,kind:string,end:long>>,spans:array<struct<start:long,kind:string,end:long>>>"
    model = broadcast(docs.sparkSession, learned_tagger(docs))
    rows = docs.select(F.struct("*").alias("_row"), "text", F.lit(None).cast(kind).alias("_private"))

    def named(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"start": start, "kind": KINDS[number], "end": end} for start, number, end in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = received(model)
        for batch in batches:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            base = [base_spans(text) for text in texts]
            more = read_texts(texts, tagger) if tagger else [[] for _ in texts]
            made = [{"base": named(b), "spans": named(all_spans(b, m))} for b, m in zip(base, more)]
            at = batch.schema.get_field_index("_private")
            yield batch.set_column(at, "_private", pa.array(made, batch.schema.field("_private").type))

    return rows.mapInArrow(run, rows.schema).select("_row.*", F.col("_private").alias(unused(docs, "_private")))


def privacy_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as text."""
    private = F.col("_private")

    def digest(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter(private["base"], lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return personal_data(docs.select("doc_id", "text")).select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(digest(private["base"]), 256).alias("base_sha256"),
        digest(private["spans"]).alias("spans"),
    )
