"""Benchmark decontamination: a multi-pattern search that shifts over impossible positions.

The letters of the search are words.  A pattern is a window of benchmark words.  A table
tells for each block of two words how far the search may move on; where that is zero, the
windows ending in that block are compared, first word hash by word hash, then as text.
Many texts are searched in step, long ones from several places at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import broadcast, map_arrow, received, row_slices, stored, unused
from meterline.llm.words import ALNUM, U64, Words, find_words, mix

WINDOW = 10
# Windows that one search holds; a larger benchmark is searched in blocks, one after another.
BLOCK_WINDOWS = 200_000
_TABLE_BITS = 18
_SEGMENT = 256

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _block(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(first * U64(0x9E3779B97F4A7C15) + last)


@dataclass
class Patterns:
    """Windows of one length with their shift table and suffix buckets."""

    length: int
    texts: list[bytes] = field(default_factory=list)
    items: list[set[str]] = field(default_factory=list)
    hashes: list[np.ndarray] = field(default_factory=list)
    known: dict[bytes, int] = field(default_factory=dict)

    def add(self, text: bytes, hashes: np.ndarray, item: str) -> None:
        at = self.known.setdefault(text, len(self.texts))
        if at == len(self.texts):
            self.texts.append(text)
            self.items.append(set())
            self.hashes.append(hashes)
        self.items[at].add(item)

    def finish(self) -> Patterns:
        """Build the tables; a one-word window has blocks of that word alone."""
        self.matrix = np.array(self.hashes, U64).reshape(len(self.texts), self.length)
        self.known = {}
        self.hashes = []
        self.width = min(2, self.length)
        self.shift = np.full(1 << _TABLE_BITS, self.length - self.width + 1, np.int32)
        for end in range(self.width - 1, self.length):
            blocks = self.blocks(self.matrix.reshape(-1), np.arange(len(self.texts)) * self.length + end)
            np.minimum.at(self.shift, self.slot(blocks), self.length - 1 - end)
        suffix = self.blocks(self.matrix.reshape(-1), np.arange(1, len(self.texts) + 1) * self.length - 1)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        return self

    def blocks(self, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
        return _block(hashes[at - 1], hashes[at]) if self.width == 2 else mix(hashes[at])

    @staticmethod
    def slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> U64(64 - _TABLE_BITS)).astype(np.int64)

    def candidates(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Last words of windows that the shift table does not rule out."""
        starts, limits = [], []
        for low, high in zip(first[:-1] + self.length - 1, first[1:]):
            cuts = np.arange(low, high, _SEGMENT)
            starts.append(cuts)
            limits.append(np.minimum(cuts + _SEGMENT, high))
        if not starts:
            return np.zeros(0, np.int64)
        at, limit, found = np.concatenate(starts), np.concatenate(limits), []
        while len(at):
            move = self.shift[self.slot(self.blocks(hashes, at))]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
            inside = at < limit
            at, limit = at[inside], limit[inside]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def search(self, words: Words, hashes: np.ndarray) -> list[tuple[int, int]]:
        """Windows found as (first word, pattern)."""
        ends = self.candidates(hashes, words.first)
        blocks = self.blocks(hashes, ends) if len(ends) else np.zeros(0, U64)
        low, high = np.searchsorted(self.suffix, blocks), np.searchsorted(self.suffix, blocks, side="right")
        ends, low, count = ends[high > low], low[high > low], (high - low)[high > low]
        starts = np.repeat(ends, count) - self.length + 1
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        patterns = self.order[np.repeat(low, count) + within] if len(starts) else within
        for i in range(self.length):
            same = hashes[starts + i] == self.matrix[patterns, i]
            starts, patterns = starts[same], patterns[same]
        return [
            (start, pattern)
            for start, pattern in zip(starts.tolist(), patterns.tolist())
            if b" ".join(words.text(start + i) for i in range(self.length)) == self.texts[pattern]
        ]


def compile_patterns(rows: list, window: int = WINDOW) -> list[Patterns]:
    """Windows of the given (item_id, text) rows by length; an item shorter than a window is one."""
    kinds: dict[int, Patterns] = {}
    words = find_words(pa.array([row[1] for row in rows], pa.string()), ALNUM)
    hashes = words.hashes()
    for row, low, high in zip(rows, words.first[:-1], words.first[1:]):
        length = int(min(window, high - low))
        for at in range(low, high - length + 1) if length else ():
            text = b" ".join(words.text(at + i) for i in range(length))
            item = "" if row[0] is None else str(row[0])
            kinds.setdefault(length, Patterns(length)).add(text, hashes[at : at + length], item)
    return [kind.finish() for kind in kinds.values()]


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def search_texts(texts: pa.Array, kinds: list[Patterns]) -> list[dict]:
    """Per text its number of words, the merged spans of hit words, and the items found."""
    words = find_words(texts, ALNUM)
    hashes = words.hashes()
    found = [{"n_words": int(n), "spans": [], "items": set()} for n in words.counts]
    for kind in kinds:
        hits = kind.search(words, hashes)
        owners = np.searchsorted(words.first, [start for start, _ in hits], side="right") - 1
        for (start, pattern), owner in zip(hits, owners):
            low = int(words.first[owner])
            found[owner]["spans"].append([start - low, start - low + kind.length])
            found[owner]["items"] |= kind.items[pattern]
    return [x | {"spans": _merged(x["spans"]), "items": sorted(x["items"])} for x in found]


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """Rows of ``docs`` with ``_found``: n_words, spans of hit words, items with a window in the text.

    Null and empty texts have no words; an empty benchmark hits nothing; a null item id counts
    as the empty string; items with the same id are one.  Other columns stay as they are; the new one gets underscores
    behind its name until no column has it.
    The benchmark reaches the tasks in blocks of about ``block_windows`` windows at most.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").filter(F.length("text") > 0)
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // (2 * block_windows)) or 1  # a word and its separator are two characters at least
    rows = docs.select(F.struct("*").alias("_row"), "text", F.lit(None).cast(FOUND).alias("_found"))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        kinds = broadcast(spark, compile_patterns([tuple(row) for row in part], window))

        def scan(batch: pa.RecordBatch, kinds=kinds) -> pa.RecordBatch:
            patterns, found = received(kinds), []
            for piece in row_slices(batch, "text"):
                found += search_texts(piece.column("text"), patterns)
            for new, old in zip(found, batch.column("_found").to_pylist()):
                if old:
                    new["spans"] = _merged(new["spans"] + old["spans"])
                    new["items"] = sorted({*new["items"], *old["items"]})
            kind = batch.schema.field("_found").type
            at = batch.schema.get_field_index("_found")
            return batch.set_column(at, "_found", pa.array(found, kind))

        rows = map_arrow(rows, scan, rows.schema)
        if block + 1 < blocks:
            rows = stored(rows, "searched")
    return rows.select("_row.*", F.col("_found").alias(unused(docs, "_found")))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents without any benchmark window, in the columns of ``docs``."""
    found = unused(docs, "_found")
    return benchmark_hits(docs, benchmark, window).filter(F.size(f"{found}.items") == 0).drop(found)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, and a digest of the items found in it."""
    found = F.col("_found")
    hit = F.aggregate(found["spans"], F.lit(0).cast("long"), lambda total, span: total + span[1] - span[0])
    return benchmark_hits(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        hit.alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
