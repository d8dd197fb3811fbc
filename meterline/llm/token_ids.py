"""Token ids of documents in compressed files, from which any range of ids is read back.

The file format is a Parquet table of shards.  A shard is a run of about half a million ids of the
token stream, in the order of doc_id, kept as a Re-Pair grammar of its own: the rules, the ids
each rule expands to, and the sequence of symbols left.  So a range of ids is decoded from the
shards and symbols that cover it, and nothing else.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import arrow_batches_of, broadcast, received, stored
from meterline.llm.encoding import encoder_of
from meterline.llm.grammar import Grammar, compress

# Fixed value: the id that ends every document.
END_ID = 0
# Ids of a shard; bytes of text that go to a file of shards, and most files.
SHARD_IDS = 1 << 19
FILE_BYTES = 128 << 20
MOST_FILES = 1 << 14
# Rows of text and of shards that a Python task gets at once; bytes of a row group, a few shards, and
# rows after which a writer first looks at them (it waits for 100 otherwise, which may be a whole file).
_TEXT_ROWS, _SHARD_ROWS = 256, 2
_ROW_GROUP = 8 << 20
_LOOKED_AT = 2
# Rows sampled per file to find where in the order each begins.
_SAMPLED = 20

_PARTS = "file int, doc_id long, row long, part int, kind string, ids binary, ends boolean"
# ``pieces`` are the documents of a shard in order; ``whole`` says that all ids of one lie in it.
_SHARDS = (
    "file int, shard int, n_ids long, base long, left binary, right binary, lengths binary, sequence binary, "
    "pieces array<struct<doc_id: long, row: long, n: long, whole: boolean>>"
)
_READ = "file int, shard int, doc_id long, row long, start long, n long, whole boolean, crc long"


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )


def _place(doc_id: int | None, row: int) -> tuple[bool, int, int]:
    return doc_id is not None, doc_id or 0, row


def file_bounds(docs: DataFrame) -> list[tuple[bool, int, int]]:
    """Where each file but the first begins in the order, from a bounded sample of ids.

    Bounds balance the files; they have no effect on what is written.
    """
    keyed = _keyed(docs)
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = min(max(-(-size // FILE_BYTES), docs.sparkSession.sparkContext.defaultParallelism), MOST_FILES)
    sample = keyed.select("doc_id", "row").orderBy(F.xxhash64("row"), "row").limit(_SAMPLED * files).collect()
    places = sorted(_place(row["doc_id"], row["row"]) for row in sample)
    return [places[len(places) * i // files] for i in range(1, files)] if places else []


def encoded(docs: DataFrame, model: str, bounds: list[tuple[bool, int, int]]) -> DataFrame:
    """The ids of every text, the end id last, and its file; very long texts are several rows."""
    sent, sent_bounds = broadcast(docs.sparkSession, model), broadcast(docs.sparkSession, bounds)
    rows = _keyed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bounds = encoder_of(received(sent)), received(sent_bounds)
        for batch in batches:
            keys = [_place(*key) for key in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist())]
            file = pa.array([bisect_right(bounds, key) for key in keys], pa.int32())
            texts, parts, ids, ends = [], [], [], []

            def made() -> pa.RecordBatch:
                kept = [column.take(pa.array(texts)) for column in (file, batch.column("doc_id"), batch.column("row"))]
                arrays = [pa.array(parts, pa.int32()), pa.array([kind] * len(ids))]
                arrays += [pa.array(ids, pa.binary()), pa.array(ends, pa.bool_())]
                return pa.RecordBatch.from_arrays([*kept, *arrays], names)

            kind = "<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
            size, part, before = 0, 0, -1
            for text, found, last in encoder.windows(batch.column("text")):
                part = part + 1 if text == before else 0
                raw = (np.append(found, END_ID) if last else found).astype(kind).tobytes()
                texts.append(text), parts.append(part), ids.append(raw), ends.append(last)
                size, before = size + len(raw), text
                if size > 4 << 20:
                    yield made()
                    texts, parts, ids, ends, size = [], [], [], [], 0
            if texts:
                yield made()

    names = [field.split()[0] for field in _PARTS.split(", ")]
    return rows.mapInArrow(run, _PARTS)


def _shard_row(file: int, shard: int, arrays: list[np.ndarray], pieces: list[dict]) -> dict:
    ids = np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)
    grammar = compress(ids)

    def raw(values: np.ndarray) -> bytes:
        return values.astype("<u4").tobytes()

    return {
        "file": file,
        "shard": shard,
        "n_ids": len(ids),
        "base": grammar.base,
        "left": raw(grammar.left),
        "right": raw(grammar.right),
        "lengths": raw(grammar.lengths),
        "sequence": raw(grammar.sequence),
        "pieces": pieces,
    }


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of about ``SHARD_IDS`` ids as grammars; reads sorted parts, holds one shard."""
    arrays, pieces, size, shard, file = [], [], 0, 0, 0
    schema = pa.schema(
        [("file", pa.int32()), ("shard", pa.int32()), ("n_ids", pa.int64()), ("base", pa.int64())]
        + [(name, pa.binary()) for name in ("left", "right", "lengths", "sequence")]
        + [("pieces", pa.list_(pa.struct([("doc_id", pa.int64()), ("row", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_())])))]
    )

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([_shard_row(file, shard, arrays, pieces)], schema)

    for batch in batches:
        raw = batch.column("ids")
        for at, row in enumerate(batch.drop_columns("ids").to_pylist()):
            file, ids = row["file"], np.frombuffer(raw[at].as_buffer(), row["kind"])
            if row["part"] and pieces:
                pieces[-1]["n"] += len(ids)
                if row["ends"]:
                    pieces[-1]["whole"] = pieces[-1]["whole"] is None
            else:  # a part that follows a full shard belongs to a document that is not whole here
                whole = False if row["part"] else (True if row["ends"] else None)
                pieces.append({"doc_id": row["doc_id"], "row": row["row"], "n": len(ids), "whole": whole})
            arrays.append(ids)
            size += len(ids)
            if size >= SHARD_IDS:
                pieces[-1]["whole"] = bool(pieces[-1]["whole"])
                yield made()
                arrays, pieces, size, shard = [], [], 0, shard + 1
    if pieces:
        yield made()


def write_token_ids(docs: DataFrame, path: str, model: str) -> None:
    """Write the ids of all documents to ``path`` in ascending order of doc_id.

    ``model`` is the text of a tokenizer file of the tokenizers library.  Null texts are empty,
    an empty text is its end id alone.  Rows of one id follow each other in the order they are
    read in; a null id comes first.  Other columns of ``docs`` are not read.  Texts of any
    length are encoded in windows, so memory holds a window and a shard.
    """
    bounds = file_bounds(docs)
    parts = encoded(docs, model, bounds).repartitionById(len(bounds) + 1, F.col("file"))
    ordered = parts.sortWithinPartitions("file", "doc_id", "row", "part")
    writer = ordered.mapInArrow(_shards, _SHARDS).write.option("compression", "zstd")
    with arrow_batches_of(docs.sparkSession, _TEXT_ROWS):
        writer = writer.option("parquet.block.size", _ROW_GROUP)
        writer.option("parquet.page.size.row.check.min", _LOOKED_AT).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(file, before): the ids of all files before each; the driver sees one row per file."""
    rows, before = [], 0
    for row in sorted(shards.groupBy("file").agg(F.sum("n_ids").alias("n")).collect()):
        rows.append((row["file"], before))
        before += row["n"]
    return shards.sparkSession.createDataFrame(rows, "file int, before long")


def _grammar(row: dict) -> Grammar:
    arrays = [np.frombuffer(row[name], "<u4").astype(np.int64) for name in ("left", "right", "lengths", "sequence")]
    return Grammar(row["base"], *arrays)


def read_token_pieces(spark: SparkSession, path: str) -> DataFrame:
    """What each shard holds of each document: its ids' number, checksum, and place in the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                raw, start, rows = _grammar(row).ids().astype("<u4"), 0, []
                for piece in row["pieces"]:
                    crc = zlib.crc32(raw[start : start + piece["n"]].tobytes())
                    rows.append({"file": row["file"], "shard": row["shard"], "start": start, "crc": crc} | piece)
                    start += piece["n"]
                yield pa.RecordBatch.from_pylist(rows, schema)

    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in _READ.split(", "))])
    return spark.read.schema(_SHARDS).parquet(path).mapInArrow(run, _READ)


def ids_between(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """The ids from ``start`` up to ``stop`` of the whole stream, decoded from the shards that cover them."""
    shards = spark.read.schema(_SHARDS).parquet(path)
    files = shard_starts(shards.select("file", "n_ids"))
    sizes = shards.select("file", "shard", "n_ids").join(files, "file")
    earlier = "coalesce(sum(n_ids) OVER (PARTITION BY file ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    placed = sizes.withColumn("first", F.col("before") + F.expr(earlier))
    wanted = placed.filter((F.col("first") < stop) & (F.col("first") + F.col("n_ids") > start))
    found = shards.drop("n_ids", "pieces").join(wanted.select("file", "shard", "first"), ["file", "shard"])
    parts = [
        _grammar(row.asDict()).ids(start - row["first"], stop - row["first"])
        for row in found.orderBy("first").toLocalIterator()
    ]
    return np.concatenate([np.zeros(0, np.int64), *parts])


def token_report(docs: DataFrame, path: str, model: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files that are written to ``path``.

    ``start`` is the number of ids of all documents before it, the checksum is the unsigned crc32
    of its ids as little-endian 32-bit numbers.
    """
    spark = docs.sparkSession
    write_token_ids(docs, path, model)
    with arrow_batches_of(spark, _SHARD_ROWS, read_too=True):
        pieces = stored(read_token_pieces(spark, path), "pieces")
    shards = spark.read.schema(_SHARDS).parquet(path)
    sizes = shards.select("file", "shard", "n_ids")
    earlier = "coalesce(sum(n_ids) OVER (PARTITION BY file ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    placed = sizes.join(shard_starts(sizes), "file").select("file", "shard", (F.col("before") + F.expr(earlier)).alias("_first"))
    pieces = pieces.join(placed, ["file", "shard"]).withColumn("start", F.col("_first") + F.col("start"))
    whole = pieces.filter("whole").select("doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    # one row per shard that a long document touches
    torn = pieces.filter(~F.col("whole")).groupBy("file", "row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("start", "n", "crc"))).alias("parts")
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                crc, n = 0, 0
                for part in row["parts"]:
                    crc, n = crc32_of_both(crc, part["crc"], 4 * part["n"]), n + part["n"]
                rows.append((row["doc_id"], row["parts"][0]["start"], n, crc))
            columns = list(zip(*rows)) or [()] * 4
            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return whole.unionByName(torn.select("doc_id", "parts").mapInArrow(joined, schema))


def crc32_of_both(first: int, second: int, second_bytes: int) -> int:
    """The crc32 of two byte strings joined, from the crc32 of each and the length of the second.

    Zero bytes after the first act on its checksum as a linear map over bits, which is applied
    by repeated squaring.
    """
    def apply(columns: list[int], value: int) -> int:
        result = 0
        for i in range(32):
            if value >> i & 1:
                result ^= columns[i]
        return result

    # what one zero byte makes of each bit: crc32 without its inversions
    step = [zlib.crc32(b"\0", 1 << i ^ 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(32)]
    zero = zlib.crc32(b"\0", 0xFFFFFFFF) ^ 0xFFFFFFFF
    step = [column ^ zero for column in step]
    while second_bytes:
        if second_bytes & 1:
            first = apply(step, first)
        step = [apply(step, column) for column in step]
        second_bytes >>= 1
    return first ^ second
