"""Near-duplicate embeddings by binary codes of randomly rotated vectors.

A unit vector o is rotated at random and each coordinate keeps its sign.  The code, a corner
of a cube scaled to length 1, has an inner product f with o, which is stored beside it.  For
any vector q, <code, q> / f is an unbiased estimate of <o, q> whose error stays below
``BOUND`` * sqrt((1 - f^2) / f^2 / (dimension - 1)) almost surely; several rotations are
averaged.  Pairs whose upper bound is below the threshold are dropped, and the others are
recomputed exactly.  Which pairs are looked at follows from tables of bits of the codes:
vectors of one label that agree in all bits of one of the tables meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import forget, stored
from meterline.llm.components import components

LIMIT = 0.93
# Bits of a code that tables and the first sorting-out use.
CODE_BITS = 256
BOUND = 4.0
# Vectors of a label that share a bucket on average, and how rarely a pair may be in no table.
BUCKET = 16
MISSED = 1e-5
# Standard errors by which agreeing bits may fall short of what the limit makes expect.
CODE_ERRORS = 6.0
_WORDS = [f"s{i}" for i in range(CODE_BITS // 64)]
_CODED = "class_id long, factors array<float>, signs binary, " + ", ".join(f"{name} long" for name in _WORDS)


_rotations: dict[int, np.ndarray] = {}


def rotations(dimension: int) -> np.ndarray:
    """Random rotations, one above the other, with ``CODE_BITS`` rows at least."""
    if dimension not in _rotations:
        draw = np.random.default_rng(dimension)
        squares = [draw.standard_normal((dimension, dimension)) for _ in range(-(-CODE_BITS // dimension))]
        _rotations[dimension] = np.concatenate([np.linalg.qr(square)[0].T for square in squares])
    return _rotations[dimension]


def unit_vectors(column: pa.Array) -> list[np.ndarray]:
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bounds = column.offsets.to_numpy()
    rows = [values[low:high] for low, high in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0])]
    return [row / np.linalg.norm(row) for row in rows]


def encode(vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs of all rotated coordinates, and per rotation the inner product of code and vector."""
    rotated = rotations(len(vector)) @ vector
    factors = np.abs(rotated.reshape(-1, len(vector))).sum(1) / math.sqrt(len(vector))
    return rotated > 0, factors


def estimate(
    signs: np.ndarray, factors: np.ndarray, rotated: np.ndarray, dimension: int
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of coded with rotated vectors, and how far they may be off.

    ``signs`` and ``rotated`` have a row per pair, ``factors`` also a column per rotation.
    """
    products = np.where(signs, rotated, -rotated).reshape(len(rotated), -1, dimension).sum(2) / math.sqrt(dimension)
    spread = (1 - np.minimum(factors, 1) ** 2) / factors**2 / max(dimension - 1, 1)
    return (products / factors).mean(1), BOUND * np.sqrt(spread.mean(1) / factors.shape[1])


def _used(dimension: int) -> int:
    """Rotations that an estimate is made from."""
    return max(CODE_BITS // dimension, 1)


def _coded(classes: DataFrame) -> DataFrame:
    names = [part.split()[0] for part in _CODED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = [encode(vector) for vector in unit_vectors(batch.column("embedding"))]
            bits = np.stack([signs[:CODE_BITS] for signs, _ in codes])
            words = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            factors = pa.array([f.astype(np.float32) for _, f in codes], pa.list_(pa.float32()))
            # whole rotations, one at least: these are what the estimate is made from
            whole = [s[: len(s) // len(f) * _used(len(s) // len(f))] for s, f in codes]
            packed = pa.array([np.packbits(x, bitorder="little").tobytes() for x in whole], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("class_id"), factors, packed, *(pa.array(words[:, i]) for i in range(len(_WORDS)))], names
            )

    return classes.select("class_id", "embedding").mapInArrow(run, _CODED)


def table_shape(largest: int) -> tuple[int, int]:
    """Bits per table and tables, for a label of ``largest`` vectors.

    Two vectors at the limit agree in a bit with probability 1 - angle / pi, so the number of
    tables follows from how rarely a pair may be missed.
    """
    bits = min(max(math.ceil(math.log2(max(largest, 1) / BUCKET)), 4), 24)
    agree = (1 - math.acos(LIMIT) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log(1 - agree))


def _bucket(table: int, bits: int) -> Column:
    chosen = np.random.default_rng(table).choice(CODE_BITS, bits, replace=False)
    masks = [sum(1 << int(bit % 64) for bit in chosen if bit // 64 == word) for word in range(len(_WORDS))]
    signed = [mask - (1 << 64) if mask >> 63 else mask for mask in masks]
    parts = [F.col(name).bitwiseAND(F.lit(mask)) for name, mask in zip(_WORDS, signed) if mask]
    return F.xxhash64(F.lit(table), "label", "size", *parts)


def _candidates(coded: DataFrame, largest: int) -> DataFrame:
    """Pairs (a < b) that share a bucket of a table and differ in few bits."""
    bits, tables = table_shape(largest)
    angle = math.acos(LIMIT) / math.pi
    most = CODE_BITS * angle + CODE_ERRORS * math.sqrt(CODE_BITS * angle * (1 - angle))
    rows = coded.select(
        "class_id", "label", "size", *_WORDS, F.explode(F.array(*[_bucket(t, bits) for t in range(tables)])).alias("_at")
    )
    other = rows.select("_at", *[F.col(name).alias(f"o_{name}") for name in ("class_id", "label", "size", *_WORDS)])
    differing = sum(
        (F.bit_count(F.col(name).bitwiseXOR(F.col(f"o_{name}"))) for name in _WORDS[1:]),
        F.bit_count(F.col(_WORDS[0]).bitwiseXOR(F.col(f"o_{_WORDS[0]}"))),
    )
    near = (
        (F.col("class_id") < F.col("o_class_id"))
        & (F.col("label") == F.col("o_label"))
        & (F.col("size") == F.col("o_size"))
        & (differing <= most)
    )
    pairs = rows.join(other, "_at").filter(near)
    return pairs.select(F.col("class_id").alias("a"), F.col("o_class_id").alias("b")).distinct()


def _same_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by length: (row numbers, matrix of unit vectors)."""
    vectors = unit_vectors(column)
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, np.stack([vectors[i] for i in rows])


def _estimated(pairs: DataFrame) -> DataFrame:
    """Pairs whose upper bound, from the code of a and the vector of b, reaches the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = np.zeros(batch.num_rows, bool)
            packed = batch.column("signs")
            factors = batch.column("factors").to_pylist()
            for rows, other in _same_length(batch.column("embedding")):
                dimension = other.shape[1]
                whole = _used(dimension)
                stored_signs = np.stack([np.frombuffer(packed[i].as_buffer(), np.uint8) for i in rows.tolist()])
                signs = np.unpackbits(stored_signs, axis=1, count=whole * dimension, bitorder="little").astype(bool)
                known = np.array([factors[i][:whole] for i in rows], np.float64)
                rotated = other @ rotations(dimension)[: whole * dimension].T
                value, error = estimate(signs, known, rotated, dimension)
                keep[rows] = value + error >= LIMIT
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a long, b long")


def _exact(pairs: DataFrame) -> DataFrame:
    """Pairs whose cosine in double precision reaches the limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keep = np.zeros(batch.num_rows, bool)
            left = _plain(batch.column("left"))
            right = _plain(batch.column("embedding"))
            for i, (x, y) in enumerate(zip(left, right)):
                keep[i] = x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= LIMIT
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a long, b long")


def _plain(column: pa.Array) -> list[np.ndarray]:
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    bounds = column.offsets.to_numpy() - column.offsets[0].as_py()
    return [values[low:high] for low, high in zip(bounds[:-1], bounds[1:])]


def embedding_links(classes: DataFrame) -> DataFrame:
    """Pairs (a < b) of class ids with the same label and a cosine of ``LIMIT`` at least.

    ``classes`` holds distinct valid vectors: class_id, label, embedding.
    """
    keyed = classes.select("class_id", "label", F.size("embedding").alias("size"))
    codes = stored(_coded(classes).join(keyed, "class_id"), "codes")
    largest = codes.groupBy("label", "size").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    pairs = stored(_candidates(codes, largest), "pairs")
    vectors = classes.select("class_id", "embedding")
    coded = codes.select(F.col("class_id").alias("a"), "factors", "signs")
    aimed = pairs.join(coded, "a").join(vectors.withColumnRenamed("class_id", "b"), "b")
    near = stored(_estimated(aimed), "near")
    both = near.join(vectors.toDF("a", "left"), "a").join(vectors.withColumnRenamed("class_id", "b"), "b")
    links = stored(_exact(both.select("a", "b", "left", "embedding")), "links")
    forget(codes, pairs, near)
    return links


def near_duplicate_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of (vec_id, embedding, label).

    Linked are vectors of one label and length with a cosine of ``LIMIT`` at least.  A vector
    that is null, zero, or holds a null or a value that is not finite, and one without label,
    is linked with nothing.  Equal vectors are compared as one and count as often as they
    occur.  Repeated ids are vectors of their own; a component is named by its smallest id and
    a row without id is kept only when there is none.
    """
    number = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    valid = F.coalesce(F.col("label").isNotNull() & finite & nonzero, F.lit(False))
    rows = vectors.select("vec_id", "label", number.alias("embedding"), valid.alias("_valid"))
    keys = ["label", "_key1", "_key2"]
    rows = rows.withColumns({"_key1": F.xxhash64("embedding"), "_key2": F.xxhash64(F.lit(1), "embedding")})
    usable = rows.filter("_valid")
    found = usable.groupBy(*keys).agg(
        F.first("embedding").alias("embedding"), F.count("*").alias("n"), F.min("vec_id").alias("least_id")
    )
    classes = stored(found.withColumn("class_id", F.monotonically_increasing_id()), "classes")
    links = embedding_links(classes)
    sizes = classes.select(F.col("class_id").alias("b"), "n")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degrees = both.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "class_id")
    roots = components(links).toDF("class_id", "_root")
    grouped = classes.drop("embedding").join(roots, "class_id", "left").join(degrees, "class_id", "left")
    grouped = grouped.withColumn("_root", F.coalesce("_root", "class_id"))
    least = grouped.groupBy("_root").agg(F.min("least_id").alias("component_id"))
    named = grouped.join(least, "_root").select(
        *keys, "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    linked = usable.select("vec_id", *keys).join(stored(named, "named"), keys).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("_valid")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
