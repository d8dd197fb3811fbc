"""Reading, storing and numbering shared by the training-data operators."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.session import pin_session, shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return pin_session(spark).read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` is called so, letter case aside."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which also cuts its lineage."""
    path = f"{shared_folder(df.sparkSession)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        for location in {file.rpartition("/")[0] for file in frame.inputFiles()}:
            if "/llm/" in location:
                path = spark._jvm.org.apache.hadoop.fs.Path(location)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list[Column], name: str, label: str) -> DataFrame:
    """``df`` with a gapless number from 0 in the given order, without a one-task window.

    The rows are range-partitioned, sorted and stored with their place in their partition,
    and only one count per partition reaches the driver.  The order must name enough columns
    to spread equal keys: rows that tie in all of them land in one partition.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, shuffle_partitions(df.sparkSession))
    keys = {f"_order{i}": column for i, column in enumerate(order)}
    placed = stored(
        df.withColumns(keys)
        .repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_stored_place", F.monotonically_increasing_id())
        .drop(*keys),
        label,
    )
    # the upper bits of the place are the partition, the lower 33 the position in it
    part, position = F.shiftright("_stored_place", 33), F.col("_stored_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = {row["part"]: row["n"] for row in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    offsets, seen = {}, 0
    for number in sorted(counts):
        offsets[number], seen = seen, seen + counts[number]
    if not offsets:
        return placed.withColumn(name, F.lit(0).cast("long")).drop("_stored_place")
    start = F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair])[part]
    return placed.withColumn(name, (start + position).cast("long")).drop("_stored_place")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_arrow(df: DataFrame, function, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` of a function of one record batch to one record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(run, schema)


@contextmanager
def arrow_batches_of(spark: SparkSession, rows: int, read_too: bool = False) -> Iterator[None]:
    """Actions whose Python tasks get at most so many rows at once, for rows that are large.

    With ``read_too`` columns of stored tables are read by so many rows as well.
    """
    settings = ["spark.sql.execution.arrow.maxRecordsPerBatch"]
    settings += ["spark.sql.parquet.columnarReaderBatchSize"] if read_too else []
    before = {name: spark.conf.get(name) for name in settings}
    for name in settings:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def broadcast(spark: SparkSession, value: object) -> Broadcast:
    """A value of bounded size for all tasks, pickled so that its classes travel with it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


_received: dict[int, object] = {}


def received(value: Broadcast) -> object:
    """The broadcast value, unpickled once per function that a task runs."""
    if id(value) not in _received:
        _received[id(value)] = pickle.loads(value.value)
    return _received[id(value)]


def row_slices(batch: pa.RecordBatch, column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows whose texts together stay near ``most_bytes``.

    One row is never cut: a text above the limit is a slice of its own.
    """
    lengths = [x or 0 for x in pa.compute.binary_length(batch.column(column)).to_pylist()]
    first, size = 0, 0
    for row, length in enumerate(lengths):
        if row > first and size + length > most_bytes:
            yield batch.slice(first, row - first)
            first, size = row, 0
        size += length
    if batch.num_rows > first:
        yield batch.slice(first)
