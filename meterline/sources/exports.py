"""CSV exports for dashboards and their read-back check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterline.layout import CLOCK_COLUMNS


def export_csv(df: DataFrame, location: str, order_by: list[Column | str]) -> None:
    """One ordered CSV file with a header, for results the calendar or a top-k bounds.

    The one-partition exchange keeps the computation before it parallel.
    """
    (
        df.repartition(1)
        .sortWithinPartitions(*order_by)
        .write.mode("overwrite")
        .option("header", True)
        .csv(location)
    )


def read_export(spark: SparkSession, location: str, schema: StructType) -> DataFrame:
    """The export read back strictly: a header or value that does not fit raises."""
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .schema(schema)
        .csv(location)
    )


def export_check(spark: SparkSession, name: str, location: str, expected: DataFrame) -> DataFrame:
    """One row: rows and columns of the export against those of its source.

    Every exported value is parsed with the expected type.  The digests of both sides add up
    a hash per row, so that they agree only when the same rows are on both.
    """
    found = read_export(spark, location, expected.schema)

    def side(df: DataFrame, name: str) -> DataFrame:
        # an empty text and none are the same in a file of this kind
        texts = {field.name for field in expected.schema if field.dataType.simpleString() == "string"}
        values = [
            # the clock of the run differs between the sides, but has to be there
            F.col(c).isNull() if c in CLOCK_COLUMNS else F.coalesce(c, F.lit("")) if c in texts else F.col(c)
            for c in expected.columns
        ]
        return df.select(F.lit(name).alias("side"), F.xxhash64(*values).cast("decimal(20,0)").alias("token"))

    sides = side(found, "exported").unionByName(side(expected, "expected"))
    return sides.agg(
        F.expr("count_if(side = 'expected') AS rows_expected"),
        F.expr("count_if(side = 'exported') AS rows_exported"),
        F.expr("coalesce(sum(IF(side = 'expected', token, -token)), 0) AS difference"),
    ).selectExpr(
        f"'{name}' AS export_name",
        f"{len(found.columns)} AS columns_exported",
        "rows_expected",
        "rows_exported",
        "IF(rows_exported = rows_expected AND difference = 0, 'PASSED', 'FAILED') AS status",
    )
