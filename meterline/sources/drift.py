"""What differs between the schemas of monthly sources, and the narrowest types that hold all."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAME, WIDENED, RESPELLED, ABSENT = "same", "widened", "respelled", "absent"
REPORT_SCHEMA = "column_name string, source string, source_column string, source_type string, common_type string, change string"

_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19)))
_MOST_DIGITS = 38


def common_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The least type that holds the values of both; text holds any plain value.

    Whole numbers widen among themselves.  With a fraction on either side, a decimal holds both
    if it has the digits, else a double does, and a float only what fits its 24 bits.
    """
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    pair = {type(left), type(right)}
    if left in _DIGITS and right in _DIGITS:
        return max(left, right, key=_DIGITS.__getitem__)
    if T.DecimalType in pair and pair <= {T.DecimalType, *map(type, _WHOLE)}:
        return _common_decimal(*[_as_decimal(x) for x in (left, right)])
    if pair <= {T.FloatType, T.ByteType, T.ShortType}:
        return T.FloatType()
    if pair <= {T.FloatType, T.DoubleType, T.DecimalType, *map(type, _WHOLE)}:
        return T.DoubleType()
    if pair == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if pair <= {T.DateType, T.TimestampType, T.TimestampNTZType}:
        return T.TimestampType()
    nested = (T.StructType, T.ArrayType, T.MapType)
    if any(isinstance(x, nested) for x in (left, right)):
        raise TypeError(f"{left.simpleString()} and {right.simpleString()} have no common type")
    return T.StringType()


def _as_decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(_DIGITS[kind], 0)


def _common_decimal(left: T.DecimalType, right: T.DecimalType) -> T.DataType:
    scale = max(left.scale, right.scale)
    digits = max(left.precision - left.scale, right.precision - right.scale) + scale
    return T.DecimalType(digits, scale) if digits <= _MOST_DIGITS else T.DoubleType()


def common_schema(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns of all schemas in order of appearance, letter case aside, with their common types."""
    found: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            key = field.name.lower()
            known = found.get(key)
            kind = field.dataType if known is None else common_type(known.dataType, field.dataType)
            found[key] = T.StructField(field.name if known is None else known.name, kind)
    return T.StructType(list(found.values()))


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of a common schema; those it lacks are null."""
    own = {name.lower(): name for name in df.columns}

    def column(field: T.StructField) -> Column:
        name = own.get(field.name.lower())
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        return value.cast(field.dataType).alias(field.name)

    return df.select(*map(column, schema))


def schema_changes(schemas: Mapping[str, T.StructType]) -> list[tuple]:
    """Per column of any source and per source: its type there, the common one, and what that means."""
    common, rows = common_schema(schemas.values()), []
    for field in common:
        for source, schema in schemas.items():
            own = next((x for x in schema if x.name.lower() == field.name.lower()), None)
            kinds = (own.dataType.simpleString() if own else None, field.dataType.simpleString())
            if own is None:
                change = ABSENT
            elif own.dataType != field.dataType:
                change = WIDENED
            else:
                change = SAME if own.name == field.name else RESPELLED
            rows.append((field.name, source, own.name if own else None, *kinds, change))
    return rows


def drift_report(spark: SparkSession, schemas: Mapping[str, T.StructType]) -> DataFrame:
    """:func:`schema_changes` as a table, a row per column and source."""
    return spark.createDataFrame(schema_changes(schemas), REPORT_SCHEMA)
