"""Sort keys that keep rows near each other which are near in several columns.

Every column is cut into ranges that hold about as many rows, and the bits of the range numbers
are interleaved.  Files cut along this key are narrow in each of the columns, so that a filter on
any one of them skips most files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits per column: 255 cuts.
BITS = 8
_ACCURACY = 10_000


def _number(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    if kind == "date":
        return F.unix_date(column)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return F.col(column).cast("double") if kind == "float" or kind.startswith("decimal") else F.col(column)
    raise TypeError(f"{column} is {kind}: only numbers, dates and times have ranges here")


def range_cuts(df: DataFrame, columns: tuple[str, ...], bits: int = BITS) -> list[list]:
    """Values that cut each column into ``2 ** bits`` ranges of about as many rows, from one pass."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(_number(df, column), shares, _ACCURACY) for column in columns]).first()
    return [list(found) if found is not None else [] for found in cuts]


def _range_number(value: Column, cuts: list, bits: int) -> Column:
    """How many cuts do not exceed the value, by halving; a null comes before all."""
    if not cuts:
        return F.lit(0)
    listed, steps = F.array(*map(F.lit, cuts)), F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(value >= F.element_at(listed, at + step), at + step).otherwise(at)
    )


def interleaved_key(df: DataFrame, columns: tuple[str, ...], bits: int = BITS) -> Column:
    """The interleaved bits of the range numbers of ``columns``, the first column's bit first.

    Takes one aggregate pass over the columns, of which a bounded number of cuts comes back.
    """
    if not 0 < len(columns) * bits < 63:
        raise ValueError("the bits of all columns have to fit a long")
    cuts = range_cuts(df, columns, bits)
    numbers = F.array(*[_range_number(_number(df, column), found, bits) for column, found in zip(columns, cuts)])
    # one element, so that each number is computed once and used once per bit
    return F.transform(F.array(numbers), lambda found: _interleaved(found, len(columns), bits))[0]


def _interleaved(numbers: Column, columns: int, bits: int) -> Column:
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for i in range(columns):
            one = F.shiftright(numbers[i], bit).bitwiseAND(F.lit(1)).cast("long")
            key = key + F.shiftleft(one, bit * columns + columns - 1 - i)
    return key
