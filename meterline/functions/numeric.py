"""Rounding and order-independent sums as built-in expressions.

``round`` on a double goes through a decimal string for every value and a decimal
``sum`` keeps a big-integer buffer; both dominate a scan of trips.  The helpers
below give the same numbers from long and double arithmetic that stays inside
whole-stage codegen.  They take and build SQL text, so a measure is parsed in one
call instead of being assembled operator by operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Below this magnitude, and this far from a tie, value * 10^k is accurate enough
# to know which way the decimal rounding goes.
_FAST_LIMIT = "1e6D"
_TIE_GAP = "1e-6D"

# Sums run over whole units split at bit 20, so neither half can overflow a long
# even when a single group holds trillions of rows.
_SPLIT_BITS = 20
_SPLIT = 1 << _SPLIT_BITS
_UNIT_LIMIT = f"{1 << 46}D"

# Units in one of each measure.
CENTS = 100
THOUSANDTHS = 1000
MICROS = 1_000_000
SECONDS_PER_MINUTE = 60


def round_half_up(x: str, digits: int) -> Column:
    """``round(x, digits)`` for a double column, value for value, at a fraction of the cost.

    Near a tie, for large magnitudes, NaN and infinities the built-in decides.
    ``x`` is evaluated several times, so it should be a plain column.
    """
    scaled = f"({x} * {10**digits}D)"
    clear = f"abs({x}) < {_FAST_LIMIT} AND abs({scaled} - floor({scaled}) - 0.5D) > {_TIE_GAP}"
    # adding 0 turns the -0.0 of a tiny negative value into 0.0
    fast = f"(rint({scaled}) + 0D) / {10**digits}D"
    return F.expr(f"CASE WHEN {clear} THEN {fast} ELSE round({x}, {digits}) END")


def unit_sums(x: str, per_one: int) -> dict[str, str]:
    """The aggregates an exact sum is made of: two integer halves and a remainder.

    Each can be summed again, so groups can be merged into larger groups.
    """
    units = f"rint({x} * {per_one}D)"
    countable = f"abs({units}) < {_UNIT_LIMIT}"
    whole = f"CASE WHEN {countable} THEN CAST({units} AS BIGINT) END"
    return {
        "high": f"sum(shiftright({whole}, {_SPLIT_BITS}))",
        "low": f"sum(({whole}) & {_SPLIT - 1})",
        "rest": f"sum(CASE WHEN NOT ({countable}) THEN {x} END)",
    }


def total_of(high: str, low: str, rest: str, per_one: int) -> str:
    """The sum as a double from its three aggregates."""
    counted = f"(CAST({high} AS DOUBLE) * {_SPLIT}D + CAST({low} AS DOUBLE)) / {per_one}D"
    return f"CASE WHEN {rest} IS NULL THEN {counted} ELSE coalesce({counted}, 0D) + {rest} END"


def _exact_sum(x: str, per_one: int, over: str) -> str:
    return total_of(*[f"{part} {over}" for part in unit_sums(x, per_one).values()], per_one)


def _rounded(sql: str, digits: int | None) -> Column:
    return F.expr(sql if digits is None else f"round({sql}, {digits})")


def exact_sum(x: str, per_one: int, digits: int | None = None, over: str = "") -> Column:
    """Sum of a double measured in whole units of ``1/per_one``, optionally rounded.

    Integer addition makes the result independent of row order, partitioning and
    retries.  Values without an exact unit count (NaN, infinite, absurdly large)
    are summed as doubles and added, so they still reach the result.  ``over`` is
    a window clause.
    """
    return _rounded(_exact_sum(x, per_one, over), digits)


def exact_mean(x: str, per_one: int, digits: int | None = None, over: str = "") -> Column:
    """Mean of the non-null values, on top of :func:`exact_sum`; null when there is none."""
    return _rounded(f"try_divide({_exact_sum(x, per_one, over)}, count({x}) {over})", digits)


def percent(part: str, whole: str, digits: int = 2) -> Column:
    """``part / whole`` in percent, rounded; null when the whole is zero."""
    return F.expr(f"round(try_divide({part}, {whole}) * 100, {digits})")
