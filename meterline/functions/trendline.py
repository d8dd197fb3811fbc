"""Least-squares line from exact integer sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fit_line(x: str, y: str, over: str = "") -> dict[str, Column]:
    """``slope``, ``mean_x`` and ``mean_y`` of integer columns without nulls.

    The sums are decimals without fraction, so the line does not depend on row
    order; ``mean_y + slope * (x - mean_x)`` evaluates it.  The slope is null
    when all x are equal.
    """

    def total(value: str) -> str:
        return f"CAST(sum({value}) {over} AS DECIMAL(38,0))"

    x, y = f"CAST({x} AS DECIMAL(18,0))", f"CAST({y} AS DECIMAL(18,0))"
    n, sum_x, sum_y = total("1"), total(x), total(y)
    rise = f"CAST({n} * {total(f'{x} * {y}')} - {sum_x} * {sum_y} AS DOUBLE)"
    run = f"CAST({n} * {total(f'{x} * {x}')} - {sum_x} * {sum_x} AS DOUBLE)"

    def ratio(above: str, below: str) -> Column:
        return F.expr(f"try_divide({above}, {below})")

    return {
        "slope": ratio(rise, run),
        "mean_x": ratio(f"CAST({sum_x} AS DOUBLE)", f"CAST({n} AS DOUBLE)"),
        "mean_y": ratio(f"CAST({sum_y} AS DOUBLE)", f"CAST({n} AS DOUBLE)"),
    }
