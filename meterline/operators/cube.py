"""Dashboard slices from stored sums over sets of dimensions, without a look at the trips.

The sums are exact and can be added up, so a slice is answered by the smallest stored set that
has the dimensions it filters and groups by.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.calendar import weekday_name
from meterline.operators.marts import sliced
from meterline.operators.rollups import grouped_measures

DAY, HOUR, WEEKDAY, BOROUGH = "pickup_date", "pickup_hour", "day_of_week", "PU_Borough"
# The sets that are stored.  A day implies its weekday, so no set has both.
SETS = tuple(
    tuple(name for name in (first, HOUR if hour else None, BOROUGH if borough else None) if name)
    for first in (DAY, WEEKDAY, None)
    for hour in (True, False)
    for borough in (True, False)
)


def set_name(dimensions: Iterable[str]) -> str:
    return "+".join(sorted(dimensions)) or "all"


def cube_sums(sums: DataFrame) -> DataFrame:
    """Sums by day, hour and borough added up over every set, in one pass over them.

    ``cube_set`` names the set a row belongs to; dimensions outside of it are null there, so a
    trip without a borough is not taken for a total.
    """
    rows = sums.withColumn(WEEKDAY, F.dayofweek(DAY))
    dimensions = (DAY, HOUR, WEEKDAY, BOROUGH)
    measures = [name for name in sums.columns if name not in (*dimensions, "month")]
    grouped = rows.groupingSets([list(map(F.col, names)) for names in SETS], *dimensions).agg(
        F.grouping_id(*dimensions).alias("_set"), *[F.sum(name).alias(name) for name in measures]
    )
    # the grouping id has a one, from the left, for each dimension that is summed over
    number = {sum(1 << i for i, name in enumerate(reversed(dimensions)) if name not in names): names for names in SETS}
    label = F.create_map(*[F.lit(x) for key, names in number.items() for x in (key, set_name(names))])
    return grouped.withColumn("cube_set", label[F.col("_set").cast("int")]).drop("_set")


def needed_dimensions(
    by: Iterable[str], dates: object = None, hours: object = None, weekdays: object = None, boroughs: object = None
) -> frozenset[str]:
    """Dimensions that grouping and filters use; the weekday follows from the day."""
    used = {DAY: dates, HOUR: hours, WEEKDAY: weekdays, BOROUGH: boroughs}
    needed = {name for name, value in used.items() if value} | set(by)
    return frozenset(needed - {WEEKDAY} if DAY in needed else needed)


def smallest_set(needed: frozenset[str], sizes: dict[str, int]) -> str:
    """The stored set with the fewest rows that has all dimensions (or the day for the weekday)."""
    fitting = [
        set_name(names)
        for names in SETS
        if all(name in names or (name == WEEKDAY and DAY in names) for name in needed) and set_name(names) in sizes
    ]
    if not fitting:
        raise KeyError(f"no stored set has {sorted(needed)}")
    return min(fitting, key=lambda name: (sizes[name], name))


def set_sizes(cube: DataFrame) -> dict[str, int]:
    """Rows of each stored set; at most one row per set reaches the driver."""
    return {row["cube_set"]: row["count"] for row in cube.groupBy("cube_set").count().collect()}


def cube_slice(
    cube: DataFrame,
    by: tuple[str, ...],
    measures: tuple[str, ...],
    dates: tuple[dt.date, dt.date] | None = None,
    hours: tuple[int, int] | None = None,
    weekdays: tuple[str, ...] | None = None,
    boroughs: tuple[str, ...] | None = None,
    sizes: dict[str, int] | None = None,
) -> DataFrame:
    """Measures by some dimensions under the dashboard's slicers, from the smallest fitting set.

    Filtering on boroughs leaves out trips without one.  ``sizes`` saves counting the sets.
    """
    needed = needed_dimensions(by, dates, hours, weekdays, boroughs)
    chosen = smallest_set(needed, set_sizes(cube) if sizes is None else sizes)
    rows = cube.filter(F.col("cube_set") == chosen)
    if weekdays and DAY not in chosen:
        rows = rows.filter(weekday_name(WEEKDAY).isin(*weekdays))
        weekdays = None
    if WEEKDAY in by and DAY in chosen:
        rows = rows.withColumn(WEEKDAY, F.dayofweek(DAY))
    return grouped_measures(sliced(rows, dates, hours, weekdays, boroughs), by, measures, merged=True)
