"""Zone lookup preparation and the two zone joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.layout import SILVER
from meterline.operators.stamps import tag


class DuplicateZoneError(ValueError):
    """A zone id occurs more than once, so the join would multiply trips."""


def tidy_zones(zones: DataFrame) -> DataFrame:
    return zones.withColumns(
        {
            "LocationID": F.expr("try_cast(LocationID AS INT)"),
            "Borough": F.expr("upper(trim(Borough))"),
            "Zone": F.expr("trim(Zone)"),
        }
    )


def checked_zones(zones: DataFrame) -> DataFrame:
    """Tidy zones ready to be joined: ids proven unique by a distributed aggregate.

    There is no hint: the optimizer broadcasts the lookup by its bytes or shuffles the joins.
    """
    tidy = tidy_zones(zones)
    counts = tidy.filter("LocationID IS NOT NULL").groupBy("LocationID").count()
    if not counts.filter("count > 1").isEmpty():
        raise DuplicateZoneError("a zone id occurs more than once in the lookup")
    return tidy


def attach_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Left-join borough and zone names for pickup and dropoff.

    ``zones`` comes from :func:`checked_zones`.  Trips without a match stay, with
    null names.
    """
    for side, trip_key in (("PU", "PULocationID"), ("DO", "DOLocationID")):
        names = zones.selectExpr(
            "LocationID AS _zone_id", f"Borough AS {side}_Borough", f"Zone AS {side}_Zone"
        )
        trips = trips.join(names, F.expr(f"{trip_key} = _zone_id"), "left").drop("_zone_id")
    return trips


def silver_trips(features: DataFrame, zones: DataFrame) -> DataFrame:
    return tag(attach_zones(features, zones), SILVER, "_transformation_timestamp")
