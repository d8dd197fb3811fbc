import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from meterline.session import build_session  # noqa: E402

TRIP_SCHEMA = (
    "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count double, "
    "trip_distance double, fare_amount double, total_amount double, tip_amount double, "
    "PULocationID int, DOLocationID int"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="4g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def trips(spark):
    """Builds raw trips from overrides of a good trip."""

    def build(*overrides):
        start = dt.datetime(2023, 3, 15, 10, 0)
        rows = []
        for override in overrides or ({},):
            row = {
                "tpep_pickup_datetime": start,
                "tpep_dropoff_datetime": start + dt.timedelta(minutes=30),
                "passenger_count": 1.0,
                "trip_distance": 10.0,
                "fare_amount": 20.0,
                "total_amount": 25.0,
                "tip_amount": 5.0,
                "PULocationID": 1,
                "DOLocationID": 2,
            } | override
            rows.append(tuple(row.values()))
        return spark.createDataFrame(rows, TRIP_SCHEMA)

    return build


@pytest.fixture(scope="session")
def zones(spark):
    rows = [(1, "  north ", " Alpha"), (2, "north", "Beta "), (3, "South", "Gamma")]
    return spark.createDataFrame(rows, "LocationID int, Borough string, Zone string")
