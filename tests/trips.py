"""Hand-made trips: one good trip, and whatever a test changes about it."""

from datetime import datetime, timedelta

from tripkpi.fixtures import YELLOW

SCHEMA = (
    "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count bigint, trip_distance double, fare_amount double, tip_amount double, "
    "total_amount double, payment_type bigint, PULocationID bigint, note string"
)

GOOD = {
    "tpep_pickup_datetime": datetime(2024, 1, 10, 8, 0, 0),
    "tpep_dropoff_datetime": datetime(2024, 1, 10, 8, 30, 0),
    "passenger_count": 1,
    "trip_distance": 2.5,
    "fare_amount": 10.0,
    "tip_amount": 2.0,
    "total_amount": 13.5,
    "payment_type": 1,
    "PULocationID": 7,
}


def trip(note: str = "", minutes: float | None = None, **changes) -> dict:
    row = {**GOOD, "note": note, **changes}
    if minutes is not None:
        row["tpep_dropoff_datetime"] = row["tpep_pickup_datetime"] + timedelta(minutes=minutes)
    return row


def frame(spark, rows):
    return spark.createDataFrame([tuple(row.values()) for row in rows], SCHEMA)


SPEC = YELLOW
