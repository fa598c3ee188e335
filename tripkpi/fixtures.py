"""A trip-shaped table derived from the ``events`` test table. For tests and benchmarks only.

Every event becomes a trip and some arrive twice. Values get the kinds of dirt a trip feed has:
missing and out-of-period times, drop-offs before pick-ups, over-long trips, bad distances, negative
amounts, impossible passenger counts. Which rows get which dirt follows from the event id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi.spec import TripSpec

YELLOW = TripSpec("yellow", 2024, 1)
GREEN = TripSpec("green", 2025, 1)


def _every(n: int) -> str:
    return f"event_id % {n} = 0"


def trips_from_events(events: DataFrame, spec: TripSpec = YELLOW) -> DataFrame:
    shift = 366 if spec.color == "green" else 0
    arrived = events.selectExpr(
        "event_id",
        "event_type",
        "user_id",
        f"ts + INTERVAL '{shift}' DAY AS ts" if shift else "ts",
        "CAST(rint(value * 100) AS BIGINT) AS cents",
        f"explode(CASE WHEN {_every(101)} THEN array(1, 2) ELSE array(1) END) AS copy",
    )
    return arrived.selectExpr(
        "event_id AS trip_id",
        "event_type AS channel",
        f"""CASE WHEN {_every(107)} THEN NULL
            WHEN {_every(97)} THEN ts - INTERVAL '40' DAY
            ELSE ts END AS {spec.pickup_column}""",
        f"""CASE WHEN {_every(89)} THEN NULL
            WHEN {_every(97)} THEN ts - INTERVAL '40' DAY + INTERVAL '7' MINUTE
            WHEN {_every(79)} THEN ts - INTERVAL '5' MINUTE
            WHEN {_every(73)} THEN ts + INTERVAL '25' HOUR
            ELSE ts + INTERVAL '1' SECOND * CAST(60 + (event_id * 37) % 3541 AS INT)
            END AS {spec.dropoff_column}""",
        f"CASE WHEN {_every(53)} THEN NULL ELSE event_id % 8 END AS passenger_count",
        f"CASE WHEN {_every(71)} THEN 0D ELSE floor(cents / 3) / 100D END AS trip_distance",
        f"(CASE WHEN {_every(83)} THEN -cents ELSE cents END) / 100D AS fare_amount",
        "floor(cents * (user_id % 5) / 20) / 100D AS tip_amount",
        f"""(CASE WHEN {_every(67)} THEN -(cents + 350) ELSE cents + 350 END) / 100D
            AS total_amount""",
        "CASE WHEN event_id % 11 = 7 THEN NULL ELSE event_id % 7 END AS payment_type",
        "user_id % 40 + 1 AS PULocationID",
    )


def odd_amounts(trips: DataFrame) -> DataFrame:
    """The trips with values that sums are hard for: distances of six decimals, tips of either sign
    in thousandths (many halves of a cent), totals up to 1e12."""
    return trips.withColumns({
        "trip_distance": F.expr("(trip_id * 7919 % 90000000 + 1) / 1000000D"),
        "tip_amount": F.expr("(trip_id * 31 % 4001 - 2000) / 1000D"),
        "total_amount": F.expr(
            "CAST(trip_id * 99999989 % 1000000000000 AS DOUBLE) + trip_id % 200 * 5 / 1000D"
        ),
    })


def vast_amounts(trips: DataFrame) -> DataFrame:
    """The trips with totals in cents, some just below what a bigint takes and some beyond it."""
    total = """CASE WHEN pickup_hour = 3 AND trip_id % 40 = 9 THEN 9.1e18D
        WHEN pickup_hour = 5 AND trip_id % 40 = 9 THEN pow(2, 70)
        WHEN pickup_hour = 7 AND trip_id % 40 = 9 THEN pow(2, 997)
        ELSE trip_id % 100000 / 100D END"""
    hour = f"hour({YELLOW.pickup_column})"
    return trips.withColumn("total_amount", F.expr(total.replace("pickup_hour", hour)))


def trips(spark: SparkSession, sf_dir: str, spec: TripSpec = YELLOW) -> DataFrame:
    return trips_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"), spec)
