from datetime import datetime

import pytest
from trips import SPEC, frame, trip

from tripkpi import fixtures
from tripkpi.functions import derive
from tripkpi.operators import profile, quality

GOLDEN = {
    "sf0.001": (1010, 1000, 660),
    "sf0.01": (10100, 10000, 6638),
    "sf0.1": (100991, 100000, 66480),
}

EDGES = [
    trip("good"),
    trip("no pickup", tpep_pickup_datetime=None),
    trip("no dropoff", tpep_dropoff_datetime=None),
    trip("no passengers", passenger_count=None),
    trip("no distance", trip_distance=None),
    trip("no fare", fare_amount=None),
    trip("no total", total_amount=None),
    trip("no tip is fine", tip_amount=None),
    trip("no payment is fine", payment_type=None),
    trip("no zone is fine", PULocationID=None),
    trip("same second", tpep_dropoff_datetime=datetime(2024, 1, 10, 8, 0, 0, 900_000)),
    trip("one second is fine", tpep_dropoff_datetime=datetime(2024, 1, 10, 8, 0, 1)),
    trip("backwards", minutes=-1),
    trip("24 h is fine", minutes=1440),
    trip("over 24 h", tpep_dropoff_datetime=datetime(2024, 1, 11, 8, 0, 1)),
    trip("distance 0", trip_distance=0.0),
    trip("distance 100 is fine", trip_distance=100.0),
    trip("distance over 100", trip_distance=100.01),
    trip("distance nan", trip_distance=float("nan")),
    trip("passengers 0", passenger_count=0),
    trip("passengers 6 is fine", passenger_count=6),
    trip("passengers 7", passenger_count=7),
    trip("fare 0 is fine", fare_amount=0.0),
    trip("fare negative", fare_amount=-0.01),
    trip("total negative", total_amount=-0.01),
    trip("first instant is fine", tpep_pickup_datetime=datetime(2024, 1, 1), minutes=5),
    trip(
        "last instant is fine",
        tpep_pickup_datetime=datetime(2024, 1, 31, 23, 59, 59, 999_999),
        minutes=5,
    ),
    trip("too late", tpep_pickup_datetime=datetime(2024, 2, 1), minutes=5),
    trip(
        "too early", tpep_pickup_datetime=datetime(2023, 12, 31, 23, 59, 59, 999_999), minutes=5
    ),
]


def test_cleaning_keeps_exactly_the_good_edges(spark):
    twice = frame(spark, EDGES + EDGES)
    kept = [row["note"] for row in quality.clean(twice, SPEC).collect()]
    fine = [row["note"] for row in EDGES if row["note"] == "good" or "fine" in row["note"]]
    assert sorted(kept) == sorted(fine)


def test_rules_on_edges(spark):
    got = {
        row["rule"]: row["bad_rows"]
        for row in profile.audit(frame(spark, EDGES), quality.rules(SPEC)).collect()
    }
    assert got == {
        "missing_pickup_ts": 1,
        "missing_dropoff_ts": 1,
        "dropoff_before_or_equal_pickup": 1,
        "duration_min_lte_0": 2,
        "duration_min_gt_24h": 1,
        "trip_distance_lte_0": 1,
        "trip_distance_gt_100": 2,
        "passenger_count_null": 1,
        "passenger_count_out_of_range": 2,
        "fare_amount_negative": 1,
        "total_amount_negative": 1,
        "pickup_outside_2024_01": 2,
    }


def test_derived_columns(spark):
    row = quality.clean(frame(spark, [trip(minutes=1.5)]), SPEC).first()
    assert row["duration_min"] == 1.5
    assert str(row["pickup_date"]) == "2024-01-10"
    assert row["pickup_hour"] == 8


def test_cleaning_twice_changes_nothing(spark):
    once = quality.clean(frame(spark, EDGES), SPEC)
    twice = quality.clean(once, SPEC)
    assert twice.columns == once.columns
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_rejects_and_clean_rows_make_up_the_distinct_rows(spark):
    table = frame(spark, EDGES + EDGES[:5])
    rejects = quality.distinct_rejects(table, SPEC).count()
    cleaned = quality.clean(table, SPEC).count()
    counts = quality.quality_counts(table, SPEC).first()
    assert rejects + cleaned == counts["distinct_rows"] == len(EDGES)
    assert counts["clean_rows"] == cleaned
    assert counts["original_rows"] == len(EDGES) + 5


def test_empty_input(spark):
    nothing = frame(spark, [])
    facts = {
        row["metric"]: row["value"]
        for row in quality.kpi_quality(quality.quality_counts(nothing, SPEC), "x").collect()
    }
    assert facts["quality_score"] == 0.0
    assert facts["removed_pct"] == 0.0
    assert facts["original_rows"] == 0.0
    summary = quality.cleaning_summary(nothing, quality.clean(nothing, SPEC)).first()
    assert tuple(summary) == (0, 0, 0, 0.0)
    audited = profile.audit(nothing, quality.rules(SPEC)).collect()
    assert len(audited) == 12
    assert all(row["bad_rows"] == 0 and row["bad_pct"] == 0.0 for row in audited)


@pytest.mark.parametrize("scale", GOLDEN)
def test_known_counts(spark, scale):
    table = fixtures.trips(spark, f"/root/testdata/{scale}")
    assert tuple(quality.quality_counts(table, SPEC).first()) == GOLDEN[scale]


def test_duration_is_the_difference_of_whole_seconds(spark):
    cases = [
        (datetime(2024, 1, 10, 8, 0, 0, 900_000), datetime(2024, 1, 10, 8, 1, 0, 100_000), 60),
        (datetime(2024, 1, 10, 8, 0, 0, 100_000), datetime(2024, 1, 10, 8, 0, 0, 900_000), 0),
        (datetime(1969, 12, 31, 23, 59, 59, 500_000), datetime(1970, 1, 1, 0, 0, 0, 500_000), 1),
        (datetime(1600, 2, 28, 0, 0, 0, 1), datetime(1600, 3, 1), 2 * 86400),
        (datetime(2024, 3, 10, 1, 30), datetime(2024, 3, 10, 3, 30), 7200),
    ]
    rows = [trip(str(i), tpep_pickup_datetime=a, tpep_dropoff_datetime=b) for i, (a, b, _) in enumerate(cases)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r.note: r.duration_min for r in derive(frame(spark, rows), SPEC).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {str(i): s / 60 for i, (_, _, s) in enumerate(cases)}


def test_bounds_of_duration(spark):
    rows = [trip(str(m), minutes=m) for m in (-1, 0, 1 / 60, 1440, 1440 + 1 / 60, 3000)]
    kept = {r.note for r in quality.clean(frame(spark, rows), SPEC).collect()}
    assert kept == {str(1 / 60), "1440"}
