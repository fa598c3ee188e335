from decimal import ROUND_HALF_UP, Decimal

import pytest
from trips import SPEC, frame, trip

from tripkpi import fixtures
from tripkpi.operators import feeds, kpis, quality
from tripkpi.spec import PAYMENT_LABELS


def cleaned(spark, rows):
    return quality.clean(frame(spark, rows), SPEC)


def values(df):
    return [tuple(row) for row in df.collect()]


def test_means_are_rounded_exactly(spark):
    totals = [1.005, 1.005, 1.005, 2.675, 10.015, 0.1, 0.2]
    rows = [trip(str(i), total_amount=t) for i, t in enumerate(totals)]
    got = kpis.kpi_summary(cleaned(spark, rows)).first()
    exact = sum(Decimal(str(t)) for t in totals)
    cent = Decimal("0.01")
    assert got["total_revenue"] == float(exact.quantize(cent, ROUND_HALF_UP))
    assert got["avg_ticket"] == float((exact / len(totals)).quantize(cent, ROUND_HALF_UP))
    one = kpis.kpi_summary(cleaned(spark, [trip(total_amount=1.005)])).first()
    assert one["avg_ticket"] == 1.01


def test_tips_that_are_missing_do_not_count(spark):
    rows = [trip("a", tip_amount=None), trip("b", tip_amount=3.0)]
    got = kpis.kpi_summary(cleaned(spark, rows)).first()
    assert got["avg_tip"] == 3.0
    assert got["avg_tip_pct"] == 15.0
    none = kpis.kpi_summary(cleaned(spark, rows[:1])).first()
    assert none["avg_tip"] is None
    assert none["avg_tip_pct"] is None


def test_no_fares_no_tip_percent(spark):
    got = kpis.kpi_summary(cleaned(spark, [trip("a", fare_amount=0.0)])).first()
    assert got["avg_tip_pct"] == 0.0


@pytest.mark.parametrize("rolled", [False, True])
def test_empty_input(spark, rolled):
    nothing = cleaned(spark, [])
    nothing = kpis.rollup(nothing) if rolled else nothing
    got = kpis.kpi_summary(nothing).first()
    assert got["total_trips"] == 0
    assert got["avg_tip_pct"] == 0.0
    assert got["total_revenue"] is None
    assert got["avg_ticket"] is None
    assert kpis.kpi_by_day(nothing).count() == 0


def test_values_that_units_cannot_hold(spark):
    huge = kpis.kpi_summary(
        cleaned(spark, [trip("a", total_amount=1e300), trip("b", total_amount=1.0)])
    ).first()
    assert huge["total_revenue"] == 1e300
    assert huge["avg_ticket"] == 5e299
    endless = kpis.kpi_summary(
        cleaned(spark, [trip("a", total_amount=float("inf")), trip("b")])
    ).first()
    assert endless["avg_ticket"] == float("inf")
    odd = kpis.kpi_summary(cleaned(spark, [trip("a", tip_amount=float("nan")), trip("b")])).first()
    assert odd["avg_tip"] != odd["avg_tip"]
    assert odd["avg_tip_pct"] != odd["avg_tip_pct"]
    assert odd["avg_ticket"] == 13.5


def test_payment_types_with_one_label_stay_apart(spark):
    codes = [1, 6, 6, 9, None, 0]
    rows = [trip(str(i), payment_type=c) for i, c in enumerate(codes)]
    trips = cleaned(spark, rows)
    got = [tuple(r)[:3] for r in kpis.kpi_by_payment(trips, PAYMENT_LABELS["yellow"]).collect()]
    assert got == [
        (6, "Voided trip", 2),
        (None, "Other / null", 1),
        (0, "Other / null", 1),
        (1, "Credit card", 1),
        (9, "Other / null", 1),
    ]
    green = {r[0]: r[1] for r in kpis.kpi_by_payment(trips, PAYMENT_LABELS["green"]).collect()}
    assert green[6] == "Other / null"


def test_ties_at_the_cut_are_settled_by_zone(spark):
    rows = [trip(str(zone), PULocationID=zone) for zone in range(25, 0, -1)]
    rows += [trip("again", PULocationID=25)]
    trips = cleaned(spark, rows)
    zones = [row["PULocationID"] for row in kpis.kpi_top_zones(trips).collect()]
    assert zones == [25, *range(1, 20)]
    top10 = feeds.dash_top_zones(kpis.kpi_top_zones(trips)).collect()
    assert [row["PULocationID"] for row in top10] == [25, *range(1, 10)]


TABLES = {
    "summary": kpis.kpi_summary,
    "day": kpis.kpi_by_day,
    "hour": kpis.kpi_by_hour,
    "payment": lambda t: kpis.kpi_by_payment(t, PAYMENT_LABELS["yellow"]),
    "zones": kpis.kpi_top_zones,
    "trips_by_hour": kpis.trips_by_hour,
}


@pytest.fixture(scope="module")
def given_trips(spark):
    raw = fixtures.trips(spark, "/root/testdata/sf0.01")
    trips = quality.clean(raw, SPEC).persist()
    yield raw, trips
    trips.unpersist()


@pytest.mark.parametrize("name", TABLES)
def test_rollup_and_layout_change_nothing(spark, given_trips, name):
    raw, trips = given_trips
    want = values(TABLES[name](trips))
    assert values(TABLES[name](kpis.rollup(trips))) == want
    assert values(TABLES[name](quality.clean(raw.repartition(13), SPEC))) == want


def test_totals_agree(given_trips):
    _, trips = given_trips
    total = kpis.kpi_summary(trips).first()["total_trips"]
    tables = (kpis.kpi_by_day(trips), kpis.kpi_by_hour(trips), TABLES["payment"](trips))
    for table in tables:
        assert sum(row["trips"] for row in table.collect()) == total
    assert kpis.trip_count(kpis.rollup(trips)).first()["clean_rows"] == total


def test_many_periods_at_once(given_trips):
    _, trips = given_trips
    halves = trips.selectExpr("trip_id % 2 AS half", "*")
    for name in ("summary", "day", "zones"):
        function = TABLES[name]
        both = values(function(halves, by=["half"]))
        rolled = values(function(kpis.rollup(halves, ["half"]), by=["half"]))
        assert rolled == both
        for half in (0, 1):
            alone = values(function(trips.filter(f"trip_id % 2 = {half}")))
            assert [row[1:] for row in both if row[0] == half] == alone


def test_card_texts_follow_python(spark):
    summary = spark.createDataFrame(
        [(1234567, 9876543.215, 30.45, 2.25, 1000.5, 0.25, 10.0, 1.35)],
        "total_trips bigint, total_revenue double, avg_ticket double, avg_trip_distance double, "
        "avg_duration_min double, avg_tip double, avg_tip_pct double, avg_passenger_count double",
    )
    row = summary.first()
    got = [(card["value"], card["delta"]) for card in feeds.dash_cards(summary).collect()]
    assert got == [
        (f"{row['total_trips']:,}", None),
        (f"${row['total_revenue']:,.2f}", None),
        (f"${row['avg_ticket']:.2f}", None),
        (f"${row['avg_tip']:.2f}", f"{row['avg_tip_pct']}%"),
        (f"{row['avg_trip_distance']:.2f} mi", None),
        (f"{row['avg_duration_min']:.1f} min", None),
        (f"{row['avg_passenger_count']:.1f}", None),
    ]
