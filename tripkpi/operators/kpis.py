"""KPI tables.

Every KPI is built from sums, so each function takes either clean trips or a ``rollup`` of them and
gives the same result, to the last digit: sums of whole units do not depend on how rows are grouped
on the way. A job that needs several tables rolls the trips up once.

``by`` names extra key columns (such as colour, year and month) to compute many periods at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.functions.derive import derive, payment_label
from tripkpi.functions.exact import Measure, percent_of
from tripkpi.operators.quality import COPIES, KINDS, VALID
from tripkpi.spec import TripSpec

TOTAL = Measure("total", "total_amount")
DISTANCE = Measure("distance", "trip_distance")
MINUTES = Measure("minutes", "duration_min", per_one=60, whole=True)
TIP = Measure("tip", "tip_amount")
FARE = Measure("fare", "fare_amount")
PASSENGERS = Measure("passengers", "passenger_count")
MEASURES = (TOTAL, DISTANCE, MINUTES, TIP, FARE, PASSENGERS)

TIME_KEYS = ("pickup_date", "pickup_hour")
PLACE_KEYS = ("payment_type", "PULocationID")

TRIPS = "trip_rows"
IS_PLACE = "is_place_sum"

# Fixed value: length of the pick-up zone ranking.
TOP_ZONES = 20

# Fixed values from here on: the column names of the tables.
_TRIPS = f"{TRIPS} AS trips"
_REVENUE = (f"{TOTAL.total()} AS revenue", f"{TOTAL.mean()} AS avg_ticket")
_LENGTH = (f"{DISTANCE.mean()} AS avg_trip_distance", f"{MINUTES.mean()} AS avg_duration_min")
_TIP = f"{TIP.mean()} AS avg_tip"


def trip_parts(
    trips: DataFrame, by: Sequence[str] = (), measures: Sequence[Measure] = MEASURES
) -> DataFrame:
    """Trips as keys and summable parts."""
    parts = [part for measure in measures for part in measure.parts()]
    return trips.selectExpr(*by, *TIME_KEYS, *PLACE_KEYS, f"1L AS {TRIPS}", *parts)


def _sums(measures: Sequence[Measure]) -> list[Column]:
    columns = [f"coalesce(sum({TRIPS}), 0L) AS {TRIPS}"]
    columns += [column for measure in measures for column in measure.sums()]
    return [F.expr(column) for column in columns]


def rollup(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trips, or parts of them, summed per date and hour and per payment type and zone.

    All KPI tables can be taken from these some thousand rows per month. Both sets of sums come from
    one pass; one set over all four keys would have about as many groups as a month has trips.
    """
    parts = trips if TRIPS in trips.columns else trip_parts(trips, by)
    sets = [[*by, *TIME_KEYS], [*by, *PLACE_KEYS]]
    grouped = parts.groupingSets(sets, *by, *TIME_KEYS, *PLACE_KEYS)
    return grouped.agg(F.expr(f"grouping(pickup_date) = 1 AS {IS_PLACE}"), *_sums(MEASURES))


# Columns of a judged rollup beside those of a rollup.
ORIGINAL, DISTINCT = "original_rows", "distinct_rows"


def judged_parts(judged: DataFrame, spec: TripSpec, by: Sequence[str] = ()) -> DataFrame:
    """Judged rows as keys and summable parts. Rejected rows have no keys but ``by``: they are counted
    only, and their dates are anything."""
    own = [*by, VALID, COPIES, KINDS]
    keys = [f"IF({VALID}, {key}, NULL) AS {key}" for key in (*TIME_KEYS, *PLACE_KEYS)]
    parts = [part for measure in MEASURES for part in measure.parts()]
    return derive(judged, spec).selectExpr(*own, *keys, f"1L AS {TRIPS}", *parts)


def judged_rollup(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rollup of valid and of rejected rows, with the rows and distinct rows behind each line."""
    sets = [[*by, VALID, *TIME_KEYS], [*by, VALID, *PLACE_KEYS]]
    grouped = parts.groupingSets(sets, *by, VALID, *TIME_KEYS, *PLACE_KEYS)
    counts = (f"sum({COPIES}) AS {ORIGINAL}", f"sum({KINDS}) AS {DISTINCT}")
    place = F.expr(f"grouping(pickup_date) = 1 AS {IS_PLACE}")
    return grouped.agg(place, *map(F.expr, counts), *_sums(MEASURES))


def valid_rollup(judged: DataFrame) -> DataFrame:
    """The rollup of the clean set alone, as ``rollup`` gives it."""
    return judged.filter(VALID).drop(VALID, ORIGINAL, DISTINCT)


def judged_counts(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """original_rows, distinct_rows and clean_rows from a judged rollup."""
    sums = (
        f"coalesce(sum({ORIGINAL}), 0L) AS {ORIGINAL}",
        f"coalesce(sum({DISTINCT}), 0L) AS {DISTINCT}",
        f"coalesce(sum(IF({VALID}, {TRIPS}, 0L)), 0L) AS clean_rows",
    )
    return judged.filter(f"NOT {IS_PLACE}").groupBy(*by).agg(*map(F.expr, sums))


def _summed(
    trips: DataFrame, keys: Sequence[str], by: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Sums per key from trips, or from the fitting half of a rollup."""
    if IS_PLACE in trips.columns:
        of_place = any(key in PLACE_KEYS for key in keys)
        parts = trips.filter(IS_PLACE if of_place else f"NOT {IS_PLACE}")
    else:
        parts = trip_parts(trips, by, measures)
    return parts.groupBy(*by, *keys).agg(*_sums(measures))


def trip_count(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """clean_rows: the number of trips."""
    return _summed(trips, (), by, ()).selectExpr(*by, f"{TRIPS} AS clean_rows")


def kpi_summary(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Eight overall KPIs."""
    return _summed(trips, (), by, MEASURES).selectExpr(
        *by,
        f"{TRIPS} AS total_trips",
        f"{TOTAL.total()} AS total_revenue",
        f"{TOTAL.mean()} AS avg_ticket",
        *_LENGTH,
        _TIP,
        f"{percent_of(TIP, FARE)} AS avg_tip_pct",
        f"{PASSENGERS.mean()} AS avg_passenger_count",
    )


def _by_time(trips: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    times = _summed(trips, (key,), by, (TOTAL, DISTANCE, MINUTES, TIP))
    return times.selectExpr(*by, key, _TRIPS, *_REVENUE, *_LENGTH, _TIP).orderBy(*by, key)


def kpi_by_day(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _by_time(trips, "pickup_date", by)


def kpi_by_hour(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _by_time(trips, "pickup_hour", by)


def kpi_by_payment(
    trips: DataFrame, labels: Mapping[int, str] | str, by: Sequence[str] = ()
) -> DataFrame:
    """KPIs per payment type, busiest first.

    The label follows from the type, so it is put on the few result rows. Types that share a label
    stay apart. ``labels`` may be an expression, for labels that differ between periods.
    """
    label = labels if isinstance(labels, str) else payment_label(labels)
    types = _summed(trips, ("payment_type",), by, (TOTAL, TIP))
    shown = types.selectExpr(
        *by, "payment_type", f"{label} AS payment_type_label", _TRIPS, *_REVENUE, _TIP
    )
    return shown.orderBy(*by, F.desc("trips"), "payment_type")


def kpi_top_zones(trips: DataFrame, n: int = TOP_ZONES, by: Sequence[str] = ()) -> DataFrame:
    """The n pick-up zones with most trips; equal counts are ranked by zone id."""
    zones = _summed(trips, ("PULocationID",), by, (TOTAL, DISTANCE, MINUTES))
    shown = zones.selectExpr(*by, "PULocationID", _TRIPS, *_REVENUE, *_LENGTH)
    if not by:
        return shown.orderBy(F.desc("trips"), "PULocationID").limit(n)
    ranking = Window.partitionBy(*by).orderBy(F.desc("trips"), "PULocationID")
    ranked = shown.withColumn("__rank", F.row_number().over(ranking)).filter(f"__rank <= {n}")
    return ranked.drop("__rank").orderBy(*by, F.desc("trips"), "PULocationID")


def trips_by_hour(trips: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The exploratory hourly table: trips and three means."""
    hours = _summed(trips, ("pickup_hour",), by, (TOTAL, DISTANCE, MINUTES))
    ticket = f"{TOTAL.mean()} AS avg_total_amount"
    shown = hours.selectExpr(*by, "pickup_hour", _TRIPS, *_LENGTH, ticket)
    return shown.orderBy(*by, "pickup_hour")
