"""What a dashboard shows: cards, series and tables, read from KPI sections.

Texts come out as Python's format() would write them: thousands separated by commas, and rounding
by the exact binary value, which format_number does as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripkpi.functions.text import literal, record, rows

# Fixed value: length of the zone table on the dashboard.
DASHBOARD_ZONES = 10


def _grouped(number: str, digits: int) -> str:
    return f"format_number({number}, {digits})"


def _plain(number: str, digits: int) -> str:
    return f"translate(format_number({number}, {digits}), ',', '')"


# Card titles and formats (title, value, small figure beside it).

_FIRST_CARDS = (
    ("Total Viajes", _grouped("total_trips", 0), "NULL"),
    ("Ingresos Totales", f"'$' || {_grouped('total_revenue', 2)}", "NULL"),
    ("Ticket Promedio", f"'$' || {_plain('avg_ticket', 2)}", "NULL"),
)
_SUMMARY_CARDS = (
    *_FIRST_CARDS,
    ("Propina Promedio", f"'$' || {_plain('avg_tip', 2)}", "CAST(avg_tip_pct AS STRING) || '%'"),
    ("Distancia Promedio", f"{_plain('avg_trip_distance', 2)} || ' mi'", "NULL"),
    ("Duración Promedio", f"{_plain('avg_duration_min', 1)} || ' min'", "NULL"),
    ("Pasajeros Promedio", _plain("avg_passenger_count", 1), "NULL"),
)
_RUN_CARDS = (
    *_FIRST_CARDS,
    ("Calidad", f"{_plain('quality_score * 100', 1)} || '%'", "NULL"),
)

# End of fixed values.


def _cards(cards: tuple[tuple[str, str, str], ...]) -> str:
    return rows(
        [
            record(
                position=str(position),
                card=literal(title),
                value=value,
                delta=f"CAST({delta} AS STRING)",
            )
            for position, (title, value, delta) in enumerate(cards, start=1)
        ]
    )


def _periods(table: DataFrame, own: str) -> list[str]:
    """The period columns that a section of several periods has in front of its own."""
    return table.columns[: table.columns.index(own)]


def dash_cards(summary: DataFrame) -> DataFrame:
    """position, card, value, delta: the seven summary cards as text, for each period."""
    return summary.selectExpr(*_periods(summary, "total_trips"), _cards(_SUMMARY_CARDS))


def dash_run_summary(summary: DataFrame, quality: DataFrame) -> DataFrame:
    """position, card, value, delta: the four cards shown after a run, for each period.

    The quality score is taken from the quality section, where it is kept.
    """
    by = _periods(summary, "total_trips")
    figures = ("total_trips", "total_revenue", "avg_ticket")
    left = summary.selectExpr(*by, *figures, "CAST(NULL AS DOUBLE) AS quality_score")
    right = quality.filter("metric = 'quality_score'").selectExpr(
        *by, "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "value"
    )
    merged = left.union(right).groupBy(*by).agg(
        *[F.max(c).alias(c) for c in (*figures, "quality_score")]
    )
    return merged.selectExpr(*by, _cards(_RUN_CARDS))


def dash_daily_series(by_day: DataFrame) -> DataFrame:
    by = _periods(by_day, "pickup_date")
    return by_day.select(*by, "pickup_date", "trips").orderBy(*by, "pickup_date")


def dash_hourly_series(by_hour: DataFrame) -> DataFrame:
    by = _periods(by_hour, "pickup_hour")
    return by_hour.select(*by, "pickup_hour", "trips").orderBy(*by, "pickup_hour")


def dash_top_zones(top_zones: DataFrame, n: int = DASHBOARD_ZONES) -> DataFrame:
    """The first zones of each period's ranking, which is ranked again as a stored section has no
    order."""
    by = _periods(top_zones, "PULocationID")
    order = [F.desc("trips"), "PULocationID"]
    columns = (*by, "PULocationID", "trips", "revenue", "avg_ticket")
    if not by:
        return top_zones.orderBy(*order).limit(n).select(*columns)
    ranking = Window.partitionBy(*by).orderBy(*order)
    ranked = top_zones.withColumn("__rank", F.row_number().over(ranking)).filter(f"__rank <= {n}")
    return ranked.orderBy(*by, "__rank").select(*columns)


def dash_payment(by_payment: DataFrame) -> DataFrame:
    by = _periods(by_payment, "payment_type")
    return by_payment.select(*by, "payment_type_label", "trips", "revenue", "avg_ticket")


def dash_quality(quality: DataFrame) -> DataFrame:
    return quality.select(*_periods(quality, "metric"), "metric", "value", "value_text")
