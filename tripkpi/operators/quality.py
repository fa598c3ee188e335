"""Data-quality rules, cleaning, and what cleaning removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.functions.derive import derive, trip_columns, trip_seconds
from tripkpi.functions.text import literal, name, record, rows
from tripkpi.operators.profile import row_kinds
from tripkpi.spec import (
    MAX_DISTANCE,
    MAX_MINUTES,
    MAX_PASSENGERS,
    MIN_PASSENGERS,
    TripSpec,
)


def in_period(spec: TripSpec) -> str:
    """Pick-up in the spec's month. Typed bounds let the comparison reach the Parquet scan."""
    pickup = trip_columns(spec)["pickup_ts"]
    start, end = f"TIMESTAMP_NTZ '{spec.start}'", f"TIMESTAMP_NTZ '{spec.end}'"
    return f"({pickup} >= {start} AND {pickup} < {end})"


def in_own_period(spec: TripSpec, year: str = "year", month: str = "month") -> str:
    """Pick-up in the month that two columns of the row name; of ``spec`` only the colour counts."""
    pickup = trip_columns(spec)["pickup_ts"]
    start = f"make_timestamp_ntz({year}, {month}, 1, 0, 0, 0)"
    return f"({pickup} >= {start} AND {pickup} < {start} + INTERVAL '1' MONTH)"


# The names of the rules.
def rules(spec: TripSpec) -> dict[str, str]:
    """Name -> condition for a bad row; a null condition does not count as bad."""
    trip = trip_columns(spec)
    pickup, dropoff, minutes = trip["pickup_ts"], trip["dropoff_ts"], trip["duration_min"]
    passengers = f"passenger_count BETWEEN {MIN_PASSENGERS} AND {MAX_PASSENGERS}"
    return {
        "missing_pickup_ts": f"{pickup} IS NULL",
        "missing_dropoff_ts": f"{dropoff} IS NULL",
        "dropoff_before_or_equal_pickup": f"{dropoff} <= {pickup}",
        "duration_min_lte_0": f"{minutes} <= 0",
        "duration_min_gt_24h": f"{minutes} > {MAX_MINUTES}",
        "trip_distance_lte_0": "trip_distance <= 0",
        "trip_distance_gt_100": f"trip_distance > {MAX_DISTANCE}",
        "passenger_count_null": "passenger_count IS NULL",
        "passenger_count_out_of_range": f"NOT ({passengers})",
        "fare_amount_negative": "fare_amount < 0",
        "total_amount_negative": "total_amount < 0",
        spec.outside_rule: f"NOT {in_period(spec)}",
    }


def validity(spec: TripSpec, period: str | None = None) -> str:
    """The condition a trip must meet to be kept. Null counts as not met, as in any filter.

    ``period`` stands in for the condition that the pick-up is in the spec's month.

    A drop-off after the pick-up is implied: whole seconds that differ by at least one, which is
    what a positive duration means, cannot come in any other order. So are times that are there.
    Plain comparisons come first, as they spare most bad rows the casts of the others.

    Times are named as few times as possible: where they are expressions, the optimizer writes each out
    once per mention, and the JVM does not compile methods of more than 8,000 bytes. So the duration's
    two bounds are one condition, that it falls into the bucket from the first second to the last.
    """
    conditions = (
        period or in_period(spec),
        f"passenger_count BETWEEN {MIN_PASSENGERS} AND {MAX_PASSENGERS}",
        f"trip_distance > 0 AND trip_distance <= {MAX_DISTANCE}",
        "fare_amount >= 0",
        "total_amount >= 0",
        f"width_bucket({trip_seconds(spec)}, 1, {60 * MAX_MINUTES + 1}, 1) = 1",
    )
    return " AND ".join(conditions)


def period_filter(df: DataFrame, spec: TripSpec) -> DataFrame:
    return df.filter(in_period(spec))


def replaced_columns(df: DataFrame, spec: TripSpec) -> list[str]:
    """Raw columns that have the name of a derived one, which takes their place."""
    derived = {c.lower() for c in trip_columns(spec)}
    return [c for c in df.columns if c.lower() in derived]


def clean(df: DataFrame, spec: TripSpec, period: str | None = None) -> DataFrame:
    """Valid, distinct trips with the derived columns.

    The derived columns are functions of the raw ones, so taking distinct rows first gives the same
    set while five columns less are hashed and shuffled. Raw columns that they replace go before, as
    rows that differ in nothing else are the same trip.
    """
    valid = df.filter(validity(spec, period)).drop(*replaced_columns(df, spec))
    return derive(valid.dropDuplicates(), spec)


# Columns of judged rows: rows and distinct rows that one stands for, and whether cleaning keeps it.
COPIES, KINDS, VALID = "__copies", "__kinds", "__valid"


def judged_rows(df: DataFrame, spec: TripSpec, period: str | None = None) -> DataFrame:
    """Distinct trips, valid or not, with COPIES, KINDS and VALID.

    One scan and one shuffle of the whole rows are enough for the clean set, the rejected rows and the
    duplicates. Rows that differ only in raw columns which derived ones replace are the same trip; they
    are merged by a second shuffle, which tables without such columns do not have.
    """
    kinds = df.groupBy(*[name(c) for c in df.columns]).agg(F.expr(f"count(*) AS {COPIES}"))
    replaced = replaced_columns(df, spec)
    if replaced:
        kept = [name(c) for c in df.columns if c not in replaced]
        sums = (f"sum({COPIES}) AS {COPIES}", f"count(*) AS {KINDS}")
        kinds = kinds.groupBy(*kept).agg(*map(F.expr, sums))
    else:
        kinds = kinds.selectExpr("*", f"1L AS {KINDS}")
    return kinds.selectExpr("*", f"coalesce({validity(spec, period)}, false) AS {VALID}")


def distinct_rejects(df: DataFrame, spec: TripSpec, period: str | None = None) -> DataFrame:
    """Distinct rows that cleaning does not keep. Copies of a row are all kept or all rejected, so
    these and the distinct valid rows together are the distinct rows of the input."""
    return df.filter(f"NOT coalesce({validity(spec, period)}, false)").dropDuplicates()


def merged_by_cleaning(df: DataFrame, spec: TripSpec) -> DataFrame:
    """merged_rows: distinct valid rows less clean rows, as one row.

    Above 0 only if a raw column has a derived column's name; without one nothing is read.
    """
    replaced = replaced_columns(df, spec)
    if not replaced:
        return df.sparkSession.range(0, 1, 1, 1).selectExpr("0L AS merged_rows")
    valid = df.filter(validity(spec))
    kept = [name(c) for c in df.columns if c not in replaced]
    kinds = valid.dropDuplicates().groupBy(*kept).agg(F.expr("count(*) - 1 AS more"))
    return kinds.selectExpr("coalesce(sum(more), 0L) AS merged_rows")


def quality_counts(df: DataFrame, spec: TripSpec) -> DataFrame:
    """original_rows, distinct_rows and clean_rows as one row; one more shuffle is needed if a raw
    column has a derived column's name."""
    counts = row_kinds(df, clean_rows=validity(spec))
    if not replaced_columns(df, spec):
        return counts
    names = ("original_rows", "distinct_rows", "clean_rows")
    less = merged_by_cleaning(df, spec).selectExpr("0L", "0L", "-merged_rows")
    return counts.union(less).selectExpr(*[f"sum({n}) AS {n}" for n in names])


_GONE = "original_rows - clean_rows"
_GONE_SHARE = f"CASE WHEN original_rows > 0 THEN ({_GONE}) / original_rows ELSE 0D END"
_SCORE = f"CASE WHEN original_rows > 0 THEN 1 - ({_GONE_SHARE}) ELSE 0D END"


def removed(counts: DataFrame) -> DataFrame:
    """original_rows, clean_rows, removed_rows, removed_pct from a row of counts."""
    return counts.selectExpr(
        "original_rows", "clean_rows", f"{_GONE} AS removed_rows", f"{_GONE_SHARE} AS removed_pct"
    )


def cleaning_summary(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """original_rows, clean_rows, removed_rows, removed_pct as one row."""
    before = raw.selectExpr("count(*) AS original_rows", "0L AS clean_rows")
    after = cleaned.selectExpr("0L AS original_rows", "count(*) AS clean_rows")
    counts = before.union(after).selectExpr(
        "sum(original_rows) AS original_rows", "sum(clean_rows) AS clean_rows"
    )
    return removed(counts)


def quality_facts(source: str) -> str:
    """Expression for the quality table, in its fixed order, over a row of counts.

    Numbers are in ``value``; the one text, the source that was used, is in ``value_text``.
    ``source`` is an expression too.
    """
    # Metric names and their order.
    numbers = {
        "original_rows": "original_rows",
        "clean_rows": "clean_rows",
        "removed_rows": _GONE,
        "removed_pct": f"round({_GONE_SHARE}, 4)",
        "quality_score": f"round({_SCORE}, 4)",
        "duplicate_rows": "original_rows - distinct_rows",
    }
    facts = {"data_source_used": ("NULL", source)}
    facts |= {metric: (number, "NULL") for metric, number in numbers.items()}
    records = [
        record(
            metric=literal(metric),
            value=f"CAST({number} AS DOUBLE)",
            value_text=f"CAST({text} AS STRING)",
        )
        for metric, (number, text) in facts.items()
    ]
    return rows(records)


def kpi_quality(counts: DataFrame, source: str) -> DataFrame:
    """metric, value, value_text: seven facts about input and cleaning."""
    return counts.selectExpr(quality_facts(literal(source)))
