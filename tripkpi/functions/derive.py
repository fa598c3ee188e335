"""Columns derived from a raw trip."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripkpi.functions.text import literal
from tripkpi.spec import OTHER_PAYMENT, TripSpec


def _seconds(ts: str) -> str:
    """Whole seconds on the wall clock since the year 1, so that fractions are cut off downwards."""
    return f"CAST(CAST({ts} - TIMESTAMP_NTZ '0001-01-01' AS INTERVAL SECOND) AS BIGINT)"


def trip_seconds(spec: TripSpec) -> str:
    """Whole seconds from pick-up to drop-off."""
    times = (spec.dropoff_column, spec.pickup_column)
    return "({} - {})".format(*[_seconds(f"CAST({ts} AS TIMESTAMP_NTZ)") for ts in times])


def trip_columns(spec: TripSpec) -> dict[str, str]:
    """The derived columns, each written over raw columns only.

    Filters and rules use these expressions in place of the derived columns, so that cleaning can
    run before anything is added to the rows. Times are wall-clock times without a zone, so neither
    the session's time zone nor a change of clocks has a part in hours and durations. Duration is the
    difference of whole seconds.
    """
    pickup = f"CAST({spec.pickup_column} AS TIMESTAMP_NTZ)"
    dropoff = f"CAST({spec.dropoff_column} AS TIMESTAMP_NTZ)"
    return {
        "pickup_ts": pickup,
        "dropoff_ts": dropoff,
        "duration_min": f"{trip_seconds(spec)} / 60",
        "pickup_date": f"CAST({pickup} AS DATE)",
        "pickup_hour": f"hour({pickup})",
    }


def derive(df: DataFrame, spec: TripSpec) -> DataFrame:
    return df.withColumns({name: F.expr(sql) for name, sql in trip_columns(spec).items()})


def payment_label(labels: Mapping[int, str], code: str = "payment_type") -> str:
    cases = " ".join(f"WHEN {value} THEN {literal(name)}" for value, name in labels.items())
    return f"CASE {code} {cases} ELSE {literal(OTHER_PAYMENT)} END"
