"""Entry points for the driver: the flagship query, all queries, and their SQL counterparts.

All queries run over whole tables. Trip queries use the trip-shaped table that
``tripkpi.fixtures`` derives from ``events``; the SQL side derives it on its own (``_TRIPS``).
"""

from __future__ import annotations

import importlib
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import fixtures
from tripkpi.fixtures import GREEN, YELLOW
from tripkpi.functions import derive
from tripkpi.operators import feeds, kpis, profile, quality
from tripkpi.plans import bundle, job
from tripkpi.session import scratch_uri
from tripkpi.sources import (
    file_sample,
    hash_sample,
    in_hash_sample,
    read_trips,
    reload_clean,
    write_clean,
)
from tripkpi.spec import TripSpec

SMOKE_DIR = "/root/testdata/sf0.001"

YELLOW_LATER = TripSpec("yellow", 2024, 3)


def _trips(spark: SparkSession, sf_dir: str, spec: TripSpec = YELLOW) -> DataFrame:
    return fixtures.trips_from_events(read_trips(spark, f"{sf_dir}/events.parquet"), spec)


def _clean(spark: SparkSession, sf_dir: str, spec: TripSpec = YELLOW) -> DataFrame:
    return quality.clean(_trips(spark, sf_dir, spec), spec)


def _run(spark: SparkSession, sf_dir: str) -> job.Run:
    """Rolled-up KPIs and document of the trips."""
    return job.kpis_of(_trips(spark, sf_dir), YELLOW, "events")


def _stored_trips(spark: SparkSession, sf_dir: str, *specs: TripSpec) -> str:
    """Trips as Parquet at the locations a run looks at; the root folder of these."""
    root = scratch_uri(spark, "trips")
    for spec in specs:
        _trips(spark, sf_dir, spec).write.parquet(spec.source_uri(root))
    return root


# Queries.


def scan_trips(spark, sf_dir):
    return _trips(spark, sf_dir)


def sample_hash(spark, sf_dir):
    return hash_sample(_trips(spark, sf_dir), "trip_id", 0.10)


def row_counts(spark, sf_dir):
    sampled = in_hash_sample("trip_id", 0.10)
    return _trips(spark, sf_dir).selectExpr(
        "count(*) AS raw_rows", f"count(CASE WHEN {sampled} THEN 1 END) AS sampled_rows"
    )


def schema_summary(spark, sf_dir):
    return profile.schema_summary(_trips(spark, sf_dir))


def audit_columns(spark, sf_dir):
    return profile.audit_preview(derive(_trips(spark, sf_dir), YELLOW), n=None)


def null_profile(spark, sf_dir):
    return profile.null_profile(_trips(spark, sf_dir))


def numeric_profile(spark, sf_dir):
    return profile.numeric_profile(_trips(spark, sf_dir), digits=4)


def numeric_profile_lineitem(spark, sf_dir):
    return profile.numeric_profile(read_trips(spark, f"{sf_dir}/lineitem.parquet"), digits=4)


def numeric_profile_exact(spark, sf_dir):
    """Means and deviations that are the same to the last digit in every run."""
    return profile.numeric_profile(_trips(spark, sf_dir), exact=True)


def numeric_profile_lineitem_exact(spark, sf_dir):
    return profile.numeric_profile(read_trips(spark, f"{sf_dir}/lineitem.parquet"), exact=True)


def profile_pass(spark, sf_dir):
    """Rows, nulls, statistics and rules from the pass that counts them together."""
    return profile.profile_rows(_trips(spark, sf_dir), quality.rules(YELLOW))


def profile_pass_one_scan(spark, sf_dir):
    """The same by the pass that sampled runs take."""
    return profile.profile_rows(_trips(spark, sf_dir), quality.rules(YELLOW), one_scan=True)


def _clashing(spark, sf_dir):
    """Each trip twice, the two differing in raw columns that are called like derived ones only."""
    trips = _trips(spark, sf_dir)
    first = trips.selectExpr("*", "'a' AS pickup_date", "1 AS duration_min")
    return first.union(trips.selectExpr("*", "'b' AS pickup_date", "2 AS duration_min"))


def clean_clashing_names(spark, sf_dir):
    return quality.clean(_clashing(spark, sf_dir), YELLOW)


def quality_clashing_names(spark, sf_dir):
    run = job.kpis_of(_clashing(spark, sf_dir), YELLOW, "events")
    return run.sections["kpi_calidad"].select("metric", "value")


def _odd_clean(spark, sf_dir):
    return quality.clean(fixtures.odd_amounts(_trips(spark, sf_dir)), YELLOW)


def exact_kpi_summary(spark, sf_dir):
    return kpis.kpi_summary(_odd_clean(spark, sf_dir))


def exact_kpi_by_hour(spark, sf_dir):
    return kpis.kpi_by_hour(kpis.rollup(_odd_clean(spark, sf_dir)))


def exact_kpi_vast(spark, sf_dir):
    """Hours whose totals have values of a few dollars beside 9.1e18 or 1.3e300."""
    trips = fixtures.vast_amounts(_trips(spark, sf_dir))
    hours = kpis.kpi_by_hour(kpis.rollup(quality.clean(trips, YELLOW)))
    return hours.select("pickup_hour", "trips", "revenue", "avg_ticket")


def sample_rows(spark, sf_dir):
    """Bernoulli sample of the events by their place in the file."""
    return file_sample(read_trips(spark, f"{sf_dir}/events.parquet"))


def report_single_file(spark, sf_dir):
    """What a plain JSON reader finds in the one object that a run publishes."""
    uri = f"{scratch_uri(spark, 'report')}/kpis.json"
    bundle.write_bundle(_run(spark, sf_dir).bundle, uri)
    objects = spark.read.format("binaryFile").load(uri)
    document = "decode(content, 'UTF-8')"
    return objects.selectExpr(
        "count(*) OVER () AS objects",
        f"get_json_object({document}, '$.metadata.dataset') AS dataset",
        f"CAST(get_json_object({document}, '$.kpi_resumen[0].total_trips') AS BIGINT) AS total_trips",
        f"json_array_length(get_json_object({document}, '$.kpi_por_dia')) AS days",
        f"json_array_length(get_json_object({document}, '$.kpi_calidad')) AS facts",
        f"get_json_object({document}, '$.kpi_calidad[0].value_text') AS data_source",
    )


def duplicate_summary(spark, sf_dir):
    return profile.duplicate_summary(_trips(spark, sf_dir))


def preview_rows(spark, sf_dir):
    """The first ten trips by id, as one looks at them before cleaning."""
    ordered = derive(_trips(spark, sf_dir), YELLOW).orderBy("trip_id", "tpep_pickup_datetime")
    return profile.audit_preview(ordered, n=10)


def describe_text(spark, sf_dir):
    """Spark's own statistics as text, of whole numbers; the standard deviation as a number."""
    whole = _trips(spark, sf_dir).select("trip_id", "PULocationID")
    table = profile.describe_numeric(whole)
    shown = {c: F.expr(f"IF(summary = 'stddev', format_number(CAST({c} AS DOUBLE), 4), {c})") for c in whole.columns}
    return table.withColumns(shown)


def run_stamp(spark, sf_dir):
    """Whether a document's time is one of UTC, to the microsecond, and of today or later."""
    stamp = _document(spark, sf_dir).select("metadata.generated_at_utc")
    pattern = r"^\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}\\.\\d{6}\\+00:00$"
    return stamp.selectExpr(
        f"generated_at_utc RLIKE '{pattern}' AS is_utc_stamp",
        "CAST(generated_at_utc AS TIMESTAMP) BETWEEN current_timestamp() - INTERVAL '1' HOUR"
        " AND current_timestamp() + INTERVAL '1' MINUTE AS is_now",
    )


def duplicate_summary_lineitem(spark, sf_dir):
    return profile.duplicate_summary(read_trips(spark, f"{sf_dir}/lineitem.parquet"))


def derive_columns(spark, sf_dir):
    return derive(_trips(spark, sf_dir), YELLOW)


def rule_audit(spark, sf_dir):
    return profile.audit(_trips(spark, sf_dir), quality.rules(YELLOW))


def rule_audit_clean(spark, sf_dir):
    return profile.audit(_clean(spark, sf_dir), quality.rules(YELLOW), "_after_cleaning")


def period_filter(spark, sf_dir):
    return quality.period_filter(_trips(spark, sf_dir), YELLOW)


def clean_trips(spark, sf_dir):
    return _clean(spark, sf_dir)


def clean_trips_green(spark, sf_dir):
    return _clean(spark, sf_dir, GREEN)


def cleaning_summary(spark, sf_dir):
    return quality.cleaning_summary(_trips(spark, sf_dir), _clean(spark, sf_dir))


def kpi_quality(spark, sf_dir):
    counts = quality.quality_counts(_trips(spark, sf_dir), YELLOW)
    return quality.kpi_quality(counts, "events")


def kpi_summary(spark, sf_dir):
    return kpis.kpi_summary(_clean(spark, sf_dir))


def kpi_by_day(spark, sf_dir):
    return kpis.kpi_by_day(_clean(spark, sf_dir))


def kpi_by_hour(spark, sf_dir):
    return kpis.kpi_by_hour(_clean(spark, sf_dir))


def trips_by_hour(spark, sf_dir):
    return kpis.trips_by_hour(_clean(spark, sf_dir))


def kpi_by_payment(spark, sf_dir):
    return kpis.kpi_by_payment(_clean(spark, sf_dir), YELLOW.payment_labels)


def kpi_by_payment_green(spark, sf_dir):
    return kpis.kpi_by_payment(_clean(spark, sf_dir, GREEN), GREEN.payment_labels)


def kpi_top_zones(spark, sf_dir):
    return kpis.kpi_top_zones(_clean(spark, sf_dir))


def clean_roundtrip(spark, sf_dir):
    uri = scratch_uri(spark, "clean")
    write_clean(_clean(spark, sf_dir), uri)
    return reload_clean(spark, uri)


def clean_roundtrip_by_date(spark, sf_dir):
    uri = scratch_uri(spark, "clean")
    write_clean(_clean(spark, sf_dir), uri, by_date=True)
    return reload_clean(spark, uri)


def kpi_bundle_sections(spark, sf_dir):
    return bundle.section_sizes(_run(spark, sf_dir).bundle)


def _document(spark, sf_dir):
    """The document of the trips, written and read back."""
    uri = scratch_uri(spark, "report")
    bundle.write_bundle(_run(spark, sf_dir).bundle, uri)
    return bundle.read_bundle(spark, uri)


def _stored(spark, sf_dir, name):
    return bundle.section(_document(spark, sf_dir), name)


def bundle_roundtrip(spark, sf_dir):
    return _stored(spark, sf_dir, "kpi_por_dia")


def document_hours(spark, sf_dir):
    return _stored(spark, sf_dir, "kpi_por_hora")


def document_zones(spark, sf_dir):
    return _stored(spark, sf_dir, "kpi_top_pickup_zones")


def document_metadata(spark, sf_dir):
    metadata = _document(spark, sf_dir).select("metadata.*")
    return metadata.drop("generated_at_utc")


def dash_cards(spark, sf_dir):
    return feeds.dash_cards(_stored(spark, sf_dir, "kpi_resumen"))


def dash_run_summary(spark, sf_dir):
    document = _document(spark, sf_dir)
    summary, facts = (bundle.section(document, n) for n in ("kpi_resumen", "kpi_calidad"))
    return feeds.dash_run_summary(summary, facts)


def dash_daily_series(spark, sf_dir):
    return feeds.dash_daily_series(_stored(spark, sf_dir, "kpi_por_dia"))


def dash_hourly_series(spark, sf_dir):
    return feeds.dash_hourly_series(_stored(spark, sf_dir, "kpi_por_hora"))


def dash_top10_zones(spark, sf_dir):
    return feeds.dash_top_zones(_stored(spark, sf_dir, "kpi_top_pickup_zones"))


def dash_payment(spark, sf_dir):
    return feeds.dash_payment(_stored(spark, sf_dir, "kpi_tipo_pago"))


def dash_quality(spark, sf_dir):
    return feeds.dash_quality(_stored(spark, sf_dir, "kpi_calidad"))


def run_batch_quality(spark, sf_dir):
    """Full run on stored trips; the quality numbers of its document."""
    root = _stored_trips(spark, sf_dir, YELLOW)
    report = YELLOW.report_uri(root)
    sources = [YELLOW.source_uri(root)]
    job.run_batch(spark, YELLOW, sources, YELLOW.clean_uri(root), report)
    facts = bundle.section(bundle.read_bundle(spark, report), "kpi_calidad")
    return facts.filter("value IS NOT NULL").select("metric", "value")


def run_for_request(spark, sf_dir):
    """Short run of a green request on stored trips; the summary of its document."""
    root = _stored_trips(spark, sf_dir, GREEN)
    job.run_for(spark, {"mes": "Enero", "anio": 2025, "color_taxi": "Verde"}, root)
    return bundle.section(bundle.read_bundle(spark, GREEN.report_uri(root)), "kpi_resumen")


def run_periods_payment(spark, sf_dir):
    """Two colours and months in one run; payment types per period."""
    root = _stored_trips(spark, sf_dir, YELLOW, GREEN)
    report = f"{root}/kpis"
    job.run_periods(spark, [YELLOW, GREEN], root, report)
    return bundle.section(bundle.read_bundle(spark, report), "kpi_tipo_pago")


def _periods_report(spark, sf_dir):
    """Where documents of two periods are, written by two runs into one root."""
    root = _stored_trips(spark, sf_dir, YELLOW, GREEN)
    report = f"{root}/kpis"
    for spec in (YELLOW, GREEN):
        job.run_periods(spark, [spec], root, report)
    return report


def run_periods_twice(spark, sf_dir):
    document = bundle.read_bundle(spark, _periods_report(spark, sf_dir))
    return bundle.section(document, "kpi_tipo_pago")


def _periods_section(spark, report, name, periods=None):
    return bundle.read_section(spark, report, name, job.PERIOD, periods)


def dash_top10_zones_periods(spark, sf_dir):
    report = _periods_report(spark, sf_dir)
    return feeds.dash_top_zones(_periods_section(spark, report, "kpi_top_pickup_zones"))


def dash_run_summary_periods(spark, sf_dir):
    report = _periods_report(spark, sf_dir)
    summary, facts = (_periods_section(spark, report, n) for n in ("kpi_resumen", "kpi_calidad"))
    return feeds.dash_run_summary(summary, facts)


def dash_daily_series_periods(spark, sf_dir):
    report = _periods_report(spark, sf_dir)
    return feeds.dash_daily_series(_periods_section(spark, report, "kpi_por_dia"))


def dash_payment_one_period(spark, sf_dir):
    """One section of one of the periods: a folder of the columnar table."""
    report = _periods_report(spark, sf_dir)
    return feeds.dash_payment(
        _periods_section(spark, report, "kpi_tipo_pago", "color = 'green' AND year = 2025 AND month = 1")
    )


def run_months_of_two_layouts(spark, sf_dir):
    """January and March, the latter with a further column and with passengers stored as doubles."""
    root = scratch_uri(spark, "trips")
    _trips(spark, sf_dir).write.parquet(YELLOW.source_uri(root))
    later = _trips(spark, sf_dir).selectExpr(
        "* EXCEPT (passenger_count)",
        "CAST(passenger_count AS DOUBLE) AS Passenger_Count",
        "trip_id % 2 AS extra_fee",
    )
    moved = {c: F.expr(f"{c} + INTERVAL '60' DAY") for c in (YELLOW.pickup_column, YELLOW.dropoff_column)}
    later.withColumns(moved).write.parquet(YELLOW_LATER.source_uri(root))
    report = f"{root}/kpis"
    job.run_periods(spark, [YELLOW, YELLOW_LATER], root, report)
    return _periods_section(spark, report, "kpi_resumen")


def batch_reports(spark, sf_dir):
    """All reports of a full run whose first source is not there, in long form."""
    root = _stored_trips(spark, sf_dir, YELLOW)
    sources = [f"{root}/elsewhere", YELLOW.source_uri(root)]
    run = job.run_batch(spark, YELLOW, sources, YELLOW.clean_uri(root), YELLOW.report_uri(root))
    return job.report_rows(run)


_QUERIES = (
    scan_trips,
    sample_hash,
    row_counts,
    schema_summary,
    audit_columns,
    null_profile,
    numeric_profile,
    numeric_profile_lineitem,
    profile_pass,
    duplicate_summary,
    duplicate_summary_lineitem,
    derive_columns,
    rule_audit,
    rule_audit_clean,
    period_filter,
    clean_trips,
    clean_trips_green,
    cleaning_summary,
    kpi_quality,
    kpi_summary,
    kpi_by_day,
    kpi_by_hour,
    trips_by_hour,
    kpi_by_payment,
    kpi_by_payment_green,
    kpi_top_zones,
    clean_roundtrip,
    clean_roundtrip_by_date,
    kpi_bundle_sections,
    bundle_roundtrip,
    dash_cards,
    dash_run_summary,
    dash_daily_series,
    dash_hourly_series,
    dash_top10_zones,
    dash_payment,
    run_batch_quality,
    run_for_request,
    run_periods_payment,
    run_periods_twice,
    dash_quality,
    dash_top10_zones_periods,
    dash_run_summary_periods,
    dash_daily_series_periods,
    document_hours,
    document_zones,
    document_metadata,
    batch_reports,
    profile_pass_one_scan,
    clean_clashing_names,
    quality_clashing_names,
    exact_kpi_summary,
    exact_kpi_by_hour,
    exact_kpi_vast,
    sample_rows,
    report_single_file,
    dash_payment_one_period,
    run_months_of_two_layouts,
    preview_rows,
    describe_text,
    run_stamp,
    numeric_profile_exact,
    numeric_profile_lineitem_exact,
)


def entry(spark: SparkSession, sf_dir: str = SMOKE_DIR) -> DataFrame:
    """KPIs by day of the trips in ``sf_dir``; by default the smallest of the given tables."""
    return kpi_by_day(spark, sf_dir)


def _llm():
    """The text operators' queries and pipeline, or None where these folders are not installed."""
    try:
        return importlib.import_module("tripkpi.llm.queries")
    except ImportError as error:
        logging.getLogger(__name__).warning("without the text operators: %s", error)
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return {query.__name__: query for query in _QUERIES} | (llm.queries() if llm else {})


# The same in SQL.

_RAW_COLUMNS = """
    event_id AS trip_id, event_type AS channel,
    CASE WHEN event_id % 107 = 0 THEN NULL
         WHEN event_id % 97 = 0 THEN ts - INTERVAL 40 DAY ELSE ts END AS {p}_pickup_datetime,
    CASE WHEN event_id % 89 = 0 THEN NULL
         WHEN event_id % 97 = 0 THEN ts - INTERVAL 40 DAY + INTERVAL 7 MINUTE
         WHEN event_id % 79 = 0 THEN ts - INTERVAL 5 MINUTE
         WHEN event_id % 73 = 0 THEN ts + INTERVAL 25 HOUR
         ELSE ts + INTERVAL 1 SECOND * CAST(60 + (event_id * 37) % 3541 AS INT)
    END AS {p}_dropoff_datetime,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE event_id % 8 END AS passenger_count,
    CASE WHEN event_id % 71 = 0 THEN CAST(0 AS DOUBLE)
         ELSE floor(cents / 3) / CAST(100 AS DOUBLE) END AS trip_distance,
    (CASE WHEN event_id % 83 = 0 THEN -cents ELSE cents END) / CAST(100 AS DOUBLE) AS fare_amount,
    floor(cents * (user_id % 5) / 20) / CAST(100 AS DOUBLE) AS tip_amount,
    (CASE WHEN event_id % 67 = 0 THEN -(cents + 350) ELSE cents + 350 END)
        / CAST(100 AS DOUBLE) AS total_amount,
    CASE WHEN event_id % 11 = 7 THEN NULL ELSE event_id % 7 END AS payment_type,
    user_id % 40 + 1 AS PULocationID"""


def _base(prefix: str, start: str, end: str, shift_days: int) -> str:
    """CTEs: trips, derived, clean."""
    return f"""WITH base AS (
  SELECT event_id, ts + INTERVAL {shift_days} DAY AS ts, user_id, event_type,
    CAST(round(value * 100) AS BIGINT) AS cents,
    unnest(CASE WHEN event_id % 101 = 0 THEN [1, 2] ELSE [1] END) AS copy
  FROM events
), trips AS (SELECT {_RAW_COLUMNS.format(p=prefix)}
  FROM base
), derived AS (
  SELECT *, {prefix}_pickup_datetime AS pickup_ts, {prefix}_dropoff_datetime AS dropoff_ts,
    date_diff('second', {prefix}_pickup_datetime, {prefix}_dropoff_datetime) / 60 AS duration_min,
    CAST({prefix}_pickup_datetime AS DATE) AS pickup_date,
    CAST(hour({prefix}_pickup_datetime) AS INT) AS pickup_hour
  FROM trips
), clean AS (
  SELECT DISTINCT * FROM derived
  WHERE dropoff_ts > pickup_ts
    AND pickup_ts >= TIMESTAMP '{start}' AND pickup_ts < TIMESTAMP '{end}'
    AND duration_min > 0 AND duration_min <= 1440
    AND trip_distance > 0 AND trip_distance <= 100
    AND passenger_count BETWEEN 1 AND 6
    AND fare_amount >= 0 AND total_amount >= 0
)
"""


_TRIPS = _base("tpep", "2024-01-01", "2024-02-01", 0)
_TRIPS_GREEN = _base("lpep", "2025-01-01", "2025-02-01", 366)

_RAW = (
    ("trip_id", "bigint"),
    ("channel", "string"),
    ("tpep_pickup_datetime", "timestamp_ntz"),
    ("tpep_dropoff_datetime", "timestamp_ntz"),
    ("passenger_count", "bigint"),
    ("trip_distance", "double"),
    ("fare_amount", "double"),
    ("tip_amount", "double"),
    ("total_amount", "double"),
    ("payment_type", "bigint"),
    ("PULocationID", "bigint"),
)
_LINEITEM_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)
_SAMPLED = "substr(md5(CAST(trip_id AS VARCHAR)), 1, 8) < '1999999a'"

_RULES = {
    "missing_pickup_ts": "pickup_ts IS NULL",
    "missing_dropoff_ts": "dropoff_ts IS NULL",
    "dropoff_before_or_equal_pickup": "dropoff_ts <= pickup_ts",
    "duration_min_lte_0": "duration_min <= 0",
    "duration_min_gt_24h": "duration_min > 1440",
    "trip_distance_lte_0": "trip_distance <= 0",
    "trip_distance_gt_100": "trip_distance > 100",
    "passenger_count_null": "passenger_count IS NULL",
    "passenger_count_out_of_range": "NOT (passenger_count BETWEEN 1 AND 6)",
    "fare_amount_negative": "fare_amount < 0",
    "total_amount_negative": "total_amount < 0",
    "pickup_outside_2024_01": (
        "NOT (pickup_ts >= TIMESTAMP '2024-01-01' AND pickup_ts < TIMESTAMP '2024-02-01')"
    ),
}


def _cents(column: str) -> str:
    return f"sum(CAST(round({column} * 100) AS HUGEINT))"


def _half_up(num: str, den: str) -> str:
    """num / den in hundredths, halves rounded up, for non-negative whole numbers."""
    return f"CAST((2 * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / 100"


def _mean(column: str) -> str:
    return _half_up(_cents(column), f"count({column})")


_DURATION = _half_up("100 * sum(CAST(round(duration_min * 60) AS HUGEINT))", "60 * count(*)")
_REVENUE = f"CAST({_cents('total_amount')} AS DOUBLE) / 100"
_TIP_PCT = (
    f"CASE WHEN sum(fare_amount) > 0 THEN "
    f"{_half_up('10000 * ' + _cents('tip_amount'), _cents('fare_amount'))} ELSE 0 END"
)
_FIGURES = (
    f"count(*) AS trips, {_REVENUE} AS revenue, {_mean('total_amount')} AS avg_ticket"
)
_LENGTH = (
    f"{_mean('trip_distance')} AS avg_trip_distance, {_DURATION} AS avg_duration_min"
)
_TIP = f"{_mean('tip_amount')} AS avg_tip"
_SUMMARY = f"""SELECT count(*) AS total_trips, {_REVENUE} AS total_revenue,
  {_mean('total_amount')} AS avg_ticket, {_LENGTH}, {_TIP}, {_TIP_PCT} AS avg_tip_pct,
  {_mean('passenger_count')} AS avg_passenger_count FROM clean"""
_BY_DAY = f"SELECT pickup_date, {_FIGURES}, {_LENGTH}, {_TIP} FROM clean GROUP BY pickup_date"
_BY_HOUR = f"SELECT pickup_hour, {_FIGURES}, {_LENGTH}, {_TIP} FROM clean GROUP BY pickup_hour"
_ZONES = f"""SELECT PULocationID, {_FIGURES}, {_LENGTH} FROM clean GROUP BY PULocationID
  ORDER BY trips DESC, PULocationID LIMIT 20"""


def _payment(last_code: int, keys: str = "") -> str:
    names = ("Credit card", "Cash", "No charge", "Dispute", "Unknown", "Voided trip")
    cases = " ".join(
        f"WHEN payment_type = {code} THEN '{name}'"
        for code, name in enumerate(names[:last_code], start=1)
    )
    label = f"CASE {cases} ELSE 'Other / null' END"
    return f"""SELECT {keys} payment_type, {label} AS payment_type_label, {_FIGURES}, {_TIP}
  FROM clean GROUP BY payment_type"""


def _rule_audit(table: str, suffix: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule, "
        f"CAST(sum(CASE WHEN {bad} THEN 1 ELSE 0 END) AS BIGINT) AS bad_rows{suffix}, "
        f"sum(CASE WHEN {bad} THEN 1 ELSE 0 END) / count(*) AS bad_pct{suffix} FROM {table}"
        for name, bad in _RULES.items()
    )


def _numeric(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM {table}"
        for c in columns
    )


def _numeric_exact(table: str, columns) -> str:
    """The same from whole numbers: billionths of the columns that have fractions."""
    parts = []
    for column, unit in columns:
        parts.append(f"""SELECT '{column}' AS "column", n AS count,
  (CAST(m AS DOUBLE) + CAST(r AS DOUBLE) / n) / {unit} AS mean,
  sqrt((CAST(CAST(s2 - m * (s1 + r) AS VARCHAR) AS DOUBLE) - CAST(r AS DOUBLE) * CAST(r AS DOUBLE) / n)
    / (n - 1)) / {unit} AS stddev, low AS min, high AS max
FROM (SELECT *, s1 // n AS m, s1 % n AS r FROM (
  SELECT count(y) AS n, sum(y) AS s1, sum(y * y) AS s2, min(v) AS low, max(v) AS high
  FROM (SELECT v, CAST(floor(v) * {unit} AS HUGEINT)
      + CAST(round_even((v - floor(v)) * {unit}, 0) AS HUGEINT) AS y
    FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {table}))))""")
    return " UNION ALL ".join(parts)


def _duplicates(table: str) -> str:
    return f"""SELECT 'total_rows' AS metric, (SELECT count(*) FROM {table}) AS value
  UNION ALL SELECT 'distinct_rows', (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))
  UNION ALL SELECT 'duplicate_rows', (SELECT count(*) FROM {table})
    - (SELECT count(*) FROM (SELECT DISTINCT * FROM {table}))"""


_COUNTS = """, counts AS (
  SELECT (SELECT count(*) FROM trips) AS original_rows,
    (SELECT count(*) FROM (SELECT DISTINCT * FROM trips)) AS distinct_rows,
    (SELECT count(*) FROM clean) AS clean_rows
)
"""
_QUALITY_NUMBERS = """SELECT 'original_rows' AS metric, CAST(original_rows AS DOUBLE) AS value
  FROM counts
  UNION ALL SELECT 'clean_rows', clean_rows FROM counts
  UNION ALL SELECT 'removed_rows', original_rows - clean_rows FROM counts
  UNION ALL SELECT 'removed_pct', round((original_rows - clean_rows) / original_rows, 4) FROM counts
  UNION ALL SELECT 'quality_score',
    round(1 - (original_rows - clean_rows) / original_rows, 4) FROM counts
  UNION ALL SELECT 'duplicate_rows', original_rows - distinct_rows FROM counts"""

_FIRST_CARDS = """SELECT 1 AS position, 'Total Viajes' AS card,
    format('{:,}', total_trips) AS value, CAST(NULL AS VARCHAR) AS delta FROM summary
  UNION ALL SELECT 2, 'Ingresos Totales', format('${:,.2f}', total_revenue), NULL FROM summary
  UNION ALL SELECT 3, 'Ticket Promedio', format('${:.2f}', avg_ticket), NULL FROM summary"""


# The trips with odd amounts; sums in billionths, halves away from zero.
_ODD = _base("tpep", "2024-01-01", "2024-02-01", 0).replace(
    "), derived AS (",
    """), even AS (SELECT * FROM trips), odd AS (
  SELECT * REPLACE (
    (trip_id * 7919 % 90000000 + 1) / CAST(1000000 AS DOUBLE) AS trip_distance,
    (trip_id * 31 % 4001 - 2000) / CAST(1000 AS DOUBLE) AS tip_amount,
    CAST(trip_id * 99999989 % 1000000000000 AS DOUBLE)
      + trip_id % 200 * 5 / CAST(1000 AS DOUBLE) AS total_amount)
  FROM even
), derived AS (""",
).replace("\n  FROM trips\n), clean", "\n  FROM odd\n), clean")


def _nanos(column: str) -> str:
    whole = f"CAST(floor({column}) AS HUGEINT)"
    return f"sum({whole} * 1000000000 + CAST(round(({column} - floor({column})) * 1e9) AS HUGEINT))"


def _away(num: str, den: str, times: int = 100) -> str:
    """num / den in hundredths, halves away from zero."""
    return (
        f"(sign({num}) * CAST(({2 * times} * abs({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / 100)"
    )


def _odd_mean(column: str) -> str:
    return _away(_nanos(column), f"(count({column})::HUGEINT * 1000000000)")


_ODD_LENGTH = (
    f"{_odd_mean('trip_distance')} AS avg_trip_distance, {_DURATION} AS avg_duration_min, "
    f"{_odd_mean('tip_amount')} AS avg_tip"
)
_ODD_REVENUE = _away(_nanos("total_amount"), "1000000000::HUGEINT")
_ODD_SUMMARY = f"""SELECT count(*) AS total_trips, {_ODD_REVENUE} AS total_revenue,
  {_odd_mean('total_amount')} AS avg_ticket, {_ODD_LENGTH},
  {_away(_nanos('tip_amount'), _nanos('fare_amount'), 10000)} AS avg_tip_pct,
  {_mean('passenger_count')} AS avg_passenger_count FROM clean"""
_ODD_BY_HOUR = f"""SELECT pickup_hour, count(*) AS trips, {_ODD_REVENUE} AS revenue,
  {_odd_mean('total_amount')} AS avg_ticket, {_ODD_LENGTH} FROM clean GROUP BY pickup_hour"""

# The trips with vast totals. What is beyond a bigint is a sum of doubles, here of equal powers of two,
# which is the same in any order.
_VAST = _ODD.replace(
    _ODD[_ODD.index("  SELECT * REPLACE (") : _ODD.index("  FROM even\n")],
    """  SELECT * REPLACE (CASE WHEN hour(tpep_pickup_datetime) = 3 AND trip_id % 40 = 9 THEN 9.1e18
    WHEN hour(tpep_pickup_datetime) = 5 AND trip_id % 40 = 9 THEN pow(2, 70)
    WHEN hour(tpep_pickup_datetime) = 7 AND trip_id % 40 = 9 THEN pow(2, 997)
    ELSE trip_id % 100000 / CAST(100 AS DOUBLE) END AS total_amount)
""",
)
_EXACT_TOTAL = _nanos("CASE WHEN total_amount < 9.2e18 THEN total_amount ELSE 0 END")
_VAST_REST = "sum(total_amount) FILTER (total_amount >= 9.2e18)"
_VAST_BY_HOUR = f"""SELECT pickup_hour, count(*) AS trips,
  CASE WHEN {_VAST_REST} IS NULL THEN {_away(_EXACT_TOTAL, '1000000000::HUGEINT')}
    ELSE CAST({_EXACT_TOTAL} AS DOUBLE) / 1000000000 + {_VAST_REST} END AS revenue,
  CASE WHEN {_VAST_REST} IS NULL
    THEN {_away(_EXACT_TOTAL, '(count(total_amount)::HUGEINT * 1000000000)')}
    ELSE (CAST({_EXACT_TOTAL} AS DOUBLE) / 1000000000 + {_VAST_REST}) / count(*) END AS avg_ticket FROM clean GROUP BY pickup_hour"""

_DESCRIBED = " UNION ALL ".join(
    f"SELECT '{name}' AS summary, " + ", ".join(f"{sql.format(c=c)} AS {c}" for c in ("trip_id", "PULocationID"))
    + " FROM trips"
    for name, sql in (
        ("count", "CAST(count({c}) AS VARCHAR)"),
        ("mean", "CAST(avg({c}) AS VARCHAR)"),
        ("stddev", "format('{{:,.4f}}', stddev_samp({c}))"),
        ("min", "CAST(min({c}) AS VARCHAR)"),
        ("max", "CAST(max({c}) AS VARCHAR)"),
    )
)

# Each trip is there twice, as two rows that cleaning makes one.
_CLASHING_COUNTS = _COUNTS.replace(
    "(SELECT count(*) FROM trips)", "(SELECT 2 * count(*) FROM trips)"
).replace(
    "(SELECT count(*) FROM (SELECT DISTINCT * FROM trips))",
    "(SELECT 2 * count(*) FROM (SELECT DISTINCT * FROM trips))",
)


def _melted(report: str, sql: str, item: str, measures) -> str:
    return " UNION ALL ".join(
        f"SELECT '{report}' AS report, CAST({item} AS VARCHAR) AS item, '{m}' AS measure, "
        f'round(CAST("{m}" AS DOUBLE), 4) AS value FROM ({sql})'
        for m in measures
    )


def _profile_rows(on_trips: dict[str, str]) -> str:
    parts = [("rows", "'all'", "total_rows", "SELECT count(*) AS total_rows FROM trips")]
    parts.append(("nulls", '"column"', "null_count", on_trips["null_profile"]))
    for statistic in ("mean", "stddev", "min", "max"):
        parts.append((statistic, '"column"', statistic, on_trips["numeric_profile"]))
    parts.append(("rule", "rule", "bad_rows", on_trips["rule_audit"]))
    return _TRIPS + " UNION ALL ".join(
        f"SELECT '{part}' AS part, {item} AS item, CAST(\"{value}\" AS DOUBLE) AS value FROM ({sql})"
        for part, item, value, sql in parts
    )


def oracle_sql() -> dict[str, str]:
    clean_green = f"{_TRIPS_GREEN} SELECT * FROM clean"
    payment_periods = " UNION ALL ".join(
        f"SELECT * FROM ({cte} {_payment(last, keys)})"
        for cte, last, keys in (
            (_TRIPS, 6, "'yellow' AS color, 2024 AS year, 1 AS month,"),
            (_TRIPS_GREEN, 5, "'green' AS color, 2025 AS year, 1 AS month,"),
        )
    )
    on_trips = {
        "scan_trips": "SELECT * FROM trips",
        "sample_hash": f"SELECT * FROM trips WHERE {_SAMPLED}",
        "row_counts": (
            "SELECT count(*) AS raw_rows, "
            f"CAST(count(CASE WHEN {_SAMPLED} THEN 1 END) AS BIGINT) AS sampled_rows FROM trips"
        ),
        "schema_summary": " UNION ALL ".join(
            f"SELECT CAST({i} AS INT) AS ordinal, '{c}' AS \"column\", '{t}' AS type, "
            f"true AS nullable, count({c}) AS filled_rows FROM trips"
            for i, (c, t) in enumerate(_RAW, start=1)
        ),
        "audit_columns": (
            "SELECT pickup_ts, dropoff_ts, duration_min, passenger_count, trip_distance, "
            "fare_amount, total_amount FROM derived"
        ),
        "null_profile": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, "
            f"(count(*) - count({c})) / count(*) AS null_pct FROM trips"
            for c, _ in _RAW
        ),
        "numeric_profile": _numeric("trips", [c for c, t in _RAW if t in ("bigint", "double")]),
        "duplicate_summary": _duplicates("trips"),
        "derive_columns": "SELECT * FROM derived",
        "rule_audit": _rule_audit("derived"),
        "rule_audit_clean": _rule_audit("clean", "_after_cleaning"),
        "period_filter": (
            "SELECT * FROM trips WHERE tpep_pickup_datetime >= TIMESTAMP '2024-01-01' "
            "AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'"
        ),
        "clean_trips": "SELECT * FROM clean",
        "clean_roundtrip": "SELECT * FROM clean",
        "clean_roundtrip_by_date": "SELECT * FROM clean",
        "kpi_summary": _SUMMARY,
        "kpi_by_day": _BY_DAY,
        "bundle_roundtrip": _BY_DAY,
        "kpi_by_hour": _BY_HOUR,
        "trips_by_hour": (
            f"SELECT pickup_hour, count(*) AS trips, {_LENGTH}, "
            f"{_mean('total_amount')} AS avg_total_amount FROM clean GROUP BY pickup_hour"
        ),
        "kpi_by_payment": _payment(6),
        "kpi_top_zones": _ZONES,
        "dash_daily_series": f"SELECT pickup_date, trips FROM ({_BY_DAY})",
        "dash_hourly_series": f"SELECT pickup_hour, trips FROM ({_BY_HOUR})",
        "dash_top10_zones": (
            f"SELECT PULocationID, trips, revenue, avg_ticket FROM ({_ZONES}) "
            "ORDER BY trips DESC, PULocationID LIMIT 10"
        ),
        "dash_payment": (
            f"SELECT payment_type_label, trips, revenue, avg_ticket FROM ({_payment(6)})"
        ),
        "dash_cards": f"""SELECT * FROM (WITH summary AS ({_SUMMARY}) {_FIRST_CARDS}
  UNION ALL SELECT 4, 'Propina Promedio', format('${{:.2f}}', avg_tip),
    CAST(avg_tip_pct AS VARCHAR) || '%' FROM summary
  UNION ALL SELECT 5, 'Distancia Promedio', format('{{:.2f}} mi', avg_trip_distance), NULL
    FROM summary
  UNION ALL SELECT 6, 'Duración Promedio', format('{{:.1f}} min', avg_duration_min), NULL
    FROM summary
  UNION ALL SELECT 7, 'Pasajeros Promedio', format('{{:.1f}}', avg_passenger_count), NULL
    FROM summary)""",
    }
    on_counts = {
        "cleaning_summary": (
            "SELECT original_rows, clean_rows, original_rows - clean_rows AS removed_rows, "
            "(original_rows - clean_rows) / original_rows AS removed_pct FROM counts"
        ),
        "kpi_quality": (
            "SELECT 'data_source_used' AS metric, CAST(NULL AS DOUBLE) AS value, "
            "'events' AS value_text UNION ALL "
            f"SELECT metric, value, NULL FROM ({_QUALITY_NUMBERS})"
        ),
        "run_batch_quality": _QUALITY_NUMBERS,
        "kpi_bundle_sections": """SELECT 'kpi_resumen' AS section, CAST(1 AS INT) AS records
  UNION ALL SELECT 'kpi_por_dia', CAST(count(DISTINCT pickup_date) AS INT) FROM clean
  UNION ALL SELECT 'kpi_por_hora', CAST(count(DISTINCT pickup_hour) AS INT) FROM clean
  UNION ALL SELECT 'kpi_tipo_pago',
    CAST(count(DISTINCT coalesce(payment_type, -1)) AS INT) FROM clean
  UNION ALL SELECT 'kpi_top_pickup_zones',
    CAST(least(20, count(DISTINCT PULocationID)) AS INT) FROM clean
  UNION ALL SELECT 'kpi_calidad', 1 + CAST(count(*) AS INT) FROM (""" + _QUALITY_NUMBERS + ")",
        "dash_run_summary": f"""SELECT * FROM (WITH summary AS ({_SUMMARY}) {_FIRST_CARDS}
  UNION ALL SELECT 4, 'Calidad', format('{{:.1f}}%', 100 * value), NULL
    FROM ({_QUALITY_NUMBERS}) WHERE metric = 'quality_score')""",
    }
    on_counts["report_single_file"] = f"""SELECT CAST(1 AS BIGINT) AS objects,
    'NYC TLC Yellow Taxi - January 2024' AS dataset, count(*) AS total_trips,
    CAST(count(DISTINCT pickup_date) AS INT) AS days, CAST(7 AS INT) AS facts, 'events' AS data_source
  FROM clean"""
    llm = _llm()
    single = {
        **{name: _TRIPS + sql for name, sql in on_trips.items()},
        **{name: _TRIPS + _COUNTS + sql for name, sql in on_counts.items()},
    }
    everything = _profile_rows(on_trips)
    reports = " UNION ALL ".join(
        _melted(report, single[key], item, measures)
        for report, key, item, measures in (
            ("nulls", "null_profile", '"column"', ("null_count", "null_pct")),
            ("numeric", "numeric_profile", '"column"', ("count", "mean", "stddev", "min", "max")),
            ("audit", "rule_audit", "rule", ("bad_rows", "bad_pct")),
            (
                "audit_after_cleaning", "rule_audit_clean", "rule",
                ("bad_rows_after_cleaning", "bad_pct_after_cleaning"),
            ),
            ("duplicates", "duplicate_summary", "metric", ("value",)),
            (
                "cleaning", "cleaning_summary", "'all'",
                ("original_rows", "clean_rows", "removed_rows", "removed_pct"),
            ),
            (
                "trips_by_hour", "trips_by_hour", "pickup_hour",
                ("trips", "avg_trip_distance", "avg_duration_min", "avg_total_amount"),
            ),
        )
    )

    def by_period(yellow: str, green: str) -> str:
        keys = ("'yellow' AS color, 2024 AS year, 1 AS month", "'green' AS color, 2025 AS year, 1 AS month")
        return " UNION ALL ".join(
            f"SELECT {key}, * FROM ({sql})" for key, sql in zip(keys, (yellow, green), strict=True)
        )

    def for_green(sql: str) -> str:
        return sql.replace(_TRIPS, _TRIPS_GREEN)

    periods = {
        f"{name}_periods": by_period(single[name], for_green(single[name]))
        for name in ("dash_top10_zones", "dash_run_summary", "dash_daily_series")
    }
    return (llm.oracle_sql() if llm else {}) | periods | {
        "profile_pass": everything,
        "profile_pass_one_scan": everything,
        "batch_reports": reports,
        "run_periods_twice": payment_periods,
        "dash_quality": single["kpi_quality"],
        "document_hours": single["kpi_by_hour"],
        "document_zones": single["kpi_top_zones"],
        "document_metadata": (
            "SELECT 'NYC TLC Yellow Taxi - January 2024' AS dataset, 'events' AS source_url, "
            "false AS sample_enabled, CAST(NULL AS DOUBLE) AS sample_fraction, "
            "'json' AS storage_format, 'streamlit' AS intended_consumer"
        ),
        "clean_clashing_names": single["clean_trips"],
        "quality_clashing_names": _TRIPS + _CLASHING_COUNTS
        + "SELECT 'data_source_used' AS metric, CAST(NULL AS DOUBLE) AS value UNION ALL "
        + f"SELECT metric, value FROM ({_QUALITY_NUMBERS})",
        "exact_kpi_summary": _ODD + _ODD_SUMMARY,
        "exact_kpi_by_hour": _ODD + _ODD_BY_HOUR,
        "exact_kpi_vast": _VAST + _VAST_BY_HOUR,
        "sample_rows": """SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER () - 1 AS place FROM events
) WHERE substr(md5('42:events.parquet:' || place), 1, 8) < '1999999a'""",
        "dash_payment_one_period": "SELECT 'green' AS color, 2025 AS year, 1 AS month, * FROM ("
        + for_green(single["dash_payment"]).replace(_payment(6), _payment(5)) + ")",
        "run_months_of_two_layouts": " UNION ALL ".join(
            f"SELECT 'yellow' AS color, 2024 AS year, {month} AS month, * FROM ({single['kpi_summary']})"
            for month in (1, 3)
        ),
        "preview_rows": _TRIPS + """SELECT pickup_ts, dropoff_ts, duration_min, passenger_count,
  trip_distance, fare_amount, total_amount FROM derived ORDER BY trip_id, pickup_ts LIMIT 10""",
        "describe_text": _TRIPS + _DESCRIBED,
        "run_stamp": "SELECT true AS is_utc_stamp, true AS is_now",
        **single,
        "numeric_profile_lineitem": _numeric("lineitem", _LINEITEM_NUMBERS),
        "duplicate_summary_lineitem": _duplicates("lineitem"),
        "numeric_profile_exact": _TRIPS + _numeric_exact(
            "trips", [(c, "1" if t == "bigint" else "1e9") for c, t in _RAW if t in ("bigint", "double")]
        ),
        "numeric_profile_lineitem_exact": _numeric_exact(
            "lineitem", [(c, "1" if c.endswith(("key", "number")) else "1e9") for c in _LINEITEM_NUMBERS]
        ),
        "clean_trips_green": clean_green,
        "kpi_by_payment_green": _TRIPS_GREEN + _payment(5),
        "run_for_request": _TRIPS_GREEN + _SUMMARY,
        "run_periods_payment": payment_periods,
    }
