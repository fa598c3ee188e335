"""Whole runs.

What a run reads and moves, with N bytes of trips:

* one pass for the profile: counts, nulls, statistics and rules; each column is read once, and a
  run on a sample by content, which goes by all columns, scans once;
* one scan and a shuffle of the valid rows for the clean set, which is written;
* one scan and a shuffle of the rejected rows to count the distinct ones. Copies of a row are either
  all valid or all rejected, so with the clean set this gives the duplicates of the whole input, and
  every row has been shuffled once, not twice;
* one scan of the needed columns of the written clean set for a rollup, from which all KPI tables
  are taken.

The short run writes no clean set, so it needs one scan and one shuffle in all: distinct rows carry
how often they occur and whether they are valid into one rollup, from which come KPIs and counts.

A run over many periods does so once per colour and column layout, with the period among the keys: the
number of scans and shuffles does not depend on the number of periods.

Nothing of the size of the input is cached. Profile row, counts and rollup are checkpointed, so
losing an executor afterwards costs nothing. Runs that read by location have a session of their own,
with a shuffle width that goes by the size of their input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi.functions.derive import payment_label
from tripkpi.functions.text import literal, name, record, rows
from tripkpi.operators import kpis, profile, quality
from tripkpi.plans.bundle import kpi_bundle, run_metadata, write_bundle, write_sections
from tripkpi.session import run_session, settle
from tripkpi.sources import (
    SAMPLE_SEED,
    file_sample,
    read_by_layout,
    read_first_available,
    read_trips,
    reload_clean,
    row_sample,
    unite,
    write_clean,
)
from tripkpi.spec import PAYMENT_LABELS, TripSpec

PERIOD = ("color", "year", "month")

# How a run's sample is drawn: by row content or row by row; either is the same in every pass.
SAMPLES = {"content": row_sample, "bernoulli": file_sample}


@dataclass(frozen=True)
class Run:
    """What a run produced. Tables are DataFrames; nothing has been brought to the driver."""

    source: str
    sections: dict[str, DataFrame]
    bundle: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


def _stack(tables: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def _sections(
    rolled: DataFrame,
    counts: DataFrame,
    source: str,
    labels: Mapping[int, str] | str,
    by: Sequence[str] = (),
) -> dict[str, DataFrame]:
    return {
        "kpi_resumen": kpis.kpi_summary(rolled, by),
        "kpi_por_dia": kpis.kpi_by_day(rolled, by),
        "kpi_por_hora": kpis.kpi_by_hour(rolled, by),
        "kpi_tipo_pago": kpis.kpi_by_payment(rolled, labels, by),
        "kpi_top_pickup_zones": kpis.kpi_top_zones(rolled, by=by),
        "kpi_calidad": counts.selectExpr(*by, quality.quality_facts(source)),
    }


def _input(
    spark: SparkSession,
    sources: Sequence[str],
    sample_fraction: float | None,
    sample: str = "content",
    seed: int = SAMPLE_SEED,
) -> tuple[DataFrame, str]:
    _, source = read_first_available(spark, sources)
    raw = read_trips(run_session(spark, [source]), source)
    if sample_fraction is None:
        return raw, source
    if sample not in SAMPLES:
        raise ValueError(f"sample must be one of {sorted(SAMPLES)}, got {sample!r}")
    return SAMPLES[sample](raw, sample_fraction, seed), source


def kpis_of(
    trips: DataFrame, spec: TripSpec, source: str, sample_fraction: float | None = None
) -> Run:
    """KPIs and document of raw trips, without writing anything but a checkpoint."""
    parts = kpis.judged_parts(quality.judged_rows(trips, spec), spec)
    judged = settle(kpis.judged_rollup(parts))
    rolled, counts = kpis.valid_rollup(judged), kpis.judged_counts(judged)
    sections = _sections(rolled, counts, literal(source), spec.payment_labels)
    metadata = run_metadata(trips.sparkSession, [(spec, source)], sample_fraction)
    return Run(source, sections, kpi_bundle(sections, metadata))


def _all_counts(
    trips: DataFrame, spec: TripSpec, originals: DataFrame, rolled: DataFrame
) -> DataFrame:
    """original_rows, distinct_rows, clean_rows from what the passes of a full run counted."""
    rejects = quality.distinct_rejects(trips, spec).selectExpr("count(*) AS reject_rows")
    merged = quality.merged_by_cleaning(trips, spec)
    stacked = _stack([originals, rejects, kpis.trip_count(rolled), merged])
    names = ("original_rows", "reject_rows", "clean_rows", "merged_rows")
    summed = stacked.selectExpr(*[f"coalesce(sum({n}), 0L) AS {n}" for n in names])
    distinct = "clean_rows + merged_rows + reject_rows AS distinct_rows"
    return summed.selectExpr("original_rows", distinct, "clean_rows")


def run_kpis(
    spark: SparkSession,
    spec: TripSpec,
    sources: Sequence[str],
    report_uri: str,
    sample_fraction: float | None = None,
    sample: str = "content",
    seed: int = SAMPLE_SEED,
) -> Run:
    """The short run: read, sample on request, clean, compute KPIs, publish the document."""
    trips, source = _input(spark, sources, sample_fraction, sample, seed)
    run = kpis_of(trips, spec, source, sample_fraction)
    write_bundle(run.bundle, report_uri)
    return run


def run_batch(
    spark: SparkSession,
    spec: TripSpec,
    sources: Sequence[str],
    clean_uri: str,
    report_uri: str,
    sample_fraction: float | None = None,
    clean_by_date: bool = False,
    sample: str = "content",
    seed: int = SAMPLE_SEED,
    exact_profile: bool = False,
) -> Run:
    """The full run: profile and audit, clean and write, audit again, KPIs, document.

    ``exact_profile`` makes the profile's means and deviations the same to the last digit in each run.
    """
    trips, source = _input(spark, sources, sample_fraction, sample, seed)
    spark = trips.sparkSession
    checks = quality.rules(spec)
    # A sample by content takes all columns for each pass; any other rows are read column by column.
    one_scan = sample_fraction is not None and sample == "content"
    wide = settle(profile.profile_pass(trips, checks, one_scan, exact_profile))
    write_clean(quality.clean(trips, spec), clean_uri, by_date=clean_by_date)
    cleaned = reload_clean(spark, clean_uri)
    after = settle(profile.audit(cleaned, checks, "_after_cleaning"))
    rolled = settle(kpis.rollup(cleaned))
    originals = wide.selectExpr(f"{profile.TOTAL} AS original_rows")
    counts = settle(_all_counts(trips, spec, originals, rolled))
    sections = _sections(rolled, counts, literal(source), spec.payment_labels)
    bundle = kpi_bundle(sections, run_metadata(spark, [(spec, source)], sample_fraction))
    write_bundle(bundle, report_uri)
    reports = {
        "nulls": profile.null_table(wide, trips.columns),
        "numeric": profile.numeric_table(wide, trips.columns, profile.numeric_columns(trips)),
        "audit": profile.rule_table(wide, checks),
        "audit_after_cleaning": after,
        "duplicates": profile.duplicate_table(counts),
        "cleaning": quality.removed(counts),
        "trips_by_hour": kpis.trips_by_hour(rolled),
    }
    return Run(source, sections, bundle, reports)


# The column that names the rows of a report.
_ITEMS = {
    "nulls": "column",
    "numeric": "column",
    "audit": "rule",
    "audit_after_cleaning": "rule",
    "duplicates": "metric",
    "cleaning": None,
    "trips_by_hour": "pickup_hour",
}


def report_rows(run: Run) -> DataFrame:
    """report, item, measure, value (to four places): all reports of a full run in long form."""
    parts = []
    for report, table in run.reports.items():
        key = _ITEMS[report]
        item = f"CAST({name(key)} AS STRING)" if key else "'all'"
        measures = [
            record(item=item, measure=literal(c), value=f"round(CAST({name(c)} AS DOUBLE), 4)")
            for c in table.columns
            if c != key
        ]
        parts.append(table.selectExpr(f"{literal(report)} AS report", rows(measures)))
    return reduce(DataFrame.union, parts)


def run_for(
    spark: SparkSession,
    request: Mapping[str, object],
    root: str,
    sample_fraction: float | None = None,
) -> Run:
    """The short run for a ``{"mes", "anio", "color_taxi"}`` request, at the usual locations."""
    spec = TripSpec.from_request(request)
    sources = [spec.source_uri(root)]
    return run_kpis(spark, spec, sources, spec.report_uri(root), sample_fraction)


def trips_of_periods(spark: SparkSession, sources: Mapping[TripSpec, str]) -> dict[str, DataFrame]:
    """Trips by colour, those of all months in one table with the period that they were stored for.

    Months of a colour may have different columns, as when a fee is added, and store a column in
    different types; each layout is one scan, and they are united by name before anything else.
    """
    tables = {}
    for color in dict.fromkeys(spec.color for spec in sources):
        uris = [uri for spec, uri in sources.items() if spec.color == color]
        stored = r"regexp_extract(_metadata.file_path, '_tripdata_([0-9]{4})-([0-9]{2})', %d)"
        period = [f"CAST({stored % i} AS INT) AS {c}" for i, c in ((1, "year"), (2, "month"))]
        layouts = read_by_layout(spark, uris)
        tables[color] = unite(
            [t.selectExpr(f"{literal(color)} AS color", *period, "*") for t in layouts]
        )
    return tables


def kpis_of_periods(trips: Mapping[str, DataFrame], sources: Mapping[TripSpec, str]) -> Run:
    """KPIs and one document per colour and month, for many of them in one job.

    ``trips`` has, by colour, tables with PERIOD columns in front. Periods are keys like others:
    there is one branch per colour, however many months there are.
    """
    spark = next(iter(trips.values())).sparkSession
    parts = []
    for color, table in trips.items():
        spec = next(s for s in sources if s.color == color)
        own = quality.in_own_period(spec)
        parts.append(kpis.judged_parts(quality.judged_rows(table, spec, own), spec, PERIOD))
    judged = settle(kpis.judged_rollup(_stack(parts), PERIOD))
    rolled = kpis.valid_rollup(judged)
    # Periods without a row still have a document.
    asked = ", ".join(f"({literal(s.color)}, {s.year}, {s.month}, 0L, 0L, 0L)" for s in sources)
    names = (kpis.ORIGINAL, kpis.DISTINCT, "clean_rows")
    asked = spark.sql(
        f"SELECT * FROM VALUES {asked} AS t({', '.join(PERIOD)}, {', '.join(names)})"
    )
    both = asked.unionByName(kpis.judged_counts(judged, PERIOD))
    counts = both.groupBy(*PERIOD).agg(*[F.expr(f"sum({n}) AS {n}") for n in names])

    by_color = [
        f"WHEN {literal(color)} THEN {payment_label(names)}"
        for color, names in PAYMENT_LABELS.items()
    ]
    by_period = [
        f"WHEN {literal(f'{s.color}-{s.year}-{s.month}')} THEN {literal(uri)}"
        for s, uri in sources.items()
    ]
    labels = f"CASE color {' '.join(by_color)} END"
    source = f"CASE color || '-' || year || '-' || month {' '.join(by_period)} END"
    sections = _sections(rolled, counts, source, labels, PERIOD)
    metadata = run_metadata(spark, list(sources.items()), None, PERIOD)
    return Run("", sections, kpi_bundle(sections, metadata, PERIOD))


def run_periods(
    spark: SparkSession, specs: Sequence[TripSpec], root: str, report_uri: str
) -> Run:
    """The short run for many colours and months; documents land in color=/year=/month= folders, and
    their sections in a columnar table beside them.

    Documents of other periods that are there already stay.
    """
    sources = {spec: spec.source_uri(root) for spec in specs}
    for uri in sources.values():
        read_trips(spark, uri)  # tells which one is missing
    own = run_session(spark, list(sources.values()))
    run = kpis_of_periods(trips_of_periods(own, sources), sources)
    documents = settle(run.bundle)
    write_bundle(documents, report_uri, PERIOD)
    write_sections(documents, report_uri, PERIOD)
    return run
