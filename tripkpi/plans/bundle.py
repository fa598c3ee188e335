"""The KPI document: all sections of a run as one nested row, and as JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkpi.functions.text import literal, record, rows
from tripkpi.sources.sinks import single_file
from tripkpi.spec import TripSpec

# Section names, column names and column order of the document.

_FIGURES = "trips bigint, revenue double, avg_ticket double"
_LENGTH = "avg_trip_distance double, avg_duration_min double"

SECTIONS = {
    "kpi_resumen": (
        "total_trips bigint, total_revenue double, avg_ticket double, "
        f"{_LENGTH}, avg_tip double, avg_tip_pct double, avg_passenger_count double"
    ),
    "kpi_por_dia": f"pickup_date date, {_FIGURES}, {_LENGTH}, avg_tip double",
    "kpi_por_hora": f"pickup_hour int, {_FIGURES}, {_LENGTH}, avg_tip double",
    "kpi_tipo_pago": (
        f"payment_type bigint, payment_type_label string, {_FIGURES}, avg_tip double"
    ),
    "kpi_top_pickup_zones": f"PULocationID bigint, {_FIGURES}, {_LENGTH}",
    "kpi_calidad": "metric string, value double, value_text string",
}

METADATA = (
    "generated_at_utc string, dataset string, source_url string, sample_enabled boolean, "
    "sample_fraction double, storage_format string, intended_consumer string"
)

STORAGE_FORMAT = "json"
INTENDED_CONSUMER = "streamlit"

QUALITY_METRICS = (
    "data_source_used",
    "original_rows",
    "clean_rows",
    "removed_rows",
    "removed_pct",
    "quality_score",
    "duplicate_rows",
)

# End of fixed values.


# Sort keys of the sections; an array has to be put in order by itself.
_ORDER = {
    "kpi_resumen": [],
    "kpi_por_dia": ["pickup_date"],
    "kpi_por_hora": ["pickup_hour"],
    "kpi_tipo_pago": ["-trips", "payment_type"],
    "kpi_top_pickup_zones": ["-trips", "PULocationID"],
    "kpi_calidad": [f"array_position(array({', '.join(map(literal, QUALITY_METRICS))}), metric)"],
}


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def _type(ddl: str) -> str:
    return f"STRUCT<{', '.join(f'{f.name}: {f.dataType.simpleString()}' for f in _fields(ddl))}>"


def _records(table: DataFrame, section_name: str, by: Sequence[str]) -> DataFrame:
    """A section's rows as one array.

    Sections are short: days, hours, twenty zones, and payment codes, of which dirty data may have
    as many as it has distinct values. Rows are put in order here, so tables need not be sorted.
    """
    fields = _fields(SECTIONS[section_name])
    shown = record(**{f.name: f"CAST({f.name} AS {f.dataType.simpleString()})" for f in fields})
    keys = {f"key_{i}": key for i, key in enumerate(_ORDER[section_name])}
    keyed = f"array_sort(collect_list({record(**keys, shown=shown)}))"
    array = F.expr(f"transform({keyed}, row -> row.shown) AS {section_name}")
    return table.groupBy(*by).agg(array)


def run_metadata(
    spark: SparkSession,
    runs: Sequence[tuple[TripSpec, str]],
    sample_fraction: float | None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row of metadata for each spec and source, with the spec's period columns on request.

    All have the same time, that of this call: a document reads the same whenever it is computed.
    """
    stamp = datetime.now(UTC).isoformat(timespec="microseconds")
    tables = [
        f"SELECT {', '.join([*_period_values(spec, by), _metadata(spec, source, sample_fraction, stamp)])}"
        for spec, source in runs
    ]
    return spark.sql(" UNION ALL ".join(tables))


def _period_values(spec: TripSpec, by: Sequence[str]) -> list[str]:
    values = {"color": literal(spec.color), "year": str(spec.year), "month": str(spec.month)}
    return [f"{values[key]} AS {key}" for key in by]


def _metadata(spec: TripSpec, source: str, sample_fraction: float | None, stamp: str) -> str:
    fraction = "NULL" if sample_fraction is None else f"{sample_fraction!r}D"
    fields = record(
        generated_at_utc=literal(stamp),
        dataset=literal(spec.dataset),
        source_url=literal(source),
        sample_enabled=str(sample_fraction is not None).lower(),
        sample_fraction=f"CAST({fraction} AS DOUBLE)",
        storage_format=literal(STORAGE_FORMAT),
        intended_consumer=literal(INTENDED_CONSUMER),
    )
    return f"{fields} AS metadata"


def kpi_bundle(
    sections: Mapping[str, DataFrame], metadata: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """One row (one per period with ``by``) holding metadata and every section as an array."""
    pieces = [metadata, *[_records(sections[name], name, by) for name in SECTIONS]]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pieces)
    arrays = [
        f"coalesce(first({name}, true), CAST(array() AS ARRAY<{_type(ddl)}>)) AS {name}"
        for name, ddl in SECTIONS.items()
    ]
    document = "first(metadata, true) AS metadata"
    return stacked.groupBy(*by).agg(*map(F.expr, (document, *arrays)))


def write_bundle(bundle: DataFrame, uri: str, by: Sequence[str] = ()) -> None:
    """Write the document as JSON to any Hadoop-compatible store, keeping null fields.

    Without ``by`` the document is one JSON object at ``uri`` itself. With ``by`` each period has a
    folder, and only the folders of periods that are written are replaced; each document is then
    written by one of several tasks.
    """
    if not by:
        with single_file(bundle.sparkSession, uri) as folder:
            bundle.coalesce(1).write.option("ignoreNullFields", "false").json(folder)
        return
    writer = bundle.repartition(*by).write.mode("overwrite").option("ignoreNullFields", "false")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(uri)


# Fixed value: where the tables of the sections are, below the documents of several periods.
TABLES = "_sections"


def write_sections(bundle: DataFrame, uri: str, by: Sequence[str]) -> None:
    """The sections as a columnar table beside the documents, in a folder per section and period.

    Documents are for exchange; who needs one section of many periods would have to parse all of them.
    All sections are one table, with the columns that any of them has. Each section of each period has
    a row without a position too, so a section that has become empty replaces an older one.
    """
    names = ", ".join(map(literal, SECTIONS))
    parts = [bundle.selectExpr(f"explode(array({names})) AS section", *by, "CAST(NULL AS INT) AS position")]
    for name in SECTIONS:
        items = bundle.selectExpr(*by, f"posexplode({name}) AS (position, item)")
        parts.append(items.selectExpr(f"{literal(name)} AS section", *by, "position", "item.*"))
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    keys = ("section", *by)
    writer = table.repartition(*keys).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*keys)
    writer.parquet(f"{uri.rstrip('/')}/{TABLES}")


def read_section(
    spark: SparkSession, uri: str, name: str, by: Sequence[str], periods: str | None = None
) -> DataFrame:
    """One section of the documents below ``uri``, as ``section`` gives it, from the columnar table.

    Only the folders of the section are read, and of those the ones that ``periods``, a condition on the
    period columns, leaves.
    """
    if name not in SECTIONS:
        raise KeyError(f"no section {name!r}; there are {sorted(SECTIONS)}")
    fields = [f.name for f in _fields(SECTIONS[name])]
    stored = spark.read.parquet(f"{uri.rstrip('/')}/{TABLES}").where(F.col("section") == name)
    if periods:
        stored = stored.where(periods)
    return stored.where("position IS NOT NULL").select(*by, *fields)


def read_bundle(spark: SparkSession, uri: str) -> DataFrame:
    """Read a document back, also one written through pandas.

    There a payment type may be a float or NaN, and quality values are numbers and texts mixed;
    both are brought into the form ``kpi_bundle`` has. A document that is cut off, is no JSON or has
    values of other types raises an error when it is read.
    """
    loose = dict(SECTIONS)
    for name, strict, wide in (
        ("kpi_tipo_pago", "payment_type bigint", "payment_type double"),
        ("kpi_calidad", "value double", "value string"),
    ):
        loose[name] = loose[name].replace(strict, wide)
    columns = [f"metadata {_type(METADATA)}"]
    columns += [f"{name} ARRAY<{_type(ddl)}>" for name, ddl in loose.items()]
    reader = spark.read.schema(", ".join(columns))
    stored = reader.json(uri, multiLine=True, mode="FAILFAST")
    code = "CASE WHEN NOT isnan(row.payment_type) THEN CAST(row.payment_type AS BIGINT) END"
    payments = _rebuilt("kpi_tipo_pago", payment_type=code)
    number = "try_cast(row.value AS DOUBLE)"
    text = f"coalesce(row.value_text, CASE WHEN {number} IS NULL THEN row.value END)"
    facts = _rebuilt("kpi_calidad", value=number, value_text=text)
    return stored.withColumns({"kpi_tipo_pago": F.expr(payments), "kpi_calidad": F.expr(facts)})


def _rebuilt(section_name: str, **changes: str) -> str:
    """Expression for a section with some fields of its records computed anew."""
    kept = {f.name: f"row.{f.name}" for f in _fields(SECTIONS[section_name])}
    return f"transform({section_name}, row -> {record(**{**kept, **changes})})"


def section(bundle: DataFrame, name: str) -> DataFrame:
    """One section as a table, with the period columns if the document has any."""
    if name not in SECTIONS:
        raise KeyError(f"no section {name!r}; there are {sorted(SECTIONS)}")
    by = [c for c in bundle.columns if c not in SECTIONS and c != "metadata"]
    return bundle.selectExpr(*by, f"inline({name})")


def section_sizes(bundle: DataFrame) -> DataFrame:
    """section, records: what a document holds."""
    by = [c for c in bundle.columns if c not in SECTIONS and c != "metadata"]
    sizes = [record(section=literal(name), records=f"size({name})") for name in SECTIONS]
    return bundle.selectExpr(*by, rows(sizes))


def document_rows(bundle: DataFrame) -> DataFrame:
    """section, position, record (as JSON): all of a document in long form, metadata first.

    The time of the run is left out, so documents of equal runs have equal rows.
    """
    by = [c for c in bundle.columns if c not in SECTIONS and c != "metadata"]
    kept = ", ".join(
        f"'{f.name}', metadata.{f.name}" for f in _fields(METADATA) if f.name != "generated_at_utc"
    )
    options = "map('ignoreNullFields', 'false')"
    parts = [bundle.selectExpr(
        *by, "'metadata' AS section", "0 AS position",
        f"to_json(named_struct({kept}), {options}) AS record",
    )]
    for part in SECTIONS:
        exploded = bundle.selectExpr(*by, f"'{part}' AS section", f"posexplode({part}) AS (position, item)")
        parts.append(exploded.selectExpr(
            *by, "section", "position", f"to_json(item, {options}) AS record"
        ))
    return reduce(DataFrame.union, parts)
