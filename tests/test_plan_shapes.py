"""Plans stay what they should be at scale: pushed filters, pruned columns, no cross joins."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry_points
from tripkpi import fixtures
from tripkpi.fixtures import YELLOW
from tripkpi.operators import kpis, profile, quality
from tripkpi.plans import bundle, job
from tripkpi.sources import file_sample, read_trips, row_sample
from tripkpi.spec import TripSpec


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("trips"))
    raw_uri, clean_uri = f"{folder}/raw", f"{folder}/clean"
    fixtures.trips(spark, "/root/testdata/sf0.001").write.parquet(raw_uri)
    quality.clean(read_trips(spark, raw_uri), YELLOW).write.parquet(clean_uri)
    return read_trips(spark, raw_uri), read_trips(spark, clean_uri)


def test_cleaning_filters_reach_the_scan(stored):
    text = plan(quality.clean(stored[0], YELLOW))
    (pushed,) = re.findall(r"PushedFilters: \[(.*)\]", text)
    for wanted in (
        "GreaterThanOrEqual(tpep_pickup_datetime,2024-01-01T00:00)",
        "LessThan(tpep_pickup_datetime,2024-02-01T00:00)",
        "GreaterThan(trip_distance,0.0)",
        "LessThanOrEqual(trip_distance,100.0)",
        "GreaterThanOrEqual(passenger_count,1)",
        "GreaterThanOrEqual(fare_amount,0.0)",
        "GreaterThanOrEqual(total_amount,0.0)",
    ):
        assert wanted in pushed


def test_derived_columns_are_not_shuffled(stored):
    text = plan(quality.clean(stored[0], YELLOW))
    (keys,) = re.findall(r"Arguments: hashpartitioning\((.*), \d+\)", text)
    assert "pickup_ts" not in keys
    assert "trip_id" in keys
    assert text.count("Exchange") == plan(stored[0].distinct()).count("Exchange")


def test_kpis_read_only_their_columns(stored):
    text = plan(kpis.kpi_by_payment(stored[1], YELLOW.payment_labels))
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    names = {field.split(":")[0] for field in schema.split(",")}
    assert names == {"payment_type", "total_amount", "tip_amount"}


def test_top_zones_are_not_fully_sorted(stored):
    text = plan(kpis.kpi_top_zones(stored[1]))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


def test_ranking_per_period_is_cut_before_the_shuffle(stored):
    tagged = stored[1].selectExpr("'yellow' AS color", "trip_id % 3 AS part", "*")
    text = plan(kpis.kpi_top_zones(tagged, by=["color", "part"]))
    assert "WindowGroupLimit" in text


def test_rollup_takes_one_scan(stored):
    text = plan(kpis.rollup(stored[1]))
    assert len(re.findall(r"Scan parquet\s+\(\d+\)", text)) == 1
    assert "Expand" in text


def test_profile_reads_each_column_once(stored):
    for rules in ({}, quality.rules(YELLOW)):
        text = plan(profile.profile_pass(stored[0], rules))
        read = [f for s in re.findall(r"ReadSchema: struct<(.*)>", text) for f in s.split(",") if f]
        assert len(read) == len(set(read)) == len(stored[0].columns)


def test_sampled_profile_scans_once(stored):
    sampled = row_sample(stored[0], 0.1)
    text = plan(profile.profile_pass(sampled, quality.rules(YELLOW), one_scan=True))
    assert len(re.findall(r"Scan parquet\s+\(\d+\)", text)) == 1


def _periods_plan(spark, months):
    sources = {TripSpec("yellow", 2024, m): "uri" for m in range(1, months + 1)}
    spec = next(iter(sources))
    table = fixtures.trips(spark, "/root/testdata/sf0.001").selectExpr(
        "'yellow' AS color", "2024 AS year", f"trip_id % {months} + 1 AS month", "*"
    )
    judged = quality.judged_rows(table, spec, quality.in_own_period(spec))
    return plan(kpis.judged_rollup(kpis.judged_parts(judged, spec, job.PERIOD), job.PERIOD))


def test_shuffles_do_not_grow_with_the_number_of_periods(spark):
    one, many = _periods_plan(spark, 2), _periods_plan(spark, 12)
    assert one.count("Exchange") == many.count("Exchange")


@pytest.mark.parametrize("name", sorted(query.__name__ for query in entry_points._QUERIES))
def test_no_cross_joins_and_no_python_workers(spark, name):
    text = plan(entry_points.queries()[name](spark, "/root/testdata/sf0.001"))
    unwanted = ["Cartesian", "NestedLoop", "Python", "Pandas"]
    # Duplicates broadcast digests whose number has been counted.
    if name not in ("duplicate_summary", "kpi_quality"):
        unwanted.append("Broadcast")
    for word in unwanted:
        assert word not in text


def test_the_short_run_scans_once_and_shuffles_rows_once(stored):
    parts = kpis.judged_parts(quality.judged_rows(stored[0], YELLOW), YELLOW)
    text = plan(kpis.judged_rollup(parts))
    assert len(re.findall(r"Scan parquet\s+\(\d+\)", text)) == 1
    shuffles = re.findall(r"Arguments: hashpartitioning\((.*), \d+\)", text.split("Initial Plan")[0])
    assert len([s for s in shuffles if "trip_id" in s]) == 1
    assert len(shuffles) == 2


def largest_method(spark, df):
    """Bytes of the largest method that Spark generates for a plan."""
    package = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$")
    parts = getattr(package, "MODULE$").codegenStringSeq(df._jdf.queryExecution().executedPlan())
    return max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size()))


def test_generated_methods_are_short_enough_to_be_compiled(spark):
    still = spark.newSession()
    still.conf.set("spark.sql.adaptive.enabled", "false")
    trips = fixtures.trips(still, "/root/testdata/sf0.001")
    cleaned = quality.clean(trips, YELLOW)
    judged = kpis.judged_parts(quality.judged_rows(trips, YELLOW), YELLOW)
    tables = {
        "clean": cleaned,
        "rejects": quality.distinct_rejects(trips, YELLOW),
        "counts": quality.quality_counts(trips, YELLOW),
        "rollup": kpis.rollup(cleaned),
        "judged": kpis.judged_rollup(judged),
        "audit": profile.audit(trips, quality.rules(YELLOW)),
    }
    sizes = {name: largest_method(spark, table) for name, table in tables.items()}
    assert max(sizes.values()) < 8000, sizes


def test_digests_are_shuffled_in_place_of_rows(stored):
    text = plan(profile.duplicate_summary(stored[0]))
    assert "BroadcastHashJoin LeftSemi" in text


def test_a_file_sample_reads_no_column_for_it(stored):
    text = plan(file_sample(stored[0]).select("fare_amount"))
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    # The row's place is counted, not stored.
    assert schema == "fare_amount:double,_tmp_metadata_row_index:bigint"


def test_a_section_of_a_period_reads_its_folders_alone(spark, tmp_path):
    trips = fixtures.trips(spark, "/root/testdata/sf0.001")
    run = job.kpis_of(trips, YELLOW, "x")
    uri, by = str(tmp_path), ("color", "month")
    table = run.bundle.selectExpr("'yellow' AS color", "1 AS month", "*")
    bundle.write_sections(table, uri, by)
    text = plan(bundle.read_section(spark, uri, "kpi_por_dia", by, "month = 1"))
    (filters,) = re.findall(r"PartitionFilters: \[(.*)\]", text)
    assert "section" in filters and "month" in filters
    (schema,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert "pickup_date" in schema and "payment_type" not in schema and "metric" not in schema
