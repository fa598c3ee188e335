from types import SimpleNamespace

import pytest
from trips import frame, trip

from tripkpi import fixtures, session
from tripkpi.fixtures import GREEN, YELLOW
from tripkpi.operators import quality
from tripkpi.plans import bundle, job
from tripkpi.spec import TripSpec as session_spec


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("store"))
    for spec in (YELLOW, GREEN):
        table = fixtures.trips(spark, "/root/testdata/sf0.001", spec)
        table.write.parquet(spec.source_uri(folder))
    return folder


@pytest.fixture(scope="module")
def batch(spark, root):
    sources = [f"{root}/elsewhere", YELLOW.source_uri(root)]
    return job.run_batch(
        spark, YELLOW, sources, YELLOW.clean_uri(root), f"{root}/batch.json", clean_by_date=True
    )


def rows(table):
    return [tuple(row) for row in table.collect()]


def facts(run):
    return {row["metric"]: row["value"] for row in run.sections["kpi_calidad"].collect()}


def test_batch_reports(spark, root, batch):
    assert batch.source == YELLOW.source_uri(root)
    assert rows(batch.reports["duplicates"]) == [
        ("total_rows", 1010),
        ("distinct_rows", 1000),
        ("duplicate_rows", 10),
    ]
    assert rows(batch.reports["cleaning"]) == [(1010, 660, 350, 350 / 1010)]
    audit = {row["rule"]: row["bad_rows"] for row in batch.reports["audit"].collect()}
    assert audit["passenger_count_out_of_range"] == 247
    after = batch.reports["audit_after_cleaning"].collect()
    assert len(after) == 12
    assert all(row["bad_rows_after_cleaning"] == 0 for row in after)
    nulls = batch.reports["nulls"].first()
    assert (nulls["column"], nulls["null_count"]) == ("payment_type", 92)
    assert batch.reports["numeric"].count() == 8
    assert sum(row["trips"] for row in batch.reports["trips_by_hour"].collect()) == 660
    assert spark.read.parquet(YELLOW.clean_uri(root)).count() == 660


def test_split_count_equals_the_single_shuffle_count(spark, root, batch):
    table = spark.read.parquet(YELLOW.source_uri(root))
    original, distinct, kept = quality.quality_counts(table, YELLOW).first()
    got = facts(batch)
    assert got["original_rows"] == original
    assert got["clean_rows"] == kept
    assert got["duplicate_rows"] == original - distinct


def test_short_run_gives_the_same_sections(spark, root, batch):
    run = job.run_kpis(spark, YELLOW, [YELLOW.source_uri(root)], f"{root}/short.json")
    for name, table in batch.sections.items():
        assert rows(run.sections[name]) == rows(table), name
    sizes = dict(rows(bundle.section_sizes(bundle.read_bundle(spark, f"{root}/short.json"))))
    assert sizes["kpi_por_dia"] == 30
    assert sizes["kpi_top_pickup_zones"] == 15


def test_request_and_periods(spark, root, batch):
    green = job.run_for(spark, {"mes": "01", "anio": 2025, "color_taxi": "green"}, root)
    stored = bundle.read_bundle(spark, GREEN.report_uri(root))
    assert stored.select("metadata.dataset").first()[0] == GREEN.dataset
    job.run_periods(spark, [YELLOW, GREEN], root, f"{root}/all")
    together = bundle.read_bundle(spark, f"{root}/all")
    for spec, run in ((YELLOW, batch), (GREEN, green)):
        mine = together.filter(f"color = '{spec.color}' AND year = {spec.year} AND month = 1")
        assert mine.count() == 1
        for name, table in run.sections.items():
            section = bundle.section(mine, name).drop(*job.PERIOD)
            assert rows(section) == rows(table), (spec, name)


def test_sampled_run_compares_like_with_like(spark, root):
    sources = [YELLOW.source_uri(root)]
    run = job.run_kpis(spark, YELLOW, sources, f"{root}/sampled.json", sample_fraction=0.5)
    got = facts(run)
    assert 400 < got["original_rows"] < 620
    assert 0.5 < got["quality_score"] < 0.8
    stored = bundle.read_bundle(spark, f"{root}/sampled.json").select("metadata.*").first()
    assert (stored["sample_enabled"], stored["sample_fraction"]) == (True, 0.5)


def test_a_third_of_all_rows_may_be_one_row_and_one_zone(spark):
    hot = [trip("hot")] * 400
    cold = [trip(str(i), PULocationID=i % 30, minutes=1 + i % 60) for i in range(800)]
    run = job.kpis_of(frame(spark, hot + cold), YELLOW, "x")
    got = facts(run)
    assert (got["original_rows"], got["clean_rows"], got["duplicate_rows"]) == (1200, 801, 399)


def test_time_zone_has_no_part_in_results(spark, root, batch):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        run = job.run_kpis(spark, YELLOW, [YELLOW.source_uri(root)], f"{root}/x.json")
        for name, table in batch.sections.items():
            assert rows(run.sections[name]) == rows(table), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bernoulli_sample_is_the_same_in_all_passes(spark, root):
    sources = [YELLOW.source_uri(root)]
    run = job.run_kpis(spark, YELLOW, sources, f"{root}/b.json", 0.5, sample="bernoulli", seed=7)
    got = facts(run)
    assert 400 < got["original_rows"] < 620
    assert got["original_rows"] - got["removed_rows"] == got["clean_rows"]
    with pytest.raises(ValueError, match="sample"):
        job.run_kpis(spark, YELLOW, sources, f"{root}/b.json", 0.5, sample="other")


def test_periods_of_other_runs_stay_and_a_missing_one_is_named(spark, root):
    report = f"{root}/twice"
    job.run_periods(spark, [YELLOW], root, report)
    job.run_periods(spark, [GREEN], root, report)
    assert bundle.read_bundle(spark, report).count() == 2
    absent = session_spec("yellow", 2024, 7)
    with pytest.raises(FileNotFoundError, match="2024-07"):
        job.run_periods(spark, [YELLOW, absent], root, report)


def test_a_document_has_one_time(spark, root):
    run = job.kpis_of(spark.read.parquet(YELLOW.source_uri(root)), YELLOW, "x")
    times = {run.bundle.select("metadata.generated_at_utc").first()[0] for _ in range(2)}
    assert len(times) == 1


def _session(master, named):
    conf = SimpleNamespace(get=lambda key, default=None: named)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_folder():
    on_cluster = _session("yarn", "/shared/place/")
    assert session.shared_folder(on_cluster) == "/shared/place"
    assert session.scratch_uri(on_cluster, "t").startswith("/shared/place/tripkpi/t-")
    assert session.shared_folder(_session("local[8]", None)).startswith("file://")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(_session("yarn", None))


def test_scratch_tables_go_with_their_run(spark):
    kept = session.scratch_uri(spark, "kept")
    spark.range(3).write.parquet(kept)
    with pytest.raises(ZeroDivisionError), session.own_scratch(spark):
        gone = [session.scratch_uri(spark, "gone") for _ in range(3)]
        spark.range(3).write.parquet(gone[0])
        spark.range(3).write.parquet(gone[1])
        assert spark.read.parquet(gone[0]).count() == 3
        raise ZeroDivisionError
    for uri in gone:
        with pytest.raises(Exception, match="PATH_NOT_FOUND"):
            spark.read.parquet(uri)
    assert spark.read.parquet(kept).count() == 3


def test_shuffle_width_follows_the_input_of_each_run(spark, root):
    uris = [YELLOW.source_uri(root)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    narrow = session.run_session(spark, uris)
    wide = session.run_session(spark, uris, bytes_per_task=1000)
    assert narrow.conf.get("spark.sql.shuffle.partitions") == before
    assert int(wide.conf.get("spark.sql.shuffle.partitions")) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    zone = "spark.sql.session.timeZone"
    assert wide.conf.get(zone) == spark.conf.get(zone)


def test_a_full_run_on_a_bernoulli_sample(spark, root):
    sources = [YELLOW.source_uri(root)]
    run = job.run_batch(
        spark, YELLOW, sources, f"{root}/sampled_clean", f"{root}/sampled_full.json", 0.5, sample="bernoulli"
    )
    got, short = facts(run), facts(job.run_kpis(spark, YELLOW, sources, f"{root}/s.json", 0.5, sample="bernoulli"))
    assert got == short
    assert 400 < got["original_rows"] < 620


def test_months_of_other_layouts_are_as_if_run_alone(spark, tmp_path):
    root, later = str(tmp_path), session_spec("yellow", 2024, 3)
    trips = fixtures.trips(spark, "/root/testdata/sf0.001")
    trips.write.parquet(YELLOW.source_uri(root))
    moved = trips.selectExpr(
        "* EXCEPT (passenger_count, tpep_pickup_datetime, tpep_dropoff_datetime)",
        "tpep_pickup_datetime + INTERVAL '60' DAY AS tpep_pickup_datetime",
        "tpep_dropoff_datetime + INTERVAL '60' DAY AS tpep_dropoff_datetime",
        "CAST(passenger_count AS DOUBLE) AS Passenger_Count", "trip_id % 3 AS fee",
        "trip_id % 2 AS duration_min",
    )
    # Rows that differ in the further column alone are different trips; one that a derived column
    # replaces makes no difference.
    moved = moved.union(moved.selectExpr("* EXCEPT (fee, duration_min)", "fee + 3", "duration_min"))
    moved = moved.union(moved.selectExpr("* EXCEPT (duration_min)", "duration_min + 2"))
    moved.write.parquet(later.source_uri(root))
    job.run_periods(spark, [YELLOW, later], root, f"{root}/kpis")
    together = bundle.read_bundle(spark, f"{root}/kpis")
    for spec in (YELLOW, later):
        alone = job.run_kpis(spark, spec, [spec.source_uri(root)], f"{root}/{spec.month}.json")
        mine = together.filter(f"month = {spec.month}")
        for part, table in alone.sections.items():
            got, want = rows(bundle.section(mine, part).drop(*job.PERIOD)), rows(table)
            if part == "kpi_calidad":
                got, want = ([r for r in x if r[0] != "data_source_used"] for x in (got, want))
            assert got == want, (spec, part)
