import json
from datetime import date

import pytest
from trips import SPEC, frame, trip

from tripkpi.operators import feeds
from tripkpi.plans import bundle, job


@pytest.fixture(scope="module")
def run(spark):
    rows = [
        trip("a"),
        trip("b", payment_type=None, PULocationID=9),
        trip("c", PULocationID=9, minutes=60),
        trip("c", PULocationID=9, minutes=60),
        trip("bad", total_amount=-1.0),
    ]
    return job.kpis_of(frame(spark, rows), SPEC, "somewhere")


def written(path):
    return json.loads(path.read_text())


def test_document_is_plain_json_with_nulls_kept(run, tmp_path):
    bundle.write_bundle(run.bundle, str(tmp_path / "doc"))
    document = written(tmp_path / "doc")
    assert list(document) == ["metadata", *bundle.SECTIONS]
    assert document["metadata"]["dataset"] == "NYC TLC Yellow Taxi - January 2024"
    assert document["metadata"]["sample_enabled"] is False
    assert document["metadata"]["sample_fraction"] is None
    assert document["kpi_tipo_pago"][1]["payment_type"] is None
    assert document["kpi_tipo_pago"][0]["trips"] == 2
    assert document["kpi_por_dia"][0]["pickup_date"] == "2024-01-10"
    assert [z["PULocationID"] for z in document["kpi_top_pickup_zones"]] == [9, 7]
    assert [f["metric"] for f in document["kpi_calidad"]] == list(bundle.QUALITY_METRICS)
    facts = {f["metric"]: f["value"] for f in document["kpi_calidad"]}
    assert facts["original_rows"] == 5
    assert facts["clean_rows"] == 3
    assert facts["duplicate_rows"] == 1
    assert document["kpi_calidad"][0]["value_text"] == "somewhere"


def test_sections_come_back_as_written(spark, run, tmp_path):
    bundle.write_bundle(run.bundle, str(tmp_path / "doc"))
    back = bundle.read_bundle(spark, str(tmp_path / "doc"))
    for name, table in run.sections.items():
        section = bundle.section(back, name)
        assert section.columns == table.columns
        assert dict(section.dtypes) == dict(table.dtypes)
        assert [tuple(r) for r in section.collect()] == [tuple(r) for r in table.collect()]
    with pytest.raises(KeyError, match="kpi_nothing"):
        bundle.section(back, "kpi_nothing")


def test_dashboard_feeds_from_a_document(spark, run, tmp_path):
    bundle.write_bundle(run.bundle, str(tmp_path / "doc"))
    back = bundle.read_bundle(spark, str(tmp_path / "doc"))
    section = {name: bundle.section(back, name) for name in bundle.SECTIONS}
    days = feeds.dash_daily_series(section["kpi_por_dia"]).collect()
    assert [tuple(r) for r in days] == [(date(2024, 1, 10), 3)]
    assert tuple(feeds.dash_hourly_series(section["kpi_por_hora"]).first()) == (8, 3)
    assert feeds.dash_top_zones(section["kpi_top_pickup_zones"]).first()["PULocationID"] == 9
    payments = feeds.dash_payment(section["kpi_tipo_pago"])
    assert payments.first()["payment_type_label"] == "Credit card"
    assert feeds.dash_quality(section["kpi_calidad"]).count() == 7
    cards = feeds.dash_run_summary(section["kpi_resumen"], section["kpi_calidad"]).collect()
    assert [c["value"] for c in cards] == ["3", "$40.50", "$13.50", "60.0%"]


def test_document_written_through_pandas(spark, tmp_path):
    figures = {"trips": 2, "revenue": 3.5, "avg_ticket": 1.75, "avg_tip": float("nan")}
    document = {
        "metadata": {"dataset": "d", "sample_enabled": True, "sample_fraction": 0.1},
        "kpi_resumen": [{"total_trips": 2, "avg_tip": float("nan")}],
        "kpi_por_dia": [{"pickup_date": "2024-01-10", **figures}],
        "kpi_por_hora": [],
        "kpi_tipo_pago": [
            {"payment_type": 1.0, "payment_type_label": "Credit card", **figures},
            {"payment_type": float("nan"), "payment_type_label": "Other / null", **figures},
        ],
        "kpi_top_pickup_zones": [{"PULocationID": 7, "trips": 2}],
        "kpi_calidad": [
            {"metric": "data_source_used", "value": "file:///x"},
            {"metric": "original_rows", "value": 10},
            {"metric": "removed_pct", "value": 0.25},
        ],
    }
    path = tmp_path / "kpis.json"
    path.write_text(json.dumps(document, indent=2))
    back = bundle.read_bundle(spark, str(path))
    codes = [row["payment_type"] for row in bundle.section(back, "kpi_tipo_pago").collect()]
    assert codes == [1, None]
    facts = [tuple(row) for row in bundle.section(back, "kpi_calidad").collect()]
    assert facts == [
        ("data_source_used", None, "file:///x"),
        ("original_rows", 10.0, None),
        ("removed_pct", 0.25, None),
    ]
    assert bundle.section(back, "kpi_por_dia").first()["pickup_date"] == date(2024, 1, 10)


def test_empty_input_gives_a_whole_document(spark, tmp_path):
    nothing = job.kpis_of(frame(spark, []), SPEC, "nowhere")
    bundle.write_bundle(nothing.bundle, str(tmp_path / "doc"))
    document = written(tmp_path / "doc")
    assert document["kpi_resumen"][0]["total_trips"] == 0
    assert document["kpi_por_dia"] == []
    assert len(document["kpi_calidad"]) == 7


def test_a_broken_document_raises(spark, run, tmp_path):
    bundle.write_bundle(run.bundle, str(tmp_path / "doc"))
    text = (tmp_path / "doc").read_text()
    for name, broken in (("cut", text[: len(text) // 2]), ("typed", text.replace('"trips":', '"trips":[1],"x":', 1))):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(broken)
        with pytest.raises(Exception, match="(?i)malformed|parse"):
            bundle.read_bundle(spark, str(tmp_path / name)).collect()


def test_a_document_is_one_object_and_replaces_the_one_before(spark, run, tmp_path):
    path = tmp_path / "kpis" / "doc.json"
    bundle.write_bundle(run.bundle, str(path))
    first = path.read_text()
    broken = run.bundle.selectExpr("*", "raise_error('no') AS more")
    with pytest.raises(Exception, match="no"):
        bundle.write_bundle(broken, str(path))
    assert path.read_text() == first
    bundle.write_bundle(run.bundle.limit(1).selectExpr("metadata"), f"file://{path}")
    assert list(written(path)) == ["metadata"]
    left = sorted(p.name for p in path.parent.iterdir() if not p.name.endswith(".crc"))
    assert left == ["doc.json"]


def test_a_folder_of_an_earlier_version_is_replaced(spark, run, tmp_path):
    path = tmp_path / "doc.json"
    run.bundle.write.json(str(path))
    bundle.write_bundle(run.bundle, str(path))
    assert written(path)["kpi_resumen"][0]["total_trips"] == 3
    assert bundle.read_bundle(spark, str(path)).count() == 1


BY = ("color", "year", "month")


def periods(run, month):
    return run.bundle.selectExpr("'yellow' AS color", "2024 AS year", f"{month} AS month", "*")


def test_sections_of_periods_are_a_table(spark, run, tmp_path):
    uri = str(tmp_path / "kpis")
    both = periods(run, 1).union(periods(run, 2))
    bundle.write_bundle(both, uri, BY)
    bundle.write_sections(both, uri, BY)
    back = bundle.read_bundle(spark, uri)
    assert back.count() == 2
    for name in bundle.SECTIONS:
        want, got = bundle.section(back, name), bundle.read_section(spark, uri, name, BY)
        columns = got.columns
        assert sorted(columns) == sorted(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(columns).collect()))
        one = bundle.read_section(spark, uri, name, BY, "month = 2")
        assert 2 * one.count() == got.count()
    with pytest.raises(KeyError, match="kpi_nothing"):
        bundle.read_section(spark, uri, "kpi_nothing", BY)


def test_a_section_that_became_empty_replaces_an_older_one(spark, run, tmp_path):
    uri = str(tmp_path / "kpis")
    bundle.write_sections(periods(run, 1).union(periods(run, 2)), uri, BY)
    empty = job.kpis_of(frame(spark, []), SPEC, "nowhere")
    bundle.write_sections(periods(empty, 1), uri, BY)
    days = bundle.read_section(spark, uri, "kpi_por_dia", BY)
    assert [tuple(r) for r in days.select(*BY).distinct().collect()] == [("yellow", 2024, 2)]
