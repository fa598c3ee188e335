from datetime import datetime

import pytest

from tripkpi.spec import TripSpec


@pytest.mark.parametrize("args", [("blue", 2024, 1), ("green", 2024, 13)])
def test_rejects_what_is_out_of_range(args):
    with pytest.raises(ValueError):
        TripSpec(*args)


@pytest.mark.parametrize("year", [2023, 2031])
def test_only_requests_are_held_to_the_pickers_years(year):
    assert TripSpec("yellow", year, 1).year == year
    with pytest.raises(ValueError, match="year"):
        TripSpec.from_request({"mes": "01", "anio": year, "color_taxi": "yellow"})


def test_december_ends_with_the_year():
    spec = TripSpec("yellow", 2024, 12)
    assert (spec.start, spec.end) == (datetime(2024, 12, 1), datetime(2025, 1, 1))


def test_color_decides_on_columns_and_labels():
    yellow, green = TripSpec("yellow", 2024, 1), TripSpec("green", 2025, 1)
    assert yellow.pickup_column == "tpep_pickup_datetime"
    assert green.dropoff_column == "lpep_dropoff_datetime"
    assert yellow.payment_labels[6] == "Voided trip"
    assert 6 not in green.payment_labels


def test_request_in_codes_or_names():
    codes = TripSpec.from_request({"mes": "09", "anio": 2026, "color_taxi": "green"})
    names = TripSpec.from_request({"mes": "Septiembre", "anio": "2026", "color_taxi": "Verde"})
    assert codes == names == TripSpec("green", 2026, 9)


def test_locations_and_names():
    spec = TripSpec("green", 2025, 1)
    source = "raw/taxis/green/2025/01/green_tripdata_2025-01.parquet"
    assert spec.source_uri("s3a://bucket/") == f"s3a://bucket/{source}"
    assert spec.report_uri("/r") == "/r/kpis/green_tripdata_2025_01_kpis.json"
    assert spec.clean_uri("/r") == "/r/clean/green_tripdata_2025_01_clean"
    assert spec.outside_rule == "pickup_outside_2025_01"
    assert spec.dataset == "NYC TLC Green Taxi - January 2025"
