import pytest
from trips import SPEC, frame, trip

from tripkpi.operators import quality
from tripkpi.sources import (
    file_sample,
    hash_sample,
    read_by_layout,
    read_first_available,
    read_trips,
    reload_clean,
    row_sample,
    sample_trips,
    unite,
    write_clean,
)


@pytest.fixture(scope="module")
def many(spark):
    return spark.range(10_000).selectExpr("id AS trip_id", "id % 7 AS v")


def ids(df):
    return sorted(row["trip_id"] for row in df.collect())


def test_file_and_directory(spark, tmp_path):
    folder = str(tmp_path / "trips")
    frame(spark, [trip("a"), trip("b")]).coalesce(1).write.parquet(folder)
    single = next(str(p) for p in (tmp_path / "trips").glob("*.parquet"))
    assert read_trips(spark, folder).count() == read_trips(spark, single).count() == 2


def test_missing_source_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        read_trips(spark, str(tmp_path / "nowhere"))


def test_falls_back_and_says_what_was_used(spark, tmp_path):
    good, empty, text = (str(tmp_path / n) for n in ("good", "empty", "text"))
    frame(spark, [trip()]).write.parquet(good)
    (tmp_path / "empty").mkdir()
    (tmp_path / "text").mkdir()
    (tmp_path / "text" / "x.parquet").write_text("no parquet")
    sources = [str(tmp_path / "no"), empty, text, "nosuchstore://x/y", good]
    table, used = read_first_available(spark, sources)
    assert used == good
    assert table.count() == 1
    with pytest.raises(FileNotFoundError, match="nosuchstore"):
        read_first_available(spark, sources[:-1])


def test_bernoulli_sample_can_be_switched_off(many):
    assert sample_trips(many, enabled=False) is many
    drawn = sample_trips(many)
    assert ids(drawn) == ids(drawn)
    assert 800 < drawn.count() < 1200


@pytest.mark.parametrize("sample", [lambda d, f: hash_sample(d, "trip_id", f), row_sample])
def test_repeatable_samples_do_not_depend_on_layout(many, sample):
    drawn = ids(sample(many, 0.1))
    assert 800 < len(drawn) < 1200
    assert ids(sample(many.repartition(7), 0.1)) == drawn
    assert set(drawn) <= set(ids(sample(many, 0.3)))
    assert sample(many, 0.0).count() == 0
    assert sample(many, 1.0).count() == 10_000
    with pytest.raises(ValueError):
        sample(many, 1.5)


def test_a_null_key_is_a_key(spark):
    table = spark.createDataFrame([(None,), (None,)], "trip_id bigint")
    assert hash_sample(table, "trip_id", 1.0).count() == 2
    assert hash_sample(table, "trip_id", 0.5).count() in (0, 2)


def test_copies_stay_together_in_a_row_sample(many):
    twice = many.union(many)
    drawn = row_sample(twice, 0.2)
    assert drawn.count() == 2 * drawn.distinct().count()


@pytest.mark.parametrize("by_date", [False, True])
def test_clean_set_on_disk(spark, tmp_path, by_date):
    uri = str(tmp_path / "clean")
    rows = [trip(str(i), minutes=10 + i) for i in range(20)] + [trip("0", minutes=10)]
    cleaned = quality.clean(frame(spark, rows), SPEC)
    for _ in range(2):
        write_clean(cleaned, uri, by_date=by_date)
    back = reload_clean(spark, uri)
    assert sorted(back.columns) == sorted(cleaned.columns)
    assert dict(back.dtypes) == dict(cleaned.dtypes)
    assert back.select(cleaned.columns).exceptAll(cleaned).count() == 0
    assert back.count() == 20


def test_a_file_sample_draws_copies_apart_and_alike_in_each_pass(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 1).selectExpr("7 AS trip_id", "'x' AS v")
    rows.write.parquet(str(tmp_path / "a"))
    stored = read_trips(spark, str(tmp_path / "a"))
    drawn = file_sample(stored, 0.1)
    assert drawn.columns == stored.columns
    assert 1800 < drawn.count() < 2200
    places = "_metadata.file_name", "_metadata.row_index"
    keys = sorted(map(tuple, drawn.select(*places).collect()))
    with_small_splits = spark.newSession()
    with_small_splits.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    again = file_sample(read_trips(with_small_splits, str(tmp_path / "a")), 0.1)
    assert sorted(map(tuple, again.select(*places).collect())) == keys
    (tmp_path / "a").rename(tmp_path / "b")
    moved = file_sample(read_trips(spark, str(tmp_path / "b")), 0.1)
    assert sorted(map(tuple, moved.select(*places).collect())) == keys
    assert file_sample(moved, 1.0).count() == len(keys)
    other = file_sample(read_trips(spark, str(tmp_path / "b")), 0.1, seed=1)
    assert sorted(map(tuple, other.select(*places).collect())) != keys


def test_layouts_are_read_together_and_united_by_name(spark, tmp_path):
    months = {
        "a": "SELECT 1 AS id, 2 AS passenger_count, date'2024-01-02' AS at",
        "b": "SELECT 3L AS id, 4D AS Passenger_Count, timestamp_ntz'2024-01-02 03:00:00' AS at, 5 AS fee",
        "c": "SELECT 6 AS id, 7 AS passenger_count, date'2024-01-03' AS at",
    }
    uris = []
    for month, sql in months.items():
        uris.append(str(tmp_path / month))
        spark.sql(sql).write.parquet(uris[-1])
    tables = read_by_layout(spark, uris)
    assert sorted(t.count() for t in tables) == [1, 2]
    table = unite(tables)
    assert dict(table.dtypes) == {"id": "bigint", "passenger_count": "double", "at": "timestamp_ntz", "fee": "int"}
    got = sorted(map(tuple, table.select("id", "passenger_count", "fee").collect()))
    assert got == [(1, 2.0, None), (3, 4.0, 5), (6, 7.0, None)]
    assert unite(tables[:1]).columns == tables[0].columns
    text = spark.sql("SELECT 'one' AS id")
    with pytest.raises(ValueError, match="'id' is stored as"):
        unite([*tables, text])
