"""Every query against its SQL counterpart in DuckDB, on the given tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

TESTDATA = "/root/testdata"
SCALES = ("sf0.001", "sf0.01")


@pytest.fixture(scope="module", params=SCALES)
def scale(request):
    directory = f"{TESTDATA}/{request.param}"
    if not os.path.isdir(directory):
        pytest.skip(f"{directory} is not there")
    connection = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield directory, connection
    connection.close()


def _sorted_rows(rows):
    return sorted(map(tuple, rows), key=lambda row: [(v is not None, str(v)) for v in row])


NAMES = sorted(query.__name__ for query in entry_points._QUERIES)


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, scale, name):
    directory, connection = scale
    got = entry_points.queries()[name](spark, directory)
    want = connection.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    types = {d[0]: str(d[1]) for d in want.description}
    want_rows = _sorted_rows(want.fetchall())
    got_rows = _sorted_rows(got.select(*[f"`{n}`" for n in names]).collect())
    assert got_rows == want_rows
    assert got_rows, "an empty result proves nothing"
    spark_types = {f.name: f.dataType.simpleString() for f in got.schema}
    expected = {
        "BIGINT": "bigint",
        "INTEGER": "int",
        "DOUBLE": "double",
        "VARCHAR": "string",
        "DATE": "date",
        "BOOLEAN": "boolean",
    }
    for column, kind in types.items():
        if kind == "TIMESTAMP":
            assert spark_types[column] in ("timestamp", "timestamp_ntz"), column
        else:
            assert spark_types[column] == expected[kind], column


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 30
    assert sum(row["trips"] for row in rows) == 660
