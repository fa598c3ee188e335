import math
import random
import statistics
from fractions import Fraction

from tripkpi.operators import profile


def test_any_column_name_is_safe(spark):
    names = ["a.b", "c`d", "it's", "back\\slash", "select"]
    table = spark.createDataFrame([(1, 2.0, None, "x", 5), (1, None, None, "y", 5)], _types(names))
    nulls = {row["column"]: row["null_count"] for row in profile.null_profile(table).collect()}
    assert nulls == {"a.b": 0, "c`d": 1, "it's": 2, "back\\slash": 0, "select": 0}
    assert profile.numeric_columns(table) == ["a.b", "c`d", "it's", "select"]
    numbers = {row["column"]: row for row in profile.numeric_profile(table).collect()}
    assert numbers["it's"]["count"] == 0
    assert numbers["it's"]["mean"] is None
    assert [row["column"] for row in profile.schema_summary(table).collect()] == names
    kinds = {row["metric"]: row["value"] for row in profile.duplicate_summary(table).collect()}
    assert kinds == {"total_rows": 2, "distinct_rows": 2, "duplicate_rows": 0}


def _types(names):
    from pyspark.sql import types as T

    kinds = [T.LongType(), T.DoubleType(), T.IntegerType(), T.StringType(), T.LongType()]
    return T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])


def test_many_numeric_columns_in_portions(spark):
    width = 2 * profile.STATISTICS_AT_ONCE + 1
    values = [[float(r * (c + 1)) for c in range(width)] for r in range(5)]
    table = spark.createDataFrame(values, [f"n{c}" for c in range(width)])
    wide = profile.profile_pass(table, {"big": "n1 > 5"})
    assert wide.count() == 1
    names = profile.numeric_columns(table)
    got = profile.numeric_table(wide, table.columns, names).collect()
    assert [row["column"] for row in got] == names
    for c, row in enumerate(got):
        column = [r[c] for r in values]
        assert row["count"] == 5
        assert row["mean"] == statistics.mean(column)
        assert math.isclose(row["stddev"], statistics.stdev(column))
        assert (row["min"], row["max"]) == (min(column), max(column))
    assert profile.rule_table(wide, {"big": ""}).first()["bad_rows"] == 2
    single = profile.numeric_profile(table).collect()
    assert [row.asDict() for row in single] == [row.asDict() for row in got]


def test_describe_agrees_with_the_typed_form(spark):
    values = [(1, 2.5, "a"), (4, None, "b"), (7, 0.5, "c")]
    table = spark.createDataFrame(values, "i int, d double, s string")
    described = {row["summary"]: row.asDict() for row in profile.describe_numeric(table).collect()}
    for row in profile.numeric_profile(table).collect():
        for statistic in ("count", "mean", "stddev", "min", "max"):
            assert float(described[statistic][row["column"]]) == float(row[statistic])
    assert "s" not in described["count"]


def test_tables_without_rows_or_numbers(spark):
    table = spark.createDataFrame([], "s string")
    assert profile.numeric_profile(table).collect() == []
    assert tuple(profile.null_profile(table).first()) == ("s", 0, 0.0)
    assert [row["value"] for row in profile.duplicate_summary(table).collect()] == [0, 0, 0]


def test_copies_of_one_row_are_counted(spark):
    table = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "0D AS v")
    kinds = [row["value"] for row in profile.duplicate_summary(table).collect()]
    assert kinds == [3000, 2001, 999]


def test_duplicates_by_digest(spark):
    rows = [(None, "a", 1.0), ("a", None, 1.0), ("a", None, 1.0), (None, None, None), (None, None, None)]
    rows += [("x", "y", 0.0), ("x", "y", -0.0), ("x", "y", float("nan")), ("x", "y", float("nan")), ("y", "x", 0.0)]
    table = spark.createDataFrame(rows + [("hot", "row", 2.0)] * 500, "a string, b string, c double")
    flagged = profile.row_kinds(table, hot="a = 'hot'", named="a IS NOT NULL").first()
    assert tuple(flagged) == (510, 7, 1, 5)
    assert tuple(profile.row_kinds(table.limit(0), hot="true").first()) == (0, 0, 0)
    assert tuple(profile.row_kinds(table.select(), all="true").first()) == (510, 1, 1)


def test_equal_digests_of_different_rows_do_no_harm(spark, monkeypatch):
    monkeypatch.setattr(profile, "_digests", lambda columns: ["1L AS __h1", "id % 2 AS __h2"])
    table = spark.range(30).union(spark.range(10))
    assert tuple(profile.row_kinds(table, small="id < 5").first()) == (40, 30, 5)
    monkeypatch.setattr(profile, "MOST_DIGESTS", 0)
    assert tuple(profile.row_kinds(table, small="id < 5").first()) == (40, 30, 5)


def test_exact_moments_do_not_depend_on_order(spark):
    random.seed(6)
    rows = [
        (random.randint(-10**6, 10**6), random.choice((0.01, 0.1, 19.99, 1e6 + 0.1)), 10.0**8 + i % 2 / 1000)
        for i in range(3000)
    ]
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        table = spark.createDataFrame(rows, "a bigint, b double, c double").repartition(1 + 3 * seed)
        for one_scan in (False, True):
            wide = profile.profile_pass(table, one_scan=one_scan, exact=True).first()
            found.add(tuple(wide[f"{s}_{i}"] for i in range(3) for s in ("mean", "stddev")))
    assert len(found) == 1
    for i, (mean, deviation) in enumerate(zip(*[iter(found.pop())] * 2)):
        values = [Fraction(round(Fraction(r[i]) * 10**9), 10**9) for r in rows]
        assert math.isclose(mean, float(statistics.mean(values)), rel_tol=1e-15)
        assert math.isclose(deviation, statistics.stdev(values), rel_tol=1e-14)


def test_exact_moments_of_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    columns = {
        "one": [5.25, None, None, None],
        "same": [5.25] * 4,
        "nothing": [None] * 4,
        "tiny": [1e-12, 2e-12, 3e-12, 4e-12],
        "vast": [1e300, 1.0, 2.0, 3.0],
        "endless": [inf, 1.0, 2.0, 3.0],
        "odd": [nan, 1.0, 2.0, 3.0],
    }
    table = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    table = table.selectExpr("*", "CAST(9e18 AS BIGINT) AS long", "CAST(1.5 AS DECIMAL(5, 1)) AS dec", "1Y AS byte")
    exact = {r["column"]: r for r in profile.numeric_profile(table, exact=True).collect()}
    for r in profile.numeric_profile(table).collect():
        got = exact[r["column"]]
        assert got["count"] == r["count"]
        for s in ("mean", "stddev"):
            a, b = got[s], r[s]
            assert a == b or (a != a and b != b) or math.isclose(a, b, rel_tol=1e-9), (r["column"], s)
    empty = profile.numeric_profile(table.limit(0), exact=True).collect()
    assert all(r["mean"] is None and r["stddev"] is None for r in empty)
