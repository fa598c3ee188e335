"""Profiling: schema, nulls, numeric statistics, duplicates.

Everything but the duplicate count is global counting: ``profile_pass`` computes it as a single
wide row and the ``*_table`` functions reshape that row. The functions named after a single report
build just their own part of the row.

A wide table takes a few aggregates side by side in one job, each over some of the columns: the code
that Spark generates for dozens of statistics at once is several times slower than the same work in
portions. Parquet is columnar, and columns that a rule needs together are in one portion, so no column
is read more than once for it.

Rules are SQL conditions by name, as ``quality.rules`` gives them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce
from itertools import batched

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripkpi.functions.text import literal, name, record, rows
from tripkpi.session import settle

TOTAL = "total_rows"

NUMERIC_SCHEMA = "column string, count bigint, mean double, stddev double, min double, max double"

# Columns per aggregate. On 20 million trips, 17 numeric columns took 20 s in one aggregate and 3 s
# six at a time.
STATISTICS_AT_ONCE = 6
COUNTS_AT_ONCE = 32

# Digests of repeated rows that are broadcast, at 16 bytes each; more are joined by merging.
MOST_DIGESTS = 100_000

# The columns of the preview.
PREVIEW_COLUMNS = (
    "pickup_ts",
    "dropoff_ts",
    "duration_min",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def audit_preview(derived: DataFrame, n: int | None = 10) -> DataFrame:
    """The columns one looks at before cleaning; all rows if ``n`` is None."""
    chosen = derived.select(*PREVIEW_COLUMNS)
    return chosen if n is None else chosen.limit(n)


def describe_numeric(df: DataFrame) -> DataFrame:
    """Spark's own describe() over the numeric columns: statistics as rows, values as strings."""
    return df.select(*[name(c) for c in numeric_columns(df)]).describe()


# The wide row. Columns are addressed by position, so that any column name is safe.


def _filled(columns: list[str], chosen: Iterable[int]) -> list[str]:
    return [f"count({name(columns[i])}) AS filled_{i}" for i in chosen]


# Values are counted in billionths where they have fractions; units have 18 digits at most.
_UNITS, _MOST_UNITS = 1_000_000_000, 10**18
# Smaller values, and a standard deviation of fewer units, have lost digits by counting in billionths.
_LEAST_VALUE, _LEAST_UNITS = "0.01D", "1e4D"


def _is_whole(df: DataFrame, i: int) -> bool:
    return isinstance(df.schema[i].dataType, T.IntegralType)


def _units(value: str, whole: bool) -> str:
    """A value as a whole number of units, or null if it has none."""
    if whole:
        return f"CASE WHEN {value} BETWEEN {1 - _MOST_UNITS}L AND {_MOST_UNITS - 1}L THEN CAST({value} AS BIGINT) END"
    small = f"abs({value}) < {_MOST_UNITS // _UNITS}D"
    fraction = f"CAST(rint(({value} - floor({value})) * {_UNITS}D) AS BIGINT)"
    return f"CASE WHEN {small} THEN floor({value}) * {_UNITS}L + {fraction} END"


def _sums(value: str, units: str) -> dict[str, str]:
    """What moments are made from. ``value`` is a double."""
    narrow = f"CAST({units} AS DECIMAL(18, 0))"
    return {
        "n": f"count({units})",
        "total": f"try_sum({narrow})",
        "squares": f"try_sum({narrow} * {narrow})",
        "mean": f"avg({value})",
        "stddev": f"stddev_samp({value})",
        "min": f"min({value})",
        "max": f"max({value})",
    }


def _moments(sums: str) -> str:
    """mean and stddev of each of an array of ``_sums`` with filled and whole, in the same order.

    Sums of values and of squares are exact: whole numbers of units, as decimals, so they are the same
    in whichever order rows come. With S the sum, n the count, m = S div n and r the rest, the squares'
    sum less m (S + r) is the exact sum of squares about m. Where a value is not finite or too large, a
    sum overflows, or values or deviations are too small for the unit, Spark's own mean and deviation stand in,
    whose last digits depend on the order.
    """
    exact = f"transform({sums}, s -> struct(s, s.n > 0 AND s.n = s.filled AND s.total IS NOT NULL AS exact))"
    middles = f"transform({exact}, x -> struct(x.*, IF(x.exact, CAST(x.s.total div x.s.n AS DECIMAL(19, 0)), NULL) AS m))"
    middles = middles.replace("x.*", "x.s AS s, x.exact AS exact")
    rests = f"transform({middles}, x -> struct(x.s AS s, x.exact AS exact, x.m AS m, x.s.total - x.m * x.s.n AS r))"
    about = "try_subtract(x.s.squares, try_multiply(x.m, CAST(x.s.total + x.r AS DECIMAL(38, 0))))"
    moment = f"CAST({about} AS DOUBLE) - CAST(x.r AS DOUBLE) * CAST(x.r AS DOUBLE) / x.s.n"
    deviation = f"IF(x.exact AND x.s.n > 1, sqrt(({moment}) / (x.s.n - 1)), NULL)"
    unit = f"IF(x.s.whole, 1D, {_UNITS}D)"
    large = f"(x.s.whole OR greatest(abs(x.s.min), abs(x.s.max)) >= {_LEAST_VALUE})"
    mean = f"IF(x.exact AND {large}, (CAST(x.m AS DOUBLE) + CAST(x.r AS DOUBLE) / x.s.n) / {unit}, x.s.mean)"
    found = f"transform({rests}, x -> struct(x.s AS s, {mean} AS mean, {unit} AS unit, {deviation} AS d))"
    enough = f"x.d IS NOT NULL AND (x.s.whole OR x.s.min = x.s.max OR x.d >= {_LEAST_UNITS})"
    return f"transform({found}, x -> struct(x.mean AS mean, IF({enough}, x.d / x.unit, x.s.stddev) AS stddev))"


_FAST = ("mean", "stddev", "min", "max")


def _statistics(df: DataFrame, i: int, exact: bool) -> list[str]:
    column = name(df.columns[i])
    value = f"CAST({column} AS DOUBLE)"
    sums = _sums(value, _units(column if _is_whole(df, i) else value, _is_whole(df, i)))
    return [f"{sql} AS {key}_{i}" for key, sql in sums.items() if exact or key in _FAST]


def _with_moments(wide: DataFrame, df: DataFrame, positions: list[int]) -> DataFrame:
    """The wide row with means and deviations in place of what they are made from."""
    if not positions:
        return wide
    sums = [
        record(**{key: f"{key}_{i}" for key in ("n", "total", "squares", "mean", "stddev", "min", "max", "filled")},
               whole=str(_is_whole(df, i)).lower())
        for i in positions
    ]
    gone = {f"{key}_{i}" for i in positions for key in ("n", "total", "squares", "mean", "stddev")}
    kept = [name(c) for c in wide.columns if c not in gone]
    made = [f"__moments[{k}].{s} AS {s}_{i}" for k, i in enumerate(positions) for s in ("mean", "stddev")]
    rows_ = wide.selectExpr(*kept, f"array({', '.join(sums)}) AS __sums")
    return rows_.selectExpr(*kept, f"{_moments('__sums')} AS __moments").selectExpr(*kept, *made)


def _violations(rules: Mapping[str, str]) -> list[str]:
    return [f"count(CASE WHEN {bad} THEN 1 END) AS {name(rule)}" for rule, bad in rules.items()]


_COUNT = f"count(*) AS {TOTAL}"


def _portions(positions: Iterable[int], size: int) -> list[tuple[int, ...]]:
    return list(batched(positions, size))


def _wide(df: DataFrame, portions: list[list[str]]) -> DataFrame:
    """One row from several aggregates over the same table."""
    parts = [df.selectExpr(*portion) for portion in portions]
    if len(parts) == 1:
        return parts[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.selectExpr(*[f"max({name(c)}) AS {name(c)}" for c in stacked.columns])


def _null_portions(df: DataFrame) -> list[list[str]]:
    columns = df.columns
    portions = _portions(range(len(columns)), COUNTS_AT_ONCE)
    return [[*([] if i else [_COUNT]), *_filled(columns, p)] for i, p in enumerate(portions)]


def _numeric_portions(df: DataFrame, exact: bool) -> list[list[str]]:
    columns, wanted = df.columns, set(numeric_columns(df))
    numeric = [i for i, c in enumerate(columns) if c in wanted]
    return [
        _filled(columns, p) + [s for i in p for s in _statistics(df, i, exact)]
        for p in _portions(numeric, STATISTICS_AT_ONCE)
    ]


def _rule_groups(df: DataFrame, rules: Mapping[str, str]) -> list[tuple[set[int], list[str]]]:
    """Rules with the columns that they name, joined where they share any."""
    groups: list[tuple[set[int], list[str]]] = []
    for rule, bad in rules.items():
        words = {w.lower() for w in re.findall(r"\w+", bad)}
        used = {i for i, c in enumerate(df.columns) if c.lower() in words}
        shared = [g for g in groups if g[0] & used]
        groups = [g for g in groups if not g[0] & used]
        columns = used.union(*(g[0] for g in shared))
        groups.append((columns, [r for g in shared for r in g[1]] + [rule]))
    return groups


def profile_pass(
    df: DataFrame,
    rules: Mapping[str, str] | None = None,
    one_scan: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Row count, nulls, numeric statistics and rule violations: one wide row.

    Columns are dealt out to portions, those that a rule names together to the same one, so each
    column is read once. If finding a row takes all columns anyway, as in a sample by row content,
    ``one_scan`` makes a row of each value instead and groups them by column.

    ``exact`` means and deviations are the same to the last digit in every run, at up to three times the
    time of Spark's own.
    """
    rules = rules or {}
    if one_scan:
        return _long_pass(df, rules, exact)
    wanted = set(numeric_columns(df))
    numeric = {i for i, c in enumerate(df.columns) if c in wanted}
    grouped = _rule_groups(df, rules)
    free = [i for i in range(len(df.columns)) if not any(i in g[0] for g in grouped)]
    portions = [(set(p), []) for p in _portions([i for i in free if i in numeric], STATISTICS_AT_ONCE)]
    portions += [(set(p), []) for p in _portions([i for i in free if i not in numeric], COUNTS_AT_ONCE)]
    # Small groups of rules share a portion with others as long as statistics stay few.
    for columns, names in sorted(grouped, key=lambda g: -len(g[0])):
        for held, rest in portions:
            if rest and len((held | columns) & numeric) <= STATISTICS_AT_ONCE:
                held |= columns
                rest += names
                break
        else:
            portions.append((set(columns), list(names)))
    expressions = [
        _filled(df.columns, sorted(held))
        + [s for i in sorted(held & numeric) for s in _statistics(df, i, exact)]
        + _violations({r: rules[r] for r in rules if r in names})
        for held, names in portions
    ]
    if not expressions:
        expressions = [[]]
    expressions[0] = [_COUNT, *expressions[0]]
    wide = _wide(df, expressions)
    return _with_moments(wide, df, sorted(numeric)) if exact else wide


def _long_pass(df: DataFrame, rules: Mapping[str, str], exact: bool) -> DataFrame:
    """The wide row from one scan: (key, value, counts) rows, grouped by key."""
    wanted = set(numeric_columns(df))
    nothing = {"value": "CAST(NULL AS DOUBLE)", "whole": "false"}
    records = [record(key="-1", counts="true", **nothing)]
    for i, c in enumerate(df.columns):
        value = {"value": f"CAST({name(c)} AS DOUBLE)", "whole": str(_is_whole(df, i)).lower()}
        counts = f"{name(c)} IS NOT NULL"
        records.append(record(key=str(i), counts=counts, **(value if c in wanted else nothing)))
    for j, bad in enumerate(rules.values()):
        key = str(len(df.columns) + j)
        records.append(record(key=key, counts=f"coalesce({bad}, false)", **nothing))
    values = df.selectExpr(rows(records))
    units = f"IF(whole, {_units('value', True)}, {_units('value', False)})"
    sums = _sums("value", units)
    wanted_sums = [F.expr(f"{sql} AS {c}") for c, sql in sums.items() if exact or c in _FAST]
    grouped = values.groupBy("key", "whole").agg(F.expr("count_if(counts) AS filled"), *wanted_sums)
    stats = grouped.withColumnRenamed("filled", "n")
    if exact:
        one = record(**{c: c for c in (*sums, "filled", "whole")})
        found = f"{_moments(f'array({one})')}[0] AS __found"
        stats = grouped.selectExpr("key", "filled AS n", "min", "max", found)
        stats = stats.selectExpr("key", "n", "min", "max", "__found.mean AS mean", "__found.stddev AS stddev")

    def pick(key: int, what: str) -> str:
        return f"max(CASE WHEN key = {key} THEN {what} END)"

    columns = [f"coalesce({pick(-1, 'n')}, 0L) AS {TOTAL}"]
    for i, c in enumerate(df.columns):
        columns.append(f"coalesce({pick(i, 'n')}, 0L) AS filled_{i}")
        if c in wanted:
            columns += [f"{pick(i, s)} AS {s}_{i}" for s in ("mean", "stddev", "min", "max")]
    for j, rule in enumerate(rules):
        columns.append(f"coalesce({pick(len(df.columns) + j, 'n')}, 0L) AS {name(rule)}")
    return stats.selectExpr(*columns)


def profile_rows(
    df: DataFrame, rules: Mapping[str, str], one_scan: bool = False, exact: bool = False
) -> DataFrame:
    """part, item, value: all that ``profile_pass`` finds, in long form; means to four places."""
    wide = profile_pass(df, rules, one_scan, exact)
    wanted = set(numeric_columns(df))
    found = [("rows", "all", TOTAL)]
    for i, c in enumerate(df.columns):
        found.append(("nulls", c, f"{TOTAL} - filled_{i}"))
        if c in wanted:
            found += [(s, c, f"round({s}_{i}, 4)") for s in ("mean", "stddev")]
            found += [(s, c, f"{s}_{i}") for s in ("min", "max")]
    found += [("rule", r, name(r)) for r in rules]
    return wide.selectExpr(
        rows(
            [
                record(part=literal(p), item=literal(c), value=f"CAST({v} AS DOUBLE)")
                for p, c, v in found
            ]
        )
    )


def _share(part: str) -> str:
    return f"CASE WHEN {TOTAL} > 0 THEN ({part}) / {TOTAL} ELSE 0D END"


def null_table(wide: DataFrame, columns: list[str]) -> DataFrame:
    """column, null_count, null_pct from a wide row, most nulls first."""
    records = []
    for i, column in enumerate(columns):
        nulls = f"{TOTAL} - filled_{i}"
        records.append(
            record(column=literal(column), null_count=nulls, null_pct=_share(nulls))
        )
    return wide.selectExpr(rows(records)).orderBy(F.desc("null_count"), "column")


def numeric_table(
    wide: DataFrame, columns: list[str], numeric: list[str], digits: int | None = None
) -> DataFrame:
    """column, count, mean, stddev, min, max from a wide row; mean and stddev rounded on request."""

    def shown(value: str) -> str:
        return value if digits is None else f"round({value}, {digits})"

    records = []
    for column in numeric:
        i = columns.index(column)
        records.append(
            record(
                column=literal(column),
                count=f"filled_{i}",
                mean=shown(f"mean_{i}"),
                stddev=shown(f"stddev_{i}"),
                min=f"min_{i}",
                max=f"max_{i}",
            )
        )
    return wide.selectExpr(rows(records))


def rule_table(wide: DataFrame, rules: Mapping[str, str], suffix: str = "") -> DataFrame:
    """rule, bad_rows, bad_pct from a wide row, worst first."""
    records = [
        record(
            rule=literal(rule),
            **{f"bad_rows{suffix}": name(rule), f"bad_pct{suffix}": _share(name(rule))},
        )
        for rule in rules
    ]
    return wide.selectExpr(rows(records)).orderBy(F.desc(f"bad_rows{suffix}"), "rule")


# Single reports.


def schema_summary(df: DataFrame) -> DataFrame:
    """ordinal, column, type, nullable, and how many rows have a value."""
    records = [
        record(
            ordinal=str(i + 1),
            column=literal(field.name),
            type=literal(field.dataType.simpleString()),
            nullable=str(field.nullable).lower(),
            filled_rows=f"filled_{i}",
        )
        for i, field in enumerate(df.schema)
    ]
    return _wide(df, _null_portions(df)).selectExpr(rows(records))


def null_profile(df: DataFrame) -> DataFrame:
    return null_table(_wide(df, _null_portions(df)), df.columns)


def numeric_profile(df: DataFrame, digits: int | None = None, exact: bool = False) -> DataFrame:
    numeric = numeric_columns(df)
    if not numeric:
        return df.sparkSession.createDataFrame([], NUMERIC_SCHEMA)
    wide = _wide(df, _numeric_portions(df, exact))
    if exact:
        wide = _with_moments(wide, df, [df.columns.index(c) for c in numeric])
    return numeric_table(wide, df.columns, numeric, digits)


def audit(df: DataFrame, rules: Mapping[str, str], suffix: str = "") -> DataFrame:
    """Bad rows and their share per rule. Rules are counted one by one and may overlap."""
    return rule_table(df.selectExpr(_COUNT, *_violations(rules)), rules, suffix)


def _digests(columns: list[str]) -> list[str]:
    """Two 64-bit hashes of a row that have nothing in common. Hashing skips nulls, so which columns are
    null is hashed too."""
    named = [name(c) for c in columns]
    empty = [
        " + ".join(f"shiftleft(CAST({c} IS NULL AS BIGINT), {i})" for i, c in enumerate(some))
        for some in batched(named, 63)
    ]
    first, second = [*empty, *named], ["'second'", *reversed(named), *empty]
    return [f"xxhash64({', '.join(h)}) AS __h{i}" for i, h in enumerate((first, second), start=1)]


def row_kinds(df: DataFrame, **flags: str) -> DataFrame:
    """original_rows, distinct_rows and, for each flag, the distinct rows that it holds for, as one row.

    Rows are grouped by digest first: some 30 bytes of each are shuffled, not the row. A digest that
    comes once is one distinct row. Those that come more than once are settled, which takes a job, and
    their rows, only theirs, are grouped by all columns, so equal digests of different rows do no harm.
    Up to MOST_DIGESTS of them are broadcast to pick these rows out before any shuffle; more are joined
    by merging. Copies are merged before each shuffle, so a row that makes up a third of the table costs
    no more than any other.
    """
    if not df.columns:
        counts = [f"least(count(*), 1L) AS {c}" for c in ("distinct_rows", *flags)]
        return df.selectExpr("count(*) AS original_rows", *counts)
    names = ("original_rows", "distinct_rows", *flags)
    held = [f"coalesce({held}, false) AS __{flag}" for flag, held in flags.items()]
    counted = [F.expr("count(*) AS __copies"), *[F.expr(f"bool_or(__{f}) AS __{f}") for f in flags]]
    digested = df.selectExpr("*", *_digests(df.columns))
    digests = digested.selectExpr("__h1", "__h2", *held).groupBy("__h1", "__h2").agg(*counted)
    # Digests that come once become one line; the others keep theirs, whose distinct rows are open.
    open_ = "__copies > 1"
    lines = (
        digests.selectExpr(
            f"IF({open_}, __h1, NULL) AS __a1", f"IF({open_}, __h2, NULL) AS __a2", "__copies AS original_rows",
            *[f"IF({open_}, 0L, CAST({h} AS BIGINT)) AS {c}" for c, h in
              (("distinct_rows", "true"), *[(f, f"__{f}") for f in flags])],
        )
        .groupBy("__a1", "__a2")
        .agg(*[F.expr(f"sum({c}) AS {c}") for c in names])
    )
    lines = settle(lines)
    again = lines.where("__a1 IS NOT NULL").select("__a1", "__a2")
    n_again = again.count()
    total = lines.select(*names)
    if n_again:
        again = F.broadcast(again) if n_again <= MOST_DIGESTS else again.hint("merge")
        repeated = digested.join(again, F.expr("__h1 = __a1 AND __h2 = __a2"), "left_semi")
        columns = [name(c) for c in df.columns]
        kinds = repeated.selectExpr(*columns, *held).groupBy(*columns).agg(*counted)
        per_flag = [f"count_if(__{flag}) AS {flag}" for flag in flags]
        total = total.union(kinds.selectExpr("0L AS original_rows", "count(*) AS distinct_rows", *per_flag))
    return total.selectExpr(*[f"coalesce(sum({c}), 0L) AS {c}" for c in names])


def duplicate_summary(df: DataFrame) -> DataFrame:
    """total_rows, distinct_rows, duplicate_rows over all columns."""
    return duplicate_table(row_kinds(df))


def duplicate_table(counts: DataFrame) -> DataFrame:
    """metric, value from a row of counts."""
    metrics = {
        "total_rows": "original_rows",
        "distinct_rows": "distinct_rows",
        "duplicate_rows": "original_rows - distinct_rows",
    }
    records = [record(metric=literal(metric), value=value) for metric, value in metrics.items()]
    return counts.selectExpr(rows(records))
