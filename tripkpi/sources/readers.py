"""Reading trips from any Hadoop-compatible store, and sampling them."""

from __future__ import annotations

import logging
import math
from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripkpi.functions.text import name

log = logging.getLogger(__name__)

SAMPLE_FRACTION = 0.10
SAMPLE_SEED = 42


def read_trips(spark: SparkSession, *uris: str) -> DataFrame:
    """Trips from Parquet files or directories, all of which have to be there."""
    try:
        return spark.read.parquet(*uris)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            missing = error.getMessageParameters().get("path", ", ".join(uris))
            raise FileNotFoundError(f"no trips at {missing}") from error
        raise


def read_first_available(spark: SparkSession, uris: Iterable[str]) -> tuple[DataFrame, str]:
    """Trips from the first location that can be read, and that location."""
    failures = []
    for uri in uris:
        try:
            return read_trips(spark, uri), uri
        except (FileNotFoundError, PySparkException, Py4JJavaError) as error:
            reason = str(error).splitlines()[0]
            log.warning("cannot read %s: %s", uri, reason)
            failures.append(f"{uri}: {reason}")
    raise FileNotFoundError("no readable source\n" + "\n".join(failures))


def read_by_layout(spark: SparkSession, uris: Sequence[str]) -> list[DataFrame]:
    """Trips from many locations, one table for each different set of columns and types.

    Only footers are read to tell layouts apart. Files that are written alike are scanned together, so
    the number of scans goes by layouts, which change every few years, not by files.
    """
    layouts: dict[tuple, list[str]] = {}
    for uri in uris:
        schema = read_trips(spark, uri).schema
        layouts.setdefault(tuple((f.name, f.dataType) for f in schema), []).append(uri)
    return [read_trips(spark, *alike) for alike in layouts.values()]


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.DateType, T.TimestampNTZType)


def common_type(column: str, types: Iterable[T.DataType]) -> T.DataType:
    """The type that a column has where files store it differently.

    Whole numbers become bigint, whole and other numbers double, dates and times times without a zone;
    a column without any value takes the others' type. Anything else, such as text beside numbers,
    cannot be the same quantity and is an error.
    """
    different = [t for t in dict.fromkeys(types) if not isinstance(t, T.NullType)]
    if len(different) < 2:
        return different[0] if different else T.NullType()
    if all(isinstance(t, _WHOLE) for t in different):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in different):
        return T.DoubleType()
    if all(isinstance(t, _TIMES) for t in different):
        return T.TimestampNTZType()
    shown = ", ".join(t.simpleString() for t in different)
    raise ValueError(f"column {column!r} is stored as {shown}")


def unite(tables: Sequence[DataFrame]) -> DataFrame:
    """Tables of different layouts as one: columns by name whatever their case, under the first name
    that they have, in their common type, null where a table lacks them."""
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    for table in tables:
        for field in table.schema:
            names.setdefault(field.name.lower(), field.name)
            types.setdefault(field.name.lower(), []).append(field.dataType)
    common = {c: common_type(names[c], found) for c, found in types.items()}

    def fitted(table: DataFrame) -> DataFrame:
        own = {f.name.lower(): f for f in table.schema}
        columns = []
        for c, shown in names.items():
            value = name(own[c].name) if c in own else "NULL"
            if c not in own or own[c].dataType != common[c]:
                value = f"CAST({value} AS {common[c].simpleString()})"
            columns.append(f"{value} AS {name(shown)}")
        return table.selectExpr(*columns)

    return reduce(DataFrame.union, map(fitted, tables))


def sample_trips(
    df: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    seed: int = SAMPLE_SEED,
    enabled: bool = True,
) -> DataFrame:
    """Bernoulli sample without replacement.

    Which rows are drawn depends on how the scan is split into partitions; ``file_sample``,
    ``hash_sample`` and ``row_sample`` draw the same rows under every split.
    """
    return df.sample(withReplacement=False, fraction=fraction, seed=seed) if enabled else df


def in_hash_sample(key: str, fraction: float = SAMPLE_FRACTION) -> str:
    """True for a repeatable share of the key values; a null key counts as a value of its own."""
    bound = _bound(fraction)
    if bound == 2**32:
        return "true"
    return f"substr(md5(coalesce(CAST({name(key)} AS STRING), '')), 1, 8) < '{bound:08x}'"


def _bound(fraction: float) -> int:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be in 0..1, got {fraction}")
    return math.ceil(fraction * 2**32)


def hash_sample(df: DataFrame, key: str, fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """Keep a repeatable share of the key values, by a digest that other SQL engines also have."""
    return df.filter(in_hash_sample(key, fraction))


def row_sample(
    df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = SAMPLE_SEED
) -> DataFrame:
    """Keep a repeatable share of the rows by content, for tables without a key.

    Copies of a row are kept or left out together, so duplicate shares stay comparable, and every
    pass over the input sees the same sample whatever number of executors it has. That has a price:
    a row that makes up a third of the table is in the sample as a whole or not at all, and the
    sample's size is off by as much. ``sample_trips`` draws copies one by one.
    """
    columns = ", ".join(name(c) for c in df.columns)
    return df.filter(f"pmod(xxhash64({seed}, {columns}), {2**32}L) < {_bound(fraction)}L")


def in_file_sample(fraction: float = SAMPLE_FRACTION, seed: int = SAMPLE_SEED) -> str:
    """True for a repeatable share of the rows of files, by file name and place in the file."""
    bound = _bound(fraction)
    if bound == 2**32:
        return "true"
    row = f"concat_ws(':', '{seed}', _metadata.file_name, CAST(_metadata.row_index AS STRING))"
    return f"substr(md5({row}), 1, 8) < '{bound:08x}'"


def file_sample(
    df: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = SAMPLE_SEED
) -> DataFrame:
    """Bernoulli sample of Parquet files that every pass sees alike.

    Each row is drawn by itself, so copies are drawn one by one and the sample has its size whatever
    repeats; which rows are drawn depends on nothing but where they are stored, so nothing has to be
    kept between passes, a lost task draws the same rows again, and no column is read for it. ``df``
    has to come straight from files. Their folder has no part in it: a copy of the files elsewhere
    gives the same sample, and files of one name in different folders draw the same places.
    """
    return df.filter(in_file_sample(fraction, seed))
