"""What the text operators share: words, Arrow batches of bounded size, tables written between jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tripkpi.session import scratch_uri

# A word is a run of anything but space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"

# Rows and characters that are held as Python objects at a time.
SLICE_ROWS = 256
SLICE_BYTES = 4 * 1024 * 1024


def schema_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, which outlives lost executors."""
    uri = scratch_uri(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.parquet(uri)


def slices(batch: pa.RecordBatch, text: str | None = None) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that are short in rows and, but for single long texts, in bytes."""
    if text is None:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    at, size = 0, 0
    for i, length in enumerate(lengths):
        if i > at and (size + length > SLICE_BYTES or i - at >= SLICE_ROWS):
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += length
    if at < batch.num_rows:
        yield batch.slice(at)


def map_rows(
    df: DataFrame,
    ddl: str | StructType,
    function: Callable[[pa.RecordBatch], Sequence],
    text: str | None = None,
    make: Callable[[], Callable] | None = None,
) -> DataFrame:
    """``df`` through ``function``, which turns part of a batch into the columns of ``ddl``.

    With ``make``, the function is built once in each task and ``function`` is ignored. Rows depend
    on nothing but themselves, so a lost task is simply run again.
    """
    schema = schema_of(ddl) if isinstance(ddl, str) else ddl
    arrow = to_arrow_schema(schema)

    def run(batches):
        work = make() if make is not None else function
        for batch in batches:
            for part in slices(batch, text):
                columns = work(part)
                arrays = [
                    c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                    for c, f in zip(columns, arrow, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)
