"""The clean set on disk, and single files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def write_clean(df: DataFrame, uri: str, by_date: bool = False) -> None:
    """Write the clean set, replacing what is there.

    ``by_date`` lays it out in one folder per pick-up date. The rebalance hint lets adaptive
    execution split busy dates over several tasks and merge quiet ones, so neither a huge file nor
    a swarm of small ones results.
    """
    if by_date:
        balanced = df.hint("rebalance", "pickup_date")
        balanced.write.mode("overwrite").partitionBy("pickup_date").parquet(uri)
    else:
        df.write.mode("overwrite").parquet(uri)


def reload_clean(spark: SparkSession, uri: str) -> DataFrame:
    """The written clean set; its columns come in the written order, partition columns last."""
    return spark.read.parquet(uri)


@contextmanager
def single_file(spark: SparkSession, uri: str) -> Iterator[str]:
    """A folder to write a one-part table to; the part becomes the object at ``uri`` at the end.

    Spark writes folders, and who reads a document wants one object. The folder is beside the object, so
    that the last step is a rename: on file systems that have it, a reader sees the old document or
    the new one, whole. If writing fails, the old one stays as it is. A folder at ``uri`` that an
    earlier version has written is replaced.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        path.toUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    target = files.makeQualified(path)
    folder = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_{target.getName()}-{uuid.uuid4().hex}")
    try:
        yield folder.toString()
        parts = files.util().listStatus(folder)
        parts = [p.getPath() for p in parts if p.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"{len(parts)} parts were written where one object is wanted")
        if files.util().exists(target) and files.getFileStatus(target).isDirectory():
            files.delete(target, True)
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        replace = spark.sparkContext._gateway.new_array(rename, 1)
        replace[0] = rename.OVERWRITE
        files.rename(parts[0], target, replace)
    finally:
        files.delete(folder, True)
