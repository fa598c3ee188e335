"""Session set-up and what a run needs of one: a scratch folder and a shuffle width of its own."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Parquet bytes behind one shuffle task; as shuffled rows they take two to three times the room.
SCAN_BYTES_PER_SHUFFLE_TASK = 128 * 1024 * 1024

_local_scratch: tempfile.TemporaryDirectory | None = None
_made: list[str] = []


def get_spark(app: str = "trip-kpis", conf: Mapping[str, str] | None = None) -> SparkSession:
    """The running session, or a new one in UTC (any zone gives the same results).

    Master, memory, shuffle width and store credentials are the deployment's business and come
    from spark-submit, the cluster's defaults or ``conf``.
    """
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir.

    Only a local master may go without: there a temporary folder, removed at exit, stands in.
    """
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="tripkpi-", ignore_cleanup_errors=True)
    return f"file://{_local_scratch.name}"


def scratch_uri(spark: SparkSession, name: str) -> str:
    """A fresh location for a written table below the shared folder."""
    uri = f"{shared_folder(spark)}/tripkpi/{name}-{uuid.uuid4().hex}"
    _made.append(uri)
    return uri


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables that are made inside it, once what was computed has been written.

    Tables between jobs have to outlive lost executors, so Spark does not remove them by itself; runs on
    large inputs would leave several times their input behind. Results that are still to be computed
    from them must not be used afterwards.
    """
    before = len(_made)
    try:
        yield
    finally:
        configuration = spark._jsparkSession.sessionState().newHadoopConf()
        while len(_made) > before:
            path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
            path.getFileSystem(configuration).delete(path, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute a small result once, in reliable storage, for everything that reads it afterwards.

    A checkpoint outlives lost executors, where a cached block would be computed again from the
    whole input.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def input_bytes(spark: SparkSession, uris: Sequence[str]) -> int:
    """Bytes of the Parquet files at the locations; only the listing is read, not the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    listed = files.option("pathGlobFilter", "*.parquet").load(list(uris))
    return listed.selectExpr("coalesce(sum(length), 0L)").first()[0]


def run_session(
    spark: SparkSession, uris: Sequence[str], bytes_per_task: int = SCAN_BYTES_PER_SHUFFLE_TASK
) -> SparkSession:
    """A session for one run, with a shuffle width that goes by the run's own input.

    The default of 200 would leave a 100 TB shuffle with half-terabyte tasks. The new session has
    the settings of ``spark`` otherwise, and shares its executors; ``spark`` itself stays as it is, so
    runs side by side do not touch each other's width. Adaptive execution merges small partitions but
    starts from this number, so it only ever goes up here.
    """
    own = spark.newSession()
    for row in spark.sql("SET").collect():
        if row.key.startswith("spark.sql.") and own.conf.isModifiable(row.key):
            own.conf.set(row.key, row.value)
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-input_bytes(spark, uris) // bytes_per_task)
    own.conf.set("spark.sql.shuffle.partitions", str(max(before, wanted)))
    return own
