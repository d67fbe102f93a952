"""Session settings and the shared working folder."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # AQE: coalesce small shuffle partitions, split skewed ones, turn a sort-merge
    # join into a broadcast join once the size of a side has been measured.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # INT96 timestamps carry no usable column statistics; micros do.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Streaming de-duplication state lives off-heap and on disk, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app: str = "tidemark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the library is designed for.

    ``shuffle_partitions`` is the starting number; AQE coalesces from there, so on
    a cluster set it generously (two to three times the executor cores).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(SESSION_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; a
    cluster session without it is an error, because a folder of the driver's
    machine is invisible to the executors.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten in place."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of frames built inside go when the execution that wrote them has ended.

    Otherwise they wait for garbage collection on the driver, which a run of many steps over
    large rows may not see in time. A frame that is executed twice shuffles twice.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def _located(spark: SparkSession, path: str):
    """A path and the file system that holds it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it is not there."""
    at, files = _located(spark, path)
    found = files.listStatus(at) if files.exists(at) else []
    return [f.getPath().getName() for f in found if f.isDirectory()]


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders with all they hold; one that is not there is none to delete."""
    for path in paths:
        at, files = _located(spark, path)
        files.delete(at, True)


def planned_bytes(df: DataFrame) -> int:
    """Size of written rows by the files that Spark has listed for them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def few_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A handful of rows as one partition of literals, without a Python worker."""
    text = json.dumps([dict(zip(schema.names, row, strict=True)) for row in rows])
    listed = F.from_json(F.lit(text), T.ArrayType(schema), {"mode": "FAILFAST"})
    return spark.range(0, 1, 1, 1).select(F.inline(listed))


def at_once(*steps: Callable) -> list:
    """Results of steps that do not need each other, run at the same time: the jobs of one
    fill the cores that the other leaves. The first failure is raised once all have ended."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        runs = [pool.submit(step) for step in steps]
    return [run.result() for run in runs]


def materialise(df, label: str):
    """Write ``df`` once under the shared folder and return the written table.

    Used where a frame feeds several jobs: unlike a cache, the files survive the
    loss of executors and a rerun reads the very same rows.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
