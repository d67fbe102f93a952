"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tidemark
from tidemark.session import materialise, new_run_dir

__all__ = ["materialise", "new_run_dir"]

#: Rows per Arrow batch: texts are long, so batches are kept short.
BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Python tasks take ``rows`` rows at a time, so that long texts fit in memory.

    Python workers on the driver's machine also learn where this library lies; a cluster
    has it installed or gets it with the job.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(tidemark.__file__)))
    environment = spark.sparkContext.environment
    known = f"{environment.get('PYTHONPATH', '')}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(
            filter(None, [root, environment.get("PYTHONPATH", "")])
        )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def record_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator:
    """Rows of an iterator as record batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield to_batch(held, schema)
            held = []
    if held:
        yield to_batch(held, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=f.type) for values, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def file_system(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path inside it of a folder on shared storage, for use in tasks."""
    uri = path
    for spark_scheme, arrow_scheme in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if uri.startswith(spark_scheme):
            uri = arrow_scheme + uri[len(spark_scheme) :]
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = uri[len("file:") :]
    return pyarrow.fs.FileSystem.from_uri(uri)


def running_total(df: DataFrame, order: str, value: str, out: str, group: int = 1024) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows of smaller ``order``, in two levels.

    ``order`` is a dense non-negative number. No task sees more than ``group`` rows and
    the group totals, so the rows never meet in one task as a whole.
    """
    grouped = df.withColumn("__group", F.floor(F.col(order) / group))
    inside = Window.partitionBy("__group").orderBy(order)
    before = Window.orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    totals = grouped.groupBy("__group").agg(F.sum(value).alias("__total"))
    bases = totals.withColumn("__base", F.coalesce(F.sum("__total").over(before), F.lit(0)))
    earlier = F.coalesce(
        F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return (
        grouped.withColumn("__inside", earlier)
        .join(bases.select("__group", "__base"), "__group")
        .withColumn(out, F.col("__base") + F.col("__inside"))
        .drop("__group", "__base", "__inside")
    )


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """``(node, component)`` of every node of the undirected ``edges (a, b)``.

    The component is the smallest node reachable. Large-star and small-star rounds, each
    a grouped minimum and a join, written down after each round: recomputation after a
    lost executor stays one round deep. A star's centre may hold a third of all edges; its
    minimum is pre-aggregated and Spark splits its join partition.
    """
    edges = materialise(
        edges.filter("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        f"{label}-edges",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m")
        )
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.filter("a <> b").distinct(), f"{label}-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
            .select("e.a", F.col("e.m").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        after = materialise(small, f"{label}-small")
        if _same(edges, after):
            break
        edges = after
    roots = after.select(F.col("b").alias("node")).distinct()
    return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _same(one: DataFrame, other: DataFrame) -> bool:
    def digest(df: DataFrame):
        return df.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))
        ).first()

    return tuple(digest(one)) == tuple(digest(other))
