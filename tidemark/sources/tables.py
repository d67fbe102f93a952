"""Tables by logical name and incremental reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timestamp_literal


class Sources:
    """Logical table name to path; the only place that knows where tables live."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        self.spark = spark
        self.paths = dict(paths)
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self.paths:
            raise KeyError(f"unknown source {name!r}; known: {sorted(self.paths)}")
        if name not in self._frames:  # reading the schema costs a small job, once
            self._frames[name] = self.spark.read.parquet(self.paths[name])
        return self._frames[name]

    def __iter__(self):
        return iter(self.paths)


def newer_than(
    df: DataFrame, column: str, watermark: datetime, overlap: timedelta = timedelta(0)
) -> DataFrame:
    """Rows strictly newer than the watermark.

    A row committed late with an older stamp is missed; ``overlap`` re-reads a margin
    to catch it, which is harmless because readers take the latest version per key.
    """
    kind = df.schema[column].dataType.simpleString()
    return df.filter(F.col(column) > timestamp_literal(watermark - overlap, kind))


def read_incremental(
    source: DataFrame,
    columns: Sequence[str],
    watermark: datetime,
    version: str = "ingested_at",
    overlap: timedelta = timedelta(0),
    ordered: bool = False,
) -> DataFrame:
    """Projected and filtered read of a table; both reach the scan.

    ``ordered=True`` sorts by version, oldest first. A bulk copy does not need it.
    """
    rows = newer_than(source, version, watermark, overlap).select(*columns)
    return rows.orderBy(version) if ordered else rows


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    driver: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """A database table read by ``partitions`` parallel key ranges.

    Filters and column lists applied to the result are pushed into the remote query.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url,
            dbtable=table,
            driver=driver,
            partitionColumn=key,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
            **options,
        )
        .load()
    )
