"""Watermark state: one row per replicated table."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timestamp_literal
from tidemark.operators.tables import SnapshotTable, typed
from tidemark.operators.upsert import insert_ignore, upsert
from tidemark.schemas import FEED_MARK, WATERMARK
from tidemark.session import few_rows

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def state_row(state: DataFrame, table: str) -> DataFrame:
    return state.filter(F.col("table_name") == table)


def watermark_of(state: DataFrame, table: str) -> DataFrame:
    """One row, always: the stored watermark, or the epoch when there is none."""
    return state_row(state, table).agg(
        F.coalesce(F.max("last_ingested_at"), timestamp_literal(EPOCH)).alias("last_ingested_at")
    )


def get_watermark(state: DataFrame, table: str) -> datetime:
    # Collected as a number: a collected timestamp would take the driver's time zone.
    row = watermark_of(state, table).select(F.unix_micros("last_ingested_at")).first()
    return EPOCH + timedelta(microseconds=row[0])


def watermark_rows(spark: SparkSession, tables: list[str]) -> DataFrame:
    """Seed rows: every table starts at the epoch."""
    values = ", ".join(f"('{name}')" for name in tables)
    return typed(
        spark.sql(f"SELECT * FROM VALUES {values} AS seeds(table_name)"),
        WATERMARK,
        defaults={
            "last_ingested_at": timestamp_literal(EPOCH),
            "updated_at": F.current_timestamp(),
        },
        not_null=["table_name"],
    )


def seed_watermarks(state: DataFrame, tables: list[str]) -> DataFrame:
    """Add missing tables; leave existing watermarks alone."""
    return insert_ignore(state, watermark_rows(state.sparkSession, tables), "table_name")


def set_watermark(
    state: SnapshotTable, table: str, value: datetime, now: datetime | None = None
) -> None:
    """Insert or replace the watermark of one table and stamp the change."""
    stamp = F.current_timestamp() if now is None else timestamp_literal(now)
    row = state.spark.range(1).select(
        F.lit(table).alias("table_name"),
        timestamp_literal(value).alias("last_ingested_at"),
        stamp.alias("updated_at"),
    )
    state.update(lambda current: upsert(current, row, "table_name"))


def set_watermark_at_least(
    state: SnapshotTable, table: str, value: datetime, now: datetime | None = None
) -> datetime:
    """Advance the watermark of one table, which never goes back; the one now stored."""
    stored = get_watermark(state.read(), table)
    if value > stored:
        set_watermark(state, table, value, now)
    return max(value, stored)


class Marks:
    """How far each table was taken in: a log of growing numbers, one small row per step.

    A number is the newest feed version or batch that was processed. Appending a row is one
    commit; the highest number of a table counts, so a repeated step is harmless.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def get(self, table: str) -> int:
        """The mark of a table, 0 for none."""
        try:
            marks = self.spark.read.schema(FEED_MARK).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return 0
            raise
        return state_row(marks, table).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def set(self, table: str, version: int) -> None:
        few_rows(self.spark, [(table, version)], FEED_MARK).write.mode("append").parquet(self.path)


def open_state(spark: SparkSession, path: str, tables: list[str]) -> SnapshotTable:
    """The state table at ``path``, seeded with the tables it does not know yet."""
    state = SnapshotTable(spark, path, WATERMARK, key="table_name")
    current = state.read()
    new = watermark_rows(spark, tables).join(current, "table_name", "left_anti")
    if not new.isEmpty():
        state.publish(seed_watermarks(current, tables))
    return state
