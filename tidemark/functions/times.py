"""Ingestion stamps, build stamps and version precision."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def timestamp_literal(value: datetime, kind: str = "timestamp") -> Column:
    """Constant of the given timestamp type; a naive value is taken as UTC.

    Going through text keeps the Python time zone of the driver out of it, and the
    cast folds to a plain literal, so comparisons still reach the Parquet reader.
    """
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text if kind == "timestamp_ntz" else text + "+00:00").cast(kind)


def stamp(df: DataFrame, batch_ts: datetime, name: str = "ingested_at") -> DataFrame:
    """One ingestion time for the whole batch, so that retried tasks agree."""
    return df.withColumn(name, timestamp_literal(batch_ts))


def built_at(df: DataFrame, ts: datetime | None = None) -> DataFrame:
    value = F.current_timestamp() if ts is None else timestamp_literal(ts)
    return df.withColumn("built_at", value)


def to_millis(c: Column) -> Column:
    """Cut microseconds down to the millisecond precision of a landing version."""
    return F.date_trunc("MILLISECOND", c)
