"""Incremental copy of an OLTP table into its versioned landing table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import reconcile_counts
from tidemark.operators.state import (
    EPOCH,
    Marks,
    get_watermark,
    set_watermark,
    set_watermark_at_least,
)
from tidemark.operators.tables import SnapshotTable, append_landing, read_landing
from tidemark.operators.upsert import SIGN
from tidemark.plans.transforms import EntitySpec, to_landing
from tidemark.sources.tables import read_incremental


@dataclass
class Replicated:
    """Outcome of one table: rows moved, the watermark now stored, and the count check."""

    table: str
    rows: int
    watermark: datetime
    check: DataFrame


def default_batch_seq(now: datetime | None = None) -> int:
    """Microseconds since the epoch: grows from run to run, one run at a time."""
    now = now or datetime.now(tz=timezone.utc)
    return (now - EPOCH) // timedelta(microseconds=1)


def replicate(
    source: DataFrame,
    landing: str,
    state: SnapshotTable,
    spec: EntitySpec,
    batch_seq: int | None = None,
    overlap: timedelta = timedelta(0),
    now: datetime | None = None,
) -> Replicated:
    """Append the rows newer than the stored watermark and advance it.

    Delivery is at least once: the batch is written before the watermark moves, so a
    run that dies in between is simply repeated, and readers of the landing table keep
    one version per key. The new watermark is read from the files just written, not
    from the source, which may have moved on. The watermark advances before the count
    check, so a failed check does not move it back. Deletes in the source do not
    travel; use :func:`tidemark.operators.changes.apply_changes` for those.
    """
    spark = source.sparkSession
    watermark = get_watermark(state.read(), spec.name)
    batch = read_incremental(source, spec.columns, watermark, spec.version, overlap)
    seq = default_batch_seq(now) if batch_seq is None else batch_seq
    rows, newest = 0, None
    if not batch.isEmpty():
        written = append_landing(to_landing(batch, spec.landing), landing, spec.columns, seq)
        rows, newest = _measured(spark, written, spec)
    if newest is not None:
        newest_at = EPOCH + timedelta(microseconds=newest)
        # An overlapping read may bring nothing newer; the watermark never goes back.
        watermark = max(watermark, newest_at)
        set_watermark(state, spec.name, watermark, now)
    return Replicated(spec.name, rows, watermark, _check(spark, source, landing, spec))


def replicate_feed(
    table: SnapshotTable,
    landing: str,
    state: SnapshotTable,
    marks: Marks,
    spec: EntitySpec,
    now: datetime | None = None,
) -> Replicated:
    """Append what the table's change feed holds after the stored mark, and advance it.

    Only the feed files of the versions after the mark are read, whatever the size of the
    table, and a change with an old stamp is not missed. The batch carries the number of the
    newest version it holds: a run that died before the mark moved writes the same folder
    again. Nothing is written when nothing is new. The watermark follows as well, so that
    :func:`replicate` can go on from there.
    """
    spark = table.spark
    mark, newest_version = marks.get(spec.name), table.version()
    rows = 0
    watermark = None
    if newest_version > mark:
        batch = table.changes(mark, newest_version).filter(F.col(SIGN) > 0)
        if not batch.isEmpty():
            moved = to_landing(batch, spec.landing)
            written = append_landing(moved, landing, spec.columns, newest_version)
            rows, newest = _measured(spark, written, spec)
            if newest is not None:
                watermark = set_watermark_at_least(
                    state, spec.name, EPOCH + timedelta(microseconds=newest), now
                )
        marks.set(spec.name, newest_version)
    if watermark is None:
        watermark = get_watermark(state.read(), spec.name)
    return Replicated(spec.name, rows, watermark, _check(spark, table.read(), landing, spec))


def _measured(spark: SparkSession, written: str, spec: EntitySpec) -> tuple[int, int | None]:
    """Rows and newest version of a written batch: two numbers, from one column."""
    batch = spark.read.schema(spec.landing).parquet(written)
    return tuple(batch.agg(F.count(F.lit(1)), F.unix_micros(F.max(spec.version))).first())


def _check(spark: SparkSession, source: DataFrame, landing: str, spec: EntitySpec) -> DataFrame:
    target = read_landing(spark, landing, spec.landing)
    return reconcile_counts(source, target, spec.name, spec.key)
