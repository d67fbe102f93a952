"""Streaming jobs.

All run with ``availableNow``: they process what has arrived since the last run in
bounded micro-batches and stop, so the same code serves an hourly schedule and, with
another trigger, a continuous one. The checkpoint remembers what was read and takes the
place of the watermark table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.deltas import MergeOnReadTable
from tidemark.operators.latest import latest_per_key
from tidemark.operators.tables import SnapshotTable, append_landing, read_or_empty
from tidemark.schemas import BATCH_SEQ
from tidemark.session import materialise


ORIGIN = "__origin"
_SALT = "__salt"
_NEWEST = T.StructType([T.StructField("newest", T.TimestampType())])


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    glob: str | None = None,
    with_origin: bool = False,
) -> DataFrame:
    """New Parquet files of a folder as a stream.

    ``files_per_batch`` bounds a micro-batch, and with it the memory a backlog needs.
    ``with_origin`` adds ``__origin``, a hash of the file split a row came from.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(path)
    if with_origin:
        split = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
        stream = stream.withColumn(ORIGIN, split)
    return stream


def replicate_stream(
    src: DataFrame,
    landing: str,
    checkpoint: str,
    columns: Sequence[str],
    base_seq: int = 0,
) -> StreamingQuery:
    """Copy a stream into a landing table, one batch directory per micro-batch.

    A replayed micro-batch has the same number and replaces its own directory. A new
    checkpoint starts counting from zero again: give it a ``base_seq`` above the batches
    already in the table.
    """

    def append(batch: DataFrame, epoch: int) -> None:
        append_landing(batch, landing, columns, base_seq + epoch)

    return (
        src.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(
    sdf: DataFrame, key: str, ts: str, delay: str, spread: str | None = None, salts: int = 256
) -> DataFrame:
    """Drop re-sent copies of an event while the stream runs.

    Keeps the first copy, so it fits exact re-sends; for changed rows use
    ``latest_per_key`` on read. The state holds keys seen within ``delay`` only: copies
    further apart both pass, and events later than ``delay`` are dropped by the
    watermark, so choose it above the lateness the source can show, or keep late events
    with :func:`dedup_stream_with_late`.

    All copies of a key meet in one task. When one event may be re-sent very often, name
    a ``spread`` column that differs between its copies but not between two runs of a
    task, such as ``__origin`` of a file stream or the partition number of a log. Copies
    are then reduced to one per salt first. The column is dropped.
    """
    if isinstance(sdf.schema[ts].dataType, T.TimestampNTZType):
        sdf = sdf.withColumn(ts, F.col(ts).cast("timestamp"))
    seen = sdf.withWatermark(ts, delay)
    if spread:
        salted = seen.withColumn(_SALT, F.pmod(F.xxhash64(spread), F.lit(salts)))
        seen = salted.dropDuplicatesWithinWatermark([key, _SALT]).drop(_SALT, spread)
    return seen.dropDuplicatesWithinWatermark([key])


def dedup_stream_with_late(
    src: DataFrame,
    key: str,
    ts: str,
    delay: str,
    out: str,
    late: str,
    checkpoint: str,
    base_seq: int = 0,
) -> StreamingQuery:
    """Drop re-sent copies and keep what comes too late, in a folder of its own.

    A micro-batch is held against the watermark of the batches before it: the newest event
    time they showed, less ``delay`` (an interval such as ``10 minutes``). Events at or after
    it go to ``out``, earlier ones and those without a time to ``late``; the two folders
    together hold every different event once. Two rows are copies if they agree in ``key``
    and ``ts``, whichever folder the first went to and however far apart they come; of copies
    that differ in other columns a hash of the content chooses. Rows without a key are no
    copies of anything and are all kept.

    There is no state store that grows: each batch is reduced to one row per event, before
    the shuffle too, and anti-joined with the (key, time) columns of what was written before.
    Punctual and late events are looked up apart, each in the span of their own times, so
    that Parquet statistics skip files outside it and one very old event does not widen the
    search for the others. Folders are per micro-batch and replaced when one is replayed; a
    new checkpoint needs a ``base_seq`` above the numbers in use.
    """
    interval = F.expr(f"INTERVAL {delay}")

    def earlier(spark: SparkSession, path: str, schema: T.StructType, seq: int) -> DataFrame:
        numbered = T.StructType([*schema.fields, T.StructField(BATCH_SEQ, T.LongType())])
        return read_or_empty(spark, path, numbered).filter(F.col(BATCH_SEQ) < seq)

    def split(batch: DataFrame, epoch: int) -> None:
        spark, seq = batch.sparkSession, base_seq + epoch
        columns, schema = batch.columns, batch.schema
        content = F.xxhash64(*[F.col(c) for c in columns])
        copies = latest_per_key(batch.filter(F.col(key).isNotNull()), [key, ts], ts, [content])
        once = materialise(copies.unionByName(batch.filter(F.col(key).isNull())), "stream-once")
        marks = earlier(spark, f"{out}/_event_time", _NEWEST, seq)
        # One row per micro-batch; the newest of them is one value.
        newest = marks.agg(F.max("newest").alias("newest"))
        mark = newest.select((F.col("newest") - interval).alias("mark")).first()[0]
        in_time = F.lit(True) if mark is None else F.col(ts) >= F.lit(mark)
        in_time = F.coalesce(in_time & F.col(ts).isNotNull(), F.lit(False))
        times = [T.StructField(c, schema[c].dataType) for c in (key, ts)]
        for path, rows in ((out, once.filter(in_time)), (late, once.filter(~in_time))):
            low, high = rows.agg(F.min(ts), F.max(ts)).first()
            new = rows
            for folder in (out, late):
                known = earlier(spark, folder, T.StructType(times), seq).drop(BATCH_SEQ)
                span = F.col(ts).isNull()
                if low is not None:
                    span |= F.col(ts).between(F.lit(low), F.lit(high))
                known = known.filter(span)
                same = [new[key] == known[key], new[ts].eqNullSafe(known[ts])]
                new = new.join(known, same, "left_anti")
            new.select(*columns).write.mode("overwrite").parquet(f"{path}/{BATCH_SEQ}={seq}")
        shown = once.agg(F.max(F.col(ts).cast("timestamp")).alias("newest"))
        shown.write.mode("overwrite").parquet(f"{out}/_event_time/{BATCH_SEQ}={seq}")

    return (
        src.writeStream.foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stream(sdf: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet folder, each row exactly once."""
    return (
        sdf.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_stream(
    src: DataFrame,
    target: SnapshotTable,
    checkpoint: str,
    version: str,
    tiebreak: Sequence = (),
) -> StreamingQuery:
    """Micro-batch load of an event log into a keyed table.

    Each micro-batch is reduced to its latest row per key and merged; only buckets that
    the batch touches are rewritten. A row older than the stored one never replaces it,
    which also makes a replayed micro-batch harmless. ``src`` may be any stream, for
    example one read with ``format("kafka")``.
    """
    order = [F.col(c).desc() for c in tiebreak] or None

    def merge(batch: DataFrame, epoch: int) -> None:
        target.upsert(batch, version=version, tiebreak=order, newest_wins=True)

    return (
        src.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_upserts_stream(
    src: DataFrame,
    target: MergeOnReadTable,
    checkpoint: str,
    base_seq: int = 0,
    fold_after: int | None = None,
) -> StreamingQuery:
    """Micro-batch load of an event log into a keyed table that is merged when read.

    A micro-batch writes its latest row per key and leaves the table alone; readers see it
    at once. Every ``fold_after`` micro-batches, or when a scheduled job calls
    ``target.fold()`` between runs, the waiting rows are taken into the table in one rewrite.
    A replayed micro-batch replaces its own rows. A new checkpoint needs a ``base_seq``
    above the numbers in use.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        target.append(batch, base_seq + epoch)
        if fold_after and (epoch + 1) % fold_after == 0:
            target.fold()

    return (
        src.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
