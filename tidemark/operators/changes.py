"""Changelogs with deletes, in or out of order, and marts rebuilt for affected keys only."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import HotKeys, skew_join
from tidemark.operators.tables import VERSION, SnapshotTable
from tidemark.operators.upsert import SIGN

DELETE = "D"

# Columns of a stored row: the place of its last change in the log, and a delete's mark.
PLACE, DELETED = "__place", "__deleted"


def apply_changes(
    target: DataFrame,
    log: DataFrame,
    key: str,
    seq: str,
    op: str = "op",
    tiebreak: list[Column] | None = None,
) -> DataFrame:
    """``target`` after a changelog of inserts, updates and deletes.

    Only the last change of each key counts, a null key being one key. Applying the same log
    again changes nothing. ``target`` holds no sequence numbers, so every change of the log is
    newer than its row: for logs that come in pieces, late or out of order, use
    :class:`ChangeTable`. Stored and logged rows are ranked together, in one shuffle.
    """
    columns = target.columns
    if tiebreak is None:
        tiebreak = [F.xxhash64(*log.columns).desc()]
    change, wanted = "__is_change", [*dict.fromkeys([*log.columns, *columns])]
    both = log.withColumn(change, F.lit(True)).unionByName(
        target.withColumn(change, F.lit(False)), allowMissingColumns=True
    )
    order = Window.partitionBy(key).orderBy(
        F.col(change).desc(), F.col(seq).desc_nulls_last(), *tiebreak
    )
    last = both.select(*wanted, change, F.row_number().over(order).alias("__rank"))
    gone = F.col(change) & (F.col(op) == DELETE)
    return last.filter((F.col("__rank") == 1) & ~F.coalesce(gone, F.lit(False))).select(*columns)


@dataclass(frozen=True)
class Applied:
    """Rows of a log that were applied, and those too old to be ordered."""

    rows: int
    refused: DataFrame


class ChangeTable:
    """A keyed table kept by a changelog that may arrive late, split, shuffled or repeated.

    Every key holds the place of its last change: its sequence number, then ``tiebreak``
    columns, then a hash of the change. A change replaces what is stored only if its place is
    higher, and a deleted key stays behind as a tombstone with its place. So any split and
    order of the same log ends in the same table, and applying a piece again does nothing.

    Tombstones would pile up: :meth:`expire` names a horizon below which no change is expected
    any more and drops the tombstones before it. Changes before the horizon could revive a
    forgotten delete; they are not applied but handed back.

    A log piece is ranked once, then compared with the rows of the buckets it touches. With
    ``feed=True`` the changes of the live rows can be read from :meth:`changes`.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        seq: T.StructField,
        tiebreak: Sequence[T.StructField] = (),
        op: str = "op",
        buckets: int | None = None,
        feed: bool = False,
    ):
        self.spark, self.key, self.op, self.feed = spark, key, op, feed
        self.columns = schema.fieldNames()
        self.place = [seq.name, *(f.name for f in tiebreak)]
        place = T.StructType([seq, *tiebreak, T.StructField("hash", T.LongType())])
        stored = T.StructType(
            [*schema.fields, T.StructField(PLACE, place), T.StructField(DELETED, T.BooleanType())]
        )
        self.table = SnapshotTable(spark, f"{path}/rows", stored, key, buckets)
        horizon = T.StructType([T.StructField("horizon", seq.dataType)])
        self.horizons = SnapshotTable(spark, f"{path}/horizon", horizon)

    def _placed(self, rows: DataFrame, deleted: Column) -> DataFrame:
        """Rows in the stored shape; a tombstone keeps nothing but its key."""
        place = self.table.schema[PLACE].dataType
        parts = [F.col(c).cast(place[c].dataType).alias(c) for c in self.place]
        # Of the content only: the same change, read through another source, keeps its place.
        hashed = F.xxhash64(*self.columns, deleted).alias("hash")
        gone = F.coalesce(deleted, F.lit(False))
        content = [
            F.col(c) if c == self.key else F.when(~gone, F.col(c)).alias(c) for c in self.columns
        ]
        return rows.select(*content, F.struct(*parts, hashed).alias(PLACE), gone.alias(DELETED))

    def seed(self, rows: DataFrame) -> None:
        """The table as it was before the log: below every change."""
        place = self.table.schema[PLACE].dataType
        lowest = F.lit(None).cast(place)
        self.table.publish(
            rows.select(*self.columns, lowest.alias(PLACE), F.lit(False).alias(DELETED))
        )

    def horizon(self) -> DataFrame:
        """``(horizon)``: one row, null while none was set."""
        return self.horizons.read().agg(F.max("horizon").alias("horizon"))

    def apply(self, log: DataFrame) -> Applied:
        """Apply a piece of the log."""
        seq = F.col(self.place[0])
        bound = self.horizon().first()[0]
        old = F.lit(False) if bound is None else F.coalesce(seq < F.lit(bound), F.lit(True))
        rows = self._placed(log.filter(~old), F.col(self.op) == DELETE)
        applied = self.table.upsert(
            rows, feed=self.feed, version=PLACE, tiebreak=[], newest_wins=True
        )
        return Applied(applied, log.filter(old))

    def expire(self, before: DataFrame) -> None:
        """Set the horizon to the one value of ``before`` and drop the tombstones below it.

        The horizon never goes back. It is stored before tombstones go, so that a run that
        dies in between forgets nothing it could still be asked about.
        """
        (name,) = before.columns
        wanted = before.select(F.col(name).alias("horizon")).unionByName(self.horizon())
        self.horizons.publish(wanted.agg(F.max("horizon").alias("horizon")))
        bound = self.horizon().first()[0]
        if bound is None:
            return
        seq = F.col(f"{PLACE}.{self.place[0]}")
        expired = self.table.read().filter(F.col(DELETED) & F.coalesce(seq < F.lit(bound), F.lit(True)))
        self.table.replace_keys(expired.select(self.key), self.table.read().limit(0), self.feed)

    def read(self) -> DataFrame:
        """The live rows."""
        return self.table.read().filter(~F.col(DELETED)).select(*self.columns)

    def changes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """Images of the live rows that changed, with their signs; see ``SnapshotTable``."""
        images = self.table.changes(after, upto).filter(~F.col(DELETED))
        return images.select(*self.columns, SIGN, VERSION)


def affected_keys(key: str, *changed: DataFrame) -> DataFrame:
    """Distinct keys over all frames that mention one: new rows and the rows they replace."""
    keys = [df.select(F.col(key)) for df in changed]
    return reduce(DataFrame.unionByName, keys).filter(F.col(key).isNotNull()).distinct()


def replaced_by(old: DataFrame, delta: DataFrame, id_column: str) -> DataFrame:
    """Stored rows that the delta replaces."""
    return old.join(delta.select(id_column).distinct(), id_column, "left_semi")


def only_keys(
    df: DataFrame, keys: DataFrame, key: str, hot: HotKeys | None = None
) -> DataFrame:
    """Rows whose key is affected.

    ``hot`` names keys of ``df`` to split; leave it out where ``key`` is unique in ``df``.
    """
    return skew_join(df, keys, key, "left_semi", hot=hot or HotKeys(None))


def refresh_mart(
    old_mart: DataFrame,
    keys: DataFrame,
    key: str,
    rebuild: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Old mart with the rows of ``keys`` recomputed.

    ``rebuild(keys)`` computes the mart for those keys. A key that no longer exists
    yields no row and so leaves the mart.
    """
    fresh = rebuild(keys)
    kept = old_mart.join(keys, key, "left_anti").select(*fresh.columns)
    return kept.unionByName(fresh)
