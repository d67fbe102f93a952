"""Keyed tables that take small batches without being rewritten: merged when they are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import latest_per_key
from tidemark.operators.tables import SnapshotTable, read_or_empty
from tidemark.schemas import BATCH_SEQ
from tidemark.session import few_rows

_FOLDED = T.StructType([T.StructField("upto", T.LongType())])
_NEWER, _KEY = "__newer", "__key"


class MergeOnReadTable:
    """A :class:`SnapshotTable` and, beside it, batches that are not yet part of it.

    :meth:`append` writes the rows of a batch and nothing else, so what a load writes follows
    the batch and not the table. :meth:`read` puts the newest row of every key together.
    :meth:`fold` takes all waiting batches into the table in one rewrite of the buckets they
    touch; run it every so many batches, so that few wait.

    The newest ``version`` of a key wins, then the largest ``tiebreak`` columns, then a hash of
    the content; a null is older than any value, and rows without a key are versions of one
    row. The order in which rows arrive does not matter, and a row applied twice counts once.
    So nothing has to be switched in one step: a fold that dies between the table's commit and
    its own mark leaves batches that are merged once more, without effect.

    Batches are numbered, and writing a number again replaces its batch. Numbers of a new
    writer must lie above those in use. A batch whose number is already folded, as in a
    replay, is merged into the table at once. One writer at a time is assumed.
    """

    def __init__(self, base: SnapshotTable, version: str, tiebreak: Sequence[str] = ()):
        if base.key is None:
            raise ValueError("merging needs a key")
        self.base = base
        self.spark = base.spark
        self.key = base.key
        self.version = version
        self.tiebreak = list(tiebreak)
        self.columns = base.schema.fieldNames()
        self.deltas = f"{base.path}/deltas"
        self._marks = f"{base.path}/folded"

    def _content(self, prefix: str = "") -> Column:
        return F.xxhash64(*[F.col(f"{prefix}`{c}`") for c in self.columns])

    def _after_version(self) -> list[Column]:
        return [*[F.col(c).desc_nulls_last() for c in self.tiebreak], self._content().desc()]

    def _order(self, prefix: str) -> Column:
        """What is compared, as one value; in a struct a null is the smallest."""
        named = [F.col(f"{prefix}`{c}`").alias(c) for c in (self.version, *self.tiebreak)]
        return F.struct(*named, self._content(prefix).alias("content"))

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows.select(*self.columns), self.key, self.version, self._after_version())

    def folded_upto(self) -> int:
        """Number of the last batch that is part of the table; -1 if none is."""
        marks = read_or_empty(self.spark, self._marks, _FOLDED)
        upto = marks.agg(F.max("upto")).first()[0]
        return -1 if upto is None else upto

    def waiting(self) -> DataFrame:
        """Rows of the batches that are not folded, with the number of their batch."""
        upto = self.folded_upto()
        numbered = T.StructType([*self.base.schema.fields, T.StructField(BATCH_SEQ, T.LongType())])
        return read_or_empty(self.spark, self.deltas, numbered).filter(F.col(BATCH_SEQ) > upto)

    def append(self, batch: DataFrame, seq: int) -> None:
        """Write the newest row per key of a batch under its number."""
        if seq < 0:
            raise ValueError("batches are numbered from 0")
        rows = self._latest(batch)
        if seq <= self.folded_upto():
            self._merge(rows)
        else:
            rows.write.mode("overwrite").parquet(f"{self.deltas}/{BATCH_SEQ}={seq}")

    def read(self) -> DataFrame:
        """The newest row of every key.

        Each stored row is held against the waiting row of its key. Spark broadcasts waiting
        rows that its size check allows, so stored rows are then not shuffled; keys that are
        new are found by the key column alone.
        """
        # The marks are read first: a batch folded in between is merged twice, without effect.
        waiting = self._latest(self.waiting())
        stored = self.base.read()
        held = waiting.select(F.struct(*self.columns).alias(_NEWER), F.col(self.key).alias(_KEY))
        stored_row = F.struct(*self.columns).alias("__stored")
        pairs = stored.select(stored_row, F.col(self.key).alias("__stored_key")).join(
            held, F.col("__stored_key").eqNullSafe(F.col(_KEY)), "left"
        )
        wins = F.col(_NEWER).isNotNull() & (self._order(f"{_NEWER}.") > self._order("__stored."))
        merged = pairs.select(F.when(wins, F.col(_NEWER)).otherwise(F.col("__stored")).alias("row"))
        keys = waiting.select(F.col(self.key).alias(_KEY))
        known = stored.select(self.key).join(
            keys, F.col(self.key).eqNullSafe(F.col(_KEY)), "left_semi"
        )
        known = known.select(F.col(self.key).alias(_KEY))
        new = waiting.join(known, F.col(self.key).eqNullSafe(F.col(_KEY)), "left_anti")
        return merged.select("row.*").unionByName(new.select(*self.columns))

    def _merge(self, rows: DataFrame) -> None:
        self.base.upsert(
            rows, version=self.version, tiebreak=self._after_version(), newest_wins=True
        )

    def fold(self) -> int:
        """Take the waiting batches into the table; returns the number of the last one."""
        waiting = self.waiting()
        upto = waiting.agg(F.max(BATCH_SEQ)).first()[0]
        if upto is None:
            return self.folded_upto()
        self._merge(self._latest(waiting.filter(F.col(BATCH_SEQ) <= upto)))
        few_rows(self.spark, [(upto,)], _FOLDED).write.mode("append").parquet(self._marks)
        return upto
