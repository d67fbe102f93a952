"""Insert-or-replace and insert-if-absent as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.latest import default_tiebreak, latest_per_key

_SEEN = "__rows_of_key"
_INCOMING = "__incoming"

# Marks of a change feed: a changed row, its image before, and the sign of an image.
CHANGED, BEFORE, SIGN = "__changed", "__before", "__sign"


def one_row_per_key(
    batch: DataFrame,
    key: str,
    version: str | None,
    tiebreak: Sequence[Column] | None,
    on_duplicate: str,
) -> DataFrame:
    if on_duplicate == "latest":
        if version is not None:
            return latest_per_key(batch, key, version, tiebreak)
        order = default_tiebreak(batch, key, key) if tiebreak is None else tiebreak
        return latest_per_key(batch, key, key, order)
    if on_duplicate == "error":
        # Counting first keeps a repeated key from being gathered whole.
        repeated = (
            batch.groupBy(key)
            .agg(F.count(F.lit(1)).alias(_SEEN))
            .filter(F.col(_SEEN) > 1)
            .agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"))
            .first()
        )
        if repeated["n"]:
            raise ValueError(
                f"{repeated['n']} keys occur more than once in the batch, first {repeated['first']}"
            )
        return batch
    raise ValueError("on_duplicate must be 'latest' or 'error'")


def _keep_stamp_of_unchanged(
    target: DataFrame, batch: DataFrame, key: str, stamp: str
) -> DataFrame:
    """Batch rows equal to the stored row apart from the stamp take the stored stamp."""
    content = [c for c in batch.columns if c not in (key, stamp)]
    stored = target.select(
        key, F.col(stamp).alias("__old_stamp"), F.struct(*content).alias("__old")
    )
    same = F.struct(*content).eqNullSafe(F.col("__old")) & F.col("__old").isNotNull()
    return batch.join(stored, key, "left").select(
        *[
            F.when(same, F.col("__old_stamp")).otherwise(F.col(c)).alias(c) if c == stamp else c
            for c in batch.columns
        ]
    )


def upsert(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    version: str | None = None,
    tiebreak: Sequence[Column] | None = None,
    on_duplicate: str = "latest",
    touch_unchanged: bool = True,
    stamp: str = "ingested_at",
    newest_wins: bool = False,
) -> DataFrame:
    """``target`` with every row of ``batch`` inserted, or replacing the row of its key.

    A key repeated inside the batch is reduced to its latest row (``on_duplicate=
    'latest'``) or rejected (``'error'``). With ``touch_unchanged=False`` a row that
    brings nothing new keeps its old stamp, so a later incremental read skips it. With
    ``newest_wins=True`` a stored row gives way only to a newer ``version``.

    Applying the same batch twice gives the same table as applying it once.
    """
    columns = target.columns
    rows = one_row_per_key(batch, key, version, tiebreak, on_duplicate).select(*columns)
    if newest_wins:
        if version is None:
            raise ValueError("newest_wins needs a version column")
        return latest_per_key(target.unionByName(rows), key, version, tiebreak)
    if not touch_unchanged:
        rows = _keep_stamp_of_unchanged(target, rows, key, stamp)
    # Null-safe: a row without a key is replaced like any other, so repeats are harmless.
    replaced = rows.select(F.col(key).alias(_SEEN))
    kept = target.join(replaced, F.col(key).eqNullSafe(F.col(_SEEN)), "left_anti")
    return kept.select(*columns).unionByName(rows)


def by_partition(df: DataFrame, partition: str, partitions: int) -> DataFrame:
    """Rows sent to the task of their number; with a single number nothing is moved."""
    return df.repartitionById(partitions, F.col(partition)) if partitions > 1 else df


def merge_partitioned(
    target: DataFrame,
    batch: DataFrame,
    key: str,
    partition: str,
    partitions: int,
    version: str | None = None,
    tiebreak: Sequence[Column] | None = None,
    on_duplicate: str = "latest",
    touch_unchanged: bool = True,
    stamp: str = "ingested_at",
    newest_wins: bool = False,
    feed: bool = False,
    unique: bool = False,
) -> DataFrame:
    """:func:`upsert` for tables stored by partition number, in one shuffle.

    Both frames carry ``partition``, a number below ``partitions`` derived from the key.
    Stored and incoming rows are sent straight to the task of that number and compared
    there, two rows per key at most; the result is left partitioned and sorted for
    writing. An anti join would shuffle the stored rows by key first and by partition
    afterwards.

    ``feed`` adds two columns: whether the row differs from the stored one, and that row.
    ``unique`` says that no key of the batch occurs twice, so that its rows need no shuffle
    by key before the one by partition.
    """
    columns = [c for c in target.columns if c != partition]
    if tiebreak is None:
        tiebreak = default_tiebreak(batch.drop(partition), key, version or key)
    if not unique:
        batch = one_row_per_key(batch, key, version, tiebreak, on_duplicate)
    rows = batch.select(target.columns)
    both = rows.withColumn(_INCOMING, F.lit(True)).unionByName(
        target.withColumn(_INCOMING, F.lit(False))
    )
    keys = Window.partitionBy(partition, key)
    order = keys.orderBy(F.col(_INCOMING).desc())
    if newest_wins:
        if version is None:
            raise ValueError("newest_wins needs a version column")
        order = keys.orderBy(F.col(version).desc_nulls_last(), *tiebreak)
    placed = by_partition(both, partition, partitions)
    if not touch_unchanged:
        content = F.struct(*[c for c in columns if c not in (key, stamp)])
        stored = F.lead(content).over(order)
        same = F.col(_INCOMING) & stored.isNotNull() & content.eqNullSafe(stored)
        kept = F.when(same, F.lead(stamp).over(order)).otherwise(F.col(stamp))
        placed = placed.withColumn("__kept_stamp", kept)
    if feed:
        placed = placed.withColumn(BEFORE, F.lead(F.struct(*columns)).over(order))
    ranked = placed.withColumn("__rank", F.row_number().over(order)).filter("__rank = 1")
    if not touch_unchanged:
        ranked = ranked.withColumn(stamp, F.col("__kept_stamp"))
    if not feed:
        return ranked.select(*columns, partition)
    differs = F.col(_INCOMING) & ~F.struct(*columns).eqNullSafe(F.col(BEFORE))
    return ranked.select(*columns, partition, differs.alias(CHANGED), BEFORE).withColumn(
        BEFORE, F.when(F.col(CHANGED), F.col(BEFORE))
    )


def insert_ignore(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``target`` plus the rows whose key it does not hold yet, one per key.

    A key repeated in ``rows`` is settled by a hash of the row. Null keys are one key.
    """
    columns = target.columns
    once = one_row_per_key(rows.select(*columns), key, None, None, "latest")
    held = target.select(F.col(key).alias(_SEEN)).distinct()
    new = once.join(held, F.col(key).eqNullSafe(F.col(_SEEN)), "left_anti")
    return target.unionByName(new.select(*columns))
