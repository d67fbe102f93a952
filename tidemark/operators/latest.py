"""Latest version per key.

A landing table only grows: every re-sent or changed row is one more version. All
readers go through :func:`latest_per_key`, which is what makes a repeated load harmless.

The plan keeps one row per key *per map task* before the shuffle (``WindowGroupLimit``,
partial) and again after it, so a key that holds a third of all rows sends at most one
row per map task. Derive narrow columns before calling it: whatever the caller does not
select afterwards is pruned out of the scan, the sort and the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.schemas import BATCH_SEQ, LANDING_MARKS


def default_tiebreak(df: DataFrame, key: str, version: str) -> list[Column]:
    """Order among equal versions: the later batch wins, within a batch the stored row hash.

    Without a batch number the remaining content decides, through a 64-bit hash, so
    that every run and every reader picks the same row. Rows that were landed without
    a hash come after those with one.
    """
    if BATCH_SEQ in df.columns:
        return [F.col(c).desc_nulls_last() for c in LANDING_MARKS if c in df.columns]
    content = [c for c in df.columns if c not in (key, version)]
    return [F.xxhash64(*content).desc()] if content else []


def latest_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    version: str,
    tiebreak: Sequence[Column] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the newest ``version``, ties settled by ``tiebreak``.

    Columns in ``drop`` may be used for the ordering and are left out of the result.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if tiebreak is None:
        tiebreak = default_tiebreak(df, keys[0], version)
    order = Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last(), *tiebreak)
    rank = "__version_rank"
    ranked = df.withColumn(rank, F.row_number().over(order))
    return ranked.filter(F.col(rank) == 1).drop(rank, *drop)


def final(df: DataFrame, key: str, version: str) -> DataFrame:
    """De-duplicated read of a landing table, without its batch number and row hash."""
    return latest_per_key(df, key, version, drop=LANDING_MARKS)


def final_count(df: DataFrame, key: str, alias: str = "rows") -> DataFrame:
    """Number of logical rows. Reads the key column only and sorts nothing."""
    return df.agg(F.count_distinct(key).alias(alias))


def latest_values(df: DataFrame, key: str, version: str, cols: Sequence[str]) -> DataFrame:
    """Latest value of a few columns by plain aggregation.

    For unique versions only: among ties, different columns could come from
    different rows.
    """
    return df.groupBy(key).agg(*[F.max_by(c, version).alias(c) for c in cols])
