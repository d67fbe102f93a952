"""Joins on keys that may be very unevenly filled.

AQE splits a skewed partition only when both inputs of a sort-merge join come straight
from a shuffle. After a de-duplication or an aggregation on the same key one input does
not, so a post with a third of all comments would land in one task. These helpers do
the split in the plan itself, and only for the keys that need it:

* :func:`heaviest_keys` counts the join key of the large side (one column, map-side
  combined, spread over all tasks) and writes down every key above ``min_rows``. The list
  is a table like any other: nothing is collected, cut off or forced into a broadcast.
  Spark broadcasts it when its measured size allows, and otherwise joins it by shuffle.
* :func:`skew_join` gives each row of a listed key one of ``ceil(rows / min_rows)``
  salts and repeats the other side's row once per salt. Every row still meets exactly
  the partners it would meet in a plain join, whatever the list says. Without hot keys
  it *is* the plain join, which keeps a partitioning the inputs already have.

Salts come from a hash of row columns, never from a random number: a recomputed task
must send each row to the same place. For the same reason the list is counted once, up
front, and both sides use that one copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

ROWS_PER_SALT = 1_000_000

HOT_KEY = "__hot_key"
SALTS = "__salts"
SALT = "__salt"


@dataclass(frozen=True)
class HotKeys:
    """Keys to split: ``(__hot_key, __salts)``, or nothing to split at all."""

    frame: DataFrame | None

    @property
    def empty(self) -> bool:
        return self.frame is None


def heaviest_keys(df: DataFrame, key: str, min_rows: int = ROWS_PER_SALT) -> HotKeys:
    """All keys with more than ``min_rows`` rows, counted once and written down."""
    counts = df.groupBy(F.col(key).alias(HOT_KEY)).agg(F.count(F.lit(1)).alias("rows"))
    hot = counts.filter(F.col("rows") > min_rows).select(
        HOT_KEY, F.ceil(F.col("rows") / min_rows).cast("int").alias(SALTS)
    )
    written = materialise(hot, "hot-keys")
    return HotKeys(None if written.isEmpty() else written)


def _with_hot(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """``df`` with ``__salts`` for the rows of hot keys, a null key included."""
    return df.join(hot.frame, F.col(key).eqNullSafe(F.col(HOT_KEY)), "left")


def salted(df: DataFrame, key: str, hot: HotKeys, spread: Sequence[str] | None = None) -> DataFrame:
    """``df`` with a ``__salt`` per row: one of its key's salts, 0 for keys that are not hot."""
    if hot.empty:
        return df.withColumn(SALT, F.lit(0))
    salts = F.coalesce(F.col(SALTS), F.lit(1))
    own = F.when(
        F.col(SALTS).isNotNull(), F.pmod(F.xxhash64(*(spread or df.columns)), salts).cast("int")
    ).otherwise(F.lit(0))
    return _with_hot(df, key, hot).select(*df.columns, own.alias(SALT))


def repeated(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    """``df`` with every row once per ``__salt`` of its key."""
    if hot.empty:
        return df.withColumn(SALT, F.lit(0))
    salts = F.coalesce(F.col(SALTS), F.lit(1))
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    return _with_hot(df, key, hot).select(*df.columns, every.alias(SALT))


def skew_join(
    large: DataFrame,
    small: DataFrame,
    on: str,
    how: str = "inner",
    spread: Sequence[str] | None = None,
    hot: HotKeys | None = None,
    min_rows: int = ROWS_PER_SALT,
) -> DataFrame:
    """Equi-join of ``large`` with ``small`` on ``on``, safe against hot keys of ``large``.

    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. ``spread`` names
    columns of ``large`` that tell its rows apart (default: all). ``hot`` may be counted
    on any cheaper frame with the same keys, such as the table before de-duplication:
    a list that is off costs time, never rows.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    if hot is None:
        hot = heaviest_keys(large, on, min_rows)
    if hot.empty:
        return large.join(small, on, how)
    left, right = salted(large, on, hot, spread), repeated(small, on, hot)
    return left.join(right, [on, SALT], how).drop(SALT)
