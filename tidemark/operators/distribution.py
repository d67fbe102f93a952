"""Two tables stored so that joins between them move no rows, hot keys included.

Buckets by key alone put all rows of a key into one bucket, and a bucket into one task. Here
the rows of a listed hot key are dealt to several sub-buckets, and the rows of the other table
that they join with are stored once in each of those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.skew import (
    ROWS_PER_SALT,
    SALT,
    HotKeys,
    heaviest_keys,
    repeated,
    salted,
)


class DistributedPair:
    """A large and a small table bucketed by ``key`` and sub-bucket, in ``buckets`` buckets.

    ``name`` prefixes two tables of the catalog, stored under ``path``. The small table grows
    by the copies of rows that belong to hot keys: at most one per ``min_rows`` rows of the
    large table and row of the key. The key of either table may be null and may repeat.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, key: str, buckets: int):
        self.spark = spark
        self.key = key
        self.buckets = buckets
        self.path = path.rstrip("/")
        self.large, self.small = f"{name}_large", f"{name}_small"

    def write(
        self,
        large: DataFrame,
        small: DataFrame,
        spread: Sequence[str] | None = None,
        hot: HotKeys | None = None,
        min_rows: int = ROWS_PER_SALT,
    ) -> None:
        """Store both tables. ``spread`` names columns that tell the large table's rows apart."""
        hot = heaviest_keys(large, self.key, min_rows) if hot is None else hot
        self._store(salted(large, self.key, hot, spread), self.large)
        self._store(repeated(small, self.key, hot), self.small)

    def _store(self, rows: DataFrame, table: str) -> None:
        by = [self.key, SALT]
        (
            rows.repartition(self.buckets, *by)
            .write.bucketBy(self.buckets, *by)
            .sortBy(*by)
            .option("path", f"{self.path}/{table}")
            .saveAsTable(table)
        )

    def join(self, how: str = "inner") -> DataFrame:
        """The large table joined with the small one by key, without a shuffle."""
        if how not in ("inner", "left", "left_semi", "left_anti"):
            raise ValueError(f"unsupported join type: {how}")
        large, small = self.spark.table(self.large), self.spark.table(self.small)
        return large.join(small, [self.key, SALT], how).drop(SALT)

    def read_large(self) -> DataFrame:
        return self.spark.table(self.large).drop(SALT)

    def read_small(self) -> DataFrame:
        """The rows of the small table, each once: every one is stored in sub-bucket 0."""
        return self.spark.table(self.small).filter(f"{SALT} = 0").drop(SALT)
