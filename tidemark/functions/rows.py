"""Row-shape helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field(path: str) -> Column:
    """Nested field by dotted path; a null parent gives null."""
    return F.col(path)


def rename_select(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the columns named in ``mapping`` (source -> target), in that order."""
    return df.select(*[F.col(source).alias(target) for source, target in mapping.items()])


def label(df: DataFrame, name: str, column: str = "table_name") -> DataFrame:
    return df.select(F.lit(name).alias(column), *df.columns)


def pass_fail(a: Column, b: Column) -> Column:
    return F.when(a == b, F.lit("PASS")).otherwise(F.lit("FAIL"))


def is_null(c: Column) -> Column:
    return c.isNull()
