"""The joins the marts are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import ROWS_PER_SALT, HotKeys, skew_join

UNMATCHED = ("type_default", "null")
_MATCHED = "__matched"


def _marked(df: DataFrame, unmatched: str) -> DataFrame:
    if unmatched not in UNMATCHED:
        raise ValueError(f"unmatched must be one of {UNMATCHED}")
    return df.withColumn(_MATCHED, F.lit(True)) if unmatched == "type_default" else df


def _fill(joined: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """Where the outer join found no partner: 0 or empty text for the added columns.

    A null that came from a partner stays null.
    """
    if _MATCHED not in joined.columns:
        return joined

    def value(f: T.StructField):
        if isinstance(f.dataType, T.StringType):
            default = F.lit("")
        elif isinstance(f.dataType, T.NumericType):
            default = F.lit(0).cast(f.dataType)
        else:
            return F.col(f.name)
        return F.when(F.col(_MATCHED).isNull(), default).otherwise(F.col(f.name)).alias(f.name)

    filled = {f.name: value(f) for f in added.schema.fields if f.name != key}
    return joined.select(*[filled.get(c, F.col(c)) for c in joined.columns if c != _MATCHED])


def attribute_comments(
    comments: DataFrame,
    posts: DataFrame,
    hot: HotKeys | None = None,
    min_rows: int = ROWS_PER_SALT,
) -> DataFrame:
    """Each comment with the author of its post; comments without a post drop out."""
    authors = posts.select("post_id", "user_id")
    spread = ["comment_id"]
    return skew_join(comments, authors, "post_id", "inner", spread, hot, min_rows)


def left_metrics(
    base: DataFrame, metrics: DataFrame, key: str, unmatched: str = "null"
) -> DataFrame:
    """Keep every base row and attach the one metrics row of its key, if any.

    ``metrics`` is aggregated by ``key`` beforehand, so nothing fans out and, with one
    row per key on that side, no key of it can be hot.
    """
    joined = base.join(_marked(metrics, unmatched), key, "left")
    return _fill(joined, metrics, key)


def lookup(
    base: DataFrame,
    dim: DataFrame,
    key: str,
    unmatched: str = "type_default",
    spread: list[str] | None = None,
    hot: HotKeys | None = None,
    min_rows: int = ROWS_PER_SALT,
) -> DataFrame:
    """Many-to-one left join against a dimension.

    No broadcast is forced: Spark broadcasts the dimension when its measured size
    allows, and otherwise shuffles with hot keys of ``base`` split.
    """
    joined = skew_join(base, _marked(dim, unmatched), key, "left", spread, hot, min_rows)
    return _fill(joined, dim, key)


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    keys = parent.select(F.col(field).alias(column)).distinct()
    return skew_join(child.filter(F.col(column).isNotNull()), keys, column, "left_anti")
