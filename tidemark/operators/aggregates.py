"""Aggregations.

All of them combine on the map side first. An exact distinct count next to other
aggregates shuffles by (key, value) before it shuffles by key, so a hot key is spread
over its values and never gathered in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import label
from tidemark.operators.joins import attribute_comments
from tidemark.operators.skew import ROWS_PER_SALT, HotKeys


def row_count(df: DataFrame, alias: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def table_counts(
    frames: dict[str, DataFrame], column: str = "table_name", alias: str = "rows"
) -> DataFrame:
    """One labelled row count per frame, in one job."""
    parts = [label(row_count(df, alias), name, column) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def max_version(batch: DataFrame, column: str) -> DataFrame:
    return batch.agg(F.max(column).alias(column))


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Non-null values of ``key`` that occur more than once, with their row counts."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def post_metrics(posts: DataFrame) -> DataFrame:
    """Posts per user, with average and total lengths."""
    return posts.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_posts"),
        F.avg("title_length").alias("avg_post_title_length"),
        F.avg("body_length").alias("avg_post_body_length"),
        F.sum("body_length").alias("total_post_body_length"),
    )


def comment_metrics(comments: DataFrame) -> DataFrame:
    """Comment volume, distinct commenters and length spread per post."""
    return comments.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.count_distinct("commenter_email").alias("unique_commenter_emails"),
        F.avg("body_length").alias("avg_comment_length"),
        F.min("body_length").alias("min_comment_length"),
        F.max("body_length").alias("max_comment_length"),
    )


def comments_received(
    comments: DataFrame,
    posts: DataFrame,
    hot: HotKeys | None = None,
    min_rows: int = ROWS_PER_SALT,
) -> DataFrame:
    """Comments and distinct commenters over all posts of each author."""
    needed = comments.select("comment_id", "post_id", "commenter_email")
    return (
        attribute_comments(needed, posts, hot, min_rows)
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("total_comments_received"),
            F.count_distinct("commenter_email").alias("unique_commenters"),
        )
    )


def top_k(df: DataFrame, metric: str, key: str, k: int = 5) -> DataFrame:
    """The ``k`` largest by ``metric``; the key settles ties.

    Spark runs this as a top-k per task followed by a merge, not as a full sort.
    """
    return df.orderBy(F.col(metric).desc(), F.col(key)).limit(k)
