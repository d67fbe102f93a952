"""Staging views over the landing tables: latest version, clean names, text lengths.

Cleaning comes before the de-duplication on purpose. A consumer that needs only
``body_length`` then shuffles eight bytes per row: the text is measured while it is
scanned and column pruning drops it before the sort and the exchange. The cleaning alone
also serves the images of a change feed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import byte_length, lower_trim, trim
from tidemark.functions.numbers import in_uint32
from tidemark.operators.latest import latest_per_key
from tidemark.operators.upsert import SIGN
from tidemark.schemas import LANDING_MARKS


def require_uint32(df: DataFrame, *columns: str) -> DataFrame:
    """Fail when one of the key columns leaves the unsigned 32-bit range.

    Written as a filter, not as a changed column, so that a lookup by key still
    reaches the Parquet reader.
    """
    in_range = reduce(Column.__and__, [in_uint32(F.col(name)) for name in columns])
    shown = F.concat_ws(", ", *[F.col(name).cast("string") for name in columns])
    failure = F.raise_error(F.concat(F.lit("outside unsigned 32-bit range: "), shown))
    return df.filter(F.when(in_range, F.lit(True)).otherwise(failure.cast("boolean")))


def _carried(raw: DataFrame) -> list[str]:
    """The batch number of a version, the sign of an image."""
    return [c for c in (*LANDING_MARKS, SIGN) if c in raw.columns]


def clean_users(raw: DataFrame) -> DataFrame:
    return require_uint32(raw, "id").select(
        F.col("id").alias("user_id"),
        F.col("name").alias("full_name"),
        "username",
        lower_trim(F.col("email")).alias("email"),
        "phone",
        "website",
        "company_name",
        "city",
        "zipcode",
        "lat",
        "lng",
        "ingested_at",
        *_carried(raw),
    )


def stg_users(raw: DataFrame) -> DataFrame:
    return latest_per_key(clean_users(raw), "user_id", "ingested_at", drop=LANDING_MARKS)


def clean_posts(raw: DataFrame) -> DataFrame:
    title, body = trim(F.col("title")), trim(F.col("body"))
    return require_uint32(raw, "id", "user_id").select(
        F.col("id").alias("post_id"),
        "user_id",
        title.alias("title"),
        body.alias("body"),
        byte_length(title).alias("title_length"),
        byte_length(body).alias("body_length"),
        "ingested_at",
        *_carried(raw),
    )


def stg_posts(raw: DataFrame) -> DataFrame:
    return latest_per_key(clean_posts(raw), "post_id", "ingested_at", drop=LANDING_MARKS)


def clean_comments(raw: DataFrame) -> DataFrame:
    body = trim(F.col("body"))
    return require_uint32(raw, "id", "post_id").select(
        F.col("id").alias("comment_id"),
        "post_id",
        F.col("name").alias("commenter_name"),
        lower_trim(F.col("email")).alias("commenter_email"),
        body.alias("body"),
        byte_length(body).alias("body_length"),
        "ingested_at",
        *_carried(raw),
    )


def stg_comments(raw: DataFrame) -> DataFrame:
    return latest_per_key(clean_comments(raw), "comment_id", "ingested_at", drop=LANDING_MARKS)
