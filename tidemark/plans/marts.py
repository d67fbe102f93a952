"""The two marts.

``hot_posts`` and ``hot_users`` are optional lists from
:func:`tidemark.operators.skew.heaviest_keys`. Left out, they are counted on the frames
given; a caller that holds the landing tables counts them there for less. ``min_rows`` is
the number of rows from which a key counted here is split.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import built_at as with_built_at
from tidemark.functions import or_default, round2
from tidemark.operators.aggregates import comment_metrics, comments_received, post_metrics
from tidemark.operators.joins import left_metrics, lookup
from tidemark.operators.skew import ROWS_PER_SALT, HotKeys, heaviest_keys
from tidemark.schemas import MARTS


def _finish(
    joined: DataFrame, name: str, dimensions: list[str], built_at: datetime | None
) -> DataFrame:
    """The declared columns in order, stamped.

    Everything but the dimensions is a measure: zero where there was nothing to
    measure, averages to two decimals.
    """

    def column(f: T.StructField):
        c = F.col(f.name)
        if f.name in dimensions:
            return c
        value = round2(c) if isinstance(f.dataType, T.DoubleType) else or_default(c)
        return value.alias(f.name)

    declared = [f for f in MARTS[name].fields if f.name != "built_at"]
    return with_built_at(joined.select(*[column(f) for f in declared]), built_at)


def mart_user_post_summary(
    users: DataFrame,
    posts: DataFrame,
    comments: DataFrame,
    built_at: datetime | None = None,
    hot_posts: HotKeys | None = None,
    min_rows: int = ROWS_PER_SALT,
) -> DataFrame:
    """One row per user; posts of unknown authors do not appear.

    Posts and comments are each aggregated to one row per author before they meet the
    users, so no measure is counted twice. Posts are used twice, but only the metrics
    branch reads their text; the join with the comments needs two narrow columns.
    """
    received = comments_received(comments, posts, hot_posts, min_rows)
    return user_summary_of(users, post_metrics(posts), received, built_at)


def user_summary_of(
    users: DataFrame, posted: DataFrame, received: DataFrame, built_at: datetime | None = None
) -> DataFrame:
    """The user mart from measures of one row per user."""
    profile = ["user_id", "username", "full_name", "email", "company_name", "city"]
    summary = users.select(*profile)
    for metrics in (posted, received):
        summary = left_metrics(summary, metrics, "user_id")
    return _finish(summary, "mart_user_post_summary", profile, built_at)


def mart_comment_statistics(
    posts: DataFrame,
    comments: DataFrame,
    users: DataFrame,
    built_at: datetime | None = None,
    unmatched: str = "type_default",
    hot_users: HotKeys | None = None,
    min_rows: int = ROWS_PER_SALT,
) -> DataFrame:
    """One row per post; a post of an unknown author stays, by default with an empty name.

    The metrics join needs no shuffle of its own: the posts are still partitioned by
    ``post_id`` from their de-duplication, and so are the aggregated comments.
    """
    metrics = comment_metrics(comments)
    return comment_statistics_of(posts, metrics, users, built_at, unmatched, hot_users, min_rows)


def comment_statistics_of(
    posts: DataFrame,
    metrics: DataFrame,
    users: DataFrame,
    built_at: datetime | None = None,
    unmatched: str = "type_default",
    hot_users: HotKeys | None = None,
    min_rows: int = ROWS_PER_SALT,
) -> DataFrame:
    """The post mart from measures of one row per post.

    Authors to split are counted on the posts alone: as many rows, and nothing is joined for it.
    """
    if hot_users is None:
        hot_users = heaviest_keys(posts, "user_id", min_rows)
    subject = posts.select("post_id", "user_id", F.col("title").alias("post_title"))
    measured = left_metrics(subject, metrics, "post_id")
    authors = users.select("user_id", F.col("username").alias("author_username"))
    named = lookup(measured, authors, "user_id", unmatched, ["post_id"], hot_users, min_rows)
    dimensions = ["post_id", "user_id", "author_username", "post_title"]
    return _finish(named, "mart_comment_statistics", dimensions, built_at)
