"""Marts refreshed for the keys a delta touches, instead of rebuilt.

A comment that moves to another post changes two posts and up to two authors, so the
affected keys come from the new rows *and* from the stored rows they replace. Everything
else is carried over from the stored mart.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tidemark.operators.changes import affected_keys, only_keys, refresh_mart, replaced_by
from tidemark.operators.skew import HotKeys
from tidemark.plans.marts import mart_comment_statistics, mart_user_post_summary


def posts_touched_by(
    delta_comments: DataFrame, old_comments: DataFrame, delta_posts: DataFrame | None = None
) -> DataFrame:
    """Distinct ``post_id`` whose statistics a delta of staged comments or posts changes."""
    changed = [delta_comments, replaced_by(old_comments, delta_comments, "comment_id")]
    if delta_posts is not None:
        changed.append(delta_posts)
    return affected_keys("post_id", *changed)


def authors_touched_by(
    touched_posts: DataFrame,
    posts: DataFrame,
    old_posts: DataFrame | None = None,
    delta_users: DataFrame | None = None,
) -> DataFrame:
    """Distinct ``user_id`` behind the touched posts, before and after, and changed users."""
    changed = [only_keys(posts, touched_posts, "post_id")]
    if old_posts is not None:
        changed.append(only_keys(old_posts, touched_posts, "post_id"))
    if delta_users is not None:
        changed.append(delta_users)
    return affected_keys("user_id", *changed)


def refresh_comment_statistics(
    old_mart: DataFrame,
    touched_posts: DataFrame,
    posts: DataFrame,
    comments: DataFrame,
    users: DataFrame,
    built_at: datetime | None = None,
    hot_posts: HotKeys | None = None,
    hot_users: HotKeys | None = None,
) -> DataFrame:
    """Post mart with the touched posts recomputed.

    A changed username changes all posts of that user: include them in
    ``touched_posts``.
    """

    def rebuild(keys: DataFrame) -> DataFrame:
        return mart_comment_statistics(
            only_keys(posts, keys, "post_id"),
            only_keys(comments, keys, "post_id", hot_posts),
            users,
            built_at,
            hot_users=hot_users,
        )

    return refresh_mart(old_mart, touched_posts, "post_id", rebuild)


def refresh_user_post_summary(
    old_mart: DataFrame,
    touched_users: DataFrame,
    users: DataFrame,
    posts: DataFrame,
    comments: DataFrame,
    built_at: datetime | None = None,
    hot_posts: HotKeys | None = None,
    hot_users: HotKeys | None = None,
) -> DataFrame:
    """User mart with the touched users recomputed over all their posts.

    Comments need no filter of their own: the join with the remaining posts drops the
    others.
    """

    def rebuild(keys: DataFrame) -> DataFrame:
        return mart_user_post_summary(
            only_keys(users, keys, "user_id"),
            only_keys(posts, keys, "user_id", hot_users),
            comments,
            built_at,
            hot_posts=hot_posts,
        )

    return refresh_mart(old_mart, touched_users, "user_id", rebuild)
