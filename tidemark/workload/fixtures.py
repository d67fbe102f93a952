"""The pipeline's entities as views over the star-schema test tables.

Every view covers its whole base table. Raw views hold two versions of every row, the
older one marked STALE, in two batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BATCH_SEQ
from tidemark.sources.tables import Sources

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


class Tables(Sources):
    """The test tables, and the views built on them, each built once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        folder = sf_dir.rstrip("/")
        super().__init__(spark, {t: f"{folder}/{t}.parquet" for t in TABLES})
        self.views: dict[str, DataFrame] = {}


def view(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def once(src: Tables) -> DataFrame:
        if build.__name__ not in src.views:
            src.views[build.__name__] = build(src)
        return src.views[build.__name__]

    return once


def _seconds_after_start(seconds: str):
    return F.expr(f"timestamp'2024-01-02 00:00:00' + make_dt_interval(0, 0, 0, {seconds})")


@view
def users(src: Tables) -> DataFrame:
    nation = src("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        src("customer")
        .join(nation, "c_nationkey")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.expr("concat('user', c_custkey)").alias("username"),
            F.expr("concat('  User', c_custkey, '@Example.COM ')").alias("email"),
            F.expr("concat('+1-555-', c_custkey)").alias("phone"),
            F.expr("concat('site', c_nationkey, '.example')").alias("website"),
            F.col("c_mktsegment").alias("company_name"),
            F.col("n_name").alias("city"),
            F.expr("cast(c_nationkey as string)").alias("zipcode"),
            F.expr("cast(cast(c_acctbal / 100 as decimal(9,6)) as double)").alias("lat"),
            F.expr("cast(cast(-c_acctbal / 200 as decimal(9,6)) as double)").alias("lng"),
            _seconds_after_start("c_custkey").alias("ingested_at"),
        )
    )


@view
def posts(src: Tables) -> DataFrame:
    return src("documents").select(
        F.col("doc_id").alias("id"),
        F.expr("doc_id % 150").alias("user_id"),
        F.expr("concat('  ', source, ' – ', lang, ' ')").alias("title"),
        F.col("text").alias("body"),
        _seconds_after_start("doc_id").alias("ingested_at"),
    )


@view
def comments(src: Tables) -> DataFrame:
    return src("conversations").select(
        F.expr("conv_id * 1000 + turn").alias("id"),
        F.col("conv_id").alias("post_id"),
        F.col("role").alias("name"),
        F.expr("concat(' ', role, turn, '@Example.COM')").alias("email"),
        F.col("text").alias("body"),
        _seconds_after_start("conv_id * 1000 + turn").alias("ingested_at"),
    )


def _two_batches(current: DataFrame, stale_column: str) -> DataFrame:
    stale = current.withColumns(
        {
            stale_column: F.lit("STALE"),
            "ingested_at": F.expr("timestamp'2023-12-31 00:00:00'"),
            BATCH_SEQ: F.lit(1).cast("bigint"),
        }
    )
    return current.withColumn(BATCH_SEQ, F.lit(2).cast("bigint")).unionByName(stale)


@view
def raw_users(src: Tables) -> DataFrame:
    return _two_batches(users(src), "name")


@view
def raw_posts(src: Tables) -> DataFrame:
    return _two_batches(posts(src), "title")


@view
def raw_comments(src: Tables) -> DataFrame:
    return _two_batches(comments(src), "name")


@view
def changes(src: Tables) -> DataFrame:
    """Events as a changelog of user rows; an error event deletes the user."""
    return src("events").select(
        "user_id",
        "ts",
        "event_id",
        "event_type",
        "value",
        F.expr("case when event_type = 'error' then 'D' else 'U' end").alias("op"),
    )


# The large shape: customers, orders and line items as staged users, posts, comments.


@view
def rel_users(src: Tables) -> DataFrame:
    nation = src("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        src("customer")
        .join(nation, "c_nationkey")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.expr("concat('user', c_custkey)").alias("username"),
            F.col("c_name").alias("full_name"),
            F.expr("concat('user', c_custkey, '@example.com')").alias("email"),
            F.col("c_mktsegment").alias("company_name"),
            F.col("n_name").alias("city"),
        )
    )


@view
def rel_posts(src: Tables) -> DataFrame:
    return src("orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("title"),
        F.expr("cast(octet_length(o_orderpriority) as bigint)").alias("title_length"),
        F.expr("cast(floor(o_totalprice) as bigint)").alias("body_length"),
    )


@view
def rel_comments(src: Tables) -> DataFrame:
    return src("lineitem").select(
        F.expr("xxhash64(l_partkey, l_suppkey, l_linenumber, l_extendedprice)").alias(
            "comment_id"
        ),
        F.col("l_orderkey").alias("post_id"),
        F.expr("concat('supp', l_suppkey, '@example.com')").alias("commenter_email"),
        F.expr("cast(l_quantity as bigint)").alias("body_length"),
    )
