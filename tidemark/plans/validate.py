"""Stage-by-stage validation: is every row where it should be?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions import label
from tidemark.operators.aggregates import table_counts, top_k
from tidemark.operators.latest import final
from tidemark.operators.state import open_state
from tidemark.plans.elt import mart_inputs, raw_versions, read_marts, read_models
from tidemark.plans.ingest import oltp_table
from tidemark.plans.transforms import ENTITIES


def layer_counts(layers: dict[str, dict[str, DataFrame]]) -> DataFrame:
    """``(layer, table_name, rows)`` for every table of every layer."""
    parts = [label(table_counts(frames), layer, "layer") for layer, frames in layers.items()]
    return reduce(DataFrame.unionByName, parts)


def top_users(mart: DataFrame, k: int = 5) -> DataFrame:
    """Users by comments received."""
    return top_k(mart, "total_comments_received", "user_id", k).select(
        "user_id", "username", "total_posts", "total_comments_received", "unique_commenters"
    )


def top_posts(mart: DataFrame, k: int = 5) -> DataFrame:
    """Posts by number of comments."""
    return top_k(mart, "total_comments", "post_id", k).select(
        "post_id", "author_username", "total_comments", "avg_comment_length"
    )


def validation(spark: SparkSession, root: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """Counts per layer, the watermarks, and the two top lists of a finished run."""
    oltp = {n: oltp_table(spark, root, s, buckets).read() for n, s in ENTITIES.items()}
    raw = raw_versions(spark, root)
    landing = {n: final(raw[n], s.key, s.version) for n, s in ENTITIES.items()}
    marts = read_marts(spark, root)
    layers = {
        "oltp": oltp,
        "landing": landing,
        "staging": mart_inputs(spark, root),
        "marts": marts,
    }
    state = open_state(spark, f"{root}/raw/sync_watermark", list(ENTITIES))
    return {
        "counts": layer_counts(layers),
        "watermarks": state.read().orderBy("table_name"),
        "top_users": top_users(marts["mart_user_post_summary"]),
        "top_posts": top_posts(marts["mart_comment_statistics"]),
    }


def register_views(spark: SparkSession, root: str) -> None:
    """Temporary views ``raw_*`` (latest versions), ``stg_*`` and ``mart_*`` for SQL users."""
    for name, spec in ENTITIES.items():
        versions = raw_versions(spark, root)[name]
        final(versions, spec.key, spec.version).createOrReplaceTempView(f"raw_{name}")
    for name, df in read_models(spark, root).items():
        df.createOrReplaceTempView(name)
