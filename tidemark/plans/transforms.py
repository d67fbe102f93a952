"""Nested payload records to flat rows, and the entity registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import (
    field,
    normalise_email,
    optional_double,
    quantise,
    required_long,
    stamp,
)


def transform_user(records: DataFrame, batch_ts: datetime) -> DataFrame:
    flat = records.select(
        required_long(field("id"), "id").alias("id"),
        "name",
        "username",
        normalise_email(field("email")).alias("email"),
        "phone",
        "website",
        field("company.name").alias("company_name"),
        field("address.city").alias("city"),
        field("address.zipcode").alias("zipcode"),
        quantise(optional_double(field("address.geo.lat"))).alias("lat"),
        quantise(optional_double(field("address.geo.lng"))).alias("lng"),
    )
    return stamp(flat, batch_ts)


def transform_post(records: DataFrame, batch_ts: datetime) -> DataFrame:
    flat = records.select(
        required_long(field("id"), "id").alias("id"),
        required_long(field("userId"), "userId").alias("user_id"),
        "title",
        "body",
    )
    return stamp(flat, batch_ts)


def transform_comment(records: DataFrame, batch_ts: datetime) -> DataFrame:
    flat = records.select(
        required_long(field("id"), "id").alias("id"),
        required_long(field("postId"), "postId").alias("post_id"),
        "name",
        normalise_email(field("email")).alias("email"),
        "body",
    )
    return stamp(flat, batch_ts)


@dataclass(frozen=True)
class EntitySpec:
    """What the pipeline needs to know about one entity."""

    name: str
    transform: Callable[[DataFrame, datetime], DataFrame]
    key: str = "id"
    version: str = "ingested_at"

    @property
    def payload(self) -> T.StructType:
        return schemas.PAYLOAD[self.name]

    @property
    def oltp(self) -> T.StructType:
        return schemas.OLTP[self.name]

    @property
    def landing(self) -> T.StructType:
        return schemas.LANDING[self.name]

    @property
    def columns(self) -> list[str]:
        return self.landing.fieldNames()


ENTITIES = {
    "users": EntitySpec("users", transform_user),
    "posts": EntitySpec("posts", transform_post),
    "comments": EntitySpec("comments", transform_comment),
}


def select_entities(which: str = "all") -> list[EntitySpec]:
    """One entity by name, or all of them in registry order."""
    if which == "all":
        return list(ENTITIES.values())
    if which not in ENTITIES:
        raise ValueError(f"unknown entity {which!r}; known: {list(ENTITIES)} or 'all'")
    return [ENTITIES[which]]


def to_landing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """OLTP row to landing row: declared order, fixed-point coordinates to doubles."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
