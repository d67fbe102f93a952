"""Nested JSON records landed as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import PAYLOAD


class PayloadError(ValueError):
    """A landed payload is not a JSON array."""


def is_json_array(payload: Column) -> Column:
    """Whether a whole payload is an array, by its first significant character."""
    return F.coalesce(payload.rlike(r"^[\s\x{FEFF}]*\["), F.lit(False))


def check_payload_shape(spark: SparkSession, path: str) -> None:
    """Fail unless every landed file holds a JSON array.

    The JSON reader would take a bare object, such as an error message, for one row. A file
    that holds nothing has no records; Spark leaves it out itself unless it is compressed.
    """
    payloads = spark.read.text(path, wholetext=True)
    wrong = (
        payloads.filter((F.col("value") != "") & ~is_json_array(F.col("value")))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.col("_metadata.file_path")).alias("first"),
        )
        .first()
    )
    if wrong["n"]:
        raise PayloadError(f"{wrong['n']} payloads are not JSON arrays, first {wrong['first']}")


def read_json_entities(
    spark: SparkSession,
    path: str,
    entity: str | T.StructType,
    lines: bool = False,
) -> DataFrame:
    """Records of one entity with the declared nested schema.

    ``lines=False`` reads response files, each a JSON array; a file is one task then,
    so land responses as many moderate files. ``lines=True`` reads one record per line,
    which Spark splits inside a file as well. Malformed input fails the read.
    """
    schema = PAYLOAD[entity] if isinstance(entity, str) else entity
    if not lines:
        check_payload_shape(spark, path)
    return (
        spark.read.schema(schema)
        .option("mode", "FAILFAST")
        .option("multiLine", not lines)
        .json(path)
    )


def parse_json(payload: Column, schema: T.StructType) -> Column:
    """Typed struct from a JSON text column; malformed text fails the job."""
    return F.from_json(payload, schema, {"mode": "FAILFAST"})
