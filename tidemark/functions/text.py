"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: Unicode white space plus the four ASCII separators, at either end.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def normalise_email(c: Column) -> Column:
    """Strip every kind of white space from both ends, lower-case, empty to null."""
    return F.nullif(F.lower(F.regexp_replace(c, _EDGE_SPACE, "")), F.lit(""))


def trim(c: Column) -> Column:
    """Strip spaces only; tabs and newlines stay."""
    return F.trim(c)


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def byte_length(c: Column) -> Column:
    """UTF-8 bytes, not characters, as a 64-bit count."""
    return F.octet_length(c).cast("bigint")
