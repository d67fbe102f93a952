"""Parsing, ranges and rounding of numbers.

The parsers raise on malformed input whether or not the session runs in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UINT32_MAX = 2**32 - 1


def _fail(kind: str, message: str, c: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message), c.cast("string"))).cast(kind)


def required_long(c: Column, name: str = "value") -> Column:
    """Integer that must be there: a null or a malformed value fails the job."""
    parsed = c.try_cast("bigint")
    return (
        F.when(parsed.isNotNull(), parsed)
        .when(c.isNull(), F.raise_error(F.lit(f"{name} is missing")).cast("bigint"))
        .otherwise(_fail("bigint", f"{name} is not an integer: ", c))
    )


def optional_double(c: Column) -> Column:
    """Null or empty text to null; any other malformed value fails the job."""
    parsed = c.try_cast("double")
    return F.when(
        c.isNotNull() & (c != ""),
        F.when(parsed.isNotNull(), parsed).otherwise(_fail("double", "not a number: ", c)),
    )


def quantise(c: Column, precision: int = 9, scale: int = 6) -> Column:
    """Fixed-point storage type; a value too large for it fails the job."""
    kind = f"decimal({precision},{scale})"
    stored = c.try_cast(kind)
    return F.when(
        c.isNotNull(),
        F.when(stored.isNotNull(), stored).otherwise(_fail(kind, f"does not fit {kind}: ", c)),
    )


def decimal_to_double(c: Column) -> Column:
    return c.cast("double")


def in_uint32(c: Column) -> Column:
    return c.isNull() | c.between(0, UINT32_MAX)


def uint32(c: Column) -> Column:
    """Unsigned 32-bit value in a long; out of range fails the job instead of wrapping."""
    parsed = c.cast("bigint")
    return F.when(in_uint32(parsed), parsed).otherwise(
        _fail("bigint", "outside unsigned 32-bit range: ", c)
    )


def or_default(c: Column, default=0) -> Column:
    return F.coalesce(c, F.lit(default))


def round2(c: Column) -> Column:
    """Two decimals, ties to even; null counts as zero."""
    return F.bround(F.coalesce(c, F.lit(0.0)), 2)
