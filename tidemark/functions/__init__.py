"""Column expressions. All of them run inside the JVM; none is a Python UDF."""

from tidemark.functions.numbers import (
    decimal_to_double,
    optional_double,
    or_default,
    quantise,
    required_long,
    round2,
    uint32,
)
from tidemark.functions.rows import field, is_null, label, pass_fail, rename_select
from tidemark.functions.text import byte_length, lower_trim, normalise_email, trim
from tidemark.functions.times import built_at, stamp, timestamp_literal, to_millis

__all__ = [
    "built_at",
    "byte_length",
    "decimal_to_double",
    "field",
    "is_null",
    "label",
    "lower_trim",
    "normalise_email",
    "optional_double",
    "or_default",
    "pass_fail",
    "quantise",
    "rename_select",
    "required_long",
    "round2",
    "stamp",
    "timestamp_literal",
    "to_millis",
    "trim",
    "uint32",
]
