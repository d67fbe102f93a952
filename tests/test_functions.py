from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import functions as fn


def column(spark, kind, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in rows]


def test_byte_length_counts_bytes(spark):
    assert column(spark, "string", ["abc", "é", "–x", "", None], fn.byte_length) == [3, 2, 4, 0, None]


def test_round_half_even_and_null_is_zero(spark):
    values = [0.125, 0.375, 0.135, -0.125, None]
    assert column(spark, "double", values, fn.round2) == [0.12, 0.38, 0.14, -0.12, 0.0]


def test_email_at_ingest_strips_all_white_space(spark):
    values = [" \tA@B.c\n", " x@y.z ", "\x1cq@r.s\x1f", "  ", "", None]
    want = ["a@b.c", "x@y.z", "q@r.s", None, None, None]
    assert column(spark, "string", values, fn.normalise_email) == want


def test_staging_trims_spaces_only(spark):
    assert column(spark, "string", [" A\n ", "\tB "], fn.lower_trim) == ["a\n", "\tb"]
    assert column(spark, "string", [" A\n ", "\tB "], fn.trim) == ["A\n", "\tB"]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", ["abc", "", None, "1.5", "9223372036854775808"])
def test_required_integer_fails_in_either_mode(spark, ansi, bad):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            column(spark, "string", ["1", bad], lambda c: fn.required_long(c, "id"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_required_integer(spark):
    assert column(spark, "string", ["7", " 8 ", "-1"], fn.required_long) == [7, 8, -1]


def test_optional_double(spark):
    assert column(spark, "string", ["1.5", "", None, "-2"], fn.optional_double) == [1.5, None, None, -2.0]
    with pytest.raises(PySparkException):
        column(spark, "string", ["north"], fn.optional_double)


def test_quantise_rounds_and_overflows(spark):
    got = column(spark, "double", [1.23456789, -999.9999994, None], fn.quantise)
    assert got == [Decimal("1.234568"), Decimal("-999.999999"), None]
    with pytest.raises(PySparkException):
        column(spark, "double", [1000.0], fn.quantise)


def test_uint32_never_wraps(spark):
    assert column(spark, "bigint", [0, 2**32 - 1, None], fn.uint32) == [0, 2**32 - 1, None]
    for bad in (-1, 2**32):
        with pytest.raises(PySparkException):
            column(spark, "bigint", [bad], fn.uint32)


def test_to_millis_truncates(spark):
    value = datetime(2024, 1, 1, 0, 0, 0, 123999)
    assert column(spark, "timestamp_ntz", [value], fn.to_millis)[0].microsecond == 123000


def test_timestamp_literal_ignores_the_driver_zone(spark):
    plus2 = timezone(timedelta(hours=2))
    row = spark.range(1).select(
        F.unix_micros(fn.timestamp_literal(datetime(2024, 1, 1, 2, tzinfo=plus2))).alias("a"),
        F.unix_micros(fn.timestamp_literal(datetime(2024, 1, 1))).alias("b"),
        fn.timestamp_literal(datetime(2024, 1, 1, 2, tzinfo=plus2), "timestamp_ntz").alias("c"),
    ).first()
    assert row["a"] == row["b"] == 1704067200 * 10**6
    assert row["c"] == datetime(2024, 1, 1)


def test_nested_field_of_a_missing_parent_is_null(spark):
    df = spark.createDataFrame([(None,), ((("x",),),)], "a struct<b:struct<c:string>>")
    assert [r[0] for r in df.select(fn.field("a.b.c")).collect()] == [None, "x"]


def test_label_rename_and_pass_fail(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "a int, b int")
    labelled = fn.label(fn.rename_select(df, {"a": "x", "b": "y"}), "t")
    assert labelled.columns == ["table_name", "x", "y"]
    got = labelled.select(fn.pass_fail(F.col("x"), F.col("y"))).collect()
    assert [r[0] for r in got] == ["PASS", "FAIL"]


def test_stamp_is_one_value_per_batch(spark):
    df = fn.stamp(spark.range(1000), datetime(2024, 1, 1, tzinfo=timezone.utc))
    assert df.select("ingested_at").distinct().count() == 1
    assert "built_at" in fn.built_at(df).columns
