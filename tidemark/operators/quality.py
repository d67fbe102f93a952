"""Declarative data tests, reconciliation and count checks.

A test counts failing rows (or failing values); zero is a pass.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import is_null, pass_fail
from tidemark.operators.aggregates import duplicates, row_count
from tidemark.operators.latest import final_count


class CheckFailed(RuntimeError):
    """A data test, a reconciliation or a count check did not pass."""


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str
    to: str | None = None
    field: str | None = None

    @property
    def name(self) -> str:
        base = f"{self.kind}_{self.model}_{self.column}"
        return base if self.to is None else f"{base}__{self.field}__{self.to}"


# The tests of each model.
SUITE = (
    Check("not_null", "stg_users", "user_id"),
    Check("unique", "stg_users", "user_id"),
    Check("not_null", "stg_users", "email"),
    Check("not_null", "stg_posts", "post_id"),
    Check("unique", "stg_posts", "post_id"),
    Check("not_null", "stg_posts", "user_id"),
    Check("relationships", "stg_posts", "user_id", "stg_users", "user_id"),
    Check("not_null", "stg_comments", "comment_id"),
    Check("unique", "stg_comments", "comment_id"),
    Check("not_null", "stg_comments", "post_id"),
    Check("relationships", "stg_comments", "post_id", "stg_posts", "post_id"),
    Check("not_null", "stg_comments", "commenter_email"),
    Check("not_null", "mart_user_post_summary", "user_id"),
    Check("unique", "mart_user_post_summary", "user_id"),
    Check("not_null", "mart_user_post_summary", "total_posts"),
    Check("not_null", "mart_user_post_summary", "total_comments_received"),
    Check("not_null", "mart_comment_statistics", "post_id"),
    Check("unique", "mart_comment_statistics", "post_id"),
    Check("not_null", "mart_comment_statistics", "total_comments"),
    Check("not_null", "mart_comment_statistics", "user_id"),
)


# ---- single tests: the failing rows or values -------------------------------------


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows in which ``column`` is null."""
    return df.filter(is_null(F.col(column)))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated non-null values with their row counts."""
    return duplicates(df, column)


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Values without a parent, with the number of child rows each.

    The child is counted per value before the join: a value held by a third of all
    rows is one row by then.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    keys = parent.select(F.col(field).alias(column))
    return values.join(keys, column, "left_anti")


# ---- the suite --------------------------------------------------------------------


def _count_where(condition: Column, rows: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0)).cast("bigint")


def _column_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All not_null and unique tests of one model in one pass.

    Grouping by the unique column once answers its uniqueness, its nulls and, through
    per-group sums, the nulls of every other tested column.
    """
    keys = [c.column for c in checks if c.kind == "unique"]
    others = {c.column for c in checks if c.kind == "not_null" and c.column not in keys}
    if len(keys) > 1:
        first = [c for c in checks if c.kind != "unique" or c.column == keys[0]]
        rest = [c for c in checks if c.kind == "unique" and c.column != keys[0]]
        return _column_checks(df, first).unionByName(_column_checks(df, rest))

    nulls = [F.count_if(is_null(F.col(c))).alias(f"__null_{c}") for c in sorted(others)]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *nulls)

    def failures(check: Check) -> Column:
        if check.kind == "unique":
            repeated = F.col(check.column).isNotNull() & (F.col("__n") > 1)
            return _count_where(repeated, F.lit(1))
        if check.column in keys:
            return _count_where(is_null(F.col(check.column)), F.col("__n"))
        return F.coalesce(F.sum(f"__null_{check.column}"), F.lit(0)).cast("bigint")

    totals = groups.agg(*[failures(c).alias(c.name) for c in checks])
    return totals.unpivot([], [c.name for c in checks], "test", "failures")


def _relationship_check(frames: dict[str, DataFrame], check: Check) -> DataFrame:
    failing = relationships(frames[check.model], check.column, frames[check.to], check.field)
    return failing.agg(_count_where(F.lit(True), F.col("n_records")).alias("failures")).select(
        F.lit(check.name).alias("test"), "failures"
    )


def run_suite(frames: dict[str, DataFrame], suite: tuple[Check, ...] = SUITE) -> DataFrame:
    """``(test, failures, status)``, one row per test: one pass per model, one anti join
    per relationship."""
    parts = []
    for model in dict.fromkeys(c.model for c in suite):
        checks = [c for c in suite if c.model == model and c.kind in ("not_null", "unique")]
        if checks:
            parts.append(_column_checks(frames[model], checks))
    parts += [_relationship_check(frames, c) for c in suite if c.kind == "relationships"]
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("status", pass_fail(F.col("failures"), F.lit(0)))


# ---- counts -----------------------------------------------------------------------


def reconcile_counts(
    source: DataFrame, target: DataFrame, table: str, key: str = "id"
) -> DataFrame:
    """Rows of the source against logical rows of the landing table."""
    sides = row_count(source, "source_rows").unionByName(
        final_count(target, key, "target_rows"), allowMissingColumns=True
    )
    return sides.agg(
        F.lit(table).alias("table_name"),
        F.max("source_rows").alias("source_rows"),
        F.max("target_rows").alias("target_rows"),
    ).withColumn("status", pass_fail(F.col("source_rows"), F.col("target_rows")))


def assert_counts(counts: DataFrame, expected: DataFrame) -> DataFrame:
    """``counts`` against ``expected``, both ``(table_name, rows)``; a missing table fails."""
    wanted = expected.select("table_name", F.col("rows").alias("expected_rows"))
    status = F.when(F.col("rows") == F.col("expected_rows"), F.lit("PASS")).otherwise(
        F.lit("FAIL")
    )
    return wanted.join(counts, "table_name", "left").select(
        "table_name", "rows", "expected_rows", status.alias("status")
    )


def failing(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "FAIL")


def fail_if_any(results: DataFrame, what: str = "checks") -> None:
    """Raise when a result row has status FAIL. Results are one row per test or table."""
    rows = failing(results).collect()
    if rows:
        raise CheckFailed(f"{what} failed: " + "; ".join(str(r.asDict()) for r in rows))
