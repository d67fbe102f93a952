"""The whole run: ingest, replicate, build, test, publish; the first failure stops it.

Replication and incremental marts read the change feeds of the ingested tables. The marts are
written, tested, and only then shown, both at once: a failed test leaves the old ones in place.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.quality import fail_if_any, run_suite
from tidemark.operators.skew import heaviest_keys
from tidemark.operators.state import Marks, open_state
from tidemark.operators.tables import (
    SnapshotTable,
    compact_landing_in_place,
    read_landing,
    sweep_landing,
)
from tidemark.operators.upsert import SIGN
from tidemark.plans.ingest import ingest, oltp_table
from tidemark.plans.mart_state import MartState
from tidemark.plans.marts import mart_comment_statistics, mart_user_post_summary
from tidemark.plans.replicate import replicate_feed
from tidemark.plans.staging import (
    clean_comments,
    clean_posts,
    clean_users,
    stg_comments,
    stg_posts,
    stg_users,
)
from tidemark.plans.transforms import ENTITIES, select_entities, to_landing
from tidemark.schemas import STAGING
from tidemark.session import materialise, short_lived_shuffles

# Fixed: model, entity and builder.
STAGING_MODELS = {
    "stg_users": ("users", stg_users),
    "stg_posts": ("posts", stg_posts),
    "stg_comments": ("comments", stg_comments),
}
CLEANERS = {"users": clean_users, "posts": clean_posts, "comments": clean_comments}
# Staging columns that the marts and the data tests use.
MART_INPUTS = {
    "stg_users": ("user_id", "username", "full_name", "email", "company_name", "city"),
    "stg_posts": ("post_id", "user_id", "title", "title_length", "body_length"),
    "stg_comments": ("comment_id", "post_id", "commenter_email", "body_length"),
}
MART_KEYS = {"mart_user_post_summary": "user_id", "mart_comment_statistics": "post_id"}

#: Batches of a landing table after which a run folds them into one version per key.
COMPACT_AFTER = 24


@dataclass
class RunReport:
    ingested: dict[str, int]
    replicated: dict[str, int]
    reconciliation: DataFrame
    models: dict[str, DataFrame]
    suite: DataFrame


def landing_path(root: str, entity: str) -> str:
    return f"{root}/landing/{entity}"


def replicate_all(
    spark: SparkSession,
    root: str,
    now: datetime,
    which: str = "all",
    buckets: int | None = None,
    strict: bool = True,
    compact_after: int | None = COMPACT_AFTER,
) -> tuple[dict[str, int], DataFrame]:
    """Replicate every table, then fail if any count check failed.

    A landing table with ``compact_after`` batches since it was last folded is folded; with
    None none is, until :func:`fold_landing`.
    """
    state = open_state(spark, f"{root}/raw/sync_watermark", list(ENTITIES))
    marks = Marks(spark, f"{root}/raw/feed_marks")
    done = []
    for spec in select_entities(which):
        table = oltp_table(spark, root, spec, buckets)
        done.append(replicate_feed(table, landing_path(root, spec.name), state, marks, spec, now))
        if compact_after is not None:
            fold_landing(spark, root, spec.name, compact_after)
    checks = materialise(reduce(DataFrame.unionByName, [r.check for r in done]), "reconciliation")
    if strict:
        fail_if_any(checks, "reconciliation")
    return {r.table: r.rows for r in done}, checks


def fold_landing(
    spark: SparkSession, root: str, which: str, compact_after: int, sweep: bool = False
) -> None:
    """Fold landing tables with that many batches; ``sweep`` deletes what a fold then holds."""
    marks = Marks(spark, f"{root}/raw/feed_marks")
    folded = Marks(spark, f"{root}/raw/folded_batches")
    for spec in select_entities(which):
        path = landing_path(root, spec.name)
        # Batches are numbered by feed version: the difference bounds their number.
        if marks.get(spec.name) - folded.get(spec.name) >= compact_after:
            upto = compact_landing_in_place(spark, path, spec.landing, spec.key, spec.version)
            folded.set(spec.name, upto)
        if sweep:
            sweep_landing(spark, path)


def sweep_taken(spark: SparkSession, root: str) -> None:
    """Delete feeds that replication and marts have taken in, and earlier mart versions."""
    marks = Marks(spark, f"{root}/raw/feed_marks")
    state = open_marts(spark, root)
    taken = state.feeds()
    for name, spec in ENTITIES.items():
        mark = marks.get(name)
        oltp_table(spark, root, spec).sweep_feeds(min(mark, taken.get(name, mark)))
    for table in state.tables.values():
        table.sweep()


def raw_versions(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The landing tables with all their versions."""
    return {
        name: read_landing(spark, landing_path(root, name), spec.landing)
        for name, spec in ENTITIES.items()
    }


def staging_views(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The staging models, recomputed on read, texts included."""
    raw = raw_versions(spark, root)
    return {name: build(raw[entity]) for name, (entity, build) in STAGING_MODELS.items()}


def _inputs_table(spark: SparkSession, root: str, name: str) -> SnapshotTable:
    schema = T.StructType([STAGING[name][c] for c in MART_INPUTS[name]])
    return SnapshotTable(spark, f"{root}/staging/{name}", schema)


def mart_inputs(spark: SparkSession, root: str, written: bool = True) -> dict[str, DataFrame]:
    """The staging columns that marts and tests use: as last written, or as views."""
    inputs = {}
    for name, view in staging_views(spark, root).items():
        table = _inputs_table(spark, root, name)
        inputs[name] = table.read() if written and table.exists() else view
    return inputs


def open_marts(spark: SparkSession, root: str, buckets: int | None = None) -> MartState:
    return MartState(spark, f"{root}/marts", buckets)


def read_marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The marts as last published, both of the same build."""
    return _marts_of(open_marts(spark, root))


def _marts_of(state: MartState) -> dict[str, DataFrame]:
    return {name: state.read(name) for name in MART_KEYS}


def build_models(
    spark: SparkSession,
    root: str,
    built_at: datetime,
    materialise_staging: bool = True,
    incremental: bool = False,
    buckets: int | None = None,
    publish: bool = True,
) -> DataFrame | None:
    """Build both marts, test them, and show them if no test failed; the test results.

    Staging feeds both marts and most tests. By default the columns those need are
    written once, so that the landing tables are scanned and de-duplicated once per run;
    bodies are measured on the way and neither shuffled nor copied. Without it every
    consumer repeats the de-duplication.

    ``incremental`` brings the marts up to date from the change feeds instead, once a build
    with partial results is there to go on from. With ``publish=False`` nothing is tested or
    shown until :func:`publish_models`.
    """
    state = open_marts(spark, root, buckets)
    results: list[DataFrame] = []

    def check(built: MartState) -> None:
        suite = run_suite(mart_inputs(spark, root, materialise_staging and not incremental) | _marts_of(built))
        results.append(materialise(suite, "suite"))
        fail_if_any(results[0], "data tests")

    test = check if publish else None
    if incremental:
        _bring_up_to_date(spark, root, state, built_at, buckets, test, publish)
        return results[0] if results else None
    raw = raw_versions(spark, root)
    inputs = staging_views(spark, root)
    if materialise_staging:
        for name in inputs:
            _inputs_table(spark, root, name).publish(inputs[name])
        inputs = mart_inputs(spark, root)
    users, posts, comments = (inputs[name] for name in STAGING_MODELS)
    marts = {
        "mart_user_post_summary": mart_user_post_summary(
            users, posts, comments, built_at, heaviest_keys(raw["comments"], "post_id")
        ),
        "mart_comment_statistics": mart_comment_statistics(
            posts, comments, users, built_at, hot_users=heaviest_keys(raw["posts"], "user_id")
        ),
    }
    state.publish(marts, test, publish)
    return results[0] if results else None


def _bring_up_to_date(
    spark: SparkSession,
    root: str,
    state: MartState,
    built_at: datetime,
    buckets: int | None,
    check,
    publish: bool,
) -> None:
    """Marts and partial results from the feeds, or as a whole where there are none yet."""
    tables = {name: oltp_table(spark, root, spec, buckets) for name, spec in ENTITIES.items()}
    # Up to what was replicated: the tests read the landing tables.
    marks = Marks(spark, f"{root}/raw/feed_marks")
    feeds = {name: marks.get(name) for name in tables}
    taken = state.feeds()
    if set(taken) != set(tables):
        views = staging_views(spark, root)
        state.load(*(views[m] for m in STAGING_MODELS), built_at, check, feeds, publish)
        return
    changes = {}
    for name, table in tables.items():
        images = table.changes(taken[name], feeds[name])
        signed = T.StructField(SIGN, T.IntegerType())
        landed = to_landing(images, T.StructType([*ENTITIES[name].landing.fields, signed]))
        changes[name] = CLEANERS[name](landed)
    state.refresh(**changes, built_at=built_at, check=check, feeds=feeds, visible=publish)


def read_models(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Staging views and the marts as last published."""
    return staging_views(spark, root) | read_marts(spark, root)


def check_models(spark: SparkSession, root: str, written: bool = True) -> DataFrame:
    """Results of the data tests on the models as last built, published or not."""
    state = open_marts(spark, root)
    state.pin_candidate()
    return run_suite(mart_inputs(spark, root, written) | _marts_of(state))


def publish_models(spark: SparkSession, root: str, written: bool = True) -> DataFrame:
    """Test the models as last built and show them; a failure leaves the old ones in place."""
    suite = materialise(check_models(spark, root, written), "suite")
    fail_if_any(suite, "data tests")
    open_marts(spark, root).publish_candidate()
    return suite


def run_elt(
    spark: SparkSession,
    paths: dict[str, str],
    root: str,
    batch_ts: datetime | None = None,
    lines: bool = False,
    buckets: int | None = None,
    touch_unchanged: bool = True,
    materialise_staging: bool = True,
    on_duplicate: str = "latest",
    incremental: bool = False,
    compact_after: int = COMPACT_AFTER,
    sweep: bool = False,
) -> RunReport:
    """Ingest -> replicate -> models -> tests -> publish. Safe to repeat with the same input.

    ``paths`` maps entity to payload folder; ``root`` is a folder all executors share.
    As a plain function it can be called by any scheduler, which also does the retries.

    ``sweep`` deletes what no step still needs as soon as that is so: staged batches, earlier
    versions of the tables, feeds that were taken in, folded batches. Landing tables are folded
    last then, when the feeds are gone. For runs that nobody reads earlier versions of; the
    frames of an earlier report cannot be read afterwards.
    """
    now = batch_ts or datetime.now(tz=timezone.utc)
    with short_lived_shuffles(spark):
        ingested = ingest(
            spark,
            paths,
            root,
            now,
            buckets=buckets,
            lines=lines,
            touch_unchanged=touch_unchanged,
            on_duplicate=on_duplicate,
            keep_staged=not sweep,
        )
        if sweep:
            for spec in ENTITIES.values():
                oltp_table(spark, root, spec).sweep()
        replicated, reconciliation = replicate_all(
            spark, root, now, buckets=buckets, compact_after=None if sweep else compact_after
        )
        suite = build_models(spark, root, now, materialise_staging, incremental, buckets)
        if sweep:
            sweep_taken(spark, root)
            fold_landing(spark, root, "all", compact_after, sweep=True)
    return RunReport(ingested, replicated, reconciliation, read_models(spark, root), suite)
