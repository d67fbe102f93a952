"""Payload files into the keyed OLTP tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import SparkSession

from tidemark.operators.tables import SnapshotTable
from tidemark.plans.transforms import EntitySpec, select_entities
from tidemark.sources.json_entities import read_json_entities


def oltp_table(
    spark: SparkSession, root: str, spec: EntitySpec, buckets: int | None = None
) -> SnapshotTable:
    return SnapshotTable(spark, f"{root}/raw/{spec.name}", spec.oltp, spec.key, buckets)


def ingest_entity(
    spark: SparkSession,
    spec: EntitySpec,
    path: str,
    table: SnapshotTable,
    batch_ts: datetime,
    lines: bool = False,
    touch_unchanged: bool = True,
    on_duplicate: str = "latest",
    feed: bool = True,
    keep_staged: bool = True,
) -> int:
    """Read, check, flatten and upsert one entity; returns the rows read.

    ``feed`` writes the change feed that replication and incremental marts read.
    """
    rows = spec.transform(read_json_entities(spark, path, spec.payload, lines), batch_ts)
    return table.upsert(
        rows,
        feed=feed,
        keep_staged=keep_staged,
        touch_unchanged=touch_unchanged,
        on_duplicate=on_duplicate,
    )


def ingest(
    spark: SparkSession,
    paths: dict[str, str],
    root: str,
    batch_ts: datetime,
    which: str = "all",
    buckets: int | None = None,
    **options,
) -> dict[str, int]:
    """Ingest one or all entities; independent entities run at the same time.

    The first failure is raised once the running entities have finished.
    """
    specs = select_entities(which)
    with ThreadPoolExecutor(max_workers=len(specs)) as pool:
        runs = {
            spec.name: pool.submit(
                ingest_entity,
                spark,
                spec,
                paths[spec.name],
                oltp_table(spark, root, spec, buckets),
                batch_ts,
                **options,
            )
            for spec in specs
        }
    return {name: run.result() for name, run in runs.items()}
