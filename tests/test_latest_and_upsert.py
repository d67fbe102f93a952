import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import final_count, latest_per_key, latest_values
from tidemark.operators.tables import SnapshotTable
from tidemark.operators.upsert import insert_ignore, merge_partitioned, upsert

T0 = datetime(2024, 1, 1)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def versions(spark, n=4000, seed=1):
    """A third of all rows belong to key 0."""
    rng = random.Random(seed)
    rows = [
        (0 if rng.random() < 1 / 3 else rng.randrange(1, 200), T0 + timedelta(seconds=rng.randrange(50)), i, f"b{i}")
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "id long, ingested_at timestamp, batch_seq long, body string").repartition(7)


def test_latest_per_key_against_brute_force(spark):
    rows, df = versions(spark)
    best = {}
    for r in rows:
        if r[0] not in best or (r[1], r[2]) > (best[r[0]][1], best[r[0]][2]):
            best[r[0]] = r
    got = latest_per_key(df, "id", "ingested_at").collect()
    assert {tuple(r) for r in got} == set(best.values())


def test_latest_per_key_reduces_before_the_shuffle(spark):
    _, df = versions(spark, 100)
    text = plan_of(latest_per_key(df, "id", "ingested_at"))
    assert text.count("WindowGroupLimit (") >= 2  # once per map task, once after the exchange


def test_ties_without_a_batch_number_are_settled_the_same_way_every_time(spark):
    rows = [(k, T0, f"body {k} {i}") for k in range(20) for i in range(5)]
    frames = [
        spark.createDataFrame(random.Random(s).sample(rows, len(rows)), "id long, ingested_at timestamp, body string").repartition(3)
        for s in (1, 2, 3)
    ]
    results = [sorted(map(tuple, latest_per_key(f, "id", "ingested_at").collect())) for f in frames]
    assert results[0] == results[1] == results[2]


def test_latest_values_and_final_count(spark):
    df = spark.createDataFrame(
        [(1, T0, "old"), (1, T0 + timedelta(1), "new"), (2, T0, "only")],
        "id long, ingested_at timestamp, body string",
    )
    got = latest_values(df, "id", "ingested_at", ["body"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "new"), (2, "only")]
    assert final_count(df, "id").first()[0] == 2


# ---- upsert -----------------------------------------------------------------------

SCHEMA = "id long, body string, ingested_at timestamp"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", T0), (2, "b", T0), (3, None, T0)], SCHEMA)


def test_upsert_replaces_all_columns_and_inserts(spark, target):
    later = T0 + timedelta(1)
    batch = spark.createDataFrame([(2, None, later), (4, "d", later)], SCHEMA)
    once = upsert(target, batch, "id")
    want = [(1, "a", T0), (2, None, later), (3, None, T0), (4, "d", later)]
    assert rows_of(once) == want
    assert rows_of(upsert(once, batch, "id")) == want


def test_upsert_of_nothing(spark, target):
    assert rows_of(upsert(target, target.limit(0), "id")) == rows_of(target)


def test_repeated_key_in_the_batch(spark, target):
    later = T0 + timedelta(1)
    batch = spark.createDataFrame([(2, "x", T0), (2, "y", later)], SCHEMA)
    got = rows_of(upsert(target, batch, "id", version="ingested_at"))
    assert (2, "y", later) in got and len(got) == 3
    with pytest.raises(ValueError, match="more than once"):
        upsert(target, batch, "id", on_duplicate="error")


def test_unchanged_rows_may_keep_their_stamp(spark, target):
    later = T0 + timedelta(1)
    batch = spark.createDataFrame([(1, "a", later), (2, "B", later), (3, None, later)], SCHEMA)
    touched = rows_of(upsert(target, batch, "id"))
    assert [r[2] for r in touched] == [later] * 3
    kept = rows_of(upsert(target, batch, "id", touch_unchanged=False))
    assert kept == [(1, "a", T0), (2, "B", later), (3, None, T0)]


def test_newest_wins(spark, target):
    batch = spark.createDataFrame([(1, "older", T0 - timedelta(1)), (2, "newer", T0 + timedelta(1))], SCHEMA)
    got = rows_of(upsert(target, batch, "id", version="ingested_at", newest_wins=True))
    assert got[0] == (1, "a", T0) and got[1][1] == "newer"


def test_insert_ignore_keeps_existing_rows(spark, target):
    rows = spark.createDataFrame([(2, "ignored", T0), (9, "new", T0)], SCHEMA)
    got = rows_of(insert_ignore(target, rows, "id"))
    assert (2, "b", T0) in got and (9, "new", T0) in got and len(got) == 4


@pytest.mark.parametrize("buckets", [1, 4])
def test_snapshot_table_upsert_against_a_dict(spark, tmp_path, buckets):
    rng = random.Random(buckets)
    schema = spark.createDataFrame([], SCHEMA).schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, "id", buckets)
    assert not table.exists() and table.read().count() == 0
    want = {}
    for round_ in range(4):
        batch = {rng.randrange(60): f"r{round_}-{i}" for i in range(15)}
        want.update(batch)
        moved = table.upsert(spark.createDataFrame([(k, v, T0) for k, v in batch.items()], SCHEMA))
        assert moved == len(batch)
        assert rows_of(table.read()) == sorted((k, v, T0) for k, v in want.items())
    assert table.upsert(spark.createDataFrame([], SCHEMA)) == 0
    assert table.version() == 4


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, "id", 8)
    table.publish(spark.range(100).select("id", F.lit("x").alias("body"), F.lit(T0).alias("ingested_at")))
    before = table._live()[1]
    table.upsert(spark.createDataFrame([(5, "new", T0)], SCHEMA))
    after = table._live()[1]
    assert sum(before[b] != after[b] for b in before) == 1
    assert table.read().count() == 100
    assert table.read().filter("id = 5").first()["body"] == "new"


def test_merge_partitioned_equals_upsert(spark):
    rng = random.Random(9)
    rows = [(k, rng.choice(["a", "b", None]), T0 + timedelta(minutes=rng.randrange(3))) for k in range(40)]
    target = spark.createDataFrame(rows, SCHEMA)
    batch = spark.createDataFrame(
        [(rng.randrange(20, 60), rng.choice(["a", "b", None]), T0 + timedelta(minutes=rng.randrange(3))) for _ in range(60)],
        SCHEMA,
    )
    bucket = F.pmod(F.xxhash64("id"), F.lit(5)).cast("int")
    for options in (
        {"version": "ingested_at"},
        {"version": "ingested_at", "touch_unchanged": False},
        {"version": "ingested_at", "newest_wins": True},
    ):
        merged = merge_partitioned(
            target.withColumn("p", bucket), batch.withColumn("p", bucket), "id", "p", 5, **options
        )
        assert rows_of(merged.drop("p")) == rows_of(upsert(target, batch, "id", **options)), options
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("shufflepartitionidpassthrough") == 1
        assert plan.count("Exchange") == 2  # the other one reduces the batch to one row per key


def test_publish_replaces_every_bucket(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema, "id", 8)
    table.publish(spark.range(100).select("id", F.lit("x").alias("body"), F.lit(T0).alias("ingested_at")))
    table.publish(spark.createDataFrame([(1, "only", T0)], SCHEMA))
    assert rows_of(table.read()) == [(1, "only", T0)]


def test_a_write_that_never_committed_is_invisible(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema)
    table.publish(spark.createDataFrame([(1, "a", T0)], SCHEMA))
    table._write(spark.createDataFrame([(2, "b", T0)], SCHEMA), None, None)
    assert rows_of(table.read()) == [(1, "a", T0)]


def test_obsolete_paths(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema)
    for i in range(3):
        table.publish(spark.createDataFrame([(i, "a", T0)], SCHEMA))
    first = table._commits().filter("version = 1").first()["path"]
    assert [r["path"] for r in table.obsolete_paths(keep=2).collect()] == [first]
    # So is the data of a write that died.
    lost = f"{tmp_path}/t/data/lost"
    table.read().write.parquet(lost)
    found = {r["path"].removeprefix("file:") for r in table.obsolete_paths(keep=2).collect()}
    assert found == {first.removeprefix("file:"), lost}


@pytest.mark.parametrize(("written", "named"), [(4, 16), (16, 8), (16, 1), (1, 16), (4, None)])
def test_updates_keep_the_stored_number_of_buckets(spark, tmp_path, written, named):
    rows = [(i, "a", T0) for i in range(200)]
    batch = [(3, "b", T0), (7, "b", T0), (500, "b", T0)]
    schema = spark.createDataFrame([], SCHEMA).schema
    path = str(tmp_path / "t")
    SnapshotTable(spark, path, schema, "id", written).publish(spark.createDataFrame(rows, SCHEMA))
    SnapshotTable(spark, path, schema, "id", named).upsert(spark.createDataFrame(batch, SCHEMA))
    want = sorted({r[0]: r for r in rows + batch}.values())
    assert rows_of(SnapshotTable(spark, path, schema, "id").read()) == want
    again = SnapshotTable(spark, path, schema, "id", named)
    again.update(lambda df: df.withColumn("id", F.col("id") + 1))
    assert again.buckets == (named or written)
    assert rows_of(SnapshotTable(spark, path, schema, "id").read()) == [(i + 1, b, t) for i, b, t in want]


def test_insert_ignore_of_repeats_and_null_keys(spark):
    target = spark.createDataFrame([(1, "a", T0), (None, "n", T0)], SCHEMA)
    rows = spark.createDataFrame(
        [(1, "x", T0), (2, "x", T0), (2, "y", T0), (None, "z", T0)], SCHEMA
    )
    for parts in (1, 3):
        got = insert_ignore(target, rows.repartition(parts), "id").collect()
        assert sorted(str(r["id"]) for r in got) == ["1", "2", "None"]


def test_upsert_with_a_null_key_is_repeatable(spark):
    target = spark.createDataFrame([(1, "a", T0)], SCHEMA)
    batch = spark.createDataFrame([(None, "n", T0), (1, "b", T0)], SCHEMA)
    once = upsert(target, batch, "id")
    twice = upsert(once, batch, "id")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert once.count() == 2


def test_publish_may_read_the_table_itself(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = SnapshotTable(spark, str(tmp_path / "t"), schema)
    table.publish(spark.createDataFrame([(1, "a", T0)], SCHEMA))
    table.publish(table.read().withColumn("id", F.col("id") + 1))
    assert rows_of(table.read()) == [(2, "a", T0)]
