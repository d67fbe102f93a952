import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import session
from tidemark.operators import deltas, distribution, quality, tables
from tidemark.operators.aggregates import table_counts
from tidemark.operators.latest import latest_per_key
from tidemark.streaming import (
    ORIGIN,
    append_upserts_stream,
    dedup_stream,
    dedup_stream_with_late,
    file_stream,
    replicate_stream,
    upsert_stream,
    write_stream,
)

T0 = datetime(2024, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- quality ----------------------------------------------------------------------


def clean_models(spark):
    return {
        "stg_users": spark.createDataFrame([(1, "a"), (2, "b")], "user_id long, email string"),
        "stg_posts": spark.createDataFrame([(1, 1), (2, 1)], "post_id long, user_id long"),
        "stg_comments": spark.createDataFrame([(1, 1, "e")], "comment_id long, post_id long, commenter_email string"),
        "mart_user_post_summary": spark.createDataFrame([(1, 2, 3)], "user_id long, total_posts long, total_comments_received long"),
        "mart_comment_statistics": spark.createDataFrame([(1, 2, 3)], "post_id long, total_comments long, user_id long"),
    }


def failures(results):
    return {r["test"]: r["failures"] for r in results.collect() if r["status"] == "FAIL"}


def test_suite_has_the_expected_tests():
    kinds = [c.kind for c in quality.SUITE]
    assert {k: kinds.count(k) for k in set(kinds)} == {"not_null": 13, "unique": 5, "relationships": 2}
    assert len({c.name for c in quality.SUITE}) == 20


def test_clean_models_pass(spark):
    results = quality.run_suite(clean_models(spark))
    assert results.count() == 20 and failures(results) == {}
    quality.fail_if_any(results)


def test_planted_violations_are_counted(spark):
    models = clean_models(spark)
    models["stg_users"] = spark.createDataFrame(
        [(1, "a"), (1, None), (1, None), (2, "b"), (2, "c"), (None, "x"), (None, "y")], "user_id long, email string"
    )
    models["stg_posts"] = spark.createDataFrame([(1, 1), (2, 8), (3, 8), (4, None)], "post_id long, user_id long")
    results = quality.run_suite(models)
    assert failures(results) == {
        "not_null_stg_users_user_id": 2,
        "unique_stg_users_user_id": 2,
        "not_null_stg_users_email": 2,
        "not_null_stg_posts_user_id": 1,
        "relationships_stg_posts_user_id__user_id__stg_users": 2,
    }
    with pytest.raises(quality.CheckFailed, match="unique_stg_users_user_id"):
        quality.fail_if_any(results)


def test_suite_of_an_empty_table_passes(spark):
    models = {name: df.limit(0) for name, df in clean_models(spark).items()}
    assert failures(quality.run_suite(models)) == {}


def test_model_with_two_unique_columns(spark):
    checks = (quality.Check("unique", "m", "a"), quality.Check("unique", "m", "b"), quality.Check("not_null", "m", "b"))
    df = spark.createDataFrame([(1, 1), (2, 1), (3, None)], "a long, b long")
    assert failures(quality.run_suite({"m": df}, checks)) == {"unique_m_b": 1, "not_null_m_b": 1}


def test_failing_rows(spark):
    df = spark.createDataFrame([(1, 7), (1, 8), (None, 9)], "k long, n long")
    assert [r["n"] for r in quality.not_null(df, "k").collect()] == [9]
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [(1, 2)]
    parent = spark.createDataFrame([(7,), (9,)], "id long")
    assert [tuple(r) for r in quality.relationships(df, "n", parent, "id").collect()] == [(8, 1)]


def test_reconcile_and_expected_counts(spark):
    source = spark.range(3)
    landing = source.union(source)
    assert tuple(quality.reconcile_counts(source, landing, "t").first()) == ("t", 3, 3, "PASS")
    short = quality.reconcile_counts(source, landing.filter("id > 0"), "t")
    assert tuple(short.first()) == ("t", 3, 2, "FAIL")
    counts = table_counts({"users": spark.range(10), "posts": spark.range(99)})
    expected = spark.createDataFrame([("users", 10), ("posts", 100), ("gone", 1)], "table_name string, rows long")
    status = {r["table_name"]: r["status"] for r in quality.assert_counts(counts, expected).collect()}
    assert status == {"users": "PASS", "posts": "FAIL", "gone": "FAIL"}


# ---- layout -----------------------------------------------------------------------


def test_sorted_layout_gives_disjoint_sorted_files(spark, tmp_path):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10_007).alias("k"))
    tables.sorted_layout(df, "k", files=5).write.parquet(str(tmp_path / "t"))
    ranges = sorted(
        (r["lo"], r["hi"])
        for r in spark.read.parquet(str(tmp_path / "t"))
        .groupBy(F.col("_metadata.file_path"))
        .agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        .collect()
    )
    assert len(ranges) == 5
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_dated_lake_prunes_and_replaces_dates(spark, tmp_path):
    path = str(tmp_path / "lake")
    df = spark.range(240).select(
        "id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, int(id), 0, 0)").alias("ts")
    )
    tables.write_by_date(df, "ts", path)
    lake = tables.read_dated(spark, path, df.schema)
    some = tables.between_dates(lake, "ts", datetime(2024, 1, 3, 12), datetime(2024, 1, 5, 12))
    assert sorted(r["id"] for r in some.collect()) == list(range(60, 108))
    assert "PartitionFilters: [isnotnull(dt" in plan_of(some) and "dt#" in plan_of(some)
    kept = tables.retain(lake, "ts", timedelta(days=2), datetime(2024, 1, 11))
    assert sorted(r["id"] for r in kept.collect()) == list(range(192, 240))
    # A full reload of one date leaves the others alone.
    again = df.filter("id < 24").withColumn("id", F.col("id") + 1000)
    tables.write_by_date(again, "ts", path, mode="overwrite")
    again = tables.read_dated(spark, path, df.schema)
    assert again.count() == 240 and again.filter("id >= 1000").count() == 24
    by_month = tables.between_dates(
        again.withColumn("dt", F.trunc("dt", "month")), "ts", datetime(2024, 1, 2), datetime(2024, 1, 3), "month"
    )
    assert by_month.count() == 24


def test_distributed_sides_join_without_another_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = tables.distribute(spark.range(100).toDF("k"), "k", 4)
        b = tables.distribute(spark.range(100).toDF("k").withColumn("v", F.lit(1)), "k", 4)
        plan = plan_of(a.join(b, "k").groupBy("k").agg(F.sum("v")))
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bucketed_a", "bucketed_b"):
            tables.write_bucketed(spark.range(100).toDF("k"), name, "k", 4, str(tmp_path / name))
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "k")
        assert "Exchange" not in plan_of(joined) and joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_stored_in_several_buckets_and_join_without_a_shuffle(spark, tmp_path):
    keys = [7] * 3_000 + [None] * 1_500 + list(range(100, 4_600))
    large = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, row long")
    names = [(None, "null"), (7, "hot"), (7, "hot too"), *[(k, f"n{k}") for k in range(100, 3_000)]]
    small = spark.createDataFrame(names, "k long, name string")
    pair = distribution.DistributedPair(spark, "hot_test", str(tmp_path), "k", 12)
    pair.write(large, small, ["row"], min_rows=60)
    assert sorted(map(str, pair.read_large().collect())) == sorted(map(str, large.collect()))
    assert sorted(map(str, pair.read_small().collect())) == sorted(map(str, small.collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("inner", "left", "left_semi", "left_anti"):
            joined = pair.join(how)
            assert "Exchange" not in plan_of(joined)
            got = sorted(map(str, joined.collect()))
            assert got == sorted(map(str, large.join(small, "k", how).collect()))
        tasks = spark.table(pair.large).join(spark.table(pair.small), ["k", "__salt"], "left_semi")
        rows = [r["n"] for r in tasks.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(rows) == 3_000 + 2_900
        assert max(rows) < 1_200
        with pytest.raises(ValueError, match="join type"):
            pair.join("full")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for table in (pair.large, pair.small):
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_typed_fills_defaults_and_enforces_not_null(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(1,), (None,)], "a int")
    got = tables.typed(df, schema, defaults={"a": F.lit(9)}).collect()
    assert [tuple(r) for r in got] == [(1, None), (9, None)]
    with pytest.raises(Exception, match="a is null"):
        tables.typed(df, schema, not_null=["a"]).collect()


def test_shared_dir_is_the_one_the_session_names(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured.rstrip("/")
    assert session.new_run_dir(spark, "x") != session.new_run_dir(spark, "x")


# ---- streams ----------------------------------------------------------------------

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("body", T.StringType()),
    ]
)


def add_file(spark, path, *rows):
    data = [(i, T0 + timedelta(minutes=m), b) for i, m, b in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_replicate_stream_delivers_only_new_files(spark, tmp_path):
    src, landing, ckpt = (str(tmp_path / n) for n in ("src", "landing", "ckpt"))
    add_file(spark, src, (1, 0, "a"), (2, 0, "b"))
    add_file(spark, src, (3, 1, "c"))

    def run():
        replicate_stream(file_stream(spark, src, SCHEMA, files_per_batch=1), landing, ckpt, SCHEMA.names).awaitTermination()
        return tables.read_landing(spark, landing, SCHEMA)

    assert run().count() == 3
    assert run().count() == 3
    add_file(spark, src, (1, 5, "A"))
    versions = run()
    assert versions.count() == 4
    assert sorted(r[0] for r in versions.select("batch_seq").distinct().collect()) == [0, 1, 2]
    latest = latest_per_key(versions, "id", "ts").orderBy("id").collect()
    assert [r["body"] for r in latest] == ["A", "b", "c"]
    # A replayed micro-batch replaces its directory.
    tables.append_landing(spark.createDataFrame([(1, T0, "A")], SCHEMA), landing, SCHEMA.names, 2)
    assert tables.read_landing(spark, landing, SCHEMA).count() == 4


def test_dedup_stream_keeps_the_first_copy_across_micro_batches(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    add_file(spark, src, (1, 0, "a"), (2, 1, "b"), (2, 1, "b"))
    add_file(spark, src, (1, 0, "a"), (3, 2, "c"))
    for _ in range(2):
        sdf = dedup_stream(file_stream(spark, src, SCHEMA, files_per_batch=1), "id", "ts", "1 hour")
        write_stream(sdf, out, ckpt).awaitTermination()
        got = sorted(r["id"] for r in spark.read.parquet(out).collect())
        assert got == ([1, 2, 3] if _ == 0 else [1, 2, 3, 4])
        add_file(spark, src, (3, 2, "c"), (4, 3, "d"))


def test_dedup_stream_with_one_event_in_many_copies(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    for part in range(3):
        add_file(spark, src, *[(7, 0, "hot")] * 50, *[(100 * part + i, 1, "x") for i in range(20)])
    stream = file_stream(spark, src, SCHEMA, files_per_batch=2, with_origin=True)
    once = dedup_stream(stream, "id", "ts", "1 hour", spread=ORIGIN, salts=4)
    assert once.columns == SCHEMA.names
    write_stream(once, out, ckpt).awaitTermination()
    got = sorted(r["id"] for r in spark.read.parquet(out).collect())
    assert got == sorted({7} | {100 * part + i for part in range(3) for i in range(20)})


def test_upsert_stream_never_goes_back(spark, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    table = tables.SnapshotTable(spark, str(tmp_path / "t"), SCHEMA, "id", buckets=2)
    add_file(spark, src, (1, 5, "new"), (2, 1, "x"), (2, 2, "y"))
    add_file(spark, src, (1, 4, "older"), (3, 1, "z"))
    for _ in range(2):
        upsert_stream(file_stream(spark, src, SCHEMA, files_per_batch=1), table, ckpt, "ts").awaitTermination()
        got = {r["id"]: r["body"] for r in table.read().collect()}
        assert got == {1: "new", 2: "y", 3: "z"}


def _merging_table(spark, path):
    base = tables.SnapshotTable(spark, str(path), SCHEMA, "id", buckets=2)
    return deltas.MergeOnReadTable(base, "ts", ["body"])


def _newest(rows):
    best = {}
    for r in rows:
        order = tuple((x is not None, x) for x in r[1:])
        if r[0] not in best or order > best[r[0]][0]:
            best[r[0]] = (order, r)
    return sorted((r for _, r in best.values()), key=str)


def test_merged_reads_are_the_newest_rows_in_any_order_of_batches_and_folds(spark, tmp_path):
    rnd = random.Random(3)
    day = datetime(2024, 1, 1)
    keys = [None, *range(12)]
    batches = [
        [
            (rnd.choice(keys), rnd.choice([None, *(day + timedelta(rnd.randrange(4)) for _ in "ab")]), rnd.choice([None, "a", "b"]))
            for _ in range(n)
        ]
        for n in (25, 0, 8, 8)
    ]
    for run, folds in enumerate(([], [0, 2], [1], [3, 3])):
        table = _merging_table(spark, tmp_path / str(run))
        assert table.read().count() == 0
        assert table.fold() == -1
        seen = []
        for seq, rows in enumerate(batches):
            batch = spark.createDataFrame(rows, SCHEMA)
            table.append(batch, seq)
            for _ in range(folds.count(seq)):
                table.fold()
            table.append(batch, seq)  # a replay
            seen += rows
            assert sorted(map(tuple, table.read().collect()), key=str) == _newest(seen)


def test_an_appended_batch_writes_itself_and_not_the_table(spark, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    table = _merging_table(spark, tmp_path / "t")

    def size(folder):
        return sum(f.stat().st_size for f in (tmp_path / "t" / folder).rglob("*.parquet"))

    def load(**options):
        stream = file_stream(spark, src, SCHEMA, files_per_batch=1)
        append_upserts_stream(stream, table, ckpt, **options).awaitTermination()

    add_file(spark, src, *[(i, 1, f"text {i * i}") for i in range(20_000)])
    load(fold_after=1)
    stored = size("data")
    assert stored > 50_000
    before = size("deltas")
    add_file(spark, src, (3, 2, "newer"), (4, 0, "older"), (-1, 0, "new"))
    load()
    assert size("data") == stored
    assert size("deltas") - before < 5_000
    got = {r["id"]: r["body"] for r in table.read().filter("id < 6").collect()}
    assert got == {-1: "new", 0: "text 0", 1: "text 1", 2: "text 4", 3: "newer", 4: "text 16", 5: "text 25"}
    assert table.read().count() == 20_001
    # The stored rows are not shuffled for a small batch.
    assert "SortMergeJoin" not in plan_of(table.read())
    assert table.fold() == 1
    assert table.waiting().count() == 0
    assert table.read().count() == 20_001


@pytest.mark.parametrize(
    "name", ["stream_replicate", "stream_dedup", "stream_upsert", "stream_upsert_merged"]
)
def test_streams_read_tables_of_part_files(spark, tmp_path, name):
    """The same rows from one file and from a folder of part files."""
    from tidemark.workload.fixtures import TABLES
    from tidemark.workload.queries import QUERIES

    single = "/root/testdata/sf0.001"
    for table in TABLES:
        if table != "events":
            (tmp_path / f"{table}.parquet").symlink_to(f"{single}/{table}.parquet")
    events = spark.read.parquet(f"{single}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    want = sorted(map(str, QUERIES[name](spark, single).collect()))
    assert sorted(map(str, QUERIES[name](spark, str(tmp_path)).collect())) == want
    assert want


def test_late_events_are_kept_apart(spark, tmp_path):
    """Batch by batch against a plain loop: every different event once, late ones in their folder."""
    schema = "event_id long, ts timestamp, v string"
    start = datetime(2024, 1, 1)

    def at(minutes):
        return None if minutes is None else start + timedelta(minutes=minutes)

    batches = [
        [(1, 0, "a"), (2, 60, "b"), (2, 60, "b"), (None, 5, "n"), (None, 5, "n")],
        [(1, 0, "a"), (2, 60, "b"), (3, 50, "c"), (4, 49, "d"), (5, None, "e"), (6, 300, "f")],
        [(4, 49, "d"), (5, None, "e"), (7, 289, "g"), (8, 290, "h"), (3, 50, "c"), (None, 1, "n")],
        [(6, 300, "f")],
        [(9, 10_000, "i"), (10, 295, "j"), (1, 0, "a")],
    ]
    seen, want, newest = set(), {"out": [], "late": []}, None
    folders = {name: str(tmp_path / name) for name in ("in", "out", "late", "checkpoint")}
    for number, rows in enumerate(batches):
        rows = [(k, at(m), v) for k, m, v in rows]
        spark.createDataFrame(rows, schema).write.parquet(f"{folders['in']}/batch={number}")
        for k, t, v in rows:
            if k is None or (k, t) not in seen:
                seen.add((k, t))
                punctual = t is not None and (newest is None or t >= newest - timedelta(minutes=10))
                want["out" if punctual else "late"].append((k, t, v))
        newest = max([t for _, t, _ in rows if t] + ([newest] if newest else []))
        stream = file_stream(spark, folders["in"], spark.createDataFrame([], schema).schema)
        dedup_stream_with_late(
            stream.select("event_id", "ts", "v"), "event_id", "ts", "10 MINUTES",
            folders["out"], folders["late"], folders["checkpoint"],
        ).awaitTermination()
        for name in ("out", "late"):
            got = spark.read.parquet(folders[name]).select("event_id", "ts", "v").collect()
            assert sorted(map(str, map(tuple, got))) == sorted(map(str, want[name])), (number, name)
    assert len(want["late"]) > 3


def test_ties_in_a_batch_do_not_follow_the_input_order(spark, tmp_path):
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("v", T.IntegerType()), T.StructField("s", T.StringType())]
    )
    rows = [(i, 1, f"{i}-{twin}") for i in range(50) for twin in range(3)]
    answers = []
    for name, order in (("a", rows), ("b", rows[::-1])):
        path = str(tmp_path / name)
        tables.append_landing(spark.createDataFrame(order, schema), path, ["id", "v", "s"], 1)
        landed = tables.read_landing(spark, path, schema)
        wide = sorted(map(tuple, latest_per_key(landed, "id", "v").select("id", "s").collect()))
        tables.compact_landing_in_place(spark, path, schema, "id", "v")
        folded = tables.read_landing(spark, path, schema)
        assert sorted(map(tuple, folded.select("id", "s").collect())) == wide
        answers.append(wide)
    assert answers[0] == answers[1]
    assert len(answers[0]) == 50


def test_landing_without_row_hashes_is_still_read(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.IntegerType())])
    spark.createDataFrame([(1, 1), (1, 2)], schema).write.parquet(str(tmp_path / "batch_seq=1"))
    tables.append_landing(spark.createDataFrame([(1, 2), (2, 1)], schema), str(tmp_path), ["id", "v"], 2)
    landed = tables.read_landing(spark, str(tmp_path), schema)
    assert sorted(map(tuple, latest_per_key(landed, "id", "v").select("id", "v", "batch_seq").collect())) == [
        (1, 2, 2),
        (2, 1, 2),
    ]
