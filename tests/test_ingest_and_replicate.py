import gzip
import json
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.operators.changes import (
    affected_keys,
    apply_changes,
    only_keys,
    refresh_mart,
    replaced_by,
)
from tidemark.operators.latest import final
from tidemark.operators.quality import CheckFailed, fail_if_any
from tidemark.operators.state import EPOCH, get_watermark, open_state, set_watermark
from tidemark.operators.tables import SnapshotTable, read_landing
from tidemark.plans.elt import run_elt
from tidemark.plans.ingest import ingest, ingest_entity, oltp_table
from tidemark.plans.marts import mart_comment_statistics, mart_user_post_summary
from tidemark.plans.refresh import (
    authors_touched_by,
    posts_touched_by,
    refresh_comment_statistics,
    refresh_user_post_summary,
)
from tidemark.plans.replicate import replicate
from tidemark.plans.transforms import ENTITIES, select_entities
from tidemark.plans.validate import register_views, validation
from tidemark.schemas import OLTP
from tidemark.sources.json_entities import PayloadError, read_json_entities
from tidemark.sources.tables import Sources, newer_than, read_incremental
from tidemark.workload.queries import RECORDS_PER_FILE, _write_arrays

UTC = timezone.utc
T0 = datetime(2024, 1, 1, tzinfo=UTC)


def write_json(path, payload, name="page-0.json"):
    path.mkdir(exist_ok=True)
    (path / name).write_text(json.dumps(payload))
    return str(path)


def user(i, **over):
    record = {
        "id": i,
        "name": f"N{i}",
        "username": f"u{i}",
        "email": f" U{i}@X.io\n",
        "phone": "1",
        "website": "w",
        "extra": {"dropped": True},
        "company": {"name": "Co", "bs": "x"},
        "address": {"city": "C", "zipcode": "Z", "geo": {"lat": "-37.3159", "lng": "81.1496"}},
    }
    record.update(over)
    return record


# ---- ingest -----------------------------------------------------------------------


def test_flatten_with_nested_nulls(spark, tmp_path):
    payload = [
        user(1),
        user(2, address=None, company=None, email="  "),
        user("3", address={"city": "C", "geo": {"lat": "", "lng": None}}),
        {"id": 4},
    ]
    path = write_json(tmp_path / "users", payload)
    rows = ENTITIES["users"].transform(read_json_entities(spark, path, "users"), T0)
    got = {r["id"]: r for r in rows.collect()}
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in OLTP["users"]]
    assert got[1]["email"] == "u1@x.io" and got[1]["company_name"] == "Co"
    assert (got[1]["lat"], got[1]["lng"]) == (Decimal("-37.315900"), Decimal("81.149600"))
    assert [got[2][c] for c in ("email", "company_name", "city", "lat")] == [None] * 4
    assert [got[3][c] for c in ("zipcode", "lat", "lng")] == [None] * 3
    assert got[4]["name"] is None and set(got) == {1, 2, 3, 4}


@pytest.mark.parametrize("entity, record", [
    ("users", {"id": "abc"}),
    ("users", {"name": "no id"}),
    ("posts", {"id": 1, "title": "no author"}),
    ("comments", {"id": 1, "postId": "x"}),
])
def test_bad_keys_fail_the_entity(spark, tmp_path, entity, record):
    path = write_json(tmp_path / entity, [record])
    with pytest.raises(PySparkException):
        ENTITIES[entity].transform(read_json_entities(spark, path, entity), T0).collect()


def test_bare_object_is_rejected(spark, tmp_path):
    path = write_json(tmp_path / "users", [user(1)])
    write_json(tmp_path / "users", {"error": "rate limit"}, "page-1.json")
    with pytest.raises(PayloadError, match="1 payloads"):
        read_json_entities(spark, path, "users")


def test_malformed_json_fails(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text('[{"id": 1, ')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_json_entities(spark, str(tmp_path / "p"), "posts").collect()


def test_json_lines(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "a.json").write_text('{"id":1,"userId":2}\n{"id":2,"userId":2}\n')
    rows = read_json_entities(spark, str(tmp_path / "p"), "posts", lines=True)
    assert rows.count() == 2


def test_ingest_twice_replaces(spark, tmp_path):
    path = write_json(tmp_path / "posts", [{"id": i, "userId": 1, "title": "t", "body": "b"} for i in range(5)])
    table = oltp_table(spark, str(tmp_path / "root"), ENTITIES["posts"], buckets=2)
    assert ingest_entity(spark, ENTITIES["posts"], path, table, T0) == 5
    assert ingest_entity(spark, ENTITIES["posts"], path, table, T0 + timedelta(hours=1)) == 5
    stamps = {r[0] for r in table.read().select(F.unix_seconds("ingested_at")).collect()}
    assert table.read().count() == 5 and stamps == {int(T0.timestamp()) + 3600}
    ingest_entity(spark, ENTITIES["posts"], path, table, T0 + timedelta(hours=2), touch_unchanged=False)
    assert {r[0] for r in table.read().select(F.unix_seconds("ingested_at")).collect()} == stamps


def test_registry(spark, tmp_path):
    assert [s.name for s in select_entities()] == ["users", "posts", "comments"]
    assert [s.name for s in select_entities("posts")] == ["posts"]
    with pytest.raises(ValueError):
        select_entities("albums")
    path = write_json(tmp_path / "users", [user(1), user(2)])
    assert ingest(spark, {"users": path}, str(tmp_path / "r"), T0, "users") == {"users": 2}
    with pytest.raises(KeyError):
        Sources(spark, {"a": "/nowhere"})("b")


# ---- watermark and replication ----------------------------------------------------


def posts_at(spark, *rows):
    # Stamps as seconds after T0, independent of the Python time zone.
    df = spark.createDataFrame([(i, 1, f"t{i}", b, s) for i, b, s in rows], "id long, user_id long, title string, body string, s long")
    return df.withColumn("ingested_at", F.timestamp_seconds(F.lit(int(T0.timestamp())) + F.col("s"))).drop("s")


def test_strict_watermark_and_overlap(spark):
    df = posts_at(spark, (1, "a", 0), (2, "b", 10), (3, "c", 11))
    at = T0 + timedelta(seconds=10)
    assert [r["id"] for r in newer_than(df, "ingested_at", at).collect()] == [3]
    late = newer_than(df, "ingested_at", at, overlap=timedelta(seconds=1)).collect()
    assert [r["id"] for r in late] == [2, 3]
    rows = read_incremental(df, ["id"], EPOCH)
    assert rows.columns == ["id"] and rows.count() == 3


def test_watermark_filter_reaches_the_reader(spark, tmp_path):
    posts_at(spark, (1, "a", 0)).write.parquet(str(tmp_path / "p"))
    read = read_incremental(spark.read.parquet(str(tmp_path / "p")), ["id"], T0)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ingested_at," in plan and "body" not in plan


def test_state_table(spark, tmp_path):
    state = open_state(spark, str(tmp_path / "s"), ["users", "posts"])
    assert get_watermark(state.read(), "users") == EPOCH
    assert get_watermark(state.read(), "unknown") == EPOCH
    at = datetime(2024, 5, 1, 12, 0, 0, 123456, tzinfo=UTC)
    set_watermark(state, "users", at)
    again = open_state(spark, str(tmp_path / "s"), ["users", "posts", "comments"])
    assert get_watermark(again.read(), "users") == at
    assert again.read().count() == 3


def test_replicate_is_incremental_and_repeatable(spark, tmp_path):
    spec, landing = ENTITIES["posts"], str(tmp_path / "landing")
    state = open_state(spark, str(tmp_path / "s"), ["posts"])
    first = replicate(posts_at(spark, (1, "a", 0), (2, "b", 5)), landing, state, spec, batch_seq=1)
    assert first.rows == 2 and first.watermark == T0 + timedelta(seconds=5)
    fail_if_any(first.check)

    changed = posts_at(spark, (1, "A", 9), (2, "b", 5), (3, "c", 8))
    second = replicate(changed, landing, state, spec, batch_seq=2)
    assert second.rows == 2 and second.watermark == T0 + timedelta(seconds=9)
    fail_if_any(second.check)
    nothing = replicate(changed, landing, state, spec, batch_seq=3)
    assert nothing.rows == 0 and nothing.watermark == second.watermark

    versions = read_landing(spark, landing, spec.landing)
    assert versions.count() == 4
    bodies = {r["id"]: r["body"] for r in final(versions, "id", "ingested_at").collect()}
    assert bodies == {1: "A", 2: "b", 3: "c"}

    # A run that died before the watermark moved is repeated: same rows, no harm.
    set_watermark(state, "posts", T0 + timedelta(seconds=5))
    repeated = replicate(changed, landing, state, spec, batch_seq=2)
    assert repeated.rows == 2 and read_landing(spark, landing, spec.landing).count() == 4
    other = replicate(changed, landing, state, spec, batch_seq=4, overlap=timedelta(days=1))
    assert other.rows == 3 and other.watermark == second.watermark
    assert final(read_landing(spark, landing, spec.landing), "id", "ingested_at").count() == 3


def test_late_row_is_missed_without_overlap_and_deletes_do_not_travel(spark, tmp_path):
    spec, landing = ENTITIES["posts"], str(tmp_path / "landing")
    state = open_state(spark, str(tmp_path / "s"), ["posts"])
    replicate(posts_at(spark, (1, "a", 10)), landing, state, spec, batch_seq=1)
    late = replicate(posts_at(spark, (1, "a", 10), (2, "late", 9)), landing, state, spec, batch_seq=2)
    assert late.rows == 0
    with pytest.raises(CheckFailed):
        fail_if_any(late.check)
    caught = replicate(
        posts_at(spark, (1, "a", 10), (2, "late", 9)), landing, state, spec, batch_seq=3, overlap=timedelta(seconds=5)
    )
    fail_if_any(caught.check)
    deleted = replicate(posts_at(spark, (2, "late", 20)), landing, state, spec, batch_seq=4)
    assert deleted.check.first()["status"] == "FAIL"
    assert deleted.watermark == T0 + timedelta(seconds=20)  # advanced before the check


# ---- changes ----------------------------------------------------------------------


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, body string")
    log = spark.createDataFrame(
        [(1, 1, "U", "A"), (2, 2, "U", "x"), (2, 3, "D", None), (4, 4, "I", "d"), (5, 5, "I", "e"), (5, 6, "D", None), (3, 7, "D", None), (3, 8, "I", "c2")],
        "id long, seq long, op string, body string",
    )
    once = apply_changes(target, log, "id", "seq")
    want = [(1, "A"), (3, "c2"), (4, "d")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, apply_changes(once, log, "id", "seq").collect())) == want


def test_refresh_mart_when_a_comment_moves(spark):
    def mart(comments):
        return comments.groupBy("post_id").agg(F.count(F.lit(1)).alias("n"))

    schema = "comment_id long, post_id long"
    old = spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, 30)], schema)
    delta = spark.createDataFrame([(2, 40), (3, 10)], schema)
    new = spark.createDataFrame([(1, 10), (2, 40), (3, 10), (4, 30)], schema)
    keys = affected_keys("post_id", delta, replaced_by(old, delta, "comment_id"))
    assert sorted(r[0] for r in keys.collect()) == [10, 20, 40]
    got = refresh_mart(mart(old), keys, "post_id", lambda k: mart(only_keys(new, k, "post_id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, mart(new).collect()))


def test_refresh_both_marts_when_comments_and_posts_move(spark):
    users = spark.createDataFrame(
        [(u, f"u{u}", "", "", "", "") for u in range(5)],
        "user_id long, username string, full_name string, email string, company_name string, city string",
    )
    post_schema = "post_id long, user_id long, title string, title_length long, body_length long"
    old_posts = spark.createDataFrame([(p, p % 4, "t", 1, p) for p in range(8)], post_schema)
    delta_posts = spark.createDataFrame([(1, 4, "t", 1, 100), (9, 0, "t", 1, 1)], post_schema)
    posts = spark.createDataFrame(
        [(p, p % 4, "t", 1, p) for p in range(8) if p != 1] + [(1, 4, "t", 1, 100), (9, 0, "t", 1, 1)], post_schema
    )
    schema = "comment_id long, post_id long, commenter_email string, body_length long"
    old = [(c, c % 8, f"e{c % 3}", c) for c in range(30)]
    moved = [(3, 9, "new", 7), (50, 6, "e0", 1)]
    old_comments = spark.createDataFrame(old, schema)
    delta = spark.createDataFrame(moved, schema)
    comments = spark.createDataFrame([r for r in old if r[0] != 3] + moved, schema)
    now = datetime(2024, 1, 1)

    touched = posts_touched_by(delta, old_comments, delta_posts)
    assert sorted(r[0] for r in touched.collect()) == [1, 3, 6, 9]
    authors = authors_touched_by(touched, posts, old_posts)
    assert sorted(r[0] for r in authors.collect()) == [0, 1, 2, 3, 4]

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    got = refresh_comment_statistics(
        mart_comment_statistics(old_posts, old_comments, users, now), touched, posts, comments, users, now
    )
    assert rows(got) == rows(mart_comment_statistics(posts, comments, users, now))
    got = refresh_user_post_summary(
        mart_user_post_summary(users, old_posts, old_comments, now), authors, users, posts, comments, now
    )
    assert rows(got) == rows(mart_user_post_summary(users, posts, comments, now))


# ---- the whole run ----------------------------------------------------------------


def payloads(tmp_path, users=10, posts=100, comments=500, **bad_comment):
    write_json(tmp_path / "users", [user(i + 1) for i in range(users)])
    write_json(tmp_path / "posts", [
        {"id": i + 1, "userId": i % users + 1, "title": f"t{i}", "body": "é" * (i % 7)} for i in range(posts)
    ])
    write_json(tmp_path / "comments", [
        {"id": i + 1, "postId": i % posts + 1, "name": "n", "email": f"E{i % 50}@x.io ", "body": "b\n", **bad_comment}
        for i in range(comments)
    ])
    return {e: str(tmp_path / e) for e in ENTITIES}


def test_run_elt_twice(spark, tmp_path):
    paths, root = payloads(tmp_path), str(tmp_path / "root")
    for hour in (0, 1):
        report = run_elt(spark, paths, root, T0 + timedelta(hours=hour), buckets=2)
        assert report.ingested == report.replicated == {"users": 10, "posts": 100, "comments": 500}
        counts = {name: df.count() for name, df in report.models.items()}
        assert counts == {
            "stg_users": 10,
            "stg_posts": 100,
            "stg_comments": 500,
            "mart_user_post_summary": 10,
            "mart_comment_statistics": 100,
        }
        suite = report.suite.collect()
        assert len(suite) == 20 and all(r["status"] == "PASS" for r in suite)
    totals = report.models["mart_user_post_summary"].agg(
        F.sum("total_posts"), F.sum("total_comments_received")
    )
    assert tuple(totals.first()) == (100, 500)


def test_validation_views_and_command_line(spark, tmp_path):
    payloads(tmp_path, 2, 4, 8)
    root = str(tmp_path / "root")
    common = ["--root", root, "--payloads", str(tmp_path)]
    for entity in ENTITIES:
        main(["ingest", *common, "--entity", entity])
    for step in ("replicate", "build", "test", "validate"):
        main([step, *common])
    report = validation(spark, root)
    counts = {(r["layer"], r["table_name"]): r["rows"] for r in report["counts"].collect()}
    assert len(counts) == 11
    assert counts["oltp", "comments"] == counts["landing", "comments"] == counts["staging", "stg_comments"] == 8
    assert counts["marts", "mart_user_post_summary"] == 2
    assert [r["table_name"] for r in report["watermarks"].collect()] == ["comments", "posts", "users"]
    assert report["top_posts"].count() == 4
    register_views(spark, root)
    total = spark.sql(
        "SELECT count(*) FROM raw_comments c JOIN stg_posts p ON c.post_id = p.post_id "
        "JOIN mart_user_post_summary m ON p.user_id = m.user_id"
    )
    assert total.first()[0] == 8
    with pytest.raises(SystemExit):
        main(["ingest", "--root", root])


@pytest.mark.parametrize("incremental", [False, True])
def test_run_elt_sweeps_up(spark, tmp_path, incremental):
    """One copy of the rows per layer stays behind, and runs go on from there."""
    paths, marts = payloads(tmp_path), {}
    for sweep in (False, True):
        root = tmp_path / f"root-{sweep}"
        for hour in (0, 1, 2):
            report = run_elt(
                spark, paths, str(root), T0 + timedelta(hours=hour), buckets=2,
                incremental=incremental, compact_after=2, sweep=sweep,
            )
        names = [n for n in report.models if n.startswith("mart")]
        marts[sweep] = [sorted(map(tuple, report.models[n].collect()), key=repr) for n in names]
        assert all(r["status"] == "PASS" for r in report.reconciliation.collect())
    assert marts[True] == marts[False]
    for entity, n in {"users": 10, "posts": 100, "comments": 500}.items():
        table = oltp_table(spark, str(root), ENTITIES[entity])
        assert table.read().count() == n and table.version() == 3
        assert not [f for part in ("incoming", "feed") for f in (root / "raw" / entity / part).iterdir()]
        stored = list((root / "raw" / entity / "data").rglob("*.parquet"))
        assert spark.read.parquet(*map(str, stored)).count() == n
        # The fold after the second run, and the batch of the third.
        landed = [f for f in (root / "landing" / entity).rglob("*.parquet") if "_live" not in str(f)]
        assert spark.read.parquet(*map(str, landed)).count() == 2 * n


def test_run_elt_skips_unchanged_rows(spark, tmp_path):
    paths, root = payloads(tmp_path, 2, 4, 8), str(tmp_path / "root")
    run_elt(spark, paths, root, T0)
    report = run_elt(
        spark, paths, root, T0 + timedelta(hours=1), touch_unchanged=False, materialise_staging=False
    )
    assert report.replicated == {"users": 0, "posts": 0, "comments": 0}
    assert report.models["stg_comments"].count() == 8


def test_run_elt_stops_on_a_failed_test(spark, tmp_path):
    paths = payloads(tmp_path, 2, 4, 8, postId=99)
    with pytest.raises(CheckFailed, match="relationships_stg_comments"):
        run_elt(spark, paths, str(tmp_path / "root"), T0)


def test_run_elt_stops_on_bad_input(spark, tmp_path):
    paths, root = payloads(tmp_path, 2, 4, 8), tmp_path / "root"
    write_json(tmp_path / "posts", {"error": 1}, "page-9.json")
    with pytest.raises(PayloadError):
        run_elt(spark, paths, str(root), T0)
    assert not SnapshotTable(spark, f"{root}/marts/mart_user_post_summary", OLTP["users"]).exists()


def test_response_files_follow_the_records_not_their_keys(spark, tmp_path):
    """A thousand records whose keys lie a thousand apart are two files, not a thousand folders."""
    records = spark.range(1000).select((F.col("id") * 1000).alias("id"), F.lit("t").alias("body"))
    path = str(tmp_path / "arrays")
    _write_arrays(records, path)
    files = [p for p in (tmp_path / "arrays").rglob("*") if p.is_file() and p.name.startswith("part-")]
    assert len([p for p in files if p.stat().st_size]) == 1000 // RECORDS_PER_FILE
    assert not [p for p in (tmp_path / "arrays").iterdir() if p.is_dir()]
    read = read_json_entities(spark, path, records.schema)
    assert sorted(r["id"] for r in read.collect()) == [i * 1000 for i in range(1000)]
    # No record, no array; reading finds nothing either.
    _write_arrays(records.limit(0), f"{path}-none")
    assert read_json_entities(spark, f"{path}-none", records.schema).count() == 0


def test_compressed_response_files(spark, tmp_path):
    """They take a fraction of the text; one that holds nothing is like an empty file."""
    records = spark.range(1000).select("id", F.repeat(F.lit("text "), 200).alias("body"))
    _write_arrays(records, str(tmp_path / "arrays"))
    files = list((tmp_path / "arrays").glob("part-*"))
    assert files and all(f.suffix == ".gz" for f in files)
    assert sum(f.stat().st_size for f in files) < 100_000
    assert read_json_entities(spark, str(tmp_path / "arrays"), records.schema).count() == 1000
    (tmp_path / "arrays" / "none.txt.gz").write_bytes(gzip.compress(b""))
    assert read_json_entities(spark, str(tmp_path / "arrays"), records.schema).count() == 1000
    (tmp_path / "arrays" / "bad.txt.gz").write_bytes(gzip.compress(b'{"error": 1}'))
    with pytest.raises(PayloadError, match="1 payloads"):
        read_json_entities(spark, str(tmp_path / "arrays"), records.schema)
