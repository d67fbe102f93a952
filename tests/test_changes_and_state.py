"""Late changes, change feeds, releases, landing compaction, and marts kept by signed sums."""

import random
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import tables as tables_module
from tidemark.operators.changes import ChangeTable, apply_changes
from tidemark.operators.skew import HotKeys
from tidemark.operators.tables import (
    Release,
    SnapshotTable,
    append_landing,
    compact_landing_in_place,
    read_landing,
    sweep_landing,
)
from tidemark.operators.upsert import SIGN, merge_partitioned
from tidemark.plans.mart_state import MartState, comment_metrics_from, signed
from tidemark.plans.marts import mart_comment_statistics, mart_user_post_summary
from tidemark.session import SHUFFLE_CLEANUP_CONF, at_once, materialise, short_lived_shuffles

NOW = datetime(2024, 1, 1)


def struct(**fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PAIR = struct(id=T.LongType(), v=T.StringType())
LOG = "id long, v string, seq long, op string"
SEQ = T.StructField("seq", T.LongType())


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- changes out of order ---------------------------------------------------------


def change_table(spark, path, buckets=None):
    table = ChangeTable(spark, str(path), PAIR, "id", SEQ, buckets=buckets, feed=True)
    table.seed(spark.createDataFrame([(9, "seed"), (1, "seed")], PAIR))
    return table


@pytest.mark.parametrize("buckets", [None, 3])
def test_any_split_and_order_of_a_log_gives_one_table(spark, tmp_path, buckets):
    rnd = random.Random(3)
    log = [
        (rnd.choice([1, 2, 3, 4, None]), f"v{i}", rnd.choice([None, *range(12)]), rnd.choice("UUD"))
        for i in range(60)
    ]
    whole = change_table(spark, tmp_path / "whole", buckets)
    whole.apply(spark.createDataFrame(log, LOG))
    want = rows(whole.read())
    rnd.shuffle(log)
    pieces = change_table(spark, tmp_path / "pieces", buckets)
    for piece in (log[:7], log[20:], log[7:20], log[:30]):
        pieces.apply(spark.createDataFrame(piece, LOG))
    assert rows(pieces.read()) == want
    # The feed, added up, leads from the seed to the same rows.
    net = pieces.changes(after=1).groupBy("id", "v").agg(F.sum(SIGN).alias("n")).filter("n <> 0")
    state = {(9, "seed"): 1, (1, "seed"): 1}
    for i, v, n in net.collect():
        state[i, v] = state.get((i, v), 0) + n
    assert sorted((k for k, n in state.items() if n), key=repr) == want
    assert all(n in (0, 1) for n in state.values())


def test_late_changes_neither_win_nor_revive(spark, tmp_path):
    table = change_table(spark, tmp_path)
    table.apply(spark.createDataFrame([(1, "new", 10, "U"), (2, "x", 11, "D")], LOG))
    table.apply(spark.createDataFrame([(1, "old", 5, "U"), (2, "old", 10, "U")], LOG))
    assert rows(table.read()) == [(1, "new"), (9, "seed")]
    # Deleted and inserted anew by a later change.
    table.apply(spark.createDataFrame([(2, "back", 12, "U")], LOG))
    assert rows(table.read()) == [(1, "new"), (2, "back"), (9, "seed")]


def test_expired_tombstones_and_changes_before_the_horizon(spark, tmp_path):
    table = change_table(spark, tmp_path, 2)
    table.apply(spark.createDataFrame([(1, "a", 5, "D"), (2, "b", 20, "D"), (3, "c", 6, "U")], LOG))
    before = table.table.version()
    horizon = lambda n: spark.createDataFrame([(n,)], "seq long")
    table.expire(horizon(10))
    kept = table.table.read().filter("__deleted").select("id").collect()
    assert [r[0] for r in kept] == [2]
    table.expire(horizon(8))  # the horizon does not go back
    done = table.apply(
        spark.createDataFrame([(1, "late", 9, "U"), (2, "late", 15, "U"), (4, "d", 10, "U")], LOG)
    )
    assert done.rows == 2 and [r["id"] for r in done.refused.collect()] == [1]
    assert rows(table.read()) == [(3, "c"), (4, "d"), (9, "seed")]
    images = table.changes(after=before).select("id", "v", SIGN)
    assert rows(images) == [(4, "d", 1)]


def test_apply_changes_treats_a_null_key_as_one_key(spark):
    target = spark.createDataFrame([(None, "seed"), (1, "seed"), (2, "seed")], PAIR)
    log = spark.createDataFrame([(None, "x", 1, "U"), (None, "y", 2, "U"), (2, "", 3, "D")], LOG)
    want = [(1, "seed"), (None, "y")]
    assert rows(apply_changes(target, log, "id", "seq")) == want
    assert rows(apply_changes(apply_changes(target, log, "id", "seq"), log, "id", "seq")) == want
    plan = apply_changes(target, log, "id", "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


# ---- feeds and releases -----------------------------------------------------------


def test_an_upsert_of_distinct_keys_is_shuffled_once(spark, tmp_path, monkeypatch):
    """Rows go to their bucket only; a batch that repeats a key is settled first, as before."""
    told = []

    def noted(*args, unique, **options):
        merged = merge_partitioned(*args, unique=unique, **options)
        plan = merged._jdf.queryExecution().optimizedPlan().toString()
        told.append((unique, plan.count("row_number()")))
        return merged

    monkeypatch.setattr("tidemark.operators.tables.merge_partitioned", noted)
    table = SnapshotTable(spark, str(tmp_path), PAIR, "id", 3)
    table.upsert(spark.createDataFrame([(i, "a") for i in range(9)] + [(None, "n")], PAIR), feed=True)
    table.upsert(spark.createDataFrame([(1, "b"), (1, "b"), (20, "c")], PAIR), feed=True)
    table.upsert(spark.createDataFrame([(None, "x"), (None, "x")], PAIR), feed=True)
    assert [unique for unique, _ in told] == [True, False, False]
    assert told[0][1] < told[1][1]
    assert table.read().count() == 11 and rows(table.read().filter("id is null")) == [(None, "x")]
    assert rows(table.changes(after=1).filter("id = 1")) == [(1, "a", -1, 2), (1, "b", 1, 2)]


def test_a_text_that_stays_is_stored_once(spark, tmp_path):
    """The feed holds whole images, whatever the stored rows leave out of theirs."""
    schema = "id long, title string, body string, n long"
    kind = spark.createDataFrame([], schema).schema
    table = SnapshotTable(spark, str(tmp_path), kind, "id", 2)
    old = [(1, "t", "long", 1), (2, None, "long", 2), (3, "t", None, 3), (4, "t", "long", 4)]
    new = [(1, "u", "long", 1), (2, "t", "long", None), (3, None, None, 3), (4, "t", "long", 4)]
    table.upsert(spark.createDataFrame(old, schema), feed=True)
    table.upsert(spark.createDataFrame(new, schema), feed=True)
    changed = [(*r, sign, 2) for r, sign in [(o, -1) for o in old[:3]] + [(n, 1) for n in new[:3]]]
    assert rows(table.changes(after=1)) == sorted(changed, key=repr)
    live = list(table._live()[1].values())
    stored = spark.read.parquet(*live).filter("__before is not null").select("id", "__before.body")
    assert rows(stored) == [(1, None), (2, None), (3, None)]


def test_stored_rows_are_written_small(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), PAIR, "id", 2)
    table.upsert(spark.createDataFrame([(1, "a"), (2, "b")], PAIR), feed=True)
    for part in ("data", "incoming", "feed"):
        files = [f.name for f in (tmp_path / "t" / part).rglob("*.parquet")]
        assert files and all(".zstd." in f for f in files)


def test_a_feed_stores_a_row_once_with_both_images(spark, tmp_path):
    schema = "id long, title string, body string"
    table = SnapshotTable(spark, str(tmp_path), spark.createDataFrame([], schema).schema, "id", 2)
    for title in ("t", "u"):
        table.upsert(spark.createDataFrame([(i, title, "long") for i in range(5)], schema), feed=True)
    stored = spark.read.parquet(str(tmp_path / "feed" / "__version=2"))
    assert rows(stored.select("title", "body", "__before.title", "__before.body")) == [("u", "long", "t", None)] * 5
    assert rows(table.changes(after=1).filter("id = 3")) == [(3, "t", "long", -1, 2), (3, "u", "long", 1, 2)]
    positive = table.changes(after=1).filter(F.col(SIGN) > 0)
    plan = positive._jdf.queryExecution().executedPlan().toString()
    assert "__before" not in plan.replace("isnotnull(__before", "")  # images before are not read


def test_feeds_of_one_image_a_row_are_still_read(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), PAIR, "id", 2)
    for v in ("a", "b"):
        table.upsert(spark.createDataFrame([(1, v), (2, "same")], PAIR), feed=True)
    want = rows(table.changes())
    earlier = spark.createDataFrame([(1, "b", 1), (1, "a", -1)], "id long, v string, __sign int")
    earlier.write.mode("overwrite").parquet(str(tmp_path / "feed" / "__version=2"))
    assert rows(table.changes()) == want and len(want) == 4


@pytest.mark.parametrize("most", [1, 8])
def test_large_rewrites_in_passes_give_the_same_table(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(tables_module, "PASS_BYTES", 1)
    monkeypatch.setattr(tables_module, "MOST_PASSES", most)
    table = SnapshotTable(spark, str(tmp_path / "t"), PAIR, "id", 16)
    written, real = [], table._write_buckets
    monkeypatch.setattr(table, "_write_buckets", lambda *a: (written.append(a), real(*a)))
    table.upsert(spark.createDataFrame([(None, "n"), *((i, "a") for i in range(200))], PAIR), feed=True)
    assert len(written) == (1 if most == 1 else 4)  # four cores, sixteen buckets
    batch = [(None, "m"), *((i, "b") for i in range(100, 300)), (250, "b"), (150, "b")]
    assert table.upsert(spark.createDataFrame(batch, PAIR), feed=True, keep_staged=False) == 203
    now = {None: "m"} | {i: "a" if i < 100 else "b" for i in range(300)}
    assert rows(table.read()) == sorted(now.items(), key=repr)
    changed = rows(table.changes(after=1).select("id", "v", SIGN))
    before = [(None, "n", -1), *((i, "a", -1) for i in range(100, 200))]
    assert changed == sorted(before + [(i, v, 1) for i, v in now.items() if v != "a"], key=repr)
    with pytest.raises(ValueError, match="2 keys occur more than once in the batch, first 150"):
        table.upsert(spark.createDataFrame(batch, PAIR), feed=True, on_duplicate="error")
    assert table.version() == 2
    # One row of one bucket is one pass over that bucket.
    written.clear()
    table.upsert(spark.createDataFrame([(7, "z")], PAIR))
    assert len(written) == 1 and rows(table.read().filter("id in (7, 8)")) == [(7, "z"), (8, "a")]


@pytest.mark.parametrize("key", ["long", "string"])
def test_compaction_in_passes(spark, tmp_path, monkeypatch, key):
    monkeypatch.setattr(tables_module, "PASS_BYTES", 1)
    schema = spark.createDataFrame([], f"id {key}, v string, at timestamp").schema
    path, kind = str(tmp_path), (int if key == "long" else str)
    for seq in (1, 2):
        some = [(kind(i), f"v{seq}", NOW) for i in range(100 * seq)] + [(None, f"n{seq}", NOW)] * 2
        append_landing(spark.createDataFrame(some, schema), path, ["id", "v", "at"], seq)
    assert compact_landing_in_place(spark, path, schema, "id", "at") == 2
    sweep_landing(spark, path)
    assert not list(tmp_path.glob("batch_seq=*"))
    want = sorted([(kind(i), "v2") for i in range(200)] + [(None, "n2")], key=repr)
    assert rows(read_landing(spark, path, schema).select("id", "v")) == want
    if key == "long":  # files cover ranges of the key that do not meet
        per_file = read_landing(spark, path, schema).groupBy(F.input_file_name()).agg(F.min("id"), F.max("id"))
        ranges = sorted(r[1:] for r in per_file.collect())
        assert len(ranges) > 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    # Later batches are appended, folded and swept as before.
    append_landing(spark.createDataFrame([(kind(5), "v3", NOW)], schema), path, ["id", "v", "at"], 3)
    assert compact_landing_in_place(spark, path, schema, "id", "at") == 3
    sweep_landing(spark, path)
    assert len(list((tmp_path / "_compacted").iterdir())) == 1
    assert rows(read_landing(spark, path, schema).filter("id = '5'").select("v")) == [("v3",)]


@pytest.mark.parametrize("buckets", [None, 4])
def test_sweep_keeps_the_current_version(spark, tmp_path, buckets):
    table = SnapshotTable(spark, str(tmp_path), PAIR, "id", buckets)
    table.upsert(spark.createDataFrame([(i, "a") for i in range(20)], PAIR), feed=True)
    table.upsert(spark.createDataFrame([(3, "b")], PAIR), feed=True)
    table.read().write.parquet(str(tmp_path / "data" / "lost"))
    want = rows(table.read())
    table.sweep()
    table.sweep_feeds(1)
    again = SnapshotTable(spark, str(tmp_path), PAIR, "id")
    assert rows(again.read()) == want and not list((tmp_path / "incoming").iterdir())
    assert not (tmp_path / "data" / "lost").exists()
    assert sum(f.suffix == ".parquet" for f in (tmp_path / "data").rglob("*")) == (buckets or 1)
    assert rows(again.changes(after=1)) == [(3, "a", -1, 2), (3, "b", 1, 2)]
    again.upsert(spark.createDataFrame([(4, "c")], PAIR), feed=True)
    assert rows(again.read()) == sorted({**dict(want), 4: "c"}.items(), key=repr)
    SnapshotTable(spark, str(tmp_path / "none"), PAIR, "id").sweep()


def test_short_lived_shuffles_leave_no_files(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f for d in disk.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")}

    before = files()
    with short_lived_shuffles(spark):
        spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, "false") == "false"


def test_adding_a_net_delta_takes_it_as_it_is(spark, tmp_path):
    schema = "id long, v string, n long"
    typed = spark.createDataFrame([], schema).schema
    table = SnapshotTable(spark, str(tmp_path), typed, "id", 3)
    table.publish(spark.createDataFrame([(1, "a", 2), (2, "a", 1)], schema))
    net = materialise(spark.createDataFrame([(1, "a", 1), (2, "a", -1), (3, "c", 4)], schema), "net")
    assert table.add(net, ["id", "v"], "n", net=True) == 3
    assert rows(table.read()) == [(1, "a", 3), (3, "c", 4)]
    assert not (tmp_path / "incoming").exists()
    assert rows(table.read_buckets_of(net.filter("id = 3")).filter("id = 3")) == [(3, "c", 4)]


@pytest.mark.parametrize("buckets", [None, 4])
def test_feed_holds_changed_rows_only(spark, tmp_path, buckets):
    table = SnapshotTable(spark, str(tmp_path), PAIR, "id", buckets)
    table.upsert(spark.createDataFrame([(i, "a") for i in range(20)], PAIR), feed=True)
    table.upsert(spark.createDataFrame([(3, "a"), (4, "b"), (30, "c"), (30, "c")], PAIR), feed=True)
    assert rows(table.changes(after=1)) == [(30, "c", 1, 2), (4, "a", -1, 2), (4, "b", 1, 2)]
    assert table.changes().count() == 23 and table.changes(after=2).count() == 0
    files = table.changes(after=1).inputFiles()
    assert files and all("/feed/__version=2/" in f for f in files)
    table.upsert(spark.createDataFrame([(5, "d")], PAIR))
    with pytest.raises(ValueError, match="version 3 was written without a feed"):
        table.changes(after=2)
    assert table.read(1).count() == 20 and table.read(2).count() == 21


def test_a_dead_write_leaves_no_feed(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), PAIR, "id", 2)
    table.upsert(spark.createDataFrame([(1, "a")], PAIR), feed=True)

    def die(*_):
        raise RuntimeError("died")

    table._commit, real = die, table._commit
    with pytest.raises(RuntimeError):
        table.upsert(spark.createDataFrame([(2, "dead")], PAIR), feed=True)
    table._commit = real
    assert rows(table.changes()) == [(1, "a", 1, 1)]
    table.upsert(spark.createDataFrame([(3, "c")], PAIR), feed=True)
    assert rows(table.changes(after=1)) == [(3, "c", 1, 2)]
    assert rows(table.read()) == [(1, "a"), (3, "c")]


def test_a_release_shows_all_tables_or_none(spark, tmp_path):
    def opened():
        tables = {n: SnapshotTable(spark, f"{tmp_path}/{n}", PAIR, "id", 2) for n in ("a", "b")}
        release = Release(spark, f"{tmp_path}/releases", tables)
        release.pin()
        return release, tables

    def contents():
        return [rows(t.read()) for t in opened()[1].values()]

    release, tables = opened()
    tables["a"].publish(spark.createDataFrame([(1, "a")], PAIR))
    assert contents() == [[], []]
    tables["b"].publish(spark.createDataFrame([(1, "b")], PAIR))
    assert release.commit() == 1
    assert contents() == [[(1, "a")], [(1, "b")]]
    # A run that dies, and one that starts over: nothing of the dead one comes through.
    _, dead = opened()
    dead["a"].upsert(spark.createDataFrame([(7, "dead")], PAIR))
    release, tables = opened()
    for table in tables.values():
        table.upsert(spark.createDataFrame([(2, "x")], PAIR))
    assert contents() == [[(1, "a")], [(1, "b")]]
    release.commit()
    assert contents() == [[(1, "a"), (2, "x")], [(1, "b"), (2, "x")]]
    obsolete = {r[0] for r in tables["a"].obsolete_paths(keep=1).collect()}
    assert not any(path in obsolete for path in tables["a"]._live()[1].values())


def test_keys_replaced_by_many_rows_or_none(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path), PAIR, "id", 3)
    table.publish(spark.createDataFrame([(i, "a") for i in range(6)], PAIR))
    keys = spark.createDataFrame([(1,), (2,), (2,), (9,)], "id long")
    table.replace_keys(keys, spark.createDataFrame([(2, "b"), (9, "n")], PAIR))
    assert rows(table.read()) == [(0, "a"), (2, "b"), (3, "a"), (4, "a"), (5, "a"), (9, "n")]
    everything = table.read().select("id")
    table.replace_keys(everything, table.read().limit(0))
    assert rows(table.read()) == []
    table.upsert(spark.createDataFrame([(1, "z")], PAIR))
    assert rows(table.read()) == [(1, "z")]


def test_counts_are_added_leave_at_zero_and_never_go_below(spark, tmp_path):
    schema = struct(id=T.LongType(), v=T.StringType(), n=T.LongType())
    table = SnapshotTable(spark, str(tmp_path), schema, "id", 2)
    for delta in ([(1, "a", 2), (1, None, 1), (2, "b", 1)], [(1, "a", -1), (2, "b", -1), (1, None, 1)]):
        table.add(spark.createDataFrame(delta, schema), ["id", "v"], "n")
    assert rows(table.read()) == [(1, "a", 1), (1, None, 2)]
    version = table.version()
    assert table.add(spark.createDataFrame([(1, "a", 1), (1, "a", -1)], schema), ["id", "v"], "n") == 0
    with pytest.raises(Exception, match="negative count"):
        table.add(spark.createDataFrame([(1, "a", -2)], schema), ["id", "v"], "n")
    assert table.version() == version


# ---- landing compaction -----------------------------------------------------------


def test_a_folded_landing_table_stays_one(spark, tmp_path):
    schema = struct(id=T.LongType(), v=T.StringType(), ingested_at=T.TimestampType())
    path = str(tmp_path / "landing")

    def batch(seq, *pairs):
        frame = spark.createDataFrame([(i, v, NOW) for i, v in pairs], schema)
        append_landing(frame, path, schema.names, seq)

    def current():
        return rows(read_landing(spark, path, schema).select("id", "v", "batch_seq"))

    def fold():
        return compact_landing_in_place(spark, path, schema, "id", "ingested_at")

    batch(1, (1, "a"), (2, "a"))
    batch(2, (2, "b"), (3, "b"))
    assert len(current()) == 4
    assert fold() == 2
    assert current() == [(1, "a", 1), (2, "b", 2), (3, "b", 2)]
    read = read_landing(spark, path, schema).select(F.input_file_name()).distinct().collect()
    assert all("_compacted" in r[0] for r in read)
    batch(3, (3, "c"), (4, "c"))
    assert len(current()) == 5
    assert fold() == 3 and fold() == 3
    assert current() == [(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "c", 3)]
    batch(4, (1, "d"))
    batch(4, (1, "e"))  # a repeated batch replaces itself, as before
    assert current()[-1] == (4, "c", 3) and (1, "e", 4) in current() and len(current()) == 5


# ---- marts from signed sums -------------------------------------------------------

USER = "user_id long, username string, full_name string, email string, company_name string, city string"
POST = "post_id long, user_id long, title string, title_length long, body_length long"
COMMENT = "comment_id long, post_id long, commenter_email string, body_length long"


class World:
    """Current rows in plain Python, and the signed changes made to them."""

    def __init__(self, seed):
        self.rnd = random.Random(seed)
        self.users, self.posts, self.comments = {}, {}, {}

    def user(self):
        return (self.rnd.choice(["ann", "bob", None, "cy"]), "n", "e", "c", self.rnd.choice("xy"))

    def post(self):
        title = self.rnd.choice(["", "t", "title", None])
        size = None if title is None else len(title)
        return (self.rnd.randint(0, 5), title, size, self.rnd.choice([None, 3, 10]))

    def comment(self):
        return (
            self.rnd.randint(0, 9),
            self.rnd.choice([None, "a@x", "b@x", "c@x"]),
            self.rnd.choice([None, 1, 2, 3, 50]),
        )

    def change(self, n):
        """Random inserts, updates, moves and deletes, some keys more than once."""
        images = {"users": [], "posts": [], "comments": []}
        for _ in range(n):
            name, keys, make = self.rnd.choice(
                [("users", 6, self.user), ("posts", 10, self.post), ("comments", 40, self.comment)]
            )
            held, key = getattr(self, name), self.rnd.randrange(keys)
            if key in held:
                images[name].append(((key, *held.pop(key)), -1))
                if self.rnd.random() < 0.3:
                    continue
            held[key] = make()
            images[name].append(((key, *held[key]), 1))
        return images

    def frames(self, spark):
        return [
            spark.createDataFrame([(k, *v) for k, v in held.items()], schema)
            for held, schema in ((self.users, USER), (self.posts, POST), (self.comments, COMMENT))
        ]


def test_authors_to_split_are_counted_on_the_posts(spark, monkeypatch):
    """Not on the posts joined with all their comments, which would be computed twice."""
    counted = []

    def noted(frame, key, min_rows):
        counted.append((frame.columns, key))
        return HotKeys(None)

    for module in ("tidemark.plans.marts", "tidemark.operators.skew"):
        monkeypatch.setattr(f"{module}.heaviest_keys", noted, raising=False)
    world = World(5)
    world.change(40)
    users, posts, comments = world.frames(spark)
    mart_comment_statistics(posts, comments, users, NOW)
    assert counted == [(posts.columns, "user_id")]


def test_measures_of_posts_are_aggregated_before_they_are_joined(spark):
    emails = spark.createDataFrame([(1, "a@x", 2), (1, None, 1), (2, None, 1)], "post_id long, commenter_email string, n long")
    lengths = spark.createDataFrame([(1, 5, 2), (1, None, 1), (2, None, 1)], "post_id long, body_length long, n long")
    metrics = comment_metrics_from(emails, lengths)
    assert rows(metrics) == [(1, 3, 1, 5.0, 5, 5), (2, 1, 0, None, None, None)]
    assert "Join" not in metrics._jdf.queryExecution().optimizedPlan().toString()


def test_steps_at_once_give_results_in_order_and_raise():
    assert at_once(lambda: 1, lambda: 2) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        at_once(lambda: 1, lambda: 1 // 0)


def signed_frames(spark, images):
    schemas = {"users": USER, "posts": POST, "comments": COMMENT}
    return {
        name: spark.createDataFrame([(*row, s) for row, s in images[name]], f"{schema}, {SIGN} int")
        for name, schema in schemas.items()
    }


def both_marts(users, posts, comments):
    return (
        rows(mart_user_post_summary(users, posts, comments, NOW)),
        rows(mart_comment_statistics(posts, comments, users, NOW)),
    )


def stored_marts(state):
    return tuple(rows(state.read(m)) for m in ("mart_user_post_summary", "mart_comment_statistics"))


@pytest.mark.parametrize(("seed", "buckets", "sizes"), [(1, None, (60,)), (2, 3, (1, 80))])
def test_refreshed_marts_equal_rebuilt_ones(spark, tmp_path, seed, buckets, sizes):
    world = World(seed)
    world.change(60)
    MartState(spark, str(tmp_path), buckets).load(*world.frames(spark), NOW)
    assert stored_marts(MartState(spark, str(tmp_path))) == both_marts(*world.frames(spark))
    for size in sizes:
        images = world.change(size)
        MartState(spark, str(tmp_path)).refresh(**signed_frames(spark, images), built_at=NOW)
        state = MartState(spark, str(tmp_path))
        assert stored_marts(state) == both_marts(*world.frames(spark))
        assert all(r["n"] > 0 for r in state.read("user_emails").collect())


def test_a_refresh_that_fails_its_check_changes_nothing(spark, tmp_path):
    world = World(5)
    world.change(40)
    state = MartState(spark, str(tmp_path), 2)
    state.load(*world.frames(spark), NOW)
    before = stored_marts(state)
    images = world.change(20)

    def fail(_):
        raise RuntimeError("tests failed")

    with pytest.raises(RuntimeError):
        MartState(spark, str(tmp_path)).refresh(**signed_frames(spark, images), built_at=NOW, check=fail)
    assert stored_marts(MartState(spark, str(tmp_path))) == before
    # The same delta again: counted once.
    MartState(spark, str(tmp_path)).refresh(**signed_frames(spark, images), built_at=NOW)
    assert stored_marts(MartState(spark, str(tmp_path))) == both_marts(*world.frames(spark))


def test_a_state_started_by_a_refresh(spark, tmp_path):
    users = spark.createDataFrame([(1, "a", "", "", "", "")], USER)
    MartState(spark, str(tmp_path), 2).refresh(users=signed(users), built_at=NOW)
    assert MartState(spark, str(tmp_path)).read("mart_user_post_summary").count() == 1
