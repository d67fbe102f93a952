import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators.joins import left_metrics, lookup, orphans
from tidemark.operators.skew import HOT_KEY, SALTS, heaviest_keys, skew_join
from tidemark.plans.marts import mart_comment_statistics, mart_user_post_summary
from tidemark.plans.staging import stg_comments, stg_posts, stg_users
from tidemark.schemas import LANDING, MARTS, STAGING

NOW = datetime(2024, 1, 1)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on key 1, a third without a key."""
    rng = random.Random(3)
    rows = [(i, rng.choice([1, None, rng.randrange(2, 30)])) for i in range(900)]
    large = spark.createDataFrame(rows, "n long, k long").repartition(5)
    small = spark.createDataFrame([(k, f"name {k}") for k in range(20)], "k long, name string")
    return rows, large, small


def test_heaviest_keys_are_all_listed_and_sized(skewed):
    rows, large, _ = skewed
    hot = {r[HOT_KEY]: r[SALTS] for r in heaviest_keys(large, "k", min_rows=100).frame.collect()}
    counts = {k: sum(r[1] == k for r in rows) for k in (1, None)}
    assert hot == {k: -(-n // 100) for k, n in counts.items()}
    assert heaviest_keys(large, "k", min_rows=1).frame.count() == len({r[1] for r in rows})
    assert heaviest_keys(large, "k").empty


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("min_rows", [1, 50, 10**6])
def test_skew_join_equals_plain_join(spark, skewed, how, min_rows):
    _, large, small = skewed
    hot = heaviest_keys(large, "k", min_rows=min_rows)
    got = skew_join(large, small, "k", how, spread=["n"], hot=hot)
    want = large.join(small, "k", how)
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(key, got.select(*want.columns).collect())) == sorted(map(key, want.collect()))


def test_skew_join_spreads_the_hot_key(spark, skewed):
    _, large, small = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = heaviest_keys(large, "k", min_rows=20)
        joined = skew_join(large, small, "k", "inner", spread=["n"], hot=hot)
        tasks = joined.filter("k = 1").select(F.spark_partition_id()).distinct().count()
        assert tasks > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_skew_join_rejects_other_join_types(skewed):
    _, large, small = skewed
    with pytest.raises(ValueError):
        skew_join(large, small, "k", "full")


def test_lookup_fills_only_unmatched_rows(spark):
    base = spark.createDataFrame([(1, 1), (2, 2), (3, None), (4, 9)], "n long, k long")
    dim = spark.createDataFrame([(1, "x", 5), (2, None, None)], "k long, name string, size int")
    got = {r["n"]: (r["name"], r["size"]) for r in lookup(base, dim, "k").collect()}
    assert got == {1: ("x", 5), 2: (None, None), 3: ("", 0), 4: ("", 0)}
    got = {r["n"]: r["name"] for r in lookup(base, dim, "k", unmatched="null").collect()}
    assert got == {1: "x", 2: None, 3: None, 4: None}
    with pytest.raises(ValueError):
        lookup(base, dim, "k", unmatched="other")


def test_left_metrics_keeps_every_base_row(spark):
    base = spark.createDataFrame([(1,), (2,)], "k long")
    metrics = spark.createDataFrame([(1, 7)], "k long, n long")
    assert sorted(map(tuple, left_metrics(base, metrics, "k").collect())) == [(1, 7), (2, None)]
    filled = left_metrics(base, metrics, "k", unmatched="type_default")
    assert sorted(map(tuple, filled.collect())) == [(1, 7), (2, 0)]


def test_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 5), (3, None)], "n long, k long")
    parent = spark.createDataFrame([(1,), (1,)], "id long")
    assert [r["n"] for r in orphans(child, "k", parent, "id").collect()] == [2]


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(k, k % 2) for k in range(10)], "k long, m long")
    top = agg.top_k(df, "m", "k", 3)
    assert [r["k"] for r in top.collect()] == [1, 3, 5]
    assert "TakeOrderedAndProject" in plan_of(top)


# ---- staging and marts ------------------------------------------------------------


def frames(spark):
    users = [
        (1, "Ann", "ann", " Ann@X.io ", "NY"),
        (2, "Bob", "bob", None, "LA"),
        (3, "Cy", None, "cy@x.io", "SF"),
    ]
    users = spark.createDataFrame(
        [(i, n, u, e, None, None, "Co", c, None, 1.0, 2.0, NOW) for i, n, u, e, c in users],
        LANDING["users"],
    )
    posts = spark.createDataFrame(
        [
            (10, 1, " é ", "x" * 3, NOW),
            (11, 1, "ab", " \n", NOW),
            (12, 9, "orphan", "zz", NOW),
            (13, None, "nobody", "z", NOW),
            (14, 3, "named", "z", NOW),
        ],
        LANDING["posts"],
    )
    comments = spark.createDataFrame(
        [
            (100, 10, "n", "A@x.io", "12345", NOW),
            (101, 10, "n", "a@x.io ", "1", NOW),
            (102, 11, "n", "a@x.io", "123", NOW),
            (103, 11, "n", "ann@x.io", None, NOW),
            (104, 12, "n", "b@x.io", "1", NOW),
            (105, 77, "n", "lost@x.io", "1", NOW),
            (106, 10, "n", None, "1", NOW),
        ],
        LANDING["comments"],
    )
    return users, posts, comments


def staged(spark):
    users, posts, comments = frames(spark)
    return stg_users(users), stg_posts(posts), stg_comments(comments)


def test_staging_schemas(spark):
    for name, df in zip(STAGING, staged(spark)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in STAGING[name]]


def test_staging_measures_trimmed_bytes(spark):
    _, posts, comments = staged(spark)
    rows = {r["post_id"]: r for r in posts.collect()}
    assert (rows[10]["title"], rows[10]["title_length"]) == ("é", 2)
    assert (rows[11]["body"], rows[11]["body_length"]) == ("\n", 1)
    emails = {r["comment_id"]: r["commenter_email"] for r in comments.collect()}
    assert emails[100] == emails[101] == "a@x.io" and emails[106] is None


def test_staging_rejects_keys_outside_uint32(spark):
    _, posts, _ = frames(spark)
    bad = posts.withColumn("id", F.when(F.col("id") == 12, -1).otherwise(F.col("id")))
    with pytest.raises(Exception, match="unsigned 32-bit"):
        stg_posts(bad).collect()


def test_key_lookup_reaches_the_reader(spark, tmp_path):
    _, posts, _ = frames(spark)
    posts.write.parquet(str(tmp_path / "p"))
    found = stg_posts(spark.read.parquet(str(tmp_path / "p"))).filter("post_id = 10")
    assert "EqualTo(id,10)" in plan_of(found)
    assert found.count() == 1


def test_text_is_not_shuffled_when_only_its_length_is_used(spark, tmp_path):
    _, posts, _ = frames(spark)
    seq = posts.withColumn("batch_seq", F.lit(1).cast("long"))
    seq.write.parquet(str(tmp_path / "p"))
    read = spark.read.parquet(str(tmp_path / "p"))
    lengths = stg_posts(read).select("post_id", "body_length")
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "title" not in plan.split("FileScan")[1]
    exchange = plan[plan.index("Exchange hashpartitioning") :]
    assert "trim(body" in exchange  # measured below the exchange, at the scan


@pytest.mark.parametrize("min_rows", [1, 10**6])
def test_user_mart(spark, min_rows):
    users, posts, comments = staged(spark)
    hot = heaviest_keys(comments, "post_id", min_rows=min_rows)
    mart = mart_user_post_summary(users, posts, comments, NOW, hot_posts=hot)
    assert [(f.name, f.dataType) for f in mart.schema] == [
        (f.name, f.dataType) for f in MARTS["mart_user_post_summary"]
    ]
    rows = {r["user_id"]: r for r in mart.collect()}
    assert set(rows) == {1, 2, 3}  # users without posts stay, unknown authors do not appear
    ann = rows[1]
    assert ann["total_posts"] == 2 and ann["total_comments_received"] == 5
    # a@x.io commented on both posts and counts once; the author's own comment counts.
    assert ann["unique_commenters"] == 2
    assert (ann["avg_post_title_length"], ann["avg_post_body_length"]) == (2.0, 2.0)
    assert ann["total_post_body_length"] == 4 and ann["built_at"] == NOW
    assert tuple(rows[2])[6:12] == (0, 0, 0, 0.0, 0.0, 0)


@pytest.mark.parametrize("min_rows", [1, 10**6])
def test_post_mart(spark, min_rows):
    users, posts, comments = staged(spark)
    hot = heaviest_keys(posts, "user_id", min_rows=min_rows)
    mart = mart_comment_statistics(posts, comments, users, NOW, hot_users=hot)
    assert [(f.name, f.dataType) for f in mart.schema] == [
        (f.name, f.dataType) for f in MARTS["mart_comment_statistics"]
    ]
    rows = {r["post_id"]: r for r in mart.collect()}
    assert set(rows) == {10, 11, 12, 13, 14}
    assert rows[12]["author_username"] == "" and rows[13]["author_username"] == ""
    assert rows[14]["author_username"] is None  # the author exists and has no name
    assert tuple(rows[13])[4:9] == (0, 0, 0.0, 0, 0)
    assert tuple(rows[10])[4:9] == (3, 1, 2.33, 1, 5)
    nulls = mart_comment_statistics(posts, comments, users, NOW, unmatched="null")
    assert nulls.filter("post_id = 12").first()["author_username"] is None


def test_marts_against_brute_force(spark):
    rng = random.Random(5)
    posts = [(p, rng.choice([0, 0, 0, rng.randrange(12)]), rng.randrange(9)) for p in range(60)]
    comments = [
        (c, rng.choice([0, rng.randrange(70)]), f"e{rng.randrange(6)}", rng.randrange(1, 40))
        for c in range(700)
    ]
    users = spark.createDataFrame(
        [(u, f"u{u}", "", "", "", "") for u in range(10)],
        "user_id long, username string, full_name string, email string, company_name string, city string",
    )
    p = spark.createDataFrame(
        [(i, u, "t", n, 2 * n) for i, u, n in posts],
        "post_id long, user_id long, title string, title_length long, body_length long",
    )
    c = spark.createDataFrame(
        comments, "comment_id long, post_id long, commenter_email string, body_length long"
    ).repartition(6)
    hot = heaviest_keys(c, "post_id", min_rows=40)
    mart = mart_user_post_summary(users, p, c, NOW, hot_posts=hot)
    author = {i: u for i, u, _ in posts}
    for row in mart.collect():
        own = [x for x in posts if x[1] == row["user_id"]]
        got = [x for x in comments if author.get(x[1]) == row["user_id"]]
        assert row["total_posts"] == len(own)
        assert row["total_comments_received"] == len(got)
        assert row["unique_commenters"] == len({x[2] for x in got})
        assert row["total_post_body_length"] == sum(2 * x[2] for x in own)
    stats = mart_comment_statistics(
        p, c, users, NOW, hot_users=heaviest_keys(p, "user_id", min_rows=5)
    )
    for row in stats.collect():
        lengths = [x[3] for x in comments if x[1] == row["post_id"]]
        assert row["total_comments"] == len(lengths)
        assert row["max_comment_length"] == max(lengths, default=0)
        assert row["author_username"] == (f"u{row['user_id']}" if row["user_id"] < 10 else "")


def test_no_python_udf_and_no_cartesian_product(spark):
    from tidemark.workload.queries import QUERIES

    for name in ("mart_user_post_summary", "mart_comment_statistics", "reconcile_counts"):
        text = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert bad not in text, itertools.chain([name, bad])


def test_more_hot_keys_than_fit_a_small_list(spark):
    """Every key above the bound is split, however many there are."""
    large = spark.range(36_000).select((F.col("id") % 12_000).alias("k"), F.col("id").alias("n"))
    hot = heaviest_keys(large, "k", min_rows=2)
    assert hot.frame.count() == 12_000
    small = spark.range(12_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = skew_join(large, small, "k", spread=["n"], hot=hot)
    assert got.count() == 36_000
    assert got.filter("v <> 2 * k").isEmpty()
