"""Spark side of the workload: one query per operator, each over whole tables.

Stored timestamps come from the data or from fixed build times, never from the clock,
so that results can be compared; ``built_at`` is left out of the marts.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.operators import aggregates as agg
from tidemark.operators import changes as chg
from tidemark.operators import deltas, distribution, joins, latest, quality, state, tables
from tidemark.operators.skew import heaviest_keys
from tidemark.operators.upsert import insert_ignore, upsert
from tidemark.plans import elt, marts, refresh, staging
from tidemark.plans.ingest import ingest_entity, oltp_table
from tidemark.plans.mart_state import MartState, signed
from tidemark.plans.replicate import replicate, replicate_feed
from tidemark.plans.transforms import ENTITIES
from tidemark.plans.validate import layer_counts, top_posts, top_users
from tidemark.schemas import MARTS, PAYLOAD, WATERMARK
from tidemark.session import materialise, new_run_dir, remove, short_lived_shuffles
from tidemark.sources.json_entities import is_json_array, parse_json
from tidemark.sources.tables import newer_than, read_incremental
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
from tidemark.workload import fixtures as fx

BATCH_TS = datetime(2024, 2, 1)
BUILT_AT = datetime(2024, 2, 2)
FILES_PER_BATCH = 10_000

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[fx.Tables], DataFrame]) -> Query:
    """Register ``build(tables)`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(fx.Tables(spark, sf_dir))

    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return run


def _parallelism(spark: SparkSession) -> int:
    """Buckets and hash partitions follow the session, as shuffles do."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---- sources ----------------------------------------------------------------------


def _payload(src: fx.Tables, entity: str) -> DataFrame:
    """The fixture view of an entity as nested payload records."""
    if entity == "users":
        return fx.users(src).select(
            F.col("id").cast("string").alias("id"),
            "name",
            "username",
            "email",
            "phone",
            "website",
            F.struct(F.col("company_name").alias("name")).alias("company"),
            F.struct(
                "city",
                "zipcode",
                F.struct(
                    F.col("lat").cast("string").alias("lat"),
                    # Negative coordinates arrive as empty text.
                    F.when(F.col("lng") < 0, "")
                    .otherwise(F.col("lng").cast("string"))
                    .alias("lng"),
                ).alias("geo"),
            ).alias("address"),
        )
    if entity == "posts":
        return fx.posts(src).select("id", F.col("user_id").alias("userId"), "title", "body")
    return fx.comments(src).select(
        "id", F.col("post_id").alias("postId"), "name", "email", "body"
    )


def _records(src: fx.Tables, entity: str) -> DataFrame:
    """Payload records after a trip through JSON text."""
    text = _payload(src, entity).select(F.to_json(F.struct("*")).alias("payload"))
    return text.select(parse_json(F.col("payload"), PAYLOAD[entity]).alias("r")).select("r.*")


@query
def src_json_props(src):
    schema = "struct<k:bigint>"
    return src("events").select(
        "event_id", F.from_json("props", schema, {"mode": "FAILFAST"})["k"].alias("k")
    )


@query
def payload_shape(src):
    array = F.concat(F.lit(" ["), "props", F.lit("]"))
    wrapped = F.when(F.col("event_type").isin("click", "view"), array).otherwise(F.col("props"))
    return (
        src("events")
        .select(is_json_array(wrapped).alias("is_array"))
        .groupBy("is_array")
        .agg(F.count(F.lit(1)).alias("payloads"))
    )


@query
def registry_counts(src):
    """Every entity through its registered transform; the counts need the parsed values."""
    measured = {"users": ("email", "name"), "posts": ("body", "title"), "comments": ("email", "body")}
    counts = []
    for name, spec in ENTITIES.items():
        flat = spec.transform(_records(src, name), BATCH_TS)
        filled, sized = measured[name]
        counted = flat.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(filled).alias("filled"),
            F.sum(fn.byte_length(F.col(sized))).cast("long").alias("name_bytes"),
        )
        counts.append(fn.label(counted, name))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def json_flatten_posts(src):
    return ENTITIES["posts"].transform(_records(src, "posts"), BATCH_TS)


@query
def json_flatten_comments(src):
    return ENTITIES["comments"].transform(_records(src, "comments"), BATCH_TS)


@query
def json_flatten(src):
    flat = ENTITIES["users"].transform(_records(src, "users"), BATCH_TS)
    return flat.withColumns({c: fn.decimal_to_double(F.col(c)) for c in ("lat", "lng")})


@query
def ingest_users(src):
    spark, spec = src.spark, ENTITIES["users"]
    payloads = new_run_dir(spark, "payload-users")
    _payload(src, "users").write.json(payloads)
    table = oltp_table(spark, new_run_dir(spark, "oltp"), spec, _parallelism(spark))
    # Twice: the second run replaces every row with itself.
    for _ in range(2):
        ingest_entity(spark, spec, payloads, table, BATCH_TS, lines=True)
    return table.read().withColumns(
        {c: fn.decimal_to_double(F.col(c)) for c in ("lat", "lng")}
    )


@query
def incremental_read(src):
    return read_incremental(
        src("events"),
        ["event_id", "user_id", "event_type", "value", "ts"],
        datetime(2024, 1, 5),
        version="ts",
        ordered=True,
    )


@query
def scan_counts(src):
    return agg.table_counts({name: src(name) for name in sorted(src)})


# ---- scalar functions -------------------------------------------------------------


@query
def rename_columns(src):
    return fn.rename_select(
        src("customer"), {"c_custkey": "user_id", "c_name": "full_name", "c_acctbal": "balance"}
    )


@query
def cast_required_int(src):
    text = F.concat(F.lit(" "), F.col("doc_id"), F.lit(" "))
    return src("documents").select(fn.required_long(text, "doc_id").alias("id"), "n_chars")


@query
def uint32_keys(src):
    return src("orders").select(
        fn.uint32(F.col("o_orderkey")).alias("post_id"),
        fn.uint32(F.col("o_custkey")).alias("user_id"),
    )


@query
def parse_optional_float(src):
    text = F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_acctbal").cast("string"))
    return src("customer").select("c_custkey", fn.optional_double(text).alias("balance"))


@query
def decimal_quantise(src):
    stored = fn.quantise(F.col("c_acctbal") / 70)
    return src("customer").select("c_custkey", fn.decimal_to_double(stored).alias("lat"))


@query
def normalise_email(src):
    text = F.when(F.col("c_acctbal") < 0, F.lit(" \t\n")).otherwise(
        F.concat(F.lit("\t User"), F.col("c_custkey"), F.lit("@Example.COM \n"))
    )
    return src("customer").select("c_custkey", fn.normalise_email(text).alias("email"))


@query
def byte_length(src):
    text = F.concat(F.lit("  "), F.col("text"), F.lit("\n "))
    return src("documents").select(
        "doc_id",
        fn.byte_length(fn.trim(text)).alias("trimmed_bytes"),
        fn.byte_length(text).alias("raw_bytes"),
    )


@query
def ts_millis(src):
    return src("events").select("event_id", fn.to_millis(F.col("ts")).alias("version"))


@query
def round_half_even(src):
    per_order = src("lineitem").groupBy("l_orderkey").agg(F.avg("l_quantity").alias("q"))
    return per_order.select("l_orderkey", fn.round2(F.col("q")).alias("avg_quantity"))


@query
def defaults_fill(src):
    rows = src("events").select(
        F.col("event_type").alias("table_name"),
        F.when(F.col("event_type") != "error", F.col("ts")).alias("last_ingested_at"),
        F.col("ts").alias("updated_at"),
    )
    return tables.typed(
        rows,
        WATERMARK,
        defaults={"last_ingested_at": fn.timestamp_literal(state.EPOCH)},
        not_null=["table_name", "updated_at"],
    )


# ---- watermark state --------------------------------------------------------------


def _state(src: fx.Tables) -> DataFrame:
    """One watermark row per event type."""
    return (
        src("events")
        .groupBy(F.col("event_type").alias("table_name"))
        .agg(
            F.max("ts").cast("timestamp").alias("last_ingested_at"),
            F.max("ts").cast("timestamp").alias("updated_at"),
        )
    )


@query
def watermark_get(src):
    stored = _state(src)
    rows = [
        fn.label(state.watermark_of(stored, name), name) for name in ("click", "not_there")
    ]
    return rows[0].unionByName(rows[1])


@query
def watermark_seed(src):
    seeded = state.seed_watermarks(_state(src), ["click", "users", "posts", "comments"])
    return seeded.select("table_name", "last_ingested_at")


@query
def watermark_advance(src):
    spark = src.spark
    stored = tables.SnapshotTable(spark, new_run_dir(spark, "state"), WATERMARK, "table_name")
    stored.publish(_state(src))
    newest = agg.max_version(src("events").withColumn("ts", F.col("ts").cast("timestamp")), "ts")
    micros = newest.select(F.unix_micros("ts")).first()[0]
    state.set_watermark(stored, "click", state.EPOCH + timedelta(microseconds=micros))
    state.set_watermark(stored, "events", state.EPOCH + timedelta(microseconds=micros))
    return stored.read().select("table_name", "last_ingested_at")


@query
def watermark_state(src):
    return _state(src).orderBy("table_name")


# ---- latest per key ---------------------------------------------------------------


@query
def latest_per_key(src):
    return latest.latest_per_key(fx.changes(src), "user_id", "ts", [F.col("event_id").desc()])


@query
def latest_max_by(src):
    return latest.latest_values(fx.changes(src), "user_id", "ts", ["event_id", "event_type", "value"])


@query
def final_read(src):
    return latest.final(fx.raw_comments(src), "id", "ingested_at").drop("body")


@query
def final_count(src):
    raw = {
        "users": fx.raw_users(src),
        "posts": fx.raw_posts(src),
        "comments": fx.raw_comments(src),
    }
    counts = [fn.label(latest.final_count(df, "id"), name) for name, df in raw.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def landing_compact(src):
    """A landing table that is folded, takes a further batch, and is folded again."""
    spark, spec = src.spark, ENTITIES["posts"]
    landing = new_run_dir(spark, "compact")
    for seq in (1, 2):
        batch = fx.raw_posts(src).filter(F.col("batch_seq") == seq)
        tables.append_landing(batch, landing, spec.columns, seq)
        tables.compact_landing_in_place(spark, landing, spec.landing, spec.key, spec.version)
    return tables.read_landing(spark, landing, spec.landing).drop("row_hash")


@query
def latest_ties(src):
    """Posts landed in one batch, each twice with the same stamp and other words, in one order
    and in the other: how many keys there are, and how many of them read differently, or whose
    narrow columns come from another row than the wide ones."""
    spark, spec = src.spark, ENTITIES["posts"]
    posts = fx.posts(src)
    twin = posts.withColumns({"title": F.reverse("title"), "body": F.concat("body", F.lit("!"))})
    reads = []
    for name, rows in (("a", posts.unionByName(twin)), ("b", twin.unionByName(posts))):
        landing = new_run_dir(spark, f"ties-{name}")
        tables.append_landing(rows, landing, spec.columns, 1)
        landed = tables.read_landing(spark, landing, spec.landing)
        wide = latest.final(landed, spec.key, spec.version)
        narrow = latest.final(
            landed.select("id", "ingested_at", "title", "batch_seq", "row_hash"), spec.key, spec.version
        )
        read = wide.select("id", F.col("title").alias(f"title_{name}"), F.col("body").alias(f"body_{name}"))
        reads.append(read.join(narrow.select("id", F.col("title").alias(f"narrow_{name}")), "id", "full"))
    differs = F.expr(
        "not (title_a <=> title_b and body_a <=> body_b "
        "and title_a <=> narrow_a and title_b <=> narrow_b)"
    )
    both = reads[0].join(reads[1], "id", "full")
    return both.agg(F.count(F.lit(1)).alias("keys"), F.count_if(differs).alias("differing"))


@query
def landing_published(src):
    spark, spec = src.spark, ENTITIES["posts"]
    table = tables.SnapshotTable(spark, new_run_dir(spark, "compact"), spec.landing)
    return tables.compact_landing(fx.raw_posts(src), spec.key, spec.version, table)


# ---- aggregates and joins ---------------------------------------------------------


@query
def agg_by_user(src):
    return agg.post_metrics(fx.rel_posts(src))


@query
def agg_by_post(src):
    return agg.comment_metrics(fx.rel_comments(src))


@query
def agg_count_distinct(src):
    return (
        src("lineitem")
        .groupBy("l_partkey")
        .agg(F.count_distinct("l_suppkey").alias("suppliers"))
    )


@query
def join_inner_agg(src):
    return agg.comments_received(fx.rel_comments(src), fx.rel_posts(src))


@query
def join_left_fill(src):
    metrics = agg.comment_metrics(fx.rel_comments(src))
    posts = fx.rel_posts(src).select("post_id", "user_id")
    return joins.left_metrics(posts, metrics, "post_id", unmatched="type_default")


def _moved_debtors(src: fx.Tables) -> DataFrame:
    """All customers; those with a debt under a key that nothing refers to."""
    key = F.when(F.col("c_acctbal") < 0, -F.col("c_custkey") - 1).otherwise(F.col("c_custkey"))
    return src("customer").withColumn("c_custkey", key)


@query
def join_lookup(src):
    authors = _moved_debtors(src).select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("author")
    )
    posts = fx.rel_posts(src).select("post_id", "user_id", "title")
    return joins.lookup(posts, authors, "user_id", spread=["post_id"])


@query
def join_orphans(src):
    known = _moved_debtors(src)
    return joins.orphans(src("orders"), "o_custkey", known, "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


# ---- staging and marts ------------------------------------------------------------


@query
def stg_users(src):
    return staging.stg_users(fx.raw_users(src))


@query
def stg_posts(src):
    return staging.stg_posts(fx.raw_posts(src))


@query
def stg_comments(src):
    return staging.stg_comments(fx.raw_comments(src))


def _user_mart(src: fx.Tables) -> DataFrame:
    return marts.mart_user_post_summary(
        staging.stg_users(fx.raw_users(src)),
        staging.stg_posts(fx.raw_posts(src)),
        staging.stg_comments(fx.raw_comments(src)),
        BUILT_AT,
        hot_posts=heaviest_keys(fx.raw_comments(src), "post_id"),
    )


def _post_mart(src: fx.Tables) -> DataFrame:
    return marts.mart_comment_statistics(
        staging.stg_posts(fx.raw_posts(src)),
        staging.stg_comments(fx.raw_comments(src)),
        staging.stg_users(fx.raw_users(src)),
        BUILT_AT,
        hot_users=heaviest_keys(fx.raw_posts(src), "user_id"),
    )


@query
def mart_user_post_summary(src):
    return _user_mart(src).drop("built_at")


@query
def mart_comment_statistics(src):
    return _post_mart(src).drop("built_at")


@query
def mart_user_post_summary_rel(src):
    return marts.mart_user_post_summary(
        fx.rel_users(src), fx.rel_posts(src), fx.rel_comments(src), BUILT_AT
    ).drop("built_at")


@query
def mart_comment_statistics_rel(src):
    return marts.mart_comment_statistics(
        fx.rel_posts(src), fx.rel_comments(src), fx.rel_users(src), BUILT_AT
    ).drop("built_at")


HOT_ROWS = 100


def _hot_posts(src: fx.Tables) -> DataFrame:
    """A third of all posts by one author."""
    author = F.when(F.col("post_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))
    return fx.rel_posts(src).withColumn("user_id", author.cast("long"))


def _hot_comments(src: fx.Tables) -> DataFrame:
    """A third of all comments on one post."""
    first = src("orders").agg(F.min("o_orderkey")).first()[0]
    hot = F.regexp_extract("commenter_email", "supp([0-9]+)@", 1).cast("long") % 3 == 0
    return fx.rel_comments(src).withColumn(
        "post_id", F.when(hot, F.lit(first)).otherwise(F.col("post_id"))
    )


@query
def mart_user_post_summary_hot(src):
    """The user mart with hot posts that are split over salts."""
    return marts.mart_user_post_summary(
        fx.rel_users(src), _hot_posts(src), _hot_comments(src), BUILT_AT, min_rows=HOT_ROWS
    ).drop("built_at")


@query
def mart_comment_statistics_hot(src):
    """The post mart with hot authors that are split over salts."""
    return marts.mart_comment_statistics(
        _hot_posts(src), _hot_comments(src), fx.rel_users(src), BUILT_AT, min_rows=HOT_ROWS
    ).drop("built_at")


@query
def topk_users(src):
    return top_users(_user_mart(src))


@query
def topk_posts(src):
    return top_posts(_post_mart(src))


@query
def validation_report(src):
    """Row counts of every layer, as the stage-by-stage check reports them."""
    staged = {
        "stg_users": staging.stg_users(fx.raw_users(src)),
        "stg_posts": staging.stg_posts(fx.raw_posts(src)),
        "stg_comments": staging.stg_comments(fx.raw_comments(src)),
    }
    layers = {
        "raw": {"users": fx.users(src), "posts": fx.posts(src), "comments": fx.comments(src)},
        "staging": staged,
        "marts": {
            "mart_user_post_summary": _user_mart(src),
            "mart_comment_statistics": _post_mart(src),
        },
    }
    return layer_counts(layers)


@query
def publish_mart(src):
    spark = src.spark
    name = "mart_comment_statistics"
    table = tables.SnapshotTable(spark, new_run_dir(spark, name), MARTS[name])
    # A full rebuild replaces the earlier build; readers see one or the other.
    table.publish(_post_mart(src), sort_key="post_id")
    table.publish(_post_mart(src), sort_key="post_id")
    return table.read().drop("built_at")


@query
def sorted_layout(src):
    """Files whose key range overlaps the next file's, after a sorted write: none."""
    spark = src.spark
    path = new_run_dir(spark, "sorted")
    orders = src("orders").select("o_orderkey", "o_custkey")
    tables.sorted_layout(orders, "o_orderkey").write.parquet(path)
    files = (
        spark.read.schema(orders.schema)
        .parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.min("o_orderkey").alias("lo"),
            F.max("o_orderkey").alias("hi"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    # One row per written file from here on, so an unpartitioned window is harmless.
    following = F.lead("lo").over(Window.orderBy("lo", "hi"))
    overlaps = F.coalesce(following <= F.col("hi"), F.lit(False))
    return files.withColumn("overlaps", overlaps).agg(
        F.sum("n").alias("rows"),
        F.min("lo").alias("first_key"),
        F.max("hi").alias("last_key"),
        F.count_if("overlaps").alias("overlaps"),
    )


# ---- data quality -----------------------------------------------------------------


@query
def dq_not_null(src):
    planted = src("events").withColumn(
        "event_type", F.nullif(F.col("event_type"), F.lit("error"))
    )
    return quality.not_null(planted, "event_type").select("event_id", "user_id")


@query
def dq_unique(src):
    lines = src("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"))
    return quality.unique(lines, "line")


@query
def dq_relationships(src):
    known = _moved_debtors(src)
    return quality.relationships(src("orders"), "o_custkey", known, "c_custkey")


@query
def dq_suite(src):
    """All tests, on data with planted violations: users with a debt have another key, users of
    one segment have no e-mail, and comments of one role appear twice."""
    moved = F.when(F.col("lat") < 0, F.col("id") + 2_000_000_000).otherwise(F.col("id"))
    users = staging.stg_users(
        fx.raw_users(src).withColumn("id", moved).withColumn(
            "email", F.when(F.col("company_name") != "BUILDING", F.col("email"))
        )
    )
    posts = staging.stg_posts(fx.raw_posts(src))
    comments = staging.stg_comments(fx.raw_comments(src))
    # The models feed several tests each: write them once.
    staged = {
        "stg_users": materialise(users, "dq-users"),
        "stg_posts": materialise(posts, "dq-posts"),
        "stg_comments": materialise(
            comments.unionByName(comments.filter(F.col("commenter_name") == "user")),
            "dq-comments",
        ),
    }
    u, p, c = staged.values()
    built = {
        "mart_user_post_summary": marts.mart_user_post_summary(u, p, c, BUILT_AT),
        "mart_comment_statistics": marts.mart_comment_statistics(p, c, u, BUILT_AT),
    }
    return quality.run_suite(staged | built)


def _reconciled(src: fx.Tables) -> DataFrame:
    pairs = {
        "users": (fx.users(src), fx.raw_users(src)),
        "posts": (fx.posts(src), fx.raw_posts(src)),
        # The source holds its assistant turns twice; the landing table does not.
        "comments": (
            fx.comments(src).select(
                "*",
                F.explode(F.sequence(F.lit(1), F.when(F.col("name") == "assistant", 2).otherwise(1))),
            ),
            fx.raw_comments(src),
        ),
    }
    checks = [quality.reconcile_counts(s, t, name) for name, (s, t) in pairs.items()]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query
def reconcile_counts(src):
    return _reconciled(src)


@query
def failing_checks(src):
    return quality.failing(_reconciled(src))


@query
def expected_counts(src):
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}
    counts = agg.table_counts({name: src(name) for name in keys})
    distinct = [fn.label(latest.final_count(src(name), key), name) for name, key in keys.items()]
    expected = distinct[0].unionByName(distinct[1]).unionByName(distinct[2])
    return quality.assert_counts(counts, expected)


# ---- writes -----------------------------------------------------------------------


def _balances(df: DataFrame, prefix: str, key: str) -> DataFrame:
    names = {key: "id", f"{prefix}_name": "name", f"{prefix}_acctbal": "balance"}
    return fn.rename_select(df, names)


def _upsert_batch(src: fx.Tables) -> DataFrame:
    """Low keys replace customers; the same suppliers under negative keys are new."""
    suppliers = _balances(src("supplier"), "s", "s_suppkey")
    return suppliers.unionByName(suppliers.withColumn("id", -F.col("id") - 1))


@query
def upsert_replace(src):
    target = _balances(src("customer"), "c", "c_custkey")
    return upsert(target, _upsert_batch(src), "id")


@query
def insert_ignore_repeats(src):
    """Every supplier twice, in two versions: one row per new key arrives."""
    target = _balances(src("customer"), "c", "c_custkey")
    batch = _upsert_batch(src)
    again = batch.withColumn("balance", F.col("balance") + 1)
    return insert_ignore(target, batch.unionByName(again), "id").select("id")


@query
def upsert_rebucketed(src):
    """Written with one number of buckets, updated by a caller that names another."""
    spark = src.spark
    target = _balances(src("customer"), "c", "c_custkey")
    path = new_run_dir(spark, "rebucketed")
    tables.SnapshotTable(spark, path, target.schema, "id", 4).publish(target)
    tables.SnapshotTable(spark, path, target.schema, "id", 7).upsert(_upsert_batch(src))
    return tables.SnapshotTable(spark, path, target.schema, "id").read()


@query
def upsert_buckets(src):
    """The same upsert into a written, bucketed table: only touched buckets are rewritten."""
    spark = src.spark
    target = _balances(src("customer"), "c", "c_custkey")
    path, n = new_run_dir(spark, "buckets"), _parallelism(spark)
    table = tables.SnapshotTable(spark, path, target.schema, "id", n)
    table.publish(target)
    table.upsert(_upsert_batch(src))
    return table.read()


@query
def replicate_batch(src):
    """Two runs from the change feed: the first copies an older state of all posts, the second
    the new one, from the feed files of its version alone."""
    spark, spec = src.spark, ENTITIES["posts"]
    root = new_run_dir(spark, "replicate")
    stored = state.open_state(spark, f"{root}/state", list(ENTITIES))
    marks = state.Marks(spark, f"{root}/marks")
    table = oltp_table(spark, root, spec, _parallelism(spark))
    raw = fx.raw_posts(src)
    for seq in (1, 2):
        table.upsert(raw.filter(F.col("batch_seq") == seq), feed=True)
        replicate_feed(table, f"{root}/landing", stored, marks, spec)
    # Nothing is new now, and nothing is written.
    replicate_feed(table, f"{root}/landing", stored, marks, spec)
    return tables.read_landing(spark, f"{root}/landing", spec.landing).drop("row_hash")


@query
def replicate_by_stamp(src):
    """The same from any table, by the watermark on its stamps."""
    spark, spec = src.spark, ENTITIES["posts"]
    root = new_run_dir(spark, "replicate")
    stored = state.open_state(spark, f"{root}/state", list(ENTITIES))
    raw = fx.raw_posts(src)
    for seq in (1, 2):
        source = raw.filter(F.col("batch_seq") == seq).drop("batch_seq")
        replicate(source, f"{root}/landing", stored, spec, batch_seq=seq)
    # Nothing is newer than the watermark now.
    replicate(source, f"{root}/landing", stored, spec, batch_seq=3)
    return tables.read_landing(spark, f"{root}/landing", spec.landing).drop("row_hash")


@query
def cdc_apply(src):
    target = src("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit("seed").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    return chg.apply_changes(
        target, fx.changes(src), "user_id", "ts", tiebreak=[F.col("event_id").desc()]
    )


@query
def cdc_out_of_order(src):
    """The later half of the log first, then the earlier one, then the later one again."""
    spark, log = src.spark, fx.changes(src)
    target = src("customer").select(
        F.col("c_custkey").alias("user_id"),
        F.lit("seed").alias("event_type"),
        F.col("c_acctbal").alias("value"),
    )
    table = chg.ChangeTable(
        spark,
        new_run_dir(spark, "cdc"),
        target.schema,
        "user_id",
        log.schema["ts"],
        [log.schema["event_id"]],
        buckets=_parallelism(spark),
    )
    table.seed(target)
    later = F.col("ts") >= F.lit("2024-01-16").cast(log.schema["ts"].dataType)
    for piece in (later, ~later, later):
        table.apply(log.filter(piece))
    return table.read()


def _assistant_delta(src: fx.Tables):
    """Staged comments before and after the assistant turns arrive, and those turns."""
    raw = fx.raw_comments(src)
    is_delta = (F.col("batch_seq") == 2) & (F.col("name") == "assistant")
    before, arrived = raw.filter(~is_delta), raw.filter(is_delta)
    return tuple(staging.stg_comments(df) for df in (before, raw, arrived))


@query
def mart_incremental(src):
    """Post mart after the assistant turns arrive, recomputing the posts they touch."""
    before, after, arrived = _assistant_delta(src)
    posts = staging.stg_posts(fx.raw_posts(src))
    users = staging.stg_users(fx.raw_users(src))
    hot_users = heaviest_keys(fx.raw_posts(src), "user_id")
    hot_posts = heaviest_keys(fx.raw_comments(src), "post_id")

    old_mart = marts.mart_comment_statistics(posts, before, users, BUILT_AT, hot_users=hot_users)
    touched = materialise(refresh.posts_touched_by(arrived, before), "touched-posts")
    return refresh.refresh_comment_statistics(
        old_mart, touched, posts, after, users, BUILT_AT, hot_posts, hot_users
    ).drop("built_at")


@query
def mart_user_incremental(src):
    """User mart after the assistant turns arrive, recomputing the authors behind them."""
    before, after, arrived = _assistant_delta(src)
    posts = staging.stg_posts(fx.raw_posts(src))
    users = staging.stg_users(fx.raw_users(src))
    hot_users = heaviest_keys(fx.raw_posts(src), "user_id")
    hot_posts = heaviest_keys(fx.raw_comments(src), "post_id")

    old_mart = marts.mart_user_post_summary(users, posts, before, BUILT_AT, hot_posts)
    touched_posts = refresh.posts_touched_by(arrived, before)
    touched = materialise(refresh.authors_touched_by(touched_posts, posts), "touched-users")
    return refresh.refresh_user_post_summary(
        old_mart, touched, users, posts, after, BUILT_AT, hot_posts, hot_users
    ).drop("built_at")


def _mart_state(src: fx.Tables) -> MartState:
    return MartState(src.spark, new_run_dir(src.spark, "mart-state"), _parallelism(src.spark))


@query
def mart_state_refresh(src):
    """Post mart after the assistant turns arrive, from the delta and the partial results."""
    before, _, arrived = _assistant_delta(src)
    kept = _mart_state(src)
    kept.load(staging.stg_users(fx.raw_users(src)), staging.stg_posts(fx.raw_posts(src)), before, BUILT_AT)
    replaced = signed(chg.replaced_by(before, arrived, "comment_id"), -1)
    kept.refresh(comments=replaced.unionByName(signed(arrived)), built_at=BUILT_AT)
    return kept.read("mart_comment_statistics").drop("built_at")


def _differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed change from one frame to another; equal rows cancel on the way."""
    return signed(before, -1).unionByName(signed(after))


@query
def mart_incremental_moves(src):
    """User mart after comments move to other posts, posts to other authors, and comments go.

    At first a seventh of all comments lie on one post, a fifth of all posts belong to one
    author, and every large comment has a copy under another address, which is deleted.
    """
    users, posts, comments = fx.rel_users(src), fx.rel_posts(src), fx.rel_comments(src)
    first = posts.agg(F.min("post_id").alias("first_post"), F.min("user_id").alias("first_user"))
    start = materialise(first, "first-keys").first()
    on_first = F.col("comment_id") % 7 == 0
    elsewhere = comments.withColumn(
        "post_id", F.when(on_first, F.lit(start["first_post"])).otherwise(F.col("post_id"))
    )
    copies = F.sequence(F.lit(0), F.when(F.col("body_length") > 45, 1).otherwise(0))
    doubled = elsewhere.select("*", F.explode(copies).alias("copy"))
    address = F.when(F.col("copy") == 1, F.lit("gone@example.com")).otherwise(F.col("commenter_email"))
    old_comments = doubled.withColumn("commenter_email", address).drop("copy")
    of_first = F.when(F.col("post_id") % 5 == 0, F.lit(start["first_user"])).otherwise(F.col("user_id"))
    old_posts = posts.withColumn("user_id", of_first)

    kept = _mart_state(src)
    kept.load(users, old_posts, old_comments, BUILT_AT)
    kept.refresh(
        posts=_differing(old_posts, posts),
        comments=_differing(old_comments, comments),
        built_at=BUILT_AT,
    )
    return kept.read("mart_user_post_summary").drop("built_at")


@query
def mart_incremental_rename(src):
    """Post mart after a third of all users get other names: only their posts are touched."""
    users, posts, comments = fx.rel_users(src), fx.rel_posts(src), fx.rel_comments(src)
    old = F.when(F.col("user_id") % 3 == 0, F.lit("old name")).otherwise(F.col("username"))
    old_users = users.withColumn("username", old)
    kept = _mart_state(src)
    kept.load(old_users, posts, comments, BUILT_AT)
    kept.refresh(users=_differing(old_users, users), built_at=BUILT_AT)
    return kept.read("mart_comment_statistics").drop("built_at")


# ---- the whole run ----------------------------------------------------------------

RECORDS_PER_FILE = 500


def _write_arrays(records: DataFrame, path: str) -> None:
    """Response files that each hold one JSON array, of ``RECORDS_PER_FILE`` records on average.

    Records are dealt out by their content and every array is a file of one folder: the number
    of files follows the number of records, however wide the keys lie apart. Files are
    compressed, as responses travel.
    """
    pages = max(1, -(-records.count() // RECORDS_PER_FILE))
    page = F.pmod(F.xxhash64(*records.columns), F.lit(pages)).alias("page")
    arrays = records.groupBy(page).agg(
        F.concat(
            F.lit("["), F.concat_ws(", ", F.collect_list(F.to_json(F.struct(*records.columns)))), F.lit("]")
        ).alias("value")
    )
    to = arrays.select("value").write.option("maxRecordsPerFile", 1)
    to.option("compression", "gzip").text(path)


@query
def run_elt(src):
    """Two whole runs over array files of all entities: all rows with stale names, then the
    current ones. The second one brings the marts up to date from the change feeds and folds
    the landing tables. Nobody else reads the files: each run sweeps up, and the responses go
    when they are taken in."""
    spark, root = src.spark, new_run_dir(src.spark, "elt")
    renamed = {"users": "name", "posts": "title", "comments": "name"}
    for hour in (0, 1):
        paths = {}
        for name, column in renamed.items():
            records = _payload(src, name)
            if hour == 0:
                records = records.withColumn(column, F.lit("STALE"))
            paths[name] = f"{root}/payload-{hour}/{name}"
            with short_lived_shuffles(spark):
                _write_arrays(records, paths[name])
        report = elt.run_elt(
            spark,
            paths,
            f"{root}/warehouse",
            BATCH_TS + timedelta(hours=hour),
            buckets=_parallelism(spark),
            incremental=True,
            compact_after=2,
            sweep=True,
        )
        remove(spark, list(paths.values()))
    user_mart, post_mart = (report.models[m] for m in ("mart_user_post_summary", "mart_comment_statistics"))
    return user_mart.select(
        F.lit("users").alias("mart"),
        F.col("user_id").alias("id"),
        F.col("full_name").alias("name"),
        F.col("total_posts").alias("rows"),
        F.col("total_comments_received").alias("comments"),
        F.col("unique_commenters").alias("people"),
        F.col("avg_post_body_length").alias("average"),
    ).unionByName(
        post_mart.select(
            F.lit("posts").alias("mart"),
            F.col("post_id").alias("id"),
            F.col("post_title").alias("name"),
            F.col("max_comment_length").alias("rows"),
            F.col("total_comments").alias("comments"),
            F.col("unique_commenter_emails").alias("people"),
            F.col("avg_comment_length").alias("average"),
        )
    )


# ---- dated lake and distribution --------------------------------------------------


def _dated_events(src: fx.Tables) -> DataFrame:
    events = src("events")
    path = new_run_dir(src.spark, "dated")
    tables.write_by_date(events, "ts", path)
    return tables.read_dated(src.spark, path, events.schema)


@query
def dated_two_loads(src):
    """Two loads that share every date: both are there afterwards."""
    events = src("events").select("event_id", "event_type", "ts")
    path = new_run_dir(src.spark, "dated-twice")
    for part in (F.col("event_type") == "click", F.col("event_type") != "click"):
        tables.write_by_date(events.filter(part), "ts", path)
    return tables.read_dated(src.spark, path, events.schema).drop(tables.DATE_PARTITION)


@query
def ttl_rewrite(src):
    events = src("events")
    old, new = (new_run_dir(src.spark, name) for name in ("dated", "dated-kept"))
    tables.write_by_date(events, "ts", old)
    tables.remove_expired(
        src.spark, old, new, events.schema, "ts", timedelta(days=7), datetime(2024, 1, 31)
    )
    return tables.read_dated(src.spark, new, events.schema).drop(tables.DATE_PARTITION)


@query
def partition_prune(src):
    wanted = tables.between_dates(
        _dated_events(src), "ts", datetime(2024, 1, 10, 6), datetime(2024, 1, 20, 18)
    )
    return wanted.drop(tables.DATE_PARTITION)


@query
def ttl_filter(src):
    kept = tables.retain(_dated_events(src), "ts", timedelta(days=7), datetime(2024, 1, 31))
    return kept.drop(tables.DATE_PARTITION)


@query
def distributed_join(src):
    """Both sides hash-distributed once; the join and the aggregation add no shuffle."""
    n = _parallelism(src.spark)
    orders = tables.distribute(src("orders").select("o_orderkey", "o_custkey"), "o_orderkey", n)
    lines = tables.distribute(
        src("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity"),
        "o_orderkey",
        n,
    )
    return (
        orders.join(lines, "o_orderkey")
        .groupBy("o_orderkey", "o_custkey")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    )


@query
def distributed_join_hot(src):
    """Lines stored with a third of them moved to order 1, joined with stored orders."""
    spark = src.spark
    root = new_run_dir(spark, "distributed-hot")
    moved = F.when(F.col("l_linenumber") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey"))
    lines = src("lineitem").select(
        moved.cast("long").alias("o_orderkey"),
        F.col("l_orderkey").alias("line_order"),
        "l_linenumber",
        "l_quantity",
    )
    orders = src("orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_custkey")
    name = "hot_" + root.rsplit("/", 1)[-1].replace("-", "_")
    pair = distribution.DistributedPair(spark, name, root, "o_orderkey", _parallelism(spark))
    pair.write(lines, orders, ["line_order", "l_linenumber"], min_rows=HOT_ROWS)
    return pair.join("left")


# ---- streams ----------------------------------------------------------------------


def _event_stream(src: fx.Tables, with_origin: bool = False) -> DataFrame:
    """The events table as a stream of files, with a zoned event time."""
    folder, name = src.paths["events"].rsplit("/", 1)
    schema = src("events").schema
    some = src("events").select("_metadata.file_name").first()
    if some is None or some[0] != name:
        # The table is a folder of part files, not one file.
        folder, name = src.paths["events"], None
    stream = file_stream(src.spark, folder, schema, FILES_PER_BATCH, name, with_origin)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(query_handle) -> None:
    query_handle.awaitTermination()


@query
def stream_replicate(src):
    spark = src.spark
    root = new_run_dir(spark, "stream-replicate")
    columns = ["event_id", "user_id", "event_type", "value", "ts"]
    # The second run finds no new file and copies nothing.
    for _ in range(2):
        _finish(
            replicate_stream(_event_stream(src), f"{root}/landing", f"{root}/checkpoint", columns)
        )
    landed = spark.read.parquet(f"{root}/landing")
    return newer_than(landed, "ts", state.EPOCH).select(*columns)


@query
def stream_dedup(src):
    spark = src.spark
    root = new_run_dir(spark, "stream-dedup")
    sent = _event_stream(src, with_origin=True)
    resent = sent.union(_event_stream(src, with_origin=True))
    once = dedup_stream(resent, "event_id", "ts", "40 days", spread=ORIGIN)
    _finish(write_stream(once, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(once.schema).parquet(f"{root}/out")


@query
def stream_late(src):
    """The events of the last ten days arrive first, then all events: what is older than ten
    days is late, nothing is lost, nothing is there twice."""
    spark = src.spark
    root = new_run_dir(spark, "stream-late")
    events = src("events").withColumn("ts", F.col("ts").cast("timestamp"))
    last = events.agg(F.max("ts").alias("last"))
    since = last.first()[0]
    recent = events.filter(F.col("ts") >= F.lit(since) - F.expr("INTERVAL 10 DAYS"))
    recent.write.parquet(f"{root}/in/batch=1")
    for seq in (1, 2):
        if seq == 2:
            events.unionByName(events).write.parquet(f"{root}/in/batch=2")
        arrived = file_stream(spark, f"{root}/in", events.schema)
        _finish(
            dedup_stream_with_late(
                arrived.select(*events.columns), "event_id", "ts", "10 DAYS",
                f"{root}/out", f"{root}/late", f"{root}/checkpoint",
            )
        )
    out = spark.read.schema(events.schema).parquet(f"{root}/out")
    late = spark.read.schema(events.schema).parquet(f"{root}/late")
    parts = [d.select(*events.columns, F.lit(x).alias("late")) for d, x in ((out, False), (late, True))]
    return parts[0].unionByName(parts[1])


@query
def stream_upsert(src):
    spark = src.spark
    root = new_run_dir(spark, "stream-upsert")
    log = _event_stream(src).select("user_id", "event_id", "event_type", "value", "ts")
    n = _parallelism(spark)
    table = tables.SnapshotTable(spark, f"{root}/table", log.schema, "user_id", n)
    _finish(upsert_stream(log, table, f"{root}/checkpoint", "ts", ["event_id"]))
    return table.read()


@query
def stream_upsert_merged(src):
    """Every second event is folded into the table, the others wait beside it when it is read."""
    spark = src.spark
    root = new_run_dir(spark, "stream-upsert-merged")
    log = src("events").select(
        "user_id", "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")
    )
    base = tables.SnapshotTable(spark, f"{root}/table", log.schema, "user_id", _parallelism(spark))
    table = deltas.MergeOnReadTable(base, "ts", ["event_id"])
    for half in (0, 1):
        log.filter(F.pmod("event_id", F.lit(2)) == half).write.parquet(f"{root}/in/half={half}")
        arrived = file_stream(spark, f"{root}/in", log.schema).select(*log.columns)
        _finish(append_upserts_stream(arrived, table, f"{root}/checkpoint"))
        if half == 0:
            table.fold()
    return table.read()
