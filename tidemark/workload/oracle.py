"""DuckDB side of the workload: the same results in SQL over the same tables."""

from __future__ import annotations

from tidemark.operators.quality import SUITE

# ---- fixture views as common table expressions ------------------------------------

VIEWS = {
    "users": """
        SELECT c_custkey AS id, c_name AS name, 'user' || c_custkey AS username,
               '  User' || c_custkey || '@Example.COM ' AS email,
               '+1-555-' || c_custkey AS phone,
               'site' || c_nationkey || '.example' AS website,
               c_mktsegment AS company_name, n_name AS city,
               CAST(c_nationkey AS VARCHAR) AS zipcode,
               CAST(CAST(c_acctbal / 100 AS DECIMAL(9,6)) AS DOUBLE) AS lat,
               CAST(CAST(-c_acctbal / 200 AS DECIMAL(9,6)) AS DOUBLE) AS lng,
               TIMESTAMP '2024-01-02' + to_seconds(c_custkey) AS ingested_at
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "posts": """
        SELECT doc_id AS id, doc_id % 150 AS user_id,
               '  ' || source || ' – ' || lang || ' ' AS title, text AS body,
               TIMESTAMP '2024-01-02' + to_seconds(doc_id) AS ingested_at
        FROM documents""",
    "comments": """
        SELECT conv_id * 1000 + turn AS id, conv_id AS post_id, role AS name,
               ' ' || role || turn || '@Example.COM' AS email, text AS body,
               TIMESTAMP '2024-01-02' + to_seconds(conv_id * 1000 + turn) AS ingested_at
        FROM conversations""",
    "raw_users": """
        SELECT *, 2 AS batch_seq FROM users UNION ALL
        SELECT * REPLACE ('STALE' AS name, TIMESTAMP '2023-12-31' AS ingested_at), 1 FROM users""",
    "raw_posts": """
        SELECT *, CAST(2 AS BIGINT) AS batch_seq FROM posts UNION ALL
        SELECT * REPLACE ('STALE' AS title, TIMESTAMP '2023-12-31' AS ingested_at), 1 FROM posts""",
    "raw_comments": """
        SELECT *, 2 AS batch_seq FROM comments UNION ALL
        SELECT * REPLACE ('STALE' AS name, TIMESTAMP '2023-12-31' AS ingested_at), 1
        FROM comments""",
    "stg_users": """
        SELECT id AS user_id, name AS full_name, username, lower(trim(email)) AS email, phone,
               website, company_name, city, zipcode, lat, lng, ingested_at
        FROM raw_users
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) = 1""",
    "stg_posts": """
        SELECT id AS post_id, user_id, trim(title) AS title, trim(body) AS body,
               strlen(trim(title)) AS title_length, strlen(trim(body)) AS body_length,
               ingested_at
        FROM raw_posts
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) = 1""",
    "stg_comments": """
        SELECT id AS comment_id, post_id, name AS commenter_name,
               lower(trim(email)) AS commenter_email, trim(body) AS body,
               strlen(trim(body)) AS body_length, ingested_at
        FROM raw_comments
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) = 1""",
    "rel_users": """
        SELECT c_custkey AS user_id, 'user' || c_custkey AS username, c_name AS full_name,
               'user' || c_custkey || '@example.com' AS email, c_mktsegment AS company_name,
               n_name AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "rel_posts": """
        SELECT o_orderkey AS post_id, o_custkey AS user_id, o_orderpriority AS title,
               strlen(o_orderpriority) AS title_length,
               CAST(floor(o_totalprice) AS BIGINT) AS body_length
        FROM orders""",
    "rel_comments": """
        SELECT l_orderkey AS post_id, 'supp' || l_suppkey || '@example.com' AS commenter_email,
               CAST(l_quantity AS BIGINT) AS body_length
        FROM lineitem""",
    "hot_posts": """
        SELECT * REPLACE (CASE WHEN post_id % 3 = 0 THEN 1 ELSE user_id END AS user_id)
        FROM rel_posts""",
    "hot_comments": """
        SELECT CASE WHEN l_suppkey % 3 = 0 THEN (SELECT min(o_orderkey) FROM orders)
                    ELSE l_orderkey END AS post_id,
               'supp' || l_suppkey || '@example.com' AS commenter_email,
               CAST(l_quantity AS BIGINT) AS body_length
        FROM lineitem""",
    "changes": """
        SELECT user_id, ts, event_id, event_type, value,
               CASE WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op
        FROM events""",
    "watermarks": """
        SELECT event_type AS table_name, max(ts) AS last_ingested_at, max(ts) AS updated_at
        FROM events GROUP BY event_type""",
}

# Views each view is built on.
NEEDS = {
    "hot_posts": ["rel_posts"],
    "raw_users": ["users"],
    "raw_posts": ["posts"],
    "raw_comments": ["comments"],
    "stg_users": ["raw_users"],
    "stg_posts": ["raw_posts"],
    "stg_comments": ["raw_comments"],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        for needed in [*_closure(NEEDS.get(name, [])), name]:
            if needed not in out:
                out.append(needed)
    return out


def sql(body: str, *views: str, **own: str) -> str:
    """``body`` below the named views and the given extra ones."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in _closure(list(views)) if v not in own]
    parts += [f"{name} AS ({text})" for name, text in own.items()]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body


# ---- shared pieces ----------------------------------------------------------------


# Each measure is a scalar query by its own meaning, asked once per row of the mart. Nothing is
# grouped or joined beforehand, unlike in the engine under test.


def of_user(expression: str, posts: str) -> str:
    return f"(SELECT {expression} FROM {posts} AS post WHERE post.user_id = who.user_id)"


def received_by_user(expression: str, comments: str, posts: str) -> str:
    return (
        f"(SELECT {expression} FROM {comments} AS remark, {posts} AS post "
        "WHERE remark.post_id = post.post_id AND post.user_id = who.user_id)"
    )


def of_post(expression: str, comments: str) -> str:
    return f"(SELECT {expression} FROM {comments} AS remark WHERE remark.post_id = it.post_id)"


def post_measures(posts: str) -> dict[str, str]:
    return {
        "total_posts": of_user("count(*)", posts),
        "avg_post_title_length": of_user("avg(title_length)", posts),
        "avg_post_body_length": of_user("avg(body_length)", posts),
        "total_post_body_length": of_user("CAST(sum(body_length) AS BIGINT)", posts),
    }


def received_measures(comments: str, posts: str) -> dict[str, str]:
    return {
        "total_comments_received": received_by_user("count(*)", comments, posts),
        "unique_commenters": received_by_user(
            "count(DISTINCT remark.commenter_email)", comments, posts
        ),
    }


def comment_measures(comments: str) -> dict[str, str]:
    return {
        "total_comments": of_post("count(*)", comments),
        "unique_commenter_emails": of_post("count(DISTINCT commenter_email)", comments),
        "avg_comment_length": of_post("avg(body_length)", comments),
        "min_comment_length": of_post("min(body_length)", comments),
        "max_comment_length": of_post("max(body_length)", comments),
    }


def listed(measures: dict[str, str], filled: bool = False) -> str:
    """The measures as columns; filled: zero for nothing, averages to two decimals."""

    def value(name: str, query: str) -> str:
        if not filled:
            return query
        whole = f"coalesce({query}, 0)"
        return f"round_even({whole}, 2)" if name.startswith("avg") else whole

    return ", ".join(f"{value(name, query)} AS {name}" for name, query in measures.items())


def post_metrics(posts: str) -> str:
    return f"""SELECT user_id, {listed(post_measures(posts))}
        FROM (SELECT DISTINCT user_id FROM {posts}) AS who"""


def comments_received(comments: str, posts: str) -> str:
    return f"""SELECT * FROM (SELECT user_id, {listed(received_measures(comments, posts))}
        FROM (SELECT DISTINCT user_id FROM {posts}) AS who) WHERE total_comments_received > 0"""


def comment_metrics(comments: str) -> str:
    return f"""SELECT post_id, {listed(comment_measures(comments))}
        FROM (SELECT DISTINCT post_id FROM {comments}) AS it"""


def user_mart(users: str, posts: str, comments: str) -> str:
    measures = post_measures(posts) | received_measures(comments, posts)
    return f"""SELECT user_id, username, full_name, email, company_name, city,
        {listed(measures, filled=True)} FROM {users} AS who"""


def post_mart(posts: str, comments: str, users: str) -> str:
    known = f"(SELECT count(*) FROM {users} AS author WHERE author.user_id = it.user_id)"
    name = f"(SELECT max(username) FROM {users} AS author WHERE author.user_id = it.user_id)"
    return f"""SELECT post_id, user_id, title AS post_title,
        CASE {known} WHEN 0 THEN '' ELSE {name} END AS author_username,
        {listed(comment_measures(comments), filled=True)} FROM {posts} AS it"""


STAGED = ("stg_users", "stg_posts", "stg_comments")
USER_MART = user_mart(*STAGED)
POST_MART = post_mart("stg_posts", "stg_comments", "stg_users")

FLAT_USERS = """
    SELECT id, name, username, nullif(lower(trim(email)), '') AS email, phone, website,
           company_name, city, zipcode, lat, CASE WHEN lng >= 0 THEN lng END AS lng,
           TIMESTAMP '2024-02-01' AS ingested_at
    FROM users"""

UPSERTED = """
    SELECT id, name, balance FROM batch
    UNION ALL
    SELECT c_custkey, c_name, c_acctbal FROM customer
    WHERE c_custkey NOT IN (SELECT id FROM batch)"""
UPSERT_BATCH = """
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
    UNION ALL
    SELECT -s_suppkey - 1, s_name, s_acctbal FROM supplier"""


def _suite_sql() -> str:
    def failures(c) -> str:
        if c.kind == "not_null":
            return f"(SELECT count(*) FROM {c.model} WHERE {c.column} IS NULL)"
        if c.kind == "unique":
            return (
                f"(SELECT count(*) FROM (SELECT {c.column} FROM {c.model} "
                f"WHERE {c.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
            )
        return (
            f"(SELECT count(*) FROM {c.model} WHERE {c.column} IS NOT NULL "
            f"AND {c.column} NOT IN (SELECT {c.field} FROM {c.to}))"
        )

    rows = "\nUNION ALL\n".join(
        f"SELECT '{c.name}' AS test, {failures(c)} AS failures" for c in SUITE
    )
    return (
        "SELECT test, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
        f"FROM ({rows})"
    )


RECONCILED = """
    SELECT table_name, source_rows, target_rows,
           CASE WHEN source_rows = target_rows THEN 'PASS' ELSE 'FAIL' END AS status
    FROM (
        SELECT 'users' AS table_name, (SELECT count(*) FROM users) AS source_rows,
               (SELECT count(DISTINCT id) FROM raw_users) AS target_rows
        UNION ALL
        SELECT 'posts', (SELECT count(*) FROM posts),
               (SELECT count(DISTINCT id) FROM raw_posts)
        UNION ALL
        SELECT 'comments',
               (SELECT CAST(sum(CASE WHEN name = 'assistant' THEN 2 ELSE 1 END) AS BIGINT) FROM comments),
               (SELECT count(DISTINCT id) FROM raw_comments))"""

CHANGED_CUSTOMERS = sql(
    """SELECT user_id, event_type, value FROM last WHERE op <> 'D'
       UNION ALL
       SELECT c_custkey, 'seed', c_acctbal FROM customer
       WHERE c_custkey NOT IN (SELECT user_id FROM last)""",
    "changes",
    last="""SELECT * FROM changes QUALIFY row_number() OVER
            (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)

BASE_TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation "
    "orders pages part region supplier"
).split()

COLUMNS = "event_id, user_id, event_type, value, ts"

ORACLE: dict[str, str] = {
    # sources
    "src_json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "payload_shape": """
        SELECT event_type IN ('click', 'view') AS is_array, count(*) AS payloads
        FROM events GROUP BY 1""",
    "registry_counts": sql(
        """SELECT 'users' AS table_name, count(*) AS rows, count(email) AS filled,
                  CAST(sum(strlen(name)) AS BIGINT) AS name_bytes FROM users UNION ALL
           SELECT 'posts', count(*), count(body), CAST(sum(strlen(title)) AS BIGINT) FROM posts
           UNION ALL
           SELECT 'comments', count(*), count(email), CAST(sum(strlen(body)) AS BIGINT)
           FROM comments""",
        "users",
        "posts",
        "comments",
    ),
    "json_flatten_posts": sql(
        """SELECT id, user_id, title, body, TIMESTAMP '2024-02-01' AS ingested_at FROM posts""",
        "posts",
    ),
    "json_flatten_comments": sql(
        """SELECT id, post_id, name, nullif(lower(trim(email)), '') AS email, body,
                  TIMESTAMP '2024-02-01' AS ingested_at FROM comments""",
        "comments",
    ),
    "json_flatten": sql(FLAT_USERS, "users"),
    "ingest_users": sql(FLAT_USERS, "users"),
    "incremental_read": f"SELECT {COLUMNS} FROM events WHERE ts > TIMESTAMP '2024-01-05'",
    "scan_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in BASE_TABLES
    ),
    # scalar functions
    "rename_columns": """
        SELECT c_custkey AS user_id, c_name AS full_name, c_acctbal AS balance FROM customer""",
    "cast_required_int": """
        SELECT CAST(' ' || doc_id || ' ' AS BIGINT) AS id, n_chars FROM documents""",
    "uint32_keys": """
        SELECT CAST(CAST(o_orderkey AS UINTEGER) AS BIGINT) AS post_id,
               CAST(CAST(o_custkey AS UINTEGER) AS BIGINT) AS user_id
        FROM orders""",
    "parse_optional_float": """
        SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
        FROM customer""",
    "decimal_quantise": """
        SELECT c_custkey, CAST(CAST(c_acctbal / 70 AS DECIMAL(9,6)) AS DOUBLE) AS lat
        FROM customer""",
    "normalise_email": """
        SELECT c_custkey,
               nullif(lower(regexp_replace(x, '^\\s+|\\s+$', '', 'g')), '') AS email
        FROM (SELECT c_custkey,
                     CASE WHEN c_acctbal < 0 THEN ' ' || chr(9) || chr(10)
                          ELSE chr(9) || ' User' || c_custkey || '@Example.COM ' || chr(10)
                     END AS x
              FROM customer)""",
    "byte_length": """
        SELECT doc_id, strlen(trim('  ' || text || chr(10) || ' ')) AS trimmed_bytes,
               strlen('  ' || text || chr(10) || ' ') AS raw_bytes
        FROM documents""",
    "ts_millis": "SELECT event_id, date_trunc('millisecond', ts) AS version FROM events",
    "round_half_even": """
        SELECT l_orderkey, round_even(avg(l_quantity), 2) AS avg_quantity
        FROM lineitem GROUP BY l_orderkey""",
    "defaults_fill": """
        SELECT event_type AS table_name,
               CASE WHEN event_type <> 'error' THEN ts ELSE TIMESTAMP '1970-01-01' END
                   AS last_ingested_at,
               ts AS updated_at
        FROM events""",
    # watermark state
    "watermark_get": sql(
        """SELECT 'click' AS table_name,
                  coalesce(max(last_ingested_at), TIMESTAMP '1970-01-01') AS last_ingested_at
           FROM watermarks WHERE table_name = 'click'
           UNION ALL
           SELECT 'not_there',
                  coalesce(max(last_ingested_at), TIMESTAMP '1970-01-01')
           FROM watermarks WHERE table_name = 'not_there'""",
        "watermarks",
    ),
    "watermark_seed": sql(
        """SELECT table_name, last_ingested_at FROM watermarks
           UNION ALL
           SELECT s, TIMESTAMP '1970-01-01'
           FROM (VALUES ('click'), ('users'), ('posts'), ('comments')) AS seeds(s)
           WHERE s NOT IN (SELECT table_name FROM watermarks)""",
        "watermarks",
    ),
    "watermark_advance": sql(
        """SELECT table_name, last_ingested_at FROM watermarks WHERE table_name <> 'click'
           UNION ALL
           SELECT t, (SELECT max(ts) FROM events)
           FROM (VALUES ('click'), ('events')) AS moved(t)""",
        "watermarks",
    ),
    "watermark_state": sql("SELECT * FROM watermarks ORDER BY table_name", "watermarks"),
    # latest per key
    "latest_per_key": sql(
        """SELECT * FROM changes QUALIFY row_number() OVER
           (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "changes",
    ),
    "latest_max_by": sql(
        """SELECT user_id, arg_max(event_id, ts) AS event_id,
                  arg_max(event_type, ts) AS event_type, arg_max(value, ts) AS value
           FROM changes GROUP BY user_id""",
        "changes",
    ),
    "final_read": sql(
        """SELECT id, post_id, name, email, ingested_at FROM raw_comments
           QUALIFY row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC) = 1""",
        "raw_comments",
    ),
    "final_count": sql(
        """SELECT 'users' AS table_name, count(DISTINCT id) AS rows FROM raw_users UNION ALL
           SELECT 'posts', count(DISTINCT id) FROM raw_posts UNION ALL
           SELECT 'comments', count(DISTINCT id) FROM raw_comments""",
        "raw_users",
        "raw_posts",
        "raw_comments",
    ),
    "landing_compact": sql("SELECT *, CAST(2 AS BIGINT) AS batch_seq FROM posts", "posts"),
    "latest_ties": sql(
        "SELECT count(DISTINCT id) AS keys, CAST(0 AS BIGINT) AS differing FROM posts", "posts"
    ),
    "landing_published": sql("SELECT * FROM posts", "posts"),
    # aggregates and joins
    "agg_by_user": sql(post_metrics("rel_posts"), "rel_posts"),
    "agg_by_post": sql(comment_metrics("rel_comments"), "rel_comments"),
    "agg_count_distinct": """
        SELECT l_partkey, count(DISTINCT l_suppkey) AS suppliers
        FROM lineitem GROUP BY l_partkey""",
    "join_inner_agg": sql(
        comments_received("rel_comments", "rel_posts"), "rel_comments", "rel_posts"
    ),
    "join_left_fill": sql(
        "SELECT post_id, user_id, "
        + ", ".join(
            f"coalesce({query}, 0) AS {name}"
            for name, query in comment_measures("rel_comments").items()
        )
        + " FROM rel_posts AS it",
        "rel_comments",
        "rel_posts",
    ),
    "join_lookup": sql(
        """SELECT p.post_id, p.user_id, p.title, coalesce(c.c_name, '') AS author
           FROM rel_posts p LEFT JOIN customer c
           ON p.user_id = c.c_custkey AND c.c_acctbal >= 0""",
        "rel_posts",
    ),
    "join_orphans": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    # staging and marts
    "stg_users": sql("SELECT * FROM stg_users", "stg_users"),
    "stg_posts": sql("SELECT * FROM stg_posts", "stg_posts"),
    "stg_comments": sql("SELECT * FROM stg_comments", "stg_comments"),
    "mart_user_post_summary": sql(USER_MART, *STAGED),
    "mart_comment_statistics": sql(POST_MART, *STAGED),
    "mart_user_post_summary_rel": sql(
        user_mart("rel_users", "rel_posts", "rel_comments"),
        "rel_users",
        "rel_posts",
        "rel_comments",
    ),
    "mart_comment_statistics_rel": sql(
        post_mart("rel_posts", "rel_comments", "rel_users"),
        "rel_users",
        "rel_posts",
        "rel_comments",
    ),
    "mart_user_post_summary_hot": sql(
        user_mart("rel_users", "hot_posts", "hot_comments"),
        "rel_users",
        "hot_posts",
        "hot_comments",
    ),
    "mart_comment_statistics_hot": sql(
        post_mart("hot_posts", "hot_comments", "rel_users"),
        "rel_users",
        "hot_posts",
        "hot_comments",
    ),
    "topk_users": sql(
        f"""SELECT user_id, username, total_posts, total_comments_received, unique_commenters
            FROM ({USER_MART}) ORDER BY total_comments_received DESC, user_id LIMIT 5""",
        *STAGED,
    ),
    "topk_posts": sql(
        f"""SELECT post_id, author_username, total_comments, avg_comment_length
            FROM ({POST_MART}) ORDER BY total_comments DESC, post_id LIMIT 5""",
        *STAGED,
    ),
    "validation_report": sql(
        f"""SELECT 'raw' AS layer, 'users' AS table_name, count(*) AS rows FROM users UNION ALL
            SELECT 'raw', 'posts', count(*) FROM posts UNION ALL
            SELECT 'raw', 'comments', count(*) FROM comments UNION ALL
            SELECT 'staging', 'stg_users', count(*) FROM stg_users UNION ALL
            SELECT 'staging', 'stg_posts', count(*) FROM stg_posts UNION ALL
            SELECT 'staging', 'stg_comments', count(*) FROM stg_comments UNION ALL
            SELECT 'marts', 'mart_user_post_summary', count(*) FROM ({USER_MART}) UNION ALL
            SELECT 'marts', 'mart_comment_statistics', count(*) FROM ({POST_MART})""",
        *STAGED,
    ),
    "publish_mart": sql(POST_MART, *STAGED),
    "sorted_layout": """
        SELECT count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
               CAST(0 AS BIGINT) AS overlaps
        FROM orders""",
    # data quality
    "dq_not_null": "SELECT event_id, user_id FROM events WHERE event_type = 'error'",
    "dq_unique": """
        SELECT l_orderkey || '-' || l_linenumber AS line, count(*) AS n_records
        FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "dq_relationships": """
        SELECT o_custkey, count(*) AS n_records FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
        GROUP BY o_custkey""",
    "dq_suite": sql(
        _suite_sql(),
        "users",
        "posts",
        "comments",
        "raw_users",
        "stg_posts",
        "raw_comments",
        known="""
            SELECT * REPLACE (CASE WHEN company_name <> 'BUILDING' THEN email END AS email,
                              CASE WHEN lat < 0 THEN id + 2000000000 ELSE id END AS id)
            FROM raw_users""",
        stg_users=VIEWS["stg_users"].replace("raw_users", "known"),
        once=VIEWS["stg_comments"],
        stg_comments="""
            SELECT * FROM once UNION ALL
            SELECT * FROM once WHERE commenter_name = 'user'""",
        mart_user_post_summary=USER_MART,
        mart_comment_statistics=POST_MART,
    ),
    "reconcile_counts": sql(RECONCILED, "raw_users", "raw_posts", "raw_comments"),
    "failing_checks": sql(
        f"SELECT * FROM ({RECONCILED}) WHERE status = 'FAIL'",
        "raw_users",
        "raw_posts",
        "raw_comments",
    ),
    "expected_counts": """
        SELECT table_name, rows, expected_rows,
               CASE WHEN rows = expected_rows THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (
            SELECT 'customer' AS table_name, count(*) AS rows,
                   count(DISTINCT c_custkey) AS expected_rows FROM customer
            UNION ALL
            SELECT 'orders', count(*), count(DISTINCT o_orderkey) FROM orders
            UNION ALL
            SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem)""",
    # writes
    "insert_ignore_repeats": sql(
        """SELECT c_custkey AS id FROM customer UNION
           SELECT s_suppkey FROM supplier UNION SELECT -s_suppkey - 1 FROM supplier"""
    ),
    "upsert_rebucketed": sql(UPSERTED, batch=UPSERT_BATCH),
    "dated_two_loads": "SELECT event_id, event_type, ts FROM events",
    "ttl_rewrite": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-24'",
    "upsert_replace": sql(UPSERTED, batch=UPSERT_BATCH),
    "upsert_buckets": sql(UPSERTED, batch=UPSERT_BATCH),
    "replicate_batch": sql("SELECT * FROM raw_posts", "raw_posts"),
    "replicate_by_stamp": sql("SELECT * FROM raw_posts", "raw_posts"),
    "cdc_apply": CHANGED_CUSTOMERS,
    "cdc_out_of_order": CHANGED_CUSTOMERS,
    "mart_incremental": sql(POST_MART, *STAGED),
    "mart_user_incremental": sql(USER_MART, *STAGED),
    "mart_state_refresh": sql(POST_MART, *STAGED),
    "mart_incremental_moves": sql(
        user_mart("rel_users", "rel_posts", "rel_comments"), "rel_users", "rel_posts", "rel_comments"
    ),
    "mart_incremental_rename": sql(
        post_mart("rel_posts", "rel_comments", "rel_users"), "rel_users", "rel_posts", "rel_comments"
    ),
    "run_elt": sql(
        f"""SELECT 'users' AS mart, user_id AS id, full_name AS name, total_posts AS rows,
                   total_comments_received AS comments, unique_commenters AS people,
                   avg_post_body_length AS average
            FROM ({USER_MART})
            UNION ALL
            SELECT 'posts', post_id, post_title, max_comment_length, total_comments,
                   unique_commenter_emails, avg_comment_length
            FROM ({POST_MART})""",
        *STAGED,
    ),
    # dated lake and distribution
    "partition_prune": """
        SELECT * FROM events
        WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-20 18:00:00'""",
    "ttl_filter": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-24'",
    "distributed_join": """
        SELECT o_orderkey, o_custkey, count(*) AS lines, sum(l_quantity) AS quantity
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
    "distributed_join_hot": """
        WITH lines AS (
            SELECT CAST(CASE l_linenumber WHEN 3 THEN 1 WHEN 6 THEN 1 ELSE l_orderkey END AS BIGINT)
                       AS order_of_line, l_orderkey AS line_order, l_linenumber, l_quantity
            FROM lineitem)
        SELECT order_of_line AS o_orderkey, line_order, l_linenumber, l_quantity,
               (SELECT o_custkey FROM orders WHERE o_orderkey = order_of_line) AS o_custkey
        FROM lines""",
    # streams
    "stream_replicate": f"SELECT {COLUMNS} FROM events",
    "stream_dedup": "SELECT * FROM events",
    "stream_late": """
        SELECT *, ts < (SELECT max(ts) FROM events) - INTERVAL 10 DAY AS late FROM events""",
    "stream_upsert": """
        SELECT user_id, event_id, event_type, value, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_upsert_merged": """
        SELECT user_id, max_by(event_id, (ts, event_id)) AS event_id,
               max_by(event_type, (ts, event_id)) AS event_type,
               max_by(value, (ts, event_id)) AS value, max(ts) AS ts
        FROM events GROUP BY user_id""",
}
