"""One declaration per entity and layer."""

from __future__ import annotations

from pyspark.sql import types as T

STRING = T.StringType()
LONG = T.LongType()
DOUBLE = T.DoubleType()
TIMESTAMP = T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# Nested records as they arrive. Keys are read as text so that both 7 and "7" reach
# the required-integer check; fields that are not named are dropped by the reader.
PAYLOAD = {
    "users": _struct(
        id=STRING,
        name=STRING,
        username=STRING,
        email=STRING,
        phone=STRING,
        website=STRING,
        company=_struct(name=STRING),
        address=_struct(
            city=STRING,
            zipcode=STRING,
            geo=_struct(lat=STRING, lng=STRING),
        ),
    ),
    "posts": _struct(id=STRING, userId=STRING, title=STRING, body=STRING),
    "comments": _struct(id=STRING, postId=STRING, name=STRING, email=STRING, body=STRING),
}

_COORDINATE = T.DecimalType(9, 6)


def _users(coordinate: T.DataType) -> T.StructType:
    return _struct(
        id=LONG,
        name=STRING,
        username=STRING,
        email=STRING,
        phone=STRING,
        website=STRING,
        company_name=STRING,
        city=STRING,
        zipcode=STRING,
        lat=coordinate,
        lng=coordinate,
        ingested_at=TIMESTAMP,
    )


_POSTS = _struct(id=LONG, user_id=LONG, title=STRING, body=STRING, ingested_at=TIMESTAMP)
_COMMENTS = _struct(
    id=LONG, post_id=LONG, name=STRING, email=STRING, body=STRING, ingested_at=TIMESTAMP
)

OLTP = {"users": _users(_COORDINATE), "posts": _POSTS, "comments": _COMMENTS}
LANDING = {"users": _users(DOUBLE), "posts": _POSTS, "comments": _COMMENTS}

# Partition column of a landing table: the sequence number of the appended batch.
BATCH_SEQ = "batch_seq"
# Hash of a landing row's content, stored with it: settles equal versions of one batch.
ROW_HASH = "row_hash"
#: Columns of a landing table that are not the entity's own.
LANDING_MARKS = (BATCH_SEQ, ROW_HASH)

WATERMARK = _struct(table_name=STRING, last_ingested_at=TIMESTAMP, updated_at=TIMESTAMP)
FEED_MARK = _struct(table_name=STRING, version=LONG)

STAGING = {
    "stg_users": _struct(
        user_id=LONG,
        full_name=STRING,
        username=STRING,
        email=STRING,
        phone=STRING,
        website=STRING,
        company_name=STRING,
        city=STRING,
        zipcode=STRING,
        lat=DOUBLE,
        lng=DOUBLE,
        ingested_at=TIMESTAMP,
    ),
    "stg_posts": _struct(
        post_id=LONG,
        user_id=LONG,
        title=STRING,
        body=STRING,
        title_length=LONG,
        body_length=LONG,
        ingested_at=TIMESTAMP,
    ),
    "stg_comments": _struct(
        comment_id=LONG,
        post_id=LONG,
        commenter_name=STRING,
        commenter_email=STRING,
        body=STRING,
        body_length=LONG,
        ingested_at=TIMESTAMP,
    ),
}

MARTS = {
    "mart_user_post_summary": _struct(
        user_id=LONG,
        username=STRING,
        full_name=STRING,
        email=STRING,
        company_name=STRING,
        city=STRING,
        total_posts=LONG,
        total_comments_received=LONG,
        unique_commenters=LONG,
        avg_post_title_length=DOUBLE,
        avg_post_body_length=DOUBLE,
        total_post_body_length=LONG,
        built_at=TIMESTAMP,
    ),
    "mart_comment_statistics": _struct(
        post_id=LONG,
        user_id=LONG,
        author_username=STRING,
        post_title=STRING,
        total_comments=LONG,
        unique_commenter_emails=LONG,
        avg_comment_length=DOUBLE,
        min_comment_length=LONG,
        max_comment_length=LONG,
        built_at=TIMESTAMP,
    ),
}


def with_marks(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField(c, LONG, True) for c in LANDING_MARKS])
