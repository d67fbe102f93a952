"""Marts kept up to date from changes alone, by sums that can be taken back.

Beside the marts lie small tables of mergeable partial results, which hold everything the marts
measure:

* ``post_emails (post_id, commenter_email, n)`` and ``post_lengths (post_id, body_length, n)``:
  how many comments of a post have each e-mail and each length. They give counts, distinct
  counts, averages and, when the shortest comment goes, the next shortest.
* ``user_emails (user_id, commenter_email, n)``: the same over all posts of an author.
* ``user_posts``: counts and sums of the lengths of an author's posts.
* ``users`` and ``posts``: the current rows, without texts.

A refresh gets rows with signs: -1 for an image that is no longer true, 1 for one that is now.
Added up they are small deltas, which are added to the partial results; a value whose count
falls to zero is gone. The change of a join is the sum of two smaller ones: changed comments
meet the authors as they were, and posts that changed hands take their e-mail counts along,
which are read from ``post_emails``. No comment is read but those in the delta.

Then the mart rows of the touched keys are computed anew from the partial results of those
keys, in the buckets that hold them, and replaced. All tables become visible in one commit, so a
refresh that dies is repeated from the state before it and never counted twice.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import affected_keys
from tidemark.operators.tables import Release, SnapshotTable
from tidemark.operators.upsert import SIGN
from tidemark.plans.marts import comment_statistics_of, user_summary_of
from tidemark.schemas import FEED_MARK, MARTS, STAGING
from tidemark.session import at_once, few_rows, materialise

USERS = ("user_id", "username", "full_name", "email", "company_name", "city")
POSTS = ("post_id", "user_id", "title", "title_length", "body_length")
COMMENTS = ("comment_id", "post_id", "commenter_email", "body_length")

POST_SUMS = ("n", "titles", "title_bytes", "bodies", "body_bytes")


def _schema(longs: str, text: str | None = None) -> T.StructType:
    named = [(c, T.LongType()) for c in longs.split()]
    if text:
        named.insert(1, (text, T.StringType()))
    return T.StructType([T.StructField(name, kind) for name, kind in named])


def _narrow(model: str, columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([STAGING[model][c] for c in columns])


#: Key and columns of each table; the counts have more than one row per key. ``feeds`` says up
#: to which version of each source table the state has taken in its change feed.
TABLES = {
    "users": ("user_id", _narrow("stg_users", USERS)),
    "posts": ("post_id", _narrow("stg_posts", POSTS)),
    "post_emails": ("post_id", _schema("post_id n", "commenter_email")),
    "post_lengths": ("post_id", _schema("post_id body_length n")),
    "user_emails": ("user_id", _schema("user_id n", "commenter_email")),
    "user_posts": ("user_id", _schema(" ".join(["user_id", *POST_SUMS]))),
    "feeds": ("table_name", FEED_MARK),
    "mart_user_post_summary": ("user_id", MARTS["mart_user_post_summary"]),
    "mart_comment_statistics": ("post_id", MARTS["mart_comment_statistics"]),
}


def signed(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Rows that become true (1) or are no longer true (-1)."""
    return rows.withColumn(SIGN, F.lit(sign))


def _counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.sum(SIGN).alias("n"))


def _post_sums(posts: DataFrame) -> DataFrame:
    """Signed counts and sums per author, as :class:`SnapshotTable` adds them up."""

    def total(column: str):
        return F.coalesce(F.sum(F.col(column) * F.col(SIGN)), F.lit(0))

    def present(column: str):
        return F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col(SIGN))), F.lit(0))

    return posts.groupBy("user_id").agg(
        F.sum(SIGN).alias("n"),
        present("title_length").alias("titles"),
        total("title_length").alias("title_bytes"),
        present("body_length").alias("bodies"),
        total("body_length").alias("body_bytes"),
    )


def _mean(total, count):
    return F.when(count > 0, total / count)


def posted_from(sums: DataFrame) -> DataFrame:
    """Measures of :func:`tidemark.operators.aggregates.post_metrics` from partial results."""
    return sums.select(
        "user_id",
        F.col("n").alias("total_posts"),
        _mean(F.col("title_bytes"), F.col("titles")).alias("avg_post_title_length"),
        _mean(F.col("body_bytes"), F.col("bodies")).alias("avg_post_body_length"),
        F.when(F.col("bodies") > 0, F.col("body_bytes")).alias("total_post_body_length"),
    )


def received_from(emails: DataFrame) -> DataFrame:
    """Measures of ``comments_received`` from counted e-mails; null ones are not distinct."""
    return emails.groupBy("user_id").agg(
        F.sum("n").alias("total_comments_received"),
        F.count("commenter_email").alias("unique_commenters"),
    )


def comment_metrics_from(emails: DataFrame, lengths: DataFrame) -> DataFrame:
    """Measures of ``comment_metrics`` from counted e-mails and lengths."""
    # One aggregation for both: a row of either table leaves the other's columns empty, and
    # only sums of one row per post are shuffled, sorted and joined from here on.
    people = emails.select(
        "post_id", "n", F.col("commenter_email").isNotNull().cast("long").alias("person")
    )
    known = F.when(F.col("body_length").isNotNull(), F.col("n"))
    total = (F.col("body_length") * F.col("n")).alias("bytes")
    sizes = lengths.select("post_id", "body_length", known.alias("sized"), total)
    both = people.unionByName(sizes, allowMissingColumns=True).groupBy("post_id")
    return both.agg(
        F.sum("n").alias("total_comments"),
        F.sum("person").alias("unique_commenter_emails"),
        _mean(F.sum("bytes"), F.sum("sized")).alias("avg_comment_length"),
        F.min("body_length").alias("min_comment_length"),
        F.max("body_length").alias("max_comment_length"),
    )


class MartState:
    """Both marts and the partial results under ``root``, refreshed together.

    Values that differ but share a name by mistake cannot cancel: a negative count fails the
    refresh, and nothing of it becomes visible.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.tables = {
            name: SnapshotTable(spark, f"{root}/{name}", schema, key, None if name == "feeds" else buckets)
            for name, (key, schema) in TABLES.items()
        }
        self.release = Release(spark, f"{root}/releases", self.tables)
        self.candidates = Release(spark, f"{root}/candidates", self.tables)
        self.release.pin()

    def read(self, name: str) -> DataFrame:
        return self.tables[name].read()

    def feeds(self) -> dict[str, int]:
        """Version of each source table up to which changes were taken in."""
        return {r["table_name"]: r["version"] for r in self.read("feeds").collect()}

    def publish(
        self, marts: dict[str, DataFrame], check: Check | None = None, visible: bool = True
    ) -> int:
        """Both marts as built elsewhere, without partial results to go on from."""
        self.release.pin()
        for name, mart in marts.items():
            self.tables[name].publish(mart, sort_key=TABLES[name][0])
        self.tables["feeds"].publish(self.spark.createDataFrame([], FEED_MARK))
        return self._commit(check, visible)

    def load(
        self,
        users: DataFrame,
        posts: DataFrame,
        comments: DataFrame,
        built_at: datetime | None = None,
        check: Check | None = None,
        feeds: dict[str, int] | None = None,
        visible: bool = True,
    ) -> int:
        """Build everything from staged rows; returns the number of the release.

        ``feeds`` are the versions of the source tables that the rows show.
        """
        self.release.pin()
        t = self.tables
        self._note(feeds)
        now = signed(comments.select(*COMMENTS))
        at_once(
            lambda: t["users"].publish(users.select(*USERS)),
            lambda: t["posts"].publish(posts.select(*POSTS)),
            lambda: t["post_emails"].publish(_counts(now, "post_id", "commenter_email")),
            lambda: t["post_lengths"].publish(_counts(now, "post_id", "body_length")),
        )
        authors = t["posts"].read().select("post_id", "user_id")
        by_author = t["post_emails"].read().join(authors, "post_id")
        received = by_author.groupBy("user_id", "commenter_email").agg(F.sum("n").alias("n"))
        at_once(
            lambda: t["user_emails"].publish(received),
            lambda: t["user_posts"].publish(_post_sums(signed(t["posts"].read()))),
            lambda: t["mart_comment_statistics"].publish(self._posts(self.read, built_at)),
        )
        t["mart_user_post_summary"].publish(self._users(self.read, built_at))
        return self._commit(check, visible)

    def refresh(
        self,
        users: DataFrame | None = None,
        posts: DataFrame | None = None,
        comments: DataFrame | None = None,
        built_at: datetime | None = None,
        check: Check | None = None,
        feeds: dict[str, int] | None = None,
        visible: bool = True,
    ) -> int:
        """Apply signed changes of staged rows; returns the number of the release.

        Changes of the same key may span several versions: their images in between cancel.
        ``check`` is called before anything becomes visible and stops the refresh by raising.
        With ``visible=False`` the result waits for :meth:`publish_candidate`.
        """
        self.release.pin()
        t = self.tables
        self._note(feeds)
        du, dp, dc = at_once(
            lambda: self._change("users", USERS, users),
            lambda: self._change("posts", POSTS, posts),
            lambda: self._change("comments", COMMENTS, comments),
        )

        # Authors before and after; equal ones cancel, so what is left changed hands.
        authored = dp.groupBy("post_id", "user_id").agg(F.sum(SIGN).alias(SIGN))
        counted = _counts(dc, "post_id", "commenter_email").filter("n <> 0")
        moved, emails = at_once(
            lambda: materialise(authored.filter(F.col(SIGN) != 0), "moved-posts"),
            lambda: materialise(counted, "emails"),
        )
        authors = t["posts"].read_buckets_of(emails).select("post_id", "user_id")
        by_author = emails.join(authors, "post_id").select("user_id", "commenter_email", "n")
        sizes = _counts(dc, "post_id", "body_length")
        at_once(
            lambda: t["post_emails"].add(emails, ["post_id", "commenter_email"], "n", net=True),
            lambda: t["post_lengths"].add(sizes, ["post_id", "body_length"], "n"),
        )
        taken_along = (
            t["post_emails"]
            .read_buckets_of(moved)
            .join(moved, "post_id")
            .select("user_id", "commenter_email", (F.col("n") * F.col(SIGN)).alias("n"))
        )
        received = materialise(
            by_author.unionByName(taken_along)
            .groupBy("user_id", "commenter_email")
            .agg(F.sum("n").alias("n"))
            .filter("n <> 0"),
            "received",
        )
        renamed = (
            du.groupBy("user_id", "username")
            .agg(F.sum(SIGN).alias(SIGN))
            .filter(F.col(SIGN) != 0)
            .select("user_id")
            .distinct()
        )
        at_once(
            lambda: t["user_emails"].add(received, ["user_id", "commenter_email"], "n", net=True),
            lambda: t["user_posts"].add(_post_sums(dp), ["user_id"], "n"),
            lambda: self._replace("users", du),
            lambda: self._replace("posts", dp),
        )

        # Posts of renamed users: the narrow posts table is the only one searched by author.
        named = t["posts"].read().join(renamed, "user_id", "left_semi")
        touched_posts, touched_users = at_once(
            lambda: materialise(affected_keys("post_id", dc, dp, named), "touched-posts"),
            lambda: materialise(affected_keys("user_id", du, dp, received), "touched-users"),
        )

        # Only the narrow rows are cut to the touched keys. Partial results are added up first
        # and meet those in the left joins of the marts: one row per key is sorted, not all.
        def of(keys: DataFrame, rows: str) -> Callable[[str], DataFrame]:
            def read(name: str) -> DataFrame:
                return t[name].read_keys(keys) if name == rows else t[name].read_buckets_of(keys)

            return read

        def users_mart() -> None:
            rows = self._users(of(touched_users, "users"), built_at)
            t["mart_user_post_summary"].replace_keys(touched_users, rows)

        def posts_mart() -> None:
            of_posts = of(touched_posts, "posts")
            authors = t["users"].read_keys(of_posts("posts").select("user_id"))
            rows = self._posts(of_posts, built_at, authors)
            t["mart_comment_statistics"].replace_keys(touched_posts, rows)

        at_once(users_mart, posts_mart)
        return self._commit(check, visible)

    def _change(self, name: str, columns: tuple[str, ...], rows: DataFrame | None) -> DataFrame:
        """A delta in its narrow form, written down; images that cancel are gone."""
        if rows is None:
            schema = _narrow(f"stg_{name}", columns).add(SIGN, "long")
            return self.spark.createDataFrame([], schema)
        net = rows.groupBy(*columns).agg(F.sum(SIGN).cast("long").alias(SIGN))
        return materialise(net.filter(F.col(SIGN) != 0), f"delta-{name}")

    def _replace(self, name: str, delta: DataFrame) -> None:
        """Current rows after a delta: those with a positive sign, or none for their key."""
        key = TABLES[name][0]
        self.tables[name].replace_keys(delta.select(key), delta.filter(F.col(SIGN) > 0))

    def _users(self, read: Callable[[str], DataFrame], built_at: datetime | None) -> DataFrame:
        posted, received = posted_from(read("user_posts")), received_from(read("user_emails"))
        return user_summary_of(read("users"), posted, received, built_at)

    def _posts(
        self,
        read: Callable[[str], DataFrame],
        built_at: datetime | None,
        users: DataFrame | None = None,
    ) -> DataFrame:
        metrics = comment_metrics_from(read("post_emails"), read("post_lengths"))
        users = read("users") if users is None else users
        return comment_statistics_of(read("posts"), metrics, users, built_at)

    def _note(self, feeds: dict[str, int] | None) -> None:
        if feeds is not None:
            self.tables["feeds"].publish(few_rows(self.spark, list(feeds.items()), FEED_MARK))

    def _commit(self, check: Check | None, visible: bool) -> int:
        """Name what was written as a whole, then check it, then show it."""
        self.candidates.commit()
        if check:
            check(self)
        return self.release.commit() if visible else 0

    def pin_candidate(self) -> None:
        """Read and show what the last complete build wrote, visible or not."""
        self.candidates.pin()

    def publish_candidate(self, check: Check | None = None) -> int:
        """Check and show the last complete build; one that died halfway is none."""
        self.pin_candidate()
        if check:
            check(self)
        return self.release.commit()


#: Looks at a state before it becomes visible, and raises to stop that.
Check = Callable[[MartState], None]
