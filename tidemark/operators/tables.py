"""Written tables: append-only landing, published snapshots, sorted and dated layouts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import timestamp_literal
from tidemark.operators.latest import latest_per_key
from tidemark.operators.upsert import (
    BEFORE,
    CHANGED,
    SIGN,
    by_partition,
    merge_partitioned,
    one_row_per_key,
    upsert,
)
from tidemark.schemas import BATCH_SEQ, LANDING_MARKS, ROW_HASH, with_marks
from tidemark.session import few_rows, planned_bytes, remove, subfolders

#: Codec of stored rows. The test documents take 30 MB where the default codec leaves 47.
COMPRESSION = "zstd"

BUCKET = "__bucket"
VERSION = "__version"
SAME = "__same_texts"

#: Rows above this size are rewritten in passes, which bounds what is shuffled at a time. A pass
#: reads the whole batch again, so there are no more than a few.
PASS_BYTES, MOST_PASSES = 64 << 20, 8

# Inside a landing table; Spark does not list folders with such names as data.
LIVE_LIST, COMPACTED = "_live", "_compacted"
_LIVE = T.StructType(
    [
        T.StructField("switch", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("upto", T.LongType()),
    ]
)


# ---- typed rows -------------------------------------------------------------------


def typed(
    df: DataFrame,
    schema: T.StructType,
    defaults: dict[str, Column] | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Cast to the declared columns; fill defaults; fail on a null in ``not_null``."""
    defaults = defaults or {}

    def value(f: T.StructField) -> Column:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        if f.name in defaults:
            c = F.coalesce(c, defaults[f.name].cast(f.dataType))
        if f.name in not_null:
            c = F.coalesce(c, F.raise_error(F.lit(f"{f.name} is null")).cast(f.dataType))
        return c.alias(f.name)

    return df.select(*[value(f) for f in schema.fields])


def _passes(size: int, parts: int | None = None, cores: int = 1) -> int:
    """Passes for rows of ``size`` bytes; every core gets one of the ``parts`` in each."""
    wanted = min(MOST_PASSES, -(-size // PASS_BYTES))
    return max(1, wanted if parts is None else min(wanted, parts // cores))


# ---- landing ----------------------------------------------------------------------


def append_landing(df: DataFrame, path: str, columns: Sequence[str], batch_seq: int) -> str:
    """Append one batch of versions in fixed column order.

    Each batch has its own partition directory, so writing the same batch again (a
    retry, a replayed micro-batch) replaces it and never doubles it. Every row is stored
    with a hash of its content, so that readers of any few columns settle equal versions of
    a key within the batch alike, in whatever order the rows came.
    """
    target = f"{path}/{BATCH_SEQ}={batch_seq}"
    hashed = F.xxhash64(*[F.col(c) for c in columns]).alias(ROW_HASH)
    df.select(*columns, hashed).write.mode("overwrite").parquet(target, compression=COMPRESSION)
    return target


def _live_batches(spark: SparkSession, path: str) -> tuple[int, str, int]:
    """Number of compactions, folder of the last one, and the last batch it holds."""
    try:
        switches = spark.read.schema(_LIVE).parquet(f"{path}/{LIVE_LIST}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return 0, "", 0
        raise
    newest = switches.orderBy(F.desc("switch")).first()
    return (0, "", 0) if newest is None else tuple(newest)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder of Parquet files, empty if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All live versions, with their batch number and the hash of their content.

    Those are the rows of the last compaction, if any, and all batches after it.
    """
    numbered = with_marks(schema)
    _, compacted, upto = _live_batches(spark, path)
    if not compacted:
        return spark.read.schema(numbered).parquet(path)
    folded = spark.read.schema(numbered).parquet(f"{path}/{COMPACTED}/{compacted}")
    try:
        later = spark.read.schema(numbered).parquet(path).filter(F.col(BATCH_SEQ) > upto)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":  # the storage has dropped the old batches
            return folded
        raise
    return folded.unionByName(later)


def compact_landing_in_place(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    key: str,
    version: str,
    files: int | None = None,
) -> int:
    """Fold all live batches of a landing table into one version per key, sorted by key.

    The table stays a landing table: rows keep the number of their batch, later batches are
    appended as before, and it can be folded again. The folded rows go to a fresh folder,
    and one row appended to the list of live batches makes readers switch; until then, and
    after a run that died, they read the batches. Batches up to the returned number, and
    earlier folded folders, are for the storage to drop once no reader is left.

    The newest batch number counts as seen: a batch with a smaller one that arrives later
    is not read, so numbers must grow, as those of replication do.
    """
    live = read_landing(spark, path, schema)
    upto = live.agg(F.max(BATCH_SEQ)).first()[0]
    switch, _, folded_upto = _live_batches(spark, path)
    if upto is None or (switch and upto <= folded_upto):
        return folded_upto
    folder = uuid.uuid4().hex
    passes = 1 if files else _passes(planned_bytes(live))
    for inside in _key_ranges(live, key, passes):
        kept = latest_per_key(live.filter(inside), key, version)
        folded = sorted_layout(kept.select(*schema.fieldNames(), *LANDING_MARKS), key, files)
        folded.write.mode("append").parquet(f"{path}/{COMPACTED}/{folder}", compression=COMPRESSION)
    row = few_rows(spark, [(switch + 1, folder, upto)], _LIVE)
    row.write.mode("append").parquet(f"{path}/{LIVE_LIST}")
    return upto


def _key_ranges(df: DataFrame, key: str, n: int) -> list[Column]:
    """Conditions that deal rows out to about ``n`` equal ranges of an integer key."""
    if n == 1 or not isinstance(df.schema[key].dataType, T.IntegralType):
        return [F.lit(True)]
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)])).first()[0]
    cuts = sorted(set(cuts or []))
    if not cuts:
        return [F.lit(True)]
    k = F.col(key)
    between = [(k > low) & (k <= high) for low, high in zip(cuts, cuts[1:], strict=False)]
    return [k.isNull() | (k <= cuts[0]), *between, k > cuts[-1]]


def sweep_landing(spark: SparkSession, path: str) -> None:
    """Delete the batches that the last compaction holds, and earlier compactions.

    For the writer, once no reader that began before the compaction is left.
    """
    _, compacted, upto = _live_batches(spark, path)
    if not compacted:
        return
    batches = [f for f in subfolders(spark, path) if f.startswith(f"{BATCH_SEQ}=")]
    held = [f"{path}/{f}" for f in batches if int(f.partition("=")[2]) <= upto]
    folded = [f for f in subfolders(spark, f"{path}/{COMPACTED}") if f != compacted]
    remove(spark, held + [f"{path}/{COMPACTED}/{f}" for f in folded])


def sorted_layout(df: DataFrame, key: str, files: int | None = None) -> DataFrame:
    """Range-partition and sort by ``key``: written files cover disjoint key ranges,
    so a key filter skips all files and row groups but the matching ones.

    Equal keys stay together, so use it on grain keys (one row per key).
    """
    ranged = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    return ranged.sortWithinPartitions(key)


# ---- published tables -------------------------------------------------------------


class SnapshotTable:
    """A Parquet table that is replaced as a whole or bucket by bucket.

    Data files are written under a fresh directory and become visible by appending the
    paths of all buckets, one row each, to a small commit table; nothing a reader may be
    scanning is ever overwritten, and a job that dies before the commit leaves the table as
    it was. One writer at a time is assumed. Any version that the storage still holds can
    be read; ``pinned`` (see :class:`Release`) makes one version the base of reads and
    writes, whatever was written after it.

    With ``buckets`` > 1 the rows are hashed by ``key``, and :meth:`upsert` reads and
    rewrites only the buckets the batch touches. Pick the number so that one bucket is
    around a gigabyte. The number is stored with every commit: a table that exists is
    updated with the number it was written with, whatever the caller says. Writing the
    table as a whole deals it out anew with the caller's number, if one is given.

    With ``feed=True`` an upsert also writes the rows it changed, before and after, under
    its version: :meth:`changes` reads them without touching the table.
    """

    COMMITS = T.StructType(
        [
            T.StructField("version", T.LongType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("path", T.StringType()),
            T.StructField("buckets", T.IntegerType()),
            T.StructField("fed", T.BooleanType()),
        ]
    )

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str | None = None,
        buckets: int | None = None,
    ):
        if (buckets or 1) > 1 and key is None:
            raise ValueError("a bucketed table needs a key")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = key
        self.wanted_buckets = buckets
        self.buckets = buckets or 1
        self.pinned: int | None = None
        # Buckets and paths by version: what is committed never changes.
        self._known: dict[int, tuple[int, dict[int, str]]] = {0: (self.buckets, {})}

    # -- commit table: per version one path for each bucket

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.COMMITS).parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _newest(self) -> int:
        commits = self._commits()
        return 0 if commits is None else commits.agg(F.max("version")).first()[0] or 0

    def _live(self, version: int | None = None) -> tuple[int, dict[int, str]]:
        """A version, the pinned or else the newest one, and the path of each bucket.

        Takes over the number of buckets of that version.
        """
        if version is None:
            version = self._newest() if self.pinned is None else self.pinned
        if version not in self._known:
            rows = self._commits().filter(F.col("version") == version).collect()
            if not rows:
                raise ValueError(f"{self.path} has no version {version}")
            self._known[version] = (
                rows[0]["buckets"],
                {r["bucket"]: r["path"] for r in rows if r["path"]},
            )
        buckets, live = self._known[version]
        if version:
            self.buckets = buckets
        return version, live

    def _last_written(self, base: int) -> int:
        """The newest version, released or not; ``base`` is the one that was read."""
        return base if self.pinned is None else self._newest()

    def _commit(self, last: int, paths: dict[int, str], fed: bool = False) -> int:
        version = last + 1
        rows = [(version, b, paths.get(b, ""), self.buckets, fed) for b in range(self.buckets)]
        few_rows(self.spark, rows, self.COMMITS).write.mode("append").parquet(f"{self.path}/commits")
        self._known[version] = (self.buckets, {b: path for b, path in paths.items() if path})
        if self.pinned is not None:
            self.pinned = version
        return version

    def _bucket(self) -> Column:
        if self.buckets == 1:
            return F.lit(0)
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, sort_key: str | None, files: int | None) -> str:
        """Write the rows under a fresh directory and return it."""
        data = f"{self.path}/data/{uuid.uuid4().hex}"
        rows = df.select(*self.schema.fieldNames())
        if self.buckets == 1:
            if sort_key:
                rows = sorted_layout(rows, sort_key, files)
            rows.write.parquet(data, compression=COMPRESSION)
        else:
            placed = rows.withColumn(BUCKET, self._bucket()).repartitionById(
                self.buckets, F.col(BUCKET)
            )
            self._write_buckets(placed.sortWithinPartitions(BUCKET, sort_key or self.key), data)
        return data

    def _write_buckets(self, placed: DataFrame, data: str) -> None:
        if self.buckets == 1:
            placed.drop(BUCKET).write.parquet(data, compression=COMPRESSION)
        else:
            to = placed.write.mode("append").partitionBy(BUCKET)
            to.parquet(data, compression=COMPRESSION)

    def _paths(self, data: str) -> dict[int, str]:
        """Paths of the buckets that have rows in a written directory."""
        if self.buckets == 1:
            return {0: data}
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        found = self.spark.read.schema(schema).parquet(data).select(BUCKET).distinct()
        return {r[BUCKET]: f"{data}/{BUCKET}={r[BUCKET]}" for r in found.collect()}

    def exists(self) -> bool:
        return self._commits() is not None

    def version(self) -> int:
        return self._newest() if self.pinned is None else self.pinned

    def _read_paths(self, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        schema = schema or self.schema
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, by default the current one."""
        live = self._live(version)[1]
        return self._read_paths([live[b] for b in sorted(live)])

    def read_buckets_of(self, keys: DataFrame) -> DataFrame:
        """All current rows of the buckets that hold ``keys``: for readers that join them
        with those keys anyway."""
        _, live = self._live()
        touched = self._touched(keys)
        return self._read_paths([live[b] for b in sorted(touched) if b in live])

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """The current rows whose key is in ``keys``, reading only the buckets of those."""
        stored = self.read_buckets_of(keys)
        return stored.join(keys.select(self.key).distinct(), self.key, "left_semi")

    def publish(
        self, df: DataFrame, sort_key: str | None = None, files: int | None = None
    ) -> int:
        """Replace the whole table; returns the new version."""
        return self._replace(df, sort_key, files)

    def update(self, change: Callable[[DataFrame], DataFrame]) -> int:
        """Replace the whole table by ``change(current rows)``."""
        version, live = self._live()
        rows = change(self._read_paths([live[b] for b in sorted(live)]))
        return self._replace(rows, last=self._last_written(version))

    def _replace(
        self,
        df: DataFrame,
        sort_key: str | None = None,
        files: int | None = None,
        last: int | None = None,
    ) -> int:
        last = self._newest() if last is None else last
        if self.wanted_buckets:
            self.buckets = self.wanted_buckets
        return self._commit(last, self._paths(self._write(df, sort_key, files)))

    # -- changes of some buckets

    def _incoming(self) -> str:
        return f"{self.path}/incoming/{uuid.uuid4().hex}"

    def _staged(self, rows: DataFrame, path: str | None = None) -> DataFrame:
        """Rows written down: they are read several times, their stamps must not change in
        between, and their true file size is what lets Spark broadcast a small batch."""
        path = path or self._incoming()
        rows.write.parquet(path, compression=COMPRESSION)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _unique(self, rows: DataFrame) -> bool:
        """Whether no key occurs twice in written rows; reads the key column only."""
        repeated = rows.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        return repeated.isEmpty()

    def _touched(self, rows: DataFrame) -> dict[int, int]:
        """Number of rows by bucket, at most ``buckets`` entries."""
        counted = rows.groupBy(self._bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        return {r["bucket"]: r["n"] for r in counted.collect()}

    def _rewrite(
        self,
        base: tuple[int, dict[int, str]],
        staged: DataFrame,
        merge: Callable[[DataFrame, DataFrame], DataFrame],
        feed: bool = False,
        spent: Sequence[str] = (),
    ) -> int:
        """Replace the buckets of ``staged`` by ``merge(stored, staged)``; rows of ``staged``.

        Both frames carry their bucket, and the merged rows are left dealt out by it. Large
        ones are merged in passes, each over some of the buckets. Folders in ``spent`` are
        deleted when the rows are written.
        """
        version, live = base
        touched = self._touched(staged)
        if not touched:
            remove(self.spark, spent)
            return 0
        paths = {b: live[b] for b in sorted(touched) if b in live}
        size = planned_bytes(staged)
        if paths:
            size += planned_bytes(self._read_paths(list(paths.values())))
        passes = _passes(size, len(touched), self.spark.sparkContext.defaultParallelism)
        data = f"{self.path}/data/{uuid.uuid4().hex}"
        for i in sorted({b % passes for b in touched}):
            stored = self._read_paths([path for b, path in paths.items() if b % passes == i])
            old, new = (df.withColumn(BUCKET, self._bucket()) for df in (stored, staged))
            if passes > 1:
                new = new.filter(F.pmod(BUCKET, F.lit(passes)) == i)
            self._write_buckets(self._without_equal_texts(merge(old, new)), data)
        remove(self.spark, spent)
        last = self._last_written(version)
        if feed:
            self._write_feed(data, last + 1)
        untouched = {b: path for b, path in live.items() if b not in touched}
        self._commit(last, untouched | self._paths(data), feed)
        return sum(touched.values())

    def upsert(
        self, batch: DataFrame, feed: bool = False, keep_staged: bool = True, **options
    ) -> int:
        """Insert or replace by key; returns the number of rows of the batch.

        ``options`` are those of :func:`tidemark.operators.upsert.upsert`. Without
        ``keep_staged`` the copy of the batch goes as soon as its rows are merged.
        """
        base = self._live()
        incoming = self._incoming()
        staged = self._staged(batch.select(*self.schema.fieldNames()), incoming)
        partitioned = self.buckets > 1 or feed
        # Most batches hold a key once: a look at the keys saves them a shuffle of whole rows.
        on_duplicate = options.get("on_duplicate", "latest")
        unique = partitioned and on_duplicate == "latest" and self._unique(staged)
        if partitioned and on_duplicate == "error":
            # Once for the whole batch, whatever the number of passes.
            one_row_per_key(staged, self.key, None, None, on_duplicate)
            unique = True

        def merge(stored: DataFrame, incoming: DataFrame) -> DataFrame:
            if not partitioned:
                return upsert(stored.drop(BUCKET), incoming.drop(BUCKET), self.key, **options)
            return merge_partitioned(
                stored, incoming, self.key, BUCKET, self.buckets, feed=feed, unique=unique, **options
            )

        return self._rewrite(base, staged, merge, feed, () if keep_staged else (incoming,))

    def replace_keys(self, keys: DataFrame, rows: DataFrame, quiet: bool = False) -> int:
        """Replace all rows of ``keys`` by ``rows``; a key without a row leaves the table.

        Returns the number of keys. Only the buckets of the keys are rewritten. ``quiet``
        tells readers of the feed that nothing changed, as when only tombstones go.
        """
        base = self._live()
        present, incoming = "__present", "__incoming"
        found = rows.select(*self.schema.fieldNames()).withColumn(present, F.lit(True))
        staged = self._staged(keys.select(self.key).distinct().join(found, self.key, "left"))

        def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
            both = new.withColumn(incoming, F.lit(True)).unionByName(
                stored.withColumns({present: F.lit(True), incoming: F.lit(False)})
            )
            order = Window.partitionBy(BUCKET, self.key).orderBy(F.col(incoming).desc())
            ranked = by_partition(both, BUCKET, self.buckets).withColumn(
                "__rank", F.row_number().over(order)
            )
            kept = ranked.filter((F.col("__rank") == 1) & F.col(present))
            return kept.select(*self.schema.fieldNames(), BUCKET)

        return self._rewrite(base, staged, merge, quiet)

    def add(self, delta: DataFrame, by: Sequence[str], count: str, net: bool = False) -> int:
        """Add signed partial sums to the stored ones, group by group.

        All columns but ``by`` are sums. A group whose ``count`` falls to zero leaves the
        table; a negative count means that something unknown was taken away, and fails.
        Returns the number of groups of the delta. ``net`` says that the delta is a written
        table with one row per group, none of them zero: it is taken as it is.
        """
        base = self._live()
        sums = [f.name for f in self.schema.fields if f.name not in by]
        total = [F.sum(c).alias(c) for c in sums]
        if net:
            staged = delta.select(*self.schema.fieldNames())
        else:
            grouped = delta.groupBy(*by).agg(*total).select(*self.schema.fieldNames())
            changed = F.lit(False)
            for c in sums:
                changed = changed | (F.col(c) != 0)
            staged = self._staged(grouped.filter(changed))
        failure = F.raise_error(F.concat(F.lit("negative count for "), F.to_json(F.struct(*by))))

        def merge(stored: DataFrame, new: DataFrame) -> DataFrame:
            both = by_partition(stored.unionByName(new), BUCKET, self.buckets)
            merged = both.groupBy(BUCKET, *by).agg(*total)
            checked = F.when(F.col(count) < 0, failure.cast("boolean")).otherwise(F.col(count) > 0)
            kept = merged.filter(checked).select(*self.schema.fieldNames(), BUCKET)
            return kept.sortWithinPartitions(BUCKET, self.key)

        return self._rewrite(base, staged, merge)

    # -- change feed

    def _texts(self) -> list[str]:
        kinds = (T.StringType, T.BinaryType)
        return [f.name for f in self.schema.fields if isinstance(f.dataType, kinds)]

    def _without_equal_texts(self, merged: DataFrame) -> DataFrame:
        """Images before without the texts that the row still has; ``SAME`` names those."""
        if BEFORE not in merged.columns:
            return merged
        texts = self._texts()
        same = {c: F.col(c).eqNullSafe(F.col(BEFORE)[c]) for c in texts}
        thin = [
            F.when(~same[c], F.col(BEFORE)[c]).alias(c) if c in same else F.col(BEFORE)[c].alias(c)
            for c in self.schema.fieldNames()
        ]
        named = F.array_compact(F.array(*[F.when(same[c], F.lit(c)) for c in texts]))
        present = F.col(BEFORE).isNotNull()
        return merged.withColumns(
            {
                SAME: F.when(present, named if texts else F.array().cast("array<string>")),
                BEFORE: F.when(present, F.struct(*thin)),
            }
        )

    def _image_before(self) -> Column:
        """The whole image before, from what :meth:`_without_equal_texts` left."""
        texts = self._texts()
        whole = [
            F.when(F.array_contains(SAME, c), F.col(c)).otherwise(F.col(BEFORE)[c]).alias(c)
            if c in texts
            else F.col(BEFORE)[c].alias(c)
            for c in self.schema.fieldNames()
        ]
        return F.struct(*whole)

    def _write_feed(self, data: str, version: int) -> None:
        """The changed rows of freshly written data, with what was different before."""
        image = T.StructType(self.schema.fields)
        names = T.ArrayType(T.StringType())
        fields = [
            T.StructField(CHANGED, T.BooleanType()),
            T.StructField(BEFORE, image),
            T.StructField(SAME, names),
        ]
        wide = T.StructType([*self.schema.fields, *fields])
        # Data written without images, quietly, has no such column: nothing changed.
        changed = self.spark.read.schema(wide).parquet(data).filter(F.col(CHANGED))
        rows = changed.select(*self.schema.fieldNames(), BEFORE, SAME)
        # A dead attempt at this version left at most this folder, which no commit names.
        rows.write.mode("overwrite").parquet(
            f"{self.path}/feed/{VERSION}={version}", compression=COMPRESSION
        )

    def changes(self, after: int = 0, upto: int | None = None) -> DataFrame:
        """Images of the versions after ``after``: rows with ``__sign`` and ``__version``.

        Summed over versions the signs of equal rows cancel out: what remains is the change
        from the one version to the other. A stored row holds both images (1 and -1), a text
        that is in both once; feeds written earlier hold an image a row, with its sign.
        """
        upto = self.version() if upto is None else upto
        schema = T.StructType(
            [*self.schema.fields, T.StructField(SIGN, T.IntegerType()), T.StructField(VERSION, T.LongType())]
        )
        if upto <= after:
            return self.spark.createDataFrame([], schema)
        fed = self._commits().filter((F.col("version") > after) & (F.col("version") <= upto))
        missing = fed.filter(~F.coalesce("fed", F.lit(False))).agg(F.min("version")).first()[0]
        if missing is not None:
            raise ValueError(f"{self.path}: version {missing} was written without a feed")
        paths = [f"{self.path}/feed/{VERSION}={v}" for v in range(after + 1, upto + 1)]
        image, names = T.StructType(self.schema.fields), self.schema.fieldNames()
        both = [
            T.StructField(BEFORE, image),
            T.StructField(SAME, T.ArrayType(T.StringType())),
        ]
        reader = self.spark.read.schema(T.StructType([*schema.fields, *both]))
        stored = reader.option("basePath", f"{self.path}/feed").parquet(*paths)
        pairs = stored.filter(F.col(SIGN).isNull())
        after = pairs.select(*names, F.lit(1).alias(SIGN), VERSION)
        before = pairs.filter(F.col(BEFORE).isNotNull()).select(
            self._image_before().alias("i"), F.lit(-1).alias(SIGN), VERSION
        )
        single = stored.filter(F.col(SIGN).isNotNull()).select(*names, SIGN, VERSION)
        return after.unionByName(before.select("i.*", SIGN, VERSION)).unionByName(single)

    def obsolete_paths(self, keep: int = 2) -> DataFrame:
        """Folders that no current reader needs: ``(path)``.

        Data that only versions before the last ``keep`` (and before a pinned one) name, data
        that no commit names (a write that died) and staged batches. Deleting them is left to
        the storage (a lifecycle rule or a file tool), once no reader of an old version and no
        writer is left. Feeds are not listed: their consumers decide.
        """
        oldest = self._newest() - keep + 1
        if self.pinned is not None:
            oldest = min(oldest, self.pinned)
        named = (
            self._commits()
            .filter("path <> ''")
            .groupBy("path")
            .agg(F.max("version").alias("version"))
            .withColumn("tail", F.regexp_extract("path", "(data/[^/]+)(/|$)", 1))
        )
        stored = (
            self.spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(self.path)
            .select(F.regexp_extract("path", "(.*/(?:data|incoming)/[^/]+)/", 1).alias("path"))
            .filter("path <> ''")
            .distinct()
            .withColumn("tail", F.regexp_extract("path", "((?:data|incoming)/[^/]+)$", 1))
        )
        unnamed = stored.join(named.select("tail").distinct(), "tail", "left_anti")
        old = named.filter(F.col("version") < oldest)
        return old.select("path").unionByName(unnamed.select("path")).distinct()


    def sweep(self) -> None:
        """Delete what :meth:`obsolete_paths` lists, all versions but the current one included.

        For the only writer, once no reader of an earlier version is left.
        """
        live = {re.search("/data/([^/]+)/?([^/]*)$", p).groups() for p in self._live()[1].values()}
        spent = [f"incoming/{f}" for f in subfolders(self.spark, f"{self.path}/incoming")]
        for folder in subfolders(self.spark, f"{self.path}/data"):
            kept = {bucket for f, bucket in live if f == folder}
            if not kept:
                spent.append(f"data/{folder}")
            elif "" not in kept:
                inside = subfolders(self.spark, f"{self.path}/data/{folder}")
                spent += [f"data/{folder}/{b}" for b in inside if b not in kept]
        remove(self.spark, [f"{self.path}/{path}" for path in spent])

    def sweep_feeds(self, upto: int) -> None:
        """Delete the feeds of versions up to one that all their consumers have taken in."""
        fed = subfolders(self.spark, f"{self.path}/feed")
        taken = [f for f in fed if int(f.partition("=")[2]) <= upto]
        remove(self.spark, [f"{self.path}/feed/{f}" for f in taken])


class Release:
    """Several tables that become visible together.

    A release is one small file that names a version of each table. Tables are pinned to the
    current release, written (which moves only their own pin), checked, and made visible by
    :meth:`commit`. Versions written by a run that died or whose checks failed stay out of
    every release; the next run starts from the released ones again.
    """

    ROWS = T.StructType(
        [
            T.StructField("release", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("version", T.LongType()),
        ]
    )

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, SnapshotTable]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.tables = tables

    def _rows(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(self.ROWS).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def current(self) -> tuple[int, dict[str, int]]:
        """Number of the newest release and its version of each table."""
        rows = self._rows()
        newest = None if rows is None else rows.agg(F.max("release")).first()[0]
        if newest is None:
            return 0, {}
        named = rows.filter(F.col("release") == newest).collect()  # one row per table
        return newest, {r["name"]: r["version"] for r in named}

    def pin(self) -> int:
        """Pin all tables to the current release; returns its number, 0 if there is none."""
        number, versions = self.current()
        for name, table in self.tables.items():
            table.pinned = versions.get(name, 0)
        return number

    def pin_written(self) -> None:
        """Pin all tables to what was written last, released or not."""
        for table in self.tables.values():
            table.pinned = table._newest()

    def commit(self) -> int:
        """Make the pinned versions visible; returns the number of the release."""
        number = self.current()[0] + 1
        rows = [(number, name, table.version()) for name, table in sorted(self.tables.items())]
        few_rows(self.spark, rows, self.ROWS).write.mode("append").parquet(self.path)
        return number


def compact_landing(
    df: DataFrame, key: str, version: str, table: SnapshotTable, files: int | None = None
) -> DataFrame:
    """One version per key of a landing table as a published table, sorted by key."""
    table.publish(latest_per_key(df, key, version), sort_key=key, files=files)
    return table.read()


# ---- dated lake -------------------------------------------------------------------

DATE_PARTITION = "dt"


def _date_of(c: Column, unit: str) -> Column:
    """First day of the day, month or year of ``c``."""
    date = F.to_date(c)
    return date if unit == "day" else F.trunc(date, unit)


def write_by_date(
    df: DataFrame, ts: str, path: str, unit: str = "day", mode: str = "append"
) -> None:
    """Write one directory per date of ``ts``; rows of an earlier load of a date stay.

    ``mode="overwrite"`` reloads dates in full: those present in ``df`` are replaced, others
    stay. Several loads of a key are for ``latest_per_key`` to settle, as in landing tables.

    Rebalancing keeps the file count near one per date; AQE splits a date that is far
    larger than the rest into several files.
    """
    dated = df.withColumn(DATE_PARTITION, _date_of(F.col(ts), unit))
    (
        dated.hint("rebalance", DATE_PARTITION)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DATE_PARTITION)
        .parquet(path)
    )


def read_dated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    declared = T.StructType(schema.fields + [T.StructField(DATE_PARTITION, T.DateType())])
    return spark.read.schema(declared).parquet(path)


def between_dates(
    df: DataFrame, ts: str, start: datetime, end: datetime, unit: str = "day"
) -> DataFrame:
    """Rows with ``start <= ts < end`` of a dated table.

    The extra condition on the partition column lets Spark skip whole directories
    before it opens a file.
    """
    kind = df.schema[ts].dataType.simpleString()
    lo, hi = timestamp_literal(start, kind), timestamp_literal(end, kind)
    partition = F.col(DATE_PARTITION)
    return df.filter(
        (partition >= _date_of(lo, unit))
        & (partition <= _date_of(hi, unit))
        & (F.col(ts) >= lo)
        & (F.col(ts) < hi)
    )


def retain(
    df: DataFrame, ts: str, interval: timedelta, now: datetime, unit: str = "day"
) -> DataFrame:
    """Rows not older than ``interval`` before ``now``; expired dates are not read."""
    kind = df.schema[ts].dataType.simpleString()
    oldest = timestamp_literal(now - interval, kind)
    keep = F.col(ts) >= oldest
    if DATE_PARTITION in df.columns:
        keep = keep & (F.col(DATE_PARTITION) >= _date_of(oldest, unit))
    return df.filter(keep)


def remove_expired(
    spark: SparkSession,
    path: str,
    target: str,
    schema: T.StructType,
    ts: str,
    interval: timedelta,
    now: datetime,
    unit: str = "day",
) -> None:
    """Write what :func:`retain` keeps of a dated table as a dated table at ``target``.

    Expired dates are not read, only the oldest kept date loses rows. Nothing is overwritten
    in place; readers move to ``target`` and the storage drops the old folder.
    """
    kept = retain(read_dated(spark, path, schema), ts, interval, now, unit)
    write_by_date(kept.drop(DATE_PARTITION), ts, target, unit)


# ---- hash distribution ------------------------------------------------------------


def distribute(df: DataFrame, key: str, n: int) -> DataFrame:
    """Hash-distribute by ``key`` once; joins and aggregations on it then need no shuffle."""
    return df.repartition(n, key)


def write_bucketed(df: DataFrame, table: str, key: str, n: int, path: str) -> None:
    """Store a table hash-bucketed and sorted by ``key`` for shuffle-free joins."""
    (
        df.repartition(n, key)
        .write.bucketBy(n, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
