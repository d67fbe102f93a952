"""Merkle manifest of a table, and proofs of all its rows by octopus multiproofs.

Every row is a leaf. The leaves of one group, in order, make a tree: while several nodes
remain, each run of 16 becomes the hash of its concatenated hex digests. The trees' roots,
ordered by group, make the top tree in the same way; its last node is the root of the table.

Building is a loop of grouped hashes over ever fewer nodes, written down level by level.

For proving, the leaves of a tree lie in partitions of 256 neighbours. A partition derives its
interior nodes from its own leaves. :func:`missing_nodes` lists the minimal union of nodes that
its proofs need beyond those, level by level up to the root; all partitions fetch theirs in one
join with the written nodes. Then each partition expands the proof of every leaf by itself and
folds the leaf that is claimed, which may differ from the one in the manifest.

Row numbers inside a tree come from a range sort and the counts of its partitions, so a group
with a third of all rows is spread over the cluster like any other. Nothing but the height of the
tallest tree, the number of trees and the root reaches the driver.

Defined cases: nulls hash as ``-``; a null group is a group of its own, the first; a null order
value comes first; rows equal in all hashed columns are separate, interchangeable leaves, even
where the order column repeats; rows with one order value are ordered by their leaf. Texts are
hashed whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialise, short_batches

FAN = 16
#: Leaves of a partition: two levels of a tree.
OWN_LEVELS = 2
SPAN = FAN**OWN_LEVELS
#: Name of the tree over the trees; those of groups start with "s" or are empty.
TOP = "top"

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PROOF_SCHEMA = pa.schema(
    [("order_value", pa.int64())]
    + [(name, pa.string()) for name in ("leaf", "subroot", "proof_sha256", "folded_root")]
)


# ---- leaves -----------------------------------------------------------------------


def leaf_hash(columns: Sequence[Column]) -> Column:
    """Hash of length-prefixed values, so that no two rows share their bytes by chance."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def lower_case_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def leaf_rows(
    docs: DataFrame,
    columns: Sequence[str] = LEAF_COLUMNS,
    group: str = "source",
    order: str = "doc_id",
    claimed: dict[str, Column] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """``(tree, order_value, leaf, claimed)`` of every row.

    ``claimed`` replaces columns in the row to be checked, where ``where`` holds; elsewhere
    the row itself is checked.
    """
    own = leaf_hash([F.col(c) for c in columns])
    other = own
    if claimed:
        altered = leaf_hash([claimed.get(c, F.col(c)) for c in columns])
        other = altered if where is None else F.when(where, altered).otherwise(F.col("leaf"))
    tree = F.coalesce(F.concat(F.lit("s"), F.col(group).cast("string")), F.lit(""))
    hashed = docs.select(
        *dict.fromkeys([*columns, group, order]), own.alias("leaf")
    ).withColumn("claimed", other)
    return hashed.select(
        tree.alias("tree"), F.col(order).cast("long").alias("order_value"), "leaf", "claimed"
    )


# ---- row numbers ------------------------------------------------------------------


def numbered(written: DataFrame, group: str | None, order: Sequence[str]) -> DataFrame:
    """A written table with ``idx``, the number of each row in its group from 0 by ``order``.

    A range sort deals the rows out; each task counts its rows per group, and the counts of
    the tasks before it are added afterwards. The place of a row in its file settles ties,
    so equal rows spread over tasks as well.
    """
    tie = ["__file", "__place"]
    keys = [*([group] if group else []), *order, *tie]
    placed = written.withColumns(
        {"__file": F.col("_metadata.file_name"), "__place": F.col("_metadata.row_index")}
    )
    ranged = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(*tie)
    tagged = ranged.withColumn("__part", F.spark_partition_id())
    short_batches(written.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, following = None, 0
        for batch in batches:
            places = []
            groups = batch.column(group).to_pylist() if group else [""] * batch.num_rows
            for value in groups:
                if value != current:
                    current, following = value, 0
                places.append(following)
                following += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places, pa.int64())], [*batch.schema.names, "__inside"]
            )

    schema = T.StructType([*tagged.schema.fields, T.StructField("__inside", T.LongType())])
    counted = materialise(tagged.mapInArrow(count, schema), "merkle-numbered")
    by = ["__part", *([group] if group else [])]
    # One row per task and group from here on.
    sizes = counted.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*([group] if group else [F.lit(0)])).orderBy("__part")
    before = F.sum("__rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.withColumn("__base", F.coalesce(before, F.lit(0))).drop("__rows")
    return (
        counted.join(bases, by)
        .withColumn("idx", F.col("__base") + F.col("__inside"))
        .drop("__part", "__inside", "__base")
    )


# ---- trees ------------------------------------------------------------------------


def _next_level(nodes: DataFrame) -> DataFrame:
    """Parents of all trees that have several nodes; ``size`` is a tree's number of nodes."""
    run = F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])
    return (
        nodes.filter(F.col("size") > 1)
        .groupBy("tree", F.expr(f"idx div {FAN}").alias("idx"))
        .agg(
            F.sha2(F.array_join(run, ""), 256).alias("digest"),
            F.expr(f"(max(size) + {FAN - 1}) div {FAN}").alias("size"),
        )
        .select("tree", "idx", "size", "digest")
    )


def grow(leaves: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels above the leaves ``(tree, idx, size, digest)``, and each tree's last node."""
    tallest = leaves.agg(F.max("size")).first()[0] or 0
    levels: list[DataFrame] = []
    level = leaves
    while tallest > 1:
        level = materialise(_next_level(level), label)
        levels.append(level)
        tallest = -(-tallest // FAN)
    roots = leaves.filter("size = 1")
    for level in levels:
        roots = roots.unionByName(level.filter("size = 1"))
    return levels, roots.select("tree", F.col("digest").alias("subroot"))


@dataclass
class Manifest:
    """A written manifest: ``leaves`` with their place, ``nodes`` above them, ``trees``."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    n_trees: int
    root: str | None


def build(leaves: DataFrame) -> Manifest:
    """Manifest of :func:`leaf_rows`."""
    written = materialise(leaves, "merkle-leaves")
    sizes = materialise(
        written.groupBy("tree").agg(F.count(F.lit(1)).alias("size")), "merkle-sizes"
    )
    placed = materialise(
        numbered(written, "tree", ["order_value", "leaf"]).withColumn(
            "part", F.expr(f"idx div {SPAN}")
        ),
        "merkle-placed",
    )
    base = placed.join(sizes, "tree").select("tree", "idx", "size", F.col("leaf").alias("digest"))
    levels, subroots = grow(base, "merkle-level")
    n_trees = sizes.count()
    ranked = numbered(materialise(subroots, "merkle-subroots"), None, ["tree"])
    trees = materialise(
        ranked.withColumnRenamed("idx", "rank").join(sizes, "tree"), "merkle-trees"
    )
    crown = trees.select(
        F.lit(TOP).alias("tree"),
        F.col("rank").alias("idx"),
        F.lit(n_trees).cast("long").alias("size"),
        F.col("subroot").alias("digest"),
    )
    top_levels, top = grow(crown, "merkle-top")
    root = top.select("subroot").first()

    def at(level: int, frame: DataFrame) -> DataFrame:
        return frame.select("tree", F.lit(level).alias("level"), "idx", "digest")

    nodes = at(0, crown)
    for i, frame in enumerate(levels, 1):
        if i >= OWN_LEVELS:
            nodes = nodes.unionByName(at(i, frame))
    for i, frame in enumerate(top_levels, 1):
        nodes = nodes.unionByName(at(i, frame))
    return Manifest(placed, nodes, trees, n_trees, root[0] if root else None)


# ---- proofs -----------------------------------------------------------------------


def missing_nodes(known: Iterable[int], level: int, size: int) -> list[tuple[int, int]]:
    """``(level, idx)`` that proofs of the ``known`` nodes of one level need from elsewhere.

    ``size`` is the number of nodes of that level. A parent of known nodes becomes known, so
    what several proofs share is listed once and what can be derived is not listed.
    """
    known, out = set(known), []
    while size > 1:
        parents = {k // FAN for k in known}
        for p in sorted(parents):
            run = range(p * FAN, min((p + 1) * FAN, size))
            out += [(level, i) for i in run if i not in known]
        known, level, size = parents, level + 1, -(-size // FAN)
    return out


def _level_size(n: int, level: int) -> int:
    for _ in range(level):
        n = -(-n // FAN)
    return n


def _requests(manifest: Manifest) -> DataFrame:
    """``(tree, part, of, level, idx)``: the nodes of tree ``of`` that a partition lacks."""
    n_trees = manifest.n_trees
    parts = manifest.trees.select(
        "tree",
        "rank",
        "size",
        F.explode(F.sequence(F.lit(0), F.expr(f"(size - 1) div {SPAN}"))).alias("part"),
    )

    def list_missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, rank, size, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = missing_nodes([part], OWN_LEVELS, _level_size(size, OWN_LEVELS))
                rows += [(tree, part, tree, level, i) for level, i in own]
                rows += [(tree, part, TOP, level, i) for level, i in missing_nodes([rank], 0, n_trees)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["tree", "part", "of", "level", "idx"],
            )

    return parts.mapInArrow(
        list_missing, "tree string, part long, of string, level int, idx long"
    )


def _hash(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def expand(
    leaves: list[str],
    claimed: list[str],
    first: int,
    size: int,
    rank: int,
    n_trees: int,
    fetched: dict[tuple[bool, int, int], str],
) -> Iterator[tuple[str, str]]:
    """Proof hash and folded root of each leaf of one partition, from ``first`` on.

    ``fetched`` holds the missing nodes by (in the top tree, level, idx).
    """
    own, width = [leaves], size
    for _ in range(OWN_LEVELS):
        if width == 1:
            break
        own.append([_hash(own[-1][i : i + FAN]) for i in range(0, len(own[-1]), FAN)])
        width = -(-width // FAN)
    # Above its own levels a partition has one node, and all its leaves share the siblings.
    shared = []
    at, level = first // FAN ** (len(own) - 1), len(own) - 1
    for top, at, level, width in ((False, at, level, width), (True, rank, 0, n_trees)):
        while width > 1:
            run = range(at // FAN * FAN, min((at // FAN + 1) * FAN, width))
            left = [fetched[top, level, i] for i in run if i < at]
            right = [fetched[top, level, i] for i in run if i > at]
            shared.append((left, right))
            at, level, width = at // FAN, level + 1, -(-width // FAN)
    shared_path = [d for left, right in shared for d in left + right]
    for place, digest in enumerate(claimed):
        path, at = [], place
        for nodes in own[:-1]:
            run = nodes[at // FAN * FAN : (at // FAN + 1) * FAN]
            left, right = run[: at % FAN], run[at % FAN + 1 :]
            path += left + right
            digest, at = _hash([*left, digest, *right]), at // FAN
        for left, right in shared:
            digest = _hash([*left, digest, *right])
        yield _hash(path + shared_path), digest


def prove(manifest: Manifest) -> DataFrame:
    """``(order_value, leaf, subroot, proof_sha256, folded_root)`` of every leaf."""
    n_trees = manifest.n_trees
    nodes = manifest.nodes.withColumnRenamed("tree", "of")
    fetched = _requests(manifest).join(nodes, ["of", "level", "idx"]).select(
        "tree", "part", (F.col("of") == TOP).alias("top"), "level", "idx", "digest"
    )
    about = manifest.trees.select("tree", "rank", "size", "subroot")
    leaves = manifest.leaves.join(about, "tree")

    def partition(mine: pa.Table, other: pa.Table) -> pa.Table:
        mine = mine.sort_by("idx")
        held = {
            (top, level, i): digest
            for top, level, i, digest in zip(
                *(other.column(c).to_pylist() for c in ("top", "level", "idx", "digest")), strict=True
            )
        }
        first, size, rank = (mine.column(c)[0].as_py() for c in ("idx", "size", "rank"))
        own, claimed = (mine.column(c).to_pylist() for c in ("leaf", "claimed"))
        proofs, roots = zip(*expand(own, claimed, first, size, rank, n_trees, held), strict=True)
        columns = [mine.column(c) for c in ("order_value", "leaf", "subroot")]
        return pa.table(
            [*columns, pa.array(proofs, pa.string()), pa.array(roots, pa.string())],
            schema=PROOF_SCHEMA,
        )

    cogrouped = leaves.groupBy("tree", "part").cogroup(fetched.groupBy("tree", "part"))
    proven = cogrouped.applyInArrow(
        partition,
        "order_value long, leaf string, subroot string, proof_sha256 string, folded_root string",
    )
    return proven


def verify_tampered(docs: DataFrame, every: int = 5) -> DataFrame:
    """Manifest and proofs of ``docs``; rows whose id's CRC ``every`` divides are tampered with.

    Tampering lower-cases the text's A-Z. Returns ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified``, one row per row of ``docs``.
    """
    tampered = F.crc32(F.col("doc_id").cast("string")) % every == 0
    rows = leaf_rows(
        docs, claimed={"text": lower_case_ascii(F.col("text"))}, where=F.coalesce(tampered, F.lit(False))
    )
    manifest = build(rows)
    root = F.lit(manifest.root).cast("string")
    return prove(manifest).select(
        F.col("order_value").alias("doc_id"),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
