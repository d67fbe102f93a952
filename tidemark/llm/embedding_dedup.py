"""Near-duplicate vectors by 8-bit tile products with rigorous error bounds.

A unit vector ``x`` is stored as ``s q`` with whole numbers ``q`` from -127 to 127 and a
residual whose length ``e`` is measured, not estimated. For any two,

    |x.y - (s q).(t r)|  <=  e_x |t r| + e_y |x|

so the product of the whole numbers, which is exact, bounds the cosine from above. Tiles
of vectors are multiplied as matrices; pairs whose bound stays under the threshold are
done, the others are computed anew from the original components in double precision.

Equal vectors are one class with a count, so copies are never expanded. Classes are dealt
into groups, and a cell compares two groups. A cell hands on the number of links of each
vector and a spanning forest of the links, not the links. All pairs of classes are bounded:
the work is quadratic in their number, as no exact method known does better for vectors
without structure; a cell's memory is bounded by the group size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, connected_components, materialise, record_batches
from tidemark.llm.vectors import matrix, packed_vectors, stored_type

THRESHOLD = 0.9
#: Classes in a group, about, and rows of a tile.
GROUP = 8192
TILE = 512
#: Sums of products of 8-bit numbers are exact in single precision up to this dimension.
EXACT_SINGLE = (1 << 24) // (127 * 127)
#: Above the rounding of the double-precision bound itself.
SLACK = 1e-9

FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])


class Quantised:
    """Unit vectors as whole numbers with their scale, the length of that, and the residual's."""

    def __init__(self, vectors: np.ndarray):
        norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        # Very large or small components: scale first, so that the norm is finite and not zero.
        odd = ~np.isfinite(norm) | (norm < 1e-150)
        if odd.any():
            vectors = vectors.copy()
            vectors[odd] /= np.abs(vectors[odd]).max(axis=1)[:, None]
            norm = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.unit = vectors / norm[:, None]
        self.scale = np.abs(self.unit).max(axis=1) / 127
        whole = np.rint(self.unit / self.scale[:, None])
        close = whole * self.scale[:, None]
        self.close = np.sqrt(np.einsum("ij,ij->i", close, close))
        rest = self.unit - close
        self.rest = np.sqrt(np.einsum("ij,ij->i", rest, rest)) + SLACK
        kind = np.float32 if vectors.shape[1] <= EXACT_SINGLE else np.float64
        self.whole = whole.astype(np.int8).astype(kind)


def link_tile(a: Quantised, rows: slice, b: Quantised, threshold: float) -> np.ndarray:
    """Which of ``rows`` of ``a`` link with which of ``b``: cosine at least ``threshold``."""
    product = a.whole[rows] @ b.whole.T
    # |x| = 1: bound = s t q.r + e_x |t r| + e_y. Per row, the smallest product that may pass.
    room = threshold - a.rest[rows] * b.close.max() - b.rest.max() - SLACK
    least = np.where(room > 0, room / (a.scale[rows] * b.scale.max()), -np.inf)
    i, j = np.nonzero(product >= least.astype(product.dtype)[:, None] * (1 - 1e-6))
    bound = (
        a.scale[rows][i] * b.scale[j] * product[i, j]
        + a.rest[rows][i] * b.close[j]
        + b.rest[j]
        + SLACK
    )
    may = bound >= threshold
    i, j = i[may], j[may]
    links = np.zeros(product.shape, bool)
    if len(i) * 8 > product.size:
        links[i, j] = (a.unit[rows] @ b.unit.T)[i, j] >= threshold
    else:
        for k in range(0, len(i), 1 << 16):
            x, y = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            links[x, y] = np.einsum("ij,ij->i", a.unit[rows][x], b.unit[y]) >= threshold
    return links


def _forest(links: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Spanning forest of a cell; the second group is numbered after the first."""
    n, m = links.shape
    shift = 0 if same else n
    back = links if same else links.T
    free_a, free_b = np.ones(n, bool), np.ones(m, bool)
    edges: list[tuple[int, int]] = []
    for root in np.flatnonzero(links.any(axis=1)).tolist():
        if not free_a[root]:
            continue
        free_a[root] = False
        if same:
            free_b[root] = False
        queue = [(root, True)]
        while queue:
            x, in_a = queue.pop()
            free = free_b if in_a else free_a
            near = np.flatnonzero((links if in_a else back)[x] & free)
            free[near] = False
            if same:
                free_a[near] = False
                free_b[near] = False
            node = x if in_a else x + shift
            edges += [(node, y + shift if in_a else y) for y in near.tolist()]
            queue += [(y, in_a if same else not in_a) for y in near.tolist()]
    return edges


def compare_groups(
    a: np.ndarray, b: np.ndarray | None, counts_a: np.ndarray, counts_b: np.ndarray | None, threshold: float
):
    """Links per row of ``a`` (and ``b``), copies counted, and a spanning forest.

    Without ``b`` the rows of ``a`` are compared with each other.
    """
    same = b is None
    qa = Quantised(a)
    qb = qa if same else Quantised(b)
    links = np.zeros((len(a), len(qb.unit)), bool)
    for k in range(0, len(a), TILE):
        rows = slice(k, min(k + TILE, len(a)))
        links[rows] = link_tile(qa, rows, qb, threshold)
    if same:
        # The two halves are rounded apart; a link is the same either way.
        links = np.triu(links, 1)
        links |= links.T
    hit = links.any(axis=1)
    n_a, n_b = np.zeros(len(a), np.int64), np.zeros(links.shape[1], np.int64)
    other = counts_a if same else counts_b
    for x in np.flatnonzero(hit).tolist():
        n_a[x] = other[links[x]].sum()
        if not same:
            n_b[links[x]] += counts_a[x]
    return n_a, n_b, _forest(links, same)


def _cells(classes: DataFrame, dtype: str, threshold: float, group: int) -> DataFrame:
    """``(a, b, n)``: links of the forest (n null), and numbers of links of a node (b null)."""
    groups = max(1, -(-classes.count() // group))
    own = F.pmod(F.xxhash64("vec"), F.lit(groups))
    celled = (
        classes.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .withColumn("cell", (F.col("j") * (F.col("j") + 1) / 2 + F.col("i")).cast("int"))
        .select("cell", (F.col("own") == F.col("j")).alias("second"), (F.col("i") == F.col("j")).alias("same"),
                "node", "n", "vec")
    )
    cells = groups * (groups + 1) // 2
    placed = celled.repartitionById(cells, F.col("cell")).sortWithinPartitions("cell", "second")

    def compare(batches):
        held: list[tuple] = []
        for batch in batches:
            names = ("cell", "second", "same", "node", "n", "vec")
            for row in zip(*(column(batch, c) for c in names), strict=True):
                if held and held[0][0] != row[0]:
                    yield from record_batches(_compared(held, dtype, threshold), FOUND)
                    held = []
                held.append(row)
        if held:
            yield from record_batches(_compared(held, dtype, threshold), FOUND)

    return placed.mapInArrow(compare, "a long, b long, n long")


def _compared(held: list[tuple], dtype: str, threshold: float):
    """Rows of one cell; vectors of another dimension than the rest meet only their like."""
    same = held[0][2]
    for size in sorted({len(r[5]) for r in held}):
        rows = [r for r in held if len(r[5]) == size]
        parts = [rows] if same else [[r for r in rows if not r[1]], [r for r in rows if r[1]]]
        if not all(parts):
            continue
        vectors = [matrix([r[5] for r in p], dtype) for p in parts]
        counts = [np.array([r[4] for r in p], np.int64) for p in parts]
        nodes = [r[3] for p in parts for r in p]
        if same:
            n_a, n_b, edges = compare_groups(vectors[0], None, counts[0], None, threshold)
            found = n_a.tolist()
        else:
            n_a, n_b, edges = compare_groups(*vectors, *counts, threshold)
            found = n_a.tolist() + n_b.tolist()
        yield from ((node, None, n) for node, n in zip(nodes, found, strict=True) if n)
        yield from ((nodes[x], nodes[y], None) for x, y in edges)


def near_duplicates(
    rows: DataFrame, threshold: float = THRESHOLD, group: int = GROUP
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Vectors that are null, zero, or hold null or non-finite components link with nothing
    and are kept. Vectors of different dimension don't link. Copies of a vector link with
    each other. A null ``vec_id`` names no component unless nothing else does; labels and
    other columns are not read. An empty table gives an empty result.
    """
    dtype = stored_type(rows)
    packed = materialise(packed_vectors(rows), "vectors")
    # The node of a class is a number of its vector alone: ids may repeat or be null.
    classes = packed.filter("vec is not null").groupBy("vec").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n")
    )
    classes = materialise(classes.withColumn("node", F.xxhash64("vec")), "vector-classes")
    found = materialise(_cells(classes.select("node", "n", "vec"), dtype, threshold, group), "vector-links")
    labels = connected_components(found.filter("b is not null").select("a", "b"), "vectors")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("linked"))
    labelled = classes.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
    roots = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    known = (
        labelled.join(counts, "node", "left")
        .join(roots, "label")
        .select("vec", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("links"), "component_id")
    )
    return packed.join(known, "vec", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )
