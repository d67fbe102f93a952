"""SimHash near-duplicates by pivot distance tables.

Fingerprints are points of a 64-dimensional cube. The distances of a fingerprint to fixed
reference fingerprints, the pivots, are its coordinates; they are computed once and written
down. Two fingerprints at Hamming distance ``d`` have coordinates that differ by ``d`` at most,
for every pivot.

There are three kinds of pivots: one base, families around it, and pivots far from each other.
The bits are divided into slices. A pivot of a family is the base changed in some bits of one
slice, so how much farther or nearer it is than the base depends on that slice alone. Two
fingerprints at distance ``d`` are equal in all but ``d`` slices, and there all these differences
of coordinates are equal. With ``max_bits + 2`` slices some two of them are equal for every link:
each choice of two is a table keyed by the differences of its families, and links are within a
key. Inside a key pairs are discarded by their largest difference over all pivots, and what
survives is verified by its own Hamming distance.

The work is on different fingerprints, with the smallest id of each. Fingerprints of one
key are searched breadth first and only a spanning forest is handed on, never all pairs.
A key of more than ``CELL`` fingerprints is cut into parts, and every two parts meet in a
cell of their own.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import (
    column,
    connected_components,
    materialise,
    record_batches,
    short_batches,
)

SEED = 42
SHINGLE = 3
MAX_BITS = 3
SLICES = MAX_BITS + 2
CELL = 4096
BITS = 64
FAR_PIVOTS = 24
FAMILY = 8

ROWS = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)],
        dtype="<u8",
    )
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of every row; ``fp`` is the fingerprint as a signed number."""
    short_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            rows = zip(
                column(batch, "doc_id"),
                (_signed(fingerprint(t, shingle)) for t in column(batch, "text")),
                strict=True,
            )
            yield from record_batches(rows, ROWS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fp long"
    )


def slice_masks(slices: int) -> list[int]:
    """Masks of about equal slices of the bits."""
    bounds = [round(i * BITS / slices) for i in range(slices + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(bounds, bounds[1:], strict=False)]


def pivots(slices: int = SLICES) -> list[int]:
    """The reference fingerprints: the far ones, the base, and the family of each slice."""

    def number(name: bytes, i: int) -> int:
        return xxhash.xxh64_intdigest(name, seed=i)

    base = number(b"base", 0)
    families = [
        base ^ (number(b"family", s * FAMILY + i) & mask)
        for s, mask in enumerate(slice_masks(slices))
        for i in range(FAMILY)
    ]
    return [*(number(b"far", i) for i in range(FAR_PIVOTS)), base, *families]


def distance_table(fps: DataFrame, slices: int = SLICES) -> DataFrame:
    """``(fp, distances)``: Hamming distances of each ``fp`` to all pivots, in their order."""
    distances = [
        F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("byte") for p in pivots(slices)
    ]
    return fps.select("fp", F.array(*distances).alias("distances"))


def _table_keys(slices: int, max_bits: int) -> list[Column]:
    """Per choice of slices a hash of how far its families lie from the base.

    Equal hashes of different distances only bring pairs that are then discarded.
    """
    base = F.col("distances")[FAR_PIVOTS]
    return [
        F.xxhash64(
            *[
                F.col("distances")[FAR_PIVOTS + 1 + s * FAMILY + i] - base
                for s in chosen
                for i in range(FAMILY)
            ]
        )
        for chosen in combinations(range(slices), slices - max_bits)
    ]


def pivot_survivors(table: np.ndarray, x: int, among: np.ndarray, max_bits: int) -> np.ndarray:
    """Rows of ``among`` whose largest coordinate difference to row ``x`` is ``max_bits`` at most."""
    for columns in (slice(0, 2), slice(2, 8), slice(8, None)):
        apart = np.abs(table[among, columns] - table[x, columns]).max(axis=1)
        among = among[apart <= max_bits]
    return among


def _forest(fps: np.ndarray, table: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among different fingerprints of one cell."""
    left = np.arange(len(fps))
    edges: list[tuple[int, int]] = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            found = pivot_survivors(table, x, left, max_bits)
            found = found[np.bitwise_count(fps[found] ^ fps[x]) <= max_bits]
            if len(found):
                edges += [(int(x), int(y)) for y in found]
                queue += found.tolist()
                left = np.setdiff1d(left, found, assume_unique=True)
    return edges


def links(fps: DataFrame, max_bits: int = MAX_BITS, slices: int = SLICES, cell: int = CELL) -> DataFrame:
    """``(a, b)``: links between different fingerprints ``fp`` that connect all that are linked."""
    if not 0 <= max_bits < slices:
        raise ValueError("there must be more slices than bits that may differ")
    table = materialise(distance_table(fps, slices), "simhash-distances")
    keyed = table.select(
        "fp", "distances", F.posexplode(F.array(*_table_keys(slices, max_bits))).alias("tab", "key")
    )
    sizes = keyed.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    parts = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    names = ["tab", "key", "i", "j"]
    celled = (
        keyed.join(sizes, ["tab", "key"])
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(others))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        .select(*names, "fp", "distances")
    )
    placed = celled.repartition(*names).sortWithinPartitions(*names)

    def search(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([np.asarray(batch.column(k)) for k in range(4)])
            fps = np.asarray(batch.column(4)).view(np.uint64)
            table = np.asarray(batch.column(5).flatten()).reshape(len(fps), -1)
            starts = np.concatenate(
                [[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]]
            )
            rows = []
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                key = tuple(keys[a].tolist())
                if key != last:
                    rows += _found(held, max_bits)
                    held, last = [], key
                held.append((fps[a:b], table[a:b]))
            yield from record_batches(rows, EDGES)
        yield from record_batches(_found(held, max_bits), EDGES)

    return placed.mapInArrow(search, "a long, b long")


def _found(held: list[tuple[np.ndarray, np.ndarray]], max_bits: int) -> list[tuple[int, int]]:
    if not held:
        return []
    fps = np.concatenate([part for part, _ in held])
    table = np.concatenate([part for _, part in held])
    signed = fps.view(np.int64)
    return [(int(signed[x]), int(signed[y])) for x, y in _forest(fps, table, max_bits)]


def components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, component_id)``: the smallest ``doc_id`` among all rows reachable by links.

    Rows without a ``doc_id`` take part; they don't name a component.
    """
    classes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    labels = connected_components(links(classes.select("fp"), max_bits), "simhash")
    labels = materialise(labels, "simhash-components")
    joined = classes.join(labels, classes["fp"] == labels["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    roots = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    return joined.join(roots, "component").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Whole texts; a null text has no words and fingerprint zero. Rows that repeat are one
    class. An empty table gives an empty result; other columns are not read.
    """
    prints = materialise(fingerprints(docs, shingle), "simhash")
    found = prints.join(components(prints, max_bits), "fp")
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_per_component(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, the one with the smallest ``doc_id``, all columns kept.

    Among rows of that id the one with the smallest hash of its text stays, and among those
    the one with the smallest hash of all columns; rows equal in all columns are one. The rows
    without an id are one row of those of their fingerprint, unless their component has an id.
    An empty table gives an empty result. Columns may have any name.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull())
    keyed = docs.select(
        row.alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        text_hash.alias("hash"),
    )
    short_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("hash", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            rows = zip(
                column(batch, "doc_id"),
                column(batch, "hash"),
                (_signed(fingerprint(t, shingle)) for t in column(batch, "text")),
                strict=True,
            )
            yield from record_batches(rows, schema)

    narrow = keyed.select("doc_id", "hash", "text")
    prints = materialise(narrow.mapInArrow(run, "doc_id long, hash long, fp long"), "simhash")
    keepers = (
        prints.join(components(prints.select("doc_id", "fp"), max_bits), "fp")
        .groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("nameless"))
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash")).alias("kept"))
        .select(F.col("kept.doc_id").alias("kept_id"), F.col("kept.hash").alias("kept_hash"))
    )
    same = (F.col("hash") == F.col("kept_hash")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    copies = Window.partitionBy("kept_hash", "kept_id").orderBy(F.xxhash64("row"))
    return (
        keyed.select("row", "doc_id", "hash")
        .join(keepers, same)
        .withColumn("copy", F.row_number().over(copies))
        .filter("copy = 1")
        .select("row.*")
    )
