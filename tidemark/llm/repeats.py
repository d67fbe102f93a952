"""Repeated byte strings by merging Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts elsewhere. Every
start of such a window is a suffix; equal windows are neighbours in suffix order.

**Routing.** The smallest hash of the ``gram``-byte strings in a window, its anchor, depends
on the window's bytes only, so equal windows have equal anchors. Consecutive starts with
the same anchor form a piece. Windows can repeat only inside a group of pieces with equal
anchor hash: groups with a single occurrence go, identical pieces become one with a
weight, and a group of one such piece is decided by its weight.

**Shards.** The other groups are gathered by anchor. A task takes as many groups as fill a
working set and cuts them into shards. The symbols of a shard's text are blocks of
``length / DEPTH`` bytes, so ``DEPTH`` symbols are a window. Each shard has its own
transform: for each of its suffixes in order, the symbol before it.

**Merge.** The interleave of the shards' suffix orders starts as plain concatenation. Each
round walks the current interleave, takes the next symbol of the shard it names, and deals
the shard numbers stably by symbol: after round ``h`` the interleave is that of all
suffixes ordered by their first ``h`` symbols. No suffix is compared or sorted again. A
block boundary that first shows in round ``h`` means a common prefix of ``h - 1`` symbols;
blocks that are still whole after ``DEPTH`` rounds are the repeated intervals.

Symbols are 64-bit hashes of their bytes, pieces are told apart by 128-bit digests.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, materialise, record_batches, short_batches, to_batch

LENGTH = 400
GRAM = 48
DEPTH = 4
#: Bytes of text scanned at once, of a task's working set, and of a shard.
SCAN = 1 << 19
WORKING_SET = 1 << 19
SHARD = 1 << 17
#: A group of more different pieces than this is cut into single windows. A piece has fewer
#: than ``2 * length`` bytes, so a group that one task gathers has 1.6 MB at most.
GROUP_PIECES = 2_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)
_BYTES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (
    np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F) >> np.uint64(17)
)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_ODD, 2 * SCAN), _powers(_INVERSE, 2 * SCAN)


def block_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    if len(data) > len(_UP):
        half = len(_UP) - size
        return np.concatenate(
            [block_hashes(data[k : k + half + size - 1], size) for k in range(0, n, half)]
        )
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * _UP[: len(data)], out=sums[1:])
    h = (sums[size:] - sums[:n]) * _DOWN[:n]
    h ^= h >> np.uint64(32)
    h *= _SPREAD
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``values[i : i + width]`` for each ``i`` that has so many."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchored_pieces(text: np.ndarray, valid: np.ndarray, length: int, gram: int):
    """Pieces of the window starts marked ``valid``: first start, starts, anchor hash."""
    grams = block_hashes(text, gram)
    places = np.uint64((1 << 22) - 1)
    ranked = (grams & ~places) | (places - np.arange(len(grams), dtype=np.uint64))
    least = _sliding_min(ranked, length - gram + 1)
    anchor = (places - (least & places)).astype(np.int64)
    starts = np.flatnonzero(valid[: len(anchor)])
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    at = anchor[starts]
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(starts) != 1)]))
    count = np.diff(np.concatenate([first, [len(starts)]]))
    return starts[first], count, grams[at[first]]


# ---- the transforms of a working set ----------------------------------------------


def _stable_order(symbols: np.ndarray) -> np.ndarray:
    """Counting-sort order of symbols below 2**32, sixteen bits at a time."""
    order = np.argsort((symbols & 0xFFFF).astype(np.uint16), kind="stable")
    if len(symbols) and symbols.max() > 0xFFFF:
        high = (symbols >> 16).astype(np.uint16)
        order = order[np.argsort(high[order], kind="stable")]
    return order


class Shard:
    """Suffix order of some pieces to ``depth`` symbols, and the symbols before the suffixes.

    ``before[p]`` is the suffix one symbol ahead of ``p``; the first suffix of a string is
    preceded by its end, whose symbol is the smallest.
    """

    def __init__(self, before: np.ndarray, symbol_before: np.ndarray, depth: int):
        order = np.arange(len(before), dtype=np.int32)
        for _ in range(depth):
            order = before[order[_stable_order(symbol_before[order])]]
        self.order = order
        self.transform = symbol_before[order]


def merge_shards(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Interleave of the shards' orders, block of each place, and common prefix with the last.

    The common prefix counts symbols, ``depth`` at most.
    """
    owner = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(s.order) for s in shards])
    block = np.zeros(len(owner), np.int32)
    prefix = np.full(len(owner), depth, np.int8)
    symbols = np.empty(len(owner), np.int32)
    for done in range(depth):
        for k, shard in enumerate(shards):
            symbols[owner == k] = shard.transform
        order = _stable_order(symbols)
        owner, dealt, inside = owner[order], symbols[order], block[order]
        starts = np.ones(len(owner), bool)
        starts[1:] = (dealt[1:] != dealt[:-1]) | (inside[1:] != inside[:-1])
        prefix[starts & (prefix == depth)] = done
        block = np.cumsum(starts, dtype=np.int32) - 1
    return owner, block, prefix


def repeated_starts(
    pieces: list[bytes], weights: list[int], length: int, depth: int = DEPTH, shard_bytes: int = SHARD
) -> list[np.ndarray]:
    """For each piece, which of its window starts occur more than once, weights counted."""
    while length % depth:
        depth -= 1
    size = length // depth
    # Offsets fit 32 bits: a working set is bounded, and so is a group of pieces.
    sizes = np.array([len(p) for p in pieces], np.int32)
    text = np.frombuffer(b"".join(pieces), np.uint8)
    base = (np.cumsum(sizes + 1) - sizes - 1).astype(np.int32)  # a suffix at each byte and end
    n = int((sizes + 1).sum())
    piece = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes + 1)
    start = base[piece]
    place = np.arange(n, dtype=np.int32) - start
    last = sizes[piece]
    with_symbol = np.flatnonzero(place <= last - size)
    hashes = block_hashes(text, size)[with_symbol - piece[with_symbol]]
    symbol = np.zeros(n, np.int32)
    symbol[with_symbol] = np.unique(hashes, return_inverse=True)[1] + 1
    first = place < size
    before = np.arange(n, dtype=np.int32) - size
    before[first] = (start + place + size * ((last - place) // size))[first]
    symbol_before = symbol[before]
    symbol_before[first] = 0

    cuts = [0]
    for i, total in enumerate(np.cumsum(sizes + 1).tolist()):
        if total - (int(base[cuts[-1]]) if cuts[-1] < len(base) else 0) >= shard_bytes:
            cuts.append(i + 1)
    if cuts[-1] != len(pieces):
        cuts.append(len(pieces))
    bounds = np.concatenate([base, [n]])
    shards, offsets = [], []
    for a, b in zip(cuts, cuts[1:], strict=False):
        lo, hi = int(bounds[a]), int(bounds[b])
        shards.append(Shard(before[lo:hi] - lo, symbol_before[lo:hi], depth))
        offsets.append(lo)
    owner, block, _ = merge_shards(shards, depth)
    suffix = np.empty(n, np.int32)
    for k, shard in enumerate(shards):
        suffix[owner == k] = shard.order + offsets[k]
    is_start = place <= last - length
    window = is_start[suffix]
    weight = np.where(window, np.asarray(weights, np.float64)[piece[suffix]], 0)
    heavy = np.bincount(block, weight) > 1
    repeated = np.zeros(n, bool)
    repeated[suffix] = heavy[block] & window
    return [
        repeated[b : b + m - length + 1] for b, m in zip(base.tolist(), sizes.tolist(), strict=True)
    ]


# ---- Spark ------------------------------------------------------------------------

KEY = ("k", "th")
_PACKED = pa.schema(
    [("doc_id", pa.int64()), ("k", pa.int64()), ("th", pa.int64()), ("packed", pa.binary())]
)
_RUNS = pa.schema(
    [(c, pa.int64()) for c in ("k", "th", "s")] + [("n", pa.int32())]
    + [(c, pa.int64()) for c in ("h", "d1", "d2")]
)


def _keyed(docs: DataFrame) -> DataFrame:
    """``k`` and ``th`` tell rows apart; equal rows share them, which changes no result."""
    doc_id = F.col("doc_id").cast("long")
    return docs.withColumns(
        {
            "k": F.coalesce(doc_id, F.lit(0)),
            "th": F.xxhash64(doc_id.isNull(), F.coalesce("text", F.lit(""))),
        }
    )


def _scan(k, th, texts, length, gram):
    """Run columns of some whole texts that are scanned together."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) < length:
        return
    ends = np.cumsum(sizes)
    begins = ends - sizes
    valid = np.zeros(len(data) + 1, np.int8)
    fits = sizes >= length
    np.add.at(valid, begins[fits], 1)
    np.add.at(valid, ends[fits] - length + 1, -1)
    yield from _runs(k, th, data, np.cumsum(valid[:-1]) > 0, begins, length, gram)


def _runs(k, th, data, valid, begins, length, gram):
    s, n, h = anchored_pieces(data, valid, length, gram)
    if not len(s):
        return
    row = np.searchsorted(begins, s, side="right") - 1
    raw = data.tobytes()
    digest = hashlib.blake2b
    digests = np.frombuffer(
        b"".join(
            digest(raw[a:b], digest_size=16).digest()
            for a, b in zip(s.tolist(), (s + n + length - 1).tolist(), strict=True)
        ),
        "<i8",
    ).reshape(-1, 2)
    arrays = (k[row], th[row], s - begins[row], n.astype(np.int32), h.view(np.int64), *digests.T)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(a), type=f.type) for a, f in zip(arrays, _RUNS, strict=True)], schema=_RUNS
    )


def pieces_of(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """Pieces of all rows: row key, first start, starts, anchor hash, digest of the bytes."""

    def scan(batches):
        for batch in batches:
            keys = [np.asarray(batch.column(i)) for i in range(2)]
            held, rows, size = [], [], 0
            for i, text in enumerate(column(batch, "text")):
                data = (text or "").encode()
                if len(data) > SCAN:
                    yield from _scan_long(keys[0][i : i + 1], keys[1][i : i + 1], data, length, gram)
                    continue
                if size + len(data) > SCAN:
                    yield from _scan(keys[0][rows], keys[1][rows], held, length, gram)
                    held, rows, size = [], [], 0
                held.append(data)
                rows.append(i)
                size += len(data)
            if held:
                yield from _scan(keys[0][rows], keys[1][rows], held, length, gram)

    return keyed.select(*KEY, "text").mapInArrow(
        scan, "k long, th long, s long, n int, h long, d1 long, d2 long"
    )


def _scan_long(k, th, data, length, gram):
    """A text longer than a scan: every window start is in exactly one part."""
    for at in range(0, len(data) - length + 1, SCAN):
        part = np.frombuffer(data[at : at + SCAN + length - 1], np.uint8)
        valid = np.ones(len(part) - length + 1, bool)
        yield from _runs(k, th, part, valid, np.array([-at]), length, gram)


def _cut_bytes(joined: DataFrame, length: int) -> DataFrame:
    """The bytes of the listed pieces of each row."""
    schema = pa.schema(
        [(c, pa.int64()) for c in ("h", "d1", "d2")] + [("w", pa.int64()), ("data", pa.binary())]
    )

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for packed, pieces in zip(column(batch, "packed"), column(batch, "pieces"), strict=True):
                text = unpack.decompress(packed)
                rows = [
                    (p["h"], p["d1"], p["d2"], p["w"], text[p["s"] : p["s"] + p["n"] + length - 1])
                    for p in pieces
                ]
                yield from record_batches(rows, schema, 5000)

    return joined.mapInArrow(cut, "h long, d1 long, d2 long, w long, data binary")


_SPANS = "h long, d1 long, d2 long, spans array<struct<a:int,b:int>>"
_SPAN_SCHEMA = pa.schema(
    [(c, pa.int64()) for c in ("h", "d1", "d2")]
    + [("spans", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))]
)


def _span_list(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


def _merge_groups(data: DataFrame, length: int) -> DataFrame:
    """Repeated starts of pieces, group by group, as ``[a, b)`` ranges of each piece's starts."""

    def merge(batches):
        keys, texts, weights, size, last = [], [], [], 0, None
        for batch in batches:
            rows = zip(*(column(batch, c) for c in ("h", "d1", "d2", "w", "data")), strict=True)
            for h, d1, d2, w, text in rows:
                if h != last and size >= WORKING_SET:
                    yield from merged(keys, texts, weights)
                    keys, texts, weights, size = [], [], [], 0
                last = h
                keys.append((h, d1, d2))
                texts.append(text)
                weights.append(w)
                size += len(text)
        if keys:
            yield from merged(keys, texts, weights)

    def merged(keys, texts, weights):
        found = zip(keys, repeated_starts(texts, weights, length), strict=True)
        rows = [(*key, _span_list(flags)) for key, flags in found if flags.any()]
        if rows:
            yield to_batch(rows, _SPAN_SCHEMA)

    return data.repartition("h").sortWithinPartitions("h").mapInArrow(merge, _SPANS)


def _single_windows(data: DataFrame, length: int) -> DataFrame:
    """The same for groups that are too large to gather: every window is counted by itself."""
    schema = pa.schema([(c, pa.int64()) for c in ("h", "d1", "d2", "w1", "w2", "w")] + [("a", pa.int32())])

    def windows(batches):
        for batch in batches:
            rows = zip(*(column(batch, c) for c in ("h", "d1", "d2", "w", "data")), strict=True)
            for h, d1, d2, w, text in rows:
                n = len(text) - length + 1
                digests = np.frombuffer(
                    b"".join(
                        hashlib.blake2b(text[i : i + length], digest_size=16).digest() for i in range(n)
                    ),
                    "<i8",
                ).reshape(-1, 2)
                yield to_batch(
                    [(h, d1, d2, *pair, w, i) for i, pair in enumerate(digests.tolist())], schema
                )

    rows = data.mapInArrow(windows, "h long, d1 long, d2 long, w1 long, w2 long, w long, a int")
    rows = materialise(rows, "windows")
    often = rows.groupBy("h", "w1", "w2").agg(F.sum("w").alias("times")).filter("times > 1")
    return (
        rows.join(often, ["h", "w1", "w2"])
        .groupBy("h", "d1", "d2")
        .agg(F.collect_list(F.struct("a", (F.col("a") + 1).alias("b"))).alias("spans"))
    )


def repeated_ranges(
    keyed: DataFrame, packed: DataFrame, length: int, gram: int, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """``(k, th, spans)``: ranges ``[a, b)`` of repeated window starts of each row that has any."""
    runs = materialise(pieces_of(keyed, length, gram), "pieces")
    piece = ["h", "d1", "d2"]
    groups = runs.groupBy("h").agg(
        F.count(F.lit(1)).alias("times"),
        F.min("d1").alias("lo1"), F.max("d1").alias("hi1"),
        F.min("d2").alias("lo2"), F.max("d2").alias("hi2"),
    ).filter("times > 1")
    one = (F.col("lo1") == F.col("hi1")) & (F.col("lo2") == F.col("hi2"))
    # Written down, so that the join reads it from a shuffle and a hot anchor can be split.
    groups = materialise(groups.select("h", one.alias("one")), "anchor-groups")
    active = materialise(runs.join(groups, "h"), "active-pieces")

    several = active.filter("not one").groupBy(*piece).agg(
        F.count(F.lit(1)).alias("w"), F.min(F.struct("k", "th", "s", "n")).alias("at")
    )
    sizes = several.groupBy("h").agg(F.count(F.lit(1)).alias("pieces")).withColumn(
        "large", F.col("pieces") > group_pieces
    )
    per_row = several.select("at.*", *piece, "w").groupBy(*KEY).agg(
        F.collect_list(F.struct("s", "n", *piece, "w")).alias("pieces")
    )
    data = materialise(
        _cut_bytes(packed.join(per_row, list(KEY)).select("packed", "pieces"), length)
        .dropDuplicates(piece)
        .join(sizes.select("h", "large"), "h"),
        "piece-bytes",
    )
    spans = _merge_groups(data.filter("not large"), length)
    if not data.filter("large").isEmpty():
        spans = spans.unionByName(_single_windows(data.filter("large"), length))
    decided = active.filter("one").select(
        *KEY, "s", F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).alias("spans")
    )
    merged = active.filter("not one").join(spans, piece).select(*KEY, "s", "spans")
    moved = F.transform(
        "spans", lambda x: F.struct((x["a"] + F.col("s")).alias("a"), (x["b"] + F.col("s")).alias("b"))
    )
    return (
        decided.unionByName(merged)
        .select(*KEY, moved.alias("spans"))
        .groupBy(*KEY)
        .agg(F.flatten(F.collect_set("spans")).alias("spans"))
    )


def cut_ranges(text: bytes, spans: list[dict] | None, length: int) -> tuple[bytes, int, int]:
    """What is left of the text, bytes removed, and maximal removed runs."""
    kept, removed, runs = kept_parts(text, spans, length)
    return b"".join(kept), removed, runs


def kept_parts(
    text: bytes, spans: list[dict] | None, length: int
) -> tuple[list[bytes], int, int]:
    """The parts that are left, bytes removed, and maximal removed runs."""
    if not spans:
        return [text], 0, 0
    kept, removed, runs, at = [], 0, 0, 0
    starts = np.array([(s["a"], s["b"]) for s in spans], np.int64)
    starts = starts[np.argsort(starts[:, 0], kind="stable")]
    end = -1
    for a, b in zip(starts[:, 0].tolist(), (starts[:, 1] + length - 1).tolist(), strict=True):
        if a > end:
            if end >= 0:
                removed += end - begin
                at = end
            kept.append(text[at:a])
            begin, end, runs = a, b, runs + 1
        else:
            end = max(end, b)
    removed += end - begin
    kept.append(text[end:])
    return kept, removed, runs


def _with_ranges(
    docs: DataFrame, columns: list[str], length: int, gram: int, group_pieces: int = GROUP_PIECES
):
    """``docs`` with their packed text and the ranges of repeated starts, text left out."""
    short_batches(docs.sparkSession)
    keyed = _keyed(docs)
    others = [c for c in columns if c != "text"]
    fields = keyed.select(*others, *KEY).schema

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            at = batch.schema.get_field_index("__text")
            arrays = [batch.column(i) for i in range(batch.num_columns) if i != at]
            packed = [squeeze((t or "").encode()) for t in column(batch, "__text")]
            names = [f"c{i}" for i in range(len(arrays))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(packed, pa.binary())], names=[*names, "packed"])

    numbered = keyed.select(
        *[F.col(f.name).alias(f"c{i}") for i, f in enumerate(fields)], F.col("text").alias("__text")
    )
    out = numbered.drop("__text").schema.add("packed", "binary")
    packed = numbered.mapInArrow(pack, out).select(
        *[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)], "packed"
    )
    narrow = packed.select(*KEY, "packed")
    ranges = repeated_ranges(keyed, narrow, length, gram, group_pieces)
    return packed.join(ranges, list(KEY), "left")


def removal_report(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty; a text shorter than ``length`` keeps all. Rows that repeat count
    as different places. An empty table gives an empty result.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
         ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    )

    def report(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc_id, packed, spans in zip(
                *(column(batch, c) for c in ("doc_id", "packed", "spans")), strict=True
            ):
                text = unpack.decompress(packed)
                kept, removed, runs = cut_ranges(text, spans, length)
                rows.append((doc_id, len(text), removed, runs, hashlib.sha256(kept).hexdigest()))
            yield from record_batches(rows, schema)

    joined = _with_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id", "text"], length, gram, group_pieces)
    return joined.select("doc_id", "packed", "spans").mapInArrow(
        report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text``; ``n_chars``, if there, follows.

    A cut inside a character takes the rest of the character as well, as text must stay
    UTF-8. A null text stays null.
    """
    columns = docs.columns
    # Columns of the table may have any name, also one that is used here.
    own = {c: c if c in ("doc_id", "text") else f"own{i}" for i, c in enumerate(columns)}
    marked = docs.select(*[F.col(c).alias(n) for c, n in own.items()]).withColumn(
        "__null", F.col("text").isNull()
    )
    joined = _with_ranges(marked, marked.columns, length, gram)
    fields = joined.select("packed", "spans", *[n for n in own.values() if n != "text"], "__null")
    names = fields.columns
    numbered = fields.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])

    def cut(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = []
            for packed, spans, null in zip(
                *(column(batch, f"c{i}") for i in (0, 1, len(names) - 1)), strict=True
            ):
                # Part by part: the halves of two cut characters must not make a third.
                parts = kept_parts(unpack.decompress(packed), spans, length)[0]
                kept = "".join(part.decode("utf-8", "ignore") for part in parts)
                texts.append(None if null else kept)
            arrays = [batch.column(i) for i in range(2, len(names) - 1)]
            labels = [f"c{i}" for i in range(2, len(names) - 1)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(texts, pa.string())], names=[*labels, "text"])

    out = numbered.drop("c0", "c1", f"c{len(names) - 1}").schema.add("text", "string")
    done = numbered.mapInArrow(cut, out).select(
        *[F.col(f"c{i}").alias(names[i]) for i in range(2, len(names) - 1)], "text"
    )
    values = {c: F.col(n) for c, n in own.items()}
    if "n_chars" in columns:
        values["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return done.select(*[v.alias(c) for c, v in values.items()])
