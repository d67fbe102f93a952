"""Byte-level BPE by a segment tree over byte positions.

A leaf belongs to a byte position and holds the rank of the pair that starts there (or
nothing); an inner node holds the smallest rank below it and its leftmost position, as
the one number ``rank * size + position``. The root is the next merge. A merge changes the
leaf where it happened, the leaf that it swallowed and the leaf of the live neighbour on
the left: three paths to the root, so it costs the logarithm of the length. Live
neighbours are linked, as positions die.

Short matches of a batch are merged in lockstep: one tree per row of an array, one merge
per row and step. Long ones have a tree of their own. Both give the same ids.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column, record_batches, short_batches, text_column
from tidemark.llm.units import UnitEncoder

NONE = np.int64(1) << 60
#: Bytes of the longest match that is merged in lockstep.
LOCKSTEP = 64
#: Matches in a lockstep group; bounds the arrays.
GROUP = 20_000

DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


class ByteBpe:
    """Ranks of byte strings, as in a rank file; the id of a token is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.vocabulary = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.vocabulary[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.base = len(self.vocabulary)
        pairs = {
            ranks[token[:i]] * self.base + ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.merged = pairs
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)

    @classmethod
    def from_file(cls, path: str) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def encode_matches(self, matches: list[bytes]) -> list[np.ndarray]:
        """Ids of each match. A match that is a token itself is that token."""
        out: list[np.ndarray | None] = [None] * len(matches)
        by_size: dict[int, list[int]] = {}
        for i, match in enumerate(matches):
            whole = self.ranks.get(match)
            if whole is not None:
                out[i] = np.array([whole], dtype=np.int64)
            elif len(match) > LOCKSTEP:
                out[i] = self._merge_long(match)
            else:
                by_size.setdefault(1 << max(1, (len(match) - 1).bit_length()), []).append(i)
        for size, members in by_size.items():
            for k in range(0, len(members), GROUP):
                part = members[k : k + GROUP]
                for i, ids in zip(part, self._merge_lockstep([matches[i] for i in part], size), strict=True):
                    out[i] = ids
        return out

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens, NONE where they don't merge."""
        keys = left * self.base + right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NONE)

    def _merge_lockstep(self, matches: list[bytes], size: int) -> list[np.ndarray]:
        n = len(matches)
        lengths = np.fromiter(map(len, matches), np.int64, n)
        text = np.frombuffer(b"".join(m.ljust(size, b"\0") for m in matches), np.uint8).reshape(n, size)
        place = np.arange(size)
        token = self.single[text]
        after = np.broadcast_to(place + 1, (n, size)).copy()
        before = np.broadcast_to(place - 1, (n, size)).copy()
        tree = np.full((n, 2 * size), NONE)
        pairs = self._pair(token[:, :-1], token[:, 1:])
        inside = (place[1:] < lengths[:, None]) & (pairs < NONE)
        tree[:, size:-1] = np.where(inside, pairs * size + place[:-1], NONE)
        level = size
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(
                tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2]
            )
            level //= 2
        live = place < lengths[:, None]
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            rank, at = np.divmod(tree[rows, 1], size)
            gone = after[rows, at]
            far = after[rows, gone]
            token[rows, at] = rank
            live[rows, gone] = False
            after[rows, at] = far
            has_far = far < lengths[rows]
            safe_far = np.where(has_far, far, at)
            before[rows[has_far], far[has_far]] = at[has_far]
            left = before[rows, at]
            has_left = left >= 0
            safe_left = np.where(has_left, left, at)
            right_pair = np.where(has_far, self._pair(rank, token[rows, safe_far]), NONE)
            left_pair = np.where(has_left, self._pair(token[rows, safe_left], rank), NONE)
            tree[rows, size + gone] = NONE
            left_key = np.where(left_pair < NONE, left_pair * size + safe_left, NONE)
            tree[rows[has_left], size + left[has_left]] = left_key[has_left]
            tree[rows, size + at] = np.where(right_pair < NONE, right_pair * size + at, NONE)
            up = np.stack([size + gone, size + at, size + safe_left])
            while up[0, 0] > 1:
                up >>= 1
                for node in up:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            rows = rows[tree[rows, 1] < NONE]
        counts = live.sum(axis=1)
        return np.split(token[live], np.cumsum(counts)[:-1])

    def _merge_long(self, match: bytes) -> np.ndarray:
        n = len(match)
        size = 1 << (n - 1).bit_length()
        none, base, merged = int(NONE), self.base, self.merged
        token = self.single[np.frombuffer(match, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = bytearray(b"\1" * n)
        tree = [none] * (2 * size)

        def key(left: int, right: int) -> int:
            rank = merged.get(token[left] * base + token[right])
            return none if rank is None else rank * size + left

        for i in range(n - 1):
            tree[size + i] = key(i, i + 1)
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(i: int, value: int) -> None:
            i += size
            tree[i] = value
            i >>= 1
            while i:
                least = min(tree[2 * i], tree[2 * i + 1])
                if tree[i] == least:
                    break
                tree[i] = least
                i >>= 1

        while tree[1] < none:
            rank, at = divmod(tree[1], size)
            gone = after[at]
            far = after[gone]
            token[at], alive[gone], after[at] = rank, 0, far
            put(gone, none)
            put(at, key(at, far) if far < n else none)
            if far < n:
                before[far] = at
            left = before[at]
            if left >= 0:
                put(left, key(left, at))
        return np.array([t for t, a in zip(token, alive, strict=True) if a], dtype=np.int64)


@lru_cache(maxsize=2)
def bpe_coder(path: str, pattern: str) -> tuple[UnitEncoder, pa.Array, pa.Array]:
    """Encoder of whole texts; tokens by id; ids as decimal numbers with a space after them."""
    bpe = ByteBpe.from_file(path)
    # White space by its Unicode property, as in the library that the ranks come from.
    matches = regex.compile(
        pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    )
    remembered: dict[str, bytes] = {}

    def encode_units(units: list[str]) -> list[bytes]:
        found = [matches.findall(u) for u in units]
        if len(remembered) > 500_000:
            remembered.clear()
        new = list({m: None for f in found for m in f if m not in remembered})
        ids = bpe.encode_matches([m.encode() for m in new])
        remembered.update(zip(new, (x.astype("<u4").tobytes() for x in ids), strict=True))
        return [b"".join(map(remembered.__getitem__, f)) for f in found]

    tokens = pa.array(bpe.vocabulary, type=pa.large_binary())
    numbers = pa.array([b"%d " % i for i in range(bpe.base)], type=pa.large_binary())
    return UnitEncoder(encode_units, True), tokens, numbers


def _looked_up(values: pa.Array, ids: np.ndarray, ends: np.ndarray) -> list[memoryview]:
    """For each run of ids up to ``ends``, the joined values of its ids."""
    found = values.take(pa.array(ids, type=pa.int32()))
    offsets = np.frombuffer(found.buffers()[1], "<i8")[: len(ids) + 1]
    data = memoryview(found.buffers()[2]) if len(ids) else memoryview(b"")
    cuts = offsets[np.concatenate([[0], ends])].tolist()
    return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def encode_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text is an empty one, with no ids. Repeated rows give repeated rows; other
    columns are not read. The digests are of the decimal ids joined by one space and of
    the bytes that the ids decode to.
    """
    short_batches(docs.sparkSession)

    def digest(batches):
        encoder, tokens, numbers = bpe_coder(ranks, pattern)
        for batch in batches:
            coded = encoder.encode(text_column(batch))
            ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
            ends = np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)
            rows = (
                (
                    doc_id,
                    len(c) // 4,
                    hashlib.sha256(decimal[:-1]).hexdigest(),
                    hashlib.sha256(text).hexdigest(),
                )
                for doc_id, c, decimal, text in zip(
                    column(batch, "doc_id"),
                    coded,
                    _looked_up(numbers, ids, ends),
                    _looked_up(tokens, ids, ends),
                    strict=True,
                )
            )
            yield from record_batches(rows, DIGESTS)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
