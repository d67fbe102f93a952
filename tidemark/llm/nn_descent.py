"""Approximate nearest neighbours: NN-descent graph and greedy search of it.

**Graph.** Every vector starts with the best neighbours of a few random blocks: vectors in
the order of a random projection, some hundreds at a time. Then rounds: each node's list is
joined with the lists it stands in, members of one list are neighbours of neighbours of
each other, and whoever improves another's list is added to it. A round is a join of the
edges with the node table, a shuffle to the list's owner, and a merge by node. Scores inside
the graph are of 8-bit copies of the vectors.

**Search.** A query keeps a beam of its best nodes. A hop expands the best ones not yet
expanded: their neighbours are looked up and scored where they are stored, in partitions
of the node table, and only those that enter the beam travel back. The beams travel with the
questions, so that hops follow each other without being written down, ``CHAIN`` at a time. It
ends when every beam is expanded; the beam is then scored on the original vectors in double
precision.

Equal vectors are one node. Lists have a fixed length, as in any such graph; the members of
a node that stands in very many lists are dealt to several tasks, none is left out. Working sets are bounded: a task merges some nodes at a time and joins ``CENTER``
members at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import column, materialise, record_batches, to_batch
from tidemark.llm.vectors import matrix, packed_vectors, stored_type

NEIGHBOURS = 24
ROUNDS = 5
PASSES = 3
BLOCK = 256
#: Members that are joined at once.
CENTER = 128
#: Links of a node that a search follows: its list and the lists it stands in.
SEARCH_LINKS = 64
BEAM = 400
EXPANDED = 100
#: Hops in one job; the beams are written down after them.
CHAIN = 4
TOP = 20
SHARD_NODES = 16_384
#: Candidate pairs held by a task before they are merged.
HELD = 1_000_000

LISTS = "u long, q binary, scale float, ids binary, scores binary, worst float"
_LIST_SCHEMA = pa.schema(
    [
        ("u", pa.int64()),
        ("q", pa.binary()),
        ("scale", pa.float32()),
        ("ids", pa.binary()),
        ("scores", pa.binary()),
        ("worst", pa.float32()),
    ]
)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit copies and their scales."""
    scale = np.abs(vectors).max(axis=1) / 127
    return np.rint(vectors / scale[:, None]).astype(np.int8), scale.astype(np.float32)


def best_per_node(u: np.ndarray, v: np.ndarray, score: np.ndarray, k: int):
    """The ``k`` best different ``v`` of each ``u``, by falling score and rising ``v``."""
    order = np.lexsort((v, u))
    u, v, score = u[order], v[order], score[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    new &= u != v
    u, v, score = u[new], v[new], score[new]
    order = np.lexsort((v, -score, u))
    u, v, score = u[order], v[order], score[order]
    starts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.zeros(0, int)
    rank = np.arange(len(u)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(u)]])))
    keep = rank < k
    return u[keep], v[keep], score[keep]


def _lists(u, v, score, k, codes=None):
    """List rows of the best candidates; ``codes`` adds the node's own copy and scale."""
    u, v, score = best_per_node(u, v, score, k)
    starts = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.zeros(0, int)
    ends = np.concatenate([starts[1:], [len(u)]]) if len(u) else starts
    v, score = v.astype("<i8"), score.astype("<f4")
    rows = []
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        node = int(u[a])
        q, scale = codes.pop(node) if codes is not None else (None, None)
        worst = float(score[b - 1]) if b - a == k else -np.inf
        rows.append((node, q, scale, v[a:b].tobytes(), score[a:b].tobytes(), worst))
    if codes:
        rows += [(node, q, scale, b"", b"", -np.inf) for node, (q, scale) in codes.items()]
    return rows


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list per node from rows of ``LISTS``; the row with ``q`` is the node's own."""

    def merge(batches):
        us, vs, scores, codes, size, last = [], [], [], {}, 0, None
        for batch in batches:
            names = ("u", "q", "scale", "ids", "scores")
            for u, q, scale, ids, score in zip(*(column(batch, c) for c in names), strict=True):
                if u != last and size >= HELD:
                    yield from flush(us, vs, scores, codes)
                    us, vs, scores, codes, size = [], [], [], {}, 0
                last = u
                if q is not None:
                    codes[u] = (q, scale)
                us.append((u, len(ids) // 8))
                vs.append(ids)
                scores.append(score)
                size += len(ids) // 8
        yield from flush(us, vs, scores, codes)

    def flush(us, vs, scores, codes):
        if us:
            pairs = np.array(us, np.int64)
            u = np.repeat(pairs[:, 0], pairs[:, 1])
            v, score = np.frombuffer(b"".join(vs), "<i8"), np.frombuffer(b"".join(scores), "<f4")
            yield from record_batches(_lists(u, v, score, k, codes), _LIST_SCHEMA)

    return lists.repartition("u").sortWithinPartitions("u").mapInArrow(merge, LISTS)


# ---- graph ------------------------------------------------------------------------


def _nodes(packed: DataFrame, dtype: str, top: int) -> DataFrame:
    """``(u, q, scale, vec, ids)`` of every different vector; ``ids`` its smallest rows.

    More rows of one vector than ``top`` and the query itself are never asked for.
    """
    rank = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = packed.filter("vec is not null").withColumn("rank", rank).filter(F.col("rank") <= top + 1)
    nodes = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    def code(batches):
        schema = pa.schema(
            [("u", pa.int64()), ("q", pa.binary()), ("scale", pa.float32()), ("vec", pa.binary()),
             ("ids", pa.list_(pa.int64()))]
        )
        for batch in batches:
            vectors = column(batch, "vec")
            coded: list = [None] * len(vectors)
            for size in set(map(len, vectors)):
                here = [i for i, v in enumerate(vectors) if len(v) == size]
                q, scale = quantise(matrix([vectors[i] for i in here], dtype))
                for i, row, s in zip(here, q, scale.tolist(), strict=True):
                    coded[i] = (row.tobytes(), s)
            yield from record_batches(
                (
                    (u, *c, vec, ids)
                    for u, c, vec, ids in zip(column(batch, "u"), coded, vectors, column(batch, "ids"), strict=True)
                ),
                schema,
            )

    return nodes.select(F.xxhash64("vec").alias("u"), "vec", "ids").mapInArrow(
        code, "u long, q binary, scale float, vec binary, ids array<long>"
    )


def _dots(q: list[bytes], scale: list[float]) -> np.ndarray:
    m = np.frombuffer(b"".join(q), np.int8).reshape(len(q), -1).astype(np.float32)
    m *= np.array(scale, np.float32)[:, None]
    return m @ m.T


def _block_lists(nodes: DataFrame, passes: int, k: int, block: int) -> DataFrame:
    """Lists within blocks of the orders of random projections, all ``passes`` in one shuffle."""

    def project(batches):
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            at = []
            for q, scale in zip(column(batch, "q"), column(batch, "scale"), strict=True):
                if len(q) not in lines:
                    lines[len(q)] = np.array(
                        [np.random.default_rng([i, len(q)]).standard_normal(len(q)) for i in range(passes)]
                    )
                at.append(lines[len(q)] @ np.frombuffer(q, np.int8) * scale)
            places = np.array(at, np.float64).reshape(-1, passes)
            for i in range(passes):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2),
                     pa.array(np.full(len(at), i, np.int32)), pa.array(places[:, i])],
                    names=["u", "q", "scale", "number", "at"],
                )

    def join_blocks(batches):
        held: list[tuple] = []
        last = None
        for batch in batches:
            for *row, number in zip(*(column(batch, c) for c in ("u", "q", "scale", "number")), strict=True):
                if number != last or len(held) == 2 * block:
                    end = block if number == last else len(held)
                    yield from record_batches(_joined_block(held[:end], k), _LIST_SCHEMA)
                    held, last = held[end:], number
                held.append(row)
        # The rest of an order in a partition is one block, so that few are very small.
        yield from record_batches(_joined_block(held, k), _LIST_SCHEMA)

    ordered = nodes.select("u", "q", "scale").mapInArrow(
        project, "u long, q binary, scale float, number int, at double"
    )
    return (
        ordered.repartitionByRange("number", "at").sortWithinPartitions("number", "at").mapInArrow(join_blocks, LISTS)
    )


def _joined_block(held: list[tuple], k: int) -> list[tuple]:
    out: list[tuple] = []
    for size in {len(r[1]) for r in held}:
        rows = [r for r in held if len(r[1]) == size]
        u = np.array([r[0] for r in rows], np.int64)
        score = _dots([r[1] for r in rows], [r[2] for r in rows])
        np.fill_diagonal(score, -np.inf)
        n = min(k, len(rows) - 1)
        if n:
            near = np.argpartition(-score, n - 1, axis=1)[:, :n]
            out += _lists(
                np.repeat(u, n), u[near].ravel(), np.take_along_axis(score, near, 1).ravel(), k
            )
    return out


def _edges(graph: DataFrame) -> DataFrame:
    """``(c, m)``: every node with itself, with its neighbours, and with those it is one of."""

    def explode(batches):
        for batch in batches:
            u = np.asarray(batch.column(0))
            counts = [len(x) // 8 for x in column(batch, "ids")]
            c = np.repeat(u, counts)
            v = np.frombuffer(b"".join(column(batch, "ids")), "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([c, v, u])), pa.array(np.concatenate([v, c, u]))],
                names=["c", "m"],
            )

    return graph.select("u", "ids").mapInArrow(explode, "c long, m long")


def _round(graph: DataFrame, k: int) -> DataFrame:
    """One round: members of each list, and of the lists' owners, meet each other."""
    members = _edges(graph).join(graph.select(F.col("u").alias("m"), "q", "scale", "worst"), "m")
    # A node's members meet where its row is. The join is a merge join, so that they come sorted by
    # node and Spark splits those of a node that stands in very many lists over several tasks.
    owners = graph.select(F.col("u").alias("c")).hint("merge")
    placed = members.join(owners, "c").select("c", "m", "q", "scale", "worst")

    def meet(batches):
        held: list[tuple] = []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size, last = 0, None
        for batch in batches:
            names = ("c", "m", "q", "scale", "worst")
            for row in zip(*(column(batch, x) for x in names), strict=True):
                if held and (row[0] != last or len(held) == CENTER):
                    found.append(_met(held))
                    size += len(found[-1][0])
                    held = []
                    if size >= HELD:
                        yield from record_batches(_lists(*map(np.concatenate, zip(*found, strict=True)), k), _LIST_SCHEMA)
                        found, size = [], 0
                last = row[0]
                held.append(row)
        if held:
            found.append(_met(held))
        if found:
            yield from record_batches(_lists(*map(np.concatenate, zip(*found, strict=True)), k), _LIST_SCHEMA)

    better = placed.sortWithinPartitions("c").mapInArrow(meet, LISTS)
    return _merged(graph.unionByName(better), k)


def _met(held: list[tuple]):
    """Pairs of members that improve the list of the first of them."""
    unique = {r[1]: r for r in held}
    sizes = {len(r[2]) for r in unique.values()}
    us, vs, scores = [], [], []
    for size in sizes:
        rows = [r for r in unique.values() if len(r[2]) == size]
        m = np.array([r[1] for r in rows], np.int64)
        score = _dots([r[2] for r in rows], [r[3] for r in rows])
        np.fill_diagonal(score, -np.inf)
        i, j = np.nonzero(score > np.array([r[4] for r in rows], np.float32)[:, None])
        us.append(m[i])
        vs.append(m[j])
        scores.append(score[i, j])
    return np.concatenate(us), np.concatenate(vs), np.concatenate(scores)


def build_graph(nodes: DataFrame, k: int = NEIGHBOURS, rounds: int = ROUNDS) -> DataFrame:
    """Rows of ``LISTS``: every node with its copy, scale and ``k`` neighbours."""
    own = nodes.select(
        "u", "q", "scale", F.lit(b"").alias("ids"), F.lit(b"").alias("scores"),
        F.lit(float("-inf")).cast("float").alias("worst"),
    )
    start = own.unionByName(_block_lists(nodes, PASSES, k, BLOCK))
    graph = materialise(_merged(start, k), "nn-graph")
    for _ in range(rounds):
        graph = materialise(_round(graph, k), "nn-graph")
    return graph


# ---- search -----------------------------------------------------------------------


def _search_links(graph: DataFrame, links: int) -> DataFrame:
    """The graph with the best ``links`` of each node, its neighbours' lists counted in."""

    def reverse(batches):
        for batch in batches:
            counts = [len(x) // 8 for x in column(batch, "ids")]
            u = np.repeat(np.asarray(batch.column(0)), counts)
            v = np.frombuffer(b"".join(column(batch, "ids")), "<i8")
            score = np.frombuffer(b"".join(column(batch, "scores")), "<f4")
            yield from record_batches(_lists(v, u, score, links), _LIST_SCHEMA)

    back = graph.select("u", "ids", "scores").mapInArrow(reverse, LISTS)
    return _merged(graph.unionByName(back), links)


_BEAM = "qid long, u long, q binary, scale float, ids binary, scores binary, done binary"
_BEAM_SCHEMA = pa.schema(
    [("qid", pa.int64()), ("u", pa.int64()), ("q", pa.binary()), ("scale", pa.float32()),
     ("ids", pa.binary()), ("scores", pa.binary()), ("done", pa.binary())]
)


#: Rows between the steps of a hop. A row with ``done`` is a beam on its way, others ask for
#: ``ids`` or bring them.
_STEP = (
    "shard long, qid long, u long, q binary, scale float, least float, ids binary, scores binary, done binary"
)
_STEP_SCHEMA = pa.schema(
    [("shard", pa.int64()), ("qid", pa.int64()), ("u", pa.int64()), ("q", pa.binary()), ("scale", pa.float32()),
     ("least", pa.float32()), ("ids", pa.binary()), ("scores", pa.binary()), ("done", pa.binary())]
)


def _hops(beams: DataFrame, table: DataFrame, shards: int, beam: int, expanded: int, hops: int) -> DataFrame:
    """Beams after ``hops`` times the best nodes not yet expanded were expanded."""

    def choose(batches):
        for batch in batches:
            rows = []
            for own in zip(*(column(batch, c) for c in _BEAM_SCHEMA.names), strict=True):
                qid, u, q, scale, ids, scores, done = own
                rows.append((qid % shards, qid, u, q, scale, None, ids, scores, done))
                least = float(np.frombuffer(scores, "<f4").min()) if len(scores) >= 4 * beam else -np.inf
                nodes = np.frombuffer(ids, "<i8")[np.frombuffer(done, np.int8) == 0][:expanded]
                for s, part in _by_shard(nodes, shards):
                    rows.append((s, qid, None, q, scale, least, part, None, None))
            yield from record_batches(rows, _STEP_SCHEMA)

    def follow(key, asked: pa.Table, stored: pa.Table) -> pa.Table:
        rows, asks = _parted(asked)
        if asks:
            u = stored["u"].to_numpy()
            order = np.argsort(u)
            links = stored["ids"].to_pylist()
            for _, qid, _, q, scale, least, nodes, *_ in asks:
                at = order[np.searchsorted(u[order], np.frombuffer(nodes, "<i8"))]
                near = np.unique(np.frombuffer(b"".join([links[i] for i in at.tolist()]), "<i8"))
                for s, part in _by_shard(near, shards):
                    rows.append((s, qid, None, q, scale, least, part, None, None))
        return pa.Table.from_batches(record_batches(rows, _STEP_SCHEMA), _STEP_SCHEMA)

    def score(key, asked: pa.Table, stored: pa.Table) -> pa.Table:
        rows, asks = _parted(asked)
        if asks:
            u = stored["u"].to_numpy()
            order = np.argsort(u)
            q, scales = stored["q"].to_pylist(), stored["scale"].to_numpy()
            size = max(map(len, q))
            codes = np.frombuffer(b"".join(x.ljust(size, b"\0") for x in q), np.int8).reshape(len(q), size)
            by_query: dict[int, list[tuple]] = {}
            for ask in asks:
                by_query.setdefault(ask[1], []).append(ask)
            for qid, mine in by_query.items():
                _, _, _, q, scale, least, *_ = mine[0]
                ids = np.unique(np.frombuffer(b"".join([r[6] for r in mine]), "<i8"))
                at = order[np.searchsorted(u[order], ids)]
                query = np.frombuffer(q.ljust(size, b"\0"), np.int8)[:size].astype(np.float32)
                value = (codes[at].astype(np.float32) @ query) * scales[at] * np.float32(scale)
                keep = value > least
                if keep.any():
                    found = (ids[keep].tobytes(), value[keep].astype("<f4").tobytes())
                    rows.append((None, qid, None, None, None, None, *found, None))
        return pa.Table.from_batches(record_batches(rows, _STEP_SCHEMA), _STEP_SCHEMA)

    def update(batches):
        rows = []
        for group in _by_query(batches, ("qid", "u", "q", "scale", "ids", "scores", "done")):
            own = next(r for r in group if r[6] is not None)
            ids, scores = np.frombuffer(own[4], "<i8"), np.frombuffer(own[5], "<f4")
            done = np.frombuffer(own[6], np.int8).copy()
            done[np.flatnonzero(done == 0)[:expanded]] = 1
            new = [r for r in group if r[6] is None]
            found = np.frombuffer(b"".join([r[4] for r in new]), "<i8")
            # A node is stored in one shard, so it comes once; those of the beam come again.
            fresh = ~np.isin(found, np.append(ids, own[0]))
            ids = np.concatenate([ids, found[fresh]])
            scores = np.concatenate([scores, np.frombuffer(b"".join([r[5] for r in new]), "<f4")[fresh]])
            done = np.concatenate([done, np.zeros(len(ids) - len(done), np.int8)])
            best = np.lexsort((ids, -scores))[:beam]
            rows.append((*own[:4], ids[best].astype("<i8").tobytes(), scores[best].astype("<f4").tobytes(), done[best].tobytes()))
            if len(rows) == 1000:
                yield to_batch(rows, _BEAM_SCHEMA)
                rows = []
        if rows:
            yield to_batch(rows, _BEAM_SCHEMA)

    links = table.select("shard", "u", "ids").groupBy("shard")
    codes = table.select("shard", "u", "q", "scale").groupBy("shard")
    asked = beams.mapInArrow(choose, _STEP)
    for hop in range(hops):
        followed = asked.groupBy("shard").cogroup(links).applyInArrow(follow, _STEP)
        scored = followed.groupBy("shard").cogroup(codes).applyInArrow(score, _STEP)
        placed = scored.repartition("qid").sortWithinPartitions("qid")
        if hop + 1 == hops:
            return placed.mapInArrow(update, _BEAM)
        asked = placed.mapInArrow(lambda batches: choose(update(batches)), _STEP)
    return beams


def _by_shard(nodes: np.ndarray, shards: int):
    """``(shard, its nodes)`` of every shard that has some."""
    shard = np.mod(nodes, shards)
    order = np.argsort(shard, kind="stable")
    nodes, shard = nodes[order], shard[order]
    cuts = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(nodes)][: len(cuts)], strict=True):
        yield int(shard[a]), nodes[a:b].tobytes()


def _parted(step: pa.Table) -> tuple[list[tuple], list[tuple]]:
    """Rows of beams on their way, and rows that ask."""
    columns = [step[name].to_pylist() for name in _STEP_SCHEMA.names]
    rows = list(zip(*columns, strict=True))
    return [r for r in rows if r[8] is not None], [r for r in rows if r[8] is None]


def _by_query(batches, names):
    """Rows of one query at a time; they come sorted by the first column."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column(batch, c) for c in names), strict=True):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def search(
    queries: DataFrame, graph: DataFrame, beam: int = BEAM, expanded: int = EXPANDED, links: int = SEARCH_LINKS
) -> DataFrame:
    """``(qid, v)``: the beam of every query node after a greedy search from its own list.

    ``queries (qid)`` are numbers of nodes of the graph.
    """
    table = _search_links(graph, links)
    count = graph.count()
    shards = max(1, -(-count // SHARD_NODES))
    # Some shards at least, so that small tables also use several tasks.
    shards = max(shards, min(12, -(-count // 1024)))
    table = materialise(table.withColumn("shard", F.pmod("u", F.lit(shards))), "nn-links")
    def begin(batches):
        for batch in batches:
            names = ("u", "q", "scale", "ids", "scores")
            rows = []
            for u, q, scale, ids, scores in zip(*(column(batch, c) for c in names), strict=True):
                n = len(ids) // 8
                rows.append((u, u, q, scale, ids[: 8 * beam], scores[: 4 * beam], bytes(min(n, beam))))
            yield to_batch(rows, _BEAM_SCHEMA)

    own = table.join(queries.select(F.col("qid").alias("u")).distinct(), "u", "left_semi")
    beams = materialise(own.select("u", "q", "scale", "ids", "scores").mapInArrow(begin, _BEAM), "nn-beams")
    finished = None
    while True:
        # A zero byte marks a node that is not expanded yet.
        marked = beams.withColumn("open", F.expr("contains(done, unhex('00'))"))
        ended, going = marked.filter("not open").drop("open"), marked.filter("open").drop("open")
        finished = ended if finished is None else finished.unionByName(ended)
        if going.isEmpty():
            break
        beams = materialise(_hops(going, table, shards, beam, expanded, CHAIN), "nn-beams")

    def explode(batches):
        for batch in batches:
            counts = [len(x) // 8 for x in column(batch, "ids")]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.asarray(batch.column(0)), counts)),
                    pa.array(np.frombuffer(b"".join(column(batch, "ids")), "<i8")),
                ],
                names=["qid", "v"],
            )

    return finished.select("qid", "ids").mapInArrow(explode, "qid long, v long")


def nearest(
    rows: DataFrame, every: int = 20, top: int = TOP, k: int = NEIGHBOURS, rounds: int = ROUNDS, beam: int = BEAM
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: ``top`` nearest found of each query by inner product.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates all others.
    Vectors that are null, zero, or hold null or non-finite components take no part, nor do
    rows without a ``vec_id``. Copies of a vector are candidates of each other. Vectors of
    different dimension don't meet. Ties go to the smaller ``vec_id``. Repeated rows of an id
    count once. An empty table gives an empty result.
    """
    dtype = stored_type(rows)
    packed = materialise(
        packed_vectors(rows).filter("vec_id is not null and vec is not null").distinct(), "vectors"
    )
    nodes = materialise(_nodes(packed, dtype, top), "nn-nodes")
    graph = build_graph(nodes, k, rounds)
    asked = packed.filter(F.col("vec_id") % every == 0).select("vec_id", F.xxhash64("vec").alias("qid"), "vec")
    reached = search(asked, graph, beam).unionByName(asked.select("qid", F.col("qid").alias("v")).distinct())
    named = asked.groupBy("qid").agg(F.first("vec").alias("query"))
    scored_rows = (
        reached.join(named, "qid")
        .join(nodes.select(F.col("u").alias("v"), "vec"), "v")
        .select("qid", "v", "query", "vec")
    )
    schema = pa.schema([("qid", pa.int64()), ("v", pa.int64()), ("score", pa.float64())])

    def exact(batches):
        for batch in batches:
            a, b = column(batch, "query"), column(batch, "vec")
            value = np.full(len(a), np.nan)
            for size in set(map(len, a)):
                here = [i for i in range(len(a)) if len(a[i]) == size and len(b[i]) == size]
                if here:
                    value[here] = np.einsum(
                        "ij,ij->i", matrix([a[i] for i in here], dtype), matrix([b[i] for i in here], dtype)
                    )
            ok = np.flatnonzero(~np.isnan(value))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ok)), batch.column(1).take(pa.array(ok)), pa.array(value[ok])],
                schema=schema,
            )

    scored = scored_rows.mapInArrow(exact, "qid long, v long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        asked.select(F.col("vec_id").alias("query_id"), "qid")
        .join(_best_nodes(scored, top), "qid")
        .join(nodes.select(F.col("u").alias("v"), "ids"), "v")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .filter("query_id <> vec_id")
        .withColumn("rank", rank)
        .filter(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )


def _best_nodes(scored: DataFrame, top: int) -> DataFrame:
    """Nodes whose rows can be among the best: those up to the score of the ``top + 1``-th."""
    place = F.rank().over(Window.partitionBy("qid").orderBy(F.desc("score")))
    return scored.withColumn("place", place).filter(F.col("place") <= top + 1).drop("place")
