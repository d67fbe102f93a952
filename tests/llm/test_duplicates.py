"""SimHash, repeated strings, embeddings: against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup, nn_descent, repeats, simhash

SCHEMA = "doc_id long, text string, fp int, component_id string, spans int, k int, node int"


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, 3, 4) for r in rows], SCHEMA)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_texts():
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        text = rnd.choices(words, k=250)
        for _ in range(6):
            copy = list(text)
            for _ in range(rnd.randint(0, 4)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            rows.append(" ".join(copy))
    rows += ["", None, "   ", "One", "one", "one two", "ONE\ttwo", "Été x", rows[0], rows[0]]
    ids = list(range(len(rows)))
    rnd.shuffle(ids)
    return list(zip(ids, rows, strict=True))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for x in range(len(rows)):
            for y in range(len(rows)):
                if (fps[x] ^ fps[y]).bit_count() <= 3 and label[y] < label[x]:
                    label[x], changed = label[y], True
    return {i: (f"{fp:016x}", c) for (i, _), fp, c in zip(rows, fps, label, strict=True)}


def test_simhash_against_brute_force(spark):
    rows = near_texts()
    got = simhash.near_duplicates(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == plain_components(rows)
    assert len(got) == len(rows)
    want = {c for _, c in plain_components(rows).values()}
    kept = simhash.keep_one_per_component(docs_of(spark, rows + rows[:5])).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(want)


@pytest.mark.parametrize("cell", [3, 4096])
def test_links_in_small_cells_connect_the_same(spark, cell):
    rnd = random.Random(9)
    base = rnd.getrandbits(63)
    fps = sorted({base ^ (1 << rnd.randrange(63)) ^ (1 << rnd.randrange(63)) for _ in range(40)})
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = simhash.links(frame, cell=cell).collect()
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        assert (r["a"] ^ r["b"]).bit_count() <= 3
        parent[root(r["a"])] = root(r["b"])
    for x in fps:
        for y in fps:
            if (x ^ y).bit_count() <= 3:
                assert root(x) == root(y)


def test_pivots_discard_nearly_all_pairs_and_no_link(spark):
    rnd = random.Random(5)
    fps = [rnd.getrandbits(64) for _ in range(300)]
    fps += [f ^ sum(1 << b for b in rnd.sample(range(64), k % 6)) for k, f in enumerate(fps)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    rows = simhash.distance_table(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    table = {r["fp"]: r["distances"] for r in rows}
    references = simhash.pivots()
    assert len(references) >= 32
    for f in fps[:20]:
        assert table[f] == [((f ^ p) & (1 << 64) - 1).bit_count() for p in references]
    order = np.array([table[f] for f in fps], dtype=np.int8)
    everyone, discarded, linked = np.arange(len(fps)), 0, 0
    for x in range(len(fps)):
        left = set(simhash.pivot_survivors(order, x, everyone, 3).tolist())
        near = {y for y in range(len(fps)) if ((fps[x] ^ fps[y]) & (1 << 64) - 1).bit_count() <= 3}
        assert near <= left
        discarded, linked = discarded + len(fps) - len(left), linked + len(near) - 1
    assert linked == 300
    assert discarded > 0.99 * len(fps) * (len(fps) - 1)


def test_links_are_those_of_brute_force_over_random_fingerprints(spark):
    rnd = random.Random(6)
    fps = [rnd.getrandbits(64) for _ in range(400)]
    fps += [f ^ sum(1 << b for b in rnd.sample(range(64), k % 5)) for k, f in enumerate(fps)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()
    got = {frozenset((r["a"], r["b"])) for r in found}
    want = {
        frozenset((x, y))
        for x in fps
        for y in fps
        if x < y and ((x ^ y) & (1 << 64) - 1).bit_count() <= 3
    }
    assert got <= want
    # Originals and their copies are pairs, so the spanning forest is all links.
    assert got == want


def test_simhash_of_nothing_and_of_null_ids(spark):
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0
    assert simhash.keep_one_per_component(docs_of(spark, [])).count() == 0
    got = simhash.near_duplicates(docs_of(spark, [(None, "a b c"), (7, "a b c"), (None, "zz")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in got) == [(-1, -1), (-1, 7), (7, 7)]
    assert simhash.keep_one_per_component(docs_of(spark, [(None, "a"), (None, "a"), (None, "b")])).count() == 2


def plain_removal(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def repeated_texts(rnd):
    words = ["alpha", "béta", "gamma", "delta", "eps"]
    passage = " ".join(rnd.choices(words, k=30))
    rows = [(i, " ".join(rnd.choices(words, k=rnd.randint(0, 25)))) for i in range(20)]
    rows += [(30 + i, f"{rnd.random()} {passage[: rnd.randint(20, 120)]} {rnd.random()}") for i in range(12)]
    rows += [(50, passage), (51, passage), (51, passage), (52, None), (53, ""), (None, passage[5:90])]
    rows += [(54, "ab" * 100), (55, "x" * 30), (56, passage + passage)]
    return rows


@pytest.mark.parametrize(("length", "gram", "pieces"), [(24, 8, 20_000), (16, 5, 20_000), (24, 8, 1)])
def test_repeats_against_brute_force(spark, length, gram, pieces):
    rows = repeated_texts(random.Random(length))
    got = repeats.removal_report(docs_of(spark, rows).repartition(3), length, gram, pieces).collect()
    assert Counter(map(tuple, got)) == plain_removal(rows, length)


def test_long_texts_are_cut_into_scans(monkeypatch):
    rnd = random.Random(8)
    long = bytes(rnd.choices(b"abcdef \n", k=5000)).decode()
    monkeypatch.setattr(repeats, "SCAN", 700)
    data = np.frombuffer(long.encode(), np.uint8)
    keys = np.array([1]), np.array([2])
    found = list(repeats._scan_long(*keys, data.tobytes(), 50, 12))
    starts = sorted(
        s + i for b in found for s, n in zip(b["s"].to_pylist(), b["n"].to_pylist(), strict=True) for i in range(n)
    )
    assert starts == list(range(5000 - 50 + 1))


def test_removed_texts_stay_rows_of_the_table(spark):
    rows = repeated_texts(random.Random(1))
    docs = docs_of(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    got = repeats.remove_repeats(docs, 24, 8)
    assert got.schema == docs.schema or got.columns == docs.columns
    out = got.collect()
    assert len(out) == len(rows)
    assert sum(r["text"] is None for r in out) == 1
    assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in out)
    assert repeats.remove_repeats(docs.filter("1 = 0"), 24, 8).count() == 0


def vectors(rnd, n, size):
    base = rnd.standard_normal((n, size))
    copies = base[: n // 4] + rnd.standard_normal((n // 4, size)) * rnd.uniform(0, 0.6, (n // 4, 1))
    return np.concatenate([base, copies, copies[:5] * 3, base[:4]])


def vector_rows(x):
    rows = [(i, [float(v) for v in r], 1, "n") for i, r in enumerate(x.astype(np.float32))]
    n, size = x.shape
    bad = [None, [0.0] * size, [float("nan")] * size, [None] + [1.0] * (size - 1), [], [float("inf")] * size]
    return rows + [(n + i, v, 1, "n") for i, v in enumerate(bad)] + [(n + 50, [1.0, 2.0], 1, "n")]


VECTORS = "vec_id long, embedding array<float>, label int, node string"


@pytest.mark.parametrize("group", [10, 8192])
def test_embedding_links_against_brute_force(spark, group):
    x = vectors(np.random.default_rng(3), 60, 16)
    rows = vector_rows(x)
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(rows, VECTORS), group=group).collect()}
    x = np.array([r[1] for r in rows[: len(x)]], np.float64)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    link = unit @ unit.T >= 0.9
    np.fill_diagonal(link, False)
    label = np.arange(len(x))
    for _ in range(len(x)):
        label = np.array([min([label[i], *label[link[i]]]) for i in range(len(x))])
    assert len(got) == len(rows)
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (link[i].sum(), label[i], label[i] == i)
    for vec_id, *_ in rows[len(x) :]:
        assert (got[vec_id]["n_links"], got[vec_id]["component_id"], got[vec_id]["kept"]) == (0, vec_id, True)
    empty = spark.createDataFrame([], VECTORS)
    assert embedding_dedup.near_duplicates(empty).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(5)
    a = rng.standard_normal((200, 48)) * rng.uniform(0.01, 100, (200, 48))
    q = embedding_dedup.Quantised(a)
    true = q.unit @ q.unit.T
    product = q.whole.astype(np.float64) @ q.whole.T.astype(np.float64)
    bound = q.scale[:, None] * q.scale * product + q.rest[:, None] * q.close + q.rest
    assert (bound >= true - 1e-12).all()


def test_nearest_finds_nearly_all(spark):
    x = vectors(np.random.default_rng(6), 900, 24)
    rows = vector_rows(x)
    got = nn_descent.nearest(spark.createDataFrame(rows, VECTORS), k=12, rounds=2, beam=80).collect()
    x = np.array([r[1] for r in rows[: len(x)]], np.float64)
    found = Counter()
    for r in got:
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), rel=1e-12)
        found[r["query_id"]] += 1
    queries = range(0, len(x), 20)
    assert all(found[q] == 20 for q in queries)
    hits = 0
    for q in queries:
        score = x @ x[q]
        score[q] = -np.inf
        best = set(np.lexsort((np.arange(len(x)), -score))[:20].tolist())
        hits += len(best & {r["vec_id"] for r in got if r["query_id"] == q})
        ordered = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in ordered] == list(range(1, 21))
        assert all((a["score"], -a["vec_id"]) > (b["score"], -b["vec_id"]) for a, b in zip(ordered, ordered[1:], strict=False))
    assert hits >= 0.9 * 20 * len(queries)


def test_nearest_of_few_vectors_and_many_copies(spark):
    rows = [(i, [1.0, 0.5], 1, "n") for i in range(60)] + [(60, [0.0, 1.0], 1, "n")]
    got = nn_descent.nearest(spark.createDataFrame(rows, VECTORS)).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by_query.setdefault(r["query_id"], []).append(r["vec_id"])
    assert by_query[0] == list(range(1, 21))
    assert by_query[20] == [i for i in range(21) if i != 20]
    assert by_query[60] == list(range(20))
    assert nn_descent.nearest(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1, "n")], VECTORS)
    assert nn_descent.nearest(one).count() == 0


def test_hops_in_one_job_find_what_single_hops_find(spark, monkeypatch):
    rows = vector_rows(vectors(np.random.default_rng(8), 700, 16))
    found, written = {}, {}
    for chain in (1, 3):
        labels = []

        def count(df, label, labels=labels, write=nn_descent.materialise):
            labels.append(label)
            return write(df, label)

        with monkeypatch.context() as patch:
            patch.setattr(nn_descent, "CHAIN", chain)
            patch.setattr(nn_descent, "materialise", count)
            monkeypatch.setattr(nn_descent.search, "__defaults__", (60, 15, 16))
            got = nn_descent.nearest(spark.createDataFrame(rows, VECTORS), k=8, rounds=1, beam=60)
            found[chain] = sorted(map(tuple, got.collect()))
        written[chain] = labels.count("nn-beams") - 1
    assert found[1] == found[3]
    assert written[1] > 3 and written[3] == -(-written[1] // 3)


def test_members_of_a_node_meet_in_as_many_tasks_as_partitions(spark, monkeypatch):
    """Whatever size Spark aims at for partitions; all pairs of a node's members still meet."""
    generator = np.random.default_rng(12)
    rows = [(i, generator.standard_normal(8).tolist(), 1, "n") for i in range(120)]
    monkeypatch.setattr(nn_descent, "BLOCK", 12)
    given = spark.createDataFrame(rows, VECTORS)
    packed = nn_descent.packed_vectors(given)
    nodes = nn_descent.materialise(nn_descent._nodes(packed, nn_descent.stored_type(given), 5), "nodes")
    graph = nn_descent.build_graph(nodes, 6, 0)
    want = {r["u"]: dict(zip(np.frombuffer(r["ids"], "<i8").tolist(), np.frombuffer(r["scores"], "<f4").tolist(), strict=True)) for r in graph.collect()}
    near = {u: set(have) for u, have in want.items()}
    coded = {r["u"]: np.frombuffer(r["q"], np.int8) * np.float32(r["scale"]) for r in nodes.collect()}
    for c in coded:
        members = near[c] | {c} | {u for u in near if c in near[u]}
        for u in members:
            want[u] |= {v: float(coded[u] @ coded[v]) for v in members - {u}}
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    context, before = spark.sparkContext, {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    context.setJobGroup("one-round", "")
    try:
        got = nn_descent._round(graph, 6).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("one-round") for s in tracker.getJobInfo(job).stageIds]
    tasks = [found.numTasks for s in stages if (found := tracker.getStageInfo(s))]
    assert 0 < max(tasks) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    for r in got:
        found = np.frombuffer(r["scores"], "<f4")
        assert np.allclose(found, sorted(want[r["u"]].values(), reverse=True)[:6], rtol=1e-4, atol=1e-4)
