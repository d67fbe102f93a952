"""Merkle manifest, whitening and quality rules: against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, quality_rules, whitening

# ---- Merkle manifest --------------------------------------------------------------

DOCS = (
    "doc_id long, source string, lang string, n_chars long, text string, "
    "tree string, idx long, part long, size long, leaf string, __part int, __file string"
)
CLASHES = ("t", 7, 8, 9, "l", 3, "f")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc, text):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return digest(*map(part, (*doc[:4], text)))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def plain_path(levels, i):
    for level in levels[:-1]:
        start = i // 16 * 16
        yield level[start:i], level[i + 1 : start + 16]
        i //= 16


def plain_proofs(docs):
    groups = {}
    for doc in docs:
        groups.setdefault(doc[1], []).append(doc)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        rows = sorted(
            groups[name],
            key=lambda d: (d[0] is not None, d[0] or 0, plain_leaf(d, d[4])),
        )
        trees[name] = rows, plain_levels([plain_leaf(d, d[4]) for d in rows])
    top = plain_levels([trees[name][1][-1][0] for name in names])
    out = []
    for rank, name in enumerate(names):
        rows, levels = trees[name]
        for i, doc in enumerate(rows):
            path = [*plain_path(levels, i), *plain_path(top, rank)]
            text = doc[4]
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 5 == 0 and text:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            folded = plain_leaf(doc, text)
            for left, right in path:
                folded = digest(*left, folded, *right)
            siblings = [d for left, right in path for d in left + right]
            root = top[-1][0]
            out.append(
                (doc[0], levels[0][i], levels[-1][0], root, digest(*siblings), folded, folded == root)
            )
    return sorted(out, key=repr)


def many_docs(n, rnd):
    docs = []
    for i in range(n):
        source = rnd.choice(["hot", "hot", "hot", "Ä", "a b", "", None, f"s{rnd.randint(0, 40)}"])
        text = rnd.choice([None, "", "Some TEXT", "ÄÖ Ü", "plain", f"Number {i}"])
        docs.append((i * 3, source, rnd.choice(["en", None]), rnd.choice([None, i]), text))
    return [*docs, docs[0], docs[0], (None, "hot", None, None, "No ID"), (6, "hot", "x", 1, "Y")]


def proofs(spark, docs):
    rows = spark.createDataFrame([(*d, *CLASHES) for d in docs], DOCS)
    return sorted((tuple(r) for r in merkle.verify_tampered(rows).collect()), key=repr)


# 16 and 17, 256 and 257: full runs, and a last run of one.
@pytest.mark.parametrize("n", [1, 16, 17, 256, 257])
def test_one_tree_at_the_edges_of_runs(spark, n):
    docs = [(i, "s", "en", 5, f"Text {i}") for i in range(n)]
    assert proofs(spark, docs) == plain_proofs(docs)


def test_many_trees_with_a_hot_one_nulls_and_repeats(spark):
    docs = many_docs(1200, random.Random(1))
    got = proofs(spark, docs)
    assert got == plain_proofs(docs)
    assert {g[-1] for g in got} == {True, False}


def test_trees_higher_than_a_partition(spark):
    docs = [(i, "s" if i else "t", "en", 5, "A" if i % 2 else "a") for i in range(4200)]
    assert proofs(spark, docs) == plain_proofs(docs)


def test_manifest_of_nothing(spark):
    assert merkle.verify_tampered(spark.createDataFrame([], DOCS)).collect() == []


def test_a_long_text_is_hashed_whole(spark):
    docs = [(0, "s", "en", 1, "Xy " * 400_000), (5, "s", "en", 1, "Xy " * 400_000 + "!")]
    assert proofs(spark, docs) == plain_proofs(docs)


@pytest.mark.parametrize("size", [1, 15, 16, 17, 300, 5000])
def test_missing_nodes_are_needed_and_enough(size):
    rnd = random.Random(size)
    for _ in range(20):
        known = set(rnd.sample(range(size), rnd.randint(1, min(size, 9))))
        missing = merkle.missing_nodes(known, 0, size)
        assert len(missing) == len(set(missing))
        held = {(0, k) for k in known} | set(missing)
        level, width = 0, size
        while width > 1:
            for p in {i // 16 for lv, i in held if lv == level}:
                run = range(p * 16, min(p * 16 + 16, width))
                # Whole runs can be hashed; what can be derived was not asked for.
                assert all((level, i) in held for i in run)
                assert (level + 1, p) not in held
                held.add((level + 1, p))
            level, width = level + 1, -(-width // 16)
        assert (level, 0) in held


# ---- whitening --------------------------------------------------------------------


def plain_whitening(vectors, k=8):
    x = np.floor(np.array(vectors, dtype=np.float64) * 1024).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    deviation = [
        sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, total, strict=True)) for row in x
    ]
    centred = x - total / n
    v = centred.T @ centred / n
    values, u = np.linalg.eigh(v)
    values, u = values[::-1], u[:, ::-1]
    return deviation, centred @ u[:, :k] / np.sqrt(values[:k]), values[:k] / np.trace(v)


EMB = "vec_id long, embedding array<float>, v int, w int, deviation int, n int"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows], EMB)


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(3)
    data = (rng.normal(size=(400, 12)) * np.linspace(1, 4, 12)).astype(np.float32)
    data[7] = 0
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    bad = [
        (900, None),
        (901, [None] + [0.0] * 11),
        (902, [math.nan] * 12),
        (903, [math.inf] + [0.0] * 11),
    ]
    got = whitening.whiten(vector_table(spark, rows + bad)).collect()
    deviation, whitened, explained = plain_whitening(data)
    assert len(got) == 400 * 8
    by_row = {(r["vec_id"], r["component"]): r for r in got}
    for k in range(1, 9):
        mine = np.array([by_row[i, k]["whitened"] for i in range(400)])
        sign = np.sign(mine @ whitened[:, k - 1])
        assert np.abs(sign * mine - whitened[:, k - 1]).max() < 1e-9
        assert abs(by_row[0, k]["explained"] - explained[k - 1]) < 1e-12
    assert [by_row[i, 1]["deviation"] for i in range(400)] == deviation
    assert {r["n"] for r in got} == {400}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_whitening_of_nothing_of_one_and_of_flat_directions(spark):
    assert whitening.whiten(vector_table(spark, [])).collect() == []
    assert whitening.whiten(vector_table(spark, [(1, None)])).collect() == []
    one = whitening.whiten(vector_table(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["identity_error"]) for r in one] == [
        (1, 0, None, None),
        (2, 0, None, None),
    ]
    line = [(i, [float(i), float(i), 1.0]) for i in range(9)] + [(0, [0.0, 0.0, 1.0])]
    got = whitening.whiten(vector_table(spark, line)).collect()
    assert len(got) == 30
    assert all((r["whitened"] is not None) == (r["component"] == 1) for r in got)
    assert got[0]["identity_error"] < 1e-10


def test_vectors_of_two_lengths_are_refused(spark):
    rows = [(i, [1.0, 2.0] if i % 2 else [1.0]) for i in range(50)]
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(vector_table(spark, rows)).collect()


@pytest.mark.parametrize(
    "values",
    [
        [5, 4, 3, 2, 1, 0.5],
        [5, 5, 5, 3, 1, 1e-9],
        [1 + 1e-9, 1, 1 - 1e-10, 0.5, 0.5 + 1e-14, 0.1],
        [1] * 6,
        [1e6, 1, 1e-6, 1e-6, 0, 0],
        [0] * 6,
    ],
)
def test_refined_eigenvectors_also_in_clusters(values):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(6, 6)))[0]
    a = (q * np.array(values, dtype=float)) @ q.T
    a = (a + a.T) / 2
    found, x = whitening.refine(a.astype(np.longdouble))
    top = max(max(values), 1e-300)
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-14
    assert np.abs(a @ x - x * found).max() < 1e-14 * top
    assert np.all(np.diff(found) <= 1e-12 * top)
    assert np.abs(found - sorted(values, reverse=True)).max() < 1e-14 * top


def test_refinement_beats_its_start():
    """Digits that 32-bit vectors cannot have."""
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(40, 40)))[0]
    a = (q * np.arange(1, 41)) @ q.T
    a = (a + a.T) / 2
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    _, x = whitening.refine(a.astype(np.longdouble))
    off = lambda v: np.abs(v.T @ a @ v - np.diag(np.diag(v.T @ a @ v))).max()
    assert off(x) < 1e-12 < 1e-8 < off(start)


def test_large_numbers_stay_exact():
    x = np.array([[2**49, -(2**49)], [2**49 + 1, 5]], dtype=np.int64)
    with pytest.raises(OverflowError):
        whitening.deviations(x, 2, [2**50 + 1, 5 - 2**49])
    d, squares = whitening.deviations(np.array([[3, 4], [5, 9]]), 2, [8, 13])
    assert squares == [4 + 25, 4 + 25] and d.tolist() == [[-2, -5], [2, 5]]
    v = whitening.covariance(2, [8, 13], np.array([4, 6]), {(0, 0): 2, (0, 1): 5, (1, 1): 13})
    assert Fraction(float(v[0, 0])) == 1 and Fraction(float(v[1, 1])) == Fraction(25, 4)


# ---- quality rules ----------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_lines": len(lines),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one two three four five six",
    "a b c d e a b c d e",
    "a b c d e f a b c d e f",
    "x " * 40,
    "x x x x x x",
    "# $ % & | < > * #x",
    "Zeile eins ist da\nZeile eins ist da\n\nZeile eins ist da \n",
    "äöü 😀😀  nbsp em word\x1cword",
    "\n".join(f"- point number {i} of the list" for i in range(12)),
    "\n".join(f"the line number {i} is cut off here..." for i in range(12)),
    " ".join(f"the w{i}" for i in range(3000)) + " the end of the very long text" * 2,
    "\x00 nul   separators \u0085 stay inside words",
]


def test_measures_against_plain_python(spark):
    rnd = random.Random(2)
    texts = TEXTS + [
        "".join(rnd.choices(["a", "b", " ", "\n", "#", "é", "\t"], k=rnd.randint(1, 300)))
        for _ in range(150)
    ]
    rows = [(i // 2, t, "n", 1) for i, t in enumerate(texts)] + [(None, "a b", "n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __words string, __row int")
    got = quality_rules.judge(docs, extra=["__words"]).collect()
    assert len(got) == len(rows)
    for (i, text, *_), r in zip(rows, got, strict=True):
        want = plain_measures(text)
        assert (r["doc_id"], r["__words"]) == (i, "n")
        assert {m: r[m] for m in want} == want, text


def test_each_rule_and_its_least_size(spark):
    plain = "the wind and the rain came to the town in the night and it was cold for all of us "
    cases = {
        (): plain * 1,
        ("symbols",): plain + "wind### town$$",
        ("stop_words",): " ".join(f"wort{i}" for i in range(30)),
        ("word_length",): " ".join(f"the {'x' * 40}{i}" for i in range(12)),
        ("bullet_lines",): "\n".join(f"- the village of number {i}" for i in range(12)),
        ("cut_lines",): "\n".join(f"the town of number {i}…" for i in range(12)),
        ("repeated_lines",): "\n".join(f"the village of {i % 5 if i < 12 else i}" for i in range(16)),
    }
    docs = spark.createDataFrame(list(enumerate(cases.values())), "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality_rules.judge(docs).collect()}
    for i, names in enumerate(cases):
        assert tuple(got[i]["failed_rules"]) == names
        assert got[i]["kept"] == (not names and not got[i]["base_failed"])
    few = spark.createDataFrame([(1, " ".join(f"wort{i}" for i in range(12)))], "doc_id long, text string")
    assert quality_rules.judge(few).first()["kept"]


def test_own_tables_of_rules(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c d")], "doc_id long, text string")
    rules = [quality_rules.Rule("long", "n_words", "n_lines", high=3)]
    got = quality_rules.judge(docs, rules).orderBy("doc_id").collect()
    assert [r["failed_rules"] for r in got] == [[], ["long"]]
    assert [r["failed_rules"] for r in quality_rules.judge(docs, []).collect()] == [[], []]
    with pytest.raises(ValueError, match="named like a measure"):
        quality_rules.measure(docs.withColumn("n_words", F.lit(1)), extra=["n_words"])
    assert quality_rules.judge(docs.limit(0)).collect() == []


def test_rules_are_one_narrow_plan_without_python(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality_rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
