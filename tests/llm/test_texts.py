"""Token files, packing, byte-level BPE: against the libraries and plain versions."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, packing, simple8b, token_files
from tidemark.llm.tokenizing import library_encoder

BYTE_LEVEL, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
TRICKY = [
    "", None, " ", "  a", "a  b", "a\n b", "a \nb", "\n\n a", "x\t\ty ", " a ", "a\xa0b", "a\x1cb c",
    "　a  　b", "don't it's", "<|endoftext|> hi", "é ́x", "İ I", "a\x85b",
    "a" * 3000, "ab" * 500 + "é" * 70, "x\x1d\x1e y", "=-" * 200, "one.\nTwo, three;\n\nfour",
    "a b", "a\n\tb", "\nx", "x\n", "\U0001f600\U0001f601 ok", "a,,, b%%%",
]
SCHEMA = "doc_id long, text string, ids int, start string, offset int, __text string"


def rows_of(texts):
    return [(i, t, 1, "s", 2, "x") for i, t in enumerate(texts)]


@pytest.mark.parametrize(("path", "spaced"), [(BYTE_LEVEL, True), (WORDS, False)])
def test_units_give_the_ids_of_whole_texts(path, spaced):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    encoder = library_encoder(path, spaced)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in TRICKY]
    for texts, ids in ((TRICKY, want), (TRICKY[::-1], want[::-1])):
        got = encoder.encode(pa.array(texts, pa.string()))
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == ids


def fuzzed(rnd, n):
    """Words of letters of many scripts, letters that come apart, marks, and odd spaces."""
    ranges = [(0x41, 0x7A), (0xC0, 0x24F), (0x300, 0x36F), (0x370, 0x3FF), (0x400, 0x4FF), (0x590, 0x6FF),
              (0x900, 0x97F), (0xE00, 0xE7F), (0x1100, 0x11FF), (0x1E00, 0x1FFF), (0x2000, 0x22FF),
              (0x3040, 0x30FF), (0x4E00, 0x4E80), (0xAC00, 0xAC80), (0xFB00, 0xFB4F), (0x1F600, 0x1F640)]
    odd = "İıſßΣςΩKÅ\u0958\u0959\ufb1d\ufb2a\u1e9e\u0345\u0130\u0307ǅǈ½²"
    for _ in range(n):
        words = []
        for _ in range(rnd.randint(1, 8)):
            pick = lambda: rnd.choice(odd) if rnd.random() < 0.3 else chr(rnd.randint(*rnd.choice(ranges)))
            words.append("".join(pick() for _ in range(rnd.randint(0, 6))) + rnd.choice(["", ".", ",", "!?", "%%", "...", "'s", ";:"]))
        yield rnd.choice([" ", "  ", "\n", "\t", " \n"]).join(words)


@pytest.mark.parametrize(("path", "spaced"), [(BYTE_LEVEL, True), (WORDS, False)])
def test_units_give_the_ids_of_random_texts(path, spaced):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    texts = ["GELDİ.", "İ,", "\u0958.", "\ufb1d!", "x\u0301.", *fuzzed(random.Random(8), 10_000)]
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = library_encoder(path, spaced).encode(pa.array(texts, pa.string()))
    for text, ids, mine in zip(texts, want, got, strict=True):
        assert np.frombuffer(mine, "<u4").tolist() == ids, repr(text)


@pytest.mark.parametrize(("path", "spaced"), [(BYTE_LEVEL, True), (WORDS, False)])
def test_words_are_not_cut_one_by_one(path, spaced, monkeypatch):
    """Words, with marks or first in a line, are prepared together; only odd parts one by one."""
    from tokenizers import Tokenizer

    from tidemark.llm.units import UnitEncoder

    asked = []
    one_by_one = UnitEncoder._units_of
    monkeypatch.setattr(UnitEncoder, "_units_of", lambda self, part: asked.append(part) or one_by_one(self, part))
    texts = ["Qwzuüxa qwzöba, 12qwz7.\nQwzéd qwz½. &&& qwz", "qwzuüxa, qwzöba.", "q\twz\x0bq q\u2003wz"]
    library = Tokenizer.from_file(path)
    encoder = UnitEncoder(library_encoder(path, spaced).encode_units, spaced)
    got = encoder.encode(pa.array(texts[:2]))
    assert asked == []
    got += encoder.encode(pa.array(texts[2:]))
    assert len(asked) <= 2
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == want


@pytest.mark.parametrize(("path", "spaced"), [(BYTE_LEVEL, True), (WORDS, False)])
def test_ids_of_many_units_are_cut_in_one_pass(path, spaced, monkeypatch):
    from tidemark.llm import tokenizing

    encoder = library_encoder(path, spaced)
    random_ = random.Random(11)
    units = ["".join(random_.choices("abcdeé1", k=random_.randint(1, 9))) for _ in range(500)]
    want = [encoder.encode_units([u])[0] for u in units]
    passes = []

    class Counting:
        def __getattr__(self, name):
            if name == "flatnonzero":
                passes.append(name)
            return getattr(np, name)

    monkeypatch.setattr(tokenizing, "np", Counting())
    assert encoder.encode_units(units) == want
    assert len(passes) == 1
    mixed = [*units[:40], "", "  x", *units[40:80], "a\nb"]
    assert encoder.encode_units(mixed) == [encoder.encode_units([u])[0] for u in mixed]
    assert encoder.encode_units([]) == []


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 59, 4095, 4096, 4097, 20_000):
        for values in (
            rng.integers(0, 50_000, n),
            rng.integers(0, 2, n) * rng.integers(0, 300, n),
            rng.integers(0, 1 << 63, n) >> rng.integers(0, 63, n),
            np.full(n, (1 << 64) - 1, np.uint64),
        ):
            words, table = simple8b.encode(np.asarray(values, np.uint64))
            assert (simple8b.decode(words, table) == np.asarray(values, np.uint64)).all()
            half = len(table) // 2
            first = int((table[:half, 0] + table[:half, 1]).sum())
            tail = simple8b.decode(words[first:], table[half:])
            assert (tail == np.asarray(values, np.uint64)[half * simple8b.BLOCK :]).all()


def test_token_files_hold_all_ids_in_order(spark):
    from tokenizers import Tokenizer

    rnd = random.Random(2)
    texts = TRICKY + [" ".join(rnd.choices("alpha beta gamma, delta.".split(), k=n)) for n in (5, 900)]
    data = rows_of(texts) + [(None, "no id", 1, "s", 2, "x"), (3, "same id", 1, "s", 2, "x")]
    docs = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = token_files.token_files(docs, BYTE_LEVEL, 2).collect()
    library = Tokenizer.from_file(BYTE_LEVEL)
    library.encode_special_tokens = True
    coded = sorted(
        (-1 if d is None else d, library.encode(t or "", add_special_tokens=False).ids + [2])
        for d, t, *_ in data
    )
    got = sorted(got, key=lambda r: r["start"])
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    assert [(-1 if r["doc_id"] is None else r["doc_id"]) for r in got] == [d for d, _ in coded]
    crc = Counter((d, zlib.crc32(np.array(ids, "<u4").tobytes())) for d, ids in coded)
    assert crc == Counter((-1 if r["doc_id"] is None else r["doc_id"], r["ids_crc32"]) for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert token_files.token_files(docs, BYTE_LEVEL, 2).count() == 0
    assert packing.pack(docs, WORDS, 0).count() == 0
    assert byte_bpe.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).count() == 0


def test_plan_places_every_piece_once():
    rnd = random.Random(5)
    for _ in range(100):
        counts = {rnd.randint(1, 100): rnd.randint(1, 50) for _ in range(rnd.randint(1, 40))}
        fill, ranks = {}, Counter()
        for length, first, n, sequence, offset in packing.plan_best_fit(counts, 100):
            assert ranks[length] == first
            ranks[length] += n
            for i in range(n):
                fill.setdefault(sequence + i, []).append((offset, length))
        assert ranks == Counter(counts)
        for placed in fill.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= 100
        # What best fit decreasing does, piece by piece.
        rooms = []
        for length in sorted(Counter(counts).elements(), reverse=True):
            fits = [r for r in rooms if r >= length]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - length)
            else:
                rooms.append(100 - length)
        assert len(fill) == len(rooms)


def test_pack_is_gapless_and_whole(spark):
    rnd = random.Random(3)
    texts = TRICKY + [" ".join(rnd.choices("red green blue".split(), k=n)) for n in (7, 7, 7, 64, 65, 300)]
    data = rows_of(texts) + [(None, "x", 1, "s", 2, "x"), rows_of(texts)[5]]
    pieces = packing.pack(spark.createDataFrame(data, SCHEMA), WORDS, 0, capacity=64).collect()
    by_sequence, by_doc = {}, Counter()
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        by_doc[p["doc_id"]] += p["length"]
        assert p["start"] == 64 * p["piece"]
    for placed in by_sequence.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    encoder = library_encoder(WORDS, False)
    want = Counter()
    for doc_id, text, *_ in data:
        want[doc_id] += len(encoder.encode(pa.array([text], pa.string()))[0]) // 4 + 1
    assert by_doc == want


def test_byte_bpe_is_that_of_the_rank_library(spark):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = spark.createDataFrame(rows_of(TRICKY), SCHEMA)
    got = {r["doc_id"]: r for r in byte_bpe.encode_decode(docs, path, P.PATTERN).collect()}
    for i, text in enumerate(TRICKY):
        ids = library.encode_ordinary(text or "")
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_lockstep_and_single_trees_agree():
    bpe = byte_bpe.ByteBpe.from_file(P.path("byte_bpe_50k.tiktoken"))
    rnd = random.Random(7)
    matches = [bytes(rnd.choices(b"aeinrsthgl ", k=rnd.randint(2, 64))) for _ in range(400)]
    for match, ids in zip(matches, bpe.encode_matches(matches), strict=True):
        if match not in bpe.ranks:
            assert ids.tolist() == bpe._merge_long(match).tolist()


def test_packing_counts_cover_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    packed = packing.pack(docs, WORDS, 0)
    assert packed.select("doc_id").distinct().count() == docs.count()
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
