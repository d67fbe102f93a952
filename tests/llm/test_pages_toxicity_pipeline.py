"""HTML text, WARC, toxicity, the pipeline, and the queries that SQL can express."""

import hashlib
import html
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import html_text, queries, repeats, simhash, toxicity, warc
from tidemark.llm.common import materialise

SF = "/root/testdata/sf0.001"


def test_extraction_of_the_test_pages(spark):
    """The article's blocks as a plain split at its block tags gives them."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in html_text.extract_text(pages).collect()}
    for r in pages.collect():
        article = re.split(r"</article>|<footer>", r["html"].split("<article>")[1])[0]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", article))
        texts = (" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks)
        want = "\n".join(t for t in texts if t)
        assert got[r["page_id"]]["text"] == want
        assert got[r["page_id"]]["n_chars"] == len(want)


SENTENCE = "Some words of a sentence, which goes on for a while, and then it ends."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        (f"<p>{SENTENCE}</p>", SENTENCE),
        (f"<article><h2>Title</h2><p>{SENTENCE}<p>Short.</article><footer>(c) x</footer>", f"Title\n{SENTENCE}\nShort."),
        (f"<main><div class='comments'><p>{SENTENCE}</p></div><p>{SENTENCE} A &amp;\n b.</p></main>", f"{SENTENCE} A & b."),
        (f"<body><nav><a>Home</a></nav><div id=content><p>{SENTENCE}</p><p>{SENTENCE}</p></div><div class='cookie-notice'>We use cookies, you know.</div>", f"{SENTENCE}\n{SENTENCE}"),
        (f"<article><script>if (a < b) '</p>'</script><style>p{{}}</style><p>{SENTENCE}<!-- <p>no</p> --></p>", SENTENCE),
        (f"<article><ul><li>One<li>Two</ul><p>{SENTENCE}<br>Next &lt;b&gt;</p></article>", f"One\nTwo\n{SENTENCE} Next <b>"),
        ("<article><p>broken <b>bold<p>next</article>", "broken bold\nnext"),
        (f"<article><p>{SENTENCE}</p><form><p>Name</p></form><aside>Side</aside></article>", SENTENCE),
    ],
)
def test_extraction_cases(page, want):
    assert html_text.main_text(page or "") == want


ARTICLE = "<p>A long text, of the article, that goes on, and on.</p><p>More of it, in a row.</p>"
BOTH = "A long text, of the article, that goes on, and on.\nMore of it, in a row."


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # A part of a class or id word says nothing, a whole one does, unless it holds the article.
        (f'<div class="content has-sidebar">{ARTICLE}</div>', BOTH),
        (f'<div class="page no-ads">{ARTICLE}</div>', BOTH),
        (f'<div id="social-science">{ARTICLE}</div>', BOTH),
        (f'<div class="ad">{ARTICLE}</div>', BOTH),
        (f"<form>{ARTICLE}<p>Send</p></form>", BOTH + "\nSend"),
        (f'<div>{ARTICLE}<div class="box ad">Buy now, here.</div></div>', BOTH),
        # Quotes open a value after "=" only; an open one goes to the end.
        ("<p title='it's'>One text.</p><p>Two, a text.</p><p class='x'>Three.</p>", "One text.\nTwo, a text.\nThree."),
        ('<p>One text.</p><p title="x>A text.</p><p>More</p>', "One text."),
        ("<p title=a>b>One text.</p>", "b>One text."),
        # Elements beside the article, without any name.
        (f"<article>{ARTICLE}</article><div><h3>Comments</h3><p>Me too.</p></div>", BOTH),
        (f"<div>{ARTICLE}</div><div><h3>Comments</h3><p>Me too.</p></div>", BOTH),
        (f"<ul><li>Home</li><li>News</li></ul><div>{ARTICLE}</div>", BOTH),
        (f"<article><ul><li><a href=a>Home</a></li><li><a>News</a></li></ul>{ARTICLE}</article>", BOTH),
        # A linked heading stays with its text, an unlinked list stays in its article.
        (f"<article><h1><a href=a>Head</a></h1>{ARTICLE}<ul><li>one</li></ul></article>", f"Head\n{BOTH}\none"),
        # Comments of odd form.
        ("<!--><p>One text.</p><!-- x --!><p>Two.</p></ ><p>Three.</p>", "One text.\nTwo.\nThree."),
    ],
)
def test_ratios_decide_and_names_do_not(page, want):
    assert html_text.main_text(page) == want


def test_names_of_classes_do_not_matter(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        want = html_text.main_text(r["html"])
        bare = re.sub(r' class="[^"]*"', "", r["html"])
        assert html_text.main_text(bare) == want
        assert html_text.main_text(bare.replace("<article>", '<article class="ad">')) == want


def test_deep_and_long_pages():
    """Time grows with the page, not with its square: 40 times the page, far below 1,600 times the time."""

    def seconds(n):
        page = "<div>a text, of some kind." * n + "</b></section>" * n
        start = time.perf_counter()
        assert html_text.main_text(page).count("text") == n
        return time.perf_counter() - start

    assert seconds(40_000) < 250 * max(seconds(1_000), 0.01)
    flat = "<article>" + "<p>A text, of some kind.</p>" * 100_000 + "</article>"
    assert html_text.main_text(flat).count("\n") == 99_999


def test_empty_tables_null_pages_repeats_and_other_columns(spark):
    rows = [(1, "u", None, "x"), (2, None, f"<article>{ARTICLE}</article>", "y")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "u", "", 0)] * 2 + [(2, None, BOTH, len(BOTH))] * 2
    assert html_text.extract_text(pages.filter("1 = 0")).count() == 0


PAGES = "page_id long, url string, html string, address string, size int, packed int"


def test_archive_round_trip(spark):
    large, small = "<p>é" * 400, "<p>small"
    rows = [(1, "http://a", large), (2, "http://b\r\nX: y", large), (9, None, large), (3, "u", small),
            (4, "u", small), (5, "u", None), (6, "u", ""), (7, "u", large + "x"), (7, "u", large + "x"),
            (None, "u", large)]
    pages = spark.createDataFrame([(*r, "a", 1, 2) for r in rows], PAGES)
    got = warc.archive_round_trip(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        payload = {1: large, 2: large, 9: large, None: large, 3: small, 4: small, 5: "", 6: "", 7: large + "x"}[r["page_id"]]
        assert r["payload_bytes"] == len(payload.encode())
        assert r["payload_digest"] == hashlib.sha1(payload.encode()).hexdigest()
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"]) for r in got)
    assert kinds == [
        (-1, "revisit", 9), (1, "revisit", 9), (2, "revisit", 9), (3, "response", None),
        (4, "response", None), (5, "response", None), (6, "response", None),
        (7, "response", None), (7, "revisit", 7), (9, "response", None),
    ]
    assert warc.archive_round_trip(pages.filter("1 = 0")).count() == 0


def test_payloads_are_stored_once_and_checked(spark, tmp_path):
    rows = [(i, "u", "x" * 5000) for i in range(20)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"))
    payloads = spark.read.parquet(str(tmp_path / "a/payloads"))
    assert payloads.count() == 1
    broken = payloads.withColumn("address", F.lit("0" * 64))
    broken.write.parquet(str(tmp_path / "b/payloads"))
    spark.read.parquet(str(tmp_path / "a/records")).withColumn("address", F.lit("0" * 64)).write.parquet(
        str(tmp_path / "b/records")
    )
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, str(tmp_path / "b")).collect()


def test_toxicity_learns_words_and_never_sees_held_out_labels(spark):
    rnd = random.Random(1)
    words = [f"{a}{b}{c}" for a in "abcd" for b in "eiou" for c in "lmnr"]
    rows, labels = [], []
    for i in range(900):
        text = rnd.choices(words, k=40)
        toxic = int(rnd.random() < 0.3)
        for _ in range(4 * toxic):
            text[rnd.randrange(40)] = rnd.choice(["vilefool", "scumbag"])
        rows.append((i, " ".join(text), "x", 1))
        labels.append((i, 0, toxic))
    rows += [(9000, None, "x", 1), (9001, "", "x", 1), (None, "some text", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, predicted string, score int")
    table = spark.createDataFrame([*labels, (5, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(toxicity.training_rows(docs, table))
    scored = {r["doc_id"]: r for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    assert len(scored) == len(rows)
    held = {r["doc_id"] for r in docs.filter(toxicity.held_out("doc_id")).collect()}
    assert all((i in held) == (duckdb_crc(i) % 3 == 1) for i in range(900))
    right = [scored[i]["predicted"] == t for i, _, t in labels if i in held]
    assert sum(right) >= 0.95 * len(right)
    assert all(0 <= r["score"] <= 1 for r in scored.values())
    flipped = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    again = toxicity.train(toxicity.training_rows(docs, spark.createDataFrame(flipped, table.schema)))
    assert (again.weights == model.weights).all()
    assert again.bias == model.bias


def test_a_short_toxic_passage_in_a_long_text_is_found(spark):
    rnd = random.Random(4)
    words = [f"{a}{b}{c}" for a in "abcdfg" for b in "eiou" for c in "lmnr"]
    rows, labels = [], []
    for i in range(1200):
        toxic = int(i % 8 == 0)
        text = rnd.choices(words, k=rnd.choice([30, 300, 3000]))
        for _ in range(3 * toxic):
            text[rnd.randrange(len(text))] = rnd.choice(["vilefool", "scumbag", "wretch"])
        rows.append((i, " ".join(text)))
        labels.append((i, 0, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(toxicity.training_rows(docs, table))
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    held = [(i, t) for i, _, t in labels if duckdb_crc(i) % 3 == 1]
    caught = [scored[i] for i, t in held if t]
    assert sum(caught) >= 0.95 * len(caught)
    assert sum(scored[i] for i, t in held if not t) <= 0.01 * len(held)


def test_calibration_gives_the_share_of_toxic_rows():
    """One feature that nine of ten rows with it are toxic for: the score says so, balanced."""
    owner, place = np.repeat(np.arange(400), 1), np.arange(400) % 2
    labels = (np.arange(400) % 2 * (np.arange(400) % 20 != 1)).astype(int)
    slope, offset = toxicity._calibration(owner, place, np.ones(400), labels, 2)
    w, bias = toxicity._fit(owner, place, np.ones(400), labels, 2)
    p = 1 / (1 + np.exp(-(slope * (w[1] + bias) + offset)))
    # Balanced: nine tenths of the rows with feature 1 are toxic, and no row without it.
    weight = toxicity._class_weights(labels)
    true = weight[(place == 1) & (labels == 1)].sum() / weight[place == 1].sum()
    assert abs(p - true) < 0.03


def test_stages_with_clashing_columns_nulls_and_nothing(spark):
    rows = [
        (1, None, 1, "a", 0.5, 0), (2, "", 2, "b", 0.5, 1), (3, "one two three", 3, "c", 0.1, 0),
        (3, "one two three", 4, "d", 0.1, 0), (3, "one two three", 4, "d", 0.1, 0),
        (None, "no id here at all", 5, "e", 0.9, 1), (4, "word " * 30_000, 6, "f", 0.9, 1),
    ]
    schema = "doc_id long, text string, __id long, __hash string, score double, toxic int"
    extra = ["__copy", "__score", "__toxic", "row", "copy", "hash", "kept_id"]
    docs = spark.createDataFrame(rows, schema).withColumns({c: F.lit(7) for c in extra})
    results = []
    for order in (docs, docs.orderBy(F.desc("__id"))):
        out = order
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = materialise(stage(spark, out, SF), "stage")
            assert out.columns == docs.columns
        results.append(sorted(map(tuple, out.collect()), key=repr))
    assert results[0] == results[1]
    ids = [r[0] for r in results[0]]
    assert ids.count(3) == 1 and 4 in ids
    assert all(r[6:] == (7,) * len(extra) for r in results[0])
    nothing = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        nothing = materialise(stage(spark, nothing, SF), "stage")
        assert nothing.collect() == []


def duckdb_crc(i):
    import zlib

    return zlib.crc32(str(i).encode())


def test_batched_and_single_scores_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    texts = [r["text"] for r in docs.select("text").collect()][:60] + ["", "a", None]
    assert model.scores(texts) == pytest.approx([model.scores([t])[0] for t in texts])
    empty = toxicity.train(toxicity.training_rows(docs, labels.filter("1 = 0")))
    assert set(empty.scores(texts)) == {0.5}


@pytest.fixture(scope="module")
def staged(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), "stage"))
    return out


def test_stages_against_plain_versions(spark, staged):
    from test_duplicates import plain_components, plain_removal

    docs, clean, single, cut, packed = staged
    assert clean.columns == single.columns == cut.columns == docs.columns
    kept = {r["doc_id"]: r["text"] for r in clean.collect()}
    verdicts = queries.op3_toxicity(spark, SF).filter("predicted = 1").count()
    assert len(kept) == docs.count() - verdicts
    parts = plain_components(sorted(kept.items()))
    one = {r["doc_id"]: r["text"] for r in single.collect()}
    assert sorted(one) == sorted({c for _, c in parts.values()})
    report = plain_removal(sorted(one.items()), corpus_pipeline.PASSAGE_BYTES)
    removed = {r[0]: r[2] for r in report}
    for r in cut.collect():
        full = one[r["doc_id"]].encode()
        assert len(full) - removed[r["doc_id"]] - 3 * 8 <= len(r["text"].encode()) <= len(full) - removed[r["doc_id"]]
    assert packed.select("doc_id").distinct().count() == len(one)
    assert simhash.MAX_BITS == 3


def test_run_gives_the_rows_of_the_stages(spark, staged):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = sorted(map(tuple, staged[-1].select(*columns).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*columns).collect())) == want


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    rows = sorted(map(repr, want.fetchall()))
    assert sorted(map(repr, map(tuple, queries.QUERIES[name](spark, SF).select(*columns).collect()))) == rows


def test_training_makes_values_of_its_sample_some_at_a_time(spark, monkeypatch):
    generator = np.random.default_rng(4)
    words = ["".join(generator.choice(list("abcdefghij"), 3)) for _ in range(60)]
    rows = [(i, " ".join(generator.choice(words, 40)) + " bad" * (i % 2), i % 2) for i in range(60)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    models, made, strength = [], [], toxicity.strength

    def counted(n):
        made.append(len(n))
        return strength(n)

    monkeypatch.setattr(toxicity, "strength", counted)
    for entries in (1 << 20, 1 << 10):
        made.clear()
        monkeypatch.setattr(toxicity, "ENTRIES", entries, raising=False)
        models.append(toxicity.train(labelled, max_features=512))
    assert sum(made) > 1 << 11 and max(made) <= 1 << 10
    assert (models[0].weights == models[1].weights).all() and models[0].bias == models[1].bias
