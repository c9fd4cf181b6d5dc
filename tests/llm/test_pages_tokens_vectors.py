"""HTML text, WARC archives, token totals, mixing and vector search."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from outreach.llm import html_text, mixing, queries, token_rollup, vector_search, warc
from outreach.llm.queries import ORACLES, QUERIES
from outreach.sources.staging import stage_path

PAGES = "page_id long, url string, html string"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# HTML --------------------------------------------------------------------------------

LONG = "The cat and the dog are in the house and they have what they want, which is to be with you for the day. " * 3


@pytest.mark.parametrize("html, want", [
    (None, ""),
    ("", ""),
    ("no markup but a < b &amp; c", ""),
    (f"<article><h1>Short</h1><p>{LONG}<p>Fin&eacute;.</article>", f"Short\n\n{LONG.strip()}\n\nFiné."),
    ("<body><nav><a href='/x'>Home</a></nav><article><p>a  b\n c<br>d &lt;e&gt; &#233;&amp</p></article><footer>F</footer>", "a b c d <e> é&"),
    (f"<div class='ad'>{LONG}</div><main><p>Keep.</p><aside>{LONG}</aside><form><p>Mail</p></form><div id='comments'><p>{LONG}</p></div></main>", "Keep."),
    (f"<p>{LONG}</p><p><a href='#'>{LONG}</a></p><div class='cookie-notice'><p>{LONG}</p></div>", LONG.strip()),
    ("<article><p>cut off in a ta", "cut off in a ta"),
    ("<article><p>one</p><script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>two</p></article", "one\n\ntwo"),
    ("<article><div class='share'><div>x</div></div><p title='a > b'>text</p></article>", "text"),
])
def test_main_text(html, want):
    assert html_text.main_text(html) == want


@pytest.mark.parametrize("html, want", [
    ("<div class='layout with-sidebar'><article><p>Keep.</p></article><div class='sidebar'>x</div></div>", "Keep."),
    (f"<div class='no-sidebar'><p>{LONG}</p><div class='share'>Share</div></div><footer>F</footer>", LONG.strip()),
    (f"<div id='page-header-wrap'><div class='has-menu'><main><p>{LONG}</p><div class='ad'><p>Buy</p></div></main></div></div>", LONG.strip()),
    (f"<form action='/'><nav>N</nav><p>{LONG}</p><input></form>", LONG.strip()),
    ("<form><article><p>Keep.</p></article></form>", "Keep."),
    (f"<main><div class='widget-page'><p>{LONG}</p></div></main>", LONG.strip()),
    (f"<article><p>Keep.</p></article><div class='related'><article><p>Other.</p></article></div>", "Keep."),
    (f"<p>{LONG}</p><div id='comments'><article><p>{LONG}{LONG}</p></article></div>", LONG.strip()),
    ("<aside><article><p>Other.</p></article><p>x</p></aside><div class='ad'><article><p>Keep.</p></article></div>", "Keep."),
    ("<div class='ad'>" * 3000 + f"<p>{LONG}</p>", LONG.strip()),
])
def test_wrappers_do_not_hide_the_text(html, want):
    assert html_text.main_text(html) == want


@pytest.mark.parametrize("html, want", [
    ("<head><title>x</title><body><article><p>Text.</article>", "Text."),
    ("<html><head><title>x</title><meta a=b><article><p>Text.</article>", "Text."),
    ("<article><svg/><p>Text.</p></article>", "Text."),
    ("<article><p>a<svg><text>no</text></svg>b</p><svg><g>no<p>Text.</p></article>", "a b\n\nText."),
    ("<article><template><p>no</p></template><object><p>no</p></object><p>Text.</p></article>", "Text."),
    (f"<article><p>{LONG}</p><section class='related-work'><p>{LONG}</p></section><div class='share-price'><p>Up 3</p></div>"
     f"<div class='related-posts'><p>no</p></div><div class='ad box'><p>no</p></div></article>", f"{LONG.strip()}\n\n{LONG.strip()}\n\nUp 3"),
    ("<div class='ad'>" * 25 + f"<p>{LONG}</p><div class='sidebar'><p>Side.</p></div>", LONG.strip()),
])
def test_valid_pages_lose_no_text(html, want):
    assert html_text.main_text(html) == want


MIDDLE = "He was in the house and it was not for him that they had come to the door of it."


def unmarked(rng):
    """A page without article or main, and its text: short ends, by-line, list, headings."""
    story = ["By A. Writer", *[" ".join(rng.choices(MIDDLE.split(), k=rng.randint(30, 80))) for _ in range(3)],
             "He never came back.", *[" ".join(rng.choices(MIDDLE.split(), k=rng.randint(30, 80))) for _ in range(2)], "The end."]
    body = "".join(f"<p>{t}</p>" for t in story)
    menu = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(6))
    return f"<body><nav><ul>{menu}</ul></nav><h1>A title</h1>{body}<footer><p>Imprint</p></footer>", ["A title", *story]


def test_unmarked_pages_by_density():
    """Where nothing but the density rules decides, nearly all text and little else is found."""
    rng = random.Random(3)
    right = found = wanted = 0
    for _ in range(60):
        html, want = unmarked(rng)
        got = html_text.main_text(html).split("\n\n")
        right += len(set(got) & set(want))
        found, wanted = found + len(got), wanted + len(want)
    assert right / found > 0.97 and right / wanted > 0.97


@pytest.mark.parametrize("html, want", [
    (f"<p>By-line.</p><p>{LONG}{LONG}</p><p>He never came back.</p>", ["By-line.", LONG + LONG, "He never came back."]),
    (f"<h1>Four</h1><p>{MIDDLE}</p><p>{MIDDLE}</p><h2>More</h2><p>{MIDDLE}</p>", ["Four", MIDDLE, MIDDLE, "More", MIDDLE]),
    (f"<ul><li>Flour<li>Salt</ul><p>{LONG}{LONG}</p>", ["Flour", "Salt", LONG + LONG]),
])
def test_edges_of_unmarked_pages(html, want):
    assert html_text.main_text(html) == "\n\n".join(" ".join(t.split()) for t in want)


RUSSIAN = "Кошка и собака живут в доме, и у них есть всё, чего они хотят, а именно быть с вами весь день. " * 3
CHINESE = "猫和狗住在房子里,它们拥有想要的一切,就是整天和你在一起。" * 5
POLISH = "Kot i pies mieszkają w domu, mają wszystko, czego chcą, czyli chcą być przy tobie każdego dnia. " * 3
CODE = "rows = [int(x) for x in open(path)]\nprint(sum(rows) / len(rows), max(rows), min(rows))\n" * 4


@pytest.mark.parametrize("html, want", [
    (f"<ul><li><a href='/'>Дом</a></ul><h1>Кошка</h1><p>{RUSSIAN}</p><p>{RUSSIAN}</p><footer>{RUSSIAN}</footer>", ["Кошка", RUSSIAN, RUSSIAN]),
    (f"<p><a href='/'>{CHINESE}</a></p><p>{CHINESE}</p>", [CHINESE]),
    (f"<div class='with-sidebar'><p>{POLISH}</p><p>{POLISH}</p><div class='ad'>Kup</div></div>", [POLISH, POLISH]),
    (f"<p>{RUSSIAN}</p><p>{LONG[:105]}</p>", [RUSSIAN, LONG[:105]]),
    (f"<p>{LONG}</p><pre>{CODE}</pre><p>{LONG}</p><pre>{CODE}</pre>", [LONG, CODE, LONG, CODE]),
    (f"<pre>{CODE}</pre>", [CODE]),
])
def test_text_without_known_stop_words(html, want):
    assert html_text.main_text(html) == "\n\n".join(" ".join(t.split()) for t in want)


def test_ambiguous_blocks_follow_their_neighbours():
    found = [html_text.Block(t, 0, False, 0, False) for t in "abcde"]
    assert html_text.second_pass(found, ["good", "short", "good", "short", "bad"]) == [True, True, True, False, False]
    assert html_text.second_pass(found, ["bad", "short", "bad", "near", "good"]) == [False, False, False, True, True]


def test_pages_give_their_articles(spark, sf_dir):
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op6_html_text"](spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1].replace("<br>", " ")
        parts = [" ".join(unescape(re.sub(r"<[^>]*>?", "", p)).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_extract_keeps_every_row(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<article><p>a</p></article>", "y"), (2, "u", "<article>" + "<p>ab</p>" * 30_000, "z")]
    out = html_text.extract(frame(spark, rows, PAGES + ", text string")).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in out) == [(0, 1), (1, 0), (1, 0), (2, 30_000 * 4 - 2)]
    assert html_text.extract(frame(spark, [], PAGES)).count() == 0


# WARC --------------------------------------------------------------------------------


def test_archive_round_trip(spark):
    rows = [(1, "http://a/ b\r\n", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (5, "u", "x\r\n\r\nWARC/1.1 y" * 9000),
            (None, "u", "<p>é</p>"), (None, None, "alone"), (5, "u", "x\r\n\r\nWARC/1.1 y" * 9000)]
    path = stage_path(spark)
    index = warc.write_archive(frame(spark, rows, PAGES).repartition(3).withColumn("payload", F.lit(1)), path, file_bytes=500)
    assert index.count() == len(rows) and index.select("file").distinct().count() > 3
    read = warc.read_records(index, path, range_bytes=300, gap_bytes=0).collect()
    got = sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in read)
    keeper = {"<p>é</p>": 2, "": 4, "x\r\n\r\nWARC/1.1 y" * 9000: 5}
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        to = keeper.get(html or "")
        revisit = to is not None and page_id != to
        want.append((page_id or 0, len(data), warc.digest(data), "revisit" if revisit else "response", to if revisit else 0))
    assert got == sorted(want)
    payloads = {bytes(r.payload) for r in read if r.record_type == "response"}
    assert payloads == {(h or "").encode() for _, _, h in rows}
    one = warc.read_records(index.where("page_id = 1"), path).collect()
    assert [r.url for r in one] == ["http://a/%20b%0D%0A"]


def test_archive_of_small_payloads_and_of_nothing(spark):
    rows = [(1, "u", "same"), (2, "u", "same")]
    assert warc.write_archive(frame(spark, rows, PAGES), stage_path(spark), least_bytes=5).where("record_type = 'revisit'").isEmpty()
    path = stage_path(spark)
    empty = warc.write_archive(frame(spark, [], PAGES), path)
    assert empty.isEmpty() and warc.read_records(empty, path).isEmpty()


def test_damage_is_noticed(spark):
    path = stage_path(spark)
    index = warc.write_archive(frame(spark, [(1, "u", "text")], PAGES), path)
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(index.withColumn("payload_digest", F.lit("X")), path).collect()


def test_warc_equals_sql(spark, sf_dir):
    assert difference(QUERIES["op8_warc"](spark, sf_dir), connect(sf_dir), ORACLES["op8_warc"]) is None


# Token totals ------------------------------------------------------------------------

COUNTS = "source string, lang string, tokenizer_version string, n_tokens long, old_tokens long"


def test_rollup_commits_once(spark):
    rollup = token_rollup.Rollup(spark, stage_path(spark))
    assert rollup.totals().isEmpty()
    rows = frame(spark, [("a", "en", "1", 5, 2), ("a", "en", "1", 7, 0), (None, "en", "1", None, 1), ("b", None, "1", 3, 3)], COUNTS)
    load, gone, new = token_rollup.inserts(rows), token_rollup.deletes(rows.where("source = 'b'")), token_rollup.revisions(rows.where("source = 'a'"))
    totals = lambda: {(r.source, r.lang): (r.documents, r.tokens) for r in rollup.totals().collect()}
    first = {("a", "en"): (2, 12), (None, "en"): (1, 0), ("b", None): (1, 3)}
    assert rollup.commit("load", load) and totals() == first
    assert not rollup.commit("load", load.limit(1)) and totals() == first
    rollup.compact()
    assert totals() == first and not rollup.commit("load", load)
    assert rollup.commit("gone", gone) and rollup.commit("new", new) and rollup.commit("nothing", load.limit(0))
    last = {("a", "en"): (2, 22), (None, "en"): (1, 0)}
    assert totals() == last
    rollup.compact()
    again = token_rollup.Rollup(spark, rollup.path)
    assert {(r.source, r.lang): (r.documents, r.tokens) for r in again.totals().collect()} == last
    assert not any(again.commit(b, load) for b in ("load", "gone", "new", "nothing"))


def test_unfinished_batch_does_not_count(spark):
    rollup = token_rollup.Rollup(spark, stage_path(spark))
    rows = token_rollup.inserts(frame(spark, [("a", "en", "1", 5, 0)], COUNTS))
    rollup.commit("one", rows)
    rollup.fs.delete(rollup.hadoop(f"{rollup.path}/deltas/{rollup._folder('one')}/_SUCCESS"), False)
    assert rollup.totals().isEmpty()
    assert rollup.commit("one", rows) and rollup.totals().first().tokens == 5


def test_token_counts_equal_the_tokenizer(spark, sf_dir):
    import tiktoken

    encoding = tiktoken.Encoding("t", pat_str=queries.PATTERN, mergeable_ranks=token_rollup.read_ranks(queries.VOCABULARY), special_tokens={})
    rows = [(1, None, "k"), (2, "", "k"), (3, "It's  <|endoftext|> 42\n\n é 日本 " * 500, "k")]
    rows += [(r.doc_id, r.text, "k") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id >= 4").limit(40).collect()]
    docs = frame(spark, rows, "doc_id long, text string, n string")
    out = token_rollup.token_counts(docs, queries.VOCABULARY, queries.PATTERN, "bpe", ["doc_id", "n"]).collect()
    assert {r.doc_id: r.bpe for r in out} == {i: len(encoding.encode_ordinary(t or "")) for i, t, _ in rows}


def test_rollup_query_equals_brute_force(spark, sf_dir):
    import tiktoken

    encoding = tiktoken.Encoding("t", pat_str=queries.PATTERN, mergeable_ranks=token_rollup.read_ranks(queries.VOCABULARY), special_tokens={})
    rows = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    want, seen = Counter(), set()
    for r in rows:
        if r.text in seen:
            continue
        seen.add(r.text)
        for version, n in (("byte_bpe_50k", len(encoding.encode_ordinary(r.text))), ("units", len(r.text))):
            want[r.source, r.lang, version, "documents"] += 1
            want[r.source, r.lang, version, "tokens"] += n
    got = {}
    for r in QUERIES["op7_token_rollup"](spark, sf_dir).collect():
        got[r.source, r.lang, r.tokenizer_version, "documents"] = r.documents
        got[r.source, r.lang, r.tokenizer_version, "tokens"] = r.tokens
    assert got == dict(want)


def test_copies_without_ids_and_with_shared_ids(spark, tmp_path):
    """A text whose only row has no id stays, as do different texts of one id; of exact copies one stays."""
    rows = [
        (None, "lonely row", "en", "a", 10), (7, "first text", "en", "a", 10), (7, "second text", "de", "b", 11),
        (7, "second text", "de", "b", 11), (9, "second text", "fr", "c", 11), (None, "first text", None, "a", 10),
        (3, None, "en", "d", 0), (4, "", "en", "a", 0), (None, "twice", None, None, 5), (None, "twice", None, None, 5),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame(spark, rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    got = {
        (r.source, r.lang): (r.documents, r.tokens)
        for r in QUERIES["op7_token_rollup"](spark, str(tmp_path)).where("tokenizer_version = 'units'").collect()
    }
    assert got == {("a", "en"): (2, 20), ("b", "de"): (1, 11), ("d", "en"): (1, 0), (None, None): (1, 5)}


def test_one_of_each_keeps_whole_rows(spark):
    rows = [(1, None, "x", 5), (1, 4, "y", 6), (1, 4, "w", 7), (None, None, None, 8), (2, None, "z", 9)]
    kept = token_rollup.one_of_each(frame(spark, rows, "k int, id int, s string, n int"), "k", ["id"])
    assert kept.columns == ["k", "id", "s", "n"]
    assert {tuple(r) for r in kept.collect()} == {(1, 4, "w", 7), (None, None, None, 8), (2, None, "z", 9)}
    assert token_rollup.one_of_each(kept.limit(0), "k", ["id"]).isEmpty()


# Mixing ------------------------------------------------------------------------------


def test_rates_meet_targets(spark):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        a, b = rng.random(), rng.random()
        rows.append((i, rng.randrange(1, 200), a / (a + b + 0.2), b / (a + b + 0.2), 0.2 / (a + b + 0.2), 0.0))
    docs = frame(spark, rows, "doc_id long, n_tokens long, p_a double, p_b double, p_c double, p_d double")
    targets = {"a": 0.5, "b": 0.3, "c": 0.2, "d": 0.0}
    out = mixing.fit_rates(docs, targets, steps=200, tolerance=1e-6).collect()
    total = sum(r.n_tokens for r in out)
    assert all(r.rate >= 0 for r in out)
    for d, share in targets.items():
        assert sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in out) / total == pytest.approx(share, abs=1e-3)


def test_mixing_query_meets_reachable_targets(spark, sf_dir):
    out = QUERIES["op9_mixing"](spark, sf_dir).collect()
    assert len(out) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(abs(sum(r[f"p_{d}"] for d in mixing.TARGETS) - 1) < 1e-9 and r.rate >= 0 for r in out)
    total = sum(r.n_tokens for r in out)
    share = sum(r.rate * r.n_tokens * r.p_q1_t0 for r in out) / total
    assert share == pytest.approx(mixing.TARGETS["q1_t0"], abs=0.05)


def test_mixing_edges(spark):
    docs = frame(spark, [(1, None, 1), (1, None, 1), (None, "a b", 2), (2, "word " * 50_000, 3)], "doc_id long, text string, rate int")
    labels = frame(spark, [(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 0), (9, 7, 7)], "doc_id long, quality int, toxic int")
    for own in (labels, labels.limit(0)):
        out = mixing.mixing_rates(docs, own).collect()
        assert sorted(r.n_tokens for r in out) == [0, 0, 2, 50_000] and all(r.rate >= 0 for r in out)
    assert mixing.mixing_rates(docs.limit(0), labels).count() == 0
    assert {r.rate for r in mixing.mixing_rates(docs.where("doc_id = 1"), labels).collect()} == {1.0}


def test_mixing_runs_no_python(spark, sf_dir):
    plan = QUERIES["op9_mixing"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Vector search -----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def exact(rows, k):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            out[i] = sorted((-float(np.einsum("j,j->", w, v)), j) for j, w in rows if j != i)[:k]
    return out


def test_visiting_all_leaves_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)] + [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(400, 500)]
    vectors = frame(spark, [(i, v, 0) for i, v in rows], VECTORS).repartition(3)
    out = vector_search.nearest(vectors, F.col("vec_id") % 20 == 0, k=20, recall=1.0, sample=100, leaf_rows=10, probes=500, block=16).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for query, want in exact(rows, 20).items():
        assert [i for i, _ in got[query]] == [j for _, j in want]
        assert np.allclose([s for _, s in got[query]], [-s for s, _ in want], rtol=1e-12)


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0]), (None, [1.0, 1.0]), (20, [-1.0, 0.0]), (40, None)]
    vectors = frame(spark, [(i, v, 0) for i, v in rows], VECTORS).withColumn("rank", F.lit("x"))
    out = vector_search.nearest(vectors, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out) == [(0, 1, 1, 1.0), (0, 2, 20, -1.0), (20, 1, 0, -1.0), (20, 2, 1, -1.0)]
    assert vector_search.nearest(vectors.limit(0), F.lit(True)).isEmpty()
    assert vector_search.nearest(vectors, F.lit(False)).isEmpty()


def test_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = Counter()
    want = exact(rows, 20)
    for r in QUERIES["op10_vector_search"](spark, sf_dir).collect():
        got[r.query_id] += r.vec_id in {j for _, j in want[r.query_id]}
    assert sum(got.values()) / (20 * len(want)) >= 0.9
