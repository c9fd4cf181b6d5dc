"""Near-duplicates and benchmark copies against brute force; the whole pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, difference
from outreach.llm import decontamination, near_dedup
from outreach.llm.queries import ORACLES, QUERIES


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return {i: top(i) for i, _ in sets}


def family(rng, first, size, words, edits):
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    out = []
    for i in range(size):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        out.append((first + i, " ".join(own)))
    return out


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 16)  # lists are cut
    monkeypatch.setattr(near_dedup, "_SMALL", 10)  # and id lists joined by shuffle
    rng = random.Random(3)
    rows = family(rng, 0, 60, 80, 6) + family(rng, 100, 30, 40, 5) + family(rng, 200, 10, 300, 12)
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(300 + i, passage + " " + " ".join(f"q{rng.randrange(5000)}" for _ in range(rng.randrange(5, 40)))) for i in range(40)]
    rows += [(400, None), (401, ""), (402, " \t"), (403, "one two"), (404, "ONE two"), (405, "one two three"), (406, "é " * 20_000)]
    out = near_dedup.near_duplicates(frame(spark, rows).repartition(4)).collect()
    want = brute_components(rows)
    assert {r.doc_id: r.component_id for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    assert {r.doc_id: r.n_shingles for r in out} == {i: len(shingle_set(t)) for i, t in rows}


def test_near_duplicate_edges(spark):
    schema = "doc_id long, text string, component_id string, sig int"
    assert near_dedup.near_duplicates(frame(spark, [], schema)).count() == 0
    long = "a b c d e f g h"
    rows = [(2, long, "x", 1), (2, long, "y", 2), (1, long, "z", 3), (None, long, "n", 4), (None, None, "n", 4), (5, "only", "o", 5)]
    docs = frame(spark, rows, schema)
    out = sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in near_dedup.near_duplicates(docs).collect())
    assert out == [(-1, -1, True), (-1, -1, True), (1, 1, True), (2, 1, False), (2, 1, False), (5, 5, True)]
    left = near_dedup.deduplicated(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in left.collect()) == [-1, -1, 1, 5]
    twice = near_dedup.deduplicated(frame(spark, rows[:2], schema)).collect()
    assert [tuple(r) for r in twice] == [(2, long, "x", 1)]


def test_rows_that_share_an_id_are_not_copies(spark):
    """Different texts under one id stay; odd columns do too."""
    schema = "doc_id long, text string, `a.b` string, m map<string,int>, _key int, _no_id string, _id int"
    a, b, c = "a b c d e f g h", "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, a), (1, b), (1, b), (2, a), (None, b), (None, c), (None, c), (3, c), (1, ""), (1, None), (None, "")]
    docs = frame(spark, [(*r, "x", {"k": 1}, 7, "n", 8) for r in rows], schema)
    left = near_dedup.deduplicated(docs, without_id=True)
    assert left.columns == docs.columns
    found = sorted(((r.doc_id or -1, r.text or "") for r in left.collect()))
    assert found[:1] == [(-1, "")] and (3, c) in found and (1, "") in found
    assert sorted(t for _, t in found) == sorted(["", "", "", a, b, c])
    assert {r._no_id for r in left.collect()} == {"n"} and {r.m["k"] for r in left.collect()} == {1}


def test_near_dedup_equals_sql(spark, sf_dir):
    assert difference(QUERIES["op3_near_dedup"](spark, sf_dir), connect(sf_dir), ORACLES["op3_near_dedup"]) is None


# Benchmark copies --------------------------------------------------------------------


def plain_alignment(doc, item):
    best = 0
    above = [0] * (len(doc) + 1)
    for word in item:
        row = [0]
        for j, own in enumerate(doc, start=1):
            row.append(max(0, above[j - 1] + (2 if own == word else -1), above[j] - 1, row[j - 1] - 1))
        best = max(best, max(row))
        above = row
    return best


def test_alignment_equals_the_textbook():
    rng = random.Random(1)
    for _ in range(200):
        doc = [rng.randrange(6) for _ in range(rng.randrange(0, 40))]
        item = [rng.randrange(6) for _ in range(rng.randrange(0, 15))]
        score, first, end = decontamination.align(np.array(doc, dtype=np.uint64), np.array(item, dtype=np.uint64))
        assert score == plain_alignment(doc, item)
        if score:
            assert plain_alignment(doc[first:end], item) == score


def test_copies_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.contaminated(docs, items).collect()}
    own = [(r.item_id, decontamination.plain_words(r.text)) for r in items.collect()]
    want = {}
    hashes = decontamination.Hashes()
    for r in docs.select("doc_id", "text").collect():
        words = hashes.of(decontamination.plain_words(r.text))
        for item_id, item in own:
            score, _, _ = decontamination.align(words, hashes.of(item))
            if score >= 0.5 * 2 * len(item):
                want[r.doc_id, item_id] = score
    assert got == want and got


def test_edited_copies_and_common_passages(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)  # several blocks of items
    rng = random.Random(2)
    item = [f"item{i}" for i in range(30)]
    edited = [w for i, w in enumerate(item) if i % 9] + ["more"]
    rows = [(1, " ".join(f"z{i}" for i in range(50)) + " " + " ".join(edited).upper() + "!"), (2, "clean words only here"), (3, None), (4, ""),
            (None, " ".join(item)), (5, "the of and " * 5_000), (1, "again another text")]
    rows += [(100 + i, f"{rng.random()} " + " ".join(item)) for i in range(60)]
    bench = [(7, " ".join(item)), (7, " ".join(item)), (8, "the of"), (9, None), (None, "clean words only here"), (10, "other " + " ".join(f"o{i}" for i in range(20)))]
    docs, items = frame(spark, rows, "doc_id long, text string"), frame(spark, bench, "item_id long, text string")
    found = decontamination.contaminated(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(1, 7)} | {(100 + i, 7) for i in range(60)}
    left = decontamination.decontaminated(docs.withColumn("score", F.lit(1)), items)
    assert left.columns == ["doc_id", "text", "score"]
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, 2, 3, 4, 5]
    assert decontamination.contaminated(docs.limit(0), items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("words, changed, verbatim", [(20, 2, 0), (30, 3, 0), (50, 4, 1), (12, 1, 0)])
def test_repeated_edited_passages_are_found(spark, words, changed, verbatim):
    item = [f"item{i}" for i in range(words)]
    step = words // (changed + 1)
    edited = [f"new{i}" if i and i % step == 0 and i // step <= changed else w for i, w in enumerate(item)]
    rng = random.Random(4)
    rows = [(i, " ".join([f"z{rng.randrange(500)}" for _ in range(20)] + (item if i < verbatim else edited))) for i in range(50)]
    rows += [(100 + i, f"{rng.random()} " + " ".join(item[:3])) for i in range(50)]  # a seed alone is no copy
    bench = frame(spark, [(7, " ".join(item))], "item_id long, text string")
    found = decontamination.contaminated(frame(spark, rows), bench).collect()
    assert sorted(r.doc_id for r in found) == list(range(50))


def test_no_alignment_exceeds_the_bound():
    rng = random.Random(5)
    for _ in range(500):
        doc = np.array([rng.randrange(12) for _ in range(rng.randrange(1, 60))], dtype=np.uint64)
        item = np.array([rng.randrange(9) for _ in range(rng.randrange(3, 15))], dtype=np.uint64)
        need = 0.5 * 2 * len(item)
        score, _, _ = decontamination.align(doc, item)
        assert score < need or decontamination.may_reach(doc, np.unique(item), len(item), need)
    assert not decontamination.may_reach(doc + np.uint64(50), np.unique(item), len(item), need)


# Pipeline ----------------------------------------------------------------------------


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stage(step(spark, docs, sf_dir))
        assert after.columns == columns, name
        assert after.exceptAll(docs).isEmpty() and 0 < after.count() <= before, name
        if name == "near_dedup":
            assert after.count() == docs.join(near_dedup.near_duplicates(docs).where("kept").select("doc_id"), "doc_id", "left_semi").count()
        docs, before = after, after.count()
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() == before and out.where("rate < 0 OR rate IS NULL").isEmpty()


def test_stages_search_rows_without_id(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    schema = "doc_id long, text string, lang string"
    rows = [(None, f"before {item} after", "en"), (None, "a b c d e f g h", "en"), (None, "a b c d e f g h", "fr"), (None, "one of its own kind", "en"),
            (3, "i j k l m n o p", "en"), (None, "i j k l m n o p", "en"), (None, None, "en"), (None, " ", "en"), (None, " ", "en")]
    docs = frame(spark, rows, schema)
    left = corpus_pipeline.drop_near_duplicates(spark, docs, sf_dir)
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.exceptAll(frame(spark, [rows[2], rows[5]], schema)).collect()))
    left = corpus_pipeline.drop_benchmark_copies(spark, docs, sf_dir)
    assert sorted(map(str, left.collect())) == sorted(map(str, frame(spark, rows[1:], schema).collect()))


@pytest.mark.parametrize("name, step", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, sf_dir, name, step):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, node long"
    rows = [(None, None, None, None, None, None, None), (1, "", "en", "s", 0, "x", 1), (1, "", "en", "s", 0, "x", 1), (2, "the cat " * 20_000, "en", None, 5, "y", 2)]
    for docs in (frame(spark, rows, schema), frame(spark, [], schema)):
        out = step(spark, docs, sf_dir)
        assert out.count() <= docs.count()
        assert name == "mixing" or out.columns == docs.columns
