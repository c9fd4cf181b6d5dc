"""Language-model scores, language identification, toxicity: brute force and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from outreach.llm import language_id, lm_scoring, toxicity
from outreach.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


# Language-model scores ---------------------------------------------------------------


def plain_scores(docs, order, weights):
    """The same model with dictionaries; docs: (doc_id, text, role)."""
    grams = [Counter() for _ in range(order)]
    runs = {}
    for doc_id, text, role in docs:
        run = [b"<b>"] * (order - 1) + (text or "").encode().lower().split() + [None]
        runs[doc_id] = run
        if role == lm_scoring.TEST:
            continue
        for i in range(max(0, order - 2), len(run)):
            for n in range(1, order + 1):
                if i - n + 1 >= 0:
                    grams[n - 1][tuple(run[i - n + 1 : i + 1])] += 1
    words = {k: v for k, v in grams[0].items() if k != (b"<b>",)}
    total, kinds = sum(words.values()), len(words)
    out = {}
    for doc_id, run in runs.items():
        score = base = known = 0
        for i in range(order - 1, len(run)):
            parts, bucket = [1 / (kinds + 1), words.get((run[i],), 0) / max(total, 1)], 0
            for n in range(2, order + 1):
                context = grams[n - 2][tuple(run[i - n + 1 : i])]
                parts.append(grams[n - 1][tuple(run[i - n + 1 : i + 1])] / context if context else 0.0)
                if context:
                    bucket = (n - 2) * 40 + 1 + min(39, int(math.log2(context)))
            score += math.log10(np.dot(parts, weights[bucket]))
            base += math.log10((words.get((run[i],), 0) + 0.1) / (total + 0.1 * (kinds + 1)))
            known += (run[i],) in words
        out[doc_id] = (len(run) - order + 1, known, total, base, score)
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(lm_scoring, "BUCKET_KEYS", 20)  # several buckets
    seen = {}
    learn = lm_scoring.learn_weights

    def remember(*args):
        seen["weights"] = learn(*args)
        return seen["weights"]

    monkeypatch.setattr(lm_scoring, "learn_weights", remember)
    rng = random.Random(5)
    words = ["a", "B", "the", "cat", "sat", "é", "on", "mat,"]
    rows = [(i, " ".join(rng.choices(words, weights=[9, 1, 5, 2, 2, 1, 3, 1], k=rng.randrange(0, 30))), i % 4 % 3) for i in range(40)]
    rows += [(100, None, 2), (101, "", 0), (102, " \t\n", 2), (103, "zzz unseen zzz", 0), (104, "the " * 500, 2)]
    docs = frame(spark, rows, "doc_id long, text string, role int").repartition(3)
    got = {r.doc_id: r for r in lm_scoring.score_texts(docs, F.col("role"), order=order, iterations=3).collect()}
    want = plain_scores(rows, order, seen["weights"])
    assert np.allclose(seen["weights"].sum(axis=1), 1)
    assert set(got) == set(want)
    for doc_id, (n, known, total, base, score) in want.items():
        r = got[doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def scored(spark, monkeypatch, docs, rows, order=3):
    """Scores of `docs` beside those by brute force of `rows`, (key, text, role); both sorted."""
    seen = {}
    learn = lm_scoring.learn_weights
    monkeypatch.setattr(lm_scoring, "learn_weights", lambda *args: seen.setdefault("weights", learn(*args)))
    found = lm_scoring.score_texts(docs, F.col("role"), order=order, iterations=2).collect()
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found)
    want = plain_scores([(i, text, role) for i, (_, text, role) in enumerate(rows)], order, seen["weights"])
    return got, sorted((n, known, total, round(base, 6), round(score, 6)) for n, known, total, base, score in want.values())


def test_a_table_twice_and_long_texts(spark, monkeypatch):
    """Equal batches in several tasks, and texts longer than a batch."""
    monkeypatch.setattr(lm_scoring, "BUCKET_KEYS", 20)
    monkeypatch.setattr(lm_scoring, "BATCH_TOKENS", 50)
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choices("a b c the cat sat".split(), k=rng.randrange(0, 30))), i % 3) for i in range(40)]
    rows.append((90, "so long a text " * 200, 2))
    once = frame(spark, rows, "doc_id long, text string, role int").coalesce(1)
    got, want = scored(spark, monkeypatch, once.unionAll(once), rows + rows)
    assert got == want


def test_rows_without_an_id_in_several_partitions(spark, monkeypatch):
    rows = [(None, "pear", 2), (None, "zebra", 0), (None, "pear", 1), (None, None, 0)]
    parts = [frame(spark, [r], "doc_id long, text string, role int").coalesce(1) for r in rows]
    docs = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    got, want = scored(spark, monkeypatch, docs, rows)
    assert got == want


def test_scores_of_nothing_and_without_training(spark):
    empty = frame(spark, [])
    assert lm_scoring.score_texts(empty, F.lit(2)).count() == 0
    row = lm_scoring.score_texts(frame(spark, [(1, "a b")]), F.lit(lm_scoring.TEST)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and math.isfinite(row.score) and math.isfinite(row.base_score)


def test_repeated_rows_null_ids_and_other_columns(spark):
    rows = [(1, "a b a", 5.0), (1, "a b a", 6.0), (None, "a", 7.0)]
    out = lm_scoring.score_texts(frame(spark, rows, "doc_id long, text string, score double"), F.lit(2)).collect()
    assert sorted((r.doc_id is None, r.n_tokens) for r in out) == [(False, 4), (False, 4), (True, 2)]


def test_mixture_beats_the_base_on_held_out_texts(spark, sf_dir):
    rows = QUERIES["op1_lm_scoring"](spark, sf_dir).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert rows[2] > 0 and rows[0] > rows[1]


def test_two_preceding_words_are_context(spark):
    docs = frame(spark, [(i, "a b c" if i % 2 else "x b d") for i in range(60)], "doc_id long, text string")
    role = (F.col("doc_id") % 3).cast("int")
    mean = lambda out: out.agg(F.avg("score")).first()[0]
    assert mean(lm_scoring.score_texts(docs, role)) > mean(lm_scoring.score_texts(docs, role, order=2)) + 0.05


# Language identification -------------------------------------------------------------


def test_kernel_counts_shared_grams():
    texts = ["The cat", "cat, the CAT", "dog"]
    points = [language_id.letters(t) for t in texts]
    spectrum = language_id.Spectrum(points[:1], 3)
    grams = lambda t: {tuple(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    own = spectrum.matrix(points)
    for i, p in enumerate(points):
        assert int(own[0] @ own[i]) == len(grams(points[0].tolist()) & grams(p.tolist()))


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op2_language_id"](spark, sf_dir).join(docs, "doc_id").where("held_out")
    n, right = out.agg(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 20 and right / n > 0.95


def test_language_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "le chat et le chien", "fr"), (3, None, "en"), (4, "12 !!", "fr"), (5, "", None),
            (None, "the dog", "en"), (6, "日本語の文", None), (1, "the cat and the dog", "en"), (7, "le " * 30_000, "fr")]
    docs = frame(spark, rows, "doc_id long, text string, lang string")
    model = language_id.learn(docs, F.lit(True))
    out = [(r.doc_id, r.lang_pred, r.score) for r in language_id.identify(docs, model).collect()]
    assert len(out) == len(rows) and all(0 <= s <= 1 for _, _, s in out)
    by_id = {i: lang for i, lang, _ in out}
    assert (by_id[1], by_id[2], by_id[7], by_id[None]) == ("en", "fr", "fr", "en")
    assert [by_id[i] for i in (3, 4, 5)] == ["und"] * 3
    nothing = language_id.learn(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identified(docs, nothing).count() == len(rows)
    kept = {r.doc_id for r in language_id.identified(docs, model).collect()}
    assert {1, 2, 7} <= kept and not {3, 4, 5} & kept


def test_a_language_of_long_texts_is_learned(spark):
    rows = [(i, f"the cat and the dog {i}", "en") for i in range(5)] + [(10 + i, "le chat et le chien " * 2_000, "fr") for i in range(3)]
    docs = frame(spark, rows + [(20, "12 " * 9_000, "xx")], "doc_id long, text string, lang string")
    model = language_id.learn(docs, F.lit(True))
    assert model.languages == ["en", "fr"]
    assert {r.doc_id: r.lang_pred for r in language_id.identify(docs, model).collect()} == {i: lang for i, _, lang in rows} | {20: "und"}


def test_the_cutoff_does_not_hang_on_the_number_of_languages(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) > 200").orderBy("doc_id").collect()
    languages = sorted({r.lang for r in rows})
    other = ["Кошка и собака живут в доме, и у них есть всё, чего они хотят, а именно быть с вами весь день. " * 6, "ქართული ენა არის " * 20]
    for n in (2, len(languages)):
        known = [r for r in rows if r.lang in languages[:n]]
        model = language_id.fit([(r.lang, r.text) for r in known[::2]])
        assert np.mean(model.belongs([r.text for r in known[1::2]])) > 0.99
        assert all(model.belongs([" ".join(r.text.split()[:1]) for r in known if r.text.split()[0][:1].isalpha()] + ["De."]))
        assert model.belongs(other) == [False, False] and model.belongs([None, "", "12"]) == [False] * 3


# Toxicity ----------------------------------------------------------------------------


def test_probabilities_sum_to_one():
    counts = [Counter(), Counter()]
    for toxic, words in enumerate((["cat", "car", "cart", "dog"], ["scum", "scam", "cat"])):
        for word in words:
            counts[toxic].update(toxicity.word_grams(word, 3))
    model = toxicity.Model(3, (dict(counts[0]), dict(counts[1])))
    model._prepare()
    letters = {g[-1] for c in counts for g in c}
    for toxic in (0, 1):
        for context in ("^", "^c", "ca", "sc", "zz"):
            known = sum(model.probability(toxic, context + x) for x in letters)
            assert known + model.probability(toxic, context + "?") == pytest.approx(1)


def test_toxic_held_out_documents(spark, sf_dir):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")  # the smallest with enough of them
    out = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    assert len(out) > 10 and sum(r.toxic == r.predicted for r in out) / len(out) > 0.9


def test_toxicity_edges(spark):
    good = [(i, f"the cat number{chr(97 + i % 20)} sat on the mat", 0) for i in range(40)]
    bad = [(100 + i, f"you are scum and vequ{'aeiou'[i % 5]}{chr(97 + i % 20)} too", 1) for i in range(40)]
    docs = frame(spark, [(i, t) for i, t, _ in good + bad])
    labels = frame(spark, [(i, x) for i, _, x in good + bad] + [(1, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, F.lit(True))
    odd = frame(spark, [(1, None), (1, None), (2, ""), (3, "!!! 12"), (4, "you are scum and vequau"), (None, "the mat"), (5, "cat " * 50_000 + "scum vequau"), (6, "ẞ İ")])
    out = [(r.doc_id, r.score, r.predicted) for r in toxicity.toxicity(odd, model).collect()]
    assert len(out) == 8 and all(0 <= s <= 1 for _, s, _ in out)
    by_id = {i: p for i, _, p in out}
    assert (by_id[4], by_id[5], by_id[None], by_id[2]) == (1, 1, 0, 0)
    assert {r.doc_id for r in toxicity.without_toxic(odd, model).collect()} == {1, 2, 3, 6, None}
    none = toxicity.learn(docs, labels.where("toxic = 0"), F.lit(True))
    assert {(r.score, r.predicted) for r in toxicity.toxicity(odd, none).collect()} == {(0.0, 0)}
    assert toxicity.toxicity(docs.limit(0), model).count() == 0
