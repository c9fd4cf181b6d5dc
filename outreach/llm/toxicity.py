"""Toxicity by two class-conditional Kneser-Ney models over the letters of words.

For either class the probability of a letter after the letters before it in the word
(up to ORDER - 1 of them, with a mark for the word's start) is the class's discounted
estimate, interpolated with one Kneser-Ney backoff that both classes share: continuation
counts pooled over them. A rare expression therefore differs between the classes only
where its letters leave what the ordinary class has often seen; elsewhere both back off
to the same counts and the difference is nil.

A text's evidence are length-normalised log-likelihood differences, toxic less ordinary:
of the whole text, and of its two most toxic words. A logistic curve turns them into a
score. It is fitted crosswise: the labelled rows are halved, models of either half give
the evidence of the other's rows, which they have not seen. The final models hold both.

Learning takes at most `rows` labelled documents per class and half, those with the
smallest hashes; scoring reads every text whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import kept_rows, rows_of
from outreach.sources.staging import stage

ORDER = 4
ROWS = 4000
DISCOUNT = 0.75
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")
_START, _END = "^", "$"  # no letters, so no word holds them
_REMEMBER = 1_000_000


def word_grams(word: str, order: int) -> Iterator[str]:
    """Each letter and the word's end, with the letters before."""
    marked = f"{_START}{word}{_END}"
    for i in range(1, len(marked)):
        yield marked[max(0, i - order + 1) : i + 1]


def _contexts(counts: dict[str, int]) -> dict[str, tuple[int, int]]:
    out: dict[str, tuple[int, int]] = {}
    for gram, n in counts.items():
        total, kinds = out.get(gram[:-1], (0, 0))
        out[gram[:-1]] = (total + n, kinds + 1)
    return out


@dataclass
class Model:
    """Counts of both classes; everything else is derived where it is used."""

    order: int
    counts: tuple[dict[str, int], dict[str, int]]  # ordinary, toxic
    weights: list[float] = field(default_factory=lambda: [0.0, 0.0, 0.0])

    def __post_init__(self):
        self._ready = False

    def __getstate__(self):
        return {"order": self.order, "counts": self.counts, "weights": self.weights, "_ready": False}

    def _prepare(self) -> None:
        self._own = [_contexts(c) for c in self.counts]
        level = set(self.counts[0]) | set(self.counts[1])
        self._letters = len({g[-1] for g in level}) + 1
        self._follow: dict[str, int] = Counter()
        while level:
            shorter = [g[1:] for g in level if len(g) > 1]
            self._follow.update(shorter)
            level = set(shorter)
        self._shared_contexts = _contexts(self._follow)
        self._backoffs: dict[str, float] = {}
        self._grams: dict[str, float] = {}
        self._words: dict[str, float] = {}
        self._ready = True

    def _backoff(self, gram: str) -> float:
        """Shared Kneser-Ney probability of the last letter."""
        if not gram:
            return 1 / self._letters
        if gram not in self._backoffs:
            lower = self._backoff(gram[1:])
            total, kinds = self._shared_contexts.get(gram[:-1], (0, 0))
            own = (max(self._follow.get(gram, 0) - DISCOUNT, 0) + DISCOUNT * kinds * lower) / total if total else lower
            self._backoffs[gram] = own
        return self._backoffs[gram]

    def probability(self, toxic: int, gram: str) -> float:
        lower = self._backoff(gram[1:])
        total, kinds = self._own[toxic].get(gram[:-1], (0, 0))
        if not total:
            return lower
        return (max(self.counts[toxic].get(gram, 0) - DISCOUNT, 0) + DISCOUNT * kinds * lower) / total

    def difference(self, word: str) -> float:
        """Log-likelihood of a word, toxic less ordinary."""
        known = self._words.get(word)
        if known is None:
            known = 0.0
            for gram in word_grams(word, self.order):
                part = self._grams.get(gram)
                if part is None:
                    part = math.log(self.probability(1, gram)) - math.log(self.probability(0, gram))
                    self._grams[gram] = part
                known += part
            if len(self._words) >= _REMEMBER:
                self._words.clear()
            self._words[word] = known
        return known

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        """Differences per letter: of the text, of its two most toxic words."""
        if not self._ready:
            self._prepare()
        total, letters, first, second = 0.0, 0, 0.0, 0.0
        for word, n in Counter(_WORD.findall(text.lower()) if text else ()).items():
            value = self.difference(word)
            total += n * value
            letters += n * (len(word) + 1)
            value /= len(word) + 1
            if value > first:
                first, second = value, first if n == 1 else value
            elif value > second:
                second = value
        return (total / letters if letters else 0.0), first, second

    def scores(self, evidence: list[tuple[float, float, float]]) -> np.ndarray:
        if not (self.counts[0] and self.counts[1]):
            return np.zeros(len(evidence))
        values = self.weights[0] + condensed(evidence) @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(values, -500, 500)))


def condensed(evidence: list[tuple[float, float, float]]) -> np.ndarray:
    """The curve's inputs: the whole text's difference, and that of its two most toxic
    words, of which the first counts double."""
    x = np.array(evidence, dtype=float).reshape(-1, 3)
    return np.stack([x[:, 0], 2 * x[:, 1] + x[:, 2]], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: tuple[float, ...] = (1.0, 0.02)) -> list[float]:
    """Intercept and weights; both classes weigh the same, the intercept is not shrunk. The
    whole text's difference is shrunk most: it is the one that short texts throw about."""
    if not len(y) or y.min() == y.max():
        return [0.0] * (x.shape[1] + 1)
    z = np.hstack([np.ones((len(y), 1)), x])
    share = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    w, shrink = np.zeros(z.shape[1]), np.diag([1e-6, *ridge])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        step = np.linalg.solve((z * (share * p * (1 - p))[:, None]).T @ z + shrink, z.T @ (share * (p - y)) + shrink @ w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def labelled_sample(labels: DataFrame, allowed: Column, rows: int) -> DataFrame:
    """doc_id, toxic, half: at most `rows` ids per class and half, by smallest hash."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int"))
    parts = [
        known.where((F.col("toxic") == t) & (F.col("half") == h)).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(rows)
        for t in (0, 1)
        for h in (0, 1)
    ]
    return stage(parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]))


def _count_grams(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {(half, toxic): Counter() for half in (0, 1) for toxic in (0, 1)}
        for batch in rows_of(batches, 2000):
            spelled = {key: Counter() for key in found}
            for text, toxic, half in zip(*[batch.column(c).to_pylist() for c in ("text", "toxic", "half")]):
                spelled[half, toxic].update(_WORD.findall(text.lower()) if text else ())
            for key, words in spelled.items():
                for word, n in words.items():
                    for gram in word_grams(word, order):
                        found[key][gram] += n
        for (half, toxic), grams in found.items():
            size = len(grams)
            yield pa.RecordBatch.from_pydict(
                {"half": pa.array([half] * size, pa.int32()), "toxic": pa.array([toxic] * size, pa.int32()),
                 "gram": pa.array(list(grams), pa.string()), "n": pa.array(list(grams.values()), pa.int64())}
            )

    return run


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, *, order: int = ORDER, rows: int = ROWS) -> Model:
    """Models and curve from the labelled sample."""
    sample = labelled_sample(labels, allowed, rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(sample, "doc_id")
    texts = stage(texts.select("doc_id", "text", "toxic", "half"))
    grams = texts.select("text", "toxic", "half").mapInArrow(_count_grams(order), "half int, toxic int, gram string, n long")
    halves = [Model(order, (Counter(), Counter())) for _ in (0, 1)]
    for half, toxic, gram, n in grams.groupBy("half", "toxic", "gram").agg(F.sum("n")).collect():  # bounded by the sample
        halves[half].counts[toxic][gram] = n
    model = Model(order, tuple(halves[0].counts[t] + halves[1].counts[t] for t in (0, 1)))
    seen = []
    for half in (0, 1):
        others = scored(texts.where(F.col("half") == 1 - half), halves[half], ["toxic"])
        seen += others.select("toxic", "whole", "first", "second").collect()
    model.weights = logistic(condensed([tuple(r)[1:] for r in seen]), np.array([r[0] for r in seen]))
    return model


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The kept columns, score, and the evidence (whole, first, second) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in rows_of(batches, 2000):
            texts = batch.column("text").to_pylist()
            evidence = [own.evidence(t) for t in texts]
            scores = own.scores(evidence)
            columns = [batch.column(c) for c in keep] + [pa.array(scores, pa.float64())]
            columns += [pa.array([e[i] for e in evidence], pa.float64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "whole", "first", "second"])

    kept = docs.select(*keep, "text")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return kept.mapInArrow(run, ", ".join([*kinds, "score double", "whole double", "first double", "second double"]))


def toxicity(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from the threshold on) of every row of `docs`.

    Null and empty texts have no evidence and get the curve's value there. A model that
    has not seen both classes scores every row 0. Repeated rows and null ids are scored
    like others; further columns of `docs` are ignored.
    """
    out = scored(docs, model, ["doc_id"])
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: Model, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below the threshold, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(texts: list[str | None]) -> list[bool]:
        own = shared.value
        return (own.scores([own.evidence(t) for t in texts]) < threshold).tolist()

    return kept_rows(docs, decide)
