"""Language identification with blended-spectrum string kernels.

The kernel counts the letter n-grams (lengths 1 to SPECTRUM) that two texts both hold,
divided by the geometric mean of their numbers: presence, not frequency. Nyström: a few
landmark texts per language stand for all, so a text is mapped to its kernel values with
the landmarks, whitened by the landmarks' own kernel matrix. One ridge regression per
language (one-versus-rest) is fitted on that map. Texts become rows of a 0/1 matrix over
the landmarks' n-grams, and a batch is scored by two matrix products.

Texts are lower-cased letters with one mark for whatever stands between words. Fitting
takes at most `rows` labelled texts per language, scoring reads every text whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import kept_rows, rows_of
from outreach.sources.staging import stage

SPECTRUM = 3
LANDMARKS = 24  # per language
ROWS = 200  # per language, landmarks among them
LONGEST = 20_000  # characters of a text that fitting looks at
RIDGE = 1e-2
UNKNOWN = "und"
SURE = 0.01  # share of the labelled texts that calibrate the cutoff from below
_BATCH = 512
_SHARPNESS = 8.0


@lru_cache(maxsize=1)
def _lower_letters() -> np.ndarray:
    """Per code point its lower-case letter's code point, 0 if it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low[0])
    return out


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters as code points, 0 between words and at both ends; empty if none."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    points = _lower_letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    if not points.any():
        return np.zeros(0, dtype=np.uint32)
    points = np.concatenate([np.zeros(1, np.uint32), points, np.zeros(1, np.uint32)])
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    return points[keep]


class Spectrum:
    """Numbers the n-grams of the landmark texts. Level by level a known n-gram and the
    next letter lead to a known longer one through a table; 0 is whatever is not known."""

    def __init__(self, texts: list[np.ndarray], longest: int):
        self.alphabet = np.unique(np.concatenate(texts)) if texts else np.zeros(0, np.uint32)
        self.width = len(self.alphabet) + 1
        self.symbol = np.zeros(0x110000, dtype=np.int32)
        self.symbol[self.alphabet] = np.arange(1, self.width)
        self.steps: list[np.ndarray] = []
        self.first = [0]
        level = [self.symbol[t] for t in texts]
        sizes = [self.width]
        starts = level
        for n in range(2, longest + 1):
            codes = [a[: len(a) - 1].astype(np.int64) * self.width + s[n - 1 :] for a, s in zip(level, starts)]
            known = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.int64)
            step = np.zeros(sizes[-1] * self.width, dtype=np.int32)
            step[known] = np.arange(1, len(known) + 1)
            self.steps.append(step)
            level = [step[c] for c in codes]
            sizes.append(len(known) + 1)
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.size = int(self.first[-1])

    def presence(self, points: np.ndarray, row: np.ndarray) -> None:
        """Mark in `row` the n-grams that a text holds; number 0 of each level stays unmarked."""
        symbols = self.symbol[points]
        level = symbols
        row[self.first[0] + level] = 1
        for n, step in enumerate(self.steps, start=2):
            if len(symbols) < n:
                break
            level = step[level[: len(level) - 1].astype(np.int64) * self.width + symbols[n - 1 :]]
            row[self.first[n - 1] + level] = 1
        row[self.first[:-1]] = 0

    def matrix(self, texts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(texts), self.size), dtype=np.float32)
        for row, points in zip(out, texts):
            if len(points):
                self.presence(points, row)
        return out


def _normal(kernel: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return kernel / np.sqrt(np.maximum(left, 1))[:, None] / np.sqrt(np.maximum(right, 1))[None, :]


@dataclass
class Model:
    languages: list[str]
    spectrum: Spectrum
    landmarks: np.ndarray  # 0/1, n-grams of each landmark
    weights: np.ndarray  # landmarks and a constant, by language
    # Best value below which a text counts as being in no language, by the power of two of
    # its letters; texts of more letters go by the last one.
    least: np.ndarray = field(default_factory=lambda: np.full(1, -np.inf))

    def kernel(self, texts: list[np.ndarray]) -> np.ndarray:
        x = self.spectrum.matrix(texts)
        return _normal(x @ self.landmarks.T, x.sum(axis=1), self.landmarks.sum(axis=1))

    def values(self, points: list[np.ndarray]) -> np.ndarray:
        """One-versus-rest values, text by language."""
        k = self.kernel(points)
        return np.hstack([k, np.ones((len(k), 1))]) @ self.weights

    def belongs(self, texts: list[str | None]) -> list[bool]:
        """Whether texts have letters and are in a learned language, as far as texts of
        their length tell."""
        points = [letters(t) for t in texts]
        if not self.languages:
            return [True] * len(texts)
        best = self.values(points).max(axis=1)
        return [bool(len(p)) and bool(v >= self.least[min(_power(p), len(self.least) - 1)]) for p, v in zip(points, best)]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        points = [letters(t) for t in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        values = self.values(points)
        best = values.argmax(axis=1)
        raised = np.exp(_SHARPNESS * (values - values.max(axis=1, keepdims=True)))
        sure = raised.max(axis=1) / raised.sum(axis=1)
        names = [self.languages[b] if len(p) else UNKNOWN for b, p in zip(best, points)]
        return names, [float(s) if len(p) else 0.0 for s, p in zip(sure, points)]


def _power(points: np.ndarray) -> int:
    return max(0, int(np.count_nonzero(points)).bit_length() - 1)


def _pieces(texts: list[np.ndarray], size: int) -> list[np.ndarray]:
    """A stretch of `size` characters of each text that has as many, from anywhere in it."""
    edge = np.zeros(1, np.uint32)
    out = []
    for i, points in enumerate(texts):
        if len(points) >= size:
            start = int((i * 0.618034) % 1 * (len(points) - size + 1))
            out.append(np.concatenate([edge, points[start : start + size], edge]))
    return out


def calibrated(model: Model, by_lang: dict[str, list[np.ndarray]], alone: float) -> np.ndarray:
    """Cutoffs by length: halfway from `alone`, the value of a text that shares nothing with
    any landmark, to the lowest values that stretches of that length of the labelled texts
    have in any language; no text is rejected where these are not above `alone`."""
    longest = max(_power(p) for texts in by_lang.values() for p in texts)
    out = np.full(longest + 1, -np.inf)
    for power in range(longest + 1):
        lowest = []
        for texts in by_lang.values():
            parts = _pieces(texts, 1 << power)
            if parts:
                best = [model.values(parts[at : at + _BATCH]).max(axis=1) for at in range(0, len(parts), _BATCH)]
                lowest.append(float(np.quantile(np.concatenate(best), SURE, method="lower")))
        if lowest and min(lowest) > alone:
            out[power] = (alone + min(lowest)) / 2
    return out


def fit(rows: list[tuple[str, str]], *, spectrum: int = SPECTRUM, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Model from (lang, text) rows; the first `landmarks` texts of a language are its landmarks."""
    by_lang: dict[str, list[np.ndarray]] = {}
    for lang, text in rows:
        points = letters(text)
        if len(points):
            by_lang.setdefault(lang, []).append(points)
    languages = sorted(by_lang)
    chosen = [p for lang in languages for p in by_lang[lang][:landmarks]]
    spec = Spectrum(chosen, spectrum)
    base = spec.matrix(chosen)
    model = Model(languages, spec, base, np.zeros((len(chosen) + 1, len(languages))))
    if not languages:
        return model
    sizes = base.sum(axis=1)
    own = _normal((base @ base.T).astype(np.float64), sizes, sizes)
    values, vectors = np.linalg.eigh(own)
    whiten = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max()))
    gram = np.zeros((len(chosen) + 1, len(chosen) + 1))
    target = np.zeros((len(chosen) + 1, len(languages)))
    for j, lang in enumerate(languages):
        for at in range(0, len(by_lang[lang]), _BATCH):
            part = by_lang[lang][at : at + _BATCH]
            phi = np.hstack([model.kernel(part) @ whiten, np.ones((len(part), 1))])
            share = 1 / len(by_lang[lang])  # every language weighs the same
            gram += share * phi.T @ phi
            target[:, j] += share * phi.sum(axis=0)
    shrink = ridge * np.eye(len(gram))
    shrink[-1, -1] = 1e-9
    solved = np.linalg.solve(gram + shrink, target)
    model.weights = np.vstack([whiten @ solved[:-1], solved[-1:]])
    if len(languages) > 1:  # with a single language there is no rest, and nothing to tell it from
        model.least = calibrated(model, by_lang, float(solved[-1].max()))
    return model


def learn(docs: DataFrame, allowed: Column, *, rows: int = ROWS, **options) -> Model:
    """Model from at most `rows` texts of each language, of those `allowed`.

    Per language the ids with the smallest hashes among rows with letters in the first
    LONGEST characters of their text. Longer texts, cut there, fill up the sample of a
    language that has too few others. Rows without lang, id or text are not learned from.
    """
    own = docs.where(allowed & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    own = own.select("lang", "doc_id", F.substring("text", 1, LONGEST).alias("text"), (F.length("text") > LONGEST).alias("_long"))
    known = own.where(F.col("text").rlike(r"\p{L}"))
    counts = known.groupBy("lang", "_long").agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return fit([])
    # A hash below the language's share leaves about 1.5 times `rows` texts; the smallest hashes stay.
    spread = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 40)) / float(1 << 40)
    share = F.lit(False)
    short = {lang: n for lang, long, n in counts if not long}
    for lang, long, n in counts:
        if not long or short.get(lang, 0) < rows:
            share = share | ((F.col("lang") == lang) & (F.col("_long") == long) & (spread <= min(1.0, (1.5 * rows + 50) / n)))
    near = known.where(share).select("lang", "text", "_long", spread.alias("_at"), "doc_id")
    picked = stage(near).orderBy("_long", "_at", "doc_id", "text").collect()
    chosen: dict[str, list[str]] = {}
    for lang, text, *_ in picked:
        if len(chosen.setdefault(lang, [])) < rows:
            chosen[lang].append(text)
    return fit([(lang, t) for lang, texts in chosen.items() for t in texts], **options)


def identify(docs: DataFrame, model: Model, keep: list[str] = ["doc_id"]) -> DataFrame:  # noqa: B006
    """The kept columns, lang_pred and score (0 to 1) of every row.

    A null text and one without letters get `und` and 0, and so does every text when
    nothing was learned. Equal values go to the language first in order. Repeated rows
    and null ids are treated like others; only `text` is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in rows_of(batches, _BATCH):
            names, scores = own.predict(batch.column("text").to_pylist())
            columns = [batch.column(c) for c in keep] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "lang_pred", "score"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))


def identified(docs: DataFrame, model: Model, *, least: float | None = None) -> DataFrame:
    """The rows of `docs` whose text is in a learned language, unchanged: whose best
    one-versus-rest value reaches `least`, by default the model's calibrated one for texts of
    its length. Texts without letters go. When nothing was learned no
    row can be rejected, and none that has letters without a calibrated cutoff."""
    if least is not None:
        model = replace(model, least=np.full(1, least))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(texts: list[str | None]) -> list[bool]:
        own = shared.value
        return [k for at in range(0, len(texts), _BATCH) for k in own.belongs(texts[at : at + _BATCH])]

    return kept_rows(docs, decide)
