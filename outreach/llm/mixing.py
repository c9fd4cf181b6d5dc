"""Mixing documents to target weights by soft domain membership.

A labelled table names the domains: each (quality, toxic) pair is one. A naive Bayes
classifier, learned from the labelled documents, gives every document a posterior over the
domains. Projected gradient then fits one rate per document, zero or more, so that the
expected tokens of each domain (the sum of rate * tokens * posterior) match the targets in
the least-squares sense, errors weighed by the domain's present share; that weighting
makes a step of one safe and convergence fast.

A step needs only the sums of the step before, one number per domain: a document's new
rate is an expression of its posterior and those numbers. Each step is one aggregation
over a narrow table; every STEPS_STAGED steps the rates are written, so plans stay short.

Everything is DataFrame functions. To the driver come counts, the classifier's numbers
and one sum per domain and step.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.sources.staging import stage

# Shares of the mixture's tokens by domain.
TARGETS = {"q1_t0": 0.85, "q0_t0": 0.13, "q1_t1": 0.01, "q0_t1": 0.01}
LEXICON = 64  # telling words per domain
SAMPLE = 2000  # labelled documents per domain that the words are taken from
MIN_DOCS = 5
STEPS = 60
STEPS_STAGED = 10
TOLERANCE = 1e-4

_SYMBOLS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = "\t\n\x0b\x0c\r"


def _words(text: Column) -> Column:
    """Lower-case words without ASCII punctuation and digits."""
    drop = _SYMBOLS + _SPACES
    return F.filter(F.split(F.translate(F.lower(text), drop, " " * len(drop)), " ", -1), lambda w: w != "")


def _share_of(text: Column, characters: str) -> Column:
    size = F.length(text)
    return F.when(size > 0, 1 - F.length(F.translate(text, characters, "")) / size).otherwise(0.0)


def _domains(labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """doc_id, domain; of rows that repeat an id the largest name counts."""
    name = F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("_t"), F.col("toxic").cast("string"))
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("domain"))
    named = named.where(F.col("doc_id").isNotNull() & F.col("domain").isin(list(targets)))
    return named.groupBy("doc_id").agg(F.max("domain").alias("domain"))


def _lexicons(docs: DataFrame, domains: DataFrame, targets: dict[str, float], sample: int, size: int) -> dict[str, list[str]]:
    """Per domain the words that tell most for it, by smoothed log-odds of documents."""
    parts = [domains.where(F.col("domain") == d).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for d in targets]
    ids = stage(reduce(DataFrame.unionAll, parts))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id")
    held = stage(texts.select("doc_id", "domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word")))
    sizes = {r[0]: r[1] for r in ids.groupBy("domain").agg(F.count(F.lit(1))).collect()}
    total = sum(sizes.values())
    counts = [F.sum((F.col("domain") == d).cast("long")).alias(f"n{i}") for i, d in enumerate(targets)]
    words = stage(held.groupBy("word").agg(F.count(F.lit(1)).alias("n"), *counts).where(F.col("n") >= MIN_DOCS))
    out = {}
    for i, d in enumerate(targets):
        inside, outside = sizes.get(d, 0) + 1.0, total - sizes.get(d, 0) + 1.0
        odds = F.log((F.col(f"n{i}") + 0.5) / inside) - F.log((F.col("n") - F.col(f"n{i}") + 0.5) / outside)
        best = words.where(odds > 1).orderBy(F.desc(odds), "word").limit(size).select("word")
        out[d] = [r[0] for r in best.collect()]
    return out


def features(docs: DataFrame, lexicons: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """The kept columns, n_tokens and the feature columns f0, f1, ... of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    every = sorted(set().union(*lexicons.values())) if lexicons else []
    as_array = lambda words: F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    first = docs.select(*keep, text.alias("_text"), _words(text).alias("_words"))
    second = first.select(
        *keep, F.size("_words").cast("long").alias("n_tokens"), F.length("_text").alias("_size"),
        _share_of(F.col("_text"), _SYMBOLS).alias("f0"), _share_of(F.col("_text"), _UPPER).alias("f1"),
        F.array_distinct("_words").alias("_kinds"),
    )
    third = second.withColumn("_telling", F.array_intersect("_kinds", as_array(every)))
    many = F.greatest("n_tokens", F.lit(1))
    hits = [
        F.log1p(F.size(F.array_intersect("_telling", as_array(words))).cast("double")).alias(f"f{i + 4}")
        for i, words in enumerate(lexicons.values())
    ]
    return third.select(
        *keep, "n_tokens", "f0", "f1", F.log1p(F.col("_size") / many).alias("f2"),
        (F.size("_kinds") / many).alias("f3"), *hits,
    )


def posteriors(rows: DataFrame, domains: DataFrame, targets: dict[str, float]) -> DataFrame:
    """`rows` with one column p_<domain> each: Gaussian naive Bayes over the features.

    Domains without labelled documents get probability zero; without any labelled
    document all are equally likely.
    """
    names = [c for c in rows.columns if c[0] == "f" and c[1:].isdigit()]
    labelled = rows.join(domains, "doc_id").groupBy("domain")
    stats = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(f"m_{c}") for c in names], *[F.var_pop(c).alias(f"v_{c}") for c in names],
    ).collect()
    if not stats:
        return rows.select("*", *[F.lit(1.0 / len(targets)).alias(f"p_{d}") for d in targets])
    total = sum(r["n"] for r in stats)
    # A feature's variance within a domain is not taken below a tenth of its pooled variance.
    pooled = {c: sum(r["n"] * r[f"v_{c}"] for r in stats) / total for c in names}
    logs = {}
    for r in stats:
        value = F.lit(math.log(r["n"] / total))
        for c in names:
            var = max(r[f"v_{c}"], 0.1 * pooled[c], 1e-6)
            value = value - (F.col(c) - r[f"m_{c}"]) ** 2 / (2 * var) - 0.5 * math.log(var)
        logs[r["domain"]] = value
    scored = rows.withColumns({f"_l_{d}": v for d, v in logs.items()})
    top = F.greatest(*[F.col(f"_l_{d}") for d in logs]) if len(logs) > 1 else F.col(f"_l_{next(iter(logs))}")
    raised = scored.withColumn("_top", top)
    raised = raised.withColumns({f"_e_{d}": F.exp(F.col(f"_l_{d}") - F.col("_top")) for d in logs})
    whole = reduce(lambda a, b: a + b, [F.col(f"_e_{d}") for d in logs])
    share = [(F.col(f"_e_{d}") / whole if d in logs else F.lit(0.0)).alias(f"p_{d}") for d in targets]
    return raised.select(*rows.columns, *share)


def fit_rates(rows: DataFrame, targets: dict[str, float], *, steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """`rows` (n_tokens, p_<domain>) with column rate, starting from one copy each.

    Target totals are the shares times all tokens. A domain that no document belongs to
    cannot be met and is left out of the fit. Without tokens every rate stays 1.
    """
    names = list(targets)
    sums = lambda df, rate: df.agg(*[F.sum(rate * F.col("n_tokens") * F.col(f"p_{d}")) for d in names]).first()
    rows = stage(rows.withColumn("rate", F.lit(1.0)))
    now = [x or 0.0 for x in sums(rows, F.col("rate"))]
    total = sum(now)
    if total <= 0:
        return rows
    mass = [x / total for x in now]
    share = sum(targets.values())
    rate = F.col("rate")
    for step in range(1, steps + 1):
        error = [x / total - targets[d] / share for x, d in zip(now, names)]
        if max(abs(e) for e, m in zip(error, mass) if m > 1e-9) <= tolerance:
            break
        push = [F.col(f"p_{d}") * (e / m) for d, e, m in zip(names, error, mass) if m > 1e-9]
        rate = F.greatest(F.lit(0.0), rate - reduce(lambda a, b: a + b, push))
        if step % STEPS_STAGED == 0:
            rows, rate = stage(rows.withColumn("rate", rate)), F.col("rate")
        now = [x or 0.0 for x in sums(rows, rate)]
    return rows.withColumn("rate", rate)


def mixing_rates(
    docs: DataFrame, labels: DataFrame, *, targets: dict[str, float] | None = None, keep: tuple[str, ...] = ("doc_id",),
    sample: int = SAMPLE, lexicon: int = LEXICON,
) -> DataFrame:
    """The kept columns, n_tokens, p_<domain> and rate of every row of `docs`.

    Null and empty texts have no tokens and the posterior of their features. Repeated rows
    are documents of their own, rows without an id are mixed but not learned from, labels
    without a domain in `targets` are ignored, further columns too.
    """
    targets = dict(targets or TARGETS)
    domains = stage(_domains(labels, targets))
    keep = tuple(dict.fromkeys(("doc_id", *keep)))
    lexicons = _lexicons(docs, domains, targets, sample, lexicon)
    rows = stage(features(docs, lexicons, list(keep)))
    soft = posteriors(rows, domains, targets)
    fitted = fit_rates(soft.select(*keep, "n_tokens", *[f"p_{d}" for d in targets]), targets)
    return fitted
