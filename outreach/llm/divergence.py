"""Source divergence audit: how far each source's word use lies from the other sources of
its language and from the language as a whole, in exact integers.

A group is a (language, source) pair. A term's price in a group or language is
p = 1 + floor(SCALE * (count + 1) / (N + V)), with V kept terms and N their occurrences
there, so it depends on the term's count only. The divergence of p from q is
floor((p - q)**2 / q), summed over all kept terms.

How it runs: tokens are counted inside each task, so one row per (group, term) and flush is
shuffled, whatever a word's frequency. For two groups the sum over all terms needs only
their joint table: how many terms have count a in one and count b in the other. Terms are
taken in blocks of like frequency; a block is a matrix with a row per term and an indicator
column per (group, count level) that occurs in it, and the product of its transpose with
itself holds the block's joint tables of all pairs of groups at once. Products of ones and
zeros are exact, blocks and pieces of the columns bound the memory, and cells are priced as
they are made, so what leaves a task is a row per pair of groups. Level zero, which nearly
every term has in nearly every group, gets no column: its part of a joint table is what the
margins leave over (`_margins`), so the work follows the occurrences and not terms x groups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outreach.llm.common import rows_of
from outreach.sources.staging import stage

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP = 200
ENTRIES = 200_000  # counts that a task holds before it sends them on
ROWS, COLUMNS = 4096, 2048  # of a block of indicators
PIECE = 1024  # columns multiplied with as many at a time
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_CHUNK = 1 << 20


def terms(raw: bytes) -> Iterator[list[bytes]]:
    """Runs of letters A-Z, in lower case, and of characters beyond ASCII, in pieces of about
    a megabyte, cut between terms."""
    at = 0
    while at < len(raw):
        end = min(at + _CHUNK, len(raw))
        while end < len(raw) and _SPLIT[raw[end]] != 32:
            end += 1
        yield raw[at:end].translate(_SPLIT).split()
        at = end


_COUNTED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _count(entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in seen.items():
                names = [None, *(t.decode(errors="replace") for t in n)]  # null: the group exists
                columns = [[lang] * len(names), [source] * len(names), names, [0, *n.values()], [0, *(docs[t] for t in n)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _COUNTED)], schema=_COUNTED)
            seen.clear()

        for batch in rows_of(batches, 1000):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for lang, source, raw in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                own: Counter = Counter()
                for piece in terms(raw):
                    own.update(piece)
                n, docs = seen.setdefault((lang, source), (Counter(), Counter()))
                held -= len(n)
                for term, times in own.items():
                    n[term] += times
                    docs[term] += 1
                held += len(n)
                if held > entries:
                    yield from flushed()
                    held = 0
        yield from flushed()

    return run


def counted_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Counts and groups: (lang, source, term, n, in_lang) for the terms that at least
    `least_docs` documents of the language hold, and (lang, source) of every row."""
    empty = F.lit("")
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), empty).alias(c) for c in ("lang", "source", "text")])
    raw = rows.mapInArrow(_count(ENTRIES), "lang string, source string, term string, n long, docs long")
    # One exchange serves the counts per group and per language: both are clustered by it.
    dealt = raw.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    sums = dealt.withColumns({"in_lang": F.sum("n").over(whole), "_docs": F.sum("docs").over(whole)})
    found = stage(sums.where((F.col("_docs") >= least_docs) | F.col("term").isNull()).drop("_docs", "docs"))
    groups = found.where(F.col("term").isNull()).select("lang", "source")
    return found.where(F.col("term").isNotNull()), groups


def price(count: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kinds)), without overflow."""
    up = (count + 1).cast("decimal(20,0)") * F.lit(Decimal(SCALE))
    return F.call_function("div", up, (total + kinds).cast("decimal(20,0)")) + F.lit(1).cast("long")


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def joint_value(own: np.ndarray, rows: np.ndarray, group: np.ndarray, p: np.ndarray, zero: np.ndarray, n_rows: int) -> Iterator[tuple]:
    """Sums over a block's joint tables: (group A, group B, value) for A and B both with
    occurrences. `rows` and `own` are the term and the column of each entry; a column has
    its group, the price p of its level and the price `zero` of level zero in its group.
    A cell is priced beyond what the margins already count for its levels."""
    shape = (n_rows, len(group))
    x = np.zeros(shape, dtype=np.float32)  # exact: no product exceeds ROWS
    x[rows, own] = 1
    for i in range(0, shape[1], PIECE):
        left = x[:, i : i + PIECE].T
        for j in range(0, shape[1], PIECE):
            joint = left @ x[:, j : j + PIECE]
            a, b = np.nonzero(joint)
            n = joint[a, b].astype(np.int64)
            a, b = a + i, b + j
            other = group[a] != group[b]
            a, b, n = a[other], b[other], n[other]
            f = lambda s, t: (s - t) * (s - t) // t
            beyond = n * (f(p[a], p[b]) - f(p[a], zero[b]) - f(zero[a], p[b]) + f(zero[a], zero[b]))
            order = np.lexsort((group[b], group[a]))
            ga, gb, beyond = group[a][order], group[b][order], beyond[order]
            starts = np.flatnonzero((np.diff(ga, prepend=-1) != 0) | (np.diff(gb, prepend=-1) != 0))
            if len(starts):
                yield from zip(ga[starts].tolist(), gb[starts].tolist(), np.add.reduceat(beyond, starts).tolist())


_VALUES = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.decimal128(38, 0))])


def _products(most_rows: int, most_columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang: str | None = None
        term: str | None = None
        names: dict[str, int] = {}  # sources of the language by number
        columns: dict[tuple[int, int], int] = {}  # (group, price) by number
        zeros: dict[int, int] = {}
        rows: list[int] = []
        own: list[int] = []
        n_rows = 0
        sums: dict[tuple[int, int], int] = {}

        def close() -> None:
            nonlocal n_rows
            if n_rows:
                group, p = (np.array(v, dtype=np.int64) for v in zip(*columns))
                zero = np.array([zeros[g] for g in group.tolist()], dtype=np.int64)
                for a, b, value in joint_value(np.array(own), np.array(rows), group, p, zero, n_rows):
                    sums[a, b] = sums.get((a, b), 0) + value
            columns.clear(), rows.clear(), own.clear()
            n_rows = 0

        def told() -> Iterator[pa.RecordBatch]:
            close()
            by_number = list(names)
            pairs = list(sums.items())
            for at in range(0, len(pairs), 10_000):
                part = pairs[at : at + 10_000]
                made = [[lang] * len(part), [by_number[a] for (a, _), _ in part], [by_number[b] for (_, b), _ in part], [Decimal(v) for _, v in part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, _VALUES)], schema=_VALUES)
            names.clear(), zeros.clear(), sums.clear()

        for batch in batches:
            for own_lang, own_term, source, p, zero in zip(*[batch.column(c).to_pylist() for c in ("lang", "term", "source", "p", "zero")]):
                if own_lang != lang:
                    yield from told()
                    lang, term = own_lang, None
                if own_term != term:
                    if n_rows >= most_rows or len(columns) >= most_columns:
                        close()
                    term, n_rows = own_term, n_rows + 1
                group = names.setdefault(source, len(names))
                zeros[group] = zero
                rows.append(n_rows - 1)
                own.append(columns.setdefault((group, p), len(columns)))
        yield from told()

    return run


def _margins(priced: DataFrame, totals: DataFrame) -> DataFrame:
    """Part of the value of each pair of groups (lang, source, item) that does not need
    their joint table: all terms at level zero in both, then, by level, the terms of one
    group against level zero of the other, beyond what they were counted for."""
    other = totals.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"))
    pairs = totals.join(other, "lang").where(F.col("source") != F.col("item"))
    wide = "decimal(38,0)"
    base = pairs.select("lang", "source", "item", (F.col("kinds").cast("decimal(19,0)") * divergence(F.col("zero"), F.col("other_zero")).cast("decimal(19,0)")).cast(wide).alias("value"))
    levels = stage(priced.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("n_terms")))
    met = levels.join(other, "lang").where(F.col("source") != F.col("item"))
    p, zero, q = F.col("p"), F.col("zero"), F.col("other_zero")
    own = divergence(p, q) - divergence(zero, q)
    turned = divergence(q, p) - divergence(q, zero)
    value = lambda d: F.sum((F.col("n_terms").cast("decimal(19,0)") * d.cast("decimal(19,0)")).cast(wide)).alias("value")
    both = met.groupBy("lang", "source", "item").agg(value(own), value(turned).alias("turned"))
    forward = both.select("lang", "source", "item", "value")
    backward = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("turned").alias("value"))
    return base.unionByName(forward).unionByName(backward)


def audit(docs: DataFrame, *, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) for each group of `docs` (text, lang,
    source).

    Part `pair`: the divergence of the group's prices from those of each other source of its
    language, over all kept terms; 0 in a language without any. Part `term`: the terms that
    the group uses more than its language does, with their divergence from the language's
    price, up to rank `top`. Ranks go by value, largest first, then item in UTF-8 order.

    Null text, lang and source count as empty strings; a row with an empty text still makes
    its group occur. Repeated rows count as often as they occur. Other columns, whatever
    their names, are ignored; an empty table gives none.
    """
    counts, groups = counted_terms(docs, least_docs)
    kinds = counts.select("lang", "term", "in_lang").distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("in_lang").alias("lang_total")
    )
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    known = groups.join(sums, ["lang", "source"], "left").join(kinds, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kinds", "lang_total")]
    )
    # Without kept terms nothing is priced; the divisor only has to be positive.
    divisor = F.greatest(F.col("kinds"), F.lit(1).cast("long"))
    totals = stage(known.withColumn("zero", price(zero, F.col("total"), divisor)))
    told = counts.join(totals, ["lang", "source"])
    priced = stage(told.select(
        "lang", "source", "term", "in_lang", price(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
        price(F.col("in_lang"), F.col("lang_total"), F.col("kinds")).alias("q"), "zero",
    ))
    more = priced.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    by_term = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    dealt = priced.repartition("lang", "term").sortWithinPartitions("lang", "in_lang", "term")
    joint = dealt.select("lang", "term", "source", "p", "zero").mapInArrow(
        _products(ROWS, COLUMNS), "lang string, source string, item string, value decimal(38,0)"
    )
    values = joint.unionByName(_margins(priced, totals)).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    by_pair = values.withColumn("rank", F.row_number().over(order))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return by_pair.withColumn("part", F.lit("pair")).select(*columns).unionByName(by_term.withColumn("part", F.lit("term")).select(*columns))
