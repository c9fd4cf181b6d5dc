"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased, so case and punctuation edits do not
matter. One pass over the corpus notes which documents hold which seed (an n-gram of an
item). A seed is rare if it lies in at most RARE times as many documents as the lower
quartile of its own item's seeds. Documents joined to an item by a rare seed are aligned
with it: the whole document against the whole item, word by word. The score counts +2 for
an equal word, -1 for a changed, extra or missing one; the share is the score divided by
that of a perfect copy.

A document that holds only common seeds of an item, a single one being enough, is aligned
with it too, unless a bound on the score, which no alignment exceeds, stays below what is
asked for. So the frequency of a passage decides about the work, never about the result.

The benchmark goes to the tasks in blocks of at most BLOCK items of bounded length, so its
size has no limit.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import Hashes, rows_of, shingles
from outreach.sources.staging import stage

SEED = 3
RARE = 8
SHARE = 0.5
MATCH, OTHER = 2, 1
BLOCK_BYTES = 16 << 20  # of benchmark text in one block; a longer item is a block of its own

_PUNCTUATION = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def plain_words(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII punctuation separates them, other characters belong to them."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_PUNCTUATION).split() if text else []


def best_end(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Score of the best local alignment and where it ends (exclusive) in doc and item."""
    width = len(doc)
    if not width or not len(item):
        return 0, 0, 0
    at = np.arange(width + 1, dtype=np.int32) * OTHER
    above = np.zeros(width + 1, dtype=np.int32)
    best, doc_end, item_end = 0, 0, 0
    for i, word in enumerate(item, start=1):
        row = np.zeros(width + 1, dtype=np.int32)
        row[1:] = above[:-1] + np.where(doc == word, MATCH, -OTHER)
        np.maximum(row, above - OTHER, out=row)
        np.maximum(row, 0, out=row)
        # A run of extra words costs OTHER each: the best start so far, less the distance.
        row = np.maximum.accumulate(row + at) - at
        j = int(row.argmax())
        if row[j] > best:
            best, doc_end, item_end = int(row[j]), j, i
        above = row
    return best, doc_end, item_end


def align(doc: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Score, first and last (exclusive) document word of the best local alignment; of
    equal ones that which ends first in the item, then in the document."""
    score, end, item_end = best_end(doc, item)
    if not score:
        return 0, 0, 0
    _, back, _ = best_end(doc[:end][::-1], item[:item_end][::-1])
    return score, end - back, end


def may_reach(doc: np.ndarray, words: np.ndarray, length: int, need: float) -> bool:
    """False if no alignment of `doc` with an item of `length` words, `words` its sorted
    distinct ones, scores `need`. A document word that the item lacks costs OTHER wherever
    an alignment spans it, any other gains MATCH at the most; and with `length` matches at
    the most an alignment that scores `need` spans a bounded number of document words."""
    known = words[np.minimum(np.searchsorted(words, doc), len(words) - 1)] == doc
    score = np.concatenate([[0], np.cumsum(np.where(known, MATCH, -OTHER))])
    if (score - np.minimum.accumulate(score)).max() < need:
        return False
    span = max(1, length + int((MATCH * length - need) // OTHER))
    held = np.concatenate([[0], np.cumsum(known)])
    most = (held[span:] - held[:-span]).max() if span < len(held) else held[-1]
    return MATCH * min(most, length) >= need


def _item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Distinct items with words, a bounded block at a time."""
    items = benchmark.where(F.col("item_id").isNotNull() & (F.length("text") > 0))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-2 * total // BLOCK_BYTES))
    if parts > 1:
        items = stage(items.withColumn("_part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))))
    for part in range(parts):
        own = items.where(F.col("_part") == part).drop("_part") if parts > 1 else items
        yield [tuple(r) for r in own.orderBy("item_id", "text").collect()]


def _holds(grams: np.ndarray, n: int):
    """doc_id, gram: which of the sorted `grams` each document holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        mask = np.zeros(1 << 20, dtype=bool)
        mask[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        for batch in rows_of(batches, 1000):
            ids, found = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tokens = plain_words(text)
                if len(tokens) < n:
                    continue
                own = shingles(hashes.of(tokens), n)
                own = own[mask[(own & np.uint64((1 << 20) - 1)).astype(np.int64)]]
                if not len(own):
                    continue
                own = np.unique(own)
                at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                at = at[grams[at] == own]
                ids += [doc_id] * len(at)
                found.append(at)
            if ids:
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "gram": pa.array(np.concatenate(found), pa.int64())})

    return run


def _align_all(items: list[tuple[int, np.ndarray]], share: float):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.int64()), ("share", pa.float64()),
                        ("first_word", pa.int64()), ("end_word", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        words: dict[int, np.ndarray] = {}
        for batch in rows_of(batches, 200):
            out = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "items", "others")]
            for doc_id, text, wanted, others in zip(*columns):
                doc = hashes.of(plain_words(text))
                certain = set(wanted)
                for k in [*wanted, *(k for k in others if k not in certain)]:
                    item_id, own = items[k]
                    if k not in certain:
                        if k not in words:
                            words[k] = np.unique(own)
                        if not may_reach(doc, words[k], len(own), share * MATCH * len(own)):
                            continue
                    score, first, end = align(doc, own)
                    if score >= share * MATCH * len(own):
                        out.append((doc_id, item_id, score, score / (MATCH * len(own)), first, end))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


_FOUND = "doc_id long, item_id long, score long, share double, first_word long, end_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, *, n: int = SEED, rare: float = RARE, share: float = SHARE) -> DataFrame:
    """doc_id, item_id, score, share, first_word, end_word of each copy found: at most one
    row per document and item, the best alignment, where its share reaches `share`.

    Null and empty texts hold no copies; items without text, or with fewer than `n` words,
    have no seed and find nothing. A copy is found if it holds `n` words in a row of its
    item, however many documents hold them; `rare` bears on the work alone. Rows without an id are not searched. Rows that repeat a
    doc_id or item_id count as one, with the best alignment of any of them (ties: the
    earliest span). An empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    parts = []
    for block in _item_blocks(benchmark):
        hashes = Hashes()
        items = [(item_id, hashes.of(plain_words(text))) for item_id, text in block]
        items = [(item_id, own) for item_id, own in items if len(own) >= n]
        if not items:
            continue
        seeds = [np.unique(shingles(own, n)) for _, own in items]
        grams = np.unique(np.concatenate(seeds))
        held = stage(texts.mapInArrow(_holds(grams, n), "doc_id long, gram long"))
        counts = np.zeros(len(grams), dtype=np.int64)
        for gram, count in held.groupBy("gram").agg(F.count(F.lit(1))).collect():  # bounded by the block
            counts[gram] = count
        items_of = defaultdict(list)
        for k, own in enumerate(seeds):
            at = np.searchsorted(grams, own)
            is_rare = counts[at] <= rare * max(1, np.quantile(counts[at], 0.25, method="lower"))
            for gram, first in zip(at.tolist(), is_rare.tolist()):
                if counts[gram]:
                    items_of[gram].append((k, first))
        pairs = spark.createDataFrame(sorted(items_of.items()), "gram long, ks array<struct<k: int, rare: boolean>>")
        # Bounded by the block, like the items that the tasks align with.
        joined = held.join(F.broadcast(pairs), "gram").select("doc_id", F.inline("ks"))
        first, other = (F.sort_array(F.collect_set(F.when(F.col("rare") == is_rare, F.col("k")))) for is_rare in (True, False))
        wanted = joined.groupBy("doc_id").agg(first.alias("items"), other.alias("others"))
        near = texts.join(wanted, "doc_id")
        parts.append(near.mapInArrow(_align_all(items, share), _FOUND))
    if not parts:
        return spark.createDataFrame([], _FOUND)
    found = parts[0]
    for more in parts[1:]:
        found = found.unionAll(more)
    best = F.max_by(F.struct("score", "share", "first_word", "end_word"), F.struct("share", -F.col("first_word"), -F.col("end_word")))
    return found.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that hold no copy of an item, unchanged."""
    hit = stage(contaminated(docs, benchmark, **options).select(F.col("doc_id").alias("_hit")).distinct())
    return docs.join(hit, docs["doc_id"] == hit["_hit"], "left_anti")
