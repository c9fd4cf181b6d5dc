"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has a bit set where over half of the hashes of its word shingles,
repeats included, have it set. Documents whose fingerprints differ in few bits are linked.

How it runs: rows with equal fingerprints are one node. The fingerprint is cut into
SEGMENTS; of two that differ in at most `bits` places, one segment lies in a small Hamming
ball around the other's (`radii`). Each node is entered in one table per segment under the
segment's value, and probes the values of the ball around it; of two values in each other's
balls only the smaller one probes, so a pair meets once per segment. A table's cell is
checked in a task: complete distances, links merged as they are found, and only the links
of a tree over what they join leave it, so a family of copies costs its size and not its
pairs. Cells of more than CELL entries are dealt to pairs of blocks: no task ever holds
more than two blocks, and no pair is left out.

With 3 segments a cell holds about one fingerprint in two million, so candidates stay in
the thousands per fingerprint for 10**10 different ones; the tables send some 24 narrow
rows per different fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import raw_column, rows_of
from outreach.llm.near_dedup import components
from outreach.sources.staging import stage

WORDS = 4
BITS = 4
SEED = 42
WIDTH = 64
SEGMENTS = 3
CELL = 1 << 15  # entries of a cell that a task compares with each other, or block with block
_AT_ONCE = 1 << 14  # shingles whose bits are counted at a time
_FAN = 16  # links of a node in the tree that leaves a cell


def fingerprint(raw: bytes | None, n: int = WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles; zero without words. Words are
    lower-cased in A-Z and split at space and control white space, which is what `bytes`
    does; a shorter text is one shingle."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    n = min(n, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - n + 1].tolist()
    stops = ends[n - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    ones = np.zeros(WIDTH, dtype=np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        spans = zip(starts[at : at + _AT_ONCE], stops[at : at + _AT_ONCE])
        h = np.array([hashed(line[a:b], seed) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 1000):
            found = np.array([fingerprint(raw, n, seed) for raw in raw_column(batch, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def radii(bits: int, segments: int) -> list[int]:
    """Of each segment the radius of its ball: when all segments differ in more bits than
    theirs, the whole differs in more than `bits`. -1: the segment need not be searched."""
    least, more = divmod(bits, segments)
    return [least] * (more + 1) + [least - 1] * (segments - more - 1)


def entries(nodes: DataFrame, bits: int, segments: int) -> DataFrame:
    """cell, fp, own: the table cells of each fingerprint, its own (true) and those of its
    balls with a larger value (false). A cell is a segment's number and value."""
    widths = [WIDTH // segments + (i < WIDTH % segments) for i in range(segments)]
    lows = [sum(widths[:i]) for i in range(segments)]
    found = [_cells_of(i, lows[i], widths[i], radius) for i, radius in enumerate(radii(bits, segments)) if radius >= 0]
    return nodes.select("fp", F.inline(F.concat(*found))).select("cell", "fp", "own")


def _cells_of(number: int, low: int, width: int, radius: int) -> Column:
    """Cells of the segment of `width` bits from bit `low`: its own and its ball's."""
    value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
    cell = lambda v, own: F.struct(v.bitwiseOR(F.lit(number << 32)).alias("cell"), F.lit(own).alias("own"))
    masks = [sum(1 << b for b in on) for k in range(1, radius + 1) for on in combinations(range(width), k)]
    if not masks:
        return F.array(cell(value, True))
    ball = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: value.bitwiseXOR(m))
    larger = F.filter(ball, lambda x: x > value)
    return F.concat(F.array(cell(value, True)), F.transform(larger, lambda x: cell(x, False)))


def dealt(found: DataFrame, most: int) -> DataFrame:
    """Entries with the pair of blocks (x, y), x <= y, in which they are compared: (0, 0) in
    a cell of up to `most` entries."""
    sizes = found.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    large = stage(sizes.where(F.col("size") > most).select("cell", F.ceil(F.col("size") / most).alias("blocks")))
    told = found.join(large, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    own_block = F.pmod(F.xxhash64("fp"), "blocks")
    paired = told.withColumn("_mine", own_block).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return paired.select("cell", F.least("_mine", "_other").alias("x"), F.greatest("_mine", "_other").alias("y"), "fp", "own")


def joined(fps: np.ndarray, own: np.ndarray, bits: int) -> np.ndarray:
    """For each of the fingerprints of a cell, the own ones of it first, the number of the
    first fingerprint it is joined to by links; one end of a link is an own one."""
    top = np.arange(len(fps))
    n_own = int(own.sum())
    for i in range(n_own):
        # Compared with what stands behind it and isn't joined to it yet.
        rest = np.flatnonzero(top[i + 1 :] != top[i]) + i + 1
        near = rest[np.bitwise_count(fps[rest] ^ fps[i]) <= bits]
        if len(near):
            tops = np.unique(np.append(top[near], top[i]))
            top[np.isin(top, tops)] = tops[0]
    return top


def tree(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that hold the members together, without a node of many links."""
    child = np.arange(1, len(members))
    return members[child], members[(child - 1) // _FAN]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _check(bits: int):
    def links_of(fps: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        order = np.argsort(~own, kind="stable")
        fps, own = fps[order], own[order]
        top = joined(fps.view(np.uint64), own, bits)
        groups, sizes = np.unique(top, return_counts=True)
        for g in groups[sizes > 1]:
            yield tree(np.unique(fps[top == g]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "x", "y", "fp", "own")]
            if kept is not None:
                columns = [np.concatenate(pair) for pair in zip(kept, columns)]
            yield from _cells(columns, False)
            kept = _last(columns)
        if kept is not None:
            yield from _cells(kept, True)

    def _edges(columns: list[np.ndarray]) -> np.ndarray:
        cell, x, y = columns[:3]
        new = (np.diff(cell) != 0) | (np.diff(x) != 0) | (np.diff(y) != 0)
        return np.concatenate([[0], np.flatnonzero(new) + 1, [len(cell)]])

    def _last(columns: list[np.ndarray]) -> list[np.ndarray]:
        return [c[_edges(columns)[-2] :] for c in columns] if len(columns[0]) else columns

    def _cells(columns: list[np.ndarray], whole: bool) -> Iterator[pa.RecordBatch]:
        if not len(columns[0]):
            return
        edges = _edges(columns)
        spans = list(zip(edges, edges[1:])) if whole else list(zip(edges[:-1], edges[1:-1]))
        fps, own = columns[3], columns[4].astype(bool)
        found = [t for a, b in spans if b - a > 1 and own[a:b].any() for t in links_of(fps[a:b], own[a:b])]
        if found:
            a, b = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_LINKS)

    return run


def links(nodes: DataFrame, bits: int = BITS, segments: int = SEGMENTS, most: int = CELL) -> DataFrame:
    """Pairs (a, b) of fingerprints that hold every component of the linked ones together."""
    found = stage(entries(nodes.select("fp"), bits, segments))
    keys = ["cell", "x", "y"]
    grouped = dealt(found, most).repartition(*keys).sortWithinPartitions(*keys)
    return stage(grouped.mapInArrow(_check(bits), "a long, b long").distinct())


def near_duplicates(
    docs: DataFrame, *, n: int = WORDS, bits: int = BITS, seed: int = SEED, segments: int = SEGMENTS, most: int = CELL
) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links reach. Null texts and texts without words
    have fingerprint zero and are linked like others. Rows that repeat a doc_id stand for
    their own texts each. Rows without a doc_id get a fingerprint, are linked with nothing
    and have component_id null. Other columns are ignored; an empty table gives none.
    """
    rows = stage(fingerprints(docs, n, seed))
    nodes = stage(rows.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("least")))
    label = components(links(nodes, bits, segments, most))
    grouped = nodes.join(label, nodes["fp"] == label["node"], "left").select("fp", "least", F.coalesce("label", "fp").alias("part"))
    lowest = grouped.groupBy("part").agg(F.min("least").alias("component_id"))
    told = stage(grouped.join(lowest, "part").select("fp", "component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    with_id = rows.where(F.col("doc_id").isNotNull()).join(told, "fp").select("doc_id", hexed, "component_id")
    without = rows.where(F.col("doc_id").isNull()).select("doc_id", hexed, F.lit(None).cast("long").alias("component_id"))
    return with_id.unionByName(without)
