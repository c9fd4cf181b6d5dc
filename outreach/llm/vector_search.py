"""Approximate nearest neighbours by inner product: a hierarchical k-means tree searched
best bin first.

The tree is fitted on at most SAMPLE vectors; every vector is then put into the leaf that
it reaches going down to the nearest centre. A query walks the tree with a priority queue
that holds the centres seen so far by their inner product with the query, and so visits
leaves from the most promising on. How many it visits is calibrated: for a sample of the
queries the exact neighbours are found by brute force, and visits are widened until the
wanted share of them lies in visited leaves.

Equal vectors are one entry of the index, with their smallest ids: as many as a result can
hold and one more, so nothing that could be a result is lost. Neighbouring leaves share a
bin of bounded size and a larger leaf is cut into blocks; a task holds one bin or block and
streams the queries that visit any of its leaves through it, a matrix product a leaf. So a
query is sent, and answers, once a bin and not once a leaf.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from outreach.llm.common import rows_of
from outreach.sources.staging import stage

NEAREST = 20
SAMPLE = 20_000
LEAF_ROWS = 256
LEAF_SAMPLE = 8  # sampled vectors that a leaf has at least
BRANCHES = 8
RECALL = 0.97
PROBES = 128  # queries that the number of visits is calibrated with
BLOCK = 4096  # entries that a task holds at once
CHUNK = 512  # queries in a matrix product
SENT = 20_000  # rows of visits in a batch


@dataclass
class Tree:
    """Nodes by number, 0 the root; a node without children is a leaf."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: dict[int, int] = field(default_factory=dict)  # node to leaf number

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each vector, going down to the nearest centre."""
        out = np.zeros(len(vectors), dtype=np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            own = self.centres[self.children[node]]
            far = (own**2).sum(axis=1) - 2 * vectors[rows] @ own.T
            near = far.argmin(axis=1)
            waiting += [(child, rows[near == i]) for i, child in enumerate(self.children[node]) if (near == i).any()]
        return out

    def visits(self, query: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first."""
        waiting = [(0.0, 0)]
        while waiting:
            _, node = heapq.heappop(waiting)
            if not self.children[node]:
                yield self.leaf[node]
                continue
            scores = self.centres[self.children[node]] @ query
            for child, score in zip(self.children[node], scores.tolist()):
                heapq.heappush(waiting, (-score, child))


def _split(vectors: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Cluster of each vector by k-means, seeded far apart."""
    centres = [vectors[rng.integers(len(vectors))]]
    far = np.full(len(vectors), np.inf)
    for _ in range(1, BRANCHES):
        far = np.minimum(far, ((vectors - centres[-1]) ** 2).sum(axis=1))
        if far.sum() <= 0:
            break
        centres.append(vectors[rng.choice(len(vectors), p=far / far.sum())])
    own = np.array(centres)
    for _ in range(10):
        near = ((own**2).sum(axis=1) - 2 * vectors @ own.T).argmin(axis=1)
        own = np.array([vectors[near == i].mean(axis=0) if (near == i).any() else own[i] for i in range(len(own))])
    return ((own**2).sum(axis=1) - 2 * vectors @ own.T).argmin(axis=1)


def fit_tree(vectors: np.ndarray, leaf_size: int, seed: int = 7) -> Tree:
    rng = np.random.default_rng(seed)
    centres, children = [vectors.mean(axis=0)], [[]]
    tree = Tree(np.zeros(0), children)
    waiting = [(0, np.arange(len(vectors)))]
    while waiting:
        node, rows = waiting.pop()
        near = _split(vectors[rows], rng) if len(rows) > leaf_size else np.zeros(len(rows), dtype=int)
        parts = [rows[near == i] for i in np.unique(near)]
        if len(parts) < 2:
            tree.leaf[node] = len(tree.leaf)
            continue
        for part in parts:
            children.append([])
            children[node].append(len(centres))
            waiting.append((len(centres), part))
            centres.append(vectors[part].mean(axis=0))
    tree.centres = np.array(centres)
    return tree


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, key, vec: rows that take part, components as doubles, key a fingerprint.

    Left out are rows without an id and vectors that are null, empty, zero or hold null or
    non-finite components; of different lengths the one most rows have is taken (ties: the
    shorter)."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.forall("v", finite) & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "n").first()
    rows = rows.where(F.size("v") == (sizes["n"] if sizes else 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 5000):
            own = [(np.array(v) + 0.0).tobytes() for v in batch.column("v").to_pylist()]  # + 0.0: no negative zero
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array([xxhash.xxh3_128_digest(v) for v in own], pa.binary()), pa.array(own, pa.binary())],
                names=["vec_id", "key", "vec"],
            )

    return rows.mapInArrow(run, "vec_id long, key binary, vec binary")


def _as_matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.float64).reshape(len(values), -1)


def _best(
    rough: np.ndarray, queries: np.ndarray, vectors: np.ndarray, ids: list[list[int]], k: int
) -> list[list[tuple[float, int]]]:
    """Per query (-score, id) of the k best, ties to smaller ids. Products (-inf where a
    query does not look) find the candidates; their scores are summed anew, one pair like
    another."""
    edges = np.full(len(queries), -np.inf)
    if len(vectors) > k:
        edges = np.partition(rough, len(vectors) - k, axis=1)[:, len(vectors) - k]
    edges = edges - 1e-9 * (1 + np.where(np.isfinite(edges), np.abs(edges), 0))
    out = []
    for query, row, edge in zip(queries, rough, edges):
        near = np.flatnonzero((row >= edge) & (row > -np.inf))
        exact = np.einsum("ij,j->i", vectors[near], query)
        found = sorted((-s, i) for s, j in zip(exact.tolist(), near.tolist()) for i in ids[j])
        out.append(found[:k])
    return out


_CANDIDATES = "array<struct<far: double, vec_id: long>>"
_FOUND_TYPE = pa.list_(pa.struct([("far", pa.float64()), ("vec_id", pa.int64())]))


def _pairs(found: list[list[tuple[float, int]]]) -> pa.Array:
    return pa.array([[{"far": f, "vec_id": i} for f, i in own] for own in found], _FOUND_TYPE)


def _merged(parts: DataFrame, k: int) -> DataFrame:
    return parts.groupBy("key").agg(F.slice(F.sort_array(F.flatten(F.collect_list("found"))), 1, k).alias("found"))


def brute_force(queries: list[tuple[bytes, bytes]], entries: DataFrame, k: int) -> DataFrame:
    """key, found: exact neighbours of a bounded list of (key, vec) queries."""
    keys, matrix = [q[0] for q in queries], _as_matrix([q[1] for q in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, BLOCK):
            vectors = _as_matrix(batch.column("vec").to_pylist())
            found = _best(matrix @ vectors.T, matrix, vectors, batch.column("ids").to_pylist(), k)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), _pairs(found)], names=["key", "found"])

    return _merged(entries.select("vec", "ids").mapInArrow(run, f"key binary, found {_CANDIDATES}"), k)


def _placed(entries: DataFrame, tree: Tree) -> DataFrame:
    shared = entries.sparkSession.sparkContext.broadcast(tree)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, BLOCK):
            leaf = shared.value.place(_as_matrix(batch.column("vec").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), *[batch.column(c) for c in ("key", "vec", "ids")]], names=["leaf", "key", "vec", "ids"])

    return entries.select("key", "vec", "ids").mapInArrow(run, "leaf long, key binary, vec binary, ids array<long>")


def _bins(entries: dict[int, int], block: int) -> dict[int, tuple[int, int]]:
    """Bin of each leaf and the blocks that bin is cut into. Leaves with neighbouring
    numbers lie side by side in the tree; they share a bin while it holds at most `block`
    entries."""
    out, number, held = {}, -1, block
    for leaf in sorted(entries):
        if held + entries[leaf] > block:
            number, held = number + 1, 0
        held += entries[leaf]
        out[leaf] = (number, -(-entries[leaf] // block))
    return out


def _visited(
    queries: DataFrame, tree: Tree, sizes: dict[int, int], bins: dict[int, tuple[int, int]], visits: int, k: int
) -> DataFrame:
    """key, vec, bin, blocks, leaves: at least `visits` leaves and `k` candidates for each
    query, by bin."""
    shared = queries.sparkSession.sparkContext.broadcast((tree, sizes, bins))
    names, types = ["key", "vec", "bin", "blocks", "leaves"], (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, size, place = shared.value
        rows = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for key, vec in zip(batch.column("key").to_pylist(), batch.column("vec").to_pylist()):
                seen = held = 0
                by_bin: dict[tuple[int, int], list[int]] = {}
                for leaf in own.visits(np.frombuffer(vec, dtype=np.float64)):
                    if size.get(leaf, 0):
                        by_bin.setdefault(place[leaf], []).append(leaf)
                    seen, held = seen + 1, held + size.get(leaf, 0)
                    if seen >= visits and held >= k:
                        break
                rows += [(key, vec, *at, leaves) for at, leaves in by_bin.items()]
                if len(rows) >= SENT:
                    yield packed()
                    rows = []
        if rows:
            yield packed()

    return queries.mapInArrow(run, "key binary, vec binary, bin long, blocks long, leaves array<long>")


def _scan(k: int):
    """Vectors of a bin come first, by leaf, and are held; its queries stream through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, vecs, ids, spans, matrix = None, [], [], {}, None
        for batch in rows_of(batches, CHUNK):
            columns = [batch.column(c).to_pylist() for c in ("bin", "block", "asks", "leaf", "key", "vec", "ids", "leaves")]
            waiting: list[tuple[bytes, bytes, list[int]]] = []

            def answer() -> Iterator[pa.RecordBatch]:
                nonlocal matrix
                if waiting and vecs:
                    matrix = _as_matrix(vecs) if matrix is None else matrix
                    queries = _as_matrix([w[1] for w in waiting])
                    by_leaf: dict[int, list[int]] = {}
                    for i, (_, _, leaves) in enumerate(waiting):
                        for leaf in leaves:
                            by_leaf.setdefault(leaf, []).append(i)
                    rough = np.full((len(queries), len(vecs)), -np.inf)
                    for leaf, asking in by_leaf.items():
                        if leaf in spans:  # a block need not hold rows of the leaf
                            start, stop = spans[leaf]
                            rough[asking, start:stop] = queries[asking] @ matrix[start:stop].T
                    found = _best(rough, queries, matrix, ids, k)
                    yield pa.RecordBatch.from_arrays([pa.array([w[0] for w in waiting], pa.binary()), _pairs(found)], names=["key", "found"])
                waiting.clear()

            for number, block, asks, leaf, key, vec, own, leaves in zip(*columns):
                if (number, block) != place:
                    yield from answer()
                    place, vecs, ids, spans, matrix = (number, block), [], [], {}, None
                if asks:
                    waiting.append((key, vec, leaves))
                else:
                    spans[leaf] = (spans.get(leaf, (len(vecs),))[0], len(vecs) + 1)
                    vecs.append(vec)
                    ids.append(own)
            yield from answer()

    return run


def nearest(
    vectors: DataFrame, asks: Column, *, k: int = NEAREST, recall: float = RECALL, sample: int = SAMPLE,
    leaf_rows: int = LEAF_ROWS, probes: int = PROBES, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the `k` nearest found of each row for which `asks`
    holds (of the columns of `vectors`), all other rows being candidates.

    `vectors` needs vec_id and embedding. Rows that `usable` leaves out take no part.
    Rows that repeat an id and a vector count once. Equal scores go by id. With fewer
    than `k` candidates all are returned; without any, or without vectors, nothing is.
    """
    rows = stage(usable(vectors).distinct())
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("_n") <= k + 1)
    entries = stage(ranked.groupBy("key").agg(F.first("vec").alias("vec"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    wanted = vectors.where(asks).select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    asking = stage(rows.join(wanted, "vec_id").select(F.col("vec_id").alias("query_id"), "key", "vec"))
    queries = stage(asking.dropDuplicates(["key"]).select("key", "vec"))
    count = entries.count()
    # Fingerprints are as good as random, so the smallest are a fair sample.
    picked = [r[0] for r in entries.orderBy("key").select("vec").limit(sample).collect()]
    if not picked:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(_as_matrix(picked), max(LEAF_SAMPLE, leaf_rows * len(picked) // count))
    index = stage(_placed(entries, tree))
    leaves = index.groupBy("leaf").agg(F.sum(F.size("ids")), F.count(F.lit(1))).collect()  # one row per leaf
    sizes, bins = {r[0]: r[1] for r in leaves}, _bins({r[0]: r[2] for r in leaves}, block)
    visits = _calibrated(queries, index, tree, k, recall, probes)
    session = vectors.sparkSession
    places = session.createDataFrame([(leaf, *at) for leaf, at in bins.items()], "leaf long, bin long, blocks long")
    held = index.join(F.broadcast(places), "leaf")  # one row per leaf
    held = held.select(
        "bin", F.pmod(F.xxhash64("key"), "blocks").alias("block"), F.lit(False).alias("asks"), "leaf", "key", "vec", "ids",
        F.lit(None).cast("array<long>").alias("leaves"),
    )
    asked = _visited(queries, tree, sizes, bins, visits, k + 1)
    asked = asked.select(
        "bin", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(True).alias("asks"),
        F.lit(None).cast("long").alias("leaf"), "key", "vec", F.lit(None).cast("array<long>").alias("ids"), "leaves",
    )
    dealt = held.unionByName(asked).repartition(F.col("bin"), F.col("block")).sortWithinPartitions("bin", "block", "asks", "leaf")
    best = _merged(dealt.mapInArrow(_scan(k + 1), f"key binary, found {_CANDIDATES}"), k + 1)
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = asking.select("query_id", "key").join(best, "key").select("query_id", F.posexplode(others).alias("at", "hit"))
    return out.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.far")).alias("score")
    )


def _calibrated(queries: DataFrame, index: DataFrame, tree: Tree, k: int, recall: float, probes: int) -> int:
    """Leaves to visit so that `recall` of the probes' exact neighbours lie in them."""
    picked = [(r[0], r[1]) for r in queries.orderBy("key").limit(probes).collect()]
    if not picked:
        return 1
    exact = stage(brute_force(picked, index, k + 1))
    hits = exact.select("key", F.explode("found.vec_id").alias("vec_id"))
    where = index.select("leaf", F.explode("ids").alias("vec_id"))
    leaves = {}
    for key, leaf in hits.join(where, "vec_id").select("key", "leaf").collect():  # probes * (k + 1) rows
        leaves.setdefault(bytes(key), []).append(leaf)
    ranks = []
    for key, vec in picked:
        order = {leaf: i for i, leaf in enumerate(tree.visits(np.frombuffer(vec, dtype=np.float64)), start=1)}
        ranks += [order[leaf] for leaf in leaves.get(bytes(key), [])]
    return int(np.quantile(ranks, recall, method="higher")) if ranks else 1
