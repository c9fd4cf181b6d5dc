"""MinHash near-duplicates by a signature-coordinate inverted join.

A document is the set of its distinct word shingles. Documents with equal sets are one
node. Each node gets a MinHash signature, and is posted under every (coordinate, value)
pair. Two nodes with the wanted similarity agree on at least `shared` of the posted coordinates
except with the probability stated at `COORDINATES`, so

* values that only one node has are dropped, and with them nodes that keep too few;
* of the values left, ordered by how rare they are, a node needs posting only under the
  first n - shared + 1 (the prefix): two nodes that agree on `shared` values have one there;
* lists are read by skipping: members already joined to each other are not paired again.
  First every member of a list is paired with one member (a star, linear in the list);
  links that hold contract their ends, and only lists with members of several components
  go to the next round, with another centre. After the last star, members of different
  components that still share a list are merged in a task that holds a bounded block of
  the list, and only links that join components leave it.

Each pair's collisions are counted on whole signatures, and a pair that reaches `matches`
is confirmed on the full shingle sets. No group's pairs are all made, and nothing but
counts and loop sizes reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import Hashes, raw_column, rows_of, shingles, words
from outreach.sources.staging import stage

WORDS = 5
PERCENT = 75
# Each coordinate of two similar sets agrees with probability 0.75 or more. Of the 64 that
# are posted fewer than 30 agree with probability 4e-7, of all 128 fewer than 72 with
# probability 2e-6; such a link would be missed.
COORDINATES = 128
POSTED = 64
SHARED = 30
MATCHES = 72
STARS = 2
BLOCK = 1024  # members of a list compared in one task at a time, against as many

_ODD = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)
_STRIDE = 512
_SMALL = 1_000_000  # rows of two longs up to which an id list is broadcast; joined by shuffle beyond


def _coordinates(count: int) -> np.ndarray:
    seeds = [xxhash.xxh3_64_intdigest(i.to_bytes(4, "little")) for i in range(count)]
    return np.array(seeds, dtype=np.uint64)


def signature(hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Smallest value of each seeded hash function over a shingle set, as 32 bits."""
    out = np.full(len(seeds), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), _STRIDE):
        mixed = hashes[None, at : at + _STRIDE] ^ seeds[:, None]
        mixed *= _ODD
        np.minimum(out, mixed.min(axis=1), out=out)
    return (out >> _HALF).astype(np.uint32)


def _sets(batch: pa.RecordBatch, n: int, hashes: Hashes) -> Iterator[np.ndarray]:
    for raw in raw_column(batch, "text"):
        yield np.unique(shingles(hashes.of(words(raw)), n))


def _key(own: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


def signatures(docs: DataFrame, n: int = WORDS, count: int = COORDINATES, posted: int = POSTED) -> DataFrame:
    """doc_id, n_shingles, set_key (128-bit fingerprint of the set), sig (the posted
    coordinates) and low (the low byte of each coordinate) per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seeds = Hashes(), _coordinates(count)
        for batch in rows_of(batches, 1000):
            own = list(_sets(batch, n, hashes))
            sigs = [signature(s, seeds) if len(s) else None for s in own]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in own], pa.int64()),
                    pa.array([_key(s) for s in own], pa.binary()),
                    pa.array([s if s is None else s[:posted].view(np.int32) for s in sigs], pa.list_(pa.int32())),
                    pa.array([s if s is None else s.astype(np.uint8).tobytes() for s in sigs], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_key", "sig", "low"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, sig array<int>, low binary")


def shingle_sets(docs: DataFrame, n: int = WORDS) -> DataFrame:
    """set_key, own: the sorted shingle hashes of each document, eight bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in rows_of(batches, 500):
            own = list(_sets(batch, n, hashes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_key(s) for s in own], pa.binary()),
                 pa.array([s.tobytes() for s in own], pa.binary())],
                names=["doc_id", "set_key", "own"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, set_key binary, own binary")


def prefixes(nodes: DataFrame, shared_at: int) -> DataFrame:
    """node, token: postings under the rarest values that a node shares."""
    posted = nodes.select("node", F.posexplode("sig").alias("at", "value")).select(
        "node", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value").cast("long")).alias("token")
    )
    shared = posted.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    live = posted.join(shared, "token")
    ordered = live.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("size", "token"))).alias("own"))
    kept = F.slice("own", F.lit(1), F.size("own") - (shared_at - 1))
    enough = ordered.where(F.size("own") >= shared_at)
    return enough.select("node", F.explode(kept).alias("p")).select("node", "p.token")


def components(edges: DataFrame) -> DataFrame:
    """node, label: smallest node reachable, for the nodes of `edges` (a, b).

    Each round a node takes the smallest label among its neighbours' and its own, then the
    label of that label, until nothing changes.
    """
    both = stage(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")
        )
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("further"))
        moved = stage(
            lower.join(jump, lower["label"] == jump["via"], "left").select(
                "node", "was", F.least("label", F.coalesce("further", "label")).alias("label")
            )
        )
        done = moved.where("label <> was").isEmpty()
        labels = moved.select("node", "label")
        if done:
            return labels


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_sets, b_sets = batch.column("a_own").to_pylist(), batch.column("b_own").to_pylist()
            keep = []
            for a, b in zip(a_sets, b_sets):
                x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
                small, large = sorted((len(x), len(y)))
                if 100 * small < percent * large:
                    keep.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (small + large - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _small(df: DataFrame) -> DataFrame:
    """A staged id list, broadcast if it is counted to be small."""
    return F.broadcast(df) if df.count() <= _SMALL else df


def node_sets(nodes: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """node, own: the full shingle set of each node, from the texts."""
    wanted = stage(nodes.select(F.col("node").alias("doc_id"), "set_key"))
    ids = _small(stage(wanted.select("doc_id").distinct()))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id")
    # Rows that repeat an id are told apart by the fingerprint of their set.
    sets = shingle_sets(texts, n).join(_small(wanted), ["doc_id", "set_key"], "left_semi")
    return stage(sets.select(F.col("doc_id").alias("node"), "set_key", "own")).dropDuplicates(["node", "set_key"]).select("node", "own")


def _agree(matches: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint8) for c in ("a_low", "b_low"))
            same = (a == b).reshape(batch.num_rows, -1).sum(axis=1) >= matches
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, live: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs (a, b) whose signatures collide often enough and whose full sets are similar."""

    def with_both(pairs: DataFrame, of: DataFrame, name: str) -> DataFrame:
        ends = _small(stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()))
        own = of.select("node", name).join(ends, "node")
        for side in ("a", "b"):
            pairs = pairs.join(own.withColumnsRenamed({"node": side, name: f"{side}_{name}"}), side)
        return pairs

    pairs = stage(pairs)
    near = stage(with_both(pairs, live, "low").mapInArrow(_agree(matches), "a long, b long").distinct())
    return stage(with_both(near, sets, "own").mapInArrow(_confirm(percent), "a long, b long").distinct())


def _centre(posts: DataFrame, k: int) -> DataFrame:
    order: Column = F.col("node") if k == 0 else F.xxhash64("node", F.lit(k))
    return posts.groupBy("token").agg(F.min_by("node", order).alias("centre"))


def _open_blocks(posts: DataFrame, block: int) -> DataFrame:
    """Posts with a key (token, x, y) each: a list of up to `block` members is one key; the
    members of a longer one are dealt to blocks, and each pair of blocks is a key."""
    sizes = posts.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = posts.join(sizes, "token").withColumn("own", own)
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return paired.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("own", "other", "blocks")


class _Forest:
    """Components within one list; starts from the labels found so far."""

    def __init__(self, labels: list[int]):
        self.up = {x: x for x in labels}

    def top(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _merge_list(nodes: list, labels: list, sigs: list, sets: list, percent: int, matches: int) -> list[tuple[int, int]]:
    """Links that join components of one list. Members of the same component are skipped;
    the others' collisions are counted, then their sets compared as bit rows."""
    forest = _Forest(labels)
    if len(forest.up) < 2:
        return []
    sizes = np.array([len(x) for x in sets])
    codes = np.frombuffer(b"".join(sigs), dtype=np.uint8).reshape(len(sets), -1)
    found, counts = np.unique(np.concatenate(sets), return_counts=True)
    common = found[counts > 1]  # others lie in one set only
    bits = np.zeros((len(sets), len(common) // 64 + 1), dtype=np.uint64)
    for i, own in enumerate(sets):
        at = np.searchsorted(common, own[np.isin(own, common, assume_unique=True)])
        np.bitwise_or.at(bits[i], at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    out = []
    for i in range(1, len(sets)):
        near = np.flatnonzero((codes[:i] == codes[i]).sum(axis=1) >= matches)
        if not len(near):
            continue
        both = np.bitwise_count(bits[near] & bits[i]).sum(axis=1, dtype=np.int64)
        for j in near[100 * both >= percent * (sizes[near] + sizes[i] - both)].tolist():
            if forest.join(labels[i], labels[j]):
                out.append((max(nodes[i], nodes[j]), min(nodes[i], nodes[j])))
    return out


def _merge(percent: int, matches: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                nodes, labels, sigs, sets = zip(*rows)
                pairs = _merge_list(nodes, labels, sigs, [np.frombuffer(x, dtype=np.uint64) for x in sets], percent, matches)
                if pairs:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs)], schema=schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("token", "x", "y", "node", "label", "low", "own")]
            for token, x, y, *row in zip(*columns):
                if (token, x, y) != key:
                    yield from done()
                    key, rows = (token, x, y), []
                rows.append(row)
        yield from done()

    return run


def merged_lists(posts: DataFrame, live: DataFrame, sets: DataFrame, percent: int, matches: int) -> DataFrame:
    """Links between components that share a list, found inside the list."""
    own = sets.join(_small(stage(posts.select("node").distinct())), "node").join(live.select("node", "low"), "node")
    keyed = _open_blocks(posts.select("token", "node", "label"), BLOCK).join(own, "node")
    grouped = keyed.repartition("token", "x", "y").sortWithinPartitions("token", "x", "y")
    found = grouped.select("token", "x", "y", "node", "label", "low", "own").mapInArrow(_merge(percent, matches), "a long, b long")
    return stage(found.distinct())


def links(nodes: DataFrame, docs: DataFrame, n: int, percent: int, shared: int, matches: int) -> DataFrame:
    """Edges (a, b), a > b, that span every component of the similarity graph."""
    posts = stage(prefixes(nodes, shared))
    live = stage(nodes.join(_small(stage(posts.select("node").distinct())), "node").select("node", "set_key", "low"))
    sets = stage(node_sets(live, docs, n))
    edges = None
    k = 0
    while True:
        if edges is None:
            labelled = posts.withColumn("label", F.col("node"))
        else:
            labels = components(edges)
            labelled = posts.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = labelled.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        open_posts = stage(labelled.join(mixed.where("lo < hi").select("token"), "token", "left_semi"))
        if open_posts.isEmpty():
            return edges if edges is not None else posts.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
        last = k >= STARS
        if last:
            found = merged_lists(open_posts, live, sets, percent, matches)
        else:
            heads = _centre(open_posts, k)
            heads = heads.join(open_posts.select(F.col("node").alias("centre"), F.col("label").alias("of")).distinct(), "centre")
            pairs = open_posts.join(heads, "token").where("label <> of").select(
                F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")
            )
            found = confirmed(pairs.distinct(), live, sets, percent, matches)
        edges = found if edges is None else edges.unionByName(found)
        if last:
            return edges
        k += 1


def near_duplicates(
    docs: DataFrame, *, n: int = WORDS, percent: int = PERCENT, count: int = COORDINATES,
    posted: int = POSTED, shared: int = SHARED, matches: int = MATCHES,
) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, set_key.

    `docs` needs doc_id and text; other columns are ignored. Rows with equal non-null ids
    count as one document. Null and empty texts have no shingles and are linked with
    nothing. Rows without an id are linked with nothing, get component_id null and are
    kept. Of a component the smallest doc_id is kept; repeated rows are returned as often
    as they occur.
    """
    sigs = stage(signatures(docs, n, count, posted))
    with_set = sigs.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = with_set.groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.first("sig").alias("sig"), F.first("low").alias("low")
    )
    nodes = stage(classes)
    edges = links(nodes, docs, n, percent, shared, matches)
    label = components(edges)
    top = nodes.join(label, "node", "left").select("set_key", F.coalesce("label", "node").alias("component_id"))
    joined = sigs.where(F.col("doc_id").isNotNull()).join(top, "set_key", "left")
    component = F.coalesce("component_id", "doc_id")
    out = joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"), "set_key"
    )
    without = sigs.where(F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"), "set_key"
    )
    return out.unionByName(without)


def fresh_name(docs: DataFrame, name: str) -> str:
    """A column name that `docs` does not use, in any case."""
    used = {c.lower() for c in docs.columns}
    while name.lower() in used:
        name += "_"
    return name


def text_key() -> Column:
    """A key above 2**62 for the content of a row that its id does not tell from others, so
    that ordinary ids are smaller; NULL for a text without words."""
    key = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    return F.when(F.col("text").rlike(r"[^\x09-\x0d\x20]"), key)


def _first_of(rows: DataFrame, key: str) -> DataFrame:
    """The smallest row of each key, by the columns that have an order."""
    names = [f"`{c}`" for c in rows.columns]
    ordered = [f"`{f.name}`" for f in rows.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    least = rows.groupBy(key).agg(F.min_by(F.struct(*names), F.struct(*ordered)).alias("_row"))
    return least.select(*[F.col("_row").getField(c).alias(c) for c in rows.columns])


def deduplicated(docs: DataFrame, *, without_id: bool = False, **options) -> DataFrame:
    """One row of each group of near-duplicates, that with the smallest doc_id, unchanged.

    Rows are told apart by doc_id while it is theirs alone. Rows that share a doc_id are
    told apart by their texts: only those of equal id and text, of which the smallest row
    stays, or of near-duplicate texts are one. Rows without an id stay, or are told apart by
    their texts as well if `without_id`; rows that have one come first. Rows without words
    are copies of nothing and stay. Other columns, of any type and name, are kept as they are.
    """
    key = fresh_name(docs, "_key")
    shared = stage(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_id")))
    same = docs["doc_id"].eqNullSafe(shared["_id"])
    told = docs.join(shared, same, "left_anti").withColumn(key, F.coalesce("doc_id", text_key()))
    others = docs.join(shared, same, "left_semi").withColumn(key, text_key())
    if not without_id:
        told, others = (df.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.col(key))) for df in (told, others))
    keyed = told.unionAll(others)
    found = near_duplicates(keyed.select(F.col(key).alias("doc_id"), "text"), **options)
    gone = stage(found.where(F.col("doc_id").isNotNull() & ~F.col("kept")).select(F.col("doc_id").alias("_id")).distinct())
    kept = told.join(gone, told[key] == gone["_id"], "left_anti")
    again = others.join(gone, others[key] == gone["_id"], "left_anti")
    once = _first_of(again.where(F.col(key).isNotNull()), key)
    return kept.unionAll(once).unionAll(again.where(F.col(key).isNull())).drop(key)
