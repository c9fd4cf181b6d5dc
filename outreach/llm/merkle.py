"""Merkle manifest of a dataset: digests of rows, of sources and of the whole, with proofs.

A row's leaf is the SHA-256 of its fields. The leaves of a source, in order of doc_id, are
hashed in runs of FANOUT into parents, those again, until one node is left: the source's
subroot. The subroots, in order of source, give the root in the same way.

How it runs: rows get their place from one range exchange of narrow rows (no text) and the
counts of its partitions, so a source that holds a third of the rows is spread like any
other. Each aligned block of FANOUT**2 nodes is one row that keeps a level as one string of
hex digits; parents are hashes of fixed-width substrings of it, and the siblings of a node
are the two substrings that flank it within its run. A block's top is a node of the next
round, whose blocks are FANOUT**2 times fewer. On the way back every block is given the
sibling segments above it; a block's rows share those, and a join from a block to the
block above never meets more than FANOUT**2 rows of a key. Only in the last, row-local
step do rows take their own segments, so no proof is ever shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outreach.sources.staging import stage

FANOUT = 16
BLOCK = FANOUT * FANOUT
DIGIT = 64  # hex digits of a digest
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<left:string,right:string>>"
_NO_PATH = f"cast(array() AS {_PATH})"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field as text that can't run into the next one."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: dict[str, Column]) -> Column:
    return digest(*[field(values[name]) for name in FIELDS])


def lower_cased(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def placed(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """`df`, staged, with the place of each row in the whole order, from 0. What goes to the
    one task that adds partition sizes up has a row per partition."""
    at = F.monotonically_increasing_id()
    ordered = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at))
    part, row = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    joined = ordered.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_start") + row).drop("_at", "_part", "_start")


def _parents(level: Column) -> Column:
    """The next level of a block: hashes of its runs, as one string."""
    width = FANOUT * DIGIT
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / width).cast("int"))
    return F.array_join(F.transform(runs, lambda j: F.sha2(F.substring(level, j * width + 1, F.lit(width)), 256)), "")


def blocks(nodes: DataFrame, extra: Column | None = None) -> DataFrame:
    """Blocks of `nodes` (tree, place, size, node), staged: tree, block, size, level0, level1
    and top. `size` is the number of nodes of the tree; a tree of one node stays as it is,
    one of up to FANOUT is hashed once, a larger one twice. `extra` is kept per node, in
    `extras`."""
    own = F.struct("place", "node", *([extra.alias("extra")] if extra is not None else []))
    items = F.array_sort(F.collect_list(own))
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / BLOCK).alias("block"), "size").agg(items.alias("_items"))
    first = grouped.withColumn("level0", F.array_join(F.transform("_items", lambda x: x["node"]), ""))
    second = first.withColumn("level1", F.when(F.col("size") > 1, _parents(F.col("level0"))))
    top = F.when(F.col("size") > FANOUT, F.sha2("level1", 256)).otherwise(F.coalesce("level1", "level0"))
    kept = ["tree", "block", "size", "level0", "level1", top.alias("top")]
    if extra is not None:
        kept.append(F.transform("_items", lambda x: x["extra"]).alias("extras"))
    return stage(second.select(*kept))


def _flanks(level: Column, at: Column) -> Column:
    """What stands left and right of node `at` of a level within its run."""
    start = F.floor(at / FANOUT) * FANOUT
    left = F.substring(level, (start * DIGIT + 1).cast("int"), ((at - start) * DIGIT).cast("int"))
    right = F.substring(level, ((at + 1) * DIGIT + 1).cast("int"), ((start + FANOUT - at - 1) * DIGIT).cast("int"))
    return F.struct(left.alias("left"), right.alias("right"))


def _path(low: Column, high: Column) -> Column:
    """The segments that a tree of the row's size has, of the two levels of a block."""
    found = F.when(F.col("size") > FANOUT, F.array(low, high)).when(F.col("size") > 1, F.array(low))
    return F.coalesce(found.cast(_PATH), F.expr(_NO_PATH))


def segments(at: Column) -> Column:
    """Sibling segments of node `at` inside its block, lowest level first."""
    low, high = _flanks(F.col("level0"), at), _flanks(F.col("level1"), F.floor(at / FANOUT))
    return _path(low, high)


def _tops(lower: DataFrame) -> DataFrame:
    size = F.ceil(F.col("size") / BLOCK).cast("long")
    return lower.select("tree", F.col("block").alias("place"), size.alias("size"), F.col("top").alias("node"))


def grown(nodes: DataFrame, extra: Column | None = None) -> list[DataFrame]:
    """Rounds of blocks, the last with one block per tree, whose top is the tree's root."""
    rounds = [blocks(nodes, extra)]
    while rounds[-1].where("block > 0").head(1):
        rounds.append(blocks(_tops(rounds[-1])))
    return rounds


def descended(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest blocks with `path`, the segments above each, and what else `above` (tree,
    path, ...) says of their tree; it has a row for each tree."""
    others = [c for c in above.columns if c not in ("tree", "path")]
    told = rounds[-1].join(above, "tree")
    for lower in reversed(rounds[:-1]):
        inner = F.transform(F.sequence(F.lit(0), (F.length("level0") / DIGIT - 1).cast("int")),
                            lambda i: F.struct(i.alias("at"), segments(i).alias("own")))
        spread = told.select("tree", F.col("block").alias("_up"), "path", *others, F.explode(inner).alias("x"))
        paths = spread.select(
            "tree", (F.col("_up") * BLOCK + F.col("x.at")).alias("block"), F.concat("x.own", "path").alias("path"), *others
        )
        told = lower.join(stage(paths), ["tree", "block"])
    return told


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """Per row of `docs` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified, place, proof_digests.

    Where `tampered` is true the check folds the leaf of the row with the letters A-Z of its
    text in lower case, as if someone had changed it; null is false. A null field is told
    from an empty one. Rows without a source are one source, the first. Rows without a
    doc_id come first in their source; rows that repeat one follow each other by their
    leaves. `place` is the row's place in its source, `proof_digests` the number of
    siblings. Other columns, whatever their names, are ignored; an empty table gives none.
    """
    values = {name: F.col(name) for name in FIELDS}
    changed = leaf({**values, "text": lower_cased(F.col("text"))})
    leaves = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf(values).alias("node"),
        F.when(tampered, changed).alias("claimed"),
    ))
    # Rows alike in all of these are told apart by where they were read.
    spread = leaves.withColumn("_tie", F.monotonically_increasing_id())
    ordered = stage(placed(spread, ["source", "doc_id", "node", "_tie"], "_whole").drop("_tie"))
    sources = stage(ordered.groupBy("source").agg(F.min("_whole").alias("tree"), F.count(F.lit(1)).alias("size")))
    nodes = ordered.join(sources, ordered["source"].eqNullSafe(sources["source"])).select(
        "tree", "size", (F.col("_whole") - F.col("tree")).alias("place"), "node", "doc_id", "claimed"
    )
    rounds = grown(nodes, F.struct("doc_id", "claimed"))
    subroots = rounds[-1].select("tree", F.col("top").alias("subroot"))
    # A source's tree is named by its first place, so trees stand in the order of sources.
    ranked = stage(placed(subroots, ["tree"], "place"))
    n_sources = ranked.count()
    tops = ranked.select(F.lit(0).cast("long").alias("tree"), "place", F.lit(n_sources).cast("long").alias("size"),
                         F.col("subroot").alias("node"), F.col("tree").alias("_of"))
    whole = grown(tops, F.col("_of"))
    root = whole[-1].select("tree", F.col("top").alias("root"), F.expr(_NO_PATH).alias("path"))
    told = descended(whole, root).select(
        "root", "path", "size", "level0", "level1", F.posexplode("extras").alias("at", "of")
    )
    above = told.select(
        F.col("of").alias("tree"), F.substring("level0", F.col("at") * DIGIT + 1, F.lit(DIGIT)).alias("subroot"), "root",
        F.concat(segments(F.col("at")), "path").alias("path"),
    )
    lowest = descended(rounds, stage(above))
    # Runs first, so that a row carries its run and not its block.
    per_run = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("extras") - 1) / FANOUT).cast("int")),
        lambda j: F.struct(
            j.alias("run"), F.substring("level0", j * FANOUT * DIGIT + 1, F.lit(FANOUT * DIGIT)).alias("nodes"),
            F.slice("extras", j * FANOUT + 1, F.lit(FANOUT)).alias("rows"), _flanks(F.col("level1"), j).alias("high"),
        ),
    )
    runs = lowest.select("block", "size", "subroot", "root", "path", F.inline(per_run))
    at = F.col("at")
    low = F.struct(
        F.substring("nodes", F.lit(1), at * DIGIT).alias("left"), F.substring("nodes", (at + 1) * DIGIT + 1, F.lit(FANOUT * DIGIT)).alias("right")
    )
    rows = runs.select(
        "block", "run", "size", "nodes", "high", "subroot", "root", F.col("path").alias("_above"), F.posexplode("rows").alias("at", "row")
    ).select(
        "row.doc_id", F.substring("nodes", at * DIGIT + 1, F.lit(DIGIT)).alias("leaf"), "row.claimed", "subroot", "root",
        F.concat(_path(low, F.col("high")), "_above").alias("path"),
        (F.col("block") * BLOCK + F.col("run") * FANOUT + at).alias("place"),
    )
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("path", F.coalesce("claimed", "leaf"), lambda h, s: digest(s["left"], h, s["right"]))
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"), "place",
        (F.length(siblings) / DIGIT).cast("int").alias("proof_digests"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
