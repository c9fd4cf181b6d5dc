"""Joins and group heads that stay balanced when one key holds much of the data."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from outreach.sources.staging import stage

HOT_ROWS = 1_000_000    # rows of one key that a task copes with
SMALL_BYTES = 8 << 20   # a table of this many bytes is copied to every executor
PACK_ROWS = 8           # left rows of a key that meet a block at once
BLOCK_ROWS = 512        # right rows of a key that one row holds
TASK_PAIRS = 1 << 23    # pairs of a key that are made together; a task makes about twice as many


def hot_keys(df: DataFrame, keys: list[str], min_rows: int = HOT_ROWS, salts: int = 2) -> DataFrame:
    """Keys with at least `min_rows` rows, and `_salts`: among how many sub-keys to split
    each so that none holds more than `min_rows`, `salts` at least.

    One small job over the key columns that combines on the map side. There can be no more
    such keys than rows / min_rows. Which keys are listed never changes a result, only how
    evenly the work is spread.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    split = F.greatest(F.ceil(F.col("_rows") / min_rows), F.lit(salts)).cast("int")
    return stage(counts.where(F.col("_rows") >= min_rows).select(*keys, split.alias("_salts")))


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's plain columns: the same on a retried task, unlike a random number."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    return F.xxhash64(*plain)


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_r_{k}" for k in keys})


def _match(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    def same(k: str) -> Column:
        return left[k].eqNullSafe(right[f"_r_{k}"]) if null_safe else left[k] == right[f"_r_{k}"]

    return reduce(lambda a, b: a & b, [same(k) for k in keys])


def _mark(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    marks = F.broadcast(_renamed(hot, keys))  # at most rows / min_rows keys
    return df.join(marks, _match(df, marks, keys, True), "left").drop(*[f"_r_{k}" for k in keys])


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    hot_in: DataFrame | None = None,
    rows: int | None = None,
    null_safe: bool = False,
    min_rows: int = HOT_ROWS,
    salts: int = 2,
) -> DataFrame:
    """Equi join (inner, left, left_semi, left_anti) whose hot left keys are split.

    Without hot keys this is the plain join and Spark picks its strategy. Otherwise the
    rows of a hot key go to one of its sub-keys, and the right rows of those keys are
    repeated once per sub-key. The right side should hold few rows per key. Pass `hot_in`
    to look for hot keys in a cheaper frame than `left`, and `rows`, the number of its rows,
    where it is known: below `min_rows` no key is hot and none are counted.
    """
    few = rows is not None and rows < min_rows
    hot = None if few else hot_keys(left if hot_in is None else hot_in, on, min_rows, salts)
    drop = [f"_r_{k}" for k in on]
    if hot is None or hot.isEmpty():
        r = _renamed(right, on)
        return left.join(r, _match(left, r, on, null_safe), how).drop(*drop)
    salt = F.coalesce(F.pmod(row_hash(left), F.col("_salts")).cast("int"), F.lit(0))
    l = _mark(left, hot, on).withColumn("_salt", salt).drop("_salts")
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    r = _renamed(_mark(right, hot, on).withColumn("_r_salt", F.explode(copies)).drop("_salts"), on)
    cond = _match(l, r, on, null_safe) & (l["_salt"] == r["_r_salt"])
    return l.join(r, cond, how).drop("_salt", "_r_salt", *drop)


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """The frame, staged, and the bytes of its rows as JSON text, which stand for what a copy
    takes in memory. The job that writes the rows measures them."""
    seen = Observation()
    size = F.sum(F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    table = stage(df.observe(seen, F.coalesce(size, F.lit(0)).alias("n_bytes")))
    return table, seen.get["n_bytes"]


def sized_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    max_bytes: int = SMALL_BYTES,
    null_safe: bool = False,
    **spread,
) -> DataFrame:
    """Equi join with a configuration table, on keys of few values or with a hot one.

    The right side is staged and measured as it is written. Within `max_bytes` every executor
    gets a copy and no left row moves, whatever its key. A larger one goes through `spread_join`,
    which splits hot keys of the left side; `spread` holds its options.
    """
    return measured_join(left, *measured(right), on, how, max_bytes=max_bytes, null_safe=null_safe, **spread)


def measured_join(
    left: DataFrame,
    table: DataFrame,
    n_bytes: int,
    on: list[str],
    how: str = "inner",
    *,
    max_bytes: int = SMALL_BYTES,
    null_safe: bool = False,
    **spread,
) -> DataFrame:
    """`sized_join` with a table that is measured already."""
    if n_bytes > max_bytes:
        return spread_join(left, table, on, how, null_safe=null_safe, **spread)
    r = F.broadcast(_renamed(table, on))
    return left.join(r, _match(left, r, on, null_safe), how).drop(*[f"_r_{k}" for k in on])


def _blocks(right: DataFrame, on: list[str], block: int) -> DataFrame:
    """The right rows of a key in order, dealt to rows of at most `block`: an array per column."""
    told = [c for c in right.columns if c not in on]
    number = F.row_number().over(Window.partitionBy(*on).orderBy(*told))
    dealt = right.withColumn("_block", F.floor((number - 1) / block))
    lists = dealt.groupBy(*on, "_block").agg(F.array_sort(F.collect_list(F.struct(*told))).alias("_told"))
    return lists.select(*on, "_block", *[F.col("_told")[c].alias(c) for c in told])


def _packs(left: DataFrame, lists: DataFrame, on: list[str], told: str, pack: int, task_pairs: int, **spread) -> DataFrame:
    """The left rows that meet something, in packs (`_pack`) of about `pack` rows of a key. Tasks
    get them by the number of their pairs, whatever the bytes and however few the keys."""
    held = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_held"))
    met = lists.groupBy(*on).agg(F.sum(F.size(told)).alias("_met"))
    parts = F.ceil(F.col("_held") * F.col("_met") / task_pairs)
    packs = F.greatest(parts, F.ceil(F.col("_held") / pack))
    dealt = stage(held.join(met, on).select(*on, parts.alias("_parts"), packs.alias("_packs")))
    n_parts = dealt.agg(F.sum("_parts")).first()[0] or 1
    number = F.pmod(row_hash(left), F.col("_packs"))
    return (
        sized_join(left, dealt, on, **spread)
        .select(*left.columns, number.alias("_number"), F.pmod(number, F.col("_parts")).alias("_part"))
        .repartition(ceil(n_parts / 2), *on, "_part")
        .groupBy(*on, "_part", "_number")
        .agg(F.collect_list(F.struct(*[c for c in left.columns if c not in on])).alias("_pack"))
        .drop("_part", "_number")
    )


def paired_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    *,
    max_bytes: int = SMALL_BYTES,
    pack: int = PACK_ROWS,
    block: int = BLOCK_ROWS,
    task_pairs: int = TASK_PAIRS,
    **spread,
) -> DataFrame:
    """Equi join that gives far more pairs than rows, as the last step: no pair is shuffled.

    The right rows of a key come as lists, which `sized_join` copies or spreads; pairs leave a
    row's list. Where a key has more than `block` right rows, they come as several lists, so that
    no row grows with the table, and left rows meet them in packs: neighbouring pairs share the
    list, which files then hold once. Left rows should be distinct, as copies share a pack.
    """
    told = [c for c in right.columns if c not in on]
    own = [c for c in left.columns if c not in on]
    lists, n_bytes = measured(_blocks(right, on, block))
    several = lists.agg(F.max("_block")).first()[0]
    people = _packs(left, lists, on, told[0], pack, task_pairs, **spread) if several else left
    met = measured_join(people, lists.drop("_block"), n_bytes, on, max_bytes=max_bytes, **spread)
    if several:
        met = met.select(*on, F.explode("_pack").alias("_own"), *told).select(*on, *[F.col("_own")[c].alias(c) for c in own], *told)
    listed = met.select(*left.columns, *told, F.posexplode(told[0]).alias("_at", "_first"))
    return listed.select(*left.columns, F.col("_first").alias(told[0]), *[F.get(c, F.col("_at")).alias(c) for c in told[1:]])


def group_heads(df: DataFrame, group: list[str], order: list, limit: DataFrame, by: list[str]) -> DataFrame:
    """First n rows of each group with their number `n`, n given by a table.

    `limit` holds one row per `by` key with column `n_max`. Rows are numbered inside hashed
    sub-groups of about HOT_ROWS first; only those within n_max there can be within n_max
    of the whole group, so the final numbering sees n_max rows of each sub-group at most.
    `df` is read twice, so stage it first when it is costly.
    """
    largest = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows")).first()[0]
    salt = F.pmod(row_hash(df), F.lit(max(1, ceil((largest or 0) / HOT_ROWS))))
    local = sized_join(df.withColumn("_sub", salt), limit, by, hot_in=df)
    local = local.withColumn("n", F.row_number().over(Window.partitionBy(*group, "_sub").orderBy(*order)))
    kept = local.where(F.col("n") <= F.col("n_max")).drop("_sub")
    ranked = kept.withColumn("n", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("n") <= F.col("n_max")).drop("n_max")


def first_per_group(df: DataFrame, group: list[str], order: list, n: int = 1) -> DataFrame:
    """First `n` rows of each group; Spark drops the rest of a group before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def consecutive_ids(df: DataFrame, key: list[str], name: str, start: int = 1) -> DataFrame:
    """Consecutive ids over the whole frame, in the order of the md5 of a unique key.

    No global sort: rows per md5 prefix are counted, the counts are summed up to offsets,
    and rows are numbered inside their prefix. Prefixes are as long as it takes for one to
    hold about HOT_ROWS rows or fewer. `df` is read three times, so stage it first when it
    is costly.
    """
    length = 1
    rows = df.count()
    while 16**length * HOT_ROWS < rows:
        length += 1
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))
    tagged = df.withColumn("_digest", digest).withColumn("_bucket", F.substring("_digest", 1, length))
    sizes = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_bucket").orderBy("_digest", *key)
    return (
        tagged.withColumn("_n", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (F.col("_offset") + F.col("_n") + (start - 1)).cast("long"))
        .drop("_digest", "_bucket", "_n", "_offset")
    )
