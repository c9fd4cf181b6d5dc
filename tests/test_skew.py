"""Splitting hot keys never changes a result."""

import random

import pytest
from pyspark.sql import functions as F

from outreach.operators.skew import consecutive_ids, first_per_group, group_heads, hot_keys, spread_join

SCHEMA = "k string, g int, id int"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, a few on NULL, the rest spread out."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        k = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randint(0, 40)}"
        rows.append((k, rng.randint(0, 3), i))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def other(spark):
    rows = [("hot", 0, 1), ("hot", 1, 2), (None, 2, 3)] + [(f"k{i}", i % 4, i) for i in range(0, 40, 2)]
    return spark.createDataFrame(rows, "k string, g int, v int")


def rows_of(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_spread_join_equals_plain_join(skewed, other, how, null_safe):
    args = (skewed, other, ["k", "g"], how)
    plain = spread_join(*args, null_safe=null_safe)
    split = spread_join(*args, null_safe=null_safe, min_rows=5, salts=7)
    assert rows_of(plain) == rows_of(split)


def test_hot_rows_reach_many_tasks(skewed, other):
    split = spread_join(skewed, other.select("k").distinct(), ["k"], min_rows=100, salts=16)
    assert "_salt" in split._jdf.queryExecution().analyzed().toString()


def test_hot_keys_lists_the_heavy_ones(skewed):
    assert [tuple(r) for r in hot_keys(skewed, ["k"], min_rows=100).collect()] == [("hot", 2)]
    assert [tuple(r) for r in hot_keys(skewed, ["k"], min_rows=50).collect()] == [("hot", 4)]


def test_every_heavy_key_is_split(spark):
    rows = spark.range(6000).selectExpr("id % 1500 AS k", "id")
    found = hot_keys(rows, ["k"], min_rows=3)
    assert found.count() == 1500 and found.where("_salts <> 2").isEmpty()
    right = spark.range(1500).selectExpr("id AS k", "id * 2 AS v")
    assert spread_join(rows, right, ["k"], min_rows=3).where("v = k * 2").count() == 6000


def test_group_heads_equals_one_window(spark, skewed):
    limit = spark.createDataFrame([(0, 3), (1, 1), (2, 5)], "g int, n_max int")
    got = group_heads(skewed, ["k", "g"], ["id"], limit, ["g"])
    want = {}
    for r in sorted(skewed.collect(), key=lambda r: r.id):
        n = {0: 3, 1: 1, 2: 5}.get(r.g, 0)
        kept = want.setdefault((r.k, r.g), [])
        if len(kept) < n:
            kept.append((r.id, len(kept) + 1))
    assert {(r.k, r.g, r.id, r.n) for r in got.collect()} == {
        (k, g, i, n) for (k, g), kept in want.items() for i, n in kept
    }


def test_consecutive_ids_are_1_to_n_whatever_the_partitioning(skewed):
    a = consecutive_ids(skewed, ["id"], "n")
    b = consecutive_ids(skewed.repartition(7), ["id"], "n")
    got = {r.id: r.n for r in a.collect()}
    assert sorted(got.values()) == list(range(1, 601))
    assert got == {r.id: r.n for r in b.collect()}


def test_first_per_group_limits_before_the_shuffle(skewed):
    plan = first_per_group(skewed, ["k"], ["id"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
