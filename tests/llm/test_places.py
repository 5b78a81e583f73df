"""Placement table and exact search against plain versions."""

import math

import numpy as np
import pytest
from cases import awkward, empty, table
from pyspark.sql import functions as F

from callmart.llm import balltree, maglev

SHARDS = [f"s{i}" for i in range(7)]


def plain_table(shards, slots, turns):
    """Turns taken one by one, each looking through the whole order of preference."""
    table = [None] * slots
    orders = {s: [(maglev._number(s, "offset") + i * (maglev._number(s, "skip") % (slots - 1) + 1)) % slots for i in range(slots)] for s in shards}
    while None in table:
        for s in shards:
            for _ in range(turns.get(s, 1)):
                free = [k for k in orders[s] if table[k] is None]
                if free:
                    table[free[0]] = s
    return table


@pytest.mark.parametrize("turns", [{}, {"s2": 3}])
def test_table(turns):
    assert maglev.lookup_table(SHARDS, 101, turns) == plain_table(SHARDS, 101, turns)


def test_table_is_even_and_steady():
    before = maglev.lookup_table(SHARDS)
    share = [before.count(s) for s in SHARDS]
    assert max(share) - min(share) <= 1
    after = maglev.lookup_table(SHARDS[:-1])
    moved = sum(a != b and a != SHARDS[-1] for a, b in zip(before, after))
    assert moved < 0.1 * len(before)
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            maglev.lookup_table(wrong)
    with pytest.raises(ValueError):
        maglev.lookup_table(SHARDS, 100)


def test_rows_are_placed(spark):
    import hashlib

    rows = awkward()
    placed = maglev.assign(table(spark, rows), "doc_id", SHARDS)
    lookup = maglev.lookup_table(SHARDS)
    found = placed.collect()
    assert len(found) == len(rows) and placed.columns.count("slot") == placed.columns.count("shard") == 1
    for r in found:
        key = "" if r.doc_id is None else f"={r.doc_id}"
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % maglev.SLOTS
        assert r.shard == lookup[r.slot]
    assert maglev.assign(empty(spark), "doc_id", SHARDS).count() == 0


def plain_top(rows, k):
    """rows: id -> vector; the ids divisible by 50 are queries."""
    out = []
    for q, v in rows.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows.items() if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows, block_rows", [(10_000, 1_000), (70, 3)])
def test_top_k(spark, shard_rows, block_rows):
    rnd = np.random.default_rng(10)
    vectors = {i: rnd.normal(size=12).astype(np.float32).tolist() for i in range(700)}
    for i in range(100, 250):
        vectors[i] = vectors[100]  # ties
    for i in (701, 750):
        vectors[i] = [0.0] * 12
    rows = list(vectors.items())
    rows += [(800, None), (850, [float("nan")] * 12), (851, [1.0, None] * 6), (852, [float("inf")] * 12), (900, []), (None, vectors[0])]
    rows += [(1000, [1.0, 2.0, 3.0]), (1001, [3.0, -2.0, 1.0]), (50, vectors[50])]
    df = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<float>, score double, n int").repartition(4)
    found = balltree.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, shard_rows=shard_rows, block_rows=block_rows, blocks_of_group=2).collect()
    whole = {i: np.floor(256.0 * np.array(v, np.float32).astype(float)).astype(int).tolist() for i, v in [*vectors.items(), *rows[-3:-1]]}
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == plain_top(whole, 5)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    query = F.col("vec_id") % 50 == 0
    assert balltree.top_k(spark.createDataFrame([], schema), "vec_id", "embedding", query).count() == 0
    one = spark.createDataFrame([(0, [1.0])], schema)
    assert balltree.top_k(one, "vec_id", "embedding", query).count() == 0
    two = spark.createDataFrame([(0, [1.0]), (3, [-2.0])], schema)
    assert [tuple(r) for r in balltree.top_k(two, "vec_id", "embedding", query).collect()] == [(0, 1, 3, -131072)]


@pytest.mark.parametrize("large", [1e6, 3e9, 1e12, 1e30])
def test_large_components_and_repeated_ids(spark, large):
    """Products beyond the doubles' whole numbers, beyond 64 bits, and rows of one id."""
    rnd = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rnd.normal(0, 1, 4)]) for i in range(150)]
    rows += [(200 + i, [large, 1.0 + i / 256, -large if i % 2 else large, i / 256]) for i in range(6)]
    rows += [(250, [large, -large, 1.0, 2.0]), (1, [9.0, 9.0, 9.0, 9.0]), (1, [9.0, 9.0, 9.0, 9.0]), (50, rows[50][1]), (300, [float("inf"), 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = balltree.top_k(df, "vec_id", "embedding", F.col("vec_id") % 50 == 0, shard_rows=60).collect()
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if all(map(math.isfinite, v))]
    queries = {}
    for i, v in whole:
        if i % 50 == 0:
            queries[i] = v
    want = []
    for q, v in queries.items():
        exact = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q)
        fit = sorted((-max(-(2**63) + 1, min(2**63 - 1, -s)), i) for s, i in exact)
        want += [(q, rank, i, -s) for rank, (s, i) in enumerate(fit[:5], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == sorted(want)
