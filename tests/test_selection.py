"""Ranks by counting ranges against a sort, and salted joins against plain ones."""

import random

import pytest
from pyspark.sql import functions as F

from callmart.checks.fixtures import CTX, view
from callmart.checks.pipelines import RAW
from callmart.operators.joins import lookup
from callmart.operators.scoring import score_bands
from callmart.operators.selection import ascending, at_ranks
from callmart.operators.skew import SALT, heavy_keys, salted, spread
from callmart.plans.call_log import first_source
from callmart.session import stage


@pytest.mark.parametrize("sample", [50, 400, 100_000])
def test_rows_at_ranks(spark, sample):
    """A third of the rows on one score, missing scores, NaN, and ties by text."""
    rnd = random.Random(1)
    score = lambda: rnd.choice([0.5, None, float("nan"), rnd.random(), 0.0, -0.0, rnd.random()])
    rows = [(score(), rnd.choice(["a", "é", None, "Z"]) and f"{rnd.choice('abé')}{i % 7}", i) for i in range(4000)]
    table = spark.createDataFrame(rows, "score double, t string, id long").repartition(6)
    table = stage(table)
    ranked = [r["id"] for r in table.orderBy(F.col("score").desc(), "t", "id").collect()]
    wanted = [1, 7, 400, 1333, 2000, 2001, 3999, 4000]
    found = at_ranks(table, ascending(table, "score", ["t", "id"]), wanted, sample)
    assert {r: key["t1"] for r, key in found.items()} == {r: ranked[r - 1] for r in wanted}


def test_not_unique(spark):
    table = stage(spark.range(900).selectExpr("1.0D as score", "id % 3 as t"))
    for sample in (10, 1000):
        assert at_ranks(table, ascending(table, "score", ["t"]), [450], sample) is None
    # Bands are then those of a sort, of equal size.
    banded = score_bands(table, tie=["t"]).groupBy("band").count().collect()
    assert sorted(tuple(r) for r in banded) == [(b, 90) for b in range(1, 11)]
    with pytest.raises(TypeError):
        ascending(spark.createDataFrame([("x",)], "s string"), "s", [])


def test_bands_shuffle_nothing(spark):
    rows = spark.range(0, 1003, 1, 4).selectExpr("id", "pmod(hash(id), 20) / 7 as score")
    banded = score_bands(rows, tie=["id"])
    assert "Exchange" not in banded._jdf.queryExecution().executedPlan().toString()
    assert banded.columns == ["id", "score", "band"]
    whole = {r["id"]: -(-10 * n // 1003) for n, r in enumerate(rows.orderBy(F.col("score").desc(), "id").collect(), 1)}
    assert {r["id"]: r["band"] for r in banded.collect()} == whole


def test_heavy_keys_are_found_without_a_count(spark):
    rows = spark.range(0, 30_000).selectExpr("if(id % 3 = 0, 'hot', if(id % 10 = 1, 'warm', cast(id as string))) as k")
    heavy = heavy_keys(rows, "k", 32)
    assert set(heavy) == {"hot", "warm"} and 10 <= heavy["hot"] <= 12 and 2 <= heavy["warm"] <= 4
    assert heavy_keys(rows.where("k not in ('hot', 'warm')"), "k", 32) == {}
    assert heavy_keys(rows.limit(0), "k") == heavy_keys(rows.selectExpr("cast(null as string) as k"), "k") == {}


def test_salted_join_equals_plain(spark):
    left = spark.range(0, 9000).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 50 = 1, null, cast(id % 900 as string))) as k")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3), ("x", 4), (None, 5)], "k string, v int")
    heavy = heavy_keys(left, "k", 30)
    apart = salted(left, "k", heavy, F.col("id"))
    joined = lookup(apart, spread(right, "k", heavy), ["k", SALT], in_place=True).drop(SALT)
    plain = left.join(right, "k", "left").select("id", "k", "v")
    assert sorted(map(str, joined.collect())) == sorted(map(str, plain.collect()))
    sizes = apart.where("k = 'hot'").groupBy(SALT).count().collect()
    assert len(sizes) == heavy["hot"] and max(r["count"] for r in sizes) < 600


def test_call_log_spreads_a_hot_call_id(spark, folder):
    """A third of a month's interactions share one call id; no task gets all of them, and nothing changes."""
    tables = {name: view(spark, folder, v) for name, v in RAW.items()}
    facts = tables["interaction_fact"]
    one = facts.agg(F.min("media_server_ixn_guid")).first()[0]
    shared = F.when(F.col("interaction_id") % 3 == 0, F.lit(one)).otherwise(F.col("media_server_ixn_guid"))
    tables["interaction_fact"] = stage(facts.withColumn("media_server_ixn_guid", shared))
    log = first_source(tables, CTX, 30, 1)
    split = sorted(map(str, log.collect()))
    heavy = heavy_keys(tables["interaction_fact"], "media_server_ixn_guid")
    assert list(heavy) == [one] and heavy[one] > 4
    from callmart.plans import call_log

    keep = call_log.heavy_keys
    call_log.heavy_keys = lambda *_: {}
    try:
        assert split == sorted(map(str, first_source(tables, CTX, 30, 1).collect())) != []
    finally:
        call_log.heavy_keys = keep
