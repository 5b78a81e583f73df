"""Bloom filters lose no match, pass little else, and change no result of the call log."""

import pytest
from pyspark.sql import functions as F

from callmart.checks.fixtures import CTX, view
from callmart.checks.pipelines import RAW
from callmart.operators.reducers import bloom, may_match
from callmart.plans.call_log import first_source, narrowed


def test_all_keys_pass_and_few_others(spark):
    keys = spark.range(0, 5000).selectExpr("cast(id * 7 as string) as k").unionByName(spark.createDataFrame([(None,)], "k string"))
    words = bloom(keys, "k", bits=1 << 16)
    assert words.count() <= 2 * (1 << 16) // 64
    everything = spark.range(0, 100_000).selectExpr("cast(id as string) as k").unionByName(spark.createDataFrame([(None,)], "k string"))
    passed = may_match(everything, "k", words, bits=1 << 16)
    assert keys.join(passed, keys["k"].eqNullSafe(passed["k"]), "left_anti").count() == 0
    # Two places of 65,536 with 5,001 keys: (1 - exp(-5001 / 65536)) ** 2 is 0.5 %.
    assert passed.count() - 5001 < 0.012 * 95_000


def test_an_overfull_filter_only_passes_more(spark):
    keys = spark.range(0, 5000).selectExpr("id as k")
    words = bloom(keys, "k", bits=64)
    assert may_match(spark.range(0, 9000).selectExpr("id as k"), "k", words, bits=64).count() >= 5000
    assert may_match(spark.range(0, 9).selectExpr("id as k"), "k", bloom(keys.limit(0), "k")).count() == 0


def test_size_does_not_follow_the_keys(spark):
    few, many = (bloom(spark.range(0, n), "id", bits=1 << 12).count() for n in (10, 50_000))
    assert few <= 20 and many == 2 * (1 << 12) // 64


@pytest.mark.parametrize("days", [(1, 1), (3, 2), (30, 1)])
def test_narrowing_changes_nothing(spark, folder, days):
    tables = {name: view(spark, folder, v) for name, v in RAW.items()}
    plain, narrow = (sorted(map(str, first_source(tables, CTX, *days, narrow=n).collect())) for n in (False, True))
    assert plain == narrow != []


def test_a_day_keeps_its_part_of_the_lookups(spark, folder):
    """What is left to rank, group and shuffle is what the day's calls meet, give or take a few."""
    tables = {name: view(spark, folder, v) for name, v in RAW.items()}
    facts = tables["interaction_fact"].where(F.col("part_date") == CTX.day_key(1)).withColumn("callid", F.col("media_server_ixn_guid"))
    small = narrowed(tables, facts)
    met = tables["contact_attempt_fact"].join(facts.select("callid").distinct(), "callid", "left_semi").count()
    left = small["contact_attempt_fact"].count()
    assert met <= left <= met + 2 + tables["contact_attempt_fact"].count() // 100
    for name in ("taskcalendar", "result", "eventhistory", "session_action"):
        assert small[name].count() < tables[name].count() / 2, name
    text = small["contact_attempt_fact"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_hour_of_start_or_end(spark, folder):
    tables = {name: view(spark, folder, v) for name, v in RAW.items()}
    by_end, by_start = (first_source(tables, CTX, 30, 1, hour_of=h) for h in ("end", "start"))
    assert by_end.where(F.hour("dtime_call_end") != F.col("h_date")).count() == 0
    assert by_start.where(F.hour("dtime_call_start") != F.col("h_date")).count() == 0
    with pytest.raises(ValueError, match="middle"):
        first_source(tables, CTX, hour_of="middle")
