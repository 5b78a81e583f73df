"""Hot keys: the split path gives the plain path's values, and no task gets a whole hot key."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callmart.operators.history import asof_join, lag_features, rank_by_recency
from callmart.operators.joins import lookup, missing_rows, restrict_to
from callmart.operators.ordered import Hot, find_hot, row_index, running
from callmart.operators.trailing import MIDNIGHT, UNTIL, Trailing, trailing

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """Three quarters of the rows on one key, a missing key, ties and copies of one instant."""
    rng = random.Random(7)
    rows = []
    for i in range(400):
        key = rng.choice(["hot"] * 6 + [None, "b", "c"])
        ts = START + timedelta(hours=rng.randrange(0, 24 * 60)) if rng.random() < 0.8 else START + timedelta(days=20)
        rows.append((i, key, ts, rng.randrange(0, 5), rng.choice([None, "x", "y"])))
    return spark.createDataFrame(rows, "id long, key string, ts timestamp_ntz, v int, tag string").cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hot_keys_are_counted(events):
    hot = find_hot(events, ["key"], 50)
    assert [r["key"] for r in hot.keys.collect()] == ["hot"]
    assert hot.rows == events.where("key = 'hot'").count()
    assert find_hot(events, ["key"], 1000) == Hot(None, 0)


def test_missing_key_can_be_hot(events):
    assert None in [r["key"] for r in find_hot(events, ["key"], 20).keys.collect()]


def test_running_is_the_same_when_split(events):
    made = lambda hot_rows: running(
        events,
        ["key"],
        ["ts", "id"],
        sums={"total": "v"},
        maxes={"top": "if(v > 1, v, null)"},
        lasts={"known": "tag"},
        prevs={"before": "tag", "before_ts": "ts"},
        hot_rows=hot_rows,
    )
    assert rows(made(1_000_000)) == rows(made(40))
    assert rows(made(1_000_000)) == rows(made(3))


def test_split_path_spreads_a_hot_key(spark, events, monkeypatch):
    from callmart.operators import ordered

    staged = []
    keep = ordered.stage
    monkeypatch.setattr(ordered, "stage", lambda df, label: staged.append(keep(df, label)) or staged[-1])
    running(events, ["key"], ["ts", "id"], sums={"n": "1"}, hot_rows=40)
    pieces = next(df for df in staged if "_piece" in df.columns)
    biggest = pieces.groupBy("_piece").count().agg(F.max("count")).first()[0]
    assert biggest < events.where("key = 'hot'").count() / 2


def test_lag_rank_asof_are_the_same_when_split(events):
    lag = lambda n: lag_features(events, ["key"], "ts", "id", {"p": "tag", "q": "v"}, hot_rows=n)
    assert rows(lag(1_000_000)) == rows(lag(30))
    rank = lambda n: rank_by_recency(events, ["key"], "ts", "id", "place", hot_rows=n)
    assert rows(rank(1_000_000)) == rows(rank(30))
    states = events.where("tag = 'x'").select("key", F.col("ts").alias("at"), "id", "v")
    asof = lambda n: asof_join(events.select("id", "key", "ts"), states, ["key"], "ts", "at", "id", ["at", "v"], hot_rows=n)
    assert rows(asof(1_000_000)) == rows(asof(30))


def brute(all_rows, back, stop, key, ts):
    lower = None if back is None else ts - back
    midnight = datetime(ts.year, ts.month, ts.day)
    upper = midnight if stop == MIDNIGHT else ts
    inside = [
        r for r in all_rows
        if r[1] == key and (lower is None or r[2] >= lower) and (r[2] < upper if stop == UNTIL else r[2] <= upper)
    ]
    big = [r[2] for r in inside if r[3] > 2]
    return len(inside), sum(r[3] for r in inside), max(big) if big else None


@pytest.mark.parametrize("hot_rows", [1_000_000, 60, 6])
@pytest.mark.parametrize("own", [True, False])
def test_trailing_equals_every_pair(events, hot_rows, own):
    windows = {
        "long": Trailing("21 DAYS"),
        "mid": Trailing("7 DAYS", MIDNIGHT),
        "short": Trailing("3 HOURS", MIDNIGHT),
        "ever": Trailing(None, UNTIL),
    }
    spans = {"long": timedelta(days=21), "mid": timedelta(days=7), "short": timedelta(hours=3), "ever": None}
    outputs = {f"{m}_{w}": (m, w) for w in windows for m in ("n", "s")}
    probes = events if own else events.select("key", "ts")
    got = trailing(
        probes, events, ["key"], "ts", "ts", {"n": "1", "s": "v"}, windows, outputs,
        latest={"last_long": ("if(v > 2, ts, null)", "long"), "last_mid": ("if(v > 2, ts, null)", "mid")},
        hot_rows=hot_rows,
    ).collect()
    data = [tuple(r) for r in events.collect()]
    assert {(r["key"], r["ts"]) for r in got} == {(r[1], r[2]) for r in data}
    assert len(got) == len({(r[1], r[2]) for r in data})
    for r in got:
        for w, window in windows.items():
            n, total, last = brute(data, spans[w], window.stop, r["key"], r["ts"])
            assert (r[f"n_{w}"], r[f"s_{w}"]) == (n, total), (w, r)
            if w in ("long", "mid"):
                assert r[f"last_{w}"] == last


def test_row_index_is_a_global_order(spark):
    data = spark.range(0, 1000, 1, 7).selectExpr("id", "id % 3 as grp", "pmod(hash(id), 10) as score")
    order = [F.col("score").desc(), F.col("id").asc()]
    got = row_index(data, order).collect()
    expected = sorted(got, key=lambda r: (-r["score"], r["id"]))
    assert [r["row_index"] for r in expected] == list(range(1, 1001))
    assert {r["row_total"] for r in got} == {1000}
    by_group = row_index(data, order, ["grp"]).collect()
    for g in range(3):
        mine = sorted((r for r in by_group if r["grp"] == g), key=lambda r: (-r["score"], r["id"]))
        assert [r["row_index"] for r in mine] == list(range(1, len(mine) + 1))
        assert {r["row_total"] for r in mine} == {len(mine)}


SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "2KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4KB",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


@pytest.mark.parametrize("hot", ["7", "null"])
def test_joins_split_a_hot_key_at_run_time(spark, conf, hot):
    """A third of the left rows share one key, present or missing; the right side was just grouped."""
    conf(**SMALL)
    left = spark.range(0, 30000, 1, 12).selectExpr("id", f"if(id % 3 = 0, {hot}, id) as k")
    right = spark.range(0, 30000).selectExpr("id as k", "id as v").groupBy("k").agg(F.max("v").alias("v"))
    for df, plan in (
        (lookup(left, right, ["k"]), "LeftOuter"),
        (restrict_to(left, right, ["k"]), "LeftSemi"),
        (missing_rows(left, right, ["k"]), "LeftAnti"),
    ):
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
        if plan == "LeftSemi" and hot == "null":
            continue  # missing keys are dropped before the shuffle
        assert "skew=true" in final, final
        assert plan in final
    joined = lookup(left, right, ["k"])
    assert joined.count() == 30000
    assert joined.where("v is not null").count() == (20000 if hot == "null" else 30000)
