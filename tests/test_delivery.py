"""Slices loaded once each, days published whole, tables laid out by key, and counts of what was written."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callmart.checks.pipelines import file_ranges
from callmart.context import RunContext
from callmart.operators import delivery
from callmart.operators.scoring import logistic
from callmart.plans import nightly
from callmart.plans.scores import write_counted_scores, write_monthly
from callmart.sources import published, sinks


@pytest.fixture(scope="module")
def order(spark):
    return [F.col("score").desc(), F.col("k").asc()]


def loads_of(path, broken_at=None):
    seen = []
    inner = delivery.to_folder(path)

    def load(rows, chunk_no):
        seen.append(chunk_no)
        if len(seen) == broken_at:
            # Half of the slice is there when the connection goes.
            inner(rows.limit(3), chunk_no)
            raise ConnectionError("lost")
        inner(rows, chunk_no)

    return load, seen


def test_a_rerun_loads_what_is_missing(spark, tmp_path, order):
    rows = spark.range(0, 1000, 1, 5).selectExpr("id as k", "pmod(hash(id), 50) as score")
    ledger, target = str(tmp_path / "ledger"), str(tmp_path / "target")
    load, seen = loads_of(target, broken_at=3)
    with pytest.raises(ConnectionError):
        delivery.deliver(rows, order, 300, ["k"], load, ledger, "x")
    assert seen == [0, 1, 2]
    load, seen = loads_of(target)
    assert delivery.deliver(rows.repartition(3), order, 300, ["k"], load, ledger, "x") == 2 and seen == [2, 3]
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == list(range(1000))
    assert delivery.deliver(rows, order, 300, ["k"], load, ledger, "x") == 0
    # Another export has slices of its own.
    assert delivery.deliver(rows, order, 300, ["k"], load, ledger, "y") == 4


def test_changed_slices_are_loaded_again(spark, tmp_path, order):
    rows = spark.range(0, 100).selectExpr("id as k", "-id as score")
    ledger, target = str(tmp_path / "ledger"), str(tmp_path / "target")
    load, seen = loads_of(target)
    delivery.deliver(rows, order, 30, ["k"], load, ledger, "x")
    changed = rows.withColumn("k", F.when(F.col("k") == 45, 1045).otherwise(F.col("k")))
    assert delivery.deliver(changed, order, 30, ["k"], load, ledger, "x") == 1
    assert seen == [0, 1, 2, 3, 1]
    assert delivery.deliver(rows.limit(0), order, 30, ["k"], load, ledger, "x") == 0


def test_small_slices_are_loaded_together(spark, tmp_path, order):
    """100 slices take a few loads; a load that fails half way is repeated whole, and nothing doubles."""
    rows = spark.range(0, 1000, 1, 5).selectExpr("id as k", "pmod(hash(id), 50) as score")
    ledger, target, seen = str(tmp_path / "ledger"), str(tmp_path / "target"), []
    inner = delivery.to_folders(target)

    def load(part, numbers):
        seen.append(numbers)
        assert {r[0] for r in part.select("chunk_no").distinct().collect()} == set(numbers)
        if len(seen) == 3:
            inner(part.limit(13), numbers)
            raise ConnectionError("lost")
        inner(part, numbers)

    with pytest.raises(ConnectionError):
        delivery.deliver_together(rows, order, 10, ["k"], load, ledger, "x", most=32)
    assert seen == [[0], [1, 2], [3, 4, 5, 6]]
    assert delivery.deliver_together(rows.repartition(3), order, 10, ["k"], load, ledger, "x", most=32) == 97
    assert [len(n) for n in seen[3:]] == [1, 2, 4, 8, 16, 32, 32, 2] and sum(seen[3:], []) == list(range(3, 100))
    there = spark.read.parquet(target)
    assert sorted(r["k"] for r in there.collect()) == list(range(1000))
    loaded = delivery.read_ledger(spark, ledger).select("chunk_no", "rows", "key_hash")
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, delivery.slice_plan(there, ["k"]).collect()))
    assert delivery.deliver_together(rows, order, 10, ["k"], load, ledger, "x") == 0
    # Entries of both ways of delivery are the same.
    assert delivery.deliver(rows, order, 10, ["k"], lambda *_: None, ledger, "x") == 0


def published_rows(spark, path):
    return sorted((r["part_date"], r["v"]) for r in published.read_published(spark, path).collect())


def test_readers_see_whole_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)
    published.publish_days({1: rows(1, 2), 2: rows(3)}, path)
    assert published_rows(spark, path) == [(1, 1), (1, 2), (2, 3)]
    # A writer that dies with its files written and its manifest not.
    before = published.read_published(spark, path)
    monkeypatch.setattr(published, "_swap", lambda *_: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        published.publish_days({1: rows(7), 2: rows(8)}, path)
    monkeypatch.undo()
    assert published_rows(spark, path) == [(1, 1), (1, 2), (2, 3)]
    # A reader keeps what it has listed while a day is replaced; the day before stays.
    published.publish_days({2: rows(9)}, path)
    assert sorted(r["v"] for r in before.collect()) == [1, 2, 3]
    assert published_rows(spark, path) == [(1, 1), (1, 2), (2, 9)]
    published.publish_days({1: rows()}, path)
    assert published_rows(spark, path) == [(2, 9)]


def test_two_writers_keep_each_others_days(spark, tmp_path, monkeypatch):
    """The other writer swaps between this one's look at the manifests and its own swap."""
    path = str(tmp_path / "t")
    rows = lambda v: spark.createDataFrame([(v,)], "v int")
    published.publish_days({1: rows(1)}, path)
    newest, once = published._newest, []

    def interrupted(folder):
        found = newest(folder)
        if not once:
            once.append(1)
            published.publish_days({2: rows(2)}, path)
        return found

    monkeypatch.setattr(published, "_newest", interrupted)
    published.publish_days({3: rows(3)}, path)
    assert published_rows(spark, path) == [(1, 1), (2, 2), (3, 3)]


def test_unnamed_attempts_are_cleared(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda v: spark.createDataFrame([(v,)], "v int")
    for v in range(4):
        published.publish_days({1: rows(v)}, path)
    assert published.clear_attempts(spark, path, kept=2) == 2
    assert published_rows(spark, path) == [(1, 3)]
    plan = published.read_published(spark, path).where("part_date = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_date" in plan


def test_files_hold_ranges(spark, tmp_path, conf):
    """Half of the rows on one key: its range is cut by what is sorted behind it."""
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rows = spark.range(0, 4000, 1, 8).selectExpr("id % 2 as d", "if(id % 4 < 2, 7, id % 100) as k", "id").repartition(6)
    plain, clustered = str(tmp_path / "a"), str(tmp_path / "b")
    sinks.rebuild(rows, plain, ["d"], ["k", "id"])
    sinks.rebuild(rows, clustered, ["d"], ["k", "id"], cluster=True)
    before, after = (file_ranges(spark.read.parquet(p), "d", ["k", "id"]).first() for p in (plain, clustered))
    assert before["overlaps"] > 0 and tuple(after) == (4000, 0, 0)
    files = spark.read.parquet(clustered).groupBy(F.col("_metadata.file_path")).count()
    assert files.count() >= 8 and files.agg(F.max("count")).first()[0] < 1500


def test_bucketed_tables_join_in_place(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    rows = spark.range(0, 2000).selectExpr("cast(id % 300 as string) as phone", "id % 7 as cuid", "id as v")
    try:
        for name in ("bucketed_a", "bucketed_b"):
            sinks.rebuild_bucketed(rows, name, ["phone", "cuid"], 8)
        a, b = spark.table("bucketed_a"), spark.table("bucketed_b").groupBy("phone", "cuid").agg(F.sum("v").alias("s"))
        joined = a.join(b, ["phone", "cuid"])
        joined.collect()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 2000
    finally:
        for name in ("bucketed_a", "bucketed_b"):
            spark.sql(f"drop table if exists {name}")


@pytest.fixture
def daily(spark):
    """A feature table with phones that are no phones, and missing values."""
    from callmart.fixed_values import DAILY_MODEL_FEATURES

    names = [n for n in DAILY_MODEL_FEATURES if n != "pif_phone_type_code"]
    rows = spark.range(0, 200, 1, 4).selectExpr("if(id % 10 = 0, '12', cast(7000000000 + id as string)) as phone_number", "if(id % 7 = 0, null, id) as cuid", "id")
    rows = rows.selectExpr("phone_number", "cuid", "if(id % 3 = 0, 9, 2) as pif_phone_type_code", *[f"if(id % 11 = 0, null, cast(id % 5 as double)) as {n}" for n in names])
    return rows


def test_counts_of_the_stored_tables(spark, daily, tmp_path):
    ctx = RunContext(datetime(2024, 1, 31))
    read, written = write_counted_scores(daily, logistic({"weekday": 0.1}), ctx, str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert (read, written) == (daily.count(), stored.count()) == (200, 180)


def test_segments_have_tables_of_their_own(spark, daily, tmp_path):
    ctx = RunContext(datetime(2024, 1, 31))
    segments = {
        "all": (F.lit(True), logistic({"cnt_in_calls_6m": 0.2, "weekday": 0.1}), ["cnt_in_calls_6m", "weekday"]),
        "primary": (F.col("pif_phone_type_code") == 9, logistic({"cnt_in_calls_6m": -0.3}), ["cnt_in_calls_6m"]),
    }
    for _ in range(2):
        write_monthly(daily, segments, ctx, str(tmp_path))
    both = {s: spark.read.parquet(str(tmp_path / s)) for s in segments}
    assert {s: t.count() for s, t in both.items()} == {"all": 180, "primary": daily.where("pif_phone_type_code = 9 and length(phone_number) = 10").count()}
    for table in both.values():
        assert table.columns == ["PHONE_NUMBER", "ID_CUID", "DATE_", "SCORE", "SK_DATE_SCORE", "SCORE_GROUP", "SK_DTIME_SCORE", "part_date"]
        assert table.where("SCORE is null or ID_CUID is null").count() == 0
        assert {r[0] for r in table.select("SCORE_GROUP").distinct().collect()} == set(range(1, 11))


def test_scores_are_delivered_once(spark, daily, tmp_path):
    ctx, root = RunContext(datetime(2024, 1, 31)), str(tmp_path)
    sinks.rebuild(daily.where("cuid is not null"), f"{root}/daily_features")
    write_counted_scores(spark.read.parquet(f"{root}/daily_features"), logistic({"weekday": 0.1}), ctx, f"{root}/scores")
    load, seen = loads_of(f"{root}/out", broken_at=2)
    with pytest.raises(ConnectionError):
        nightly.deliver_scores(spark, load, ctx, root, size=50)
    assert nightly.deliver_scores(spark, load, ctx, root, size=50) == 3
    assert seen == [0, 1, 1, 2, 3]
    out, scores = spark.read.parquet(f"{root}/out"), spark.read.parquet(f"{root}/scores")
    assert out.count() == scores.count() == out.select("PHONE_NUMBER", "ID_CUID").distinct().count()
    # Scores of another feature table are not delivered.
    sinks.rebuild(daily.where("cuid > 50"), f"{root}/daily_features")
    with pytest.raises(ValueError, match="missing_in_source"):
        nightly.deliver_scores(spark, load, ctx, root, size=50)
