"""Features of a day from the stored table of days: the same as from all calls."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.operators.trailing import MIDNIGHT, Trailing
from callmart.plans.call_features import call_features
from callmart.plans.day_table import backfill_day_rows, day_rows, features_of_day, window_starts, write_day_rows
from callmart.sources.sinks import refresh_partitions

COLUMNS = (
    "interaction_id long, cuid long, phone_number string, dtime_call_start timestamp_ntz, dtime_call_end timestamp_ntz, weekday string,"
    " day_part string, talk_duration long, interaction_type_code string, code_call_result_type string, part_date int"
)
MONTHS = {"6m": Trailing("6 MONTHS"), "3m": Trailing("3 MONTHS", MIDNIGHT), "1m": Trailing("1 MONTH", MIDNIGHT)}


def made(spark, last: datetime, n=600, seed=1):
    """Calls of most of a year: few pairs, missing phones and clients, ties, midnights, and calls stored some days late."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        back = rng.choice([0, 0, 0, 1, 2, rng.randrange(400), *[30 * m + rng.randrange(-2, 3) for m in (1, 3, 6)]])
        ts = last - timedelta(days=max(0, back)) + timedelta(hours=rng.choice([0, 0, 9, 14, 20]), minutes=rng.choice([0, 0, 30]))
        stored = ts + timedelta(days=rng.choice([0] * 8 + [1, 6]))
        rows.append(
            (
                i, rng.choice([1, 2, None]), rng.choice(["a", "b", None]), ts, ts + timedelta(minutes=rng.randrange(3)), ts.strftime("%A"),
                rng.choice(["Morning", "Afternoon", "Evening", "Night"]), rng.choice([None, 0, 5, 60]), rng.choice(["INBOUND", "OUTBOUND", None]),
                rng.choice(["ANSWER", "BUSY", None]), int(stored.strftime("%Y%m%d")),
            )
        )
    rows.append((n, 1, "a", None, None, None, None, 3, None, None, int(last.strftime("%Y%m%d"))))
    return spark.createDataFrame(rows, COLUMNS)


def text(df, columns):
    return sorted(map(str, df.select(columns).collect()))


@pytest.mark.parametrize("last", [datetime(2024, 8, 31), datetime(2024, 2, 29)])
def test_a_day_equals_all_calls(spark, tmp_path, last):
    """Also where months are clamped at their end."""
    ctx = RunContext(last + timedelta(days=1))
    path = str(tmp_path)
    refresh_partitions(made(spark, last), f"{path}/calls")
    calls = spark.read.parquet(f"{path}/calls")
    backfill_day_rows(calls, f"{path}/days")
    got = features_of_day(calls, spark.read.parquet(f"{path}/days"), ctx, MONTHS)
    whole = call_features(calls, ctx, days=1, windows=MONTHS).where(F.col("dtime_call_start") < ctx.as_of)
    columns = sorted(whole.columns)
    assert columns == sorted(got.columns)
    assert text(got, columns) == text(whole, columns) != []


def test_three_nights_equal_one_backfill(spark, tmp_path):
    last, path = datetime(2024, 5, 31), str(tmp_path)
    calls = made(spark, last, seed=2)
    # Calls that a night could not have had yet are left out: each is stored on its own day.
    calls = calls.where("dtime_call_start is not null").withColumn("part_date", F.date_format("dtime_call_start", "yyyyMMdd").cast("int"))
    refresh_partitions(calls, f"{path}/calls")
    stored = spark.read.parquet(f"{path}/calls")
    first = RunContext(last - timedelta(days=1))
    backfill_day_rows(stored.where(F.col("part_date") < first.day_key(1)), f"{path}/days")
    nights: set[str] = set()
    for k in (1, 0, 0, -1):  # one night runs twice
        ctx = RunContext(last - timedelta(days=k))
        known = stored.where(F.col("part_date") <= ctx.day_key(1))
        write_day_rows(known, ctx, f"{path}/days")
        got = features_of_day(known, spark.read.parquet(f"{path}/days"), ctx, MONTHS)
        columns = sorted(got.columns)
        nights.update(text(got, columns))
    ctx = RunContext(last + timedelta(days=1))
    whole = call_features(stored, ctx, days=3, windows=MONTHS)
    assert sorted(nights) == text(whole, columns) != []
    # What the nights wrote is what a backfill writes.
    table = spark.read.parquet(f"{path}/days")
    assert text(table, sorted(table.columns)) == text(day_rows(stored), sorted(table.columns))


def test_reads_few_days_of_calls(spark, tmp_path):
    """Of the calls only days near a window's end are read."""
    last, path = datetime(2024, 5, 31), str(tmp_path)
    refresh_partitions(made(spark, last, seed=3), f"{path}/calls")
    calls = spark.read.parquet(f"{path}/calls")
    backfill_day_rows(calls, f"{path}/days")
    got = features_of_day(calls, spark.read.parquet(f"{path}/days"), RunContext(last + timedelta(days=1)), MONTHS)
    scans = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line or "Location" in line]
    of_calls = [line for line in scans if "/calls]" in line]
    assert of_calls and all("PartitionFilters: [" in line and "part_date" in line.split("PartitionFilters")[1] for line in of_calls)


def test_windows_begin_on_one_day(spark):
    calls = made(spark, datetime(2024, 8, 31), 3)
    assert window_starts(datetime(2024, 8, 31).date(), MONTHS, calls)["6 MONTHS"] == datetime(2024, 2, 29).date()
    with pytest.raises(ValueError, match="less than a day"):
        window_starts(datetime(2024, 8, 31).date(), {"h": Trailing("3 HOURS")}, calls)


def test_nights_store_call_features(spark, folder, tmp_path):
    """The nightly mart: each night adds its day, and two nights hold what all stored calls give."""
    from callmart.checks.fixtures import view
    from callmart.checks.history import DAY_WINDOWS
    from callmart.checks.pipelines import RAW
    from callmart.plans import nightly

    root = str(tmp_path)
    tables = {name: view(spark, folder, v) for name, v in RAW.items()}
    known = view(spark, folder, "fx_contacts").withColumnRenamed("external_id", "cuid")
    first = RunContext(datetime(2024, 1, 29))
    for back in range(4, 0, -1):
        nightly.refresh_calls(tables, RunContext(first.as_of - timedelta(days=back)), root)
    nightly.refresh_calls(tables, first, root)
    before = nightly.kept_log(spark, tables, known, first, root)
    backfill_day_rows(before.where(F.col("part_date") < first.day_key(1)), f"{root}/{nightly.CALL_DAYS}")
    for day in (29, 30):
        ctx = RunContext(datetime(2024, 1, day))
        nightly.refresh_calls(tables, ctx, root)
        nightly.refresh_call_features(spark, tables, known, ctx, root, DAY_WINDOWS)
    stored = spark.read.parquet(f"{root}/{nightly.CALL_FEATURES}")
    assert {r[0] for r in stored.select("partition_date").distinct().collect()} == {20240128, 20240129}
    ctx = RunContext(datetime(2024, 1, 30))
    whole = call_features(nightly.kept_log(spark, tables, known, ctx, root), ctx, days=2, windows=DAY_WINDOWS)
    columns = sorted(whole.columns)
    assert text(stored, columns) == text(whole.where(F.col("dtime_call_start") < ctx.as_of), columns) != []
