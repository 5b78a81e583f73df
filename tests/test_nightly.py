"""Three nights in a row, one of them run twice."""

from datetime import datetime

from pyspark.sql import functions as F

from callmart.checks.fixtures import view
from callmart.checks.pipelines import RAW
from callmart.context import RunContext
from callmart.operators.dedupe import latest_per
from callmart.operators.scoring import logistic
from callmart.plans import nightly
from callmart.plans.call_log import first_source
from callmart.plans.daily_features import COMMENTS, phone_type_rows
from callmart.plans.schemas import CALL_LOG


def test_nights(spark, folder, tmp_path):
    root = str(tmp_path)
    tables = {name: view(spark, folder, v) for name, v in RAW.items()}
    contacts = view(spark, folder, "fx_contacts")
    known = contacts.withColumnRenamed("external_id", "cuid")
    roles = latest_per(view(spark, folder, "cl_role"), ["id"], "modified_ts", "role_tie")
    scorer = logistic({"cnt_in_calls_6m": 0.2, "past_days_last_call": -0.1})
    for day in (28, 29, 29, 30):
        ctx = RunContext(datetime(2024, 1, day))
        nightly.refresh_calls(tables, ctx, root)
        log = nightly.kept_log(spark, tables, known, ctx, root)
        published = nightly.refresh_features(spark, log, known, phone_type_rows(contacts, roles), view(spark, folder, "fx_messages"), ctx, root)
        nightly.score_night(spark, scorer, ctx, root, clock=lambda: ctx.as_of)

    assert published.columns == list(COMMENTS)
    ctx = RunContext(datetime(2024, 1, 30))
    stored = spark.read.schema(CALL_LOG).parquet(f"{root}/calls")
    assert {r["part_date"] for r in stored.select("part_date").distinct().collect()} == {20240127, 20240128, 20240129}
    whole = first_source(tables, ctx, 3, 1)
    assert stored.count() == whole.count() > 0
    assert stored.exceptAll(whole).count() == 0

    features = spark.read.parquet(f"{root}/daily_features")
    assert features.select("phone_number", "cuid").distinct().count() == features.count()
    days = {r["part_date"]: r["count"] for r in spark.read.parquet(f"{root}/scores").groupBy("part_date").count().collect()}
    assert set(days) == {20240128, 20240129, 20240130} and days[20240130] == features.where(F.length("phone_number").isin(10, 11)).count()

    runs = spark.read.parquet(f"{root}/runs")
    assert {(r["run_id"], r["status"]): r["count"] for r in runs.groupBy("run_id", "status").count().collect()} == {
        (str(d), s): 2 if d == 20240129 else 1 for d in (20240128, 20240129, 20240130) for s in ("STARTED", "FINISHED")
    }
    last = runs.where("run_id = '20240130' and status = 'FINISHED'").first()
    assert (last["source_rows"], last["target_rows"]) == (features.count(), days[20240130])
    assert last["max_source_date"] == stored.agg(F.max("dtime_call_start")).first()[0]
