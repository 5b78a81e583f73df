"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as checks
from callmart.checks.fixtures import CTX, table, view
from callmart.checks.history import DAY_WINDOWS
from callmart.operators.dedupe import latest_per
from callmart.operators.scans import scan_day, scan_range
from callmart.operators.trailing import Trailing
from callmart.plans.call_features import call_features
from callmart.sources import sinks

NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(checks.queries()))
def test_no_pairs_of_everything(spark, folder, conf, name):
    conf(**NO_BROADCAST)
    text = plan(checks.queries()[name](spark, folder))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_day_scans_prune_partitions(spark, folder, tmp_path):
    path = str(tmp_path / "calls")
    sinks.refresh_partitions(view(spark, folder, "fx_calls"), path)
    calls = spark.read.parquet(path)
    for scan in (scan_day(calls, CTX), scan_range(calls, CTX, 14, 1)):
        filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan(scan.select("interaction_id"))).group(1)
        assert "part_date" in filters
        assert re.search(r"ReadSchema: struct<interaction_id:bigint>", plan(scan.select("interaction_id")))


def test_features_of_a_day_prune_every_scan(spark, folder, tmp_path):
    """Each scan of the calls has a day bound, and stored days out of reach change nothing."""
    windows = {w: Trailing(t.back.replace("21", "5").replace("14", "3").replace("7", "2"), t.stop) for w, t in DAY_WINDOWS.items()}
    calls = view(spark, folder, "fx_calls").drop("raw_phone")
    path = str(tmp_path / "calls")
    sinks.refresh_partitions(calls, path)
    stored = spark.read.parquet(path)
    pruned = call_features(stored, CTX, days=1, windows=windows)
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(pruned))
    assert len(filters) >= 3 and all("part_date" in f for f in filters)
    columns = sorted(pruned.columns)
    text = lambda df: sorted(map(str, df.select(columns).collect()))
    whole = call_features(stored, CTX, days=30, windows=windows).where(F.col("partition_date") >= CTX.day_key(1))
    assert text(pruned) == text(whole) != []


def test_latest_row_is_limited_before_the_shuffle(spark, folder):
    text = plan(latest_per(view(spark, folder, "fx_contacts"), ["phone_number"], "modified_ts", "contact_id"))
    assert re.search(r"WindowGroupLimit.*Final.*WindowGroupLimit.*Partial", text, re.S)


def test_ranking_never_gathers_all_rows(spark, folder):
    for name in ("score_bands", "segment_scores", "export_chunks", "score_output"):
        assert "SinglePartition" not in plan(checks.queries()[name](spark, folder))


def test_wide_calls_are_shuffled_once(spark, folder, conf):
    """No exchange above the window of the previous call: every later join finds the rows in place."""
    conf(**NO_BROADCAST)
    for name in ("call_features", "training_frame"):
        text = plan(checks.queries()[name](spark, folder))
        spine = []
        for line in text.splitlines():
            spine.append(line)
            if re.search(r"Window \[lag\(", line):
                break
        depth = lambda line: re.search(r"[A-Za-z]", line).start()
        # Operators on the way from the root to the window are those that end up above it leftmost.
        window = depth(spine[-1])
        path, limit = [], window
        for line in reversed(spine[:-1]):
            if re.search(r"[A-Za-z]", line) and depth(line) < limit:
                path.append(line)
                limit = depth(line)
        assert not [line for line in path if "Exchange" in line], name


def test_trailing_forms_no_pairs(spark, folder, conf):
    conf(**NO_BROADCAST)
    text = plan(checks.queries()["trailing_days"](spark, folder))
    assert text.count("SortMergeJoin") == 1 and "LeftOuter" in text


def test_scans_read_only_what_is_needed(spark, folder):
    text = plan(checks.queries()["product_pivot"](spark, folder))
    assert "l_extendedprice" not in text and "p_name" not in text
    assert table(spark, folder, "lineitem").columns  # the table itself has more


def test_hints_override_the_size_rule(spark, conf):
    from callmart.operators.joins import lookup

    left, dim = spark.range(100).selectExpr("id as k"), spark.range(50).selectExpr("id as k", "id as v")
    conf(**NO_BROADCAST)
    assert "SortMergeJoin" in plan(lookup(left, dim, ["k"]))
    assert "BroadcastHashJoin" in plan(lookup(left, dim, ["k"], hint="broadcast"))
    conf(spark__sql__autoBroadcastJoinThreshold="10MB")
    assert "BroadcastHashJoin" in plan(lookup(left, dim, ["k"]))
    assert "SortMergeJoin" in plan(lookup(left, dim, ["k"], hint="merge"))
