"""Windows of a fixed length multiply no rows, give the values of window ends, and shuffle narrow rows once."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from callmart.checks.fixtures import CTX, view
from callmart.checks.pipelines import CLIENTS
from callmart.operators.ordered import Hot
from callmart.operators.trailing import MIDNIGHT, UNTIL, Trailing, trailing
from callmart.plans.client_attributes import client_attributes

DAYS = {"long": Trailing("21 DAYS"), "mid": Trailing("2 DAYS", MIDNIGHT), "short": Trailing("3 HOURS", MIDNIGHT), "before": Trailing(None, UNTIL)}
NONE_HOT = Hot(None, 0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    start = datetime(2024, 1, 1)
    # Midnights, instants one microsecond beside them, copies, and a missing key.
    at = [start + timedelta(hours=h, microseconds=m) for h in range(0, 24 * 4, 6) for m in (-1, 0, 0, 1)]
    rows = [(k, t, i % 5) for k in ("a", None) for i, t in enumerate(at)]
    return spark.createDataFrame(rows, "key string, ts timestamp_ntz, v int")


def swept(probes, events, windows):
    outputs = {f"{s}_{w}": (s, w) for w in windows for s in ("n", "s")}
    latest = {f"last_{w}": ("if(v > 2, ts, null)", w) for w in windows}
    return trailing(probes, events, ["key"], "ts", "ts", {"n": "1", "s": "v"}, windows, outputs, latest, hot=NONE_HOT)


@pytest.mark.parametrize("own", [True, False])
def test_every_instant_against_all_events(events, own):
    got = swept(events if own else events.select("key", "ts"), events, DAYS)
    text = plan(got)
    assert "Generate" not in text and text.count("Exchange hashpartitioning") == 1
    data = [tuple(r) for r in events.collect()]
    found = got.collect()
    assert len(found) == len({(k, t) for k, t, _ in data})
    spans = {"long": timedelta(days=21), "mid": timedelta(days=2), "short": timedelta(hours=3)}
    for r in found:
        midnight = datetime.combine(r["ts"].date(), datetime.min.time())
        for w, window in DAYS.items():
            upto = midnight if window.stop == MIDNIGHT else r["ts"]
            inside = [
                (t, v) for k, t, v in data
                if k == r["key"] and (t < upto if window.stop == UNTIL else t <= upto) and (w == "before" or t >= r["ts"] - spans[w])
            ]
            newest = max((t for t, v in inside if v > 2), default=None)
            assert (r[f"n_{w}"], r[f"s_{w}"], r[f"last_{w}"]) == (len(inside), sum(v for _, v in inside), newest), (w, r)


def test_lookups_are_filtered_before_they_are_ranked(spark, folder):
    calls = view(spark, folder, "fx_calls").where(F.col("cuid") == 3)
    tables = {name: view(spark, folder, v) for name, v in CLIENTS.items()}
    assert "_word_0" in plan(client_attributes(calls, tables, CTX))
