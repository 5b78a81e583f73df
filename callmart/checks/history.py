"""Windows, trailing features, as-of joins, ranking and scoring."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from callmart.checks.fixtures import CTX, table, view
from callmart.checks.registry import OK, check
from callmart.functions.calendar import elapsed
from callmart.functions.phone import pair_key
from callmart.operators import dedupe, history, joins
from callmart.operators.trailing import MIDNIGHT, Trailing, count_before, trailing
from callmart.plans.call_features import WHO_KEY, trailing_features, with_previous_call
from callmart.plans.daily_features import ranked_contacts
from callmart.plans.engagement import message_counts

PAIR = ["phone_number", "cuid"]
TS = "dtime_call_start"

# The data spans 30 days, so the three windows are 21, 14 and 7 days.
DAY_WINDOWS = {"6m": Trailing("21 DAYS"), "3m": Trailing("14 DAYS", MIDNIGHT), "1m": Trailing("7 DAYS", MIDNIGHT)}
MESSAGE_WINDOWS = {"6m": Trailing("21 DAYS"), "3m": Trailing("14 DAYS"), "1m": Trailing("7 DAYS")}


def pairs_sql(calls: str = "fx_calls") -> str:
    """Every call beside the calls of its (phone, client) in the 21 days up to it."""
    return f"""pairs as (select a.interaction_id as id, a.dtime_call_start as at, b.*,
  {OK.replace('talk_duration', 'b.talk_duration').replace('code_call', 'b.code_call')} as ok,
  b.dtime_call_start between a.dtime_call_start - interval 14 days and date_trunc('day', a.dtime_call_start) as in_14,
  b.dtime_call_start between a.dtime_call_start - interval 7 days and date_trunc('day', a.dtime_call_start) as in_7
  from {calls} a join {calls} b on a.phone_number = b.phone_number and a.cuid is not distinct from b.cuid
  and b.dtime_call_start between a.dtime_call_start - interval 21 days and a.dtime_call_start)"""


COUNTS_SQL = """count(*) as cnt_calls_6m, count(*) filter (where in_14) as cnt_calls_3m, count(*) filter (where in_7) as cnt_calls_1m,
  count(*) filter (where ok) as cnt_successful_calls_6m, count(*) filter (where ok and in_14) as cnt_successful_calls_3m,
  count(*) filter (where ok and in_7) as cnt_successful_calls_1m"""
AVERAGES_SQL = """avg(if(ok and day_part = 'Morning', talk_duration, 0)) as avg_talk_morning_6m,
  avg(if(ok and day_part = 'Afternoon', talk_duration, 0)) as avg_talk_afternoon_6m,
  avg(if(ok and day_part = 'Evening', talk_duration, 0)) as avg_talk_evening_6m,
  avg(talk_duration) filter (where ok) as avg_talk_6m, avg(talk_duration) filter (where ok and in_14) as avg_talk_3m,
  avg(talk_duration) filter (where ok and in_7) as avg_talk_1m"""


def per_call(spark, folder, columns):
    calls = view(spark, folder, "fx_calls").withColumn(WHO_KEY, pair_key())
    features = trailing_features(calls, [WHO_KEY], DAY_WINDOWS)
    return joins.lookup(calls, features, [WHO_KEY, TS]).select("interaction_id", *columns)


@check("trailing_days", f"select id as interaction_id, {COUNTS_SQL} from pairs group by id", pairs_sql())
def trailing_days(spark, folder):
    return per_call(spark, folder, [f"cnt_{s}calls_{w}" for s in ("", "successful_") for w in DAY_WINDOWS])


@check("trailing_avgs", f"select id as interaction_id, {AVERAGES_SQL} from pairs group by id", pairs_sql())
def trailing_avgs(spark, folder):
    parts = [f"avg_talk_{p}_6m" for p in ("morning", "afternoon", "evening")]
    return per_call(spark, folder, [*parts, *[f"avg_talk_{w}" for w in DAY_WINDOWS]])


@check(
    "trailing_months",
    """select a.o_orderkey, count(*) as cnt_6m,
    count(*) filter (where b.o_orderdate between a.o_orderdate - interval 3 months and date_trunc('day', a.o_orderdate)) as cnt_3m,
    count(*) filter (where b.o_orderdate between a.o_orderdate - interval 1 month and date_trunc('day', a.o_orderdate)) as cnt_1m,
    count(*) filter (where b.o_orderstatus = 'F') as ok_6m,
    max(b.o_orderdate) filter (where b.o_orderstatus = 'F') as last_ok
    from orders a join orders b on a.o_custkey = b.o_custkey and b.o_orderdate between a.o_orderdate - interval 6 months and a.o_orderdate
    group by a.o_orderkey""",
)
def trailing_months(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    features = trailing(
        orders, orders, ["o_custkey"], "o_orderdate", "o_orderdate",
        sums={"n": "1", "ok": "if(o_orderstatus = 'F', 1, 0)"},
        windows={"6": Trailing("6 MONTHS"), "3": Trailing("3 MONTHS", MIDNIGHT), "1": Trailing("1 MONTH", MIDNIGHT)},
        outputs={"cnt_6m": ("n", "6"), "cnt_3m": ("n", "3"), "cnt_1m": ("n", "1"), "ok_6m": ("ok", "6")},
        latest={"last_ok": ("if(o_orderstatus = 'F', o_orderdate, null)", "6")},
    )
    return joins.attach(orders, features, ["o_custkey", "o_orderdate"]).select("o_orderkey", *[c for c in features.columns if not c.startswith("o_")])


@check(
    "trailing_other",
    """select a.o_orderkey, count(l.l_shipdate) as shipped_12m from orders a left join
    (select o_custkey, l_shipdate from lineitem join orders on l_orderkey = o_orderkey) l
    on l.o_custkey = a.o_custkey and l.l_shipdate between a.o_orderdate - interval 12 months and a.o_orderdate group by a.o_orderkey""",
)
def trailing_other(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    shipped = joins.lookup(
        table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate"), orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"], how="inner"
    )
    counted = trailing(
        orders, shipped, ["o_custkey"], "o_orderdate", "l_shipdate",
        sums={"n": "1"}, windows={"year": Trailing("12 MONTHS")}, outputs={"shipped_12m": ("n", "year")},
    )
    return joins.attach(orders, counted, ["o_custkey", "o_orderdate"]).select("o_orderkey", "shipped_12m")


@check(
    "trailing_messages",
    """select c.interaction_id, count(m.input_date) as cnt_push_6m,
    count(*) filter (where m.input_date >= c.dtime_call_start - interval 14 days) as cnt_push_3m,
    count(*) filter (where m.input_date >= c.dtime_call_start - interval 7 days) as cnt_push_1m
    from fx_calls c left join fx_messages m on m.cuid = c.cuid
    and m.input_date between c.dtime_call_start - interval 21 days and c.dtime_call_start group by c.interaction_id""",
)
def trailing_messages(spark, folder):
    calls = view(spark, folder, "fx_calls").select("interaction_id", "cuid", TS)
    messages = view(spark, folder, "fx_messages").select("cuid", "input_date")
    counted = message_counts(calls, messages, "cuid", "input_date", "cnt_push", MESSAGE_WINDOWS)
    out = joins.attach(calls, counted, ["cuid", TS])
    return out.na.fill(0).select("interaction_id", *[f"cnt_push_{w}" for w in MESSAGE_WINDOWS])


@check(
    "theta_before",
    """select a.o_orderkey, count(l.l_shipdate) as shipped_before from orders a left join
    (select o_custkey, l_shipdate from lineitem join orders on l_orderkey = o_orderkey) l
    on l.o_custkey = a.o_custkey and l.l_shipdate < a.o_orderdate group by a.o_orderkey""",
)
def theta_before(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    shipped = joins.lookup(
        table(spark, folder, "lineitem").select("l_orderkey", "l_shipdate"), orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"], how="inner"
    )
    counted = count_before(
        orders, shipped, ["o_custkey"], "o_orderdate", "l_shipdate", {"shipped_before": "l_shipdate is not null"}
    )
    return joins.attach(orders, counted, ["o_custkey", "o_orderdate"]).select("o_orderkey", "shipped_before")


@check(
    "trailing_amounts",
    """select a.o_orderkey, cast(sum(cast(b.o_totalprice as decimal(18, 2))) as double) as amount from orders a join orders b
    on b.o_custkey = a.o_custkey and b.o_orderdate between a.o_orderdate - interval 300 days and a.o_orderdate group by a.o_orderkey""",
)
def trailing_amounts(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("at"), F.col("o_totalprice").cast("decimal(18,2)").alias("price")
    )
    summed = trailing(
        orders, orders, ["o_custkey"], "at", "at", {"price": "price"}, {"w": Trailing("300 DAYS")}, {"amount": ("price", "w")}
    )
    found = joins.attach(orders, summed, ["o_custkey", "at"])
    return found.select("o_orderkey", F.col("amount").cast("double").alias("amount"))


@check(
    "asof_join",
    """select a.o_orderkey, s.at as state_at, s.price as state_price from orders a left join lateral
    (select o_orderdate as at, o_totalprice as price from orders b where b.o_custkey = a.o_custkey and b.o_orderpriority = '1-URGENT'
     and b.o_orderdate <= a.o_orderdate order by o_orderdate desc, o_orderkey desc limit 1) s on true""",
)
def asof_join(spark, folder):
    orders = table(spark, folder, "orders")
    states = orders.where("o_orderpriority = '1-URGENT'").select(
        "o_custkey", F.col("o_orderdate").alias("state_at"), F.col("o_totalprice").alias("state_price"), F.col("o_orderkey").alias("tie")
    )
    asked = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    out = history.asof_join(asked, states, ["o_custkey"], "o_orderdate", "state_at", "tie", ["state_at", "state_price"])
    return out.select("o_orderkey", "state_at", "state_price")


@check(
    "lag_features",
    f"""select interaction_id, call_result, lag(dtime_call_start) over w as last_dtime_call, lag(code_call_result_type) over w as last_code_call_result_type,
    lag(interaction_type_code) over w as last_interaction_type_code, lag(call_result) over w as last_call_result
    from (select *, {OK}::int as call_result from fx_calls)
    window w as (partition by phone_number, cuid order by dtime_call_start, interaction_id)""",
)
def lag_features(spark, folder):
    return with_previous_call(view(spark, folder, "fx_calls")).select(
        "interaction_id", "call_result", "last_dtime_call", "last_code_call_result_type", "last_interaction_type_code", "last_call_result"
    )


@check(
    "elapsed",
    """select interaction_id, date_diff('day', p, t)::int as days, (epoch(date_trunc('second', t)) - epoch(date_trunc('second', p)))::bigint as seconds,
    (epoch(date_trunc('second', t)) - epoch(date_trunc('second', p))) / 60.0 as minutes,
    (epoch(date_trunc('second', t)) - epoch(date_trunc('second', p))) / 3600.0 as hours
    from (select interaction_id, dtime_call_start as t, lag(dtime_call_start) over (partition by phone_number, cuid order by dtime_call_start, interaction_id) as p
    from fx_calls)""",
)
def elapsed_since(spark, folder):
    calls = with_previous_call(view(spark, folder, "fx_calls"))
    return calls.select(
        "interaction_id", *[elapsed("last_dtime_call", TS, u).alias(u) for u in ("days", "seconds", "minutes", "hours")]
    )


def _nth_contact(order: str) -> str:
    return f"""select contact_id, phone_number, modified_ts from (select *, row_number() over
    (partition by phone_number order by {order}) as n from fx_contacts) where n = 1"""


@check("latest_per", _nth_contact("modified_ts desc, contact_id desc"))
def latest_per(spark, folder):
    newest = dedupe.latest_per(view(spark, folder, "fx_contacts"), ["phone_number"], "modified_ts", "contact_id")
    return newest.select("contact_id", "phone_number", "modified_ts")


@check("first_per", _nth_contact("modified_ts, contact_id"))
def first_per(spark, folder):
    oldest = dedupe.first_per(view(spark, folder, "fx_contacts"), ["phone_number"], "modified_ts", "contact_id")
    return oldest.select("contact_id", "phone_number", "modified_ts")


@check(
    "rank_recency",
    """select contact_id, phone_number, row_number() over (partition by phone_number order by modified_ts desc, contact_id desc) as status_last
    from fx_contacts""",
)
def rank_recency(spark, folder):
    return ranked_contacts(view(spark, folder, "fx_contacts")).select("contact_id", "phone_number", "status_last")


# A closed-form stand-in for a trained model: any scorer can take its place.
WEIGHTS = {
    "past_days_last_call": -0.03,
    "cnt_success_sms_6m": 0.05,
    "rate_connect_monday": 0.4,
    "rate_connect_friday": 0.3,
    "rate_connect_tuesday": 0.5,
    "rate_connect_thursday": 0.2,
    "cnt_in_calls_6m": 0.06,
    "rate_connect_wednesday": 0.35,
    "rate_connect_sunday": 0.15,
    "rate_connect_saturday": 0.1,
    "pif_phone_type_code": 0.02,
    "weekday": -0.01,
}
INTERCEPT = -0.5
MOBILE_WEIGHTS = {"past_days_last_call": -0.05, "rate_connect_mor": 0.7, "cnt_in_calls_6m": 0.1}


def loader(weights: dict[str, float], intercept: float):
    """A loader as ``score`` wants it: returns a predict function over batches of features.

    A closure travels to the executors whole; a model of your own is best loaded from a file that
    every executor can read.
    """

    def load():
        by_name = pd.Series(weights)

        def predict(batch: pd.DataFrame) -> pd.Series:
            z = intercept + (batch[list(weights)].astype("float64") * by_name).sum(axis=1)
            return 1.0 / (1.0 + np.exp(-z))

        return predict

    return load


def score_sql(weights: dict, intercept: float = 0.0) -> str:
    return f"1.0 / (1.0 + exp(-({intercept} + " + " + ".join(f"{n} * ({w})" for n, w in weights.items()) + ")))"
