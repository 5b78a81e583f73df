"""The training frame: every feature of a call, with its outcome as the label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.functions.phone import pair_key
from callmart.operators.joins import lookup
from callmart.operators.ordered import HOT_ROWS, find_hot
from callmart.operators.trailing import Trailing
from callmart.plans.call_features import LOOSE_DAYS, WHO_KEY, call_features, reach, stored_since
from callmart.plans.call_features import WINDOWS as CALL_WINDOWS
from callmart.plans.client_attributes import PAIR, client_attributes
from callmart.plans.engagement import (
    ALERT_SPAN,
    MOMENTS,
    TS,
    WINDOWS,
    engagement,
    records_at,
    since_last_call,
    with_records,
)
from callmart.session import stage

# Keys of the messages and cases of a call, beside its phone.
MOMENT = ["id_cuid", "skp_client"]


def training_frame(
    calls: DataFrame,
    clients: Mapping[str, DataFrame],
    contacts_made: Mapping[str, DataFrame],
    ctx: RunContext,
    days: int = 180,
    call_windows: Mapping[str, Trailing] | None = None,
    message_windows: Mapping[str, Trailing] = WINDOWS,
    alert_span: str = ALERT_SPAN,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Call features, client attributes and engagement joined; ``call_result`` is the label.

    The wide call rows are shuffled once, by phone and client: everything is joined to them by
    that key, or by it and the time of the call. Only when a pair is too big for one task do the
    joins shuffle anew.

    The calls are counted by pair once. What does not depend on the time of a call (attributes, and the client's vehicle,
    device and alerts) is found for the pairs and tested at each call in place.
    """
    pairs = counted_pairs(calls, ctx, days, call_windows)
    hot = find_hot(pairs, [WHO_KEY], hot_rows // 6, "calls")
    stay = hot.keys is None
    featured = call_features(calls, ctx, days, call_windows, keep_key=True, hot=hot, hot_rows=hot_rows)
    wanted = pairs.where("wanted > 0")
    attributes = with_records(client_attributes(wanted, clients, ctx), contacts_made, ctx)
    attributes = stage(attributes.withColumn(WHO_KEY, pair_key()), "attributes")
    named = lookup(featured, attributes.drop(*PAIR), [WHO_KEY], in_place=stay)
    named = records_at(named, alert_span)

    called = stored_since(calls, ctx, days).where(f"{TS} >= {ctx.midnight(days)}").select("phone_number", pair_key().alias(WHO_KEY), TS)
    moments = lookup(called.distinct(), attributes, [WHO_KEY], MOMENT).select(WHO_KEY, "phone_number", *MOMENT, TS)
    asked = lookup(wanted.select(WHO_KEY, "phone_number", F.col("wanted").alias(MOMENTS)), attributes, [WHO_KEY], MOMENT)
    on = [WHO_KEY, TS]
    whole = engagement(named, contacts_made, ctx, message_windows, alert_span, moments, on, stay, hot_rows, True, stage(asked, "clients"))
    return since_last_call(whole).drop(WHO_KEY)


def counted_pairs(
    calls: DataFrame, ctx: RunContext, days: int, windows: Mapping[str, Trailing] | None = None
) -> DataFrame:
    """The pairs of the calls that are read, with the number of their calls and of those of the last ``days`` days (wanted)."""
    read = stored_since(calls, ctx, days + reach(windows or CALL_WINDOWS))
    recent = f"part_date >= {ctx.day_key(days + LOOSE_DAYS)} and {TS} >= {ctx.midnight(days)}"
    counted = read.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("calls"), F.expr(f"count_if({recent})").alias("wanted"))
    return stage(counted.withColumn(WHO_KEY, pair_key()), "pairs")
