"""P4: pushes, messages, vehicles, credit cases, devices and bureau alerts before each call.

All of it depends on who was called and when, so it is worked out on the distinct moments of the
calls: narrow rows that are cheap to shuffle by one key after another. The wide calls are joined
once, at the end.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import (
    ACTIVE_CREDIT_STATES,
    HOME_TIME_ZONES,
    PRODUCT_COLUMNS,
    PUSH_TYPES,
    RULE_COUNTS,
    RULE_FLAGS,
    TRAILER_PATTERNS,
)
from callmart.functions.calendar import elapsed, epoch_ms_to_ts, minus
from callmart.functions.decode import one_hot, outside_set_flag
from callmart.functions.phone import phone_key
from callmart.operators.dedupe import first_per, latest_per
from callmart.operators.joins import attach, kv_param, lookup, restrict_to
from callmart.operators.ordered import HOT_ROWS, Hot, find_hot
from callmart.operators.scans import exclude_like, in_list, scan_range
from callmart.operators.trailing import Trailing, count_before, trailing
from callmart.session import stage

TS = "dtime_call_start"
WHO = ["phone_number", "id_cuid", "skp_client", "pif_identification_code", TS]

# All message windows end at the call.
WINDOWS = {"6m": Trailing("6 MONTHS"), "3m": Trailing("3 MONTHS"), "1m": Trailing("1 MONTH")}
ALERT_SPAN = "12 MONTHS"
HISTORY_DAYS = 365

# How many moments a row of a client stands for, where moments were counted by client.
MOMENTS = "_moments"


def _counted(clients: DataFrame, key: str) -> DataFrame:
    """The key of each row and how many moments the row stands for."""
    n = F.col(MOMENTS) if MOMENTS in clients.columns else F.lit(1).cast("long")
    return clients.where(F.col(key).isNotNull()).select(key, n.alias(MOMENTS))


def _crowded(events: DataFrame, clients: DataFrame, key: str, most: int) -> Hot:
    """Keys with more than ``most`` events and moments."""
    return find_hot(_counted(events.select(key), key).unionByName(_counted(clients, key)), [key], most, MOMENTS)


def message_counts(
    moments: DataFrame, messages: DataFrame, key: str, ts: str, names: str,
    windows: Mapping[str, Trailing] = WINDOWS, hot_rows: int = HOT_ROWS, clients: DataFrame | None = None,
) -> DataFrame:
    """Messages of a key in the windows before each moment; 0 where there were none.

    ``clients`` holds the keys of the moments in fewer rows.
    """
    asked = moments.where(F.col(key).isNotNull())
    clients = asked if clients is None else clients
    hot = _crowded(messages, clients, key, hot_rows // 5)
    return trailing(
        asked, restrict_to(messages, clients, [key]), [key], TS, ts,
        sums={"n": "1"},
        windows=windows,
        outputs={f"{names}_{w}": ("n", w) for w in windows},
        hot=hot,
        hot_rows=hot_rows,
    )


def with_vehicle(clients: DataFrame, records: DataFrame) -> DataFrame:
    """Add ``_car``, when the client's newest vehicle was registered. Only records of these clients are ranked."""
    cars = exclude_like(records.where("cuid is not null"), "automodel", TRAILER_PATTERNS).select(
        "cuid", epoch_ms_to_ts("req_ts").alias("dtime_request_car"), "tie"
    )
    newest = latest_per(restrict_to(cars, clients, {"cuid": "id_cuid"}), ["cuid"], "dtime_request_car", "tie")
    return lookup(clients, newest.select("cuid", F.col("dtime_request_car").alias("_car")), {"id_cuid": "cuid"})


def vehicle_at(calls: DataFrame) -> DataFrame:
    """What ``_car`` was at each call."""
    there = F.when(F.col(TS) >= F.col("_car"), F.col("_car"))
    return calls.withColumn("dtime_request_car", there).drop("_car").withColumns(
        {
            "flag_has_car": F.when(F.col("dtime_request_car").isNotNull(), 1).otherwise(0),
            "driving_days": elapsed("dtime_request_car", TS, "days"),
        }
    )


def vehicles(moments: DataFrame, records: DataFrame) -> DataFrame:
    """Whether the client's newest registered vehicle was there at the call, and for how many days."""
    return vehicle_at(with_vehicle(moments, records))


def product_counts(
    moments: DataFrame, cases: DataFrame, products: DataFrame, hot_rows: int = HOT_ROWS, clients: DataFrame | None = None
) -> DataFrame:
    """Active credit cases decided before each call, one column per product type.

    ``clients`` holds the clients of the moments in fewer rows.
    """
    granted = in_list(cases, "skp_credit_status", ACTIVE_CREDIT_STATES)
    typed = lookup(granted, products, ["skp_product"], ["code_product_type"], how="inner")
    typed = typed.where(F.col("skp_client").isNotNull() & F.col("code_product_type").isin(list(PRODUCT_COLUMNS)))
    asked = moments.where("skp_client is not null")
    clients = asked if clients is None else clients
    hot = _crowded(granted, clients, "skp_client", hot_rows // 2)
    return count_before(
        asked, restrict_to(typed, clients, ["skp_client"]), ["skp_client"], TS, "date_decision",
        {name: f"code_product_type = '{code}'" for code, name in PRODUCT_COLUMNS.items()},
        hot=hot,
        hot_rows=hot_rows,
    )


DEVICE_FLAGS = ["flag_device_iphone", "flag_device_samsung", "flag_device_other", "networkoperatorname", "flag_diff_time_zone"]


def with_device(clients: DataFrame, devices: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Add ``_device``, the client's first device record.

    Only records of clients in ``asked`` are ranked: those given, unless a caller has them in a shorter form.
    """
    known = restrict_to(devices.where("inserted_date is not null"), clients if asked is None else asked, {"cuid": "id_cuid"})
    first = first_per(known, ["cuid"], "inserted_date", "tie")
    first = first.select(
        "cuid",
        "inserted_date",
        *one_hot(
            "device_manufacturer",
            {"IPHONE": "flag_device_iphone", "SAMSUNG": "flag_device_samsung"},
            other="flag_device_other",
        ),
        "networkoperatorname",
        outside_set_flag("timezoneid", HOME_TIME_ZONES).alias("flag_diff_time_zone"),
    )
    return lookup(clients, first.select("cuid", F.struct("inserted_date", *DEVICE_FLAGS).alias("_device")), {"id_cuid": "cuid"})


def device_at(calls: DataFrame) -> DataFrame:
    """Maker, operator and time zone of ``_device``, once it existed."""
    there = F.col("_device.inserted_date") < F.col(TS)
    kept = [c for c in calls.columns if c != "_device"]
    return calls.select(*kept, *[F.when(there, F.col(f"_device.{c}")).alias(c) for c in DEVICE_FLAGS])


def device_flags(moments: DataFrame, devices: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Maker, operator and time zone of the client's first device record, once it existed."""
    return device_at(with_device(moments, devices, asked))


def newest_alerts(headers: DataFrame, params: DataFrame, ctx: RunContext) -> DataFrame:
    """The newest alert of each client and rule within the kept history, with its parameter value."""
    rules = [*RULE_COUNTS, *RULE_FLAGS]
    kept = scan_range(headers, ctx, HISTORY_DAYS).select("id", "iin", "ruleid", "insert_time")
    alerts = kv_param(kept, params, "value", rules, ["value_new"])
    return latest_per(alerts, ["iin", "ruleid"], "insert_time", "id")


def with_alerts(clients: DataFrame, alerts: DataFrame) -> DataFrame:
    """Add ``_alerts``, the list of the client's alerts.

    ``alerts`` has one row per client and rule, so they fold into one short list per client (as
    long as the list of rules): no row is multiplied.
    """
    folded = (
        alerts.where("iin is not null")
        .groupBy("iin")
        .agg(
            F.collect_list(
                F.struct(
                    "ruleid",
                    "insert_time",
                    F.right(F.replace("value_new", F.lit("-"), F.lit("")), F.lit(7)).alias("digits"),
                )
            ).alias("_alerts")
        )
    )
    return lookup(clients, folded, {"pif_identification_code": "iin"}, ["_alerts"])


def alerts_at(calls: DataFrame, span: str = ALERT_SPAN) -> DataFrame:
    """Alerts of ``_alerts`` in the year before each call: counts, flags, and a matching new phone. Each call tests its list in place."""
    kept = [c for c in calls.columns if c != "_alerts"]
    recent = F.filter("_alerts", lambda a: a["insert_time"].between(minus(TS, span), F.col(TS)))
    out = calls.withColumn("_alerts", recent)
    any_of = lambda test: F.coalesce(F.exists("_alerts", test), F.lit(False)).cast("int")
    count = lambda rule: F.aggregate(
        "_alerts", F.lit(0), lambda n, a: n + F.when(a["ruleid"] == rule, 1).otherwise(0)
    )
    return out.select(
        *kept,
        *[any_of(lambda a: a["ruleid"] == rule).alias(name) for rule, name in RULE_FLAGS.items()],
        *[F.coalesce(count(rule), F.lit(0)).alias(name) for rule, name in RULE_COUNTS.items()],
        any_of(lambda a: a["digits"] == F.right("phone_number", F.lit(7))).alias("fcb_phone_is_same"),
    )


def alert_flags(moments: DataFrame, alerts: DataFrame, span: str = ALERT_SPAN) -> DataFrame:
    """Alerts of the client in the year before each call: counts, flags, and a matching new phone."""
    return alerts_at(with_alerts(moments, alerts), span)


def with_records(clients: DataFrame, t: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Add the vehicle, device and alerts of each client, whatever the time of a call."""
    out = with_device(with_vehicle(clients, t["vehicle"]), t["device"], clients)
    return with_alerts(out, newest_alerts(t["alert"], t["alert_param"], ctx))


def records_at(calls: DataFrame, alert_span: str = ALERT_SPAN) -> DataFrame:
    """What the columns of ``with_records`` say at each call, in their place."""
    return alerts_at(device_at(vehicle_at(calls)), alert_span)


def engagement(
    calls: DataFrame,
    t: Mapping[str, DataFrame],
    ctx: RunContext,
    windows: Mapping[str, Trailing] = WINDOWS,
    alert_span: str = ALERT_SPAN,
    moments: DataFrame | None = None,
    on: list[str] | None = None,
    stay: bool = False,
    hot_rows: int = HOT_ROWS,
    recorded: bool = False,
    clients: DataFrame | None = None,
) -> DataFrame:
    """Add all engagement columns to ``calls``, which carry the columns of ``WHO``.

    A caller with a shorter way to the distinct moments of its calls gives them, and names the
    columns ``on`` which calls and moments share a key that is never missing; ``stay`` says that
    the calls are partitioned by it and no key is hot. The moments are staged: six feature groups
    read them, or three where the calls are ``recorded``: they have the columns of ``records_at`` already. ``clients``
    holds the clients of the moments, each at least once, in fewer rows than the moments.
    """
    moments = stage(calls.select(*WHO).distinct() if moments is None else moments, "moments")

    pushes = in_list(scan_range(t["push"], ctx, HISTORY_DAYS), "type", PUSH_TYPES).select(
        F.col("cuid").cast("bigint").alias("id_cuid"), "event_time_new"
    )
    texts = scan_range(t["sms"], ctx, HISTORY_DAYS).select(phone_key("phone").alias("phone_number"), "input_date")
    by_push = message_counts(moments, pushes, "id_cuid", "event_time_new", "cnt_push", windows, hot_rows, clients)
    by_text = message_counts(moments, texts, "phone_number", "input_date", "cnt_success_sms", windows, hot_rows, clients)
    by_product = product_counts(moments, t["credit_case"], t["product"], hot_rows, clients)

    out = moments if recorded else records_at(with_records(moments, t, ctx), alert_span)
    out = lookup(out, by_push, ["id_cuid", TS])
    out = lookup(out, by_text, ["phone_number", TS])
    out = lookup(out, by_product, ["skp_client", TS])
    counted = [c for df in (by_push, by_text, by_product) for c in df.columns if c.startswith("cnt_")]
    out = out.na.fill(0, counted)
    if on is None:
        return attach(calls, out, WHO)
    return lookup(calls, out, on, [c for c in out.columns if c not in (*WHO, *on)], in_place=stay)


def since_last_call(calls: DataFrame) -> DataFrame:
    """Days, seconds, minutes and hours since the previous call."""
    names = {
        "days": "past_days_last_call",
        "seconds": "past_sec_last_call",
        "minutes": "past_min_last_call",
        "hours": "past_hour_last_call",
    }
    return calls.withColumns({name: elapsed("last_dtime_call", TS, unit) for unit, name in names.items()})
