"""P5: one feature row per (phone, client), from the recent calls, the contacts and the messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import DIRECTIONS, PHONE_TYPES, WEEKDAYS
from callmart.functions.calendar import days_since
from callmart.functions.decode import SUCCESS, nan_to_zero, ordinal, safe_rate
from callmart.functions.phone import phone_key
from callmart.operators.categories import slot_counts, slot_names
from callmart.operators.history import rank_by_recency
from callmart.operators.joins import lookup, restrict_to
from callmart.operators.scans import recent

KEYS = ["phone_number", "cuid"]
TS = "dtime_call_start"
SPAN = "6 MONTHS"
LOOSE_DAYS = 190

# Feature name of each rate, by what was counted.
PART_RATES = {"Morning": "rate_connect_mor", "Afternoon": "rate_connect_after", "Evening": "rate_connect_even"}
DAY_RATES = {d: f"rate_connect_{d.lower()}" for d in WEEKDAYS}

COMMENTS = {
    "phone_number": "Phone number the row is about",
    "cuid": "Client the phone belongs to",
    "pif_finded_status": "1 when phone and client are registered together, else 0",
    **{r: f"Share of answered calls, {p.lower()}" for p, r in PART_RATES.items()},
    **{r: f"Share of answered calls, {d}" for d, r in DAY_RATES.items()},
    "cnt_in_calls_6m": "Inbound calls in the window",
    "pif_phone_type_code": "Code of the phone type, -1 when unknown",
    "past_days_last_succ_call": "Days since the last answered call, -1 when never",
    "past_days_last_call": "Days since the last call, -1 when never",
    "cnt_success_sms_6m": "Text messages in the window",
    "last_interaction_type_code": "Code of the direction of the window's first call, -1 when unknown",
}


def official_contacts(parties: DataFrame, roles: DataFrame, contacts: DataFrame) -> DataFrame:
    """Active official contacts of active customers: contact, role and party chained by key."""
    live = parties.where("active_yn = 1").select("id")
    roles = restrict_to(roles.where("role_type_id = 'CUSTOMER_PER'"), live, {"party_id": "id"})
    shown = contacts.where("active_yn = 1 and official_yn = 1")
    return lookup(shown, roles, {"party_role_id": "id"}, ["external_id"], how="inner").withColumnRenamed(
        "external_id", "cuid"
    )


def ranked_contacts(contacts: DataFrame, tie: str = "contact_id") -> DataFrame:
    """All contacts, numbered per phone from the newest; every client of a phone stays."""
    return rank_by_recency(contacts, ["phone_number"], "modified_ts", tie, "status_last")


def call_measures() -> list[Column]:
    """Slot counts, last times and the first direction, over rows of the call log."""
    when = f"if({TS} is null, null, struct({TS}, interaction_id))"
    return [
        *slot_counts(),
        F.expr("count_if(interaction_type_code = 'INBOUND') as cnt_in_calls_6m"),
        F.expr(f"max({TS}) as last_dtime_call"),
        F.expr(f"max(if({SUCCESS}, {TS}, null)) as last_success_dtime_call"),
        # The window's earliest call, not its latest, gives the direction.
        F.expr(f"min_by(interaction_type_code, {when}) as last_interaction_type"),
    ]


def recent_call_counts(calls: DataFrame, ctx: RunContext, span: str = SPAN, loose_days: int = LOOSE_DAYS) -> DataFrame:
    """The call measures of each (phone, client) in the window."""
    return recent(calls, ctx, TS, span, loose_days).groupBy(*KEYS).agg(*call_measures())


def recent_messages(messages: DataFrame, ctx: RunContext, span: str = SPAN, loose_days: int = LOOSE_DAYS) -> DataFrame:
    """Messages per phone key in the window."""
    return (
        recent(messages, ctx, "input_date", span, loose_days)
        .groupBy(phone_key("phone").alias("phone_number"))
        .agg(F.count(F.lit(1)).alias("cnt_success_sms_6m"))
    )


def phone_type_rows(contacts: DataFrame, roles: DataFrame) -> DataFrame:
    """Contact rows with their role's client and the time of the role record."""
    held = lookup(
        contacts.select("phone_number", "party_role_id", "classification", "contact_id"),
        roles, {"party_role_id": "id"}, ["external_id", "modified_ts"], how="inner",
    )
    held = held.where("external_id is not null and phone_number is not null")
    return held.withColumnRenamed("external_id", "cuid")


def add_rates(df: DataFrame) -> DataFrame:
    """Ten connect rates from the slot counts; 0 where nothing was called."""
    parts, days = slot_names(False)
    ok_parts, ok_days = slot_names(True)
    counted = {r: (ok_parts[p], parts[p]) for p, r in PART_RATES.items()}
    counted |= {r: (ok_days[d], days[d]) for d, r in DAY_RATES.items()}
    return df.withColumns({rate: nan_to_zero(safe_rate(*pair)) for rate, pair in counted.items()})


def daily_features(
    calls: DataFrame,
    contacts: DataFrame,
    types: DataFrame,
    messages: DataFrame,
    ctx: RunContext,
    span: str = SPAN,
    loose_days: int = LOOSE_DAYS,
) -> DataFrame:
    """The feature table the daily model reads.

    ``contacts`` holds the registered (phone, client) rows; ``types`` the contact rows that tell a
    pair's phone type, of which the newest counts if the pair is registered. Registered pairs
    without calls and called pairs without registration both get a row; calls of an unknown client
    do not.

    The three inputs are stacked and grouped by pair at once. That is the full join of the pairs,
    with one shuffle of rows that each task has already combined, so no pair is ever hot.
    """
    log = recent(calls, ctx, TS, span, loose_days).select(
        *KEYS, "interaction_id", TS, "day_part", "weekday", "talk_duration", "interaction_type_code", "code_call_result_type"
    )
    stacked = log.unionByName(
        contacts.select(*KEYS, F.lit(1).alias("registered")), allowMissingColumns=True
    ).unionByName(
        types.select(*KEYS, "classification", F.struct("modified_ts", "contact_id").alias("typed_at")),
        allowMissingColumns=True,
    )
    merged = (
        stacked.where("cuid is not null")
        .groupBy(*KEYS)
        .agg(
            *call_measures(),
            F.max("registered").alias("registered"),
            F.expr("max_by(classification, typed_at) as phone_type"),
        )
        # A pair that only a contact row tells of, but that is neither registered nor called.
        .where("registered = 1 or last_dtime_call is not null")
    )
    merged = lookup(merged, recent_messages(messages, ctx, span, loose_days), ["phone_number"], ["cnt_success_sms_6m"])
    registered = F.col("registered").isNotNull() & F.col("phone_number").isNotNull()
    return add_rates(merged).select(
        *KEYS,
        F.when(registered, "1").otherwise("0").alias("pif_finded_status"),
        *PART_RATES.values(),
        *DAY_RATES.values(),
        F.coalesce("cnt_in_calls_6m", F.lit(0)).alias("cnt_in_calls_6m"),
        ordinal(F.when(registered, F.col("phone_type")), PHONE_TYPES).alias("pif_phone_type_code"),
        days_since("last_success_dtime_call", ctx).alias("past_days_last_succ_call"),
        days_since("last_dtime_call", ctx).alias("past_days_last_call"),
        F.coalesce("cnt_success_sms_6m", F.lit(0)).alias("cnt_success_sms_6m"),
        ordinal("last_interaction_type", DIRECTIONS).alias("last_interaction_type_code"),
    )


def published_columns() -> Mapping[str, str]:
    """Column list and comments of the published view."""
    return COMMENTS
