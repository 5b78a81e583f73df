"""P1: one row per interaction from the raw call facts, and the second call source beside it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import CALL_RESULT_LABELS, CALL_RESULT_RANGES
from callmart.functions.calendar import day_part, epoch_to_local, weekday_name
from callmart.functions.decode import decode, zero_when
from callmart.functions.phone import counterparty, phone_key
from callmart.operators.categories import collapse_legs
from callmart.operators.dedupe import dedupe, latest_per
from callmart.operators.joins import lookup
from callmart.operators.reducers import bloom, may_match
from callmart.operators.scans import scan_range
from callmart.operators.skew import SALT, heavy_keys, salted, spread
from callmart.plans.schemas import CALL_LOG, SECOND_SOURCE_DEFAULTS
from callmart.sources.tables import align_to

HISTORY_DAYS = 365

# An attempt's task.
TASK_ID = "cast(try_cast(record_field_37 as int) as bigint)"


def narrowed(t: Mapping[str, DataFrame], facts: DataFrame) -> dict[str, DataFrame]:
    """The lookup tables without rows that no call of ``facts`` can meet.

    The days' call ids become a Bloom filter that the scans of attempts, sessions and actions test; the clients of the sessions and
    the tasks of the attempts that pass become two more. A client's sessions stay together, as the
    newest of them is chosen before it is joined.
    """
    text = lambda c: F.col(c).cast("string")
    calls = bloom(facts.where("callid is not null"), text("callid"))
    attempts = may_match(t["contact_attempt_fact"], text("callid"), calls)
    met = may_match(t["session"], text("id_ses"), calls)
    clients = bloom(met.select("cuid"), "cuid")
    tasks = bloom(attempts.select(F.expr(TASK_ID).alias("task_id")).where("task_id is not null"), "task_id")
    of_task = lambda name, key: may_match(t[name], F.col(key).cast("bigint"), tasks)
    return {
        **t,
        "contact_attempt_fact": attempts,
        "session": may_match(t["session"], "cuid", clients),
        "session_action": may_match(t["session_action"], text("id_ses"), calls),
        "taskcalendar": of_task("taskcalendar", "t_taskcalendar_id"),
        "result": of_task("result", "t_taskcalendar_1"),
        "eventhistory": of_task("eventhistory", "t_taskcalendar_1"),
    }


def first_source(
    t: Mapping[str, DataFrame], ctx: RunContext, from_days: int = 1, to_days: int = 1, narrow: bool = False, hour_of: str = "end"
) -> DataFrame:
    """Raw interactions of the given days with all their lookups.

    ``narrow`` first drops lookup rows that the days' calls cannot meet; it is for a night, whose calls meet little of
    the lookups, and changes no result. ``hour_of`` says whether the hour is that of the ``end`` or of the ``start`` of a call.

    Every lookup follows the row it belongs to: an interaction with two dialling attempts gives
    two rows, each with its own result and campaign. The weekday is that of the start of the call. An interaction without an attempt keeps missing values; one
    without talk-time rows or with an unknown resource is not a call and is left out.
    """
    facts = scan_range(t["interaction_fact"], ctx, from_days, to_days).select(
        "interaction_id",
        F.col("media_server_ixn_guid").alias("callid"),
        epoch_to_local("start_ts").alias("dtime_call_start"),
        epoch_to_local("end_ts").alias("dtime_call_end"),
        "interaction_type_key",
        "target_address",
        "source_address",
        "part_date",
    )
    if hour_of not in ("start", "end"):
        raise ValueError(f"hour_of is start or end, not {hour_of}")
    if narrow:
        t = narrowed(t, facts)

    # Talk time per interaction and day is summed before it meets the facts, so that a run over many days
    # gives what as many one-day runs give.
    talk = (
        scan_range(t["interaction_resource_fact"], ctx, from_days, to_days)
        .groupBy("interaction_id", "part_date")
        .agg(F.sum("talk_duration").alias("talk_duration"), F.max("resource_key").alias("resource_key"))
    )
    known = dedupe(t["resource"], ["resource_key"])
    calls = lookup(facts, talk, ["interaction_id", "part_date"], how="inner", in_place=True)
    calls = lookup(calls, known, ["resource_key"], [], how="inner")
    calls = lookup(calls, t["interaction_type"], ["interaction_type_key"], ["interaction_type", "interaction_type_code"])

    attempts = t["contact_attempt_fact"].select(
        "callid",
        "contact_info",
        F.col("call_result_key").cast("string").alias("call_result_key"),
        F.col("campaign_key").cast("string").alias("campaign_key"),
        F.expr(TASK_ID).alias("task_id"),
    )
    # Attempts, sessions and actions share the call's id, and with it one shuffle of the calls. A
    # call without an id gets one that nothing else has.
    calls = calls.withColumn("call_key", F.coalesce("callid", F.concat(F.lit("\0"), "interaction_id")))
    # An id that holds a large part of the calls is salted, so that its calls spread over tasks; for the others the salt is 0.
    heavy = heavy_keys(facts, "callid")
    calls = salted(calls, "call_key", heavy, F.col("interaction_id"))
    key = {"call_key": "_key", SALT: SALT}
    calls = lookup(calls, spread(attempts.withColumnRenamed("callid", "_key"), "_key", heavy), key, in_place=True)
    # The newest session of each client is chosen first; older sessions lose their client.
    sessions = latest_per(t["session"].select("id_ses", "cuid", "begin_session"), ["cuid"], "begin_session", "id_ses")
    actions = latest_per(
        t["session_action"].select("id_ses", "id_action", "begin_action"), ["id_ses"], "begin_action", "id_action"
    )
    calls = lookup(calls, spread(sessions.withColumnRenamed("id_ses", "_key"), "_key", heavy), key, ["cuid"], in_place=True)
    calls = lookup(calls, spread(actions.withColumnRenamed("id_ses", "_key"), "_key", heavy), key, ["id_action"], in_place=True)

    # Results and comments belong to a task of the calendar and are gathered by its key, so the
    # calls move once for all three.
    tasks = t["taskcalendar"].select(
        F.col("t_taskcalendar_id").cast("bigint").alias("task_id"), F.col("t_tasktype_1").cast("string").alias("task_type")
    )
    outcome = (
        t["result"]
        .groupBy("t_taskcalendar_1")
        .agg(F.min("t_resulttype_1").cast("string").alias("task_result"))
    )
    comments = dedupe(t["eventhistory"], ["t_taskcalendar_1", "resultscomment"])
    tasks = lookup(tasks, outcome, {"task_id": "t_taskcalendar_1"})
    tasks = lookup(tasks, comments, {"task_id": "t_taskcalendar_1"})
    calls = lookup(calls, tasks, ["task_id"])

    calls = lookup(calls, t["call_result_type"], {"call_result_key": "id_source"}, ["code_call_result_type"])
    calls = lookup(calls, t["campaign_type"], {"campaign_key": "id_source"}, ["name_call_campaign"])
    calls = lookup(calls, t["camp_task_type"], {"task_type": "id_source"}, ["code_camp_task_type"])
    calls = lookup(calls, t["camp_task_result_type"], {"task_result": "id_source"}, ["code_camp_task_result_type"])
    calls = lookup(calls, t["action"], {"id_action": "id"}, ["name"])

    hour = F.hour(f"dtime_call_{hour_of}")
    number = counterparty(
        F.col("interaction_type") == "Outbound", F.col("contact_info"), F.col("target_address"), F.col("source_address")
    )
    out = calls.withColumns(
        {
            "phone_number": phone_key(number),
            "weekday": weekday_name("dtime_call_start"),
            "h_date": hour,
            "day_part": day_part(hour),
            "response_name": F.col("name"),
            "text_call_disposition": F.col("resultscomment"),
            "call_source": F.lit("GENESYS"),
        }
    )
    return align_to(out, CALL_LOG)


def second_source_calls(raw: DataFrame) -> DataFrame:
    """The second source's rows in the names of the call log, legs of a call made one."""
    legs = raw.select(
        F.col("abonentnumber").alias("phone_number"),
        F.col("datetimestart").alias("dtime_call_start"),
        F.col("datetimestop").alias("dtime_call_end"),
        weekday_name("datetimestart").alias("weekday"),
        F.hour("datetimestart").alias("h_date"),
        decode("isoutput", {1: "OUTBOUND"}, default="INBOUND").alias("interaction_type_code"),
        zero_when("lentime", F.col("alinenum").eqNullSafe("IVR") | F.col("blinenum").isNull()).alias("talk_duration"),
        decode("callresult", CALL_RESULT_LABELS, CALL_RESULT_RANGES).alias("code_call_result_type"),
        F.lit("OKTELL").alias("call_source"),
        "part_date",
    )
    return collapse_legs(legs)


def second_source(
    raw: DataFrame, contacts: DataFrame, ctx: RunContext, from_days: int = HISTORY_DAYS, to_days: int = 1
) -> DataFrame:
    """Calls of the second source under every client known for their phone.

    ``contacts`` has (phone_number, cuid); a phone of two clients gives the call twice, once for
    each, as the later keys are (phone, client). Repeated contact rows do not repeat calls.
    """
    calls = second_source_calls(scan_range(raw, ctx, from_days, to_days))
    calls = lookup(calls, dedupe(contacts, ["phone_number", "cuid"]), ["phone_number"], ["cuid"])
    calls = calls.withColumn("day_part", day_part("h_date"))
    return align_to(calls, CALL_LOG, SECOND_SOURCE_DEFAULTS)


def call_log(
    tables: Mapping[str, DataFrame], contacts: DataFrame, ctx: RunContext, from_days: int = HISTORY_DAYS, to_days: int = 1,
    narrow: bool = False,
) -> DataFrame:
    """Both call sources in one table."""
    return first_source(tables, ctx, from_days, to_days, narrow).unionByName(
        second_source(tables["second_calls"], contacts, ctx, from_days, to_days)
    )
