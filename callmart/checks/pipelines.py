"""The pipelines, the ranking built on the feature table, and the sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from callmart.checks.fixtures import CTX, view
from callmart.checks.history import (
    AVERAGES_SQL,
    COUNTS_SQL,
    DAY_WINDOWS,
    INTERCEPT,
    MESSAGE_WINDOWS,
    MOBILE_WEIGHTS,
    WEIGHTS,
    loader,
    pairs_sql,
    score_sql,
)
from callmart.checks.registry import AS_OF, OK, check, d
from callmart.checks.relational import LEGS_SQL, PAIR, slot_sql
from callmart.checks.scalars import RATES_SQL
from callmart.operators import dedupe, delivery, scoring
from callmart.operators.quality import profile
from callmart.operators.trees import forest
from callmart.plans import call_features as P2
from callmart.plans import call_log as P1
from callmart.plans import client_attributes as P3
from callmart.plans import daily_features as P5
from callmart.plans import engagement as P4
from callmart.plans import scores as P6
from callmart.plans.day_table import backfill_day_rows, features_of_day, write_day_rows
from callmart.plans.schemas import CALL_LOG, SECOND_SOURCE_DEFAULTS
from callmart.plans.training import training_frame as build_training
from callmart.session import new_path, stage
from callmart.sources import published, sinks
from callmart.sources.tables import align_to

SPAN, LOOSE = "21 DAYS", 25


# --- P1 ---------------------------------------------------------------------------------------

_LOG_COLUMNS = ", ".join(CALL_LOG.names)
_ALIGNED_SQL = """select -1 as interaction_id, '' as callid, cuid, phone_number, dtime_call_start, dtime_call_end, weekday, h_date,
  case when h_date between 9 and 12 then 'Morning' when h_date between 13 and 17 then 'Afternoon' when h_date between 18 and 21 then 'Evening' else 'Night' end as day_part,
  talk_duration, interaction_type_code, code_call_result_type, '' as response_name, '' as code_camp_task_type, '' as name_call_campaign,
  '' as code_camp_task_result_type, '' as text_call_disposition, call_source, part_date"""
_OWNED_LEGS = """owned as (select legs.*, k.cuid from legs left join (select distinct phone_number, external_id as cuid from fx_contacts) k
  on legs.phone_number = k.phone_number)"""


@check(
    "call_log_union",
    f"""select interaction_id, callid, cuid, phone_number, dtime_call_start, dtime_call_end, weekday, h_date, day_part, talk_duration,
    interaction_type_code, code_call_result_type, cast(null as varchar) as response_name, cast(null as varchar) as code_camp_task_type,
    cast(null as varchar) as name_call_campaign, cast(null as varchar) as code_camp_task_result_type, cast(null as varchar) as text_call_disposition,
    call_source, part_date from fx_calls union all by name {_ALIGNED_SQL} from owned""",
    LEGS_SQL,
    _OWNED_LEGS,
)
def call_log_union(spark, folder):
    return both_sources(spark, folder)


def both_sources(spark, folder):
    contacts = view(spark, folder, "fx_contacts").withColumnRenamed("external_id", "cuid")
    first = align_to(view(spark, folder, "fx_calls"), CALL_LOG)
    return first.unionByName(P1.second_source(view(spark, folder, "fx_calls2"), contacts, CTX))


RAW = {
    "interaction_fact": "raw_interaction",
    "interaction_resource_fact": "raw_resource_fact",
    "interaction_type": "raw_type",
    "resource": "raw_resource",
    "contact_attempt_fact": "raw_attempt",
    "call_result_type": "raw_result_type",
    "campaign_type": "raw_campaign",
    "taskcalendar": "raw_task",
    "camp_task_type": "raw_task_type",
    "result": "raw_task_result",
    "camp_task_result_type": "raw_task_result_type",
    "eventhistory": "raw_comment",
    "session": "raw_session",
    "session_action": "raw_session_action",
    "action": "raw_action",
    "second_calls": "fx_calls2",
}


_CALL_LOG_SQL = f"""select f.interaction_id, media_server_ixn_guid as callid, s.cuid,
      right(if(interaction_type = 'Outbound', coalesce(contact_info, target_address), source_address), 10) as phone_number,
      make_timestamp((start_ts + 21600) * 1000000) as dtime_call_start, make_timestamp((end_ts + 21600) * 1000000) as dtime_call_end,
      dayname(make_timestamp((start_ts + 21600) * 1000000)) as weekday, h.h_date,
      case when h_date between 9 and 12 then 'Morning' when h_date between 13 and 17 then 'Afternoon' when h_date between 18 and 21 then 'Evening' else 'Night' end as day_part,
      talk.talk_duration, interaction_type_code, code_call_result_type, act.name as response_name, code_camp_task_type, name_call_campaign,
      code_camp_task_result_type, ev.resultscomment as text_call_disposition, 'GENESYS' as call_source, f.part_date
    from raw_interaction f
    join (select interaction_id, cast(hour(make_timestamp((end_ts + 21600) * 1000000)) as int) as h_date from raw_interaction) h on h.interaction_id = f.interaction_id
    join (select interaction_id, sum(talk_duration)::bigint as talk_duration, max(resource_key) as resource_key, part_date from raw_resource_fact group by interaction_id, part_date) talk
      on talk.interaction_id = f.interaction_id and talk.part_date = f.part_date
    join raw_resource res on res.resource_key = talk.resource_key
    left join raw_type ty on ty.interaction_type_key = f.interaction_type_key
    left join raw_attempt a on a.callid = f.media_server_ixn_guid
    left join raw_result_type rt on rt.id_source = cast(a.call_result_key as varchar)
    left join raw_campaign ca on ca.id_source = cast(a.campaign_key as varchar)
    left join raw_task tk on tk.t_taskcalendar_id = try_cast(a.record_field_37 as int)
    left join raw_task_type tt on tt.id_source = cast(tk.t_tasktype_1 as varchar)
    left join (select t_taskcalendar_1, cast(min(t_resulttype_1) as varchar) as res from raw_task_result group by 1) tr on tr.t_taskcalendar_1 = tk.t_taskcalendar_id
    left join raw_task_result_type rr on rr.id_source = tr.res
    left join (select distinct * from raw_comment) ev on ev.t_taskcalendar_1 = tk.t_taskcalendar_id
    left join (select *, row_number() over (partition by cuid order by begin_session desc, id_ses desc) as n from raw_session) s
      on s.id_ses = f.media_server_ixn_guid and s.n = 1
    left join (select *, row_number() over (partition by id_ses order by begin_action desc, id_action desc) as n from raw_session_action) sa
      on sa.id_ses = f.media_server_ixn_guid and sa.n = 1
    left join raw_action act on act.id = sa.id_action
    union all by name {_ALIGNED_SQL} from owned"""


@check("call_log", _CALL_LOG_SQL, LEGS_SQL, _OWNED_LEGS)
def call_log(spark, folder):
    contacts = view(spark, folder, "fx_contacts").withColumnRenamed("external_id", "cuid")
    return P1.call_log({name: view(spark, folder, v) for name, v in RAW.items()}, contacts, CTX)


@check("call_log_day", f"select * from ({_CALL_LOG_SQL}) where part_date = {d(1)}", LEGS_SQL, _OWNED_LEGS)
def call_log_day(spark, folder):
    """Yesterday alone, with the lookups narrowed to what yesterday's calls can meet."""
    contacts = view(spark, folder, "fx_contacts").withColumnRenamed("external_id", "cuid")
    return P1.call_log({name: view(spark, folder, v) for name, v in RAW.items()}, contacts, CTX, 1, 1, narrow=True)


# --- P2 ---------------------------------------------------------------------------------------

_SLOTS_OF_PAIRS = slot_sql().replace(OK, "ok")
_FEATURES_SQL = f"""features as (select id, {COUNTS_SQL}, {_SLOTS_OF_PAIRS},
  count(*) filter (where interaction_type_code = 'OUTBOUND') as cnt_out_calls_6m, count(*) filter (where interaction_type_code = 'INBOUND') as cnt_in_calls_6m,
  count(*) filter (where interaction_type_code = 'OUTBOUND' and ok) as cnt_success_out_calls_6m,
  count(*) filter (where interaction_type_code = 'INBOUND' and ok) as cnt_success_in_calls_6m,
  {AVERAGES_SQL}, max(dtime_call_start) filter (where ok) as last_success_dtime_call2 from pairs group by id)"""
_PREVIOUS_SQL = f"""previous as (select *, lag(dtime_call_start) over w as last_dtime_call, lag(code_call_result_type) over w as last_code_call_result_type,
  lag(interaction_type_code) over w as last_interaction_type_code, lag(call_result) over w as last_call_result
  from (select *, {OK}::int as call_result, part_date as partition_date from fx_calls)
  window w as (partition by phone_number, cuid order by dtime_call_start, interaction_id))"""


@check(
    "call_features",
    "select previous.*, features.* exclude (id) from previous join features on id = interaction_id",
    pairs_sql(),
    _FEATURES_SQL,
    _PREVIOUS_SQL,
)
def call_features(spark, folder):
    return P2.call_features(view(spark, folder, "fx_calls"), CTX, windows=DAY_WINDOWS)


@check(
    "nightly_features",
    f"select previous.*, features.* exclude (id) from previous join features on id = interaction_id where partition_date = {d(1)}",
    pairs_sql(),
    _FEATURES_SQL,
    _PREVIOUS_SQL,
)
def nightly_features(spark, folder):
    """Yesterday's calls from a stored table of days and the calls of the days in which windows begin."""
    calls, path = view(spark, folder, "fx_calls"), new_path(spark, "call-days")
    backfill_day_rows(calls.where(F.col("part_date") < d(1)), path)
    write_day_rows(calls, CTX, path)
    return features_of_day(calls, spark.read.parquet(path), CTX, DAY_WINDOWS)


# --- P3 ---------------------------------------------------------------------------------------

CLIENTS = {
    "contact": "fx_contacts",
    "role": "cl_role",
    "person": "cl_person",
    "person_rel": "cl_rel",
    "registry": "cl_registry",
    "state_person": "cl_state",
    "bureau_client": "cl_bureau",
    "marriage": "cl_marriage",
    "divorce": "cl_divorce",
}

_ATTRIBUTES_SQL = f"""attributes as (select p.phone_number, p.cuid, r.skp_client,
  coalesce(p.cuid, k.external_id, s.cuid, r.id_cuid, b.cuid) as id_cuid, k.party_id as pif_party_id, k.party_role_id as pif_party_role_id,
  k.classification as pif_phone_type_code, person.identification_code as pif_identification_code, rel.housingtype_code as pif_housingtype_code,
  coalesce(r.cnt_children, rel.cust_childnum) as cnt_children,
  coalesce(case s.gender_code when '1' then 'M' when '0' then 'F' end, person.gender_code, upper(r.code_gender)) as code_gender,
  coalesce(s.birthdate, person.birth_date_dt, r.date_birth) as date_birth,
  cast(date_diff('day', coalesce(s.birthdate, person.birth_date_dt, r.date_birth), date '2024-01-31') // 365 as int) as age,
  coalesce(s.regaddress_district, b.region) as c_region,
  case coalesce(s.regaddress_district, b.region) when 'АЛМАТЫ' then 2 when 'г.Шымкент' then 3 when 'ШЫМКЕНТ' then 3 when 'АКМОЛИНСКАЯ' then 5 when 'область Абай' then 18 end as region_code,
  coalesce(rel.education_code, case try_cast(b.education_id as int) when 3 then 'BACHELORS' when 1 then 'SECONDARY_SCHOOL' when 2 then 'SECONDARY_SCHOOL' end,
    r.code_education_type) as education_type,
  coalesce(case when dv.at > mr.at then 'DIVORCED' when mr.at is not null then 'MARRIED' when dv.at is not null then 'DIVORCED' end, rel.maritalstatus_code,
    case b.matrialstatus_id when '1' then 'SINGLE' when '2' then 'MARRIED' when '3' then 'DIVORCED' when '5' then 'LIVING_WITH_PARTNER' end) as marital_status
  from (select distinct phone_number, cuid from fx_calls) p
  left join (select c.phone_number, o.external_id, o.party_id, c.party_role_id, c.classification from
      (select *, row_number() over (partition by phone_number order by modified_ts desc, contact_id desc) as n from fx_contacts where active_yn = 1) c
      left join (select *, row_number() over (partition by id order by modified_ts desc, role_tie desc) as n from cl_role) o on o.id = c.party_role_id and o.n = 1
      where c.n = 1) k on k.phone_number = p.phone_number and k.external_id = p.cuid
  left join cl_person person on person.id = k.party_id
  left join cl_rel rel on rel.id = k.party_id
  left join (select *, row_number() over (partition by text_identification_number order by dtime_modified, tie) as n from cl_registry) r
    on r.text_identification_number = person.identification_code and r.n = 1
  left join (select *, row_number() over (partition by iin order by req_ts desc, tie desc) as n from cl_state) s on s.iin = person.identification_code and s.n = 1
  left join (select *, row_number() over (partition by iin order by created_ts desc, tie desc) as n from cl_bureau) b on b.iin = person.identification_code and b.n = 1
  left join (select cuid, max(actdate) as at from cl_marriage group by cuid) mr on mr.cuid = coalesce(p.cuid, k.external_id, s.cuid, r.id_cuid, b.cuid)
  left join (select cuid, max(actdate) as at from cl_divorce group by cuid) dv on dv.cuid = coalesce(p.cuid, k.external_id, s.cuid, r.id_cuid, b.cuid))"""


@check("client_attributes", "select * from attributes", _ATTRIBUTES_SQL)
def client_attributes(spark, folder):
    return P3.client_attributes(
        view(spark, folder, "fx_calls"), {name: view(spark, folder, v) for name, v in CLIENTS.items()}, CTX
    )


# --- P4 ---------------------------------------------------------------------------------------

MADE = {
    "push": "en_push",
    "sms": "fx_messages",
    "vehicle": "en_vehicle",
    "credit_case": "en_case",
    "product": "en_product",
    "device": "en_device",
    "alert": "fx_alerts",
    "alert_param": "en_param",
}
ALERT_DAYS = "14 DAYS"


def engagement_sql(calls: str) -> str:
    """Engagement per call of a relation with the client keys."""
    case_count = lambda code: (
        f"(select count(*) from en_case c join en_product p using (skp_product) where c.skp_client = x.skp_client"
        f" and c.date_decision < x.dtime_call_start and c.skp_credit_status in (2, 8) and p.code_product_type = '{code}')"
    )
    push = lambda days: (
        f"(select count(*) from en_push p where cast(p.cuid as bigint) = x.id_cuid and p.type in ('PUSH_VIEWED', 'CALLBACK_PUSH')"
        f" and p.event_time_new between x.dtime_call_start - interval {days} days and x.dtime_call_start)"
    )
    text = lambda days: (
        f"(select count(*) from fx_messages p where right(p.phone, 10) = x.phone_number"
        f" and p.input_date between x.dtime_call_start - interval {days} days and x.dtime_call_start)"
    )
    alerts = lambda test, measure: (
        f"(select {measure} from alerts a where a.iin = x.pif_identification_code and {test}"
        f" and a.insert_time between x.dtime_call_start - interval 14 days and x.dtime_call_start)"
    )
    return f"""engaged as (select x.*, {push(21)} as cnt_push_6m, {push(14)} as cnt_push_3m, {push(7)} as cnt_push_1m,
  {text(21)} as cnt_success_sms_6m, {text(14)} as cnt_success_sms_3m, {text(7)} as cnt_success_sms_1m,
  if(v.cuid is null, 0, 1) as flag_has_car, v.at as dtime_request_car, date_diff('day', v.at, x.dtime_call_start)::int as driving_days,
  {case_count('REV')} as cnt_act_cards, {case_count('CAL')} as cnt_act_cash, {case_count('COL')} as cnt_act_pos,
  g.flag_device_iphone, g.flag_device_samsung, g.flag_device_other, g.networkoperatorname, g.flag_diff_time_zone,
  {alerts("a.ruleid = '16'", "least(count(*), 1)::int")} as flag_phone_is_changed_1y,
  {alerts("a.ruleid = '21'", "count(*)::int")} as amt_fcb_searched_1y, {alerts("a.ruleid = '2'", "count(*)::int")} as cnt_ext_overdue_7d_in_1y,
  {alerts("a.ruleid = '8'", "count(*)::int")} as cnt_changes_in_ext_payment_1y, {alerts("a.ruleid = '4'", "count(*)::int")} as cnt_new_ext_contracts_1y,
  {alerts("right(replace(a.value_new, '-', ''), 7) = right(x.phone_number, 7)", "least(count(*), 1)::int")} as fcb_phone_is_same
  from {calls} x
  left join (select cuid, make_timestamp(max(req_ts // 1000) * 1000000) as at from en_vehicle
    where automodel not like '%П/%' and automodel not like '%ПРИЦЕП%' group by cuid) v on v.cuid = x.id_cuid and x.dtime_call_start >= v.at
  left join (select cuid, inserted_date, networkoperatorname, if(upper(device_manufacturer) = 'IPHONE', 1, 0) as flag_device_iphone,
      if(upper(device_manufacturer) = 'SAMSUNG', 1, 0) as flag_device_samsung, if(upper(device_manufacturer) in ('IPHONE', 'SAMSUNG'), 0, 1) as flag_device_other,
      case when timezoneid is null then null when timezoneid in ('Asia/Almaty', 'Etc/GMT+6') then 0 else 1 end as flag_diff_time_zone
    from (select *, row_number() over (partition by cuid order by inserted_date, tie) as n from en_device) where n = 1) g
    on g.cuid = x.id_cuid and g.inserted_date < x.dtime_call_start)"""


_ALERTS_SQL = """alerts as (select * from (select h.iin, h.ruleid, h.insert_time, p.value_new,
  row_number() over (partition by h.iin, h.ruleid order by h.insert_time desc, h.id desc) as n
  from fx_alerts h join en_param p on h.id = p.id and p.key = 'value') where n = 1)"""
_CALL_KEYS_SQL = """called as (select interaction_id, phone_number, cuid as id_cuid, cuid as skp_client,
  'Customer#' || lpad(cast(cuid as varchar), 9, '0') as pif_identification_code, dtime_call_start from fx_calls)"""


@check("engagement", "select * from engaged", _ALERTS_SQL, _CALL_KEYS_SQL, engagement_sql("called"))
def engagement(spark, folder):
    calls = view(spark, folder, "fx_calls").select(
        "interaction_id",
        "phone_number",
        F.col("cuid").alias("id_cuid"),
        F.col("cuid").alias("skp_client"),
        F.concat(F.lit("Customer#"), F.lpad(F.col("cuid").cast("string"), 9, "0")).alias("pif_identification_code"),
        "dtime_call_start",
    )
    made = {name: view(spark, folder, v) for name, v in MADE.items()}
    return P4.engagement(calls, made, CTX, MESSAGE_WINDOWS, ALERT_DAYS)


@check(
    "training_frame",
    """select * exclude (raw_phone), date_diff('day', last_dtime_call, dtime_call_start)::int as past_days_last_call,
    (epoch(date_trunc('second', dtime_call_start)) - epoch(date_trunc('second', last_dtime_call)))::bigint as past_sec_last_call,
    (epoch(date_trunc('second', dtime_call_start)) - epoch(date_trunc('second', last_dtime_call))) / 60.0 as past_min_last_call,
    (epoch(date_trunc('second', dtime_call_start)) - epoch(date_trunc('second', last_dtime_call))) / 3600.0 as past_hour_last_call from engaged""",
    pairs_sql(),
    _FEATURES_SQL,
    _PREVIOUS_SQL,
    _ATTRIBUTES_SQL,
    _ALERTS_SQL,
    "named as (select previous.*, features.* exclude (id), attributes.* exclude (phone_number, cuid) from previous join features on id = interaction_id "
    "left join attributes on attributes.phone_number = previous.phone_number and attributes.cuid = previous.cuid)",
    engagement_sql("named"),
)
def training_frame(spark, folder):
    return build_training(
        view(spark, folder, "fx_calls").drop("raw_phone"),
        {name: view(spark, folder, v) for name, v in CLIENTS.items()},
        {name: view(spark, folder, v) for name, v in MADE.items()},
        CTX,
        call_windows=DAY_WINDOWS,
        message_windows=MESSAGE_WINDOWS,
        alert_span=ALERT_DAYS,
    )


# --- P5 ---------------------------------------------------------------------------------------

_RECENT = f"part_date > {d(LOOSE)} and dtime_call_start between {AS_OF} - interval 21 days and {AS_OF}"
_DAILY_SQL = (
    f"""counted as (select phone_number, cuid, {RATES_SQL}, count(*) filter (where interaction_type_code = 'INBOUND') as cnt_in_calls_6m,
  date_diff('day', max(dtime_call_start), {AS_OF})::int as days_call, date_diff('day', max(if({OK}, dtime_call_start, null)), {AS_OF})::int as days_ok,
  arg_min(interaction_type_code, (dtime_call_start, interaction_id)) as first_code from fx_calls where {_RECENT} group by phone_number, cuid)""",
    "known as (select distinct phone_number, external_id as cuid from fx_contacts where active_yn = 1 and official_yn = 1)",
    f"""texts as (select right(phone, 10) as phone_number, count(*) as n from fx_messages
  where part_date > {d(LOOSE)} and input_date between {AS_OF} - interval 21 days and {AS_OF} group by 1)""",
    """kinds as (select phone_number, external_id as cuid, classification from (select k.phone_number, o.external_id, k.classification,
    row_number() over (partition by k.phone_number, o.external_id order by o.modified_ts desc, k.contact_id desc) as n
    from fx_contacts k join (select id, external_id, max(modified_ts) as modified_ts from cl_role group by all) o on o.id = k.party_role_id) where n = 1
    and (phone_number, external_id) in (select (phone_number, cuid) from known))""",
    """daily as (select coalesce(k.phone_number, c.phone_number) as phone_number, coalesce(k.cuid, c.cuid) as cuid, if(k.cuid is null, '0', '1') as pif_finded_status,
  """
    + ", ".join(
        f"coalesce({r}, 0.0) as {r}"
        for r in ["rate_connect_mor", "rate_connect_after", "rate_connect_even"]
        + [f"rate_connect_{w}" for w in ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")]
    )
    + """, coalesce(cnt_in_calls_6m, 0) as cnt_in_calls_6m,
  case coalesce(t.classification, '') when 'CONTACT_PHONE' then 2 when 'HOME_PHONE' then 5 when 'PRIMARY_MOBILE' then 9 when 'SECONDARY_MOBILE' then 11 else -1 end as pif_phone_type_code,
  coalesce(days_ok, -1) as past_days_last_succ_call, coalesce(days_call, -1) as past_days_last_call, coalesce(x.n, 0) as cnt_success_sms_6m,
  case first_code when 'OUTBOUND' then 1 when 'INBOUND' then 2 when 'INTERNAL' then 3 else -1 end as last_interaction_type_code
  from known k full join counted c on k.phone_number = c.phone_number and k.cuid = c.cuid
  left join kinds t on t.phone_number = coalesce(k.phone_number, c.phone_number) and t.cuid = coalesce(k.cuid, c.cuid)
  left join texts x on x.phone_number = coalesce(k.phone_number, c.phone_number))""",
)


def features(spark, folder):
    contacts = view(spark, folder, "fx_contacts")
    known = contacts.where("active_yn = 1 and official_yn = 1").withColumnRenamed("external_id", "cuid")
    roles = view(spark, folder, "cl_role")
    roles = dedupe.latest_per(roles, ["id"], "modified_ts", "role_tie")
    types = P5.phone_type_rows(contacts, roles)
    calls, messages = view(spark, folder, "fx_calls"), view(spark, folder, "fx_messages")
    return P5.daily_features(calls, known, types, messages, CTX, SPAN, LOOSE)


@check("daily_features", "select * from daily", *_DAILY_SQL)
def daily_features(spark, folder):
    return features(spark, folder)


@check("published_features", "select * from daily", *_DAILY_SQL)
def published_features(spark, folder):
    return sinks.publish_view(features(spark, folder), "published_features", P5.published_columns())


CALL_TYPES = {
    **dict.fromkeys(["callid", "raw_phone", "phone_number", "weekday", "day_part"], "string"),
    **dict.fromkeys(["interaction_type_code", "code_call_result_type", "call_source"], "string"),
    **dict.fromkeys(["dtime_call_start", "dtime_call_end"], "timestamp_ntz"),
    **dict.fromkeys(["interaction_id", "cuid", "talk_duration"], "bigint"),
    **dict.fromkeys(["h_date", "part_date"], "int"),
}


@check(
    "profile_features",
    " union all ".join(
        f"""select '{c}' as column_name, '{t}' as column_type, count(*) as rows, count(*) filter (where {c} is null) as nulls
        from fx_calls"""
        for c, t in CALL_TYPES.items()
    ),
)
def profile_features(spark, folder):
    return profile(view(spark, folder, "fx_calls"))


# --- P6 ---------------------------------------------------------------------------------------

_SCORED_SQL = f"""scored as (select phone_number, cuid, {score_sql(WEIGHTS, INTERCEPT)} as score
  from (select *, 3 as weekday from daily where length(phone_number) in (10, 11)))"""
_BANDED_SQL = """banded as (select *, cast((10 * row_number() over (order by round(score, 12) desc, phone_number, cuid) + count(*) over () - 1) // count(*) over () as int) as band
  from scored)"""
RANK = [*_DAILY_SQL, _SCORED_SQL, _BANDED_SQL]


def linear():
    """The stand-in model's score to 12 digits, so that sums in another order rank the same."""
    return F.round(scoring.logistic(WEIGHTS, INTERCEPT), 12)


def scored(spark, folder):
    return P6.scored(features(spark, folder), linear(), CTX)


def rounded(df):
    return df.withColumn("score", F.round("score", 6))


@check("score_linear", "select phone_number, cuid, round(score, 6) as score from scored", *RANK)
def score_linear(spark, folder):
    return rounded(scored(spark, folder))


@check("score_udf", "select phone_number, cuid, round(score, 6) as score from scored", *RANK)
def score_udf(spark, folder):
    return rounded(P6.scored(features(spark, folder), loader(WEIGHTS, INTERCEPT), CTX))


@check("score_bands", "select phone_number, cuid, band from banded", *RANK)
def score_bands(spark, folder):
    return scoring.score_bands(scored(spark, folder), tie=PAIR).select(*PAIR, "band")


_ROWS_SQL = f"""rows_ as (select 'all' as segment, phone_number, cuid, round({score_sql(WEIGHTS, INTERCEPT)}, 12) as score from (select *, 3 as weekday from daily)
  union all select 'primary', phone_number, cuid, round({score_sql(MOBILE_WEIGHTS)}, 12) from daily where pif_phone_type_code = 9)"""


@check(
    "segment_scores",
    """select segment, phone_number, cuid, round(score, 6) as score,
    cast(ceil(10.0 * row_number() over (partition by segment order by score desc, phone_number, cuid) / count(*) over (partition by segment)) as int) as band
    from rows_ where length(phone_number) in (10, 11)""",
    *_DAILY_SQL,
    _ROWS_SQL,
)
def segment_scores(spark, folder):
    table = stage(features(spark, folder).withColumn("weekday", F.lit(3)), "features")
    segments = {
        "all": (F.lit(True), linear(), list(WEIGHTS)),
        "primary": (F.col("pif_phone_type_code") == 9, F.round(scoring.logistic(MOBILE_WEIGHTS), 12), list(MOBILE_WEIGHTS)),
    }
    return rounded(P6.segment_output(table, segments))


@check(
    "top_scores",
    "select phone_number, cuid, round(score, 6) as score from scored order by round(scored.score, 12) desc, phone_number, cuid limit 100",
    *RANK,
)
def top_scores(spark, folder):
    return rounded(scoring.top_scores(scored(spark, folder), 100, tie=PAIR))


@check(
    "best_phone_per_client",
    """select cuid, phone_number, round(score, 6) as score from (select *, row_number() over
    (partition by cuid order by round(score, 12) desc, phone_number) as n from scored) where n = 1""",
    *RANK,
)
def best_phone_per_client(spark, folder):
    return rounded(scoring.best_per_client(scored(spark, folder), "cuid", 1, tie=["phone_number"])).select("cuid", "phone_number", "score")


@check(
    "export_chunks",
    """select (r - 1) // 500 as chunk_no, count(*) as rows, min(phone_number) as min_key, max(phone_number) as max_key
    from (select phone_number, row_number() over (order by round(score, 12) desc, phone_number, cuid) as r from scored) group by 1""",
    *RANK,
)
def export_chunks(spark, folder):
    order = [F.col("score").desc(), F.col("phone_number").asc(), F.col("cuid").asc()]
    return scoring.export_chunks(scored(spark, folder), order, 500, "phone_number")


@check(
    "score_output",
    """select phone_number as PHONE_NUMBER, cuid as ID_CUID, '31.01.2024' as DATE_, round(score, 6) as SCORE, 20240131 as SK_DATE_SCORE,
    band as SCORE_GROUP, '31.01.2024 00:00:00' as SK_DTIME_SCORE from banded""",
    *RANK,
)
def score_output(spark, folder):
    out = P6.score_output(features(spark, folder), linear(), CTX)
    return out.withColumn("SCORE", F.round("SCORE", 6))


TREES = [
    ("cnt_in_calls_6m", 1.5, ("rate_connect_mor", 0.25, 0.2, ("past_days_last_call", 9.5, 0.45, 0.35)), ("rate_connect_even", 0.5, 0.6, 0.8)),
    ("past_days_last_succ_call", 2.5, ("past_days_last_succ_call", -0.5, 0.1, 0.7), ("cnt_success_sms_6m", 3.5, 0.3, ("rate_connect_friday", 0.1, 0.25, 0.4))),
    ("pif_phone_type_code", 4.5, 0.35, 0.5),
]
TREE_FEATURES = [
    "cnt_in_calls_6m", "rate_connect_mor", "past_days_last_call", "rate_connect_even", "past_days_last_succ_call", "cnt_success_sms_6m",
    "rate_connect_friday", "pif_phone_type_code",
]


def tree_sql(node) -> str:
    if not isinstance(node, tuple):
        return repr(float(node))
    name, threshold, left, right = node
    return f"case when {name} <= {threshold} then {tree_sql(left)} else {tree_sql(right)} end"


@check(
    "score_trees",
    f"""select phone_number, cuid, round(({' + '.join(tree_sql(t) for t in TREES)}) / {len(TREES)}, 6) as score
    from daily where length(phone_number) in (10, 11)""",
    *_DAILY_SQL,
)
def score_trees(spark, folder):
    """A forest walked by column expressions."""
    rows = P6.scored(features(spark, folder), forest(TREE_FEATURES, TREES).column(), CTX, TREE_FEATURES)
    return rounded(rows)


_DAILY_ROWS = "(select *, 3 as weekday from daily)"


@check(
    "monthly_scores",
    f"""select segment, phone_number as PHONE_NUMBER, cuid as ID_CUID, '31.01.2024' as DATE_, round(score, 6) as SCORE, 20240131 as SK_DATE_SCORE,
    cast(ceil(10.0 * row_number() over (partition by segment order by score desc, phone_number, cuid) / count(*) over (partition by segment)) as int) as SCORE_GROUP,
    '31.01.2024 00:00:00' as SK_DTIME_SCORE from rows_ where length(phone_number) in (10, 11)""",
    *_DAILY_SQL,
    _ROWS_SQL,
)
def monthly_scores(spark, folder):
    """Both segments in the output's columns."""
    segments = {
        "all": (F.lit(True), linear(), list(WEIGHTS)),
        "primary": (F.col("pif_phone_type_code") == 9, F.round(scoring.logistic(MOBILE_WEIGHTS), 12), list(MOBILE_WEIGHTS)),
    }
    out = P6.monthly_output(features(spark, folder), segments, CTX)
    return out.withColumn("SCORE", F.round("SCORE", 6))


# Two tables as far as the key hash goes: what slices hold, and how often each was loaded.
@check(
    "export_ledger",
    """select cast(chunk_no as bigint) as chunk_no, count(*) as rows,
    bit_xor(cast('0x' || left(md5(phone_number || '|' || cast(cuid as varchar)), 15) as bigint)) as key_hash, 1 as loads
    from (select *, (row_number() over (order by round(score, 12) desc, phone_number, cuid) - 1) // 500 as chunk_no from scored) group by chunk_no""",
    *RANK,
)
def export_ledger(spark, folder):
    """Slices loaded by a first call that fails at its second load and by one that goes on: each once."""
    order = [F.col("score").desc(), F.col("phone_number").asc(), F.col("cuid").asc()]
    rows, ledger, target = stage(scored(spark, folder), "scored"), new_path(spark, "ledger"), new_path(spark, "target")
    load, calls = delivery.to_folders(target), []

    def failing(part, numbers):
        calls.append(numbers)
        if len(calls) == 2:
            raise ConnectionError("lost")
        load(part, numbers)

    try:
        delivery.deliver_together(rows, order, 500, PAIR, failing, ledger, "scores")
    except ConnectionError:
        pass
    delivery.deliver_together(rows, order, 500, PAIR, failing, ledger, "scores")
    there = delivery.slice_plan(spark.read.parquet(target), PAIR).withColumnRenamed("chunk_no", "_chunk")
    loads = delivery.read_ledger(spark, ledger).groupBy("chunk_no", "rows", "key_hash").agg(F.count(F.lit(1)).cast("int").alias("loads"))
    same = (F.col("_chunk") == F.col("chunk_no")) & (there["rows"] == loads["rows"]) & (there["key_hash"] == loads["key_hash"])
    return loads.join(there, same, "left_semi")


# --- sinks ------------------------------------------------------------------------------------


@check("refresh_idempotent", "select part_date, interaction_id, talk_duration from fx_calls")
def refresh_idempotent(spark, folder):
    """All days written, then one day refreshed twice and another replaced alone: nothing doubles."""
    rows = view(spark, folder, "fx_calls").select("part_date", "interaction_id", "talk_duration")
    path = new_path(spark, "refreshed")
    sinks.refresh_partitions(rows, path)
    day = rows.where(F.col("part_date") == CTX.day_key(1))
    sinks.refresh_partitions(day, path)
    sinks.refresh_partitions(day, path)
    sinks.write_day(rows, path, CTX.day_key(2))
    return spark.read.parquet(path)


@check("published_days", "select part_date, interaction_id, talk_duration from fx_calls")
def published_days(spark, folder):
    """Days published at once, one of them twice, after a writer that died: readers see whole days only."""
    rows = view(spark, folder, "fx_calls").select("part_date", "interaction_id", "talk_duration")
    path = new_path(spark, "published")
    days = [r["part_date"] for r in rows.select("part_date").distinct().collect()]
    of_day = lambda d_: rows.where(F.col("part_date") == d_)
    published.publish_days({d_: of_day(d_) for d_ in days}, path)
    # What a writer leaves that ends before its manifest.
    of_day(days[0]).limit(1).write.parquet(f"{path}/data/part_date={days[0]}/attempt=broken")
    published.publish_days({days[1]: of_day(days[1])}, path)
    return published.read_published(spark, path)


@check(
    "clustered_files",
    "select count(*) as rows, 0 as overlaps, 0 as unsorted from fx_calls",
)
def clustered_files(spark, folder):
    """Files of one day hold phone ranges that do not overlap, each sorted."""
    rows = view(spark, folder, "fx_calls").select("part_date", "phone_number", "interaction_id")
    path = new_path(spark, "clustered")
    sinks.rebuild(rows, path, ["part_date"], ["phone_number", "interaction_id"], cluster=True)
    return file_ranges(spark.read.parquet(path), "part_date", ["phone_number", "interaction_id"])


def file_ranges(table, partition: str, keys: list[str]):
    """Rows of a stored table, its files whose key range begins before the one before ends, and rows out of order in a file."""
    key = F.struct(*keys)
    placed = table.select(partition, key.alias("key"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))
    in_file = Window.partitionBy("file").orderBy("place")
    placed = placed.withColumn("before", F.lag("key").over(in_file))
    files = placed.groupBy(partition, "file").agg(
        F.count(F.lit(1)).alias("rows"), F.min("key").alias("low"), F.max("key").alias("high"), F.count_if(F.col("key") < F.col("before")).alias("unsorted")
    )
    before = F.max("high").over(Window.partitionBy(partition).orderBy("low", "file").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("below", before).agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("low") < F.col("below")).cast("int").alias("overlaps"), F.sum("unsorted").cast("int").alias("unsorted")
    )


@check("rebuild_roundtrip", "select part_date, phone_number, interaction_id from fx_calls")
def rebuild_roundtrip(spark, folder):
    """A table rebuilt twice, partitioned by day and sorted by phone."""
    rows = view(spark, folder, "fx_calls").select("part_date", "phone_number", "interaction_id")
    path = new_path(spark, "rebuilt")
    sinks.rebuild(rows, path)
    sinks.rebuild(rows, path, ["part_date"], ["phone_number"])
    return spark.read.parquet(path)


@check(
    "run_log",
    """select 'daily' as job, 'STARTED' as status, 0 as source_rows, 0 as target_rows, cast(null as timestamp) as max_source_date
    union all select 'daily', 'FINISHED', (select count(*) from fx_calls), (select count(*) from fx_contacts),
    (select max(dtime_call_start) from fx_calls)""",
)
def run_log(spark, folder):
    calls, contacts = view(spark, folder, "fx_calls"), view(spark, folder, "fx_contacts")
    path = new_path(spark, "runs")

    def work():
        seen = calls.agg(F.count(F.lit(1)), F.max("dtime_call_start")).first()
        return seen[0], contacts.count(), seen[1]

    sinks.logged_run(spark, path, "daily", "run-1", work, clock=lambda: datetime(2024, 1, 31))
    return spark.read.parquet(path).select("job", "status", "source_rows", "target_rows", "max_source_date")
