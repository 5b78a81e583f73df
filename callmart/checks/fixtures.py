"""The driver tables in the shapes the operators read, as Spark frames and as SQL.

Every event and every order is used; the views only rename, derive and classify. Events are split
by their type into the two call sources and the messages. Internal calls come from extension
numbers (prefix 84), which no contact record holds.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from callmart.context import RunContext
from callmart.sources.tables import load

CTX = RunContext(datetime(2024, 1, 31))

_K = "cast(get_json_object(props, '$.k') as int)"
_RAW = "case when event_type = 'error' then '84' else '87' end || lpad(cast(user_id as string), 9, '0')"
_DK = "cast(year(ts) * 10000 + month(ts) * 100 + day(ts) as int)"
_IDENT = "'Customer#' || lpad(cast({} as string), 9, '0')"

# Each fixture: source table, filter, and column expressions in Spark SQL.
VIEWS = {
    "fx_calls": (
        "events",
        "event_type in ('click', 'purchase', 'error')",
        {
            "interaction_id": "event_id",
            "callid": "cast(event_id as string)",
            "cuid": "user_id",
            "raw_phone": _RAW,
            "phone_number": f"right({_RAW}, 10)",
            "dtime_call_start": "ts",
            "dtime_call_end": "ts",
            "weekday": "date_format(ts, 'EEEE')",
            "h_date": "cast(hour(ts) as int)",
            "day_part": "case when hour(ts) between 9 and 12 then 'Morning' when hour(ts) between 13 and 17 then 'Afternoon' "
            "when hour(ts) between 18 and 21 then 'Evening' else 'Night' end",
            "talk_duration": "cast(case when event_type = 'purchase' or (event_type = 'click' and value > 60) "
            "then floor(value) else 0 end as bigint)",
            "interaction_type_code": "case when event_type = 'error' then 'INTERNAL' when event_type = 'purchase' "
            "and value >= 30 then 'INBOUND' else 'OUTBOUND' end",
            "code_call_result_type": "case when event_type = 'purchase' then 'ANSWER' when event_type = 'error' "
            "then 'NO_ANSWER' when value <= 60 then 'BUSY' end",
            "call_source": "'GENESYS'",
            "part_date": _DK,
        },
    ),
    "fx_calls2": (
        "events",
        "event_type = 'signup'",
        {
            "abonentnumber": f"right({_RAW}, 10)",
            "datetimestart": "ts",
            "datetimestop": "ts",
            "isoutput": f"case when {_K} >= 50 then 1 else 0 end",
            "alinenum": f"case when {_K} < 15 then 'IVR' else 'LINE' end",
            "blinenum": f"case when {_K} between 10 and 20 then null else 'B' end",
            "lentime": "cast(floor(value) as bigint)",
            "callresult": _K,
            "part_date": _DK,
        },
    ),
    "fx_messages": (
        "events",
        "event_type = 'view'",
        {
            "phone": f"'+' || {_RAW}",
            "cuid": "user_id",
            "input_date": "ts",
            "type": f"case when {_K} < 40 then 'PUSH_VIEWED' when {_K} < 50 then 'CALLBACK_PUSH' else 'OTHER' end",
            "part_date": _DK,
        },
    ),
    "fx_contacts": (
        "orders",
        "true",
        {
            "contact_id": "o_orderkey",
            "phone_number": "right('87' || lpad(cast(o_custkey as string), 9, '0'), 10)",
            "external_id": "o_custkey",
            "party_role_id": "o_custkey",
            "classification": "case o_orderpriority when '1-URGENT' then 'PRIMARY_MOBILE' when '2-HIGH' then 'SECONDARY_MOBILE' "
            "when '3-MEDIUM' then 'HOME_PHONE' when '4-NOT SPECIFIED' then 'CONTACT_PHONE' else 'OTHER_PHONE' end",
            "modified_ts": "o_orderdate",
            "active_yn": "case when o_orderstatus = 'P' then 0 else 1 end",
            "official_yn": "case when o_totalprice < 400000 then 1 else 0 end",
        },
    ),
    "fx_alerts": (
        "events",
        "event_type in ('error', 'signup')",
        {
            "id": "event_id",
            "iin_key": "user_id",
            "iin": _IDENT.format("user_id"),
            "insert_time": "ts",
            "k": _K,
            "ruleid": f"case when {_K} < 20 then '2' when {_K} < 40 then '4' when {_K} < 60 then '8' when {_K} < 80 then '16' else '21' end",
            "value_new": f"'+7-' || substr(lpad(cast(case when {_K} >= 70 then user_id + 1 else user_id end as string), 9, '0'), 1, 3) "
            f"|| '-' || substr(lpad(cast(case when {_K} >= 70 then user_id + 1 else user_id end as string), 9, '0'), 4, 6)",
            "part_date": _DK,
        },
    ),
    # Raw facts of the first call source.
    "raw_interaction": (
        "events",
        "event_type in ('click', 'purchase', 'error')",
        {
            "interaction_id": "event_id",
            "media_server_ixn_guid": "'g' || cast(event_id as string)",
            "start_ts": "{epoch} - 21600",
            "end_ts": "{epoch} - 21600 + cast(floor(value) as bigint)",
            "interaction_type_key": "case event_type when 'click' then 0 when 'purchase' then 1 else 2 end",
            "target_address": f"({_RAW}) || '1'",
            "source_address": _RAW,
            "part_date": _DK,
        },
    ),
    "raw_resource_fact": (
        "events",
        "event_type in ('click', 'purchase', 'error', 'view')",
        {
            "interaction_id": "event_id",
            "talk_duration": "cast(floor(value) as bigint)",
            "resource_key": "user_id",
            "part_date": _DK,
        },
    ),
    "raw_attempt": (
        "events",
        "event_type in ('click', 'purchase')",
        {
            "callid": "'g' || cast(event_id as string)",
            "contact_info": f"case when {_K} < 50 then {_RAW} end",
            "call_result_key": _K,
            "campaign_key": f"cast(floor({_K} / 4) as int)",
            "record_field_37": f"case when {_K} = 99 then 'none' else cast(event_id as string) end",
        },
    ),
    "raw_session": (
        "events",
        "event_type <> 'view'",
        {"id_ses": "'g' || cast(event_id as string)", "cuid": "user_id", "begin_session": "ts"},
    ),
    "raw_session_action": (
        "lineitem",
        "true",
        {"id_ses": "'g' || cast(l_orderkey as string)", "id_action": "l_suppkey", "begin_action": "l_shipdate"},
    ),
    "raw_type": (
        "region",
        "true",
        {
            "interaction_type_key": "r_regionkey",
            "interaction_type": "case r_regionkey when 0 then 'Outbound' when 1 then 'Inbound' when 2 then 'Internal' else r_name end",
            "interaction_type_code": "case r_regionkey when 0 then 'OUTBOUND' when 1 then 'INBOUND' when 2 then 'INTERNAL' else r_name end",
        },
    ),
    "raw_result_type": (
        "nation",
        "true",
        {
            "id_source": "cast(n_nationkey as string)",
            "code_call_result_type": "case n_nationkey when 2 then 'BUSY' when 3 then 'NO_ANSWER' when 5 then 'ANSWER' else n_name end",
        },
    ),
    "raw_campaign": ("nation", "true", {"id_source": "cast(n_nationkey as string)", "name_call_campaign": "n_name"}),
    "raw_task": (
        "orders",
        "true",
        {"t_taskcalendar_id": "o_orderkey", "t_tasktype_1": "cast(substr(o_orderpriority, 1, 1) as int)"},
    ),
    "raw_task_type": (
        "region",
        "true",
        {"id_source": "cast(r_regionkey + 1 as string)", "code_camp_task_type": "r_name"},
    ),
    "raw_task_result": ("lineitem", "true", {"t_taskcalendar_1": "l_orderkey", "t_resulttype_1": "l_linenumber"}),
    "raw_task_result_type": (
        "nation",
        "true",
        {"id_source": "cast(n_nationkey as string)", "code_camp_task_result_type": "'RES_' || n_name"},
    ),
    "raw_comment": ("lineitem", "true", {"t_taskcalendar_1": "l_orderkey", "resultscomment": "l_returnflag"}),
    "raw_action": ("supplier", "true", {"id": "s_suppkey", "name": "s_name"}),
    "raw_resource": ("supplier", "true", {"resource_key": "s_suppkey"}),
    # Client records.
    "cl_role": (
        "orders",
        "true",
        {
            "id": "o_custkey",
            "party_id": "o_custkey",
            "external_id": "o_custkey",
            "modified_ts": "o_orderdate",
            "role_tie": "o_orderkey",
            "role_type_id": "'CUSTOMER_PER'",
        },
    ),
    "cl_party": ("customer", "true", {"id": "c_custkey", "active_yn": "case when c_acctbal < 0 then 0 else 1 end"}),
    "cl_person": (
        "customer",
        "true",
        {
            "id": "c_custkey",
            "gender_code": "case c_mktsegment when 'MACHINERY' then null when 'BUILDING' then 'F' else 'M' end",
            "birth_date_dt": "date_add(date '1960-01-01', cast(floor(c_acctbal) as int))",
            "identification_code": "case when c_nationkey > 0 then c_name end",
        },
    ),
    "cl_rel": (
        "customer",
        "true",
        {
            "id": "c_custkey",
            "maritalstatus_code": "case when c_nationkey < 5 then 'SINGLE' when c_nationkey < 10 then 'MARRIED' end",
            "education_code": "case when c_acctbal < 0 then 'SCHOOL' end",
            "housingtype_code": "c_mktsegment",
            "cust_childnum": "case when c_nationkey < 15 then cast(floor(c_nationkey / 5) as int) end",
        },
    ),
    "cl_registry": (
        "orders",
        "true",
        {
            "text_identification_number": _IDENT.format("o_custkey"),
            "skp_client": "o_custkey",
            "id_cuid": "o_custkey",
            "code_gender": "case when o_orderstatus = 'F' then 'f' else 'm' end",
            "date_birth": "case when o_orderstatus = 'O' then date '1980-05-05' end",
            "cnt_children": "case when o_orderpriority = '1-URGENT' then 2 when o_orderpriority = '2-HIGH' then 1 end",
            "code_education_type": "o_orderpriority",
            "dtime_modified": "o_orderdate",
            "tie": "o_orderkey",
        },
    ),
    "cl_state": (
        "events",
        "event_type = 'signup'",
        {
            "iin": _IDENT.format("user_id"),
            "cuid": "user_id",
            "gender_code": f"case when {_K} < 30 then '1' when {_K} < 60 then '0' else '9' end",
            "birthdate": f"case when {_K} < 25 then date '1990-02-03' end",
            "regaddress_district": f"case when {_K} < 20 then 'АЛМАТЫ' when {_K} < 40 then 'г.Шымкент' when {_K} < 60 then 'область Абай' "
            f"when {_K} < 70 then 'elsewhere' end",
            "req_ts": "ts",
            "tie": "event_id",
        },
    ),
    "cl_bureau": (
        "events",
        "event_type = 'purchase'",
        {
            "iin": _IDENT.format("user_id"),
            "cuid": "user_id",
            "region": f"case when {_K} < 50 then 'АКМОЛИНСКАЯ' else 'ШЫМКЕНТ' end",
            "education_id": f"case when {_K} >= 90 then 'x' else cast(cast(floor({_K} / 25) as int) as string) end",
            "matrialstatus_id": f"cast(cast(floor({_K} / 20) as int) + 1 as string)",
            "created_ts": "ts",
            "tie": "event_id",
        },
    ),
    "cl_marriage": ("orders", "o_orderstatus = 'F' and o_totalprice > 350000", {"cuid": "o_custkey", "actdate": "o_orderdate"}),
    "cl_divorce": ("orders", "o_orderstatus = 'O' and o_totalprice > 350000", {"cuid": "o_custkey", "actdate": "o_orderdate"}),
    # What the client did before the calls.
    "en_push": (
        "events",
        "event_type = 'view'",
        {
            "cuid": "cast(user_id as string)",
            "event_time_new": "ts",
            "type": f"case when {_K} < 40 then 'PUSH_VIEWED' when {_K} < 50 then 'CALLBACK_PUSH' else 'OTHER' end",
            "part_date": _DK,
        },
    ),
    "en_vehicle": (
        "events",
        "event_type in ('signup', 'view')",
        {
            "cuid": "user_id",
            "req_ts": "{epoch} * 1000 + 7",
            "automodel": f"case when {_K} < 30 then 'ПРИЦЕП ' || props when {_K} < 40 then 'A П/Б' when {_K} < 45 then null else 'SEDAN' end",
            "tie": "event_id",
        },
    ),
    "en_case": (
        "events",
        "event_type in ('signup', 'purchase')",
        {
            "skp_client": "user_id",
            "date_decision": "ts",
            "skp_product": f"cast({_K} as bigint)",
            "skp_credit_status": "case when value < 20 then 2 when value < 40 then 8 else 3 end",
        },
    ),
    "en_product": (
        "part",
        "true",
        {
            "skp_product": "p_partkey",
            "code_product_type": "case p_type when 'ECONOMY' then 'REV' when 'SMALL' then 'CAL' when 'PROMO' then 'COL' else p_type end",
        },
    ),
    "en_device": (
        "events",
        "event_type = 'signup'",
        {
            "cuid": "user_id",
            "device_manufacturer": f"case when {_K} < 25 then 'iPhone' when {_K} < 50 then 'samsung' when {_K} < 75 then 'Other' end",
            "networkoperatorname": "'NET' || cast(isoutput_k as string)".replace("isoutput_k", _K),
            "timezoneid": f"case when {_K} < 30 then 'Asia/Almaty' when {_K} < 60 then 'Europe/Oslo' when {_K} < 80 then 'Etc/GMT+6' end",
            "inserted_date": "ts",
            "tie": "event_id",
        },
    ),
    "en_param": (
        "events",
        "event_type in ('error', 'signup')",
        {
            "id": "event_id",
            "key": f"case when {_K} < 95 then 'value' else 'note' end",
            "value_new": f"'+7-' || substr(lpad(cast(case when {_K} >= 70 then user_id + 1 else user_id end as string), 9, '0'), 1, 3) "
            f"|| '-' || substr(lpad(cast(case when {_K} >= 70 then user_id + 1 else user_id end as string), 9, '0'), 4, 6)",
        },
    ),
}

_SPARK_EPOCH = "unix_timestamp(cast(ts as timestamp))"
_DUCK_EPOCH = "cast(floor(epoch(ts)) as bigint)"


_schemas: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. Its schema is read once; reading it again for every use costs a job each."""
    df = load(spark, folder, f"{name}.parquet", _schemas.get((folder, name)))
    _schemas.setdefault((folder, name), df.schema)
    return df


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A fixture as a Spark frame."""
    source, where, columns = VIEWS[name]
    exprs = [F.expr(e.replace("{epoch}", _SPARK_EPOCH)).alias(c) for c, e in columns.items()]
    return table(spark, folder, source).where(where).select(*exprs)


def _duck(expression: str) -> str:
    for spark_sql, duck_sql in (
        ("{epoch}", _DUCK_EPOCH),
        (_K, "cast(json_extract_string(props, '$.k') as int)"),
        ("date_format(ts, 'EEEE')", "dayname(ts)"),
        ("date_add(date '1960-01-01', cast(floor(c_acctbal) as int))", "date '1960-01-01' + cast(floor(c_acctbal) as int)"),
    ):
        expression = expression.replace(spark_sql, duck_sql)
    return expression.replace(" as string)", " as varchar)")


def view_sql(name: str) -> str:
    """The same fixture as a SQL query."""
    source, where, columns = VIEWS[name]
    picked = ", ".join(f"{_duck(e)} as {c}" for c, e in columns.items())
    return f"select {picked} from {source} where {where}"


def with_views(sql: str, *extra: str) -> str:
    """Put the definitions of the fixtures a statement names in front of it.

    ``extra`` are further named queries (``name as (...)``) that may use the fixtures.
    """
    text = sql + " ".join(extra)
    named = [f"{n} as ({view_sql(n)})" for n in VIEWS if n in text]
    parts = [*named, *extra]
    return f"with {', '.join(parts)} {sql}" if parts else sql
