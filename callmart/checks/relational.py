"""Joins, grouping, set operations and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from callmart.checks.fixtures import CTX, table, view
from callmart.checks.registry import AS_OF, OK, check, d
from callmart.fixed_values import RULE_COUNTS, RULE_FLAGS
from callmart.functions.calendar import elapsed
from callmart.functions.phone import phone_key
from callmart.operators import categories, dedupe, joins, quality, scans
from callmart.plans.call_log import second_source_calls
from callmart.plans.daily_features import official_contacts, recent_messages

PAIR = ["phone_number", "cuid"]


def pairs(spark, folder):
    return view(spark, folder, "fx_contacts").withColumnRenamed("external_id", "cuid")


@check(
    "join_inner_agg",
    """select a.cuid, sum_talk, max_id from (select cuid, sum(talk_duration)::bigint as sum_talk from fx_calls group by cuid) a
    join (select iin_key, max(id) as max_id from fx_alerts group by iin_key) b on a.cuid = b.iin_key""",
)
def join_inner_agg(spark, folder):
    talk = view(spark, folder, "fx_calls").groupBy("cuid").agg(F.sum("talk_duration").alias("sum_talk"))
    newest = view(spark, folder, "fx_alerts").groupBy("iin_key").agg(F.max("id").alias("max_id"))
    # Both sides were just grouped by the key and have one row per key: they join where they are.
    return joins.lookup(talk, newest, {"cuid": "iin_key"}, how="inner", in_place=True)


@check(
    "join_left_lookup",
    """select o_orderkey, c_mktsegment, n_name from orders left join customer on o_custkey = c_custkey
    left join nation on c_nationkey = n_nationkey""",
)
def join_left_lookup(spark, folder):
    out = joins.lookup(table(spark, folder, "orders"), table(spark, folder, "customer"), {"o_custkey": "c_custkey"}, ["c_mktsegment", "c_nationkey"])
    out = joins.lookup(out, table(spark, folder, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name"])
    return out.select("o_orderkey", "c_mktsegment", "n_name")


@check(
    "join_full_filtered",
    "select p_partkey, l_orderkey, l_linenumber from part full join lineitem on p_partkey = l_partkey where l_orderkey is not null",
)
def join_full_filtered(spark, folder):
    parts = table(spark, folder, "part").withColumn("part", F.col("p_partkey"))
    out = joins.lookup(table(spark, folder, "lineitem"), parts, {"l_partkey": "p_partkey"}, ["part"])
    return out.select(F.col("part").alias("p_partkey"), "l_orderkey", "l_linenumber")


@check(
    "join_left_notnull",
    """select distinct c.cuid, k.classification from (select distinct phone_number, cuid from fx_calls) c
    left join fx_contacts k on k.phone_number = c.phone_number and k.external_id = c.cuid where k.phone_number is not null""",
)
def join_left_notnull(spark, folder):
    users = view(spark, folder, "fx_calls").select(*PAIR).distinct()
    found = joins.lookup(users, pairs(spark, folder), PAIR, ["classification"], how="inner")
    return found.select("cuid", "classification").distinct()


@check(
    "join_full_coalesce",
    """select coalesce(k.phone_number, c.phone_number) as phone_number, coalesce(k.cuid, c.cuid) as cuid, coalesce(calls, 0) as calls
    from (select distinct phone_number, external_id as cuid from fx_contacts) k
    full join (select phone_number, cuid, count(*) as calls from fx_calls group by all) c on k.phone_number = c.phone_number and k.cuid = c.cuid""",
)
def join_full_coalesce(spark, folder):
    known = dedupe.dedupe(pairs(spark, folder), PAIR)
    counted = view(spark, folder, "fx_calls").groupBy(*PAIR).agg(F.count(F.lit(1)).alias("calls"))
    return joins.outer_merge(known, counted, PAIR).na.fill(0, ["calls"])


@check(
    "join_anti",
    """select distinct phone_number, cuid from fx_calls c
    where not exists (select 1 from fx_contacts k where k.phone_number = c.phone_number and k.external_id = c.cuid)""",
)
def join_anti(spark, folder):
    users = view(spark, folder, "fx_calls").select(*PAIR).distinct()
    return joins.missing_rows(users, pairs(spark, folder), PAIR)


@check(
    "join_backfill",
    """select * from matched union all
    select interaction_id, null, null from fx_calls where interaction_id not in (select interaction_id from matched)""",
    "k as (select phone_number, max(contact_id) as contact_id, count(*) as contacts from fx_contacts group by phone_number)",
    "matched as (select interaction_id, contact_id, contacts from fx_calls join k using (phone_number))",
)
def join_backfill(spark, folder):
    known = view(spark, folder, "fx_contacts").groupBy("phone_number").agg(
        F.max("contact_id").alias("contact_id"), F.count(F.lit(1)).alias("contacts")
    )
    out = joins.lookup(view(spark, folder, "fx_calls"), known, ["phone_number"])
    return out.select("interaction_id", "contact_id", "contacts")


@check(
    "join_semi",
    """select right(phone, 10) as phone_number, input_date from fx_messages
    where right(phone, 10) in (select phone_number from fx_calls where code_call_result_type = 'ANSWER')""",
)
def join_semi(spark, folder):
    texts = view(spark, folder, "fx_messages").select(phone_key("phone").alias("phone_number"), "input_date")
    answered = view(spark, folder, "fx_calls").where("code_call_result_type = 'ANSWER'")
    return joins.restrict_to(texts, answered, ["phone_number"])


@check(
    "join_semi_pair",
    """select contact_id, phone_number, external_id as cuid from fx_contacts k
    where exists (select 1 from fx_calls c where c.phone_number = k.phone_number and c.cuid = k.external_id)""",
)
def join_semi_pair(spark, folder):
    known = pairs(spark, folder).select("contact_id", *PAIR)
    return joins.restrict_to(known, view(spark, folder, "fx_calls"), PAIR)


@check(
    "join_null_safe",
    """select label, count(*) as rows from fx_calls2 c join
    (select distinct blinenum as line, coalesce(blinenum, 'none') as label from fx_calls2) l on c.blinenum is not distinct from l.line group by label""",
)
def join_null_safe(spark, folder):
    calls = view(spark, folder, "fx_calls2").select("blinenum")
    labels = calls.distinct().select(F.col("blinenum").alias("line"), F.coalesce("blinenum", F.lit("none")).alias("label"))
    out = joins.lookup(calls, labels, {"blinenum": "line"}, ["label"], how="inner", null_safe=True)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


@check(
    "join_chain",
    """select k.contact_id, k.phone_number, r.external_id as cuid from cl_party p
    join (select distinct id, party_id, external_id, role_type_id from cl_role) r on p.id = r.party_id
    join fx_contacts k on k.party_role_id = r.id
    where k.active_yn = 1 and k.official_yn = 1 and p.active_yn = 1 and r.role_type_id = 'CUSTOMER_PER'""",
)
def join_chain(spark, folder):
    roles = dedupe.dedupe(view(spark, folder, "cl_role"), ["id", "party_id", "external_id", "role_type_id"])
    contacts = view(spark, folder, "fx_contacts").drop("external_id")
    return official_contacts(view(spark, folder, "cl_party"), roles, contacts).select("contact_id", *PAIR)


@check(
    "star_join",
    """select r_name, p_type, s_nationkey, count(*) as rows, sum(l_quantity) as sum_qty from lineitem
    join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    group by all""",
)
def star_join(spark, folder):
    t = lambda name: table(spark, folder, name)
    whole = joins.star_join(
        t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity"),
        [
            (t("part"), {"l_partkey": "p_partkey"}, ["p_type"]),
            (t("supplier"), {"l_suppkey": "s_suppkey"}, ["s_nationkey"]),
            (t("orders"), {"l_orderkey": "o_orderkey"}, ["o_custkey"]),
            (t("customer"), {"o_custkey": "c_custkey"}, ["c_nationkey"]),
            (t("nation"), {"c_nationkey": "n_nationkey"}, ["n_regionkey"]),
            (t("region"), {"n_regionkey": "r_regionkey"}, ["r_name"]),
        ],
    )
    return whole.groupBy("r_name", "p_type", "s_nationkey").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("sum_qty")
    )


@check(
    "enrich_chain",
    """select interaction_id, c_mktsegment, n_name, r_name from fx_calls left join customer on cuid = c_custkey
    left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
)
def enrich_chain(spark, folder):
    t = lambda name: table(spark, folder, name)
    out = joins.enrich(
        view(spark, folder, "fx_calls").select("interaction_id", "cuid"),
        [
            (t("customer"), {"cuid": "c_custkey"}, ["c_mktsegment", "c_nationkey"]),
            (t("nation"), {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]),
            (t("region"), {"n_regionkey": "r_regionkey"}, ["r_name"]),
        ],
    )
    return out.select("interaction_id", "c_mktsegment", "n_name", "r_name")


@check(
    "lookup_latest",
    """select c.interaction_id, k.classification, k.contact_id from fx_calls c left join (
      select *, row_number() over (partition by external_id order by modified_ts desc, contact_id desc) as n from fx_contacts where active_yn = 1) k
    on k.external_id = c.cuid and k.n = 1""",
)
def lookup_latest(spark, folder):
    live = scans.active(view(spark, folder, "fx_contacts"), ["active_yn"], [])
    out = joins.lookup(
        view(spark, folder, "fx_calls").select("interaction_id", "cuid"),
        live, {"cuid": "external_id"}, ["classification", "contact_id"], latest_by=("modified_ts", "contact_id"),
    )
    return out.drop("cuid")


_MERGED = """m as (select k.phone_number as k_phone, k.cuid as k_cuid, c.phone_number as c_phone, c.cuid as c_cuid
  from (select distinct phone_number, external_id as cuid from fx_contacts) k
  full join (select distinct phone_number, cuid from fx_calls) c on k.phone_number = c.phone_number and k.cuid = c.cuid)"""
_FIRST_CODE = """f as (select phone_number, cuid, interaction_type_code as code from (
  select *, row_number() over (partition by phone_number, cuid order by dtime_call_start, interaction_id) as n from fx_calls) where n = 1)"""


@check(
    "lookup_fallback",
    """select coalesce(k_phone, c_phone) as phone_number, coalesce(k_cuid, c_cuid) as cuid, coalesce(a.code, b.code) as code
    from m left join f a on a.phone_number = k_phone and a.cuid = k_cuid left join f b on b.phone_number = c_phone and b.cuid = c_cuid""",
    _MERGED,
    _FIRST_CODE,
)
def lookup_fallback(spark, folder):
    side = lambda df, p: dedupe.dedupe(df, PAIR).select(
        *PAIR, F.col("phone_number").alias(f"{p}_phone"), F.col("cuid").alias(f"{p}_cuid")
    )
    calls = view(spark, folder, "fx_calls")
    merged = joins.outer_merge(side(pairs(spark, folder), "k"), side(calls, "c"), PAIR)
    first = dedupe.first_per(calls, PAIR, "dtime_call_start", "interaction_id")
    first = first.select(*PAIR, F.col("interaction_type_code").alias("code_"))
    out = joins.lookup_fallback(
        merged, first, {"k_phone": "phone_number", "k_cuid": "cuid"}, {"c_phone": "phone_number", "c_cuid": "cuid"}, "code_", "code"
    )
    return out.select(*PAIR, "code")


@check(
    "attach_features",
    """select interaction_id, n as calls_that_day from fx_calls join
    (select phone_number, cuid, part_date, count(*) as n from fx_calls group by all) using (phone_number, cuid, part_date)""",
)
def attach_features(spark, folder):
    calls = view(spark, folder, "fx_calls").select("interaction_id", *PAIR, "part_date")
    counted = calls.groupBy(*PAIR, "part_date").agg(F.count(F.lit(1)).alias("calls_that_day"))
    return joins.attach(calls, counted, [*PAIR, "part_date"]).select("interaction_id", "calls_that_day")


@check(
    "kv_param",
    """select iin, ruleid, insert_time, value_new from (
      select h.iin, h.ruleid, h.insert_time, p.value_new, row_number() over (partition by h.iin, h.ruleid order by h.insert_time desc, h.id desc) as n
      from fx_alerts h join en_param p on h.id = p.id and p.key = 'value' where h.ruleid in ('2', '4', '8', '16', '21')) where n = 1""",
)
def kv_param(spark, folder):
    headers = view(spark, folder, "fx_alerts").select("id", "iin", "ruleid", "insert_time")
    named = joins.kv_param(headers, view(spark, folder, "en_param"), "value", [*RULE_COUNTS, *RULE_FLAGS], ["value_new"])
    newest = dedupe.latest_per(named, ["iin", "ruleid"], "insert_time", "id")
    return newest.select("iin", "ruleid", "insert_time", "value_new")


@check(
    "latest_if_before",
    """select o.o_orderkey, if(s.o_custkey is null, 0, 1) as has_state, date_diff('day', s.at, o.o_orderdate)::int as days
    from orders o left join (select o_custkey, max(o_orderdate) as at from orders where o_orderpriority = '1-URGENT' group by o_custkey) s
    on s.o_custkey = o.o_custkey and o.o_orderdate >= s.at""",
)
def latest_if_before(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    states = orders.where("o_orderpriority = '1-URGENT'").select(
        "o_custkey", F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("tie")
    )
    out = joins.latest_if_before(orders, states, ["o_custkey"], "o_orderdate", "at", "tie", ["at"])
    return out.select(
        "o_orderkey",
        F.when(F.col("at").isNotNull(), 1).otherwise(0).alias("has_state"),
        elapsed("at", "o_orderdate", "days").alias("days"),
    )


@check("dedupe_group", "select o_custkey, o_orderstatus from orders group by o_custkey, o_orderstatus")
def dedupe_group(spark, folder):
    return dedupe.dedupe(table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"])


@check("distinct_pairs", "select distinct phone_number, external_id as cuid from fx_contacts")
def distinct_pairs(spark, folder):
    return dedupe.dedupe(pairs(spark, folder), PAIR)


@check("min_code", "select l_orderkey, cast(min(l_linenumber) as varchar) as first_code from lineitem group by l_orderkey")
def min_code(spark, folder):
    return table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_linenumber").cast("string").alias("first_code"))


LEGS_SQL = """legs as (select part_date, abonentnumber as phone_number, cast(hour(datetimestart) as int) as h_date, 'OKTELL' as call_source,
  case when callresult = 2 then 'BUSY' when callresult = 3 then 'NO_ANSWER' when callresult = 5 then 'ANSWER' when callresult = 6 then 'SKIPPED CALL'
    when callresult = 7 then 'PROMISSED' when callresult between 21 and 28 then 'INBOUND CALLS' end as code_call_result_type,
  min(datetimestart) as dtime_call_start, max(datetimestop) as dtime_call_end, max(dayname(datetimestart)) as weekday,
  max(if(alinenum = 'IVR' or blinenum is null, 0, lentime)) as talk_duration,
  max(if(isoutput = 1, 'OUTBOUND', 'INBOUND')) as interaction_type_code
  from fx_calls2 group by 1, 2, 3, 4, 5)"""


@check("collapse_legs", "select * from legs", LEGS_SQL)
def collapse_legs(spark, folder):
    return second_source_calls(view(spark, folder, "fx_calls2"))


def slot_sql() -> str:
    out = []
    for mid, extra in (("", ""), ("_successful", f" and {OK}")):
        out += [f"count(*) filter (where day_part = '{p}'{extra}) as cnt_{p.lower()}{mid}_calls" for p in ("Morning", "Afternoon", "Evening")]
        out += [
            f"count(*) filter (where weekday = '{w}'{extra}) as {w.lower()}{mid}_calls"
            for w in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
        ]
    return ", ".join(out)


@check("calls_by_slot", f"select phone_number, cuid, {slot_sql()} from fx_calls group by phone_number, cuid")
def calls_by_slot(spark, folder):
    return view(spark, folder, "fx_calls").groupBy(*PAIR).agg(*categories.slot_counts())


@check(
    "calls_by_direction",
    f"""select phone_number, cuid, count(*) filter (where interaction_type_code = 'OUTBOUND') as cnt_out_calls_6m,
    count(*) filter (where interaction_type_code = 'INBOUND') as cnt_in_calls_6m,
    count(*) filter (where interaction_type_code = 'OUTBOUND' and {OK}) as cnt_success_out_calls_6m,
    count(*) filter (where interaction_type_code = 'INBOUND' and {OK}) as cnt_success_in_calls_6m
    from fx_calls group by phone_number, cuid""",
)
def calls_by_direction(spark, folder):
    return view(spark, folder, "fx_calls").groupBy(*PAIR).agg(*categories.direction_counts())


@check(
    "messages_recent",
    f"""select right(phone, 10) as phone_number, count(*) as cnt_success_sms_6m from fx_messages
    where part_date > {d(25)} and input_date between {AS_OF} - interval 21 days and {AS_OF} group by 1""",
)
def messages_recent(spark, folder):
    return recent_messages(view(spark, folder, "fx_messages"), CTX, "21 DAYS", 25)


@check(
    "product_pivot",
    """select o_custkey, count(*) filter (where p_type = 'ECONOMY') as economy, count(*) filter (where p_type = 'SMALL') as small,
    count(*) filter (where p_type = 'PROMO') as promo from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey group by o_custkey""",
)
def product_pivot(spark, folder):
    t = lambda name: table(spark, folder, name)
    typed = joins.lookup(t("lineitem").select("l_partkey", "l_orderkey"), t("part"), {"l_partkey": "p_partkey"}, ["p_type"], how="inner")
    owned = joins.lookup(typed, t("orders"), {"l_orderkey": "o_orderkey"}, ["o_custkey"], how="inner")
    return categories.pivot_counts(owned, ["o_custkey"], "p_type", {"ECONOMY": "economy", "SMALL": "small", "PROMO": "promo"})


@check(
    "rule_counts",
    """select iin, count(*) filter (where ruleid = '21') as amt_fcb_searched_1y, count(*) filter (where ruleid = '2') as cnt_ext_overdue_7d_in_1y,
    count(*) filter (where ruleid = '8') as cnt_changes_in_ext_payment_1y, count(*) filter (where ruleid = '4') as cnt_new_ext_contracts_1y,
    max(if(ruleid = '16', 1, 0)) as flag_phone_is_changed_1y from fx_alerts group by iin""",
)
def rule_counts(spark, folder):
    return categories.rule_counts(view(spark, folder, "fx_alerts"), ["iin"], RULE_COUNTS, RULE_FLAGS)


@check(
    "reconcile",
    """select (select count(*) from fx_calls) as source_rows, (select count(*) from fx_contacts) as target_rows,
    (select count(distinct cuid) from fx_calls where cuid not in (select external_id from fx_contacts)) as missing_in_target,
    (select count(distinct external_id) from fx_contacts where external_id not in (select cuid from fx_calls)) as missing_in_source""",
)
def reconcile(spark, folder):
    return quality.reconcile(view(spark, folder, "fx_calls").select("cuid"), pairs(spark, folder).select("cuid"), ["cuid"])
