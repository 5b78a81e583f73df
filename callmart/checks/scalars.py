"""Scans, scalar functions, conditionals and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from callmart.checks.fixtures import CTX, table, view
from callmart.checks.registry import AS_OF, OK, check, d
from callmart.fixed_values import (
    CALL_RESULT_LABELS,
    CALL_RESULT_RANGES,
    DIRECTIONS,
    EDUCATION_CODES,
    EDUCATION_RANGES,
    MARITAL_CODES,
    PHONE_TYPES,
    PUSH_TYPES,
)
from callmart.functions import calendar as C
from callmart.functions import decode as D
from callmart.functions import phone as P
from callmart.operators import quality, scans
from callmart.plans.client_attributes import lookup_code
from callmart.plans.daily_features import add_rates, recent_call_counts
from callmart.sources.tables import register

BASE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@check("load_counts", " union all ".join(f"select '{t}' as table_name, count(*) as row_count from {t}" for t in BASE))
def load_counts(spark, folder):
    register(spark, folder, BASE, ".parquet")
    return quality.row_counts({t: spark.table(t) for t in BASE})


@check("scan_day", f"select interaction_id, phone_number from fx_calls where part_date = {d(1)}")
def scan_day(spark, folder):
    return scans.scan_day(view(spark, folder, "fx_calls"), CTX).select("interaction_id", "phone_number")


@check(
    "scan_range",
    f"select part_date, count(*) as rows from fx_calls where part_date between {d(14)} and {d(1)} group by part_date",
)
def scan_range(spark, folder):
    days = scans.scan_range(view(spark, folder, "fx_calls"), CTX, 14, 1)
    return days.groupBy("part_date").agg(F.count(F.lit(1)).alias("rows"))


@check(
    "recent_window",
    f"""select right(phone, 10) as phone_number, count(*) as rows from fx_messages
    where part_date > {d(20)} and input_date between {AS_OF} - interval 14 days and {AS_OF} group by 1""",
)
def recent_window(spark, folder):
    rows = scans.recent(view(spark, folder, "fx_messages"), CTX, "input_date", "14 DAYS", 20)
    return rows.groupBy(P.phone_key("phone").alias("phone_number")).agg(F.count(F.lit(1)).alias("rows"))


@check(
    "active_contacts",
    "select contact_id, phone_number from fx_contacts where active_yn = 1 and official_yn = 1 and classification is not null",
)
def active_contacts(spark, folder):
    live = scans.active(view(spark, folder, "fx_contacts"), ["active_yn", "official_yn"], ["classification"])
    return live.select("contact_id", "phone_number")


@check("in_list", "select cuid, count(*) as rows from fx_messages where type in ('PUSH_VIEWED', 'CALLBACK_PUSH') group by cuid")
def in_list(spark, folder):
    rows = scans.in_list(view(spark, folder, "fx_messages"), "type", PUSH_TYPES)
    return rows.groupBy("cuid").agg(F.count(F.lit(1)).alias("rows"))


@check("not_like", "select p_partkey, p_name from part where p_name not like '%ring%' and p_name not like '%widget%'")
def not_like(spark, folder):
    return scans.exclude_like(table(spark, folder, "part"), "p_name", ["%ring%", "%widget%"]).select("p_partkey", "p_name")


@check("epoch_local", "select event_id, date_trunc('second', ts) + interval 6 hours as local_ts from events")
def epoch_local(spark, folder):
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select("event_id", C.epoch_to_local(seconds).alias("local_ts"))


@check("epoch_ms", "select event_id, date_trunc('second', ts) as event_ts from events")
def epoch_ms(spark, folder):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select("event_id", C.epoch_ms_to_ts(millis).alias("event_ts"))


@check(
    "calendar_parts",
    """select interaction_id, dayname(dtime_call_start) as weekday, cast(hour(dtime_call_start) as int) as h_date,
    case when hour(dtime_call_start) in (9, 10, 11, 12) then 'Morning'
         when hour(dtime_call_start) in (13, 14, 15, 16, 17) then 'Afternoon'
         when hour(dtime_call_start) in (18, 19, 20, 21) then 'Evening' else 'Night' end as day_part,
    cast(isodow(dtime_call_start) as int) as iso_weekday from fx_calls""",
)
def calendar_parts(spark, folder):
    start = "dtime_call_start"
    return view(spark, folder, "fx_calls").select(
        "interaction_id",
        C.weekday_name(start).alias("weekday"),
        F.hour(start).alias("h_date"),
        C.day_part(F.hour(start)).alias("day_part"),
        C.iso_weekday(start).alias("iso_weekday"),
    )


@check(
    "day_key",
    "select interaction_id, cast(strftime(dtime_call_start, '%Y%m%d') as int) as day_key, "
    "date_trunc('day', dtime_call_start)::timestamp as day_start from fx_calls",
)
def day_key(spark, folder):
    start = "dtime_call_start"
    return view(spark, folder, "fx_calls").select(
        "interaction_id", C.day_key(start).alias("day_key"), C.start_of_day(start).alias("day_start")
    )


@check(
    "age_years",
    f"select o_orderkey, cast(date_diff('day', o_orderdate, {AS_OF}) // 365 as int) as age from orders",
)
def age_years(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", C.age_years("o_orderdate", CTX).alias("age"))


@check(
    "recency",
    f"""select phone_number, cuid,
    coalesce(date_diff('day', max(dtime_call_start), {AS_OF}), -1)::int as past_days_last_call,
    coalesce(date_diff('day', max(case when {OK} then dtime_call_start end), {AS_OF}), -1)::int as past_days_last_succ_call
    from fx_calls group by phone_number, cuid""",
)
def recency(spark, folder):
    last = view(spark, folder, "fx_calls").groupBy("phone_number", "cuid").agg(
        F.max("dtime_call_start").alias("last"),
        F.max(F.when(D.is_success(), F.col("dtime_call_start"))).alias("last_ok"),
    )
    return last.select(
        "phone_number",
        "cuid",
        C.days_since("last", CTX).alias("past_days_last_call"),
        C.days_since("last_ok", CTX).alias("past_days_last_succ_call"),
    )


@check("phone_key", "select phone, right(phone, 10) as phone_number, count(*) as rows from fx_messages group by phone")
def phone_key(spark, folder):
    return (
        view(spark, folder, "fx_messages")
        .groupBy("phone", P.phone_key("phone").alias("phone_number"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


_SPACED = "case when event_type = 'error' then ' 87 ' when event_type = 'view' then ' 870 ' else ' ' end || cast(user_id as {}) || ' 12345 ' || cast(event_id as {})"


@check(
    "phone_clean",
    f"""select event_id, phone from (select event_id, replace(trim({_SPACED.format('varchar', 'varchar')}), ' ', '') as phone from events)
    where length(phone) in (10, 11)""",
)
def phone_clean(spark, folder):
    spaced = F.expr(_SPACED.format("string", "string"))
    rows = table(spark, folder, "events").select("event_id", P.clean_phone(spaced).alias("phone"))
    return P.valid_phone(rows, "phone")


@check(
    "phone_suffix",
    "select id, right(replace(value_new, '-', ''), 7) = right(lpad(cast(iin_key as varchar), 9, '0'), 7) as is_same from fx_alerts",
)
def phone_suffix(spark, folder):
    own = F.lpad(F.col("iin_key").cast("string"), 9, "0")
    return view(spark, folder, "fx_alerts").select("id", P.phone_suffix_match("value_new", own).alias("is_same"))


@check(
    "counterparty",
    """select interaction_id, right(case when interaction_type_code = 'OUTBOUND'
    then coalesce(case when code_call_result_type = 'ANSWER' then raw_phone end, raw_phone || '1') else raw_phone || '2' end, 10)
    as phone_number from fx_calls""",
)
def counterparty(spark, folder):
    contact = F.when(F.col("code_call_result_type") == "ANSWER", F.col("raw_phone"))
    other = P.counterparty(
        F.col("interaction_type_code") == "OUTBOUND",
        contact,
        F.concat("raw_phone", F.lit("1")),
        F.concat("raw_phone", F.lit("2")),
    )
    return view(spark, folder, "fx_calls").select("interaction_id", P.phone_key(other).alias("phone_number"))


@check(
    "decode_result",
    """select abonentnumber as phone_number, datetimestart,
    case callresult when 2 then 'BUSY' when 3 then 'NO_ANSWER' when 5 then 'ANSWER' when 6 then 'SKIPPED CALL' when 7 then 'PROMISSED'
      else case when callresult >= 21 and callresult <= 28 then 'INBOUND CALLS' end end as result,
    if(isoutput = 1, 'OUTBOUND', 'INBOUND') as direction from fx_calls2""",
)
def decode_result(spark, folder):
    return view(spark, folder, "fx_calls2").select(
        F.col("abonentnumber").alias("phone_number"),
        "datetimestart",
        D.decode("callresult", CALL_RESULT_LABELS, CALL_RESULT_RANGES).alias("result"),
        D.decode("isoutput", {1: "OUTBOUND"}, default="INBOUND").alias("direction"),
    )


@check(
    "zero_when",
    """select abonentnumber as phone_number, datetimestart,
    if(alinenum = 'IVR' or blinenum is null, 0, lentime) as talk_duration from fx_calls2""",
)
def zero_when(spark, folder):
    unheard = (F.col("alinenum") == "IVR") | F.col("blinenum").isNull()
    return view(spark, folder, "fx_calls2").select(
        F.col("abonentnumber").alias("phone_number"), "datetimestart", D.zero_when("lentime", unheard).alias("talk_duration")
    )


@check("success_flag", f"select interaction_id, {OK}::int as call_result from fx_calls")
def success_flag(spark, folder):
    return view(spark, folder, "fx_calls").select("interaction_id", D.is_success().cast("int").alias("call_result"))


@check(
    "first_known",
    """select cuid, coalesce(case gender_code when '1' then 'M' when '0' then 'F' end,
    (select gender_code from cl_person p where p.id = s.cuid), 'U') as gender, tie from cl_state s""",
)
def first_known(spark, folder):
    from callmart.operators.joins import lookup

    state = view(spark, folder, "cl_state").withColumnRenamed("gender_code", "state_gender")
    both = lookup(state, view(spark, folder, "cl_person"), {"cuid": "id"}, ["gender_code"])
    gender = D.first_known(D.decode("state_gender", {"1": "M", "0": "F"}), "gender_code", F.lit("U"))
    return both.select("cuid", gender.alias("gender"), "tie")


@check(
    "decode_bands",
    """select tie, case try_cast(education_id as int) when 3 then 'BACHELORS' when 1 then 'SECONDARY_SCHOOL' when 2 then 'SECONDARY_SCHOOL' end as education,
    case matrialstatus_id when '1' then 'SINGLE' when '2' then 'MARRIED' when '3' then 'DIVORCED' when '5' then 'LIVING_WITH_PARTNER' end as marital
    from cl_bureau""",
)
def decode_bands(spark, folder):
    education = F.expr("try_cast(education_id as int)")
    return view(spark, folder, "cl_bureau").select(
        "tie",
        D.decode(education, EDUCATION_CODES, EDUCATION_RANGES).alias("education"),
        D.decode("matrialstatus_id", MARITAL_CODES).alias("marital"),
    )


@check(
    "latest_status",
    """select cuid, case when ended > began then 'DIVORCED' when began is not null then 'MARRIED'
      when ended is not null then 'DIVORCED' else 'SINGLE' end as marital_status
    from (select c_custkey as cuid, (select max(actdate) from cl_marriage m where m.cuid = c_custkey) as began,
      (select max(actdate) from cl_divorce x where x.cuid = c_custkey) as ended from customer)""",
)
def latest_status(spark, folder):
    from callmart.operators.joins import lookup
    from callmart.plans.client_attributes import marital_dates

    dates = marital_dates(view(spark, folder, "cl_marriage"), view(spark, folder, "cl_divorce"))
    clients = table(spark, folder, "customer").select(F.col("c_custkey").alias("cuid"))
    status = D.latest_status(F.col("ended"), F.col("began"), F.lit("SINGLE"))
    return lookup(clients, dates, ["cuid"]).select("cuid", status.alias("marital_status"))


@check(
    "region_code",
    """select c_custkey, case n_name when 'NATION_1' then 1 when 'NATION_2' then 2 when 'NATION_3' then 2 when 'NATION_7' then 3 end as region_code
    from customer left join nation on c_nationkey = n_nationkey""",
)
def region_code(spark, folder):
    from callmart.operators.joins import lookup
    from callmart.plans.client_attributes import region_dimension

    spellings = {1: ["NATION_1"], 2: ["NATION_2", "NATION_3"], 3: ["NATION_7"]}
    named = lookup(table(spark, folder, "customer"), table(spark, folder, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name"])
    coded = lookup_code(named, "n_name", region_dimension(spark, spellings), "region_name", "region_code")
    return coded.select("c_custkey", "region_code")


@check(
    "device_flags",
    """select tie, if(upper(device_manufacturer) = 'IPHONE', 1, 0) as flag_iphone, if(upper(device_manufacturer) = 'SAMSUNG', 1, 0) as flag_samsung,
    if(upper(device_manufacturer) in ('IPHONE', 'SAMSUNG'), 0, 1) as flag_other,
    case when timezoneid is null then null when timezoneid in ('Asia/Almaty', 'Etc/GMT+6') then 0 else 1 end as flag_zone from en_device""",
)
def device_flags(spark, folder):
    from callmart.fixed_values import HOME_TIME_ZONES

    return view(spark, folder, "en_device").select(
        "tie",
        *D.one_hot("device_manufacturer", {"IPHONE": "flag_iphone", "SAMSUNG": "flag_samsung"}, other="flag_other"),
        D.outside_set_flag("timezoneid", HOME_TIME_ZONES).alias("flag_zone"),
    )


@check(
    "ordinal_codes",
    """select 'contact' as kind, classification as label,
      case classification when 'CONTACT_PHONE' then 2 when 'HOME_PHONE' then 5 when 'PRIMARY_MOBILE' then 9 when 'SECONDARY_MOBILE' then 11 else -1 end as code,
      count(*) as rows from fx_contacts group by all
    union all
    select 'call', interaction_type_code, case interaction_type_code when 'OUTBOUND' then 1 when 'INBOUND' then 2 when 'INTERNAL' then 3 else -1 end,
      count(*) from fx_calls group by all""",
)
def ordinal_codes(spark, folder):
    def coded(name, column, kind, values):
        label = F.col(column).alias("label")
        keys = [F.lit(kind).alias("kind"), label, D.ordinal(column, values).alias("code")]
        return view(spark, folder, name).select(*keys).groupBy("kind", "label", "code").agg(F.count(F.lit(1)).alias("rows"))

    return coded("fx_contacts", "classification", "contact", PHONE_TYPES).unionByName(
        coded("fx_calls", "interaction_type_code", "call", DIRECTIONS)
    )


def rate_sql(condition: str) -> str:
    return (
        f"coalesce(count(*) filter (where {condition} and {OK}) * 1.0::double"
        f" / nullif(count(*) filter (where {condition}), 0), 0.0)"
    )


RATES_SQL = ", ".join(
    [
        f"{rate_sql(chr(40) + 'day_part = ' + repr(p) + chr(41))} as {name}"
        for p, name in (("Morning", "rate_connect_mor"), ("Afternoon", "rate_connect_after"), ("Evening", "rate_connect_even"))
    ]
    + [
        f"{rate_sql(chr(40) + 'weekday = ' + repr(w) + chr(41))} as rate_connect_{w.lower()}"
        for w in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
    ]
)


@check("connect_rates", f"select phone_number, cuid, {RATES_SQL} from fx_calls group by phone_number, cuid")
def connect_rates(spark, folder):
    rated = add_rates(recent_call_counts(view(spark, folder, "fx_calls"), CTX))
    return rated.select("phone_number", "cuid", *[c for c in rated.columns if c.startswith("rate_")])


@check(
    "fill_defaults",
    """select coalesce(k.phone_number, c.phone_number) as phone_number, coalesce(k.cuid, -1) as cuid, coalesce(c.calls, 0) as calls
    from (select distinct phone_number, external_id as cuid from fx_contacts) k
    full join (select phone_number, count(*) as calls from fx_calls group by phone_number) c on k.phone_number = c.phone_number""",
)
def fill_defaults(spark, folder):
    from callmart.operators.joins import outer_merge

    known = view(spark, folder, "fx_contacts").select("phone_number", F.col("external_id").alias("cuid")).distinct()
    counted = view(spark, folder, "fx_calls").groupBy("phone_number").agg(F.count(F.lit(1)).alias("calls"))
    return outer_merge(known, counted, ["phone_number"]).na.fill(0, ["calls"]).na.fill(-1, ["cuid"])


@check("talk_mean", "select count(*) as rows, avg(talk_duration)::double as avg_talk from fx_calls")
def talk_mean(spark, folder):
    talk = F.col("talk_duration").cast("double")
    return view(spark, folder, "fx_calls").agg(F.count(F.lit(1)).alias("rows"), F.avg(talk).alias("avg_talk"))
