"""Missing values, ties, clamped months, short phones and the other edge cases."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.functions import calendar as C
from callmart.functions import decode as D
from callmart.functions import phone as P
from callmart.operators import joins
from callmart.operators.dedupe import first_per, latest_per
from callmart.operators.quality import reconcile
from callmart.operators.trailing import MIDNIGHT, Trailing, trailing
from callmart.plans import call_log as P1
from callmart.plans.call_features import call_features, trailing_features, with_previous_call
from callmart.plans.client_attributes import contact_addresses, known_contacts
from callmart.plans.daily_features import add_rates, daily_features
from callmart.plans.engagement import vehicles
from callmart.plans.schemas import CALL_LOG
from callmart.sources.tables import align_to, require_columns

CTX = RunContext(datetime(2024, 9, 1))
CALL = "interaction_id long, phone_number string, cuid long, dtime_call_start timestamp_ntz, talk_duration long, code_call_result_type string"


def call(i, phone, cuid, ts, talk=0, result=None):
    return (i, phone, cuid, ts, talk, result)


def calls(spark, *rows):
    df = spark.createDataFrame(list(rows), CALL)
    return align_to(
        df.withColumns(
            {
                "dtime_call_end": F.col("dtime_call_start"),
                "weekday": C.weekday_name("dtime_call_start"),
                "h_date": F.hour("dtime_call_start"),
                "day_part": C.day_part(F.hour("dtime_call_start")),
                "interaction_type_code": F.lit("OUTBOUND"),
                "part_date": C.day_key("dtime_call_start"),
            }
        ),
        CALL_LOG,
    )


def column(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_month_bounds_clamp(spark):
    at = [datetime(2024, 2, 29, 12), datetime(2024, 8, 30, 23), datetime(2024, 8, 31, 1)]
    df = spark.createDataFrame([("k", t) for t in at], "key string, ts timestamp_ntz")
    got = trailing(df, df, ["key"], "ts", "ts", {"n": "1"}, {"w": Trailing("6 MONTHS")}, {"n": ("n", "w")})
    assert [column(got, "ts", "n")[t] for t in at] == [1, 1, 3]


def test_same_day_calls(spark):
    at = [datetime(2024, 8, 10, 10), datetime(2024, 8, 20, 9), datetime(2024, 8, 20, 15)]
    got = trailing_features(calls(spark, *[call(i, "1", 1, t) for i, t in enumerate(at)]))
    assert [column(got, "dtime_call_start", "cnt_calls_6m")[t] for t in at] == [1, 2, 3]
    assert [column(got, "dtime_call_start", "cnt_calls_3m")[t] for t in at] == [0, 1, 1]
    assert [column(got, "dtime_call_start", "cnt_calls_1m")[t] for t in at] == [0, 1, 1]


def test_midnight_call_counts_in_its_own_window(spark):
    got = trailing_features(calls(spark, call(1, "1", 1, datetime(2024, 8, 20))))
    assert got.first()["cnt_calls_3m"] == 1


def test_equal_times_see_each_other_and_lag_by_id(spark):
    t = datetime(2024, 8, 20, 9)
    both = calls(spark, call(2, "1", 1, t, 5), call(1, "1", 1, t))
    assert trailing_features(both).first()["cnt_calls_6m"] == 2
    previous = with_previous_call(both)
    assert column(previous, "interaction_id", "last_dtime_call") == {1: None, 2: t}
    assert column(previous, "interaction_id", "last_call_result") == {1: None, 2: 0}


def test_missing_clients_match_each_other_only(spark):
    t = [datetime(2024, 8, 20, h) for h in (9, 10, 11)]
    rows = calls(spark, call(1, "1", None, t[0]), call(2, "1", None, t[1]), call(3, "1", 7, t[2]))
    got = call_features(rows, CTX)
    assert column(got, "interaction_id", "cnt_calls_6m") == {1: 1, 2: 2, 3: 1}
    assert column(got, "interaction_id", "last_dtime_call") == {1: None, 2: t[0], 3: None}


def test_missing_and_empty_phones_are_different_keys(spark):
    df = spark.createDataFrame([(None, 1), ("", 1), ("1", None), ("1|c2", None), ("1", 2)], "phone_number string, cuid long")
    assert df.select(P.pair_key()).distinct().count() == 5


def test_repeated_calls_do_not_multiply(spark):
    t = datetime(2024, 8, 20, 9)
    twice = calls(spark, call(1, "1", 1, t), call(1, "1", 1, t), call(2, "1", 1, datetime(2024, 8, 21, 9)))
    got = call_features(twice, CTX)
    assert got.count() == 3
    assert sorted(r["cnt_calls_6m"] for r in got.collect()) == [2, 2, 3]


def test_answered_without_talk_time_stays_out_of_averages(spark):
    day = [datetime(2024, 8, d, 9) for d in (1, 2, 3)]
    rows = calls(spark, call(1, "1", 1, day[0], None, "ANSWER"), call(2, "1", 1, day[1], 10), call(3, "1", 1, day[2], 0))
    got = {r["dtime_call_start"]: r for r in trailing_features(rows).collect()}
    assert got[day[2]]["avg_talk_6m"] == 10.0
    assert got[day[2]]["avg_talk_morning_6m"] == 5.0
    assert got[day[0]]["avg_talk_6m"] is None


def test_call_features_split_equals_plain(spark):
    rows = [call(i, "1", None if i % 2 else 1, datetime(2024, 8, 1 + i % 20, i % 24), i % 3) for i in range(120)]
    plain, split = (call_features(calls(spark, *rows), CTX, hot_rows=n) for n in (1_000_000, 60))
    columns = sorted(plain.columns)
    key = lambda df: sorted(map(str, df.select(columns).collect()))
    assert key(plain) == key(split)


@pytest.mark.parametrize(
    "hour, part",
    [(8, "Night"), (9, "Morning"), (12, "Morning"), (13, "Afternoon"), (17, "Afternoon"), (18, "Evening"), (21, "Evening"), (22, "Night"), (None, "Night")],
)
def test_day_parts(spark, hour, part):
    df = spark.createDataFrame([(hour,)], "h int")
    assert df.select(C.day_part("h")).first()[0] == part


def test_phones(spark):
    df = spark.createDataFrame([("12345",), (" 8700 0000001 ",), (None,), ("+7-701-1234567",)], "p string")
    assert [r[0] for r in df.select(P.phone_key("p")).collect()][0] == "12345"
    cleaned = df.select(P.clean_phone("p").alias("p"))
    assert [r[0] for r in P.valid_phone(cleaned, "p").collect()] == ["87000000001"]
    assert df.where(P.phone_suffix_match("p", F.lit("0071234567"))).count() == 1


def test_rates_without_calls_are_zero(spark):
    counted = calls(spark, call(1, "1", 1, datetime(2024, 8, 20, 9), 5)).groupBy("phone_number").agg(
        *__import__("callmart.operators.categories", fromlist=["x"]).slot_counts()
    )
    row = add_rates(counted).first()
    assert (row["rate_connect_mor"], row["rate_connect_sunday"], row["rate_connect_tuesday"]) == (1.0, 0.0, 1.0)


def test_status_from_dates(spark):
    rows = [(1, 2), (2, 1), (1, 1), (1, None), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "m int, d int")
    got = [r[0] for r in df.select(D.latest_status(F.col("d"), F.col("m"), F.lit(None), F.lit("SINGLE"))).collect()]
    assert got == ["DIVORCED", "MARRIED", "MARRIED", "MARRIED", "DIVORCED", "SINGLE"]


def test_device_flags(spark):
    df = spark.createDataFrame([("IPHONE",), ("samsung",), ("X",), (None,)], "m string")
    flags = D.one_hot("m", {"IPHONE": "i", "SAMSUNG": "s"}, other="o")
    assert [tuple(r) for r in df.select(*flags).collect()] == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 1)]
    zone = spark.createDataFrame([("a",), ("b",), (None,)], "z string").select(D.outside_set_flag("z", ["a"]))
    assert [r[0] for r in zone.collect()] == [0, 1, None]


def test_success_is_never_missing(spark):
    df = spark.createDataFrame([(None, None), (0, None), (3, None), (None, "ANSWER"), (0, "BUSY")], "talk_duration long, code_call_result_type string")
    assert [r[0] for r in df.select(D.is_success()).collect()] == [False, False, True, True, False]


def test_age_truncates_towards_zero(spark):
    df = spark.createDataFrame([(date(2023, 9, 3),), (date(2023, 9, 2),), (date(2025, 12, 1),), (None,)], "b date")
    assert [r[0] for r in df.select(C.age_years("b", CTX)).collect()] == [0, 1, -1, None]


def test_lookups_keep_missing_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, k string")
    dim = spark.createDataFrame([("a", 10), (None, 99)], "k string, v int")
    assert column(joins.lookup(left, dim, ["k"]), "id", "v") == {1: 10, 2: None, 3: None}
    assert column(joins.lookup(left, dim, ["k"], null_safe=True), "id", "v") == {1: 10, 2: 99, 3: None}
    assert {r["id"] for r in joins.missing_rows(left, dim, ["k"]).collect()} == {2, 3}
    assert {r["id"] for r in joins.restrict_to(left, dim, ["k"]).collect()} == {1}
    assert [r["id"] for r in joins.lookup(left, dim, ["k"], how="inner").collect()] == [1]


def test_restrict_and_missing_are_complements(spark):
    a = spark.range(100).selectExpr("if(id % 7 = 0, null, id) as k", "id")
    b = spark.range(0, 100, 3).selectExpr("id as k").unionByName(spark.range(0, 100, 3).selectExpr("id as k"))
    both = joins.restrict_to(a, b, ["k"]).unionByName(joins.missing_rows(a, b, ["k"]))
    assert sorted(r["id"] for r in both.collect()) == list(range(100))


def test_outer_merge_keeps_both_sides(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "k string, a int")
    b = spark.createDataFrame([("y", 5), ("z", 6), (None, 7)], "k string, b int")
    apart = {tuple(r) for r in joins.outer_merge(a, b, ["k"]).collect()}
    assert apart == {("x", 1, None), ("y", 2, 5), ("z", None, 6), (None, 3, None), (None, None, 7)}
    merged = {tuple(r) for r in joins.outer_merge(a, b, ["k"], null_safe=True).collect()}
    assert merged == {("x", 1, None), ("y", 2, 5), ("z", None, 6), (None, 3, 7)}


def test_one_row_per_key_with_ties(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("k", t, 1), ("k", t, 2), ("k", None, 3), (None, t, 4)], "key string, ts timestamp_ntz, tie int")
    assert column(latest_per(df, ["key"], "ts", "tie"), "key", "tie") == {"k": 2, None: 4}
    assert column(first_per(df, ["key"], "ts", "tie"), "key", "tie") == {"k": 1, None: 4}


def test_second_source_lists_a_call_under_each_client(spark):
    raw = spark.createDataFrame(
        [("7011234567", datetime(2024, 8, 30, 10), datetime(2024, 8, 30, 10), 1, "LINE", "B", 30, 5, 20240830)] * 2,
        "abonentnumber string, datetimestart timestamp_ntz, datetimestop timestamp_ntz, isoutput int, alinenum string, blinenum string, lentime long, callresult int, part_date int",
    )
    contacts = spark.createDataFrame([("7011234567", 1), ("7011234567", 1), ("7011234567", 2)], "phone_number string, cuid long")
    got = P1.second_source(raw, contacts, CTX).collect()
    assert sorted(r["cuid"] for r in got) == [1, 2]
    assert {(r["interaction_id"], r["callid"], r["talk_duration"], r["code_call_result_type"]) for r in got} == {(-1, "", 30, "ANSWER")}
    nobody = P1.second_source(raw, contacts.where("cuid > 5"), CTX).collect()
    assert [r["cuid"] for r in nobody] == [None]


def test_daily_rows_for_every_kind_of_pair(spark):
    log = calls(spark, call(1, "7010000001", 1, datetime(2024, 8, 20, 9), 9), call(2, "7010000002", 2, datetime(2024, 8, 20, 9)), call(3, "7010000003", None, datetime(2024, 8, 20, 9)))
    contacts = spark.createDataFrame([("7010000001", 1), ("7010000004", 4), ("7010000004", 4)], "phone_number string, cuid long")
    types = spark.createDataFrame(
        [("7010000001", 1, "FAX", datetime(2024, 1, 1), 1), ("7010000001", 1, "PHONE", datetime(2024, 2, 1), 2),
         ("7010000002", 2, "FAX", datetime(2024, 1, 1), 3), ("7010000009", 9, "FAX", datetime(2024, 1, 1), 4)],
        "phone_number string, cuid long, classification string, modified_ts timestamp_ntz, contact_id long",
    )
    texts = spark.createDataFrame([("+77010000004", datetime(2024, 8, 1), 20240801)], "phone string, input_date timestamp_ntz, part_date int")
    got = {r["cuid"]: r for r in daily_features(log, contacts, types, texts, CTX).collect()}
    assert set(got) == {1, 2, 4}
    assert [got[c]["pif_finded_status"] for c in (1, 2, 4)] == ["1", "0", "1"]
    assert [got[c]["pif_phone_type_code"] for c in (1, 2, 4)] == [7, -1, -1]
    assert [got[c]["past_days_last_succ_call"] for c in (1, 2, 4)] == [12, -1, -1]
    assert [got[c]["cnt_success_sms_6m"] for c in (1, 2, 4)] == [0, 0, 1]
    assert got[4]["last_interaction_type_code"] == -1


def test_vehicle_registered_after_the_call_does_not_count(spark):
    t = datetime(2024, 8, 20)
    moments = spark.createDataFrame([(1, t), (2, t), (None, t)], "id_cuid long, dtime_call_start timestamp_ntz")
    ms = lambda when: int((when - datetime(1970, 1, 1)).total_seconds() * 1000)
    cars = spark.createDataFrame(
        [(1, ms(datetime(2024, 8, 10)), "SEDAN", 1), (1, ms(datetime(2024, 8, 25)), "ПРИЦЕП", 2), (2, ms(datetime(2024, 8, 10)), "A", 3), (2, ms(datetime(2024, 8, 25)), "B", 4)],
        "cuid long, req_ts long, automodel string, tie int",
    )
    got = vehicles(moments, cars)
    assert column(got, "id_cuid", "flag_has_car") == {1: 1, 2: 0, None: 0}
    assert column(got, "id_cuid", "driving_days") == {1: 10, 2: None, None: None}


def test_addresses_of_known_contacts(spark):
    contacts = spark.createDataFrame([("p", 5, "FAX", datetime(2024, 1, 1), 1, 1)], "phone_number string, party_role_id long, classification string, modified_ts timestamp_ntz, active_yn int, contact_id long")
    roles = spark.createDataFrame([(5, 50, 9, datetime(2024, 1, 1), 1), (5, 51, 9, datetime(2024, 2, 1), 2)], "id long, party_id long, external_id long, modified_ts timestamp_ntz, role_tie long")
    known = known_contacts(contacts, roles)
    assert [tuple(r) for r in known.collect()] == [("p", 51, 9, 5, "FAX")]
    addresses = spark.createDataFrame([(51, 5, "R1", 1), (51, 5, "R2", 0), (50, 5, "R3", 1)], "party_id long, party_role_id long, region_code string, active_yn int")
    assert [r["region_code"] for r in contact_addresses(known, addresses).collect()] == ["R1"]


def test_first_source_lookups(spark):
    """One raw interaction with two attempts and a task with two comments, and one without any."""
    D1 = 20240831
    t = {
        "interaction_fact": spark.createDataFrame(
            [(1, "g1", 0, 3600, 10, "T", "S", D1), (2, None, 0, 0, 11, "T2", "5557011234567", D1), (3, "g3", 0, 0, 10, "T", "S", D1), (4, "g4", 0, 0, 10, "T", "S", 20240701)],
            "interaction_id long, media_server_ixn_guid string, start_ts long, end_ts long, interaction_type_key int, target_address string, source_address string, part_date int"),
        "interaction_resource_fact": spark.createDataFrame([(1, 4, 7, D1), (1, 5, 6, D1), (2, 0, 7, D1), (3, 1, 99, D1)], "interaction_id long, talk_duration long, resource_key int, part_date int"),
        "resource": spark.createDataFrame([(7,)], "resource_key int"),
        "interaction_type": spark.createDataFrame([(10, "Outbound", "OUTBOUND"), (11, "Inbound", "INBOUND")], "interaction_type_key int, interaction_type string, interaction_type_code string"),
        "contact_attempt_fact": spark.createDataFrame([("g1", "0007010000001", 1, 5, "8"), ("g1", None, 2, 6, "x")], "callid string, contact_info string, call_result_key int, campaign_key int, record_field_37 string"),
        "call_result_type": spark.createDataFrame([("1", "ANSWER"), ("2", "BUSY")], "id_source string, code_call_result_type string"),
        "campaign_type": spark.createDataFrame([("5", "C5")], "id_source string, name_call_campaign string"),
        "taskcalendar": spark.createDataFrame([(8, 3)], "t_taskcalendar_id long, t_tasktype_1 int"),
        "camp_task_type": spark.createDataFrame([("3", "TT")], "id_source string, code_camp_task_type string"),
        "result": spark.createDataFrame([(8, 40), (8, 30)], "t_taskcalendar_1 long, t_resulttype_1 int"),
        "camp_task_result_type": spark.createDataFrame([("30", "RR")], "id_source string, code_camp_task_result_type string"),
        "eventhistory": spark.createDataFrame([(8, "hi"), (8, "hi"), (8, "yo")], "t_taskcalendar_1 long, resultscomment string"),
        "session": spark.createDataFrame([("g1", 77, datetime(2024, 1, 2)), ("g0", 77, datetime(2024, 1, 1))], "id_ses string, cuid long, begin_session timestamp_ntz"),
        "session_action": spark.createDataFrame([("g1", 1, datetime(2024, 1, 1)), ("g1", 2, datetime(2024, 1, 2))], "id_ses string, id_action int, begin_action timestamp_ntz"),
        "action": spark.createDataFrame([(2, "said yes")], "id int, name string"),
    }
    got = P1.first_source(t, CTX)
    assert got.columns == CALL_LOG.names
    rows = sorted(got.collect(), key=str)
    assert [r["interaction_id"] for r in rows].count(1) == 3 and [r["interaction_id"] for r in rows].count(2) == 1 and len(rows) == 4
    ones = [r for r in rows if r["interaction_id"] == 1]
    assert {(r["phone_number"], r["code_call_result_type"], r["name_call_campaign"], r["text_call_disposition"]) for r in ones} == {
        ("7010000001", "ANSWER", "C5", "hi"), ("7010000001", "ANSWER", "C5", "yo"), ("T", "BUSY", None, None)}
    assert {(r["cuid"], r["response_name"], r["talk_duration"], r["h_date"], r["weekday"]) for r in ones} == {(77, "said yes", 9, 7, "Thursday")}
    assert {r["code_camp_task_result_type"] for r in ones} == {"RR", None}
    two = [r for r in rows if r["interaction_id"] == 2][0]
    assert (two["phone_number"], two["cuid"], two["code_call_result_type"]) == ("7011234567", None, None)


def test_reconcile_counts_rows_and_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (3,)], "k int")
    assert tuple(reconcile(a, b, ["k"]).first()) == (4, 2, 2, 1)
    assert tuple(reconcile(a.limit(0), b.limit(0), ["k"]).first()) == (0, 0, 0, 0)


def test_boundary_check_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="calls lacks columns: b"):
        require_columns(spark.range(1), ["id", "b"], "calls")


@pytest.mark.parametrize("days", [1, 5, 40])
def test_one_night_gives_the_rows_of_the_whole(spark, days):
    """Asking for the last days only changes which calls get a row, not what they get."""
    rows = [call(i, str(i % 3), i % 2 or None, datetime(2024, 1 + i % 8, 1 + i % 28, i % 24), i % 3) for i in range(300)]
    rows += [call(1000 + h, "1", 1, datetime(2024, 8, 31, h)) for h in range(5)]
    whole = call_features(calls(spark, *rows), CTX, days=400)
    part = call_features(calls(spark, *rows), CTX, days=days)
    columns = sorted(whole.columns)
    wanted = whole.where(F.col("partition_date") >= CTX.day_key(days))
    text = lambda df: sorted(map(str, df.select(columns).collect()))
    assert text(part) == text(wanted) and part.count() >= 5


def test_since_with_clamped_months(spark):
    """The first probe's month bound lies later than the second's."""
    at = [datetime(2024, 2, 29, 12), datetime(2024, 8, 30, 23), datetime(2024, 8, 31, 1)]
    df = spark.createDataFrame([("k", t) for t in at], "key string, ts timestamp_ntz")
    got = trailing(
        df, df, ["key"], "ts", "ts", {"n": "1"}, {"w": Trailing("6 MONTHS")}, {"n": ("n", "w")},
        since="timestamp_ntz '2024-08-30 23:00:00'",
    )
    assert column(got, "ts", "n") == {at[1]: 1, at[2]: 3}
    other = trailing(
        df.select("key", "ts"), df, ["key"], "ts", "ts", {"n": "1"}, {"w": Trailing("6 MONTHS"), "m": Trailing("1 MONTH", MIDNIGHT)},
        {"n": ("n", "w"), "m": ("n", "m")}, since="timestamp_ntz '2024-08-30 23:00:00'",
    )
    assert column(other, "ts", "n") == {at[1]: 1, at[2]: 3} and column(other, "ts", "m") == {at[1]: 0, at[2]: 1}
