"""P3: one attribute set per (phone, client) from contact, person, registry and bureau records.

Attributes depend on the phone and client only, so they are worked out once per distinct pair and
not once per call; calls get them by one join at the end.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmart.context import RunContext
from callmart.fixed_values import EDUCATION_CODES, EDUCATION_RANGES, GENDER_CODES, MARITAL_CODES, REGION_NAMES
from callmart.functions.calendar import age_years
from callmart.functions.decode import decode, first_known, latest_status
from callmart.operators.dedupe import dedupe, first_per, latest_per
from callmart.operators.joins import lookup, restrict_to
from callmart.operators.reducers import bloom, met_by
from callmart.operators.scans import active
from callmart.session import stage

PAIR = ["phone_number", "cuid"]


def region_dimension(spark, names: Mapping[int, list[str]] = REGION_NAMES) -> DataFrame:
    """The region dictionary as a table of (region name, region code)."""
    rows = [(name, code) for code, spellings in names.items() for name in spellings]
    return spark.createDataFrame(rows, "region_name string, region_code int")


def lookup_code(df: DataFrame, column: str, dim: DataFrame, name: str, code: str) -> DataFrame:
    """Code of a spelling by dictionary; an unknown spelling has none."""
    return lookup(df, dim, {column: name}, [code])


def known_contacts(contacts: DataFrame, roles: DataFrame) -> DataFrame:
    """The newest active contact of each phone with its role's party and client.

    One row per phone: the phone's newest contact decides, as role ids are unique once deduped.
    """
    newest = latest_per(active(contacts, ["active_yn"], []), ["phone_number"], "modified_ts", "contact_id")
    newest = newest.select("phone_number", "party_role_id", "classification")
    role = latest_per(roles, ["id"], "modified_ts", "role_tie").select("id", "party_id", "external_id")
    return lookup(newest, role, {"party_role_id": "id"}).select(
        "phone_number", "party_id", "external_id", "party_role_id", "classification"
    )


def contact_addresses(contacts: DataFrame, addresses: DataFrame) -> DataFrame:
    """Active addresses of the parties behind known contacts."""
    live = active(addresses, ["active_yn"], [])
    keys = ["party_id", "party_role_id"]
    return lookup(contacts.select("phone_number", *keys), live, keys, ["region_code"], how="inner")


def marital_dates(marriages: DataFrame, divorces: DataFrame) -> DataFrame:
    """Newest marriage and divorce date per client, grouped in one shuffle."""
    both = marriages.select("cuid", F.col("actdate").alias("began"), F.lit(None).cast("timestamp_ntz").alias("ended"))
    both = both.unionByName(
        divorces.select("cuid", F.lit(None).cast("timestamp_ntz").alias("began"), F.col("actdate").alias("ended"))
    )
    return both.where(F.col("cuid").isNotNull()).groupBy("cuid").agg(
        F.max("began").alias("began"), F.max("ended").alias("ended")
    )


# What is read of a party's own record and of its relations.
PARTY_COLUMNS = [
    "identification_code", "gender_code", "birth_date_dt", "housingtype_code", "education_code", "maritalstatus_code", "cust_childnum",
]


def one_per_party(records: DataFrame, parties: DataFrame) -> DataFrame:
    """The columns needed of each listed party, one row for each.

    Records of one party that differ are settled by the greatest values, known before missing ones.
    """
    read = [c for c in PARTY_COLUMNS if c in records.columns]
    wanted = restrict_to(records.where("id is not null").select("id", *read), parties, ["id"])
    return wanted.groupBy("id").agg(F.max(F.struct(*read)).alias("_all")).select("id", *[f"_all.{c}" for c in read])


def client_attributes(calls: DataFrame, t: Mapping[str, DataFrame], ctx: RunContext) -> DataFrame:
    """Attributes per distinct (phone, client) of ``calls``; where sources differ, trust decides.

    Only contacts of the called phones and client records of the identified clients are ranked: Bloom filters drop the
    others in the scan. The pairs are staged for them, and again with their parties.
    """
    pairs = stage(dedupe(calls, PAIR), "pairs")
    phones = bloom(pairs.where("phone_number is not null"), "phone_number")
    contacts = known_contacts(met_by(t["contact"], "phone_number", phones, pairs, "phone_number"), t["role"])
    out = lookup(
        pairs, contacts, {"phone_number": "phone_number", "cuid": "external_id"},
        ["party_id", "party_role_id", "classification"],
    ).withColumnsRenamed(
        {"party_id": "pif_party_id", "party_role_id": "pif_party_role_id", "classification": "pif_phone_type_code"}
    )
    out = out.withColumn("pif_cuid", F.when(F.col("pif_party_role_id").isNotNull(), F.col("cuid")))

    parties = out.select(F.col("pif_party_id").alias("id")).distinct()
    out = lookup(out, one_per_party(t["person"], parties), {"pif_party_id": "id"})
    out = lookup(out, one_per_party(t["person_rel"], parties), {"pif_party_id": "id"})

    # One row per identified client: the oldest registry row, the newest state and bureau rows.
    out = stage(out, "identified")
    codes = bloom(out.where("identification_code is not null"), "identification_code")
    known = lambda name, key: met_by(t[name].where(F.col(key).isNotNull()), key, codes, out, "identification_code")
    registry = first_per(
        known("registry", "text_identification_number"), ["text_identification_number"], "dtime_modified", "tie"
    )
    state = latest_per(known("state_person", "iin"), ["iin"], "req_ts", "tie")
    bureau = latest_per(known("bureau_client", "iin"), ["iin"], "created_ts", "tie")

    prefixed = lambda df, key, p: df.select(F.col(key).alias(key), *[F.col(c).alias(p + c) for c in df.columns if c != key])
    out = lookup(out, prefixed(registry, "text_identification_number", "r_"), {"identification_code": "text_identification_number"})
    out = lookup(out, prefixed(state, "iin", "s_"), {"identification_code": "iin"})
    out = lookup(out, prefixed(bureau, "iin", "b_"), {"identification_code": "iin"})

    education = F.expr("try_cast(b_education_id as int)")
    out = out.withColumns(
        {
            "c_id_cuid": first_known("cuid", "pif_cuid", "s_cuid", "r_id_cuid", "b_cuid"),
            "code_gender": first_known(
                decode("s_gender_code", GENDER_CODES), "gender_code", F.upper("r_code_gender")
            ),
            "date_birth": first_known("s_birthdate", "birth_date_dt", "r_date_birth"),
            "c_region": first_known("s_regaddress_district", "b_region"),
            "education_type": first_known(
                "education_code", decode(education, EDUCATION_CODES, EDUCATION_RANGES), "r_code_education_type"
            ),
            "bureau_marital": decode("b_matrialstatus_id", MARITAL_CODES),
            "cnt_children": first_known("r_cnt_children", "cust_childnum"),
        }
    )
    out = lookup(out, marital_dates(t["marriage"], t["divorce"]), {"c_id_cuid": "cuid"})
    out = out.withColumn(
        "marital_status",
        latest_status(F.col("ended"), F.col("began"), F.col("maritalstatus_code"), F.col("bureau_marital")),
    ).withColumn("age", age_years("date_birth", ctx))
    out = lookup_code(out, "c_region", region_dimension(calls.sparkSession), "region_name", "region_code")
    return out.select(
        *PAIR,
        F.col("r_skp_client").alias("skp_client"),
        F.col("c_id_cuid").alias("id_cuid"),
        "pif_party_id",
        "pif_party_role_id",
        "pif_phone_type_code",
        F.col("identification_code").alias("pif_identification_code"),
        F.col("housingtype_code").alias("pif_housingtype_code"),
        "cnt_children",
        "code_gender",
        "date_birth",
        "age",
        "c_region",
        "region_code",
        "education_type",
        "marital_status",
    )
