"""Project the four raw marketing sources from the driver tables.

The driver tables (``events``, ``customer``, ``nation``) carry no marketing
data, so the sources are derived from them by fixed rules (see FIXTURES.md):
every run of five consecutive events is one pseudo-user whose events are in
time order. The derivation is plain DataFrame work: no row leaves the
executors and no group is bigger than five rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixture projection rules.
# slot-0 event type -> raw onboarding_name (error -> null)
ONBOARDING_NAME_BY_EVENT = {"click": " Standard", "purchase": "sleep", "signup": "FOCUS", "view": "fitness"}
# customer segment -> raw gender
GENDER_BY_SEGMENT = {
    "AUTOMOBILE": "male",
    "BUILDING": " Female",
    "FURNITURE": "NonBinary",
    "HOUSEHOLD": "prefer_not_to_say",
    "MACHINERY": "UnknownX",
}
# c_nationkey % 12 -> raw country (index 11 -> null)
COUNTRY_BY_NATION_MOD = ("us", "DE", "FR ", "GB", "ES", "IT", "AU", "BR", "CA", "IN", "XX", None)
# n_nationkey % 5 -> campaign type
CAMPAIGN_TYPE_BY_MOD = ("Social", "Influencer", "Search", "Display", "Video")
EVENTS_PER_USER = 5
# one campaign per nation; codes beyond them belong to no campaign
MAPPED_CAMPAIGNS = 25
CODES = 27
UNMAPPED_CODE = "C999"


def _mapping(c, mapping: dict) -> F.Column:
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out


def _campaign_code(uid, lower_mapped: bool = False) -> F.Column:
    r = (uid * 7) % CODES
    prefix = "c00" if lower_mapped else "C00"
    return F.when(r >= MAPPED_CAMPAIGNS, F.lit(UNMAPPED_CODE)).otherwise(F.concat(F.lit(prefix), (r + 1).cast("string")))


def _keyed(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "ts",
        F.col("user_id").alias("src_user"),
        "event_type",
        "value",
        F.expr(f"event_id div {EVENTS_PER_USER}").alias("uid"),
        (F.col("event_id") % EVENTS_PER_USER).alias("slot"),
    )


def user_activity(events: DataFrame, faults: bool = False) -> DataFrame:
    """Raw ``user_activity``, one row per event. Slot 0 is the onboarding of its
    user; slot 1 may be a trial, slots 2-4 may be sales; any other event is the
    onboarding of a visitor of its own, who has no profile. What slots 1-4 are
    depends on their type and on slot 0's, read through a window over the (at
    most five-row) user. ``faults`` adds the rule-breaking rows of FIXTURES.md."""
    ev = _keyed(events)
    per_user = Window.partitionBy("uid")

    def of_slot(n: int, c: str) -> F.Column:
        return F.max(F.when(F.col("slot") == n, F.col(c))).over(per_user)

    ev = ev.select("*", of_slot(0, "ts").alias("ts0"), of_slot(0, "event_type").alias("type0"), of_slot(2, "ts").alias("ts2"), of_slot(2, "value").alias("value2"))
    slot, uid, eid, kind_of = F.col("slot"), F.col("uid"), F.col("event_id"), F.col("event_type")
    trial = (slot == 1) & ((kind_of == "click") | (F.col("type0").isin("click", "purchase") & (kind_of != "error")))
    sale = (slot >= 2) & (
        (kind_of.isin("purchase", "signup") & F.col("type0").isin("click", "view")) | ((kind_of == "purchase") & (slot == 2))
    )
    known = F.col("ts0").isNotNull()
    ev = ev.withColumn("kind", F.when(slot == 0, "onboarding").when(known & trial, "trial").when(known & sale, "sale").otherwise("visitor"))
    kind = F.col("kind")
    visitor = kind == "visitor"
    first_day = F.when(visitor, F.col("ts")).otherwise(F.col("ts0")).cast("date")
    out = ev.select(
        "*",
        F.when(visitor, F.concat(F.lit("v"), eid.cast("string"))).otherwise(uid.cast("string")).alias("who"),
        F.when(kind == "onboarding", "Start_Onboarding ").when(kind == "trial", "start_trial").when(kind == "sale", "SALE")
        .otherwise("start_onboarding").alias("name"),
        F.when(kind == "sale", F.col("value")).when((kind == "trial") & (uid % 3 == 0), F.lit(0.0)).alias("revenue"),
        first_day.alias("dt"),
        first_day.alias("day"),
        _mapping(F.when(visitor, kind_of).otherwise(F.col("type0")), ONBOARDING_NAME_BY_EVENT).alias("onboarding"),
        F.when(visitor, _campaign_code(eid)).otherwise(_campaign_code(uid, lower_mapped=True)).alias("code"),
    )
    if faults:
        out = _with_faults(out)
    return out.select(
        F.col("who").alias("user_id"),
        F.col("name").alias("event_type"),
        F.col("ts").alias("event_date"),
        F.col("revenue").alias("revenue_amount"),
        F.col("day").alias("attribution_date"),
        F.col("onboarding").alias("onboarding_name"),
        "dt",
        F.col("code").alias("campaign_id"),
    )


# event_id % 500 of visitors with a sale, and its revenue.
VISITOR_SALES = {7: 1e7, 107: 1.5e9, 207: 0.0005, 307: 123456789.125, 407: 0.00002}


def _with_faults(rows: DataFrame) -> DataFrame:
    """Rows that break rules or sit at their edges (FIXTURES.md)."""
    uid, eid, slot, kind = F.col("uid"), F.col("event_id"), F.col("slot"), F.col("kind")
    visitor, trial, sale = kind == "visitor", kind == "trial", kind == "sale"
    later = trial | sale
    visitor_sale = visitor & (eid % 500).isin(*VISITOR_SALES)
    rows = rows.withColumns(
        {
            "name": F.when(visitor_sale, "SALE").when(visitor & (eid % 97 == 5), "Refund").otherwise(F.col("name")),
            "revenue": F.when(visitor_sale, _mapping(eid % 500, VISITOR_SALES))
            .when(sale & (eid % 40 == 13), F.lit(0.0))
            .when(sale & (eid % 60 == 22), F.lit(None).cast("double"))
            .when(sale & (uid % 14 == 3) & (slot == 3), F.col("value2"))
            .otherwise(F.col("revenue")),
            "ts": F.when(trial & (uid % 7 == 3), F.coalesce(F.expr("ts2 - INTERVAL 14 DAYS"), F.col("ts")))
            .when(sale & (uid % 7 == 3) & (slot == 3), F.coalesce(F.expr("ts2 + INTERVAL 30 HOURS"), F.col("ts")))
            .when(sale & (uid % 41 == 6), F.expr("ts - INTERVAL 50 DAYS"))
            .otherwise(F.col("ts")),
            "day": F.when(visitor & (eid % 53 == 19), F.date_add("day", 1)).when(later & (uid % 50 == 17), F.date_add("day", 2)).otherwise(F.col("day")),
            "onboarding": F.when(visitor & (eid % 89 == 11), "Yoga")
            .when(later & (uid % 29 == 3), "fitness")
            .when(later & (uid % 31 == 2), F.lit(None).cast("string"))
            .otherwise(F.col("onboarding")),
            "code": F.when(visitor & (eid % 71 == 9), "").when(later & (uid % 23 == 4), UNMAPPED_CODE).otherwise(F.col("code")),
        }
    )
    twice = (visitor & (eid % 101 == 7)) | (trial & (uid % 43 == 8))
    return rows.withColumn("copy", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))


def dim_user(events: DataFrame, customer: DataFrame, faults: bool = False) -> DataFrame:
    """Raw ``dim_user``: one base row per pseudo-user (slot-0 event joined to its
    customer) plus exact copies and conflicting variants, produced by one
    ``explode`` instead of a union of re-scans. ``faults`` adds users without
    any activity whose gender and country no domain lists."""
    ev = _keyed(events).where(F.col("slot") == 0)
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    base = ev.join(cust, ev.src_user == cust.c_custkey, "inner")
    uid = F.col("uid")
    country_idx = F.col("c_nationkey") % 12
    country = None
    for i, v in enumerate(COUNTRY_BY_NATION_MOD):
        val = F.lit(v) if v is not None else F.lit(None).cast("string")
        country = F.when(country_idx == i, val) if country is None else country.when(country_idx == i, val)
    base = base.select(
        uid.alias("uid"),
        _mapping(F.col("c_mktsegment"), GENDER_BY_SEGMENT).alias("gender"),
        country.alias("country"),
        _campaign_code(uid).alias("campaign_id"),
    )
    # variant 0 = base row; 1..6 = the extra rows of FIXTURES.md
    variants = F.array(
        F.lit(0),
        F.when(uid % 4 == 0, F.lit(1)),
        F.when(uid % 10 == 3, F.lit(2)),
        F.when(uid % 10 == 7, F.lit(3)),
        F.when(uid % 25 == 11, F.lit(4)),
        F.when(uid % 50 == 21, F.lit(5)),
        F.when(uid % 20 == 9, F.lit(6)),
        F.when(F.lit(faults) & (uid % 33 == 6), F.lit(7)),
    )
    rows = base.select("*", F.explode(F.filter(variants, lambda v: v.isNotNull())).alias("variant"))
    v = F.col("variant")
    return rows.select(
        F.when(v == 7, F.concat(F.lit("d"), F.col("uid").cast("string"))).otherwise(F.col("uid").cast("string")).alias("user_id"),
        F.when(v == 2, F.lit("?"))
        .when(v == 3, F.lit("male"))
        .when(v == 6, F.upper("gender"))
        .when(v == 7, F.lit("robot"))
        .otherwise(F.col("gender"))
        .alias("gender"),
        F.when(v == 4, F.lit("ZZ")).when(v == 6, F.lower("country")).when(v == 7, F.lit("QQ")).otherwise(F.col("country")).alias("country"),
        F.when(v == 5, F.lit("C001")).when(v == 6, F.lit("")).otherwise(F.col("campaign_id")).alias("campaign_id"),
    )


def marketing_spend(events: DataFrame, faults: bool = False) -> DataFrame:
    """Raw ``marketing_spend``: one row per day x campaign code, spend = max
    value (max, so the figure does not depend on summing order). With
    ``faults`` the last campaign spends nothing."""
    number = F.col("event_id") % MAPPED_CAMPAIGNS + 1
    return (
        events.select(
            F.col("ts").cast("date").alias("date"),
            F.concat(F.lit("C00"), number.cast("string")).alias("campaign_id"),
            F.when(F.lit(faults) & (number == MAPPED_CAMPAIGNS), F.lit(0.0)).otherwise(F.col("value")).alias("value"),
        )
        .groupBy("date", "campaign_id")
        .agg(F.max("value").alias("spend"))
    )


def marketing_campaigns(nation: DataFrame, faults: bool = False) -> DataFrame:
    """Raw ``marketing_campaigns``: one per nation. With ``faults`` the last has
    a type that no domain lists, and the one before it has no name."""
    key = F.col("n_nationkey")
    ctype = _mapping(key % 5, dict(enumerate(CAMPAIGN_TYPE_BY_MOD)))
    return nation.select(
        F.concat(F.lit("C00"), (key + 1).cast("string")).alias("campaign_id"),
        F.when(~(F.lit(faults) & (key == MAPPED_CAMPAIGNS - 2)), F.col("n_name")).alias("campaign_name"),
        F.when(F.lit(faults) & (key == MAPPED_CAMPAIGNS - 1), F.lit("Billboard")).otherwise(ctype).alias("campaign_type"),
    )


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_sources(spark: SparkSession, sf_dir: str, faults: bool = False) -> dict[str, DataFrame]:
    """The four raw sources derived from the driver tables in ``sf_dir``; with
    ``faults`` they also hold rows that break the data rules."""
    events = driver_table(spark, sf_dir, "events")
    customer = driver_table(spark, sf_dir, "customer")
    nation = driver_table(spark, sf_dir, "nation")
    return {
        "marketing_spend": marketing_spend(events, faults),
        "marketing_campaigns": marketing_campaigns(nation, faults),
        "dim_user": dim_user(events, customer, faults),
        "user_activity": user_activity(events, faults),
    }
