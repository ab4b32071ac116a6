"""Registered cleaning / scalar-function queries on the driver tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sparkexp.functions import scalars as S
from sparkexp.operators import clean as cl
from sparkexp.plans.registry import register
from sparkexp.plans.tables import EXPERIMENT_SQL, experiment, load, use_utc


@register("trim_column_names", "SELECT * FROM customer", ["c_acctbal"])
def q_trim(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    padded = c.toDF(*[f"  {n} " for n in c.columns])
    return S.trim_column_names(padded)


_NUM_TEXT = "CASE WHEN event_type = 'error' THEN ' ' WHEN event_type = 'signup' THEN 'n/a' ELSE substr(props, 7, length(props) - 7) END"


@register(
    "to_number_or_null",
    f"SELECT event_id, TRY_CAST({_NUM_TEXT} AS DOUBLE) AS k_value FROM events",
    ["k_value"],
)
def q_to_number(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return e.select("event_id", S.to_number_or_null(F.expr(_NUM_TEXT)).alias("k_value"))


@register(
    "as_category",
    "SELECT c_custkey, coalesce(CAST(nullif(c_nationkey, 3) AS VARCHAR), 'nan') AS nation_category FROM customer",
)
def q_as_category(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", S.as_category(F.expr("nullif(c_nationkey, 3)")).alias("nation_category"))


_LABEL_TEXT = "CASE o_orderstatus WHEN 'F' THEN ' Yes ' WHEN 'O' THEN 'no' ELSE 'maybe' END"


@register(
    "encode_label",
    f"""SELECT o_orderkey, CAST(CASE lower(trim({_LABEL_TEXT})) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS label
        FROM orders WHERE lower(trim({_LABEL_TEXT})) IN ('yes', 'no')""",
)
def q_encode_label(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", S.encode_label(F.expr(_LABEL_TEXT)).alias("label"))
    return o.where(F.col("label").isNotNull())


@register("drop_duplicate_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem", ["l_tax"])
def q_dedup(spark, sf_dir):
    return cl.drop_duplicate_rows(load(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_tax"))


@register(
    "select_features",
    f"SELECT * EXCLUDE (unit_id, treatment, converted) FROM ({EXPERIMENT_SQL}) AS e",
    ["o_totalprice", "c_acctbal", "score"],
)
def q_select_features(spark, sf_dir):
    return cl.select_features(experiment(spark, sf_dir), ["unit_id", "treatment", "converted"])


@register(
    "align_schema",
    """SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_comment,
              o_orderstatus, CAST(o_custkey AS VARCHAR) AS SeniorCitizen FROM orders""",
    ["o_totalprice"],
)
def q_align(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "SeniorCitizen")
    expected = [("o_orderkey", "bigint"), ("o_totalprice", "double"), ("o_comment", "string"),
                ("o_orderstatus", "string"), ("SeniorCitizen", "string")]
    return cl.align_schema(o, expected)


_ARM_TEXT = "CASE o_orderkey % 5 WHEN 0 THEN ' Test ' WHEN 1 THEN 'control' WHEN 2 THEN 'B' WHEN 3 THEN 'TRUE' ELSE 'a' END"


@register(
    "encode_treatment",
    f"""SELECT o_orderkey,
        CAST(lower(trim({_ARM_TEXT})) IN ('1', 'b', 'treatment', 'test', 'variant', 'yes', 'true') AS INTEGER) AS arm_text,
        CAST(o_orderkey % 2 = 1 AS INTEGER) AS arm_int,
        CAST(o_orderstatus = 'F' AS INTEGER) AS arm_bool
        FROM orders""",
)
def q_encode_treatment(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr(_ARM_TEXT).alias("t_text"),
        (F.col("o_orderkey") % 2).alias("t_int"),
        (F.col("o_orderstatus") == "F").alias("t_bool"),
    )
    return o.select(
        "o_orderkey",
        S.encode_treatment(o, "t_text").alias("arm_text"),
        S.encode_treatment(o, "t_int").alias("arm_int"),
        S.encode_treatment(o, "t_bool").alias("arm_bool"),
    )


# events as raw experiment visits: date and HH:mm texts, broken for error events
_RAW_SQL = """
SELECT event_id AS user_id,
       CASE WHEN event_id % 4 = 0 THEN 'B' ELSE 'A' END AS "group",
       CAST(event_type = 'purchase' AS INTEGER) AS converted,
       CASE user_id % 6 WHEN 0 THEN '18–24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54' WHEN 4 THEN '55+' ELSE 'unknown' END AS age_group,
       CASE user_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS device_type,
       CAST(user_id % 2 AS INTEGER) AS previous_app_user,
       CASE WHEN event_type = 'error' THEN 'bad-date' ELSE strftime(ts, '%Y-%m-%d') END AS visit_date,
       CASE WHEN event_type = 'signup' THEN '??' ELSE strftime(ts, '%H:%M') END AS visit_time
FROM events
"""


def _raw(spark, sf_dir):
    use_utc(spark)
    e = load(spark, sf_dir, "events")
    age = (
        F.when(F.col("user_id") % 6 == 0, "18–24").when(F.col("user_id") % 6 == 1, "25-34")
        .when(F.col("user_id") % 6 == 2, "35-44").when(F.col("user_id") % 6 == 3, "45-54")
        .when(F.col("user_id") % 6 == 4, "55+").otherwise("unknown")
    )
    dev = F.when(F.col("user_id") % 3 == 0, "iOS").when(F.col("user_id") % 3 == 1, "Android").otherwise("Web")
    return e.select(
        F.col("event_id").alias("user_id"),
        F.when(F.col("event_id") % 4 == 0, "B").otherwise("A").alias("group"),
        (F.col("event_type") == "purchase").cast("int").alias("converted"),
        age.alias("age_group"),
        dev.alias("device_type"),
        (F.col("user_id") % 2).cast("int").alias("previous_app_user"),
        F.when(F.col("event_type") == "error", "bad-date").otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("visit_date"),
        F.when(F.col("event_type") == "signup", "??").otherwise(F.date_format("ts", "HH:mm")).alias("visit_time"),
    )


@register(
    "parse_visit_time",
    f"""SELECT user_id, coalesce(dayname(try_strptime(visit_date, '%Y-%m-%d')), 'Unknown') AS visit_weekday,
               CAST(coalesce(hour(try_strptime(visit_time, '%H:%M')), 12) AS INTEGER) AS visit_hour
        FROM ({_RAW_SQL}) AS r""",
)
def q_parse_visit(spark, sf_dir):
    r = _raw(spark, sf_dir)
    wd, hr = S.parse_visit_time("visit_date", "visit_time")
    return r.select("user_id", wd.alias("visit_weekday"), hr.alias("visit_hour"))


_TWO_PI = repr(2 * math.pi / 24.0)
_ENGINEERED_SQL = f"""
WITH p AS (
  SELECT user_id,
         CAST(lower(trim("group")) IN ('1', 'b', 'treatment', 'test', 'variant', 'yes', 'true', 'blue') AS INTEGER) AS treatment,
         converted, replace(age_group, '–', '-') AS age_group, device_type, previous_app_user,
         coalesce(dayname(try_strptime(visit_date, '%Y-%m-%d')), 'Unknown') AS visit_weekday,
         CAST(coalesce(hour(try_strptime(visit_time, '%H:%M')), 12) AS INTEGER) AS visit_hour,
         CASE WHEN previous_app_user = 1 THEN 'returning' ELSE 'new' END AS user_type
  FROM ({_RAW_SQL}) AS r)
SELECT *,
       CAST(CASE age_group WHEN '18-24' THEN 1 WHEN '25-34' THEN 2 WHEN '35-44' THEN 3 WHEN '45-54' THEN 4 WHEN '55+' THEN 5 ELSE 0 END AS INTEGER) AS age_group_code,
       CAST(visit_weekday IN ('Saturday', 'Sunday') AS INTEGER) AS is_weekend,
       CAST(device_type = 'iOS' AS INTEGER) AS is_ios,
       sin(CAST(visit_hour AS DOUBLE) * {_TWO_PI}) AS visit_hour_sin,
       cos(CAST(visit_hour AS DOUBLE) * {_TWO_PI}) AS visit_hour_cos,
       CAST(previous_app_user * CAST(device_type = 'iOS' AS INTEGER) AS INTEGER) AS returning_ios
FROM p
"""


@register("derive_flags", _ENGINEERED_SQL, ["visit_hour_sin", "visit_hour_cos"])
def q_derive_flags(spark, sf_dir):
    """Loader + feature engineering: treatment tokens, weekday/hour parsing,
    user type, age band code (en dash folded), weekend, iOS, cyclical hour,
    returning x iOS."""
    return cl.load_experiment_frame(_raw(spark, sf_dir))


@register(
    "ordinal_map",
    f"SELECT user_id, age_group, age_group_code FROM ({_ENGINEERED_SQL}) AS e",
)
def q_ordinal(spark, sf_dir):
    r = _raw(spark, sf_dir)
    return r.select(
        "user_id",
        F.regexp_replace("age_group", "–", "-").alias("age_group"),
        S.ordinal_map("age_group").alias("age_group_code"),
    )


@register(
    "cyclical_encode",
    f"SELECT user_id, visit_hour_sin, visit_hour_cos FROM ({_ENGINEERED_SQL}) AS e",
    ["visit_hour_sin", "visit_hour_cos"],
)
def q_cyclical(spark, sf_dir):
    r = _raw(spark, sf_dir)
    _, hr = S.parse_visit_time("visit_date", "visit_time")
    s, c = S.cyclical_encode(hr)
    return r.select("user_id", s.alias("visit_hour_sin"), c.alias("visit_hour_cos"))


@register(
    "score_transforms",
    """SELECT o_orderkey,
         greatest(least(o_totalprice / 399989.0, 1 - 1e-6), 1e-6) AS clipped,
         1.0 / (1.0 + exp(-greatest(least((o_totalprice - 250000.0) / 10000.0, 20.0), -20.0))) AS sigmoid_score,
         greatest(least(CAST(o_orderkey % 3 AS DOUBLE) - 0.5, 1.0), 0.0) AS prediction_score,
         CAST(o_totalprice / 399989.0 >= 0.3 AS INTEGER) AS label_at_030
       FROM orders""",
    ["clipped", "sigmoid_score", "prediction_score"],
)
def q_score_transforms(spark, sf_dir):
    """clip, sigmoid_score (decision value clipped to +-20), prediction
    fallback clipped to [0, 1], and the inclusive threshold label."""
    o = load(spark, sf_dir, "orders")
    p = F.col("o_totalprice") / 399989.0
    return o.select(
        "o_orderkey",
        S.clip(p).alias("clipped"),
        S.sigmoid((F.col("o_totalprice") - 250000.0) / 10000.0, clip_at=20).alias("sigmoid_score"),
        S.prediction_to_score((F.col("o_orderkey") % 3).cast("double") - 0.5).alias("prediction_score"),
        S.threshold_label(p, 0.3).alias("label_at_030"),
    )


# orders x customer as a churn-style raw table
_CHURN_RAW = """
SELECT c_name AS customerID, c_mktsegment AS Contract, CAST(c_nationkey % 2 AS INTEGER) AS SeniorCitizen,
       CASE WHEN o_orderkey % 50 = 0 THEN ' ' ELSE CAST(o_totalprice AS VARCHAR) END AS TotalCharges,
       CASE o_orderstatus WHEN 'F' THEN ' yes ' WHEN 'O' THEN 'No' ELSE 'maybe' END AS Churn
FROM orders JOIN customer ON o_custkey = c_custkey
"""


@register(
    "clean_churn_frame",
    f"""SELECT DISTINCT customerID, Contract, CAST(SeniorCitizen AS VARCHAR) AS SeniorCitizen,
               TRY_CAST(TotalCharges AS DOUBLE) AS TotalCharges,
               CAST(CASE lower(trim(Churn)) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS INTEGER) AS Churn
        FROM ({_CHURN_RAW}) AS r WHERE lower(trim(Churn)) IN ('yes', 'no')""",
    ["TotalCharges"],
)
def q_clean_churn(spark, sf_dir):
    o, c = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    raw = j.select(
        F.col("c_name").alias(" customerID "),
        F.col("c_mktsegment").alias("Contract"),
        (F.col("c_nationkey") % 2).cast("int").alias("SeniorCitizen "),
        F.when(F.col("o_orderkey") % 50 == 0, " ").otherwise(F.col("o_totalprice").cast("string")).alias("TotalCharges"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN ' yes ' WHEN 'O' THEN 'No' ELSE 'maybe' END").alias("Churn"),
    )
    return cl.clean_churn_frame(raw)


# ---------------------------------------------------------------- the three score transforms, one key each

@register(
    "clip",
    """SELECT l_orderkey, l_linenumber, greatest(least(l_discount * 10.0 - 0.2, 1 - 1e-6), 1e-6) AS clipped
       FROM lineitem""",
    ["clipped"],
)
def q_clip(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", S.clip(F.col("l_discount") * 10.0 - 0.2).alias("clipped"))


@register(
    "sigmoid_score",
    """SELECT l_orderkey, l_linenumber,
         1.0 / (1.0 + exp(-greatest(least((l_extendedprice - 50000.0) / 2000.0, 20.0), -20.0))) AS sigmoid_score
       FROM lineitem""",
    ["sigmoid_score"],
)
def q_sigmoid(spark, sf_dir):
    """Decision value -> probability, decision value clipped to +-20 first."""
    li = load(spark, sf_dir, "lineitem")
    z = (F.col("l_extendedprice") - 50000.0) / 2000.0
    return li.select("l_orderkey", "l_linenumber", S.sigmoid(z, clip_at=20).alias("sigmoid_score"))


@register(
    "threshold_label",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity / 50.0 >= 0.5 AS INTEGER) AS label FROM lineitem",
)
def q_threshold_label(spark, sf_dir):
    """Inclusive cut: quantity 25 gives exactly 0.5 and is labelled 1."""
    li = load(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", S.threshold_label(F.col("l_quantity") / 50.0, 0.5).alias("label"))
