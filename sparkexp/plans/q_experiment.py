"""Registered experiment-statistics queries (orders x customer experiment view)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkexp.functions.normal import two_sided_p_sql
from sparkexp.operators import experiment as ex
from sparkexp.plans.registry import register
from sparkexp.plans.tables import EXPERIMENT_SQL, experiment

AB_DOUBLES = ["control_rate", "treatment_rate", "absolute_lift", "relative_lift", "ci_low", "ci_high", "p_value"]


def _ab_sql(group_cols: list[str], source: str = "e", extra_where: str = "") -> str:
    g = ", ".join(group_cols)
    gsel = f"{g}, " if g else ""
    cols = f"{gsel}n_control, n_treatment, " + ", ".join(AB_DOUBLES)
    return f"SELECT {cols} FROM ({ex.stages_sql(_counts_sql(group_cols, source, extra_where), ex.ab_stages())}) AS s"


def _counts_sql(group_cols: list[str], source: str = "e", extra_where: str = "") -> str:
    g = ", ".join(group_cols)
    gsel = f"{g}, " if g else ""
    gby = f"GROUP BY {g}" if g else ""
    return f"""
WITH e AS ({EXPERIMENT_SQL}),
c AS (
  SELECT {gsel}
         count_if(treatment = 0) AS n_control,
         count_if(treatment = 1) AS n_treatment,
         CAST(sum(CASE WHEN treatment = 0 THEN converted ELSE 0 END) AS BIGINT) AS control_success,
         CAST(sum(CASE WHEN treatment = 1 THEN converted ELSE 0 END) AS BIGINT) AS treatment_success
  FROM {source} WHERE treatment IS NOT NULL AND converted IS NOT NULL {extra_where}
  {gby})
SELECT * FROM c
"""


@register("ab_test", _ab_sql([]), AB_DOUBLES)
def q_ab_test(spark, sf_dir):
    return ex.ab_test(experiment(spark, sf_dir), "treatment", "converted")


@register("ab_test_grouped", _ab_sql(["c_nationkey"]), AB_DOUBLES)
def q_ab_test_grouped(spark, sf_dir):
    return ex.ab_test(experiment(spark, sf_dir), "treatment", "converted", ["c_nationkey"])


_PS_SQL = f"""
SELECT *, abs(absolute_lift) >= 0.01 AS is_practically_significant FROM ({_ab_sql(["o_orderpriority"])}) AS a
"""


@register("practical_significance", _PS_SQL, AB_DOUBLES)
def q_practical_significance(spark, sf_dir):
    return ex.practical_significance(ex.ab_test(experiment(spark, sf_dir), "treatment", "converted", ["o_orderpriority"]))


def _segment_sql() -> str:
    cols = "segment, segment_value, n_control, n_treatment, " + ", ".join(AB_DOUBLES)
    return f"SELECT {cols} FROM ({ex.stages_sql(_segment_counts_sql(), ex.ab_stages())}) AS s"


def _segment_counts_sql() -> str:
    return f"""
WITH e AS ({EXPERIMENT_SQL}),
l AS (
  SELECT 'o_orderpriority' AS segment, coalesce(CAST(o_orderpriority AS VARCHAR), 'nan') AS segment_value, treatment, converted FROM e
  UNION ALL
  SELECT 'c_mktsegment', coalesce(CAST(c_mktsegment AS VARCHAR), 'nan'), treatment, converted FROM e
  UNION ALL
  SELECT 'c_nationkey', coalesce(CAST(c_nationkey AS VARCHAR), 'nan'), treatment, converted FROM e),
c AS (
  SELECT segment, segment_value,
         count_if(treatment = 0) AS n_control, count_if(treatment = 1) AS n_treatment,
         CAST(sum(CASE WHEN treatment = 0 THEN converted ELSE 0 END) AS BIGINT) AS control_success,
         CAST(sum(CASE WHEN treatment = 1 THEN converted ELSE 0 END) AS BIGINT) AS treatment_success
  FROM l WHERE treatment IS NOT NULL AND converted IS NOT NULL
  GROUP BY segment, segment_value)
SELECT * FROM c WHERE n_control > 0 AND n_treatment > 0
"""


@register("segment_effects", _segment_sql(), AB_DOUBLES)
def q_segment_effects(spark, sf_dir):
    return ex.segment_effects(
        experiment(spark, sf_dir), "treatment", "converted", ["o_orderpriority", "c_mktsegment", "c_nationkey"]
    )


# ---------------------------------------------------------------- Welch / chi-square statistics

_WELCH_SQL = f"""
WITH e AS ({EXPERIMENT_SQL}),
l AS (
  SELECT 'o_totalprice' AS feature, treatment, CAST(o_totalprice AS DOUBLE) AS v FROM e
  UNION ALL SELECT 'c_acctbal', treatment, CAST(c_acctbal AS DOUBLE) FROM e),
a AS (
  SELECT feature,
         count_if(treatment = 0) AS n0, count_if(treatment = 1) AS n1,
         avg(CASE WHEN treatment = 0 THEN v END) AS control_mean,
         avg(CASE WHEN treatment = 1 THEN v END) AS treatment_mean,
         var_samp(CASE WHEN treatment = 0 THEN v END) AS var0,
         var_samp(CASE WHEN treatment = 1 THEN v END) AS var1
  FROM l WHERE treatment IS NOT NULL AND v IS NOT NULL GROUP BY feature)
SELECT feature, n0, n1, control_mean, treatment_mean,
       {ex.welch_formulas()['difference']} AS difference,
       {ex.welch_formulas()['t_stat']} AS t_stat,
       {ex.welch_formulas()['dof']} AS dof
FROM a WHERE n0 > 0 AND n1 > 0
"""


# The tail of the t distribution by Simpson's rule over its density from 0 to |t|.
_T_STEPS = 2000
_WELCH_P_SQL = f"""
WITH w AS ({_WELCH_SQL}),
c AS (SELECT *, exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi()) AS scale, abs(t_stat) / {_T_STEPS} AS h FROM w),
p AS (SELECT feature, h, scale * power(1 + (i * h) * (i * h) / dof, -(dof + 1) / 2)
             * CASE WHEN i IN (0, {_T_STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS part
      FROM c, (SELECT unnest(range({_T_STEPS} + 1)) AS i) AS r),
s AS (SELECT feature, 1 - 2 * sum(part) * min(h) / 3 AS p_value FROM p GROUP BY feature)
SELECT w.*, s.p_value FROM w JOIN s USING (feature)
"""


@register("welch_ttest", _WELCH_P_SQL, ["control_mean", "treatment_mean", "difference", "t_stat", "dof", "p_value"])
def q_welch(spark, sf_dir):
    """The test's p-value beside its statistics (t and Welch-Satterthwaite dof)."""
    e, cols = experiment(spark, sf_dir), ["o_totalprice", "c_acctbal"]
    return ex.welch_stats(e, "treatment", cols).join(ex.welch_ttest(e, "treatment", cols).select("feature", "p_value"), "feature")


def _chi_sql() -> str:
    cells = """
  SELECT feature, level, count_if(treatment = 0) AS o0, count_if(treatment = 1) AS o1
  FROM l WHERE treatment IS NOT NULL AND level IS NOT NULL GROUP BY feature, level"""
    return f"""
WITH e AS ({EXPERIMENT_SQL}),
l AS (
  SELECT 'o_orderpriority' AS feature, treatment, CAST(o_orderpriority AS VARCHAR) AS level FROM e
  UNION ALL SELECT 'c_mktsegment', treatment, CAST(c_mktsegment AS VARCHAR) FROM e
  UNION ALL SELECT 'arm3', treatment, CAST(arm3 AS VARCHAR) FROM e),
cells AS ({cells}),
m AS (
  SELECT feature, level, o0, o1,
         sum(o0) OVER (PARTITION BY feature) AS c0,
         sum(o1) OVER (PARTITION BY feature) AS c1,
         count(*) OVER (PARTITION BY feature) - 1 AS dof
  FROM cells),
t AS (
  SELECT feature, c0, c1, dof,
         (o0 + o1) * c0 / CAST(c0 + c1 AS DOUBLE) AS e0,
         (o0 + o1) * c1 / CAST(c0 + c1 AS DOUBLE) AS e1, o0, o1
  FROM m)
SELECT feature,
       sum(CASE WHEN e0 > 0 THEN power(abs(o0 - e0) - CASE WHEN dof = 1 THEN least(0.5, abs(o0 - e0)) ELSE 0.0 END, 2) / e0 ELSE 0.0 END
         + CASE WHEN e1 > 0 THEN power(abs(o1 - e1) - CASE WHEN dof = 1 THEN least(0.5, abs(o1 - e1)) ELSE 0.0 END, 2) / e1 ELSE 0.0 END) AS chi2,
       CAST(min(dof) AS BIGINT) AS dof, CAST(min(c0) AS BIGINT) AS n0, CAST(min(c1) AS BIGINT) AS n1
FROM t GROUP BY feature
HAVING min(c0) > 0 AND min(c1) > 0 AND min(dof) >= 1
"""


# The chi-square tail: the normal one for one degree of freedom, a finite sum for even ones.
_CHI_P_SQL = f"""
WITH c AS ({_chi_sql()}),
s AS (SELECT feature, sum(term) AS tail FROM (
        SELECT feature, exp(-chi2 / 2) * power(chi2 / 2, k) / exp(lgamma(k + 1)) AS term FROM c, (SELECT unnest(range(50)) AS k) AS r
        WHERE dof % 2 = 0 AND k < dof / 2) AS x GROUP BY feature)
SELECT c.*, CASE WHEN dof = 1 THEN {two_sided_p_sql('sqrt(chi2)')} ELSE tail END AS p_value FROM c LEFT JOIN s USING (feature)
"""


@register("chi_square_independence", _CHI_P_SQL, ["chi2", "p_value"])
def q_chi(spark, sf_dir):
    """The test's p-value beside Pearson's statistic and its dof per categorical
    covariate (Yates only for 2x2)."""
    e, cols = experiment(spark, sf_dir), ["o_orderpriority", "c_mktsegment", "arm3"]
    p = ex.chi_square_independence(e, "treatment", cols).select("feature", "p_value")
    return ex.chi_square_stats(e, "treatment", cols).join(p, "feature")


@register("chi_square_2x2_pvalue", f"""
SELECT feature, chi2, {two_sided_p_sql('sqrt(chi2)')} AS p_value FROM ({_chi_sql()}) AS c WHERE dof = 1
""", ["chi2", "p_value"])
def q_chi_2x2(spark, sf_dir):
    """For dof = 1 the chi-square tail is 2*(1 - Phi(sqrt(chi2))): checked in SQL."""
    s = ex.chi_square_stats(experiment(spark, sf_dir), "treatment", ["o_orderpriority", "c_mktsegment", "arm3"])
    return s.where("dof = 1").select("feature", "chi2", F.expr(two_sided_p_sql("sqrt(chi2)")).alias("p_value"))


@register("randomization_diagnostics", f"""
SELECT feature, 'welch_ttest' AS test, control_mean, treatment_mean, difference, p_value FROM ({_WELCH_P_SQL}) AS w
UNION ALL SELECT feature, 'chi_square', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), chi2, p_value FROM ({_CHI_P_SQL}) AS c
""", ["control_mean", "treatment_mean", "difference", "p_value"])
def q_randomization(spark, sf_dir):
    return ex.randomization_diagnostics(
        experiment(spark, sf_dir),
        "treatment",
        numeric_cols=["o_totalprice", "c_acctbal"],
        categorical_cols=["o_orderpriority", "c_mktsegment", "arm3"],
        outcome_col="converted",
        id_col="unit_id",
    )


# ---------------------------------------------------------------- balance

_BALANCE_SQL = f"""
WITH e AS (SELECT * FROM ({EXPERIMENT_SQL}) AS x WHERE treatment IN (0, 1)),
num AS (
  SELECT feature,
         avg(CASE WHEN treatment = 1 THEN v END) AS treated_mean,
         avg(CASE WHEN treatment = 0 THEN v END) AS control_mean,
         var_samp(CASE WHEN treatment = 1 THEN v END) AS vt,
         var_samp(CASE WHEN treatment = 0 THEN v END) AS vc
  FROM (SELECT 'o_totalprice' AS feature, treatment, CAST(o_totalprice AS DOUBLE) AS v FROM e
        UNION ALL SELECT 'c_acctbal', treatment, CAST(c_acctbal AS DOUBLE) FROM e) AS l
  GROUP BY feature),
arm AS (SELECT count_if(treatment = 1) AS nt, count_if(treatment = 0) AS nc FROM e),
lv AS (
  SELECT col, lvl, count_if(treatment = 1) AS kt, count_if(treatment = 0) AS kc
  FROM (SELECT 'o_orderpriority' AS col, CAST(o_orderpriority AS VARCHAR) AS lvl, treatment FROM e
        UNION ALL SELECT 'c_mktsegment', CAST(c_mktsegment AS VARCHAR), treatment FROM e) AS l
  WHERE lvl IS NOT NULL GROUP BY col, lvl),
cat AS (
  SELECT col || '=' || lvl AS feature, kt / CAST(nt AS DOUBLE) AS treated_mean, kc / CAST(nc AS DOUBLE) AS control_mean
  FROM lv CROSS JOIN arm)
SELECT feature, treated_mean, control_mean,
       (treated_mean - control_mean) / sqrt(greatest((vt + vc) / 2, 1e-9)) AS std_mean_diff FROM num
UNION ALL
SELECT feature, treated_mean, control_mean,
       (treated_mean - control_mean) / sqrt(greatest((treated_mean * (1 - treated_mean) + control_mean * (1 - control_mean)) / 2, 1e-9))
FROM cat
"""


@register("balance_check", _BALANCE_SQL, ["treated_mean", "control_mean", "std_mean_diff"])
def q_balance(spark, sf_dir):
    return ex.balance_check(
        experiment(spark, sf_dir), "treatment", ["o_totalprice", "c_acctbal"], ["o_orderpriority", "c_mktsegment"]
    )


# ---------------------------------------------------------------- power and decision

_POWER_COLS = ["baseline_rate", "effect_size_h", "required_n_per_group", "observed_power", "is_sample_adequate"]


def _power_sql() -> str:
    staged = ex.stages_sql(_ab_sql(["o_orderpriority"]), ex.power_stages())
    return f"SELECT *, 0.05 AS alpha, 0.8 AS target_power FROM ({staged}) AS a"


@register("power_check", _power_sql(), AB_DOUBLES + ["baseline_rate", "effect_size_h", "observed_power", "alpha", "target_power"])
def q_power(spark, sf_dir):
    return ex.power_check(ex.ab_test(experiment(spark, sf_dir), "treatment", "converted", ["o_orderpriority"]))


def _decision_sql() -> str:
    f = ex.decision_formulas()
    # value columns: IPW policy values of the price-band score, per priority
    from sparkexp.plans.q_uplift import policies_sql

    return f"""
WITH ab AS ({_ab_sql(['o_orderpriority'])}),
pol AS ({policies_sql(['o_orderpriority'], 0.30)}),
j AS (SELECT ab.*, pol.expected_incremental_value_blanket AS value_blanket,
             pol.expected_incremental_value_targeted AS value_targeted
      FROM ab JOIN pol USING (o_orderpriority))
SELECT *, {f['decision']} AS decision, {f['rationale']} AS rationale,
       '[' || printf('%.4f', ci_low) || ', ' || printf('%.4f', ci_high) || ']' AS ab_ci
FROM j
"""


@register("decision_recommendation", _decision_sql(), AB_DOUBLES + ["value_blanket", "value_targeted"])
def q_decision(spark, sf_dir):
    from sparkexp.operators.uplift import compare_policies

    e = experiment(spark, sf_dir)
    ab = ex.ab_test(e, "treatment", "converted", ["o_orderpriority"])
    pol = compare_policies(e, "converted", "treatment", "score", "unit_id", ["o_orderpriority"]).select(
        "o_orderpriority",
        F.col("expected_incremental_value_blanket").alias("value_blanket"),
        F.col("expected_incremental_value_targeted").alias("value_targeted"),
    )
    return ex.decision_recommendation(ab.join(pol, "o_orderpriority"))


def _summary_sql() -> str:
    f = ex.decision_formulas()
    from sparkexp.plans.q_uplift import policies_sql

    staged = ex.stages_sql(_ab_sql(["c_mktsegment"]), ex.power_stages())
    return f"""
WITH ab AS (SELECT *, 0.05 AS alpha, 0.8 AS target_power FROM ({staged}) AS a),
pol AS ({policies_sql(['c_mktsegment'], 0.30)}),
j AS (SELECT ab.*, pol.expected_incremental_value_blanket AS value_blanket,
             pol.expected_incremental_value_targeted AS value_targeted
      FROM ab JOIN pol USING (c_mktsegment))
SELECT *, {f['decision']} AS decision, {f['rationale']} AS rationale,
       '[' || printf('%.4f', ci_low) || ', ' || printf('%.4f', ci_high) || ']' AS ab_ci
FROM j
"""


@register(
    "experiment_summary",
    _summary_sql(),
    AB_DOUBLES + ["baseline_rate", "effect_size_h", "observed_power", "alpha", "target_power", "value_blanket", "value_targeted"],
)
def q_experiment_summary(spark, sf_dir):
    return ex.experiment_summary(
        experiment(spark, sf_dir), "treatment", "converted", "score", "unit_id", ["c_mktsegment"]
    )
