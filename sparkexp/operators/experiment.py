"""Experiment statistics: A/B test, segment effects, randomisation checks,
covariate balance, power and decisions.

Every operator is one grouped aggregate (map-side partial aggregation, then a
shuffle of at most one row per group per partition) followed by column
arithmetic on the small aggregated table. Segment and covariate loops of the
single-table version are fused into one job by unpivoting first.

The closed-form statistics are written as SQL text over the aggregated
columns, so the library and the DuckDB oracle evaluate identical formulas.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.operators.joins import join_keys
from sparkexp.functions.distributions import chi2_sf_udf, t_two_sided_p_udf
from sparkexp.functions.normal import norm_ppf, norm_sf_sql, two_sided_p_sql
from sparkexp.functions.scalars import TREATMENT_TOKENS, encode_treatment

Z_975 = 1.959963984540054  # norm.isf(0.025)

AB_COLUMNS = [
    "n_control",
    "n_treatment",
    "control_rate",
    "treatment_rate",
    "absolute_lift",
    "relative_lift",
    "ci_low",
    "ci_high",
    "p_value",
]


# ---------------------------------------------------------------- formulas (SQL text)

def ab_stages(alpha: float = 0.05) -> list[tuple[str, str]]:
    """A/B statistics as ordered (column, SQL) stages over columns n_control,
    n_treatment, control_success, treatment_success. Intermediate columns
    start with '_' and keep every expression small (the normal tail refers
    to its argument many times)."""
    z = repr(norm_ppf(1 - alpha / 2)) if alpha != 0.05 else repr(Z_975)
    return [
        ("control_rate", "(CAST(control_success AS DOUBLE) / NULLIF(n_control, 0))"),
        ("treatment_rate", "(CAST(treatment_success AS DOUBLE) / NULLIF(n_treatment, 0))"),
        ("absolute_lift", "(treatment_rate - control_rate)"),
        ("relative_lift", "(CASE WHEN control_rate > 0 THEN absolute_lift / control_rate END)"),
        ("_pooled", "(CAST(control_success + treatment_success AS DOUBLE) / NULLIF(n_control + n_treatment, 0))"),
        ("_se0", "sqrt(_pooled * (1.0 - _pooled) * (1.0 / NULLIF(n_treatment, 0) + 1.0 / NULLIF(n_control, 0)))"),
        ("_z", "(absolute_lift / NULLIF(_se0, 0.0))"),
        ("_se1", "sqrt(treatment_rate * (1.0 - treatment_rate) / NULLIF(n_treatment, 0) + control_rate * (1.0 - control_rate) / NULLIF(n_control, 0))"),
        ("ci_low", f"(absolute_lift - {z} * _se1)"),
        ("ci_high", f"(absolute_lift + {z} * _se1)"),
        ("p_value", two_sided_p_sql("_z")),
    ]


def power_stages(alpha: float = 0.05, target_power: float = 0.80, clip: float = 1e-6) -> list[tuple[str, str]]:
    """Power check as ordered (column, SQL) stages over columns control_rate
    (baseline), absolute_lift, n_control, n_treatment. Each stage refers to
    earlier ones by name, so expressions stay small.

    Cohen's h on clipped rates; required n per arm solves the two-sided normal
    power equation (closed form, then two Newton steps that add the far tail);
    achieved power uses n1 = min(n_c, n_t) and ratio n_t / n_c, as the
    single-table version does.
    """
    za = repr(norm_ppf(1 - alpha / 2))
    zb = repr(norm_ppf(target_power))
    lo, hi = repr(clip), repr(1 - clip)
    st: list[tuple[str, str]] = [
        ("baseline_rate", f"greatest(least(CAST(control_rate AS DOUBLE), {hi}), {lo})"),
        ("_treat", f"greatest(least(baseline_rate + CAST(absolute_lift AS DOUBLE), {hi}), {lo})"),
        ("effect_size_h", "(2.0 * asin(sqrt(_treat)) - 2.0 * asin(sqrt(baseline_rate)))"),
        ("_ah", "abs(effect_size_h)"),
        ("_n0", f"(2.0 * power(({za} + {zb}) / NULLIF(_ah, 0.0), 2))"),
    ]
    for k in range(2):
        n, n_next = f"_n{k}", f"_n{k + 1}"
        st += [
            (f"_s{k}", f"(_ah * sqrt({n} / 2.0))"),
            (f"_a{k}", f"({za} - _s{k})"),
            (f"_b{k}", f"({za} + _s{k})"),
            (f"_f{k}", f"({norm_sf_sql(f'_a{k}')} + {norm_sf_sql(f'_b{k}')} - {target_power!r})"),
            (f"_d{k}", f"((exp(-_a{k} * _a{k} / 2.0) - exp(-_b{k} * _b{k} / 2.0)) / 2.5066282746310002 * _ah / (4.0 * sqrt({n} / 2.0)))"),
            (n_next, f"({n} - _f{k} / NULLIF(_d{k}, 0.0))"),
        ]
    st += [
        ("required_n_per_group", "CAST(ceil(_n2) AS BIGINT)"),
        ("_ratio", "(CAST(greatest(n_treatment, 1) AS DOUBLE) / greatest(n_control, 1))"),
        ("_neff", "(CAST(least(n_control, n_treatment) AS DOUBLE) * _ratio / (1.0 + _ratio))"),
        ("_ao", f"({za} - effect_size_h * sqrt(_neff))"),
        ("_bo", f"({za} + effect_size_h * sqrt(_neff))"),
        ("observed_power", f"({norm_sf_sql('_ao')} + {norm_sf_sql('_bo')})"),
        ("is_sample_adequate", "(n_control >= required_n_per_group AND n_treatment >= required_n_per_group)"),
    ]
    return st


def apply_stages(df: DataFrame, stages: list[tuple[str, str]]) -> DataFrame:
    for name, expr in stages:
        df = df.withColumn(name, F.expr(expr))
    return df.drop(*[n for n, _ in stages if n.startswith("_")])


def stages_sql(base_sql: str, stages: list[tuple[str, str]]) -> str:
    sql = base_sql
    for i, (name, expr) in enumerate(stages):
        sql = f"SELECT *, {expr} AS {name} FROM ({sql}) AS _s{i}"
    temps = [n for n, _ in stages if n.startswith("_")]
    return f"SELECT * EXCLUDE ({', '.join(temps)}) FROM ({sql}) AS _fin" if temps else sql


# Decision rules and rationale texts.
DECISION_TEXT = {
    "ship_segment_only": "A/B effect is positive with statistical confidence, and targeted rollout materially exceeds blanket value.",
    "ship_all": "A/B effect is positive and reliable, with limited extra value from targeted-only rollout.",
    "iterate": "Directional lift exists but uncertainty remains; continue experimentation before full launch.",
    "stop": "No reliable positive incremental effect; avoid broad rollout.",
}


def decision_formulas(p_threshold: float = 0.05, targeted_margin: float = 1.05) -> dict[str, str]:
    """Over columns p_value, absolute_lift, ci_low, ci_high, value_blanket, value_targeted."""
    confident = f"(absolute_lift > 0 AND p_value < {p_threshold} AND ci_low > 0)"
    decision = (
        f"(CASE WHEN {confident} AND value_targeted > value_blanket * {targeted_margin} THEN 'ship_segment_only' "
        f"WHEN {confident} THEN 'ship_all' "
        "WHEN absolute_lift > 0 AND value_targeted > 0 THEN 'iterate' ELSE 'stop' END)"
    )
    rationale = "(CASE " + " ".join(
        f"WHEN {decision} = '{k}' THEN '{v}'" for k, v in DECISION_TEXT.items()
    ) + " END)"
    ci_text = "concat('[', format_number_4(ci_low), ', ', format_number_4(ci_high), ']')"
    return {"decision": decision, "rationale": rationale, "ab_ci": ci_text}


def _fmt4_spark(c: str) -> str:
    return f"format_string('%.4f', {c})"


# ---------------------------------------------------------------- A/B test

def _ab_input(df: DataFrame, treatment_col: str, outcome_col: str, tokens: Sequence[str]) -> tuple[DataFrame, Column, Column]:
    d = df.where(F.col(treatment_col).isNotNull() & F.col(outcome_col).isNotNull())
    t = encode_treatment(df, treatment_col, tokens)
    y = F.col(outcome_col).cast("int")
    return d, t, y


def ab_counts(
    df: DataFrame,
    treatment_col: str,
    outcome_col: str,
    group_cols: Sequence[str] = (),
    tokens: Sequence[str] = TREATMENT_TOKENS,
) -> DataFrame:
    """Sufficient statistics per group: arm sizes and successes (one aggregate)."""
    d, t, y = _ab_input(df, treatment_col, outcome_col, tokens)
    d = d.select(*group_cols, t.alias("_t"), y.alias("_y"))
    return d.groupBy(*group_cols).agg(
        F.count_if(F.col("_t") == 0).alias("n_control"),
        F.count_if(F.col("_t") == 1).alias("n_treatment"),
        F.sum(F.when(F.col("_t") == 0, F.col("_y")).otherwise(0)).cast("long").alias("control_success"),
        F.sum(F.when(F.col("_t") == 1, F.col("_y")).otherwise(0)).cast("long").alias("treatment_success"),
    )


def ab_from_counts(counts: DataFrame, group_cols: Sequence[str] = (), alpha: float = 0.05) -> DataFrame:
    return apply_stages(counts, ab_stages(alpha)).select(*group_cols, *AB_COLUMNS)


def ab_test(
    df: DataFrame,
    treatment_col: str,
    outcome_col: str,
    group_cols: Sequence[str] = (),
    alpha: float = 0.05,
    tokens: Sequence[str] = TREATMENT_TOKENS,
) -> DataFrame:
    """Two-proportion A/B test per group: arm sizes and rates, absolute and
    relative lift, unpooled Wald CI, pooled two-sided z-test p-value.

    Rows with a NULL treatment or outcome are dropped first. Relative lift is
    NULL when the control rate is 0; an empty arm gives NULL statistics.
    """
    return ab_from_counts(ab_counts(df, treatment_col, outcome_col, group_cols, tokens), group_cols, alpha)


def practical_significance(ab: DataFrame, min_lift: float = 0.01) -> DataFrame:
    return ab.withColumn("is_practically_significant", F.abs(F.col("absolute_lift")) >= F.lit(min_lift))


def segment_effects(
    df: DataFrame,
    treatment_col: str,
    outcome_col: str,
    segment_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    alpha: float = 0.05,
    tokens: Sequence[str] = TREATMENT_TOKENS,
    null_token: str = "nan",
) -> DataFrame:
    """A/B test for every value of every segment column, in one job.

    Rows are unpivoted to (segment, segment_value) pairs (NULL value -> 'nan'),
    aggregated once, and segments where an arm is empty after the NULL drop
    are skipped. Sorted by (segment, p_value).
    """
    d, t, y = _ab_input(df, treatment_col, outcome_col, tokens)
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("segment"), F.coalesce(F.col(s).cast("string"), F.lit(null_token)).alias("segment_value"))
            for s in segment_cols
        ]
    )
    long = d.select(*group_cols, t.alias("_t"), y.alias("_y"), F.inline(pairs))
    keys = [*group_cols, "segment", "segment_value"]
    counts = long.groupBy(*keys).agg(
        F.count_if(F.col("_t") == 0).alias("n_control"),
        F.count_if(F.col("_t") == 1).alias("n_treatment"),
        F.sum(F.when(F.col("_t") == 0, F.col("_y")).otherwise(0)).cast("long").alias("control_success"),
        F.sum(F.when(F.col("_t") == 1, F.col("_y")).otherwise(0)).cast("long").alias("treatment_success"),
    ).where((F.col("n_control") > 0) & (F.col("n_treatment") > 0))
    return ab_from_counts(counts, keys, alpha).orderBy(*group_cols, "segment", F.col("p_value").asc_nulls_last())


# ---------------------------------------------------------------- randomisation checks

DIAG_SCHEMA = "feature string, test string, control_mean double, treatment_mean double, difference double, p_value double"


def _treatment_int(df: DataFrame, treatment_col: str, tokens: Sequence[str]) -> Column:
    return encode_treatment(df, treatment_col, tokens)


def welch_stats(
    df: DataFrame,
    treatment_col: str,
    numeric_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    tokens: Sequence[str] = TREATMENT_TOKENS,
) -> DataFrame:
    """Per numeric covariate: arm means, variances, sizes, Welch t and dof (one aggregate)."""
    d = df.where(F.col(treatment_col).isNotNull())
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_v")) for c in numeric_cols])
    long = d.select(*group_cols, _treatment_int(df, treatment_col, tokens).alias("_t"), F.inline(pairs)).where(
        F.col("_v").isNotNull()
    )
    keys = [*group_cols, "feature"]
    agg = long.groupBy(*keys).agg(
        F.count_if(F.col("_t") == 0).alias("n0"),
        F.count_if(F.col("_t") == 1).alias("n1"),
        F.avg(F.when(F.col("_t") == 0, F.col("_v"))).alias("control_mean"),
        F.avg(F.when(F.col("_t") == 1, F.col("_v"))).alias("treatment_mean"),
        F.var_samp(F.when(F.col("_t") == 0, F.col("_v"))).alias("var0"),
        F.var_samp(F.when(F.col("_t") == 1, F.col("_v"))).alias("var1"),
    ).where((F.col("n0") > 0) & (F.col("n1") > 0))
    f = welch_formulas()
    return agg.select(*keys, "n0", "n1", "control_mean", "treatment_mean", *[F.expr(v).alias(k) for k, v in f.items()])


def welch_formulas() -> dict[str, str]:
    se2 = "(var1 / n1 + var0 / n0)"
    return {
        "difference": "(treatment_mean - control_mean)",
        "t_stat": f"((treatment_mean - control_mean) / NULLIF(sqrt({se2}), 0.0))",
        "dof": f"(power({se2}, 2) / NULLIF(power(var1 / n1, 2) / (n1 - 1) + power(var0 / n0, 2) / (n0 - 1), 0.0))",
    }


def welch_ttest(
    df: DataFrame,
    treatment_col: str,
    numeric_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    tokens: Sequence[str] = TREATMENT_TOKENS,
) -> DataFrame:
    """Welch unequal-variance t-test of treatment vs control per numeric covariate."""
    s = welch_stats(df, treatment_col, numeric_cols, group_cols, tokens)
    return s.select(
        *group_cols,
        "feature",
        F.lit("welch_ttest").alias("test"),
        "control_mean",
        "treatment_mean",
        "difference",
        t_two_sided_p_udf(F.col("t_stat"), F.col("dof")).alias("p_value"),
    )


def chi_square_stats(
    df: DataFrame,
    treatment_col: str,
    categorical_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    tokens: Sequence[str] = TREATMENT_TOKENS,
) -> DataFrame:
    """Pearson chi-square of (covariate level x arm) per categorical covariate.

    Cell counts come from one grouped aggregate; margins are window sums over
    the (tiny) cell table. Yates' correction applies only when dof = 1.
    Covariates with one arm present are skipped; NULL levels are dropped.
    """
    d = df.where(F.col(treatment_col).isNotNull())
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in categorical_cols])
    long = d.select(*group_cols, _treatment_int(df, treatment_col, tokens).alias("_t"), F.inline(pairs)).where(
        F.col("level").isNotNull()
    )
    keys = [*group_cols, "feature"]
    cells = long.groupBy(*keys, "level").agg(
        F.count_if(F.col("_t") == 0).alias("o0"), F.count_if(F.col("_t") == 1).alias("o1")
    )
    return chi_square_from_cells(cells, keys)


def chi_square_from_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy(*keys)
    m = cells.select(
        *keys,
        "o0",
        "o1",
        F.sum("o0").over(w).alias("c0"),
        F.sum("o1").over(w).alias("c1"),
        F.count(F.lit(1)).over(w).alias("n_levels"),
    )
    m = m.withColumn("_n", F.col("c0") + F.col("c1"))
    m = m.withColumn("_dof", (F.col("n_levels") - 1) * F.lit(1))
    terms = []
    for o, c in (("o0", "c0"), ("o1", "c1")):
        e = (F.col("o0") + F.col("o1")) * F.col(c) / F.col("_n")
        diff = F.abs(F.col(o) - e)
        corr = F.when(F.col("_dof") == 1, F.least(F.lit(0.5), diff)).otherwise(F.lit(0.0))
        terms.append(F.when(e > 0, F.pow(diff - corr, 2) / e).otherwise(F.lit(0.0)))
    m = m.withColumn("_term", terms[0] + terms[1])
    out = m.groupBy(*keys).agg(
        F.sum("_term").alias("chi2"),
        F.first("_dof").alias("dof"),
        F.min("c0").alias("n0"),
        F.min("c1").alias("n1"),
    ).where((F.col("n0") > 0) & (F.col("n1") > 0) & (F.col("dof") >= 1))
    return out.select(*keys, "chi2", F.col("dof").cast("long").alias("dof"), "n0", "n1")


def chi_square_independence(
    df: DataFrame,
    treatment_col: str,
    categorical_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    tokens: Sequence[str] = TREATMENT_TOKENS,
) -> DataFrame:
    s = chi_square_stats(df, treatment_col, categorical_cols, group_cols, tokens)
    return s.select(
        *group_cols,
        "feature",
        F.lit("chi_square").alias("test"),
        F.lit(None).cast("double").alias("control_mean"),
        F.lit(None).cast("double").alias("treatment_mean"),
        F.col("chi2").alias("difference"),
        chi2_sf_udf(F.col("chi2"), F.col("dof").cast("double")).alias("p_value"),
    )


def randomization_diagnostics(
    df: DataFrame,
    treatment_col: str,
    numeric_cols: Sequence[str] = (),
    categorical_cols: Sequence[str] = (),
    group_cols: Sequence[str] = (),
    tokens: Sequence[str] = TREATMENT_TOKENS,
    outcome_col: str | None = None,
    id_col: str | None = None,
) -> DataFrame:
    """Welch tests for numeric and chi-square tests for categorical covariates,
    unioned and sorted by p-value. Empty input gives an empty typed table.

    The treatment, outcome and id columns are rejected as covariates.
    """
    banned = {treatment_col, outcome_col, id_col} - {None}
    bad = banned.intersection(list(numeric_cols) + list(categorical_cols))
    if bad:
        raise ValueError(f"not covariates: {sorted(bad)}")
    parts: list[DataFrame] = []
    if numeric_cols:
        parts.append(welch_ttest(df, treatment_col, numeric_cols, group_cols, tokens))
    if categorical_cols:
        parts.append(chi_square_independence(df, treatment_col, categorical_cols, group_cols, tokens))
    if not parts:
        spark = df.sparkSession
        return spark.createDataFrame([], DIAG_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(*group_cols, F.col("p_value").asc_nulls_last(), "feature")


# ---------------------------------------------------------------- balance (SMD)

def balance_check(
    df: DataFrame,
    treatment_col: str,
    numeric_cols: Sequence[str] = (),
    categorical_cols: Sequence[str] = (),
    group_cols: Sequence[str] = (),
    floor: float = 1e-9,
) -> DataFrame:
    """Standardised mean difference per numeric column and per category level.

    Numeric: (m_t - m_c) / sqrt(max((v_t + v_c)/2, floor)), sample variances.
    Level: rates of ``col == level`` in each arm (NULL counts as not the level),
    pooled p(1-p). Sorted by |SMD| desc. ``treatment_col`` must be 0/1.
    """
    t = F.col(treatment_col).cast("int")
    d = df.where(t.isin(0, 1))
    parts: list[DataFrame] = []
    if numeric_cols:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("_v")) for c in numeric_cols])
        long = d.select(*group_cols, t.alias("_t"), F.inline(pairs))
        agg = long.groupBy(*group_cols, "feature").agg(
            F.avg(F.when(F.col("_t") == 1, F.col("_v"))).alias("treated_mean"),
            F.avg(F.when(F.col("_t") == 0, F.col("_v"))).alias("control_mean"),
            F.var_samp(F.when(F.col("_t") == 1, F.col("_v"))).alias("_vt"),
            F.var_samp(F.when(F.col("_t") == 0, F.col("_v"))).alias("_vc"),
        )
        pooled = F.sqrt(F.greatest((F.col("_vt") + F.col("_vc")) / 2, F.lit(floor)))
        parts.append(
            agg.select(
                *group_cols,
                "feature",
                "treated_mean",
                "control_mean",
                ((F.col("treated_mean") - F.col("control_mean")) / pooled).alias("std_mean_diff"),
            )
        )
    if categorical_cols:
        arm = d.groupBy(*group_cols).agg(
            F.count_if(t == 1).alias("_nt"), F.count_if(t == 0).alias("_nc")
        )
        pairs = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("string").alias("_lvl")) for c in categorical_cols])
        long = d.select(*group_cols, t.alias("_t"), F.inline(pairs)).where(F.col("_lvl").isNotNull())
        lv = long.groupBy(*group_cols, "_col", "_lvl").agg(
            F.count_if(F.col("_t") == 1).alias("_kt"), F.count_if(F.col("_t") == 0).alias("_kc")
        )
        lv = join_keys(lv, arm, group_cols)
        tr = F.col("_kt") / F.nullif(F.col("_nt"), F.lit(0))
        cr = F.col("_kc") / F.nullif(F.col("_nc"), F.lit(0))
        lv = lv.select(*group_cols, "_col", "_lvl", tr.alias("treated_mean"), cr.alias("control_mean"))
        pooled = F.sqrt(
            F.greatest(
                (F.col("treated_mean") * (1 - F.col("treated_mean")) + F.col("control_mean") * (1 - F.col("control_mean"))) / 2,
                F.lit(floor),
            )
        )
        parts.append(
            lv.select(
                *group_cols,
                F.concat(F.col("_col"), F.lit("="), F.col("_lvl")).alias("feature"),
                "treated_mean",
                "control_mean",
                ((F.col("treated_mean") - F.col("control_mean")) / pooled).alias("std_mean_diff"),
            )
        )
    if not parts:
        raise ValueError("no covariates given")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(*group_cols, F.abs(F.col("std_mean_diff")).desc_nulls_last(), "feature")


# ---------------------------------------------------------------- power, decision, summary

def power_check(ab: DataFrame, alpha: float = 0.05, target_power: float = 0.80) -> DataFrame:
    """Adds power columns to an ``ab_test`` table (one row per experiment/segment)."""
    out = apply_stages(ab, power_stages(alpha, target_power))
    return out.withColumn("alpha", F.lit(float(alpha))).withColumn("target_power", F.lit(float(target_power)))


def decision_recommendation(
    table: DataFrame, p_threshold: float = 0.05, targeted_margin: float = 1.05
) -> DataFrame:
    """Ship / iterate / stop per row of a table holding p_value, absolute_lift,
    ci_low, ci_high, value_blanket and value_targeted."""
    f = decision_formulas(p_threshold, targeted_margin)
    ci = F.concat(
        F.lit("["), F.format_string("%.4f", F.col("ci_low")), F.lit(", "), F.format_string("%.4f", F.col("ci_high")), F.lit("]")
    )
    return (
        table.withColumn("decision", F.expr(f["decision"]))
        .withColumn("rationale", F.expr(f["rationale"]))
        .withColumn("ab_ci", ci)
    )


def experiment_summary(
    df: DataFrame,
    treatment_col: str,
    outcome_col: str,
    score_col: str,
    id_col: str,
    group_cols: Sequence[str],
    conversion_value: float = 120.0,
    top_fraction: float = 0.30,
    alpha: float = 0.05,
    target_power: float = 0.80,
) -> DataFrame:
    """A/B test + power + policy values + decision, one row per experiment."""
    from sparkexp.operators.uplift import compare_policies

    ab = power_check(ab_test(df, treatment_col, outcome_col, group_cols, alpha), alpha, target_power)
    pol = compare_policies(df, outcome_col, treatment_col, score_col, id_col, group_cols, conversion_value, top_fraction)
    pol = pol.select(
        *group_cols,
        F.col("expected_incremental_value_blanket").alias("value_blanket"),
        F.col("expected_incremental_value_targeted").alias("value_targeted"),
    )
    joined = join_keys(ab, pol, group_cols)
    return decision_recommendation(joined)
