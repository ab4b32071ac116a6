"""Registered drift / monitoring queries.

lineitem shipped before 1998 is the expected side, later lines the actual
side; the monitoring example scores orders (prob = price / 500000) and
inflates a 250-order recent sample by 8 %.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkexp.functions.hashing import seeded_uniform_sql
from sparkexp.operators import drift as dr
from sparkexp.operators.sampling import inflate_batch, sample_n
from sparkexp.plans.registry import register
from sparkexp.plans.tables import load, use_utc

CUT = "1998-01-01"
NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT = ["l_returnflag", "l_linestatus"]


def _li(spark, sf_dir):
    use_utc(spark)
    li = load(spark, sf_dir, "lineitem")
    cut = F.col("l_shipdate") < F.lit(CUT).cast("timestamp")
    return li.where(cut), li.where(~cut)


def _unpivot_sql(src: str, cols: list[str], cast: str = "DOUBLE") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS v FROM {src}" for c in cols)


def psi_sql(exp_src: str, act_src: str, cols: list[str], bins: int = 10) -> str:
    probs = ", ".join(f"({i}, {i / bins!r})" for i in range(bins + 1))
    feats = ", ".join(f"('{c}')" for c in cols)
    return f"""
WITH e AS (SELECT * FROM ({_unpivot_sql(exp_src, cols)}) AS x WHERE v IS NOT NULL AND NOT isnan(v)),
a AS (SELECT * FROM ({_unpivot_sql(act_src, cols)}) AS x WHERE v IS NOT NULL AND NOT isnan(v)),
r AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) AS rk, count(*) OVER (PARTITION BY feature) AS n FROM e),
q AS (SELECT * FROM (VALUES {probs}) AS t(qi, prob)),
t AS (SELECT f.feature, f.n, q.qi, CAST(f.n - 1 AS DOUBLE) * q.prob AS h
      FROM (SELECT DISTINCT feature, n FROM r) AS f CROSS JOIN q),
t2 AS (SELECT *, CAST(floor(h) AS BIGINT) + 1 AS lo, least(CAST(floor(h) AS BIGINT) + 2, n) AS hi, h - floor(h) AS frac FROM t),
ev AS (SELECT t2.feature,
              CASE WHEN frac >= 0.5 THEN rh.v - (rh.v - rl.v) * (1.0 - frac) ELSE rl.v + (rh.v - rl.v) * frac END AS edge
       FROM t2 JOIN r AS rl ON rl.feature = t2.feature AND rl.rk = t2.lo
               JOIN r AS rh ON rh.feature = t2.feature AND rh.rk = t2.hi),
el AS (SELECT DISTINCT feature, edge FROM ev),
fe AS (SELECT feature, count(*) - 1 AS nb, min(edge) AS lo_e, max(edge) AS hi_e FROM el GROUP BY feature HAVING count(*) >= 3),
bins AS (SELECT feature, nb, unnest(range(0, nb)) AS bin FROM fe),
eb AS (SELECT x.feature, least((SELECT count(*) FROM el WHERE el.feature = x.feature AND el.edge <= x.v) - 1, fe.nb - 1) AS bin
       FROM e AS x JOIN fe ON fe.feature = x.feature WHERE x.v >= fe.lo_e AND x.v <= fe.hi_e),
ab AS (SELECT x.feature, least((SELECT count(*) FROM el WHERE el.feature = x.feature AND el.edge <= x.v) - 1, fe.nb - 1) AS bin
       FROM a AS x JOIN fe ON fe.feature = x.feature WHERE x.v >= fe.lo_e AND x.v <= fe.hi_e),
ec AS (SELECT feature, bin, count(*) AS c FROM eb GROUP BY feature, bin),
ac AS (SELECT feature, bin, count(*) AS c FROM ab GROUP BY feature, bin),
m AS (SELECT b.feature, b.nb, coalesce(ec.c, 0) AS ce, coalesce(ac.c, 0) AS ca FROM bins AS b
      LEFT JOIN ec ON ec.feature = b.feature AND ec.bin = b.bin LEFT JOIN ac ON ac.feature = b.feature AND ac.bin = b.bin),
s AS (SELECT *, (ce + 1e-6) / (sum(ce) OVER (PARTITION BY feature) + 1e-6 * nb) AS pe,
                (ca + 1e-6) / (sum(ca) OVER (PARTITION BY feature) + 1e-6 * nb) AS pa FROM m),
p AS (SELECT feature, sum((pa - pe) * ln(pa / pe)) AS psi FROM s GROUP BY feature),
ne AS (SELECT feature, count(*) AS c FROM e GROUP BY feature),
na AS (SELECT feature, count(*) AS c FROM a GROUP BY feature)
SELECT f.feature, CASE WHEN coalesce(ne.c, 0) > 0 AND coalesce(na.c, 0) > 0 THEN p.psi END AS psi
FROM (VALUES {feats}) AS f(feature) LEFT JOIN p ON p.feature = f.feature
LEFT JOIN ne ON ne.feature = f.feature LEFT JOIN na ON na.feature = f.feature
"""


LI_EXP = f"(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}')"
LI_ACT = f"(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')"


@register("population_stability_index", psi_sql(LI_EXP, LI_ACT, NUM), ["psi"])
def q_psi(spark, sf_dir):
    e, a = _li(spark, sf_dir)
    return dr.population_stability_index(e, a, NUM)


def shift_sql(exp_src: str, act_src: str, cols: list[str]) -> str:
    def shares(src: str) -> str:
        u = " UNION ALL ".join(f"SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), 'nan') AS value FROM {src}" for c in cols)
        return f"""SELECT feature, value, count(*) / CAST(sum(count(*)) OVER (PARTITION BY feature) AS DOUBLE) AS p
                   FROM ({u}) AS x GROUP BY feature, value"""

    return f"""
SELECT coalesce(e.feature, a.feature) AS feature, sum(abs(coalesce(e.p, 0.0) - coalesce(a.p, 0.0))) * 0.5 AS shift
FROM ({shares(exp_src)}) AS e FULL OUTER JOIN ({shares(act_src)}) AS a ON e.feature = a.feature AND e.value = a.value
GROUP BY coalesce(e.feature, a.feature)
"""


@register("categorical_shift", shift_sql(LI_EXP, LI_ACT, CAT), ["shift"])
def q_shift(spark, sf_dir):
    e, a = _li(spark, sf_dir)
    return dr.categorical_shift(e, a, CAT)


def level_sql(score: str) -> str:
    return (
        f"CASE WHEN {score} IS NULL THEN 'unknown' WHEN {score} > 0.2 THEN 'high' "
        f"WHEN {score} > 0.1 THEN 'medium' ELSE 'low' END"
    )


# ---------------------------------------------------------------- orders monitoring example

ORD_COLS = ["o_totalprice", "o_orderpriority", "o_orderstatus"]


def _orders(spark, sf_dir):
    use_utc(spark)
    o = load(spark, sf_dir, "orders")
    cut = F.col("o_orderdate") < F.lit(CUT).cast("timestamp")
    return o.where(cut), o.where(~cut)


def _recent(spark, sf_dir):
    _, late = _orders(spark, sf_dir)
    return inflate_batch(late, 250, seed=42, id_col="o_orderkey", column="o_totalprice", factor=1.08)


def recent_sql() -> str:
    u = seeded_uniform_sql(42, "o_orderkey")
    return f"""(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 1.08 AS o_totalprice, o_orderdate, o_orderpriority
FROM (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}' ORDER BY {u}, o_orderkey LIMIT 250) AS s)"""


def _all_recent(spark, sf_dir):
    """Every late order, prices inflated as in the drifted batch."""
    _, late = _orders(spark, sf_dir)
    return late.withColumn("o_totalprice", F.col("o_totalprice") * 1.08)


ALL_RECENT = f"""(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 1.08 AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT}')"""
ORD_EXP = f"(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}')"


@register("inflate_batch", f"SELECT * FROM {recent_sql()} AS r", ["o_totalprice"])
def q_inflate(spark, sf_dir):
    return _recent(spark, sf_dir)


@register(
    "sample_n",
    f"SELECT * FROM orders ORDER BY {seeded_uniform_sql(7, 'o_orderkey')}, o_orderkey LIMIT 100",
    ["o_totalprice"],
)
def q_sample_n(spark, sf_dir):
    use_utc(spark)
    return sample_n(load(spark, sf_dir, "orders"), 100, seed=7, id_col="o_orderkey")


def drift_table_sql() -> str:
    rec = ALL_RECENT
    return f"""
WITH d AS (
  SELECT feature AS feature_name, 'numeric' AS feature_type, psi AS drift_score FROM ({psi_sql(ORD_EXP, rec, ['o_totalprice'])}) AS p
  UNION ALL
  SELECT feature, 'categorical', shift FROM ({shift_sql(ORD_EXP, rec, ['o_orderpriority', 'o_orderstatus'])}) AS s)
SELECT *, {level_sql('drift_score')} AS drift_level FROM d
"""


@register("drift_table", drift_table_sql(), ["drift_score"])
def q_drift_table(spark, sf_dir):
    early, _ = _orders(spark, sf_dir)
    return dr.drift_table(early.select(*ORD_COLS), _all_recent(spark, sf_dir).select(*ORD_COLS))


@register("drift_level", f"SELECT feature_name, drift_level FROM ({drift_table_sql()}) AS d")
def q_drift_level(spark, sf_dir):
    early, _ = _orders(spark, sf_dir)
    t = dr.drift_table(early.select(*ORD_COLS), _all_recent(spark, sf_dir).select(*ORD_COLS))
    return t.select("feature_name", dr.drift_level(F.col("drift_score")).alias("drift_level"))


def monitoring_sql() -> str:
    rec = ALL_RECENT
    return f"""
WITH d AS ({drift_table_sql()}),
sc AS (SELECT count(*) AS recent_samples, avg(least(o_totalprice / 500000.0, 1.0)) AS mean_probability,
              avg(CAST(least(o_totalprice / 500000.0, 1.0) >= 0.5 AS DOUBLE)) AS high_risk_rate FROM {rec} AS r),
dd AS (SELECT count_if(drift_level = 'high') AS high_drift_features, count_if(drift_level = 'medium') AS medium_drift_features,
              count(*) AS nf FROM d),
x AS (SELECT (SELECT count(*) FROM {ORD_EXP} AS t) AS train_samples, sc.*, dd.*,
             high_drift_features / CAST(greatest(nf, 1) AS DOUBLE) AS high_drift_ratio FROM sc CROSS JOIN dd)
SELECT train_samples, recent_samples, mean_probability, high_risk_rate, high_drift_features, medium_drift_features,
       high_drift_ratio, high_drift_ratio >= 0.25 AS drift_trigger, coalesce(high_risk_rate >= 0.45, false) AS risk_trigger,
       high_drift_ratio >= 0.25 OR coalesce(high_risk_rate >= 0.45, false) AS retrain_recommended
FROM x
"""


@register("monitoring_report", monitoring_sql(), ["mean_probability", "high_risk_rate", "high_drift_ratio"])
def q_monitoring(spark, sf_dir):
    early, _ = _orders(spark, sf_dir)
    recent = _all_recent(spark, sf_dir)
    prob = F.least(F.col("o_totalprice") / 500000.0, F.lit(1.0))
    scored = recent.select(prob.alias("churn_probability"), (prob >= 0.5).cast("int").alias("predicted_label"))
    drift = dr.drift_table(early.select(*ORD_COLS), recent.select(*ORD_COLS))
    return dr.monitoring_report(early, scored, drift)


_DENS_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def density_sql() -> str:
    e = _unpivot_sql(LI_EXP, _DENS_COLS)
    a = _unpivot_sql(LI_ACT, _DENS_COLS)
    return f"""
WITH b AS (SELECT feature, v, 'train' AS side FROM ({e}) AS x WHERE v IS NOT NULL
           UNION ALL SELECT feature, v, 'recent' FROM ({a}) AS y WHERE v IS NOT NULL),
r AS (SELECT feature, min(v) AS lo, max(v) AS hi FROM b GROUP BY feature),
k AS (SELECT b.feature, b.side, r.lo, r.hi,
             CAST(CASE WHEN r.hi = r.lo THEN 0 ELSE least(floor((b.v - r.lo) / ((r.hi - r.lo) / 20.0)), 19) END AS INTEGER) AS bin
      FROM b JOIN r USING (feature)),
c AS (SELECT feature, bin, lo, hi, count_if(side = 'train') AS t, count_if(side = 'recent') AS rc FROM k GROUP BY feature, bin, lo, hi)
SELECT feature, bin, lo + (hi - lo) * bin / 20.0 AS bin_low,
       t / CAST(sum(t) OVER (PARTITION BY feature) AS DOUBLE) AS train_share,
       rc / CAST(sum(rc) OVER (PARTITION BY feature) AS DOUBLE) AS recent_share
FROM c
"""


@register("density_comparison", density_sql(), ["bin_low", "train_share", "recent_share"])
def q_density(spark, sf_dir):
    e, a = _li(spark, sf_dir)
    return dr.density_comparison(e.select(*_DENS_COLS), a.select(*_DENS_COLS))


def triggers_sql() -> str:
    def metrics(src: str) -> str:
        return f"""SELECT (count_if(CAST(l_returnflag = 'R' AS INTEGER) = 0 AND l_quantity / 51.0 >= 0.5) * 65.0
                          + count_if(CAST(l_returnflag = 'R' AS INTEGER) = 1 AND l_quantity / 51.0 < 0.5) * 320.0)
                          / greatest(count(*), 1) * 1000.0 AS cost_per_1000 FROM {src} AS s"""

    return f"""
WITH cur AS ({metrics(LI_ACT)}), base AS ({metrics(LI_EXP)}),
d AS (SELECT count_if(psi > 0.2) / CAST(count(*) AS DOUBLE) AS share FROM ({psi_sql(LI_EXP, LI_ACT, NUM)}) AS p)
SELECT d.share > 0.25 AS drift_flag,
       cur.cost_per_1000 >= base.cost_per_1000 * 1.2 AS cost_flag,
       CAST(NULL AS BOOLEAN) AS age_flag, CAST(NULL AS BOOLEAN) AS auuc_flag,
       CAST(NULL AS BOOLEAN) AS calibration_flag, CAST(NULL AS BOOLEAN) AS mix_flag,
       coalesce(d.share > 0.25, false) OR coalesce(cur.cost_per_1000 >= base.cost_per_1000 * 1.2, false) AS retrain
FROM cur CROSS JOIN base CROSS JOIN d
"""


@register("retrain_triggers", triggers_sql())
def q_triggers(spark, sf_dir):
    from sparkexp.operators.classification import business_cost_per_1000

    e, a = _li(spark, sf_dir)

    def scored(df):
        return df.select((F.col("l_returnflag") == "R").cast("int").alias("y"), (F.col("l_quantity") / 51.0).alias("prob"))

    cur = business_cost_per_1000(scored(a), "y", "prob", 0.5).withColumnRenamed("expected_cost_per_1000", "cost_per_1000")
    base = business_cost_per_1000(scored(e), "y", "prob", 0.5).withColumnRenamed("expected_cost_per_1000", "cost_per_1000")
    psi = dr.population_stability_index(e, a, NUM)
    share = psi.agg((F.count_if(F.col("psi") > 0.2) / F.count(F.lit(1))).alias("high_drift_share"))
    return dr.retrain_triggers(cur.crossJoin(share), base)


_KEYED_SQL = """
WITH s AS (SELECT nullif(l_linestatus || l_returnflag, 'FN') AS k, CAST(l_returnflag = 'R' AS INTEGER) AS y, l_quantity / 51.0 AS prob, l_shipdate < TIMESTAMP '1996-01-01' AS old
           FROM lineitem),
c AS (SELECT k, old, (count_if(y = 0 AND prob >= 0.5) * 65.0 + count_if(y = 1 AND prob < 0.5) * 320.0) / count(*) * 1000.0 AS cost FROM s GROUP BY k, old),
j AS (SELECT c.k, c.cost AS cur, b.cost AS base FROM c LEFT JOIN c AS b ON c.k IS NOT DISTINCT FROM b.k AND b.old WHERE NOT c.old)
SELECT k, CAST(NULL AS BOOLEAN) AS drift_flag, cur >= base * 1.2 AS cost_flag, CAST(NULL AS BOOLEAN) AS age_flag, CAST(NULL AS BOOLEAN) AS auuc_flag,
       CAST(NULL AS BOOLEAN) AS calibration_flag, CAST(NULL AS BOOLEAN) AS mix_flag, coalesce(cur >= base * 1.2, false) AS retrain FROM j
"""


@register("retrain_triggers_keyed", _KEYED_SQL)
def q_triggers_keyed(spark, sf_dir):
    """Triggers per line status and return flag, of which one is NULL and some have
    no baseline."""
    from sparkexp.operators.classification import business_cost_per_1000

    use_utc(spark)
    s = load(spark, sf_dir, "lineitem").select(
        F.expr("nullif(l_linestatus || l_returnflag, 'FN')").alias("k"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_quantity") / 51.0).alias("prob"), (F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp")).alias("old"),
    )
    cost = lambda d: business_cost_per_1000(d, "y", "prob", 0.5, ["k"]).withColumnRenamed("expected_cost_per_1000", "cost_per_1000")
    return dr.retrain_triggers(cost(s.where("not old")), cost(s.where("old")), ["k"])


_WIN_COLS = ["l_quantity", "l_extendedprice"]


def _window_psi_sql() -> str:
    train, later = "(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')", "(SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')"
    edges = ", ".join(f"quantile_cont(v, {i / 10!r})" for i in range(11))
    unpivot = " UNION ALL ".join(f"SELECT l_shipdate AS ts, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {{src}} AS t_{c}" for c in _WIN_COLS)
    return f"""
WITH e AS ({unpivot.format(src=train)}), a AS ({unpivot.format(src=later)}),
el AS (SELECT feature, list_sort(list_distinct([{edges}])) AS edges FROM e GROUP BY feature),
b AS (SELECT feature, edges, len(edges) - 1 AS nb, unnest(range(0, len(edges) - 1)) AS bin FROM el),
eb AS (SELECT feature, least(len(list_filter(edges, lambda x: x <= v)), len(edges) - 1) - 1 AS bin FROM e JOIN el USING (feature) WHERE v BETWEEN edges[1] AND edges[-1]),
ab AS (SELECT time_bucket(INTERVAL 180 DAYS, ts, TIMESTAMP '1970-01-01') AS w, feature, least(len(list_filter(edges, lambda x: x <= v)), len(edges) - 1) - 1 AS bin,
              v BETWEEN edges[1] AND edges[-1] AS inside FROM a JOIN el USING (feature)),
ec AS (SELECT feature, bin, count(*) AS c FROM eb GROUP BY ALL),
ac AS (SELECT w, feature, bin, count(*) AS c FROM ab WHERE inside GROUP BY ALL),
n AS (SELECT w, feature, count(*) AS rows FROM ab GROUP BY ALL),
m AS (SELECT n.w, n.feature, n.rows, b.nb, coalesce(ec.c, 0) AS ce, coalesce(ac.c, 0) AS ca FROM n JOIN b USING (feature)
      LEFT JOIN ec USING (feature, bin) LEFT JOIN ac ON ac.w = n.w AND ac.feature = n.feature AND ac.bin = b.bin),
s AS (SELECT *, (ce + 1e-6) / (sum(ce) OVER (PARTITION BY w, feature) + 1e-6 * nb) AS pe, (ca + 1e-6) / (sum(ca) OVER (PARTITION BY w, feature) + 1e-6 * nb) AS pa FROM m),
p AS (SELECT w AS window_start, feature, min(rows) AS rows, sum((pa - pe) * ln(pa / pe)) AS psi FROM s GROUP BY w, feature)
SELECT *, CASE WHEN psi > {dr.HIGH!r} THEN 'high' WHEN psi > {dr.MEDIUM!r} THEN 'medium' ELSE 'low' END AS drift_level FROM p
"""


@register("windowed_drift_stream", _window_psi_sql(), ["psi"])
def q_windowed_drift(spark, sf_dir):
    """Drift per 180 days of a stream of line items against those shipped before
    1998. The files are in no order of time, so the watermark allows for all of it."""
    from sparkexp.sources import io
    from sparkexp.streaming import drift as sd
    from sparkexp.streaming.scoring import read_record_stream, run_windowed

    use_utc(spark)
    # Event times of a watermark have a time zone.
    li = load(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("l_shipdate"), *_WIN_COLS)
    cut = F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp")
    ref = sd.training_histogram(li.where(cut), _WIN_COLS)
    src = io.scratch_path(spark, "drift-src")
    li.where(~cut).repartition(6).write.mode("overwrite").parquet(src)
    stream = read_record_stream(spark, src, li.schema, "parquet", max_files_per_trigger=2)
    out, ck = io.scratch_path(spark, "drift-out"), io.scratch_path(spark, "drift-ck")
    run_windowed(sd.windowed_histogram(stream, ref, "l_shipdate", _WIN_COLS, "180 days", "4000 days"), out, ck)
    return sd.latest_drift(spark, out, ref)
