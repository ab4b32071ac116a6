"""Registered profiling queries (customer with NULLs made by nullif, events,
the experiment view)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkexp.operators import profile as pr
from sparkexp.operators.sampling import stratified_split
from sparkexp.plans.registry import register
from sparkexp.plans.tables import EXPERIMENT_SQL, experiment, load, use_utc

CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _customer(spark, sf_dir):
    use_utc(spark)
    c = load(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        "c_name",
        F.expr("nullif(c_nationkey, 3)").alias("c_nationkey"),
        F.expr("CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END").alias("c_acctbal"),
        F.expr("nullif(c_mktsegment, 'BUILDING')").alias("c_mktsegment"),
    )


CUST_SQL = """SELECT c_custkey, c_name, nullif(c_nationkey, 3) AS c_nationkey,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment
  FROM customer"""

_TYPE_MAP = "CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' ELSE lower(typeof({c})) END"


def _dict_sql(by_id: bool) -> str:
    parts = []
    for c in CUST_COLS:
        order = "c_custkey" if by_id else "v"
        parts.append(f"""
SELECT '{c}' AS column, (SELECT {_TYPE_MAP.format(c=c)} FROM cst LIMIT 1) AS dtype,
       count_if({c} IS NULL) AS n_missing,
       count_if({c} IS NULL) / CAST(count(*) AS DOUBLE) * 100.0 AS missing_pct,
       count(DISTINCT CAST({c} AS VARCHAR)) AS n_unique,
       (SELECT coalesce(string_agg(v, ', ' ORDER BY k), '') FROM (
          SELECT v, row_number() OVER (ORDER BY {order}, v) AS k FROM (SELECT c_custkey, CAST({c} AS VARCHAR) AS v FROM cst) AS z
          WHERE v IS NOT NULL QUALIFY k <= 3) AS s) AS sample_values
FROM cst""")
    return "WITH cst AS (" + CUST_SQL + ")\n" + "\nUNION ALL\n".join(parts)


@register("data_dictionary", _dict_sql(True), ["missing_pct"])
def q_dictionary(spark, sf_dir):
    return pr.data_dictionary(_customer(spark, sf_dir), order_col="c_custkey")


def _nulls_sql() -> str:
    parts = [
        f"""SELECT '{c}' AS feature, (SELECT {_TYPE_MAP.format(c=c)} FROM cst LIMIT 1) AS dtype,
       count_if({c} IS NULL) AS null_count, count_if({c} IS NULL) / CAST(count(*) AS DOUBLE) AS null_pct,
       count(DISTINCT CAST({c} AS VARCHAR)) AS n_unique FROM cst"""
        for c in CUST_COLS
    ]
    return "WITH cst AS (" + CUST_SQL + ")\n" + "\nUNION ALL\n".join(parts)


@register("profile_nulls", _nulls_sql(), ["null_pct"])
def q_nulls(spark, sf_dir):
    return pr.profile_nulls(_customer(spark, sf_dir))


_DUP_SQL = """
WITH li AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem),
r AS (SELECT count(*) AS c FROM li GROUP BY ALL),
i AS (SELECT count(*) AS c FROM li GROUP BY l_orderkey, l_linenumber)
SELECT (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM r) AS duplicate_rows,
       (SELECT CAST(sum(c) AS BIGINT) FROM r) AS n_rows,
       (SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM i) AS duplicate_ids
"""


@register("duplicate_report", _DUP_SQL.replace("GROUP BY ALL", "GROUP BY l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity"))
def q_dups(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    # the id here is the (order, line) pair
    li = li.withColumn("_id", F.struct("l_orderkey", "l_linenumber"))
    rep = pr.duplicate_report(li.drop("_id"), None).drop("duplicate_ids")
    ids = pr.duplicate_report(li.select("_id"), "_id").select("duplicate_ids")
    return rep.crossJoin(ids)


@register(
    "label_balance",
    "SELECT l_returnflag, count(*) AS count, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag",
    ["share"],
)
def q_label_balance(spark, sf_dir):
    return pr.label_balance(load(spark, sf_dir, "lineitem"), "l_returnflag")


def _leak_sql() -> str:
    return f"""
WITH e AS (SELECT *, o_totalprice * 2 AS purchase_amount, c_acctbal AS time_on_page_s FROM ({EXPERIMENT_SQL}) AS x),
f AS (SELECT * FROM (VALUES
   ('unit_id', false), ('treatment', false), ('o_orderpriority', false), ('c_mktsegment', false), ('c_nationkey', false),
   ('o_totalprice', false), ('c_acctbal', false), ('o_orderdate', false), ('score', false), ('arm3', false),
   ('purchase_amount', true), ('time_on_page_s', true)) AS t("column", is_potential_leakage)),
c AS (SELECT * FROM (SELECT
   corr(CAST(unit_id AS DOUBLE), CAST(converted AS DOUBLE)) AS unit_id,
   corr(CAST(treatment AS DOUBLE), CAST(converted AS DOUBLE)) AS treatment,
   corr(CAST(c_nationkey AS DOUBLE), CAST(converted AS DOUBLE)) AS c_nationkey,
   corr(CAST(o_totalprice AS DOUBLE), CAST(converted AS DOUBLE)) AS o_totalprice,
   corr(CAST(c_acctbal AS DOUBLE), CAST(converted AS DOUBLE)) AS c_acctbal,
   corr(CAST(score AS DOUBLE), CAST(converted AS DOUBLE)) AS score,
   corr(CAST(arm3 AS DOUBLE), CAST(converted AS DOUBLE)) AS arm3,
   corr(CAST(purchase_amount AS DOUBLE), CAST(converted AS DOUBLE)) AS purchase_amount,
   corr(CAST(time_on_page_s AS DOUBLE), CAST(converted AS DOUBLE)) AS time_on_page_s FROM e) AS a
   UNPIVOT (target_corr FOR "column" IN (unit_id, treatment, c_nationkey, o_totalprice, c_acctbal, score, arm3, purchase_amount, time_on_page_s)))
SELECT f."column", f.is_potential_leakage,
       CASE WHEN f.is_potential_leakage THEN 'name_suggests_outcome' ELSE 'name_is_neutral' END AS reason,
       c.target_corr
FROM f LEFT JOIN c USING ("column")
"""


@register("leakage_report", _leak_sql(), ["target_corr"])
def q_leakage(spark, sf_dir):
    e = experiment(spark, sf_dir)
    e = e.withColumn("purchase_amount", F.col("o_totalprice") * 2).withColumn("time_on_page_s", F.col("c_acctbal"))
    return pr.leakage_report(e, "converted")


def _split_sql() -> str:
    from sparkexp.functions.hashing import seeded_uniform_sql

    h = seeded_uniform_sql(42, "unit_id")
    return f"""
WITH e AS ({EXPERIMENT_SQL}),
r AS (SELECT *, row_number() OVER (PARTITION BY treatment, converted ORDER BY {h}, unit_id) AS rk,
             count(*) OVER (PARTITION BY treatment, converted) AS c FROM e),
s AS (SELECT *, CASE WHEN rk <= round(c * 0.2) THEN 'holdout'
                     WHEN rk <= round(c * 0.2) + round((c - round(c * 0.2)) * 0.25) THEN 'valid' ELSE 'train' END AS split FROM r)
SELECT split, count(*) AS rows, avg(CAST(treatment AS DOUBLE)) AS treatment_rate, avg(CAST(converted AS DOUBLE)) AS outcome_rate
FROM s GROUP BY split
"""


def _split(spark, sf_dir):
    return stratified_split(
        experiment(spark, sf_dir), ["treatment", "converted"], "unit_id", 0.2, 0.2, 42, ("train", "valid", "holdout")
    )


@register("split_summary", _split_sql(), ["treatment_rate", "outcome_rate"])
def q_split_summary(spark, sf_dir):
    return pr.split_summary(_split(spark, sf_dir), "split", "treatment", "converted")


def _corr_sql() -> str:
    cols = ["o_totalprice", "c_acctbal", "c_nationkey", "converted"]
    sel, pairs = [], []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            k = f"c_{i}_{cols.index(b)}"
            sel.append(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS {k}")
            pairs.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {k} AS corr FROM a")
            if a != b:
                pairs.append(f"SELECT '{b}', '{a}', {k} FROM a")
    return f"WITH a AS (SELECT {', '.join(sel)} FROM ({EXPERIMENT_SQL}) AS e)\n" + "\nUNION ALL\n".join(pairs)


@register("correlation_matrix", _corr_sql(), ["corr"])
def q_corr(spark, sf_dir):
    return pr.correlation_matrix(experiment(spark, sf_dir), ["o_totalprice", "c_acctbal", "c_nationkey", "converted"])


# ---------------------------------------------------------------- row-level splits and folds

def _lineitem_labelled(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


def _row_split_sql(src: str, strata: str, id_col: str, names: tuple[str, str, str], cols: str) -> str:
    from sparkexp.functions.hashing import seeded_uniform_sql

    h = seeded_uniform_sql(42, id_col)
    return f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY {h}, {id_col}) AS rk,
                  count(*) OVER (PARTITION BY {strata}) AS c FROM ({src}) AS t)
SELECT {cols}, CASE WHEN rk <= round(c * 0.2) THEN '{names[2]}'
                    WHEN rk <= round(c * 0.2) + round((c - round(c * 0.2)) * 0.25) THEN '{names[1]}'
                    ELSE '{names[0]}' END AS split
FROM r"""


_LI_LABELLED_SQL = "SELECT l_orderkey * 8 + l_linenumber AS row_id, CAST(l_returnflag = 'R' AS INTEGER) AS label FROM lineitem"


@register(
    "stratified_split_churn",
    _row_split_sql(_LI_LABELLED_SQL, "label", "row_id", ("train", "valid", "test"), "row_id, label"),
)
def q_split_churn(spark, sf_dir):
    """Every lineitem row gets train / valid / test (0.6 / 0.2 / 0.2),
    stratified by the label, exact per-stratum counts."""
    return stratified_split(_lineitem_labelled(spark, sf_dir), ["label"], "row_id", 0.2, 0.2, 42)


@register(
    "stratified_split_uplift",
    _row_split_sql(EXPERIMENT_SQL, "treatment, converted", "unit_id", ("train", "valid", "holdout"),
                   "unit_id, treatment, converted"),
)
def q_split_uplift(spark, sf_dir):
    """Every experiment unit gets train / valid / holdout, stratified by
    treatment x outcome."""
    return _split(spark, sf_dir).select("unit_id", "treatment", "converted", "split")


def _folds_sql() -> str:
    from sparkexp.functions.hashing import seeded_uniform_sql

    h = seeded_uniform_sql(42, "unit_id")
    return f"""SELECT unit_id, converted,
  CAST((row_number() OVER (PARTITION BY converted ORDER BY {h}, unit_id) - 1) % 3 AS INTEGER) AS fold
FROM ({EXPERIMENT_SQL}) AS e"""


@register("stratified_folds", _folds_sql())
def q_folds(spark, sf_dir):
    """Shuffled 3-fold assignment stratified by outcome."""
    from sparkexp.operators.sampling import stratified_folds

    e = experiment(spark, sf_dir).select("unit_id", "converted")
    return stratified_folds(e, ["converted"], "unit_id", 3, 42)
