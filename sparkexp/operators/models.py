"""Model training jobs on ``pyspark.ml``: family registry, majority
baseline, T-learner and X-learner uplift models, Platt calibration with
cross-fitting, k-fold CV, family sweeps and their ranking, a time-budgeted
random search, the compare -> tune -> calibrate -> refit track, and seed
stability.

Each fit is a distributed Spark job; the Python loops only walk the small
space of families, folds, trials and seeds. Feature vectors are prepared
once per split and persisted, then reused by every estimator.

The sweep rankings and search summaries order result tables with one row
per model family, candidate or trial (tens of rows, independent of the data
size), so their unpartitioned ``Window.orderBy`` runs in one task by design;
data-sized orderings use ``ordering.global_rank``.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce as functools_reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkexp.operators.boosting import AdaBoost, RidgeClassifier
from sparkexp.operators.bundle import Bundle
from sparkexp.operators.classification import average_precision, brier_score, roc_auc, threshold_sweep
from sparkexp.operators.discriminant import GaussianDiscriminant
from sparkexp.operators.extra_trees import ExtraTrees
from sparkexp.operators.features import build_preprocessor, split_roles
from sparkexp.operators.histogram_boosting import HistogramBoosting
from sparkexp.operators.neighbors import NearestNeighbors
from sparkexp.operators.sampling import stratified_folds
from sparkexp.session import cut_lineage

# Discovery-model names mapped to the implementable families.
LAZY_TO_MANUAL_FAMILY = {
    "LogisticRegression": "logistic_regression",
    "RidgeClassifier": "logistic_regression",
    "LinearDiscriminantAnalysis": "logistic_regression",
    "Perceptron": "logistic_regression",
    "RandomForestClassifier": "random_forest",
    "ExtraTreesClassifier": "random_forest",
    "DecisionTreeClassifier": "random_forest",
    "BaggingClassifier": "random_forest",
    "XGBClassifier": "xgboost",
    "LGBMClassifier": "xgboost",
    "GradientBoostingClassifier": "xgboost",
    "AdaBoostClassifier": "xgboost",
}
# Families never carried forward from the uplift discovery sweep.
UPLIFT_EXCLUDED = (
    "DummyClassifier",
    "LabelPropagation",
    "LabelSpreading",
    "PassiveAggressiveClassifier",
    "Perceptron",
    "SGDClassifier",
    "NearestCentroid",
)
# Estimator settings per project. Spark grows trees to depth 30 at
# most, which stands for "no limit".
UNLIMITED_DEPTH = 30
SETTINGS = {
    "churn": {
        "logistic": {"maxIter": 2000},
        "forest": {"numTrees": 400, "maxDepth": UNLIMITED_DEPTH, "minInstancesPerNode": 2},
        "extra_trees": {"numTrees": 400, "maxDepth": UNLIMITED_DEPTH, "minInstancesPerNode": 2},
        "boosting": {"maxIter": 450, "maxDepth": 4, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.85"},
        "light_boosting": {"maxIter": 450, "stepSize": 0.05},
        "plain_boosting": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1},
        "balanced": ("logistic", "forest", "extra_trees"),
    },
    "uplift": {
        "logistic": {"maxIter": 2500},
        "forest": {"numTrees": 300, "maxDepth": UNLIMITED_DEPTH, "minInstancesPerNode": 5},
        "extra_trees": {"numTrees": 350, "maxDepth": UNLIMITED_DEPTH, "minInstancesPerNode": 3},
        "boosting": {"maxIter": 300, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"},
        "light_boosting": {"maxIter": 350, "stepSize": 0.05},
        "plain_boosting": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.1},
        "balanced": (),
    },
}
# What one distributed fit may cost. A tree level is a job over all rows and a level
# of a deep forest a model of millions of nodes, so the counts and depths above are
# used up to these limits; fewer boosting rounds take proportionally larger steps.
LIMITS = {"numTrees": 100, "maxDepth": 10, "rounds": 50, "second_order_rounds": 25, "stepSize": 0.3}
#: Rows up to which one task grows all trees of second-order boosting.
OWN_ROWS = 300_000
#: Names of ``SETTINGS`` and of search grids in this library's boosting.
BOOSTING_NAMES = {"maxIter": "rounds", "stepSize": "rate", "maxDepth": "max_depth", "subsamplingRate": "rows_share"}
FAMILY_GROUPS = {
    "logistic": ("logisticregression", "lr", "perceptron"),
    "forest": ("randomforest", "randomforestclassifier", "rf", "baggingclassifier"),
    "extra_trees": ("extratrees", "extratreesclassifier", "et"),
    "boosting": ("xgboost", "xgb", "xgbclassifier", "gbt"),
    "light_boosting": ("lightgbm", "lgbm", "lgbmclassifier"),
    "plain_boosting": ("gradientboosting", "gradientboostingclassifier"),
}


def family_group(family: str) -> str | None:
    n = family.lower().replace(" ", "").replace("_", "")
    return next((g for g, names in FAMILY_GROUPS.items() if n in names), None)


def wants_balanced_weights(family: str, project: str) -> bool:
    return family_group(family) in SETTINGS[project]["balanced"]


def at_once(jobs: Sequence[Callable[[], Any]], threads: int = 4) -> list[Any]:
    """Results of independent jobs, run from ``threads`` threads of the driver, so that
    Spark fills free executors with the next fit's tasks. The first error is raised."""
    with ThreadPool(max(1, min(threads, len(jobs)))) as pool:
        return pool.map(lambda job: inheritable_thread_target(SparkSession.active())(job)(), jobs, chunksize=1)


# ---------------------------------------------------------------- registry

def fit_settings(project: str, group: str, full: bool = False) -> dict[str, Any]:
    """Estimator settings of a family group: the project's, within ``LIMITS``
    unless ``full``."""
    own = dict(SETTINGS[project][group])
    if full or group == "logistic":
        return own
    for name in ("numTrees", "maxDepth"):
        if name in own:
            own[name] = min(own[name], LIMITS[name])
    rounds = LIMITS["second_order_rounds" if group in ("boosting", "light_boosting") else "rounds"]
    if "maxIter" in own and own["maxIter"] > rounds:
        own["stepSize"] = min(LIMITS["stepSize"], own["stepSize"] * own["maxIter"] / rounds)
        own["maxIter"] = rounds
    return own


def make_classifier(
    family: str,
    seed: int = 42,
    features_col: str = "features",
    label_col: str = "label",
    weight_col: str | None = None,
    strict: bool = False,
    project: str = "uplift",
    full: bool = False,
    **overrides: Any,
) -> Estimator:
    """Family name -> estimator with the project's fixed settings (``SETTINGS``)
    within ``LIMITS`` (``full``: without); ``overrides`` replace single parameters.

    Unknown names fall back to logistic regression, or raise when ``strict``.
    GradientBoosting maps to GBT; forests and bagging to random forest; Gaussian NB to
    NaiveBayes (gaussian). Discriminant analysis, nearest neighbours, extra trees,
    AdaBoost, the ridge classifier and second-order boosting (XGBoost level by level,
    LightGBM leaf by leaf), which ``pyspark.ml`` lacks, are this library's own.
    """
    n = family.lower().replace(" ", "").replace("_", "")
    common = {"featuresCol": features_col, "labelCol": label_col}
    group = family_group(family)
    own = {"features_col": features_col, "label_col": label_col}
    made = None
    if n in ("kneighborsclassifier", "kneighbors", "knn"):
        made = NearestNeighbors(k=25, seed=seed, **own)
    elif n in ("adaboost", "adaboostclassifier"):
        made = AdaBoost(rounds=50, **own)
    elif n in ("ridgeclassifier", "ridge"):
        made = RidgeClassifier(alpha=1.0, **own)
    elif n in ("lineardiscriminantanalysis", "lda"):
        made = GaussianDiscriminant("linear", **own)
    elif n in ("quadraticdiscriminantanalysis", "qda"):
        made = GaussianDiscriminant("quadratic", reg_param=0.1, **own)
    elif group == "extra_trees":
        f = fit_settings(project, group, full)
        made = ExtraTrees(f["numTrees"], f["maxDepth"], f["minInstancesPerNode"], balanced=bool(weight_col), seed=seed, **own)
    elif group in ("boosting", "light_boosting"):
        f = fit_settings(project, group, full)
        steps = {"rounds": f["maxIter"], "rate": f["stepSize"], "seed": seed, "own_rows": OWN_ROWS, **own}
        if group == "boosting":
            shares = {"rows_share": f["subsamplingRate"], "features_share": float(f["featureSubsetStrategy"])}
            made = HistogramBoosting(max_leaves=0, max_depth=f["maxDepth"], l2=1.0, min_hessian=1.0, min_rows=1, **shares, **steps)
        else:
            made = HistogramBoosting(max_leaves=31, max_depth=0 if full else LIMITS["maxDepth"], **steps)
        overrides = {BOOSTING_NAMES.get(k, k): v for k, v in overrides.items()}
    if made is not None:
        return replace(made, **overrides)
    fixed = {} if group is None else fit_settings(project, group, full)
    trees = {"cacheNodeIds": True, "checkpointInterval": 10, "seed": seed}
    if group == "logistic":
        est = LogisticRegression(**fixed, **common)
    elif group == "forest":
        est = RandomForestClassifier(**fixed, **trees, **common)
    elif group == "plain_boosting":
        est = GBTClassifier(**fixed, **trees, **common)
    elif n in ("decisiontree", "decisiontreeclassifier"):
        est = DecisionTreeClassifier(maxDepth=7, minInstancesPerNode=8, seed=seed, **common)
    elif n == "linearsvc":
        est = LinearSVC(maxIter=100, regParam=0.01, **common)
    elif n in ("gaussiannb", "naivebayes"):
        est = NaiveBayes(modelType="gaussian", **common)
    elif strict:
        raise ValueError(f"no settings for the family {family!r}")
    else:
        est = LogisticRegression(**fit_settings(project, "logistic"), **common)
    if weight_col and group is not None:
        est.setWeightCol(weight_col)
    if overrides:
        est = est.copy({est.getParam(k): v for k, v in overrides.items()})
    return est


def positive_score(df: DataFrame, out_col: str = "score", clip_decision: float | None = 20.0) -> DataFrame:
    """P(y=1) from a model output: probability vector, else the sigmoid of
    the decision value (clipped), else the hard prediction clipped to [0,1]."""
    if "probability" in df.columns:
        s = vector_to_array(F.col("probability")).getItem(1)
    elif "rawPrediction" in df.columns:
        z = vector_to_array(F.col("rawPrediction")).getItem(1)
        if clip_decision is not None:
            z = F.greatest(F.least(z, F.lit(clip_decision)), F.lit(-clip_decision))
        s = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    else:
        s = F.greatest(F.least(F.col("prediction").cast("double"), F.lit(1.0)), F.lit(0.0))
    return df.withColumn(out_col, s)


def _only(df: DataFrame, *cols: str) -> DataFrame:
    """Those of ``cols`` that ``df`` has: all that a copy of it need hold."""
    return df.select(*[c for c in dict.fromkeys(cols) if c in df.columns])


def _read_by(estimator: Estimator, df: DataFrame, *cols: str) -> DataFrame:
    """The columns of ``df`` that fitting and scoring ``estimator`` reads, and ``cols``;
    all where it does not name its own."""
    if hasattr(estimator, "features_col"):
        return _only(df, estimator.features_col, estimator.label_col, *cols)
    if not estimator.hasParam("featuresCol"):
        return df
    names = [n for n in ("featuresCol", "labelCol", "weightCol", "validationIndicatorCol") if estimator.hasParam(n) and estimator.isDefined(n)]
    return _only(df, *[estimator.getOrDefault(n) for n in names], *cols)


def _drop_model_cols(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in ("probability", "rawPrediction", "prediction") if c in df.columns])


def score_with(model: Transformer, df: DataFrame, out_col: str) -> DataFrame:
    return _drop_model_cols(positive_score(model.transform(df), out_col))


def balanced_weights(df: DataFrame, label_col: str, weight_col: str = "_w") -> DataFrame:
    """class_weight='balanced': w = n / (2 * n_class), via a 2-row broadcast."""
    cnt = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    tot = cnt.agg(F.sum("_nc").alias("_n"))
    w = cnt.crossJoin(tot).select(label_col, (F.col("_n") / (F.lit(2.0) * F.col("_nc"))).alias(weight_col))
    return df.join(F.broadcast(w), label_col, "left")


# ---------------------------------------------------------------- baseline

def baseline_majority(train: DataFrame, df: DataFrame, label_col: str, out_col: str = "score") -> DataFrame:
    """Most-frequent-class baseline: constant P(y=1) = 1 if 1 is the
    majority (ties: smaller label), else 0."""
    maj = train.groupBy(label_col).count().orderBy(F.col("count").desc(), F.col(label_col).asc()).limit(1)
    m = maj.select((F.col(label_col).cast("int") == 1).cast("double").alias(out_col))
    return df.crossJoin(F.broadcast(m))


# ---------------------------------------------------------------- calibration and CV

@dataclass
class CalibratedModel(Bundle):
    """Average of k (base model, Platt sigmoid) pairs fitted by cross-fitting."""

    bases: list[Transformer]
    sigmoids: list[tuple[float, float]]

    def transform_score(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        out = df
        parts: list[Column] = []
        for i, (m, (a, b)) in enumerate(zip(self.bases, self.sigmoids)):
            out = calibration_score(m, out, f"_raw{i}")
            parts.append(F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * F.col(f"_raw{i}") + F.lit(b)))))
        avg = parts[0]
        for p in parts[1:]:
            avg = avg + p
        return out.withColumn(out_col, avg / F.lit(float(len(parts)))).drop(*[f"_raw{i}" for i in range(len(parts))])


def _fit_sigmoid(scored: DataFrame, score_col: str, label_col: str) -> tuple[float, float]:
    from pyspark.ml.feature import VectorAssembler

    va = VectorAssembler(inputCols=[score_col], outputCol="_sv")
    lr = LogisticRegression(featuresCol="_sv", labelCol=label_col, maxIter=100, regParam=0.0)
    m = lr.fit(va.transform(scored.select(score_col, F.col(label_col).cast("double").alias(label_col))))
    return float(m.coefficients[0]), float(m.intercept)


#: Models whose raw prediction is a decision value (a margin or log-odds).
DECISION_MODELS = ("LogisticRegressionModel", "GBTClassificationModel", "LinearSVCModel", "RidgeModel")


def calibration_score(model: Transformer, df: DataFrame, out_col: str) -> DataFrame:
    """What a sigmoid is fitted to: the decision value where the model has one,
    else its probability."""
    if type(model).__name__ not in DECISION_MODELS:
        return score_with(model, df, out_col)
    x = model.transform(df).withColumn(out_col, vector_to_array(F.col("rawPrediction")).getItem(1))
    return _drop_model_cols(x)


def platt_calibrate(
    prepared: DataFrame, estimator: Estimator, label_col: str, id_col: str, k: int = 3, seed: int = 42, refit: bool = False
) -> CalibratedModel:
    """Sigmoid calibration with k-fold cross-fitting: per fold, fit the base
    model on the other folds and a Platt sigmoid on this fold's scores. With
    ``refit`` one sigmoid is fitted on the scores of all folds, each by a model that
    has not seen it, and joined to one base model fitted on all rows. What a fit of
    trees keeps grows with rows times trees, so those folds are fitted one after the
    other, and walk their trees anew in place of keeping each row's nodes."""
    threads = 4
    if isinstance(estimator, RandomForestClassifier):
        estimator, threads = estimator.copy({estimator.cacheNodeIds: False}), 1
    folded = stratified_folds(_read_by(estimator, prepared, label_col, id_col), [label_col], id_col, k, seed).persist(StorageLevel.MEMORY_AND_DISK)

    def pair(f: int) -> tuple[Transformer, tuple[float, float]]:
        m = (estimator.copy() if f else estimator).fit(folded.where(F.col("fold") != f))
        return m, _fit_sigmoid(calibration_score(m, folded.where(F.col("fold") == f), "_s"), "_s", label_col)

    def held_scores(f: int) -> DataFrame:
        m = (estimator.copy() if f else estimator).fit(folded.where(F.col("fold") != f))
        held = calibration_score(m, folded.where(F.col("fold") == f), "_s")
        return cut_lineage(held.select("_s", F.col(label_col).cast("double").alias(label_col)))

    if refit:
        held = at_once([lambda f=f: held_scores(f) for f in range(k)], threads)
        sigmoid = _fit_sigmoid(functools_reduce(DataFrame.unionByName, held), "_s", label_col)
        folded.unpersist()
        return CalibratedModel([estimator.copy().fit(prepared)], [sigmoid])
    pairs = at_once([lambda f=f: pair(f) for f in range(k)], threads)
    folded.unpersist()
    bases, sigs = [m for m, _ in pairs], [s for _, s in pairs]
    return CalibratedModel(bases, sigs)


def cross_validate(
    prepared: DataFrame, estimator: Estimator, label_col: str, id_col: str, k: int = 3, seed: int = 42
) -> DataFrame:
    """Stratified k-fold average precision per fold, plus mean and population
    std as a one-row summary (``fold`` = -1)."""
    spark = prepared.sparkSession
    folded = stratified_folds(_read_by(estimator, prepared, label_col, id_col), [label_col], id_col, k, seed).persist(StorageLevel.MEMORY_AND_DISK)
    rows = []
    for f in range(k):
        m = estimator.fit(folded.where(F.col("fold") != f))
        held = score_with(m, folded.where(F.col("fold") == f), "_s")
        ap = average_precision(held, label_col, "_s").collect()[0][0]  # one row
        rows.append((f, float(ap) if ap is not None else None))
    folded.unpersist()
    df = spark.createDataFrame(rows, "fold int, average_precision double")
    summ = df.agg(
        F.lit(-1).alias("fold"), F.avg("average_precision").alias("cv_metric_mean"), F.stddev_pop("average_precision").alias("cv_metric_std")
    )
    return df.withColumn("cv_metric_mean", F.lit(None).cast("double")).withColumn(
        "cv_metric_std", F.lit(None).cast("double")
    ).unionByName(summ.withColumn("average_precision", F.lit(None).cast("double")))


# ---------------------------------------------------------------- uplift learners

@dataclass
class TLearner(Bundle):
    """One response model per arm on a shared, fitted preprocessor;
    uplift = P(y=1 | treated model) - P(y=1 | control model)."""

    preprocessor: PipelineModel
    model_treatment: Any
    model_control: Any
    model_name: str = "t_learner"
    library_source: str = "spark"
    interpretability_note: str = ""

    def _score(self, model: Any, df: DataFrame, out: str) -> DataFrame:
        if isinstance(model, CalibratedModel):
            return model.transform_score(df, out)
        return score_with(model, df, out)

    def transform(self, df: DataFrame, keep_features: bool = False) -> DataFrame:
        x = self.preprocessor.transform(df)
        x = self._score(self.model_treatment, x, "p_treated")
        x = self._score(self.model_control, x, "p_control")
        x = x.withColumn("uplift", F.col("p_treated") - F.col("p_control"))
        if not keep_features:
            x = x.select(*df.columns, "p_treated", "p_control", "uplift")
        return x


def t_learner_rows(train: DataFrame, preprocessor: PipelineModel, treatment_col: str, outcome_col: str, id_col: str) -> DataFrame:
    """What both arms' models are fitted to, kept until it is unpersisted."""
    return _prepared(train, outcome_col, preprocessor, treatment_col, id_col)


def fit_t_learner(
    train: DataFrame,
    feature_cols: Sequence[str],
    family: str,
    treatment_col: str = "treatment",
    outcome_col: str = "converted",
    id_col: str = "user_id",
    seed: int = 42,
    calibrate: bool = False,
    preprocessor: PipelineModel | None = None,
    prepared: DataFrame | None = None,
) -> TLearner:
    """``prepared``: the rows of ``train`` as ``preprocessor`` makes them (``t_learner_rows``),
    kept by a caller that fits several families to them."""
    num, cat = split_roles(train, feature_cols)
    pre = preprocessor or build_preprocessor(train, num, cat)
    x = t_learner_rows(train, pre, treatment_col, outcome_col, id_col) if prepared is None else prepared
    models = []
    for arm, s in ((1, seed), (0, seed + 1)):
        part = x.where(F.col(treatment_col) == arm)
        est = make_classifier(family, s)
        if calibrate and family.lower().replace(" ", "") not in ("linearsvc",):
            models.append(platt_calibrate(part, est, "label", id_col, 3, s))
        else:
            models.append(est.fit(part))
    if prepared is None:
        x.unpersist()
    note = (
        "two response models, each calibrated; targeting share tuned afterwards"
        if calibrate
        else "two response models, scores not calibrated"
    )
    return TLearner(pre, models[0], models[1], model_name=f"{family} T-Learner", interpretability_note=note)


def x_learner_combine(e_x: Column, tau_control: Column, tau_treated: Column) -> Column:
    """X-learner blend: e(x) * tau_c(x) + (1 - e(x)) * tau_t(x)."""
    return e_x * tau_control + (F.lit(1.0) - e_x) * tau_treated


@dataclass
class XLearner(Bundle):
    preprocessor: PipelineModel
    mu_treated: Any
    mu_control: Any
    tau_treated: Any
    tau_control: Any
    propensity: Any

    def transform(self, df: DataFrame) -> DataFrame:
        x = self.preprocessor.transform(df)
        x = _drop_model_cols(self.tau_treated.transform(x).withColumnRenamed("prediction", "tau_t"))
        x = _drop_model_cols(self.tau_control.transform(x).withColumnRenamed("prediction", "tau_c"))
        x = score_with(self.propensity, x, "e_x")
        x = x.withColumn("uplift", x_learner_combine(F.col("e_x"), F.col("tau_c"), F.col("tau_t")))
        return x.select(*df.columns, "e_x", "tau_t", "tau_c", "uplift")


def fit_x_learner(
    train: DataFrame,
    feature_cols: Sequence[str],
    treatment_col: str = "treatment",
    outcome_col: str = "converted",
    seed: int = 42,
    family: str = "xgboost",
    effect: Mapping[str, Any] | None = None,
) -> XLearner:
    """Kuenzel et al. (2019): arm response models, imputed effects regressed
    per arm (GBT regressors, settings ``effect``), propensity model, blended by e(x).
    The response models take the project's settings whole, beyond ``LIMITS``.
    The two response models, and then the two effect models and the propensity, are
    independent and fitted at the same time."""
    num, cat = split_roles(train, feature_cols)
    pre = build_preprocessor(train, num, cat)
    x = pre.transform(train).withColumn("label", F.col(outcome_col).cast("double"))
    x = _only(x, "features", "label", treatment_col).persist(StorageLevel.MEMORY_AND_DISK)
    t, c = x.where(F.col(treatment_col) == 1), x.where(F.col(treatment_col) == 0)
    mu1, mu0 = at_once([lambda: make_classifier(family, seed, full=True).fit(t), lambda: make_classifier(family, seed + 1, full=True).fit(c)])
    # Written, as the regressors read their rows several times and all trees score them.
    d1 = cut_lineage(score_with(mu0, t, "_mu0").select("features", (F.col("label") - F.col("_mu0")).alias("d")))
    d0 = cut_lineage(score_with(mu1, c, "_mu1").select("features", (F.col("_mu1") - F.col("label")).alias("d")))
    settings = {"maxIter": 30, "maxDepth": 4, "seed": seed, "cacheNodeIds": True, **(effect or {})}
    reg = GBTRegressor(featuresCol="features", labelCol="d", **settings)
    prop = LogisticRegression(maxIter=100, featuresCol="features", labelCol="_t")
    tau1, tau0, prop = at_once([
        lambda: reg.fit(d1), lambda: reg.copy().fit(d0), lambda: prop.fit(x.withColumn("_t", F.col(treatment_col).cast("double"))),
    ])
    x.unpersist()
    return XLearner(pre, mu1, mu0, tau1, tau0, prop)


# ---------------------------------------------------------------- sweeps

def sweep_families(
    train: DataFrame,
    valid: DataFrame,
    label_col: str,
    families: Sequence[str],
    preprocessor: PipelineModel,
    seed: int = 42,
    project: str = "churn",
    parallelism: int = 1,
) -> DataFrame:
    """Fit every family, with the project's settings whole, beyond ``LIMITS``, on the
    prepared train split and measure it on valid:
    ROC AUC, balanced accuracy and F1 at 0.5, fit seconds. One row per family, in the
    order given; ``parallelism`` of them are fitted at a time. A family that cannot be
    fitted to these rows is recorded with its error."""
    xt, xv = _prepared(train, label_col, preprocessor), _prepared(valid, label_col, preprocessor)
    try:
        return _sweep(xt, xv, families, seed, project, parallelism)
    finally:
        xt.unpersist()
        xv.unpersist()


def _prepared(df: DataFrame, label_col: str, preprocessor: PipelineModel, *cols: str) -> DataFrame:
    """Features, label and ``cols``, kept for all fits and scores that read them."""
    x = preprocessor.transform(df).withColumn("label", F.col(label_col).cast("double"))
    return _only(x, "features", "label", *cols).persist(StorageLevel.MEMORY_AND_DISK)


def _sweep(xt: DataFrame, xv: DataFrame, families: Sequence[str], seed: int, project: str, parallelism: int = 1) -> DataFrame:
    spark = xt.sparkSession

    def measured(fam: str) -> tuple:
        t0 = time.perf_counter()
        try:
            weighted = wants_balanced_weights(fam, project)
            m = make_classifier(fam, seed, weight_col="_w" if weighted else None, project=project, full=True).fit(
                balanced_weights(xt, "label") if weighted else xt
            )
            sc = cut_lineage(score_with(m, xv, "_s").select("label", "_s"))  # read twice
            y, pred = F.col("label"), (F.col("_s") >= 0.5).cast("double")
            r = sc.agg(
                F.count_if((y == 1) & (pred == 1)).alias("tp"), F.count_if((y == 0) & (pred == 1)).alias("fp"),
                F.count_if((y == 1) & (pred == 0)).alias("fn"), F.count_if((y == 0) & (pred == 0)).alias("tn"),
            ).collect()[0]  # one row
            auc = roc_auc(sc, "label", "_s").collect()[0][0]  # one row
            tpr = r.tp / (r.tp + r.fn) if (r.tp + r.fn) else None
            tnr = r.tn / (r.tn + r.fp) if (r.tn + r.fp) else None
            ba = (tpr + tnr) / 2 if tpr is not None and tnr is not None else (tpr if tpr is not None else tnr)
            f1 = 2 * r.tp / (2 * r.tp + r.fp + r.fn) if (2 * r.tp + r.fp + r.fn) else 0.0
            return (fam, auc, ba, f1, time.perf_counter() - t0, "ok")
        except Exception as e:  # noqa: BLE001 - a failed family is recorded, not raised
            return (fam, None, None, None, time.perf_counter() - t0, f"failed: {type(e).__name__}: {str(e)[:200]}")

    rows = at_once([lambda f=f: measured(f) for f in families], parallelism)
    return spark.createDataFrame(
        rows, "model_name string, roc_auc double, balanced_accuracy double, f1 double, time_taken double, status string"
    )


def sweep_families_by_arm(
    train: DataFrame,
    valid: DataFrame,
    feature_cols: Sequence[str],
    families: Sequence[str],
    treatment_col: str = "treatment",
    outcome_col: str = "converted",
    seed: int = 42,
    parallelism: int = 2,
    top_n: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """Discovery for uplift: every family fitted to each arm on its own, on one
    preprocessor, both arms at the same time, and ranked by what both arms show
    (``rank_sweep_uplift``). Returns (ranking, the arms' tables)."""
    pre = build_preprocessor(train, *split_roles(train, feature_cols))

    def arm(value: int) -> DataFrame:
        part = lambda d: d.where(F.col(treatment_col) == value)
        return sweep_families(part(train), part(valid), outcome_col, families, pre, seed + value, "uplift", parallelism)

    treated, control = at_once([lambda: arm(1), lambda: arm(0)])
    ok = lambda t: t.where("status = 'ok'").withColumnRenamed("model_name", "model_family")
    both = treated.select(F.lit("treatment").alias("arm"), "*").unionByName(control.select(F.lit("control").alias("arm"), "*"))
    return rank_sweep_uplift(ok(treated), ok(control), top_n), both


def rank_sweep_churn(
    table: DataFrame, top_n: int = 3, min_auc: float = 0.60, min_bal_acc: float = 0.55
) -> DataFrame:
    """Discovery ranking: map names to families (broadcast lookup), rank by
    (ROC AUC, balanced accuracy) desc, take the best row of each eligible
    family, then fallback families, then placeholders, up to ``top_n``."""
    spark = table.sparkSession
    fam = spark.createDataFrame(list(LAZY_TO_MANUAL_FAMILY.items()), "model_name string, manual_family string")
    t = table.join(F.broadcast(fam), "model_name", "left")
    elig = t["manual_family"].isNotNull() & (F.coalesce("roc_auc", F.lit(float("-inf"))) >= min_auc) & (
        F.coalesce("balanced_accuracy", F.lit(float("-inf"))) >= min_bal_acc
    )
    t = t.withColumn("eligible_for_manual", elig)
    order = [F.col("roc_auc").desc_nulls_last(), F.col("balanced_accuracy").desc_nulls_last(), F.col("model_name").asc()]
    t = t.withColumn("_pos", F.row_number().over(Window.orderBy(*order)))
    # tier 0: eligible (first per family); tier 1: mapped fallback (first per family)
    t = t.where(F.col("manual_family").isNotNull()).withColumn(
        "_tier", F.when(F.col("eligible_for_manual"), F.lit(0)).otherwise(F.lit(1))
    )
    first = t.withColumn("_fr", F.row_number().over(Window.partitionBy("manual_family", "_tier").orderBy("_pos"))).where("_fr = 1")
    # a family selected in tier 0 is not repeated in tier 1
    best_tier = first.withColumn("_bt", F.min("_tier").over(Window.partitionBy("manual_family"))).where(F.col("_tier") == F.col("_bt"))
    placeholders = spark.createDataFrame(
        [(f, i) for i, f in enumerate(("logistic_regression", "random_forest", "xgboost"))], "manual_family string, _ph int"
    )
    chosen = best_tier.select(
        F.col("model_name").alias("swept_model_name"), "manual_family", "_tier", "_pos",
        F.col("roc_auc").alias("swept_roc_auc"), F.col("balanced_accuracy").alias("swept_balanced_accuracy"),
    )
    ph = placeholders.join(chosen.select("manual_family"), "manual_family", "left_anti").select(
        F.lit("fallback_placeholder").alias("swept_model_name"), "manual_family", F.lit(2).alias("_tier"),
        F.col("_ph").cast("int").alias("_pos"), F.lit(None).cast("double").alias("swept_roc_auc"),
        F.lit(None).cast("double").alias("swept_balanced_accuracy"),
    )
    allc = chosen.unionByName(ph)
    w = Window.orderBy("_tier", "_pos")
    reason = (
        F.when(F.col("_tier") == 0, F.lit("passes_quality_floor"))
        .when(F.col("_tier") == 1, F.lit("below_floor_fills_track"))
        .otherwise(F.lit("family_not_in_sweep"))
    )
    return (
        allc.withColumn("track_rank", F.row_number().over(w).cast("int"))
        .where(F.col("track_rank") <= top_n)
        .select("track_rank", "swept_model_name", "manual_family", reason.alias("eligibility_reason"), "swept_roc_auc", "swept_balanced_accuracy")
    )


def rank_sweep_uplift(
    table_t: DataFrame, table_c: DataFrame, top_n: int = 3, cutoff_quantile: float = 0.40
) -> DataFrame:
    """Per-arm discovery tables joined on family; mean balanced accuracy /
    AUC / time of the arms; excluded families dropped; cutoff at the 40th
    percentile of mean balanced accuracy; sorted; top ``top_n`` then filled
    from all joined families by balanced accuracy."""
    spark = table_t.sparkSession
    a = table_t.select("model_family", *[F.col(c).alias(f"{c}_treat") for c in ("balanced_accuracy", "roc_auc", "time_taken")])
    b = table_c.select("model_family", *[F.col(c).alias(f"{c}_ctrl") for c in ("balanced_accuracy", "roc_auc", "time_taken")])
    m = a.join(b, "model_family", "inner")

    def mean2(x: str, y: str) -> Column:
        cx, cy = F.col(x), F.col(y)
        return F.when(cx.isNull(), cy).when(cy.isNull(), cx).otherwise((cx + cy) / 2)

    m = m.select(
        "model_family",
        mean2("balanced_accuracy_treat", "balanced_accuracy_ctrl").alias("balanced_accuracy_mean"),
        mean2("roc_auc_treat", "roc_auc_ctrl").alias("roc_auc_mean"),
        mean2("time_taken_treat", "time_taken_ctrl").alias("time_taken_mean"),
    )
    excl = spark.createDataFrame([(x,) for x in UPLIFT_EXCLUDED], "model_family string")
    elig = m.join(F.broadcast(excl), "model_family", "left_anti")
    cut = elig.agg(F.percentile("balanced_accuracy_mean", cutoff_quantile).alias("_cut"))
    elig = elig.crossJoin(cut).where(F.col("balanced_accuracy_mean") >= F.col("_cut")).drop("_cut")
    order = [F.col("balanced_accuracy_mean").desc_nulls_last(), F.col("roc_auc_mean").desc_nulls_last(),
             F.col("time_taken_mean").asc_nulls_last(), F.col("model_family").asc()]
    ranked = elig.withColumn("_pos", F.row_number().over(Window.orderBy(*order))).withColumn("_tier", F.lit(0))
    fill = m.join(ranked.select("model_family"), "model_family", "left_anti")
    fill = fill.withColumn(
        "_pos", F.row_number().over(Window.orderBy(F.col("balanced_accuracy_mean").desc_nulls_last(), F.col("model_family").asc()))
    ).withColumn("_tier", F.lit(1))
    allr = ranked.unionByName(fill)
    out = allr.withColumn("selection_rank", F.row_number().over(Window.orderBy("_tier", "_pos")).cast("int"))
    return out.select(
        "selection_rank",
        "model_family",
        "balanced_accuracy_mean",
        "roc_auc_mean",
        "time_taken_mean",
        (F.col("selection_rank") <= top_n).alias("is_top"),
        (F.col("_tier") == 1).alias("is_fallback"),
    )


def numeric_coerce_metrics(table: DataFrame, key_col: str, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Normalise a metrics table: for each canonical metric, the first
    available alias column, coerced to double (bad text -> NULL)."""
    cols = [F.col(key_col)]
    lower = {c.lower().replace(" ", "_"): c for c in table.columns}
    for canon, names in aliases.items():
        src = next((lower[n.lower().replace(" ", "_")] for n in names if n.lower().replace(" ", "_") in lower), None)
        cols.append((F.col(f"`{src}`").cast("string").try_cast("double") if src else F.lit(None).cast("double")).alias(canon))
    return table.select(*cols)


# ---------------------------------------------------------------- budgeted search

# Search spaces per family (sampled uniformly, seeded).
SEARCH_SPACE = {
    "logistic_regression": {"regParam": [0.0, 0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]},
    "random_forest": {"numTrees": [100, 200, 400], "maxDepth": [6, 10, 20, UNLIMITED_DEPTH], "minInstancesPerNode": [1, 2, 5]},
    "xgboost": {"maxIter": [100, 300, 450], "maxDepth": [3, 4, 5], "stepSize": [0.03, 0.05, 0.1]},
}


def log_loss_col(label: Column, p: Column, eps: float = 1e-15) -> Column:
    q = F.greatest(F.least(p, F.lit(1 - eps)), F.lit(eps))
    return -(label * F.log(q) + (F.lit(1.0) - label) * F.log(F.lit(1.0) - q))


def budgeted_search(
    train: DataFrame,
    valid: DataFrame,
    label_col: str,
    preprocessor: PipelineModel,
    families: Sequence[str] = ("logistic_regression", "random_forest", "xgboost"),
    budget_sec: float = 40.0,
    seed: int = 42,
    metric: str = "log_loss",
    threshold: float = 0.5,
    configs: Sequence[tuple[str, Mapping[str, Any]]] | None = None,
    project: str = "churn",
) -> DataFrame:
    """Seeded random search over ``SEARCH_SPACE`` until the time budget is
    spent (checked between fits; one trial per family at least). ``configs``, a
    list of (family, settings), is tried instead, whole and whatever the clock
    says, so that its result can be repeated. Each trial is scored on valid by
    log loss or business cost at ``threshold``. Returns the trial table (config
    as JSON) with ``is_best`` per family and ``is_best_overall``."""
    xt, xv = _prepared(train, label_col, preprocessor), _prepared(valid, label_col, preprocessor)
    try:
        return _search(xt, xv, families, budget_sec, seed, metric, threshold, configs, project)
    finally:
        xt.unpersist()
        xv.unpersist()


def _search(
    xt: DataFrame,
    xv: DataFrame,
    families: Sequence[str],
    budget_sec: float,
    seed: int,
    metric: str = "log_loss",
    threshold: float = 0.5,
    configs: Sequence[tuple[str, Mapping[str, Any]]] | None = None,
    project: str = "churn",
    full: bool = False,
) -> DataFrame:
    spark = xt.sparkSession
    rng = random.Random(seed)
    deadline = time.perf_counter() + budget_sec
    rows = []
    trial = 0
    while trial < len(configs) if configs is not None else trial < len(families) or time.perf_counter() < deadline:
        if configs is not None:
            fam, cfg = configs[trial][0], dict(configs[trial][1])
        else:
            fam = families[trial % len(families)]
            cfg = {k: rng.choice(v) for k, v in SEARCH_SPACE.get(fam, {}).items()}
        t0 = time.perf_counter()
        m = make_classifier(fam, seed, project=project, full=full, **cfg).fit(xt)
        sc = score_with(m, xv, "_s")
        if metric == "log_loss":
            loss = sc.agg(F.avg(log_loss_col(F.col("label"), F.col("_s")))).collect()[0][0]  # one row
        else:
            pred = (F.col("_s") >= threshold).cast("int")
            r = sc.agg(
                F.count_if((F.col("label") == 0) & (pred == 1)).alias("fp"),
                F.count_if((F.col("label") == 1) & (pred == 0)).alias("fn"), F.count(F.lit(1)).alias("n"),
            ).collect()[0]  # one row
            loss = (r.fp * 65.0 + r.fn * 320.0) / max(r.n, 1) * 1000.0
        rows.append((trial, fam, json.dumps(cfg, sort_keys=True), float(loss), time.perf_counter() - t0))
        trial += 1
    df = spark.createDataFrame(rows, "trial int, family string, config string, loss double, fit_seconds double")
    wf = Window.partitionBy("family").orderBy("loss", "trial")
    wa = Window.orderBy("loss", "trial")
    return df.withColumn("is_best", F.row_number().over(wf) == 1).withColumn("is_best_overall", F.row_number().over(wa) == 1)


# ---------------------------------------------------------------- orchestrated track

@dataclass
class FinalModel(Bundle):
    preprocessor: PipelineModel
    model: Any
    family: str
    threshold: float
    record: dict[str, Any] = field(default_factory=dict)

    def score(self, df: DataFrame, out_col: str = "score") -> DataFrame:
        x = self.preprocessor.transform(df)
        if isinstance(self.model, CalibratedModel):
            x = self.model.transform_score(x, out_col)
        else:
            x = score_with(self.model, x, out_col)
        return x.select(*df.columns, out_col)


def compare_tune_calibrate_finalize(
    train: DataFrame,
    valid: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    id_col: str,
    families: Sequence[str] = ("logistic_regression", "random_forest", "xgboost"),
    budget_sec: float = 20.0,
    seed: int = 42,
    configs: Sequence[tuple[str, Mapping[str, Any]]] | None = None,
    project: str = "churn",
    final_rows: DataFrame | None = None,
    preprocessor: PipelineModel | None = None,
) -> FinalModel:
    """Compare families by valid AUC, tune the best (keep the tuned config only
    if its valid AUC is higher; ``configs`` as in ``budgeted_search``), and finalise:
    the chosen setting is fitted on all of ``final_rows`` (default: train) and
    calibrated by their out-of-fold scores. The threshold is the cost-optimal one on
    valid, which no fit has seen unless ``final_rows`` holds it."""
    rows = train if final_rows is None else final_rows
    pre = preprocessor or build_preprocessor(train, *split_roles(train, feature_cols))
    xt, xv = _prepared(train, label_col, pre), _prepared(valid, label_col, pre)
    try:
        sweep = _sweep(xt, xv, families, seed, project)
        best = sweep.where("status = 'ok'").orderBy(F.col("roc_auc").desc_nulls_last(), "model_name").first()
        if best is None:
            raise ValueError("no family could be fitted")
        fam = best["model_name"]
        base_auc = best["roc_auc"]
        own = None if configs is None else [c for c in configs if c[0] == fam]
        trials = _search(xt, xv, [fam], budget_sec, seed, configs=own, project=project, full=True)
        cfg_row = trials.where("is_best").first()
        cfg = json.loads(cfg_row["config"]) if cfg_row else {}
        tuned = make_classifier(fam, seed, project=project, full=True, **cfg).fit(xt)
        tuned_auc = roc_auc(score_with(tuned, xv, "_s"), "label", "_s").collect()[0][0]  # one row
    finally:
        xt.unpersist()
        xv.unpersist()
    use_cfg = cfg if (tuned_auc or 0) > (base_auc or 0) else {}
    weighted = wants_balanced_weights(fam, project)
    est = make_classifier(fam, seed, weight_col="_w" if weighted else None, project=project, full=True, **use_cfg)
    x = _prepared(rows, label_col, pre, id_col)
    try:
        model: Any = platt_calibrate(balanced_weights(x, "label") if weighted else x, est, "label", id_col, 3, seed, refit=True)
    finally:
        x.unpersist()
    fm = FinalModel(pre, model, fam, 0.5)
    scored_valid = fm.score(valid).withColumn("_y", F.col(label_col))
    thr = threshold_sweep(scored_valid, "_y", "score").where("is_best").first()
    fm.threshold = float(thr["threshold"]) if thr else 0.5
    fm.record = {"family": fam, "config": use_cfg, "valid_auc_base": base_auc, "valid_auc_tuned": tuned_auc,
                 "threshold": fm.threshold}
    return fm


def finalize_t_learner(
    train: DataFrame,
    feature_cols: Sequence[str],
    id_col: str = "user_id",
    treatment_col: str = "treatment",
    outcome_col: str = "converted",
    families: Sequence[str] = ("logistic_regression", "random_forest", "xgboost"),
    budget_sec: float = 20.0,
    seed: int = 42,
    configs: Sequence[tuple[str, Mapping[str, Any]]] | None = None,
    check_share: float = 0.3,
) -> tuple[TLearner, dict[str, dict[str, Any]]]:
    """The uplift half of the track: each arm compares and tunes on ``1 - check_share``
    of its rows, judged on the rest, and its winner is calibrated and fitted on all of
    them. Returns the learner and each arm's record. The targeting share is chosen
    afterwards, on rows that are not in ``train``."""
    pre = build_preprocessor(train, *split_roles(train, feature_cols))
    made, record = {}, {}
    for arm, value in (("treatment", 1), ("control", 0)):
        part = train.where(F.col(treatment_col) == value)
        checked = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1000)) < int(check_share * 1000)
        fm = compare_tune_calibrate_finalize(
            part.where(~checked), part.where(checked), outcome_col, feature_cols, id_col, families, budget_sec, seed + 1 - value, configs, "uplift", part, pre
        )
        made[arm], record[arm] = fm.model, fm.record
    note = "compared, tuned, calibrated and finalised per arm"
    return TLearner(pre, made["treatment"], made["control"], "Finalized T-Learner", "spark", note), record


# ---------------------------------------------------------------- stability

def seed_stability_summary(runs: DataFrame, key_col: str = "candidate_key", metric_col: str = "holdout_primary_metric") -> DataFrame:
    """Mean, sample std, min, max and count of a metric per candidate over
    seeds (NULL keys kept), sorted by mean desc."""
    return (
        runs.groupBy(key_col)
        .agg(
            F.avg(metric_col).alias("auuc_mean"),
            F.stddev_samp(metric_col).alias("auuc_std"),
            F.min(metric_col).alias("auuc_min"),
            F.max(metric_col).alias("auuc_max"),
            F.count(metric_col).alias("n_runs"),
        )
        .orderBy(F.col("auuc_mean").desc_nulls_last())
    )


def seed_stability(
    df: DataFrame,
    feature_cols: Sequence[str],
    families: Sequence[str],
    seeds: Sequence[int],
    id_col: str = "user_id",
    treatment_col: str = "treatment",
    outcome_col: str = "converted",
) -> tuple[DataFrame, DataFrame]:
    """Re-split and refit every candidate per seed, AUUC on each holdout.
    Failures are recorded with a status, not raised. Returns (runs, summary)."""
    from sparkexp.operators.sampling import stratified_split
    from sparkexp.operators.uplift import uplift_metrics

    spark = df.sparkSession
    df = _only(df, id_col, treatment_col, outcome_col, *feature_cols)
    rows = []
    for s in seeds:
        split = stratified_split(df.withColumn("_st", F.concat_ws("_", treatment_col, outcome_col)), ["_st"], id_col,
                                 0.2, 0.2, s, ("train", "valid", "holdout")).drop("_st")
        split = split.persist(StorageLevel.MEMORY_AND_DISK)
        train, hold = split.where("split = 'train'"), split.where("split = 'holdout'")
        for fam in families:
            try:
                tl = fit_t_learner(train, feature_cols, fam, treatment_col, outcome_col, id_col, s)
                # written, as the ranking reads its rows three times
                sc = cut_lineage(tl.transform(hold).select(*dict.fromkeys([id_col, outcome_col, treatment_col, "uplift"])))
                m = uplift_metrics(sc, outcome_col, treatment_col, "uplift", id_col).collect()[0]  # one row
                rows.append((fam, s, float(m["auuc"]), "ok"))
            except Exception as e:  # noqa: BLE001
                rows.append((fam, s, None, f"failed: {type(e).__name__}"))
        split.unpersist()
    runs = spark.createDataFrame(rows, "candidate_key string, seed int, holdout_primary_metric double, status string")
    return runs, seed_stability_summary(runs.where("status = 'ok'"))


def seed_stability_churn(
    train: DataFrame,
    valid: DataFrame,
    test: DataFrame,
    label_col: str,
    feature_cols: Sequence[str],
    candidates: Sequence[tuple[str, str, str]],
    seeds: Sequence[int],
    retrainable_sources: Sequence[str] = ("spark", "manual"),
) -> DataFrame:
    """Refit each (candidate_id, library_source, family) per seed on the same
    splits: threshold from the valid cost sweep, cost / AP / AUC / Brier on
    test. Candidates from other sources are recorded as not retrainable;
    failures are recorded with their message, never raised."""
    from sparkexp.operators.classification import evaluate_classifier

    spark = train.sparkSession
    num, cat = split_roles(train, feature_cols)
    pre = build_preprocessor(train, num, cat)
    ready = lambda d: _only(pre.transform(d).withColumn("label", F.col(label_col).cast("double")), "features", "label").persist(StorageLevel.MEMORY_AND_DISK)
    xt, xv, xs = ready(train), ready(valid), ready(test)
    rows = []
    for cand_id, source, family in candidates:
        for seed in seeds:
            rec = (None, None, None, None, None)
            if source not in retrainable_sources:
                status = "skipped_not_retrainable"
            else:
                try:
                    m = make_classifier(family, seed).fit(xt)
                    v, s = (cut_lineage(score_with(m, d, "_s").select("label", "_s")) for d in (xv, xs))  # s is read four times
                    ev = evaluate_classifier(v, s, "label", "_s").first()
                    rec = (ev["threshold"], ev["expected_cost_per_1000"], ev["average_precision"], ev["roc_auc"], ev["brier_score"])
                    status = "ok"
                except Exception as e:  # noqa: BLE001 - recorded, not raised
                    status = f"failed: {type(e).__name__}: {e}"
            rows.append((cand_id, source, family, int(seed), status, *rec))
    for d in (xt, xv, xs):
        d.unpersist()
    return spark.createDataFrame(
        rows,
        "candidate_id string, library_source string, model_name string, seed int, status string, threshold double, "
        "holdout_primary_metric double, holdout_secondary_metric double, holdout_tertiary_metric double, calibration_metric double",
    )
