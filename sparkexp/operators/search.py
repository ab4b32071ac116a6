"""Model search by cross-validation: metrics as ``pyspark.ml`` evaluators, a grid
over a fold column, and a cost-frugal search by successive halving, alone or for each
arm of a T-learner.

A fit is a distributed job; the driver only walks configurations and folds, several
at a time, and collects one number from each.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkexp.operators.classification import average_precision
from sparkexp.operators.features import build_preprocessor, split_roles
from sparkexp.operators.models import SEARCH_SPACE, TLearner, at_once, log_loss_col, make_classifier, positive_score
from sparkexp.operators.sampling import stratified_folds

# What a wrong contact and a missed one cost.
FP_COST, FN_COST = 65.0, 320.0


# ---------------------------------------------------------------- metrics

class ScoreEvaluator(Evaluator):
    """A metric of the positive-class score that a model's output holds."""

    larger_is_better = False

    def __init__(self, label_col: str = "label"):
        super().__init__()
        self.label_col = label_col

    def metric(self, scored: DataFrame) -> float:
        raise NotImplementedError

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = positive_score(dataset, "_s").select(F.col(self.label_col).cast("int").alias("_y"), "_s")
        return self.metric(scored)

    def isLargerBetter(self) -> bool:
        return self.larger_is_better


class LogLoss(ScoreEvaluator):
    def metric(self, scored: DataFrame) -> float:
        return float(scored.agg(F.avg(log_loss_col(F.col("_y"), F.col("_s")))).first()[0])


class AveragePrecision(ScoreEvaluator):
    """Average precision; 0 without positives."""

    larger_is_better = True

    def metric(self, scored: DataFrame) -> float:
        return float(average_precision(scored, "_y", "_s").first()[0] or 0.0)


class BusinessCost(ScoreEvaluator):
    """Cost of wrong decisions at ``threshold`` per 1000 rows."""

    def __init__(self, label_col: str = "label", threshold: float = 0.5, fp_cost: float = FP_COST, fn_cost: float = FN_COST):
        super().__init__(label_col)
        self.threshold, self.fp_cost, self.fn_cost = threshold, fp_cost, fn_cost

    def metric(self, scored: DataFrame) -> float:
        yes = F.col("_s") >= self.threshold
        r = scored.agg(F.count_if((F.col("_y") == 0) & yes).alias("fp"), F.count_if((F.col("_y") == 1) & ~yes).alias("fn"), F.count("*").alias("n")).first()
        return (r["fp"] * self.fp_cost + r["fn"] * self.fn_cost) / max(r["n"], 1) * 1000.0


METRICS = {"log_loss": LogLoss, "average_precision": AveragePrecision, "business_cost": BusinessCost}


# ---------------------------------------------------------------- fold column

def fold_search(
    folded: DataFrame, estimator: Estimator, grid: Sequence[Mapping[str, Any]], evaluator: Evaluator, fold_col: str = "fold", parallelism: int = 4
) -> tuple[DataFrame, CrossValidatorModel]:
    """Every setting of ``grid`` on the folds that ``fold_col`` (0 to k - 1) names, by
    ``CrossValidator``. One row per setting: its JSON, mean and population std of the
    metric, and whether it is the best (of equals the first); and the fitted model,
    refitted on all rows."""
    maps = [{estimator.getParam(n): v for n, v in g.items()} for g in grid]
    data = folded.withColumn(fold_col, F.col(fold_col).cast("int")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        k = data.agg(F.max(fold_col)).first()[0]
        if k is None:
            raise ValueError("empty training data")
        cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator, numFolds=int(k) + 1, foldCol=fold_col, parallelism=parallelism)
        model = cv.fit(data)
    finally:
        data.unpersist()
    mean = [float(m) for m in model.avgMetrics]
    best = mean.index(max(mean) if evaluator.isLargerBetter() else min(mean))
    rows = [(i, json.dumps(dict(g), sort_keys=True), float(m), float(s), i == best) for i, (g, m, s) in enumerate(zip(grid, mean, model.stdMetrics, strict=True))]
    return folded.sparkSession.createDataFrame(rows, "trial int, config string, metric_mean double, metric_std double, is_best boolean"), model


# ---------------------------------------------------------------- successive halving

def sample_configs(families: Sequence[str], n: int, seed: int = 42) -> list[tuple[str, dict[str, Any]]]:
    """n settings from ``SEARCH_SPACE``, families in turn, without repeats as long as
    there are others. A family without a space is tried as it is."""
    rng, out = random.Random(seed), []
    for i in range(n):
        family = families[i % len(families)]
        space = SEARCH_SPACE.get(family, {})
        for _ in range(20):
            config = (family, {k: rng.choice(v) for k, v in space.items()})
            if config not in out:
                out.append(config)
                break
    return out


def halving_schedule(n: int, eta: int = 3, least_share: float = 1 / 9) -> list[tuple[float, int]]:
    """(share of the rows, settings left) of each rung; the last uses all rows."""
    share, left, out = least_share, n, []
    while share < 1 and left > 1:
        out.append((share, left))
        share, left = min(1.0, share * eta), max(1, -(-left // eta))
    return [*out, (1.0, left)]


def halving_search(
    prepared: DataFrame,
    label_col: str,
    id_col: str,
    configs: Sequence[tuple[str, Mapping[str, Any]]],
    metric: str = "log_loss",
    folds: int = 3,
    eta: int = 3,
    least_share: float = 1 / 9,
    budget_sec: float | None = None,
    seed: int = 42,
    project: str = "uplift",
    parallelism: int = 4,
) -> DataFrame:
    """Successive halving: all settings are cross-validated on a small share of the
    rows, the best 1 / ``eta`` on ``eta`` times as many, and so on up to all rows.

    Folds are stratified and fixed; the shares are nested, by a hash of the id. With
    ``budget_sec`` no rung after the first starts once that time is spent; without, the
    schedule is fixed and the result repeats. One row per rung and setting: mean and
    population std of the loss over the folds, seconds, ``kept`` (goes on, or the
    winner), ``is_best`` (the winner) and ``is_best_of_family`` (last rung reached,
    then loss). Of equals the earlier setting wins.
    """
    evaluator = METRICS[metric](label_col)
    sign = -1.0 if evaluator.isLargerBetter() else 1.0
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 20))
    # What every family reads; a copy of all columns would be several times as large.
    needed = prepared.select(*dict.fromkeys(["features", label_col, id_col]))
    folded = stratified_folds(needed, [label_col], id_col, folds, seed).withColumn("_at", place).persist(StorageLevel.MEMORY_AND_DISK)
    rows, left, began = [], list(range(len(configs))), time.perf_counter()
    schedule = halving_schedule(len(configs), eta, least_share)

    def loss(trial: int, fold: int, share: float) -> tuple[float, float]:
        family, config = configs[trial]
        part = folded.where(F.col("_at") < int(share * (1 << 20))) if share < 1 else folded
        t = time.perf_counter()
        model = make_classifier(family, seed, label_col=label_col, project=project, **config).fit(part.where(F.col("fold") != fold))
        return sign * evaluator.evaluate(model.transform(part.where(F.col("fold") == fold))), time.perf_counter() - t

    try:
        for rung, (share, _) in enumerate(schedule):
            if rung and budget_sec is not None and time.perf_counter() - began > budget_sec:
                break
            jobs = [(t, f) for t in left for f in range(folds)]
            got = dict(zip(jobs, at_once([lambda j=j: loss(*j, share) for j in jobs], parallelism), strict=True))
            ranked = []
            for t in left:
                own = [got[t, f][0] for f in range(folds)]
                mean = sum(own) / folds
                ranked.append((mean, t, (sum((x - mean) ** 2 for x in own) / folds) ** 0.5, sum(got[t, f][1] for f in range(folds))))
            ranked.sort(key=lambda r: r[:2])
            stay = schedule[rung + 1][1] if rung + 1 < len(schedule) else 1
            left = sorted(t for _, t, *_ in ranked[:stay])
            rows += [(rung, share, t, configs[t][0], json.dumps(dict(configs[t][1]), sort_keys=True), m, s, sec, t in left) for m, t, s, sec in ranked]
    finally:
        folded.unpersist()
    out = prepared.sparkSession.createDataFrame(
        rows, "rung int, share double, trial int, family string, config string, loss double, loss_std double, seconds double, kept boolean"
    )
    # One row per rung and setting: a table of the driver's size.
    order = [F.desc("rung"), "loss", "trial"]
    return out.withColumn("is_best", F.row_number().over(Window.orderBy(*order)) == 1).withColumn(
        "is_best_of_family", F.row_number().over(Window.partitionBy("family").orderBy(*order)) == 1
    )


def search_t_learner(
    train: DataFrame,
    valid: DataFrame,
    holdout: DataFrame,
    feature_cols: Sequence[str],
    configs: Sequence[tuple[str, Mapping[str, Any]]],
    id_col: str = "user_id",
    treatment_col: str = "treatment",
    outcome_col: str = "converted",
    seed: int = 42,
    budget_sec: float | None = None,
    n_boot: int = 250,
    **search: Any,
) -> tuple[DataFrame, TLearner, DataFrame, DataFrame]:
    """A T-learner whose arms are searched apart, each with its own folds, seed and
    budget. Returns the candidate row (judged on holdout at the targeting share that
    is best on valid), the learner, the table of shares and the trials of both arms."""
    from sparkexp.operators.labs import evaluate_uplift
    from sparkexp.operators.uplift import optimize_policy_fraction

    began = time.perf_counter()
    pre = build_preprocessor(train, *split_roles(train, feature_cols))
    x = pre.transform(train).withColumn("label", F.col(outcome_col).cast("double"))
    x = x.select(*dict.fromkeys(["features", "label", treatment_col, id_col])).persist(StorageLevel.MEMORY_AND_DISK)
    fitted, trials = {}, None
    for arm, own_seed in (("treatment", seed), ("control", seed + 1)):
        part = x.where(F.col(treatment_col) == int(arm == "treatment"))
        found = halving_search(part, "label", id_col, configs, budget_sec=budget_sec, seed=own_seed, **search)
        best = found.where("is_best").first()
        est = make_classifier(best["family"], own_seed, project=search.get("project", "uplift"), **json.loads(best["config"]))
        fitted[arm] = est.fit(part)
        found = found.select(F.lit(arm).alias("arm"), "*")
        trials = found if trials is None else trials.unionByName(found)
    x.unpersist()
    learner = TLearner(pre, fitted["treatment"], fitted["control"], "Searched T-Learner", "spark", "response models chosen per arm by cross-validation")
    shares = optimize_policy_fraction(learner.transform(valid), outcome_col, treatment_col, "uplift", id_col)
    best = shares.where("is_best").first()
    seconds = time.perf_counter() - began
    row = evaluate_uplift(
        learner.transform(holdout), outcome_col, treatment_col, id_col, "search::t_learner", learner.model_name, note=learner.interpretability_note,
        selected_fraction=float(best["target_fraction"]) if best else 0.30, seed=seed, n_boot=n_boot,
    )
    return row.withColumn("train_time_sec", F.lit(seconds)), learner, shares, trials


def search_details(trials: DataFrame) -> DataFrame:
    """Best learner, setting and loss of each arm."""
    return trials.where("is_best").select("arm", F.col("family").alias("best_estimator"), F.col("config").alias("best_config"), F.col("loss").alias("best_loss"))


def refit_best(prepared: DataFrame, trials: DataFrame, label_col: str = "label", seed: int = 42, project: str = "uplift") -> Model:
    """The winner of ``halving_search`` fitted on all rows."""
    best = trials.where("is_best").first()
    return make_classifier(best["family"], seed, label_col=label_col, project=project, **json.loads(best["config"])).fit(prepared)
