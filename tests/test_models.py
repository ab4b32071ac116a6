"""ML layer: fit / score / save-load / stream = batch on a small table."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def splits(spark):
    from sparkexp.plans.q_models import _splits

    return _splits(spark, SF_SMALL)


def test_preprocessor_unknown_level_is_zero(spark, splits):
    from pyspark.ml.functions import vector_to_array

    from sparkexp.operators.features import build_preprocessor

    train, _, hold = splits
    pre = build_preprocessor(train, ["o_totalprice"], ["c_mktsegment"])
    odd = hold.limit(3).withColumn("c_mktsegment", F.lit("NEVER-SEEN"))
    arr = pre.transform(odd).select(vector_to_array("features").alias("a")).collect()
    k = train.select("c_mktsegment").distinct().count()
    assert all(len(r.a) == 1 + k and sum(r.a[1:]) == 0 for r in arr)


def test_t_learner_probabilities_and_save_load(spark, splits, tmp_path):
    from pyspark.ml import PipelineModel

    from sparkexp.operators import models as mo
    from sparkexp.plans.q_models import FEATS
    from sparkexp.sources import io

    train, _, hold = splits
    tl = mo.fit_t_learner(train, FEATS, "logistic_regression", id_col="unit_id")
    out = tl.transform(hold).collect()
    assert all(0.0 <= r.p_treated <= 1.0 and 0.0 <= r.p_control <= 1.0 for r in out)
    assert all(abs(r.uplift - (r.p_treated - r.p_control)) < 1e-12 for r in out)
    full = PipelineModel(stages=[*tl.preprocessor.stages, tl.model_treatment])
    path = str(tmp_path / "bundle")
    io.save_model(full, path, {"threshold": 0.4})
    loaded, meta = io.load_model(spark, path)
    a = [r.probability[1] for r in full.transform(hold).orderBy("unit_id").collect()]
    b = [r.probability[1] for r in loaded.transform(hold).orderBy("unit_id").collect()]
    assert a == b and meta["threshold"] == 0.4
    with pytest.raises(ValueError):
        io.load_model(spark, str(tmp_path / "missing"))


def test_stream_equals_batch(spark):
    import __spark_entry__ as ent

    q = ent.queries()
    stream = q["score_stream"](spark, SF_SMALL).orderBy("unit_id").collect()
    batch = q["score_batch"](spark, SF_SMALL).orderBy("unit_id").collect()
    assert [(r.unit_id, round(r.churn_probability, 12)) for r in stream] == [
        (r.unit_id, round(r.churn_probability, 12)) for r in batch
    ]
