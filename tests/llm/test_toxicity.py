"""Toxicity: held-out accuracy, interactions that weights alone miss, awkward rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkexp.llm import toxicity as tx
from sparkexp.llm.queries import QUERIES
from tests.llm.data import awkward, make

SF = "/root/testdata/sf0.1"


def pairs_data(n=4000, seed=0):
    """Toxic when one of five insults and one of five groups are named."""
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        a = [f"insult{i}" for i in r.choice(5, r.integers(0, 5), replace=False)]
        b = [f"group{i}" for i in r.choice(5, r.integers(0, 5), replace=False)]
        noise = [f"word{i}" for i in r.integers(0, 400, 12)]
        rows.append((a + b + noise, int(bool(a) and bool(b))))
    return rows


def test_pairs_beat_additive_weights():
    rows = pairs_data()
    x = [sorted({zlib.crc32(w.encode()) % tx.DIMS for w in ws}) for ws, _ in rows]
    y = np.array([t for _, t in rows], float)
    cut = 3000
    flat = lambda z: (np.array([len(t) for t in z]), np.array([i for t in z for i in t]))
    n, t = flat(x[cut:])
    right = []
    for settings in ({}, {"group": 100.0}):
        m = tx.FactorizationMachine()
        m.b, used, w, v = tx.fit_rows(*flat(x[:cut]), y[:cut], **settings)
        m.w[used], m.v[used] = w, v
        right.append(((m.raw(np.repeat(np.arange(len(n)), n), t, len(n)) > 0) == (y[cut:] == 1)).mean())
    assert not v.any()
    assert right[0] > 0.85 and right[0] > right[1] + 0.05


def test_raw_is_the_sum_over_pairs():
    r = np.random.default_rng(1)
    m = tx.FactorizationMachine(20)
    m.b, m.w, m.v = 0.3, r.normal(size=20), r.normal(size=(20, 4))
    docs = [[1, 4, 7], [], [3], [0, 19, 5, 6]]
    n = np.array([len(d) for d in docs])
    got = m.raw(np.repeat(np.arange(4), n), np.array(sum(docs, [])), 4)
    want = [0.3 + sum(m.w[i] for i in d) + sum(m.v[i] @ m.v[j] for i in d for j in d if i < j) for d in docs]
    assert np.allclose(got, want)


def test_held_out_accuracy_and_scores(spark):
    got = QUERIES["op12_toxicity"](spark, SF).cache()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    for r in rows[:500]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    test = [r for r in rows if r.held_out]
    bad, good = [r for r in test if r.toxic == 1], [r for r in test if r.toxic == 0]
    assert sum(r.predicted for r in bad) / len(bad) > 0.8
    assert sum(r.predicted for r in good) / len(good) < 0.02


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, " ".join(ws), t) for i, (ws, t) in enumerate(pairs_data(1500))]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return tx.fit_model(d.drop("toxic"), d.drop("text")), d


def test_sample_bound_repeats_and_one_label(spark, model):
    m, d = model
    again = tx.fit_model(d.drop("toxic").repartition(7), d.drop("text").union(d.drop("text")))
    key = lambda x: sorted((r.place, round(r.w, 9)) for r in x.collect())
    assert key(m) == key(again)
    small = d.where(tx._share(d.count(), 100, F.xxhash64("doc_id"))).count()
    assert 50 < small < 200
    only = tx.fit_model(d.drop("toxic"), d.select("doc_id", F.lit(0).alias("toxic")))
    assert [r.place for r in only.collect()] == [-1] and only.first().w < -5
    none = tx.fit_model(d.where("false").drop("toxic"), d.drop("text"))
    assert {round(r.toxicity, 9) for r in tx.score(d, none).collect()} == {0.1}


def test_awkward_rows(spark, model):
    m, _ = model
    docs = make(spark, [*awkward(), (50, "INSULT0!! über,GROUP1", "en", "s")])
    got = tx.score(docs, m)
    assert got.columns == [*docs.columns, "toxicity"] and got.count() == 13
    by = {r.text: r.toxicity for r in got.collect()}
    assert by[None] == by[""] == by[" \t\n "] < 0.5
    assert by["INSULT0!! über,GROUP1"] == tx.score(make(spark, [(1, "insult0 group1", "en", "s")]), m).first().toxicity
    assert tx.score(docs.where("false"), m).collect() == []
