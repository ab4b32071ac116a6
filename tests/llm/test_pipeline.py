"""The pipeline's stages against brute-force versions, each on its own input."""

from __future__ import annotations

import os

import pytest

from tests.conftest import SF_SMALL
from tests.llm import data
from tests.llm.data import order

pytestmark = pytest.mark.skipif(not os.path.exists("corpus_pipeline.py") and not os.path.exists(os.path.join(os.path.dirname(__file__), "../../corpus_pipeline.py")), reason="no pipeline")


def _rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_stages(spark):
    import corpus_pipeline as p
    from sparkexp.llm.mixing import mix

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = [n for n, _ in p.STAGES]
    assert len(names) == 5
    stage = dict(p.STAGES)

    kept = stage[names[0]](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    failed = {d for d, t, *_ in _rows(docs) for c in [data.quality_counts(t)] if c[0] < 10 or 100 * c[4] > 20 * c[0]}
    assert not failed & {r[0] for r in _rows(kept)}

    lines = stage[names[1]](spark, kept, SF_SMALL)
    want = [(d, t) for d, n, gone, t in data.line_dedup(_rows(kept), 10) if gone < n or gone == 0]
    assert order([r[:2] for r in _rows(lines)]) == order(want) and lines.columns == docs.columns

    near = stage[names[2]](spark, lines, SF_SMALL)
    rows = _rows(lines)
    first = {c for d, _, c in data.jaccard(rows, 5, 80)}
    assert sorted(r[0] for r in _rows(near)) == sorted(first) and near.columns == docs.columns

    clean = stage[names[3]](spark, near, SF_SMALL)
    words = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    items = [words(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    leaked = {r[0] for r in _rows(near) if any(i in words(r[1]) for i in items)}
    left = {r[0] for r in _rows(clean)}
    assert not leaked & left and clean.columns == docs.columns

    mixed = stage[names[4]](spark, clean, SF_SMALL)
    assert mixed.count() == sum(r.copies for r in mix(clean).collect())


@pytest.mark.parametrize("rows", [data.awkward(), [(None, t, *x) for _, t, *x in data.corpus(8, 30)]], ids=["awkward", "no ids"])
def test_near_duplicates_keep_one_row_a_group(spark, rows):
    """Rows of brute-force groups, those without words alone: one of each stays."""
    import corpus_pipeline as p

    # Brute force over row numbers in place of ids names the groups.
    group = [c for _, _, c in data.jaccard([(k, t) for k, (_, t, *_) in enumerate(rows)], 5, 80)]
    least: dict = {}
    for (i, *_), c in zip(rows, group, strict=True):
        least[c] = min(least.get(c, 1 << 63), (1 << 63) - 1 if i is None else i)
    got = _rows(p.near_duplicates(spark, data.make(spark, rows).repartition(3), SF_SMALL))
    assert order([((1 << 63) - 1 if r[0] is None else r[0],) for r in got]) == order([(x,) for x in least.values()])
    of = {}
    for (i, t, *_), c in zip(rows, group, strict=True):
        of.setdefault((i, t), []).append(c)
    stays = [of[r[:2]].pop() for r in got]
    assert len(set(stays)) == len(stays)


def test_run_and_awkward_rows(spark, tmp_path):
    import corpus_pipeline as p

    rows = data.awkward() + data.corpus()
    for name, part in (("full", rows), ("none", [])):
        d = tmp_path / name
        data.make(spark, part).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(1, None), (2, "a few words of a test item that nobody copied")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        out = p.run(spark, str(d))
        assert out.columns == ["doc_id", "text", "lang", "source", *data.EXTRA]
        assert (out.count() > 0) == bool(part)
