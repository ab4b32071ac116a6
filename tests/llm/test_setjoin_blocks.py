"""Verification in blocks: intersections of all pairs, links through groups of any size."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sparkexp.llm import setjoin as sj
from tests.llm.data import make


@pytest.mark.parametrize("often", [2, 5, 1000])
def test_common_counts_all_pairs(often):
    r = np.random.default_rng(often)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40))).astype(np.uint64) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) if i != j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)])
    got = sj.common(sets, often)
    np.fill_diagonal(got, 0)
    assert np.array_equal(got, want)


def near_copies(n=150, words=40, seed=1):
    """Edits of one text, most pairs of which do not link, among other texts."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        t = list(base)
        for _ in range(r.choice([1, 1, 2])):
            t[r.randrange(words)] = f"e{r.randrange(400)}"
        rows.append((i, " ".join(t), "en", "s"))
    return rows + [(1000 + i, " ".join(f"x{r.randrange(300)}" for _ in range(30)), "en", "s") for i in range(40)]


def brute(rows, n, percent):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").split()
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))})
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, r in enumerate(rows):
        low.setdefault(find(i), []).append(r[0])
    return {rows[i][0]: min(low[find(i)]) for i in range(len(rows))}


@pytest.mark.parametrize("blocks", [(2000, 1 << 20), (20, 1 << 20), (2000, 600)])
def test_components_of_a_hot_group(spark, monkeypatch, blocks):
    monkeypatch.setattr(sj, "BLOCK_CLASSES", blocks[0])
    monkeypatch.setattr(sj, "BLOCK_SHINGLES", blocks[1])
    rows = near_copies()
    got = {r.did: r.component_id for r in sj.jaccard_components(make(spark, rows), n=4, percent=78).collect()}
    want = brute(rows, 4, 78)
    assert got == want and 3 < len(set(want.values())) < len(rows)
