"""Weighted automata and phrase mining against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sparkexp.llm import automata as au


def some(seed, n=400, vocab=12):
    r = random.Random(seed)
    c = Counter()
    for _ in range(n):
        c[tuple(r.randint(1, vocab) for _ in range(r.randint(1, 4)))] += r.randint(1, 3)
    return c


def arrays(c):
    g = np.array([[*p, *[0] * (4 - len(p))] for p in c], np.int64).reshape(-1, 4)
    hi, lo, n = au.summed(*au.keys(g), np.array(list(c.values()), np.int64))
    return au.grams(hi, lo), n


@pytest.mark.parametrize("seed", range(6))
def test_transducer_paths_and_weights(seed):
    c = some(seed) if seed else Counter()
    t = au.Transducer.unpack(au.Transducer.build(*arrays(c)).pack())
    g, n = t.paths()
    assert {tuple(int(x) for x in p if x): int(k) for p, k in zip(g, n, strict=True)} == dict(c)
    assert [tuple(p) for p in g] == sorted(tuple(p) for p in g)
    r = random.Random(seed)
    ask = [tuple(r.randint(1, 13) for _ in range(r.randint(1, 4))) for _ in range(800)] + list(c)
    got = t.weights(np.array([[*p, *[0] * (4 - len(p))] for p in ask], np.int64))
    assert got.tolist() == [c[p] for p in ask]


def test_equal_endings_are_shared():
    c = Counter({(a, 50, b, 51): 1 for a in range(1, 40) for b in range(1, 5)})
    t = au.Transducer.build(*arrays(c))
    assert [len(level[1]) for level in t.levels] == [39, 1, 4, 1]


def test_union_adds_weights_over_own_word_lists():
    words = [f"w{i:02d}" for i in range(30)]
    want, lists, blobs = Counter(), [], []
    for seed in range(5):
        c = some(seed)
        own = sorted(random.Random(seed).sample(words, 12))
        for p, k in c.items():
            want[tuple(own[i - 1] for i in p)] += k
        w, b = au.packed(pa.array(own), *arrays(c))
        lists.append(w)
        blobs.append(b)
    w, g, n = au.union(lists, blobs)
    w = w.to_pylist()
    assert w == sorted(w)
    assert {tuple(w[i - 1] for i in p if i): int(k) for p, k in zip(g, n, strict=True)} == dict(want)


# ------------------------------------------------------------- phrase mining
from sparkexp.llm import collocations as co  # noqa: E402
from tests.llm.data import awkward, make  # noqa: E402

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, min_count, inside=80, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, *w[i : i + k]] += 1
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    gone = set()
    for p, c in cand.items():
        for i in range(1, len(p)):
            for j in range(i + 2, len(p) + 1):
                q = (p[0], *p[i:j])
                if len(q) < len(p) and 100 * c >= inside * f[q]:
                    gone.add(q)
    out = []
    for p, a in cand.items():
        if p in gone:
            continue
        best = min((2000000 * a // (f[p[: k + 1]] + f[p[0], *p[k + 1 :]]), k) for k in range(1, len(p) - 1))
        k = best[1]
        out.append((p[0], best[0], a, " ".join(p[1:]), f[p[: k + 1]], f[p[0], *p[k + 1 :]]))
    rows = []
    for lang in {p[0] for p in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[1], -x[2], x[3].encode()))[:top]
        rows += [(lang, r, ph, a, left, right, n[lang], s) for r, (_, s, a, ph, left, right) in enumerate(own, 1)]
    return sorted(rows)


def texts(seed=0, n=150):
    r = random.Random(seed)
    vocab = ["the", "The", "of", "é", "Éa", "straße", "x\x01y", "new", "york", "city", "-", "a　b"]
    rows = []
    for i in range(n):
        words = [r.choice(vocab) if r.random() < 0.7 else r.choice(["new york city hall", "of the", "New\tYork"]) for _ in range(r.randint(0, 60))]
        rows.append((i, r.choice([" ", " ", "  ", ", ", "\n", ". "]).join(words), r.choice(["en", "de", None, "und", "e"]), "s"))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_mine_against_brute_force(spark, monkeypatch, small):
    rows = texts() + texts()[:40] + awkward()[:5]
    if small:
        monkeypatch.setattr(co, "RANGE_BYTES", 2000)
        monkeypatch.setattr(co, "SHARD_PHRASES", 300)
        monkeypatch.setattr(co, "PART_BYTES", 500)
        monkeypatch.setattr(co, "GROUP_ASKS", 100)
    got = co.mine(make(spark, rows).repartition(3), min_count=6, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute([(r[2], r[1]) for r in rows], 6, top=40)


def test_no_phrases_and_long_text(spark):
    assert co.mine(make(spark, [(1, "a b c", "en", "s")])).collect() == []
    assert co.mine(make(spark, [(1, "a b", "en", "s")]).where("false")).collect() == []
    long = " ".join(f"t{i % 700}" for i in range(70_000))
    got = co.mine(make(spark, [(1, long, "en", "s"), (2, "a" * 300_000, None, None)]), min_count=30)
    assert [tuple(r)[1:] for r in got.orderBy("rank").limit(3).collect()] == [x[1:] for x in brute([("en", long)], 30)[:3]]


def test_equal_hashes_are_told_apart():
    """All words share one hash; their numbers still differ."""
    raw = np.frombuffer(b"one two one three Two", np.uint8)
    w = co.Words.of(raw, np.array([0, len(raw)]), np.zeros(1, np.uint64))
    w.hash[:] = 1
    s = co.Symbols()
    ids = s.of(w, ["en"])
    assert s.names().take(pa.array(ids)).to_pylist() == ["en\none", "en\ntwo", "en\none", "en\nthree", "en\ntwo"]
    w.start, w.end, w.doc, w.hash = w.start[3:4], w.end[3:4], w.doc[3:4], w.hash[3:4]
    again = [int(s.of(w, [x])[0]) for x in ("en", "de")]
    assert s.names().take(pa.array(again)).to_pylist() == ["en\nthree", "de\nthree"]


def test_filter_only_saves_work(spark, monkeypatch):
    """A filter with few bits lets more through and changes nothing."""
    rows = texts(seed=3)
    monkeypatch.setattr(co, "FILTER_BITS", 1 << 18)
    full = co.mine(make(spark, rows), min_count=5).collect()
    monkeypatch.setattr(co, "_filter", lambda s, p: s.sparkContext.broadcast(np.full(1 << 12, 255, np.uint8)))
    assert sorted(full) == sorted(co.mine(make(spark, rows), min_count=5).collect())
