"""Small tables with the awkward cases, and plain-Python versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns whose names the operators use themselves.
EXTRA = ["rid", "did", "row", "th", "lines", "words", "size", "bucket", "cls", "sig", "a", "b", "k", "copies", "base", "cand"]
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)


def make(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, *["x"] * len(EXTRA)) for i, t, lang, src in rows], SCHEMA)


def corpus(seed: int = 5, n: int = 60):
    """Texts with copies, shared passages, repeats inside a text and edits."""
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["é", "straße", "Über", "THE", "the"]
    passages = [" ".join(r.choices(vocab, k=r.randint(30, 90))) for _ in range(4)]
    rows = []
    for i in range(n):
        body = " ".join(r.choices(vocab, k=r.choice([0, 3, 8, 40, 120])))
        kind = i % 6
        if kind == 1:
            body += " " + r.choice(passages) + "\n" + " ".join(r.choices(vocab, k=20))
        elif kind == 2 and rows:
            body = r.choice(rows)[1] or ""
        elif kind == 3 and rows:
            w = (r.choice(rows)[1] or "a").split(" ")
            w[r.randrange(len(w))] = "edit"
            body = " ".join(w)
        elif kind == 4:
            body = body + "\t" + body + "\n\n" + r.choice(passages)
        rows.append((i * 3, body, r.choice(["en", "de", None]), r.choice(["s1", "s2", None])))
    return rows


def awkward():
    long = " ".join(f"t{i % 5000}" for i in range(60_000))
    return [
        (1, None, "en", "s1"), (2, "", "en", "s1"), (3, " \t\n ", None, None), (None, "lost id " * 30, "en", None), (None, None, None, None),
        (5, long, "en", "s2"), (6, long, "en", "s2"), (7, "same row " * 20, "en", "s1"), (7, "same row " * 20, "en", "s1"), (7, "other text", "en", "s1"),
        (9, "a" * 3000, "xx", "s3"), (10, "a" * 3000 + "b", "xx", "s3"),
    ]


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def runs(flags) -> int:
    return sum(1 for a, b in zip([0, *flags], flags, strict=False) if b and not a)


def substrings(rows, k):
    c = Counter()
    for _, t, *_ in rows:
        w = WORD.findall(t or "")
        c.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for d, t, *_ in rows:
        w = WORD.findall(t or "")
        f = [0] * len(w)
        for i in range(len(w) - k + 1):
            if c[tuple(w[i : i + k])] > 1:
                f[i : i + k] = [1] * k
        out.append((d, len(w), sum(f), " ".join(x for x, y in zip(w, f, strict=True) if not y)))
    return out


def bytes_dedup(rows, k):
    inf = 1 << 70
    first = {}
    for d, t, *_ in rows:
        b, d = (t or "").encode(), inf if d is None else d
        for i in range(len(b) - k + 1):
            first[b[i : i + k]] = min(first.get(b[i : i + k], inf), d)
    out = []
    for d, t, *_ in rows:
        b = (t or "").encode()
        f = [0] * len(b)
        for i in range(len(b) - k + 1):
            if first[b[i : i + k]] < (inf if d is None else d):
                f[i : i + k] = [1] * k
        out.append((d, len(b), sum(f), runs(f), bytes(x for x, y in zip(b, f, strict=True) if not y)))
    return out


def jaccard(rows, n, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[find(i)] = find(j)
    key = [(1 << 63) - 1 if r[0] is None else r[0] for r in rows]
    least = defaultdict(lambda: 1 << 63)
    for i in range(len(rows)):
        least[find(i)] = min(least[find(i)], key[i])
    return [(key[i], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def line_dedup(rows, least):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(low)
    c = Counter()
    for _, t, *_ in rows:
        c.update({key(x) for x in (t or "").split("\n")} - {""})
    out = []
    for d, t, *_ in rows:
        x = (t or "").split("\n")
        kept = [y for y in x if c[key(y)] < least]
        out.append((d, len(x), len(x) - len(kept), "\n".join(kept)))
    return out


def quality_counts(t):
    t = t or ""
    w = WORD.findall(t)
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c, covered, seen, dup = Counter(win), set(), set(), 0
    for i, x in enumerate(win):
        if c[x] > 1:
            covered.update(range(i, i + 5))
    for x in t.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))
