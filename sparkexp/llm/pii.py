"""Personal data by fixed patterns and weak supervision.

Base spans are those of four fixed patterns with their checks. Looser patterns
propose further candidates (numbers without a plus sign, spelt-out addresses,
names after a title, account numbers). Labelers vote on every candidate: form
(regular expressions and checksums), a gazetteer, and the words before it. Votes
and features are counted over the whole corpus; a vote table of bounded size
goes to expectation-maximisation, which estimates how reliable each labeler is,
and the resulting probabilities train a logistic span classifier. Candidates the
classifier is sure of join the base spans.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkexp.session import cut_lineage

# The base patterns and the order of their kinds.
BASE_KINDS = ["email", "ip", "card", "phone"]
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
# EMAIL and IP without trying every start of a long run: what stands left of an @ and
# its domain, and numbers from the start of their digits.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP_ONCE = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")

#: Kinds the method may add, after the base kinds where starts tie.
ADDED_KINDS = ["phone", "email", "account", "name"]
KINDS = [*BASE_KINDS, "account", "name"]

# Gazetteers.
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Mme Mlle Monsieur Madame Señor Señora Sr Sra Don Doña".split()
PROVIDERS = set("gmail googlemail yahoo hotmail outlook live icloud aol gmx web orange free wanadoo proton protonmail example mail1 mail2".split())
COUNTRY_CODES = set("AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM".split())
CONTEXT = {
    "phone": re.compile(r"(?i)\b(?:tel|téléphone|telephone|phone|call|mobile|cell|fax|handy|telefon|teléfono|móvil|ruf)\W*$"),
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|correo|kontakt|write to|reach)\W*(?:\w+\W+)?$"),
    "account": re.compile(r"(?i)\b(?:iban|account|konto|kontonummer|compte|cuenta|ssn|social security|bank)\W*(?:\w+\W+)?$"),
    "name": re.compile(r"(?i)\b(?:name|nom|nombre|signed|regards|dear|contact|by|sincerely|lieber|liebe|cher|chère|estimad[oa])\W*$"),
}

LOOSE = {
    "phone": re.compile(r"(?<![\w+.-])(?:00[1-9][0-9]{0,2}[ .-]?)?\(?0?[0-9]{2,4}\)?[ .-][0-9]{3}[ .-]?[0-9]{3,4}(?![\w-])"),
    "email": re.compile(r"(?<![\w.])[A-Za-z0-9._-]{2,40} ?[\[({] ?at ?[\])}] ?[A-Za-z0-9-]{2,40}(?: ?[\[({] ?dot ?[\])}] ?|\.)[A-Za-z]{2,10}\b"),
    "account": re.compile(r"(?<!\w)(?:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|[0-9]{3}-[0-9]{2}-[0-9]{4})(?!\w)"),
    "name": re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\.? (?:[A-ZÀ-ÖØ-Þ][\w'-]+)(?: [A-ZÀ-ÖØ-Þ][\w'-]+)?"),
}
#: A literal without which the loose pattern cannot match.
NEEDS = {"phone": DIGIT, "email": re.compile(r"[\[({] ?at"), "account": DIGIT, "name": re.compile(rf"(?:{'|'.join(TITLES)})\b")}
LABELERS = ["form", "gazetteer", "context", "surrounding"]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    if s[:2] not in COUNTRY_CODES:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of EMAIL's matches, in time linear in the text."""
    done = 0
    for m in re.finditer("@", text):
        at = m.start()
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; matches that fail are dropped."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            out += [("ip", m.start(), m.end()) for m in IP_ONCE.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                d = re.sub(r"[^0-9]", "", m[0])
                if 14 <= len(d) <= 19 and luhn(d):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isascii() and c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def candidates(text: str, base: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """Loose matches that overlap no base span and no earlier candidate."""
    # Disjoint taken stretches, in order.
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for kind, pattern in LOOSE.items():
        if not NEEDS[kind].search(text):
            continue
        for m in pattern.finditer(text):
            a, b = m.span()
            i = bisect_right(ends, a)
            if i == len(ends) or starts[i] >= b:
                starts.insert(i, a)
                ends.insert(i, b)
                yield kind, a, b


def votes(kind: str, s: str, before: str, after: str) -> list[int]:
    """1 personal, -1 not, 0 no opinion, by labeler."""
    digits = re.sub(r"[^0-9]", "", s)
    if kind == "phone":
        form = 1 if re.fullmatch(r"(?:00[1-9]\d{0,2}[ .-]?)?\(?0?\d{3}\)?([ .-])\d{3}\1?\d{4}", s) else -1 if len(set(digits)) < 3 or len(digits) < 9 else 0
        gaz = 1 if s.startswith("00") or "(" in s else 0
    elif kind == "email":
        form = 1 if re.search(r"dot|\.", s) else -1
        gaz = 1 if PROVIDERS & set(re.split(r"[^a-z0-9]+", s.lower())) else 0
    elif kind == "account":
        form = 1 if "-" in s and not s.startswith(("000", "666", "9")) else (1 if s[:2].isalpha() and iban_ok(s) else -1)
        gaz = 1 if s[:2] in COUNTRY_CODES else 0
    else:
        form = 1 if re.fullmatch(r"\w+\.? [^\W\d_]+(?: [^\W\d_]+)?", s) else -1
        gaz = 1 if len(s.split()) > 2 or "." in s else 0
    context = 1 if CONTEXT[kind].search(before) else 0
    odd = sum(c in "#*$%&|<>=\"" for c in before[-6:] + after[:6])
    return [form, gaz, context, -1 if odd else 0]


FOUND = "doc_id {}, base string, n_email long, n_ip long, n_card long, n_phone long, cand array<struct<kind:int,start:int,end:int,v:int>>"
_CAND = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("v", pa.int32())]))


def _code(v: list[int]) -> int:
    return sum((x + 1) * 3**i for i, x in enumerate(v))


def _find(batches):
    for batch in batches:
        base, counts, cand = [], {k: [] for k in BASE_KINDS}, []
        for t in batch.column("text").to_pylist():
            t = t or ""
            spans = base_spans(t)
            base.append(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
            for k in BASE_KINDS:
                counts[k].append(sum(s[0] == k for s in spans))
            cand.append(
                [
                    {"kind": ADDED_KINDS.index(k), "start": a, "end": b, "v": _code(votes(k, t[a:b], t[max(0, a - 40) : a], t[b : b + 10]))}
                    for k, a, b in candidates(t, spans)
                ]
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(base, pa.string()), *[pa.array(counts[k], pa.int64()) for k in BASE_KINDS], pa.array(cand, _CAND)],
            names=["doc_id", "base", "n_email", "n_ip", "n_card", "n_phone", "cand"],
        )


def fit_labelers(kind: np.ndarray, v: np.ndarray, n: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability that each vote pattern is personal data.

    v (patterns x labelers) in {-1, 0, 1}, n their counts. EM for a two-class
    model with a prior per kind and, per labeler, a distribution of votes in each
    class, both smoothed towards labelers being right more often than not.
    """
    if not len(n):
        return np.zeros(0)
    p = np.clip(0.5 + 0.2 * v.sum(axis=1), 0.05, 0.95)
    prior = np.full(len(ADDED_KINDS), 0.5)
    smooth = {1: np.array([1.0, 4.0, 4.0]), 0: np.array([4.0, 4.0, 1.0])}
    for _ in range(rounds):
        logs = {}
        for c, w in ((1, p * n), (0, (1 - p) * n)):
            logs[c] = np.zeros(len(n))
            for j in range(v.shape[1]):
                t = smooth[c] + np.bincount(v[:, j] + 1, weights=w, minlength=3)
                logs[c] += np.log(t / t.sum())[v[:, j] + 1]
        for k in range(len(prior)):
            own = kind == k
            prior[k] = (1 + (p * n)[own].sum()) / (2 + n[own].sum())
        odds = logs[1] - logs[0] + np.log(prior[kind] / (1 - prior[kind]))
        new = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            return new
        p = new
    return p


def features(kind: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Kind and votes as indicator columns."""
    cols = [kind[:, None] == np.arange(len(ADDED_KINDS))]
    cols += [v == 1, v == -1]
    return np.hstack(cols).astype(float)


def fit_classifier(x: np.ndarray, p: np.ndarray, n: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Logistic regression on weighted soft labels, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (n * (q - p)) + ridge * w
        h = (x.T * (n * q * (1 - q))) @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _vote_vector(code: np.ndarray) -> np.ndarray:
    return np.stack([code // 3**i % 3 - 1 for i in range(len(LABELERS))], axis=1)


def scores(spark_counts: list) -> dict[int, float]:
    """Classifier's probability for each kind * 1000 + vote code."""
    if not spark_counts:
        return {}
    kind = np.array([r["kind"] for r in spark_counts], np.int64)
    code = np.array([r["v"] for r in spark_counts], np.int64)
    n = np.array([r["n"] for r in spark_counts], float)
    o = np.lexsort((code, kind))
    kind, code, n = kind[o], code[o], n[o]
    v = _vote_vector(code)
    w = fit_classifier(features(kind, v), fit_labelers(kind, v, n), n)
    every = np.array(list(itertools.product(range(len(ADDED_KINDS)), range(3 ** len(LABELERS)))))
    q = 1 / (1 + np.exp(-(features(every[:, 0], _vote_vector(every[:, 1])) @ w)))
    return {int(k * 1000 + c): float(x) for (k, c), x in zip(every, q, strict=True)}


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sure: float = 0.9) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base, spans`` of every row.

    base and spans list kind:start:end (code points, end exclusive) by start and
    kind, comma-joined: the base spans, and those with the candidates added whose
    probability is ``sure`` or more. A candidate must also have a positive vote.
    NULL text counts as empty and has no spans; NULL ids are passed on; equal rows
    give equal results; an empty table gives an empty table. Only vote counts, one
    row for each kind and vote pattern at most, go to the driver.
    """
    kind = dict(docs.dtypes)[id_col]
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = cut_lineage(d.mapInArrow(_find, FOUND.format(kind)))
    counts = found.select(F.explode("cand").alias("c")).groupBy("c.kind", "c.v").agg(F.count("*").alias("n")).collect()
    keep = {k for k, p in scores(counts).items() if p >= sure and (_vote_vector(np.array([k % 1000]))[0] == 1).any()}

    def merge(batches):
        for batch in batches:
            out = []
            for base, cand in zip(batch.column("base").to_pylist(), batch.column("cand").to_pylist(), strict=True):
                spans = [(int(a), KINDS.index(k), k, int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                for c in cand:
                    if c["kind"] * 1000 + c["v"] in keep:
                        k = ADDED_KINDS[c["kind"]]
                        spans.append((c["start"], KINDS.index(k), k, c["end"]))
                out.append(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans)))
            names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(out, pa.string())], names=[*names, "spans"])

    return found.mapInArrow(merge, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
