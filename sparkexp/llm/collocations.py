"""Phrase collocations by weighted acyclic automata.

1. Each task turns its shard's sorted n-grams into count transducers, one for each
   prefix range, as it reads: what a shard holds is bounded, then it is sent on.
2. Each range unions its shards' transducers and sums their weights; phrases under
   the count limit go. One- and two-word phrases come first; a bit filter of the
   frequent two-word ones then keeps longer phrases that cannot be frequent out of
   the second pass (it errs only by letting some through, never by dropping one).
3. Each frequent phrase asks for its parts: the asked parts, routed to their ranges,
   are composed with the range's transducer, which gives their counts. Ranges asked
   often are copied to several groups.
4. Scores and the rule against phrases inside longer ones are SQL on those counts,
   in decimals.

Range borders come from a bounded sample of phrases and only balance the work. A
phrase's words are led by its language, so that languages never meet.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkexp.llm import anchors
from sparkexp.llm.anchors import U, mix
from sparkexp.llm.automata import DEPTH, Transducer, grams, keys, packed, summed, union
from sparkexp.llm.text import or_empty
from sparkexp.session import cut_lineage

# What a byte is: part of a word, a blank, or the end of a piece.
WORD, BLANK, STOP = range(3)
KIND = np.zeros(256, np.uint8)
KIND[[9, 32]] = BLANK
KIND[[*b".,;:!?", *range(10, 14)]] = STOP
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text read at a time, phrases a shard holds, and bytes of text a range.
PART_BYTES = 2 << 20
SHARD_PHRASES = 2_000_000
RANGE_BYTES = 8 << 20
#: Documents and phrases of each for the range borders.
SAMPLE_DOCS, SAMPLE_PHRASES = 2000, 32
#: Bits of the filter of frequent pairs at most (16 MB).
FILTER_BITS = 1 << 27
#: Lookups that one group of a range answers, about.
GROUP_ASKS = 200_000

_RANGE = "range int, words array<string>, automaton binary, langs array<string>, totals array<long>"
_RANGE_PA = pa.schema([("range", pa.int32()), ("words", pa.list_(pa.string())), ("automaton", pa.binary()), ("langs", pa.list_(pa.string())), ("totals", pa.list_(pa.int64()))])
_ASK = "key int, lang string, phrase string, words int, a long, i int, j int, part string"
_FOUND = "lang string, phrase string, words int, a long, i int, j int, part string, n long"
_PA = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _PA[t]) for n, t in (x.strip().split(" ") for x in ddl.split(","))])


@dataclass
class Words:
    """Words of some documents: lower-cased bytes, where each begins and ends, its
    document, whether the next word follows it in the same piece, and a hash."""

    low: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    joined: np.ndarray
    hash: np.ndarray

    @classmethod
    def of(cls, raw: np.ndarray, off: np.ndarray, lang: np.ndarray) -> Words:
        low, kind = LOWER[raw], KIND[raw]
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = kind == WORD
        edge = np.zeros(len(raw) + 1, bool)
        edge[off] = True
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        doc = np.searchsorted(off, start, side="right") - 1
        piece = np.cumsum(kind == STOP)[start] if len(start) else start
        joined = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        h = anchors.PrefixHash(anchors.BYTE_CODE[low]).of(start, end) + (end - start).astype(U)
        return cls(low, start, end, doc, joined, mix(mix(h) + lang[doc]))

    def text(self, k: int) -> str:
        return self.low[self.start[k] : self.end[k]].tobytes().decode(errors="replace")


def lang_code(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U(anchors.BASE) + b)


def equal_bytes(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether size[i] bytes of a from at[i] equal those of b from bt[i]."""
    out, step = np.ones(len(size), bool), 1 << 16
    for k in range(0, len(size), step):
        n = size[k : k + step]
        of = np.repeat(np.arange(len(n)), n)
        ramp = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        out[k + of[a[at[k : k + step][of] + ramp] != b[bt[k : k + step][of] + ramp]]] = False
    return out


class Symbols:
    """Numbers for words with their language. Hashes find them; that equal hashes are
    equal words is checked byte by byte."""

    def __init__(self):
        self.hash, self.at = np.zeros(0, U), np.zeros(0, np.int64)
        # Of each number: where its word is in the store, its length and language.
        self.store, self.start, self.size, self.lang = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.langs: dict[str, int] = {}

    def of(self, w: Words, langs: list[str]) -> np.ndarray:
        if not len(w.start):
            return np.zeros(0, np.int64)
        lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int64)[w.doc]
        size = w.end - w.start
        u, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        k = np.searchsorted(self.hash, u)
        known = np.zeros(len(u), bool)
        if len(self.hash):
            known = self.hash[np.minimum(k, len(self.hash) - 1)] == u
        ids = np.empty(len(u), np.int64)
        ids[known] = self.at[k[known]]
        new, old = first[~known], first[known]
        ids[~known] = len(self.size) + np.arange(len(new))
        rep, had = first[back], ids[known]
        fine = (size == size[rep]).all() and (lang == lang[rep]).all() and (size[old] == self.size[had]).all() and (lang[old] == self.lang[had]).all()
        fine = fine and equal_bytes(w.low, w.start, w.low, w.start[rep], size).all() and equal_bytes(w.low, w.start[old], self.store, self.start[had], size[old]).all()
        if not fine:
            return self._slowly(w, lang)
        self._add(w, lang, new)
        self.hash, self.at = np.insert(self.hash, k[~known], u[~known]), np.insert(self.at, k[~known], ids[~known])
        return ids[back]

    def _add(self, w: Words, lang: np.ndarray, new: np.ndarray) -> None:
        size = w.end[new] - w.start[new]
        ramp = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        self.start = np.concatenate([self.start, len(self.store) + np.cumsum(size) - size])
        self.store = np.concatenate([self.store, w.low[np.repeat(w.start[new], size) + ramp]])
        self.size, self.lang = np.concatenate([self.size, size]), np.concatenate([self.lang, lang[new]])

    def _slowly(self, w: Words, lang: np.ndarray) -> np.ndarray:
        """Numbers by the words themselves, for documents in which hashes collide."""
        word = lambda buf, a, n: buf[a : a + n].tobytes()
        have = {(int(x), word(self.store, a, n)): k for k, (x, a, n) in enumerate(zip(self.lang, self.start, self.size, strict=True))}
        out = np.zeros(len(w.start), np.int64)
        for k in range(len(out)):
            key = (int(lang[k]), word(w.low, w.start[k], w.end[k] - w.start[k]))
            if key not in have:
                have[key] = len(self.size)
                self._add(w, lang, np.array([k]))
            out[k] = have[key]
        return out

    def names(self) -> pa.Array:
        """Language and word of each number, with a newline between."""
        off = pa.array(np.append(self.start, len(self.store)), pa.int64())
        words = pa.Array.from_buffers(pa.large_binary(), len(self.size), [None, off.buffers()[1], pa.py_buffer(self.store.tobytes())])
        try:
            words = words.cast(pa.large_string())
        except pa.ArrowInvalid:
            words = pa.array([x.decode(errors="replace") for x in words.to_pylist()], pa.large_string())
        lang = pa.array(list(self.langs), pa.large_string()).take(pa.array(self.lang))
        return pc.binary_join_element_wise(lang, words, pa.scalar("\n", pa.large_string())).cast(pa.string())


class Shard:
    """Counts of the phrases of documents given one after the other."""

    def __init__(self, cuts: list[tuple[str, str]], pairs: np.ndarray | None):
        self.cuts, self.pairs = cuts, pairs
        self._clear()

    def _clear(self) -> None:
        self.symbols, self.parts, self.held = Symbols(), [], 0

    def add(self, raw: np.ndarray, off: np.ndarray, langs: list[str]) -> None:
        code = np.array([lang_code(x) for x in langs], U)
        w = Words.of(raw, off, code)
        if self.pairs is None:
            i = self.symbols.of(w, langs) + 1
            two = np.flatnonzero(w.joined)
            g = np.zeros((len(i) + len(two), DEPTH), np.int64)
            g[: len(i), 0] = i
            g[len(i) :, 0], g[len(i) :, 1] = i[two], i[two + 1]
        else:
            ok = np.zeros(len(w.start) + 2, bool)
            k = np.flatnonzero(w.joined)
            bit = pair_hash(w.hash[k], w.hash[k + 1]) & U(len(self.pairs) * 8 - 1)
            ok[k] = (self.pairs[(bit >> U(3)).astype(np.int64)] >> (bit & U(7)).astype(np.uint8)) & 1 > 0
            three = np.flatnonzero(ok[:-1] & ok[1:])
            four = three[ok[three + 2]]
            if not len(three):
                return
            # Only words of such phrases need a number.
            need = np.unique(np.concatenate([three, three + 1, three + 2, four + 3]))
            part = Words(w.low, w.start[need], w.end[need], w.doc[need], w.joined[:0], w.hash[need])
            i = np.zeros(len(w.start), np.int64)
            i[need] = self.symbols.of(part, langs) + 1
            g = np.zeros((len(three) + len(four), DEPTH), np.int64)
            for j in range(3):
                g[: len(three), j] = i[three + j]
            for j in range(4):
                g[len(three) :, j] = i[four + j]
        self.parts.append(summed(*keys(g), np.ones(len(g), np.int64)))
        self.held += len(self.parts[-1][0])

    def out(self) -> Iterator[tuple[int, pa.Array, bytes]]:
        """(range, words, transducer) of all that was added, which is forgotten."""
        if self.held:
            words = self.symbols.names()
            order = pc.sort_indices(words)
            words = words.take(order)
            rank = np.zeros(len(words) + 1, np.int64)
            rank[order.to_numpy() + 1] = np.arange(1, len(words) + 1)
            g = rank[np.concatenate([grams(hi, lo) for hi, lo, _ in self.parts])]
            hi, lo, n = summed(*keys(g), np.concatenate([c for *_, c in self.parts]))
            border = np.concatenate([[0], np.searchsorted(hi, np.array([self._key(words, c) for c in self.cuts], U)), [len(hi)]])
            for r in range(len(border) - 1):
                a, b = int(border[r]), int(border[r + 1])
                if a < b:
                    yield (r, *packed(words, grams(hi[a:b], lo[a:b]), n[a:b]))
        self._clear()

    @staticmethod
    def _key(words: pa.Array, cut: tuple[str, str]) -> int:
        place = lambda x: bisect_left(range(len(words)), x, key=lambda k: words[k].as_py())
        k = place(cut[0])
        same = k < len(words) and words[k].as_py() == cut[0]
        return (k + 1) << 32 | (1 + place(cut[1]) if same else 0)


def _parts(batches) -> Iterator[tuple[np.ndarray, np.ndarray, list[str]]]:
    """Runs of documents of about PART_BYTES from batches of (lang, text)."""
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        raw, off = anchors.text_bytes(batch.column("text"))
        for a, b in anchors.groups(off, PART_BYTES):
            yield raw[off[a] : off[b]], off[a : b + 1] - off[a], langs[a:b]


def _row(r: int, words: pa.Array, blob: bytes, totals: dict[str, int]) -> pa.RecordBatch:
    listed = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
    cols = [pa.array([r], pa.int32()), listed, pa.array([blob], pa.binary()), pa.array([list(totals)], pa.list_(pa.string())), pa.array([list(totals.values())], pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(cols, schema=_RANGE_PA)


def _shards(cuts, pairs):
    def run(batches):
        shard = Shard(cuts, pairs.value if pairs is not None else None)

        def rows():
            for r, words, blob in shard.out():
                yield _row(r, words, blob, {})

        for raw, off, langs in _parts(batches):
            shard.add(raw, off, langs)
            if shard.held >= SHARD_PHRASES:
                yield from rows()
        yield from rows()

    return run


def _lists(column: pa.ChunkedArray) -> list[pa.Array]:
    return [x.values for x in column]


def _unions(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        words, g, n = union(_lists(table.column("words")), table.column("automaton").to_pylist())
        single = g[:, 1] == 0
        totals: dict[str, int] = {}
        names = words.to_pylist()
        for k, x in zip(g[single, 0], n[single], strict=True):
            lang = names[k - 1].split("\n", 1)[0]
            totals[lang] = totals.get(lang, 0) + int(x)
        often = n >= min_count
        words, blob = packed(words, g[often], n[often])
        return pa.Table.from_batches([_row(table.column("range")[0].as_py(), words, blob, totals)])

    return run


def _borders(d: DataFrame, docs: int, size: int) -> list[tuple[str, str]]:
    """Borders between the ranges: quantiles of a sample of two-word phrases, the
    SAMPLE_PHRASES of the smallest hashes from each of about SAMPLE_DOCS documents."""
    ranges = -(-size // RANGE_BYTES)
    if ranges < 2:
        return []

    def run(batches):
        for raw, off, langs in _parts(batches):
            w = Words.of(raw, off, np.array([lang_code(x) for x in langs], U))
            k = np.flatnonzero(w.joined)
            h = pair_hash(w.hash[k], w.hash[k + 1])
            o = np.lexsort((h, w.doc[k]))
            k, doc = k[o], w.doc[k[o]]
            first = np.searchsorted(doc, doc)
            k = k[np.arange(len(k)) - first < SAMPLE_PHRASES]
            name = lambda i: f"{langs[w.doc[i]]}\n{w.text(i)}"
            yield pa.RecordBatch.from_arrays([pa.array([name(i) for i in k], pa.string()), pa.array([name(i + 1) for i in k], pa.string())], names=["a", "b"])

    share = int(min(1.0, SAMPLE_DOCS / max(docs, 1)) * (1 << 20))
    some = d.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share).mapInArrow(run, "a string, b string").distinct()
    # At most about SAMPLE_DOCS * SAMPLE_PHRASES short rows.
    sample = sorted((r["a"], r["b"]) for r in some.collect())
    return sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []


def _frequent_pairs(batches):
    """Hash of each two-word phrase of the ranges' transducers."""
    for batch in batches:
        for names, blob in zip(batch.column("words").to_pylist(), batch.column("automaton").to_pylist(), strict=True):
            g, _ = Transducer.unpack(blob).paths()
            g = g[g[:, 1] > 0] - 1
            split = [x.split("\n", 1) for x in names]
            raw, off = anchors.text_bytes(pa.array([x[1] for x in split], pa.string()))
            code = np.array([lang_code(x[0]) for x in split], U)
            h = anchors.PrefixHash(anchors.BYTE_CODE[raw]).of(off[:-1], off[1:]) + np.diff(off).astype(U)
            h = mix(mix(h) + code)
            yield pa.RecordBatch.from_arrays([pa.array(pair_hash(h[g[:, 0]], h[g[:, 1]]).astype(np.int64))], names=["h"])


def _filter(spark, pairs: DataFrame):
    """Broadcast bits of the pairs' hashes; at most FILTER_BITS, whatever there is."""
    n = pairs.count()
    bits = 1 << 18
    while bits < min(FILTER_BITS, 16 * n):
        bits *= 2
    place = pairs.select((F.col("h").bitwiseAND(F.lit(bits - 1))).alias("p"))
    block = place.groupBy((F.shiftright("p", 15)).alias("k")).agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("m"))
    out = np.zeros(bits // 8, np.uint8)
    for row in block.collect():  # bits / 32768 rows of 4 KB
        out[row["k"] * 4096 : (row["k"] + 1) * 4096] = np.frombuffer(row["m"], np.uint8)
    return spark.sparkContext.broadcast(out)


def _asks(cuts):
    """What each frequent phrase of two words or more wants to know."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for names, blob in zip(batch.column("words").to_pylist(), batch.column("automaton").to_pylist(), strict=True):
                g, n = Transducer.unpack(blob).paths()
                for p, a in zip(g.tolist(), n.tolist(), strict=True):
                    w = [names[k - 1] for k in p if k]
                    if len(w) < 2:
                        continue
                    lang = w[0].split("\n", 1)[0]
                    bare = [x.split("\n", 1)[1] for x in w]
                    phrase = " ".join(bare)
                    for i in range(len(w)):
                        for j in range(i + 1, len(w) + 1):
                            # Parts that a cut gives, and those long enough to be dropped.
                            if 0 < j - i < len(w) and (i == 0 or j == len(w) or j - i > 1):
                                r = bisect_right(cuts, (w[i], w[i + 1] if j > i + 1 else ""))
                                out.append((2 * r + (j - i > 2), lang, phrase, len(w), a, i, j, " ".join(bare[i:j])))
            schema = _schema(_ASK)
            cols = list(zip(*out, strict=True)) or [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return run


def _compose(asked: pa.Table, ranges: pa.Table) -> pa.Table:
    """Counts of the asked parts by a range's transducer."""
    lang, part = asked.column("lang").to_pylist(), asked.column("part").to_pylist()
    n = np.zeros(len(part), np.int64)
    for names, blob in zip(ranges.column("words").to_pylist(), ranges.column("automaton").to_pylist(), strict=True):
        rank = {x: k + 1 for k, x in enumerate(names)}
        g = np.zeros((len(part), DEPTH), np.int64)
        for row, (x, p) in enumerate(zip(lang, part, strict=True)):
            for j, w in enumerate(p.split(" ")):
                # A word that the range does not have leaves the automaton.
                g[row, j] = rank.get(f"{x}\n{w}", len(names) + 1)
        n += Transducer.unpack(blob).weights(g)
    keep = ["lang", "phrase", "words", "a", "i", "j", "part"]
    return asked.select(keep).append_column("n", pa.array(n))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, inside: int = 80, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into
    words at blanks and tabs. A candidate has two to four words and a count a of
    ``min_count`` or more. Cut after its first words it scores floor(2000000 * a /
    (l + r)) with its parts' counts l and r; its lowest cut counts, the first of
    equals. Candidates inside a longer one that has at least ``inside`` % of their
    count go. n is the language's number of words. Ranked by score, a, and phrase in
    byte order.

    NULL texts have no words; a NULL language is ``und``. Every row counts, repeated
    rows too; without frequent phrases the result is empty.
    """
    spark = docs.sparkSession
    d = docs.select(F.coalesce(F.col(f"`{lang_col}`"), F.lit("und")).alias("lang"), or_empty(F.col(f"`{text_col}`")).alias("text"))
    size = d.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    cuts = _borders(d, size["n"], size["b"])

    def counted(pairs) -> DataFrame:
        shards = d.mapInArrow(_shards(cuts, pairs), _RANGE)
        return cut_lineage(shards.groupBy("range").applyInArrow(_unions(min_count), _RANGE))

    short = counted(None)
    pairs = _filter(spark, short.mapInArrow(_frequent_pairs, "h long"))
    both = short.withColumn("key", F.col("range") * 2).union(counted(pairs).withColumn("key", F.col("range") * 2 + 1))

    asks = both.mapInArrow(_asks(cuts), _ASK)
    load = asks.groupBy("key").agg(F.ceil(F.count("*") / GROUP_ASKS).cast("int").alias("copies"))
    load = cut_lineage(load)  # one row per range
    copies = both.join(load, "key").select("key", "words", "automaton", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
    routed = asks.join(load, "key").withColumn("salt", F.pmod(F.xxhash64("lang", "phrase"), F.col("copies")).cast("int")).drop("copies")
    found = cut_lineage(routed.groupBy("key", "salt").cogroup(copies.groupBy("key", "salt")).applyInArrow(_compose, _FOUND))

    cover = found.where("j - i > 1").groupBy("lang", F.col("part").alias("phrase")).agg(F.max(F.struct("a", "n")).alias("m"))
    big = lambda c: F.col(c).cast("decimal(20,0)")
    dropped = cover.where(big("m.a") * 100 >= big("m.n") * inside).select("lang", "phrase")
    cut = found.where("i = 0 or j = words").withColumn("k", F.when(F.col("i") == 0, F.col("j")).otherwise(F.col("i")))
    cut = cut.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("i") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("i") > 0, F.col("n"))).alias("r"))
    cut = cut.withColumn("score", F.expr("CAST(a AS decimal(20,0)) * 2000000 DIV (CAST(l AS decimal(20,0)) + r)"))
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    best = best.select("lang", "phrase", "a", "m.l", "m.r", F.col("m.score").cast("long").alias("score")).join(dropped, ["lang", "phrase"], "left_anti")
    # First in slices of a language, so that no task ranks all of its phrases.
    for by in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(64))], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase"))
        best = best.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    words = short.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang")).agg(F.sum("t.totals").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
