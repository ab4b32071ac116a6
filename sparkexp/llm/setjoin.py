"""N-gram Jaccard join by universe partitions.

Texts are sets of word shingles. Sizes fall into bands such that linked sets lie
in the same or in neighbouring bands. Linked sets in a band differ in at most H
shingles; hashing shingles into m segments, at least m - H segments agree
(pigeonhole). A set is indexed by the hashes of its segment subsets in the
schemes of its own band and of the next one. Where sets are so small that
subsets would hardly tell texts apart, the scheme has half as many segments and
also indexes each subset's one-deletion neighbourhood; a cost estimate per band
decides. Subset schemes have spare segments, which lets every set leave out its
most frequent subsets (passages that many texts share) without losing a link.

Equal sets count as one class throughout, numbered by 64 bits of the set that are
checked against 64 others. Classes that share a signature are
candidates. Links only matter for reachability, so candidates are verified in two
rounds: with the smallest class they share most signatures with, and then, where a
signature's classes are still in several components, in groups: a class and all that
share such a signature of which it is the smallest. A task gets two blocks of a
group, of bounded size, counts all common shingles at once and passes on the links
between components; candidate pairs are never rows. Every pair that shares a
signature is verified or already connected.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkexp.llm import anchors
from sparkexp.llm.anchors import U, mix
from sparkexp.llm.components import components
from sparkexp.session import cut_lineage

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Of the distinct segment values a candidate costs as much as this many rows.
EMPTY_COST = 100.0


class Rule:
    """Bands and schemes for 100 * |intersection| >= percent * |union|."""

    def __init__(self, percent: int, n: int):
        if not 50 <= percent <= 100 or n < 1:
            raise ValueError("percent must be 50 to 100 and n positive")
        self.percent, self.n = percent, n
        self.low = [1]

    def band(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, -(-self.low[-1] * 100 // self.percent)))
        return int(np.searchsorted(self.low, size, side="right")) - 1

    @lru_cache(maxsize=None)
    def scheme(self, band: int) -> tuple[int, int, bool]:
        """Segments, how many subsets a set may leave out, one-deletion or not."""
        while len(self.low) <= band + 1:
            self.band(self.low[-1])
        size = self.low[band + 1] - 1
        h = (100 - self.percent) * 2 * size // (100 + self.percent)
        if h == 0:
            return 0, 0, False  # only equal sets link
        spare = -(-(h + 1) // 4)
        m = h + 1 + spare
        subsets = m + EMPTY_COST * m * math.exp(-size / m)
        half = -(-(h + 1) // 2)
        deletions = half + size + EMPTY_COST * half * math.exp(-size / half)
        return (m, spare, False) if subsets <= deletions else (half, 0, True)


def shingle_sets(batch: pa.RecordBatch, n: int):
    """Sorted distinct shingle hashes of every text: values, offsets."""
    raw, off = anchors.text_bytes(batch.column("text"))
    raw = _LOWER[raw]
    vals, sizes = [np.zeros(0, U)], []
    for a, b in anchors.groups(off):
        w, woff, _ = anchors.Words.split(raw[off[a] : off[b]], off[a : b + 1] - off[a])
        count = np.diff(woff)
        # With fewer than n words the whole sequence is the one shingle.
        length = np.minimum(count, n)
        per = np.where(count > 0, count - length + 1, 0)
        total = int(per.sum())
        start = np.repeat(woff[:-1] - (np.cumsum(per) - per), per) + np.arange(total)
        doc = np.repeat(np.arange(b - a), per)
        p = anchors.PrefixHash(w)
        ln = length[doc]
        h = mix(p.of(start, start + ln) + ln.astype(U))
        o = np.lexsort((h, doc))
        h, doc = h[o], doc[o]
        keep = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if total else np.zeros(0, bool)
        vals.append(h[keep])
        sizes.append(np.bincount(doc[keep], minlength=b - a))
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    return np.concatenate(vals), np.append(0, np.cumsum(sizes)).astype(np.int64)


def fingerprints(vals: np.ndarray, off: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers of each set, whatever the order: sums of two mixes."""
    out = []
    for salt in (0x51ED270B35B1C2A7 + seed, 0x2545F4914F6CDD1D):
        c = np.append(U(0), np.cumsum(mix(vals ^ U(salt)) if len(vals) else vals))
        out.append(mix((c[off[1:]] - c[off[:-1]]) + np.diff(off).astype(U)).view(np.int64))
    return out[0], out[1]


def signatures(sets: np.ndarray, rule: Rule, band: int) -> tuple[np.ndarray, int]:
    """Signatures of one set in the scheme of ``band`` and how many empty
    segments were left out. Of a signature six bytes count (see ``anchors.pack``);
    their lowest bit is the band's parity."""
    m, spare, deletions = rule.scheme(band)
    if not m:
        return np.zeros(0, U), 0
    seg = ((sets >> U(32)) % U(m)).astype(np.int64)
    c = mix(sets)
    total = np.zeros(m, U)
    np.add.at(total, seg, c)
    count = np.bincount(seg, minlength=m)
    tag = mix(np.arange(m, dtype=U) * U(0x9E3779B97F4A7C15) + U(band + 1))
    sig = mix(total + tag + count.astype(U))
    empty = 0
    if deletions:
        sig = np.concatenate([sig, mix((total[seg] - c) + tag[seg] + (count[seg] - 1).astype(U))])
    else:
        # One order for all sets, or linked ones could leave out all they share:
        # empty segments first, as many as may go, then (``_keep_rare``) frequent ones.
        gone = np.flatnonzero(count == 0)[:spare]
        empty = len(gone)
        sig = np.delete(sig, gone)
    return np.unique((sig >> U(17) << U(17)) | U((band & 1) << 16)), empty


def _describe(n: int, seed: int):
    def run(batches):
        for batch in batches:
            vals, off = shingle_sets(batch, n)
            f1, f2 = fingerprints(vals, off, seed)
            yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("rid"), pa.array(np.diff(off)), pa.array(f1), pa.array(f2)], names=["did", "rid", "size", "cls", "check"])

    return run


def _class_signatures(rule: Rule, seed: int):
    def extract(batch):
        vals, off = shingle_sets(batch, rule.n)
        cls, _ = fingerprints(vals, off, seed)
        first = np.unique(cls, return_index=True)[1]  # equal sets count once in a block
        hs, ds = [np.zeros(0, U)], [np.zeros(0, np.int64)]
        for i in first:
            own = vals[off[i] : off[i + 1]]
            if len(own):
                b = rule.band(len(own))
                for scheme in (b, b + 1):
                    h, _ = signatures(own, rule, scheme)
                    hs.append(h)
                    ds.append(np.full(len(h), i))
        return np.concatenate(hs), np.concatenate(ds), None, cls

    return extract


def _keep_rare(rule: Rule):
    """Leave out each set's most frequent signatures, as many as its scheme has
    to spare; empty segments went first, in every set (see ``signatures``)."""

    def run(batches):
        for batch in batches:
            out_c, out_s, out_n = [], [], []
            cols = [batch.column(c).to_pylist() for c in ("cls", "size", "empty0", "empty1", "sigs", "freqs")]
            for cls, size, e0, e1, sigs, freqs in zip(*cols, strict=True):
                sigs, freqs = np.array(sigs, np.int64).view(U), np.array(freqs, np.int64)
                b = rule.band(size)
                for scheme, empty in ((b, e0), (b + 1, e1)):
                    mine = (sigs >> U(16) & U(1)) == U(scheme & 1)
                    drop = rule.scheme(scheme)[1] - empty
                    kept = sigs[mine][np.lexsort((sigs[mine], -freqs[mine]))[max(0, drop) :]]
                    out_s.append(kept.view(np.int64))
                    out_c += [cls] * len(kept)
                    out_n += [size] * len(kept)
            sig = np.concatenate(out_s) if out_s else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(out_c, pa.int64()), pa.array(sig), pa.array(out_n, pa.int64())], names=["cls", "sig", "size"])

    return run


def _linked(percent: int, n: int):
    """Pairs whose sets, made anew from the texts, link. Sizes alone rule most of
    the others out."""

    def run(batches):
        for batch in batches:
            sets = []
            for side in ("x", "y"):
                text = [pa.decompress(z, k, codec="zstd", asbytes=True) for z, k in zip(batch.column(side).to_pylist(), batch.column(f"{side}_len").to_pylist(), strict=True)]
                vals, off = shingle_sets(pa.RecordBatch.from_arrays([pa.array(text, pa.binary()).cast(pa.string())], names=["text"]), n)
                sets.append([vals[a:b] for a, b in zip(off[:-1], off[1:], strict=True)])
            ok = []
            for x, y in zip(*sets, strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["v", "u"]).filter(pa.array(ok, pa.bool_()))

    return run


def _verify(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs u, v whose sets link."""
    side = lambda c, name: sets.select(F.col("cls").alias(c), F.col("size").alias(f"{name}_size"), F.col("z").alias(name), F.col("len").alias(f"{name}_len"))
    j = pairs.select("u", "v").join(side("u", "x"), "u")
    j = j.join(side("v", "y"), "v")
    fits = (F.col("x_size") * 100 >= F.col("y_size") * rule.percent) & (F.col("y_size") * 100 >= F.col("x_size") * rule.percent)
    return j.where(fits).mapInArrow(_linked(rule.percent, rule.n), "v long, u long").select("u", "v")


def _components(edges: DataFrame) -> DataFrame:
    return cut_lineage(components(edges).select(F.col("node").alias("cls"), F.col("label").alias("comp")))


def _with_comp(k: DataFrame, comp: DataFrame, cls: str, out: str) -> DataFrame:
    c = comp.select(F.col("cls").alias("_c"), F.col("comp").alias(out))
    j = k.join(c, F.col(cls) == F.col("_c"), "left").drop("_c")
    return j.withColumn(out, F.coalesce(out, cls))


def link_classes(src: DataFrame, described: DataFrame, rule: Rule, seed: int) -> DataFrame:
    """cls, comp for every class of equal sets that links with another."""
    seeds = anchors.shared_seeds(src, _class_signatures(rule, seed), True).select(F.col("rid").alias("cls"), "a")
    # Each class's signatures once, then how many classes have each.
    own = seeds.groupBy("cls").agg(F.collect_list("a").alias("a")).mapInArrow(_distinct_seeds, "cls long, sig long")
    own = cut_lineage(own)
    freq = own.groupBy("sig").agg(F.count("*").alias("freq")).where("freq > 1")
    shared = cut_lineage(own.join(freq, "sig").groupBy("cls").agg(F.collect_list("sig").alias("sigs"), F.collect_list("freq").alias("freqs")))
    # The text of one row stands for its class, compressed before it is shuffled.
    rep = described.groupBy("cls").agg(F.min(F.struct("did", "rid")).alias("r")).join(shared.select("cls"), "cls")
    rep = rep.select("cls", F.col("r.did").alias("r_did"), F.col("r.rid").alias("r_rid"))
    z = src.mapInArrow(_compressed, "did long, rid long, z binary, len long")
    texts = z.join(rep, (F.col("did") == F.col("r_did")) & (F.col("rid") == F.col("r_rid"))).select("cls", "z", "len")
    sets = cut_lineage(texts.mapInArrow(_sets(rule), "cls long, size long, empty0 long, empty1 long, z binary, len long").dropDuplicates(["cls"]))

    per_class = shared.join(sets.select("cls", "size", "empty0", "empty1"), "cls")
    k = cut_lineage(per_class.mapInArrow(_keep_rare(rule), "cls long, sig long, size long"))

    star = k.groupBy("sig").agg(F.min("cls").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    hub = k.join(star, "sig").where("cls <> v").groupBy(F.col("cls").alias("u"), "v").agg(F.count("*").alias("n"))
    hub = cut_lineage(hub)
    best = hub.groupBy("u").agg(F.max(F.struct("n", "v")).alias("b")).select("u", F.col("b.v").alias("v"))
    e1 = cut_lineage(_verify(best, sets, rule))
    comp = _components(e1)
    # Signatures whose classes are still in several components. A class and those it is
    # the smallest of in such signatures are a group: every pair that shares one is in one.
    kc = _with_comp(k, comp, "cls", "comp")
    open_ = kc.groupBy("sig").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.min("cls").alias("v")).where("a <> b").select("sig", "v")
    group = cut_lineage(kc.join(open_, "sig").groupBy("v", "cls", "size", "comp").agg(F.lit(1)).select("v", "cls", "size", "comp"))
    return _components(e1.union(_verify_groups(group, sets, rule)))


#: Classes and shingles of a block; two blocks meet in a task.
BLOCK_CLASSES, BLOCK_SHINGLES = 2000, 1 << 20


def _verify_groups(group: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links u, v between classes of one group (v, cls, size, comp) and different
    components: as many as connect what links connect. Groups are cut into blocks of
    bounded size; all pairs of blocks are compared, but only links are passed on."""
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("size") / BLOCK_SHINGLES))
    plan = group.groupBy("v").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), blocks.cast("int").alias("blocks")).where("a <> b").select("v", "blocks")
    g = group.join(plan, "v").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    g = g.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    g = g.select("v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "cls", "comp")
    g = g.join(sets.select("cls", "z", "len"), "cls")
    return g.groupBy("v", "i", "j").applyInArrow(_block_links(rule), "u long, v long")


def common(sets: list[np.ndarray], often: int = 32) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets. Values of few sets count pair by
    pair, the others by a product of their incidence matrix, some columns at a time."""
    n = len(sets)
    out = np.zeros((n, n))
    who = np.repeat(np.arange(n), [len(x) for x in sets])
    vals, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    o = np.argsort(at, kind="stable")
    begin = np.cumsum(df) - df
    for c in range(2, min(often, n) + 1):
        rows = who[o[begin[df == c][:, None] + np.arange(c)]]
        for x in range(c):
            np.add.at(out, (np.repeat(rows[:, x], c), rows.ravel()), 1)
    many = np.flatnonzero(df > often)
    for a in range(0, len(many), 4096):
        part = many[a : a + 4096]
        x = np.zeros((n, len(part)), np.float32)
        size = df[part]
        of = np.repeat(np.arange(len(part)), size)
        x[who[o[np.repeat(begin[part] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]], of] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _block_links(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        cls, comp, own = (table.column(c).to_numpy() for c in ("cls", "comp", "own"))
        text = [pa.decompress(z, k, codec="zstd", asbytes=True) for z, k in zip(table.column("z").to_pylist(), table.column("len").to_pylist(), strict=True)]
        vals, off = shingle_sets(pa.RecordBatch.from_arrays([pa.array(text, pa.binary()).cast(pa.string())], names=["text"]), rule.n)
        both = common([vals[a:b] for a, b in zip(off[:-1], off[1:], strict=True)])
        size = np.diff(off)
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        linked = 100 * both >= rule.percent * (size[:, None] + size[None, :] - both)
        linked &= comp[:, None] != comp[None, :]
        if i != j:
            linked &= own[:, None] != own[None, :]
        x, y = np.nonzero(np.triu(linked, 1))
        # One link for each pair of components, and none that others make needless.
        label, at = np.unique(comp, return_inverse=True)
        low, high = np.minimum(at[x], at[y]), np.maximum(at[x], at[y])
        first = np.unique(low * len(label) + high, return_index=True)[1]
        root = list(range(len(label)))

        def find(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        keep = []
        for k in first:
            a, b = find(low[k]), find(high[k])
            if a != b:
                root[a] = b
                keep.append(k)
        return pa.table({"u": pa.array(cls[x[keep]], pa.int64()), "v": pa.array(cls[y[keep]], pa.int64())})

    return run


def _distinct_seeds(batches):
    for batch in batches:
        own = [np.unique(anchors.unpack(b"".join(x))) for x in batch.column("a").to_pylist()]
        sig = np.concatenate(own) if own else np.zeros(0, U)
        cls = np.repeat(np.asarray(batch.column("cls"), dtype=np.int64), [len(x) for x in own])
        yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(sig.view(np.int64))], names=["cls", "sig"])


def _compressed(batches):
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
        z = [pa.compress(t, codec="zstd", asbytes=True) for t in raw]
        yield pa.RecordBatch.from_arrays([batch.column("did"), batch.column("rid"), pa.array(z, pa.binary()), pa.array([len(t) for t in raw], pa.int64())], names=["did", "rid", "z", "len"])


def _sets(rule: Rule):
    """Size of each class's set and the empty segments in its two schemes."""

    def run(batches):
        for batch in batches:
            text = [pa.decompress(z, k, codec="zstd", asbytes=True) for z, k in zip(batch.column("z").to_pylist(), batch.column("len").to_pylist(), strict=True)]
            vals, off = shingle_sets(pa.RecordBatch.from_arrays([pa.array(text, pa.binary()).cast(pa.string())], names=["text"]), rule.n)
            size, empty = np.diff(off), []
            for i, s in enumerate(size.tolist()):
                b = rule.band(s) if s else 0
                empty.append([signatures(vals[off[i] : off[i + 1]], rule, x)[1] if s else 0 for x in (b, b + 1)])
            e = np.array(empty, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(size), pa.array(e[:, 0]), pa.array(e[:, 1]), batch.column("z"), batch.column("len")], names=["cls", "size", "empty0", "empty1", "z", "len"])

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85) -> DataFrame:
    """``did, rid, n_shingles, component_id, comp`` per row: component_id is the
    smallest id reachable by links, the row's own included; comp numbers the linked
    rows, also where ids repeat or are NULL (rows without shingles share one).

    Two rows link when 100 * |intersection| >= ``percent`` * |union| of their sets
    of ``n``-word shingles (ASCII-lower-cased; a shorter text is one shingle).
    NULL, empty and space-only texts have no shingles and link with nothing. did
    is the id; NULL becomes 2**63 - 1, the largest. rid is a hash of id and text,
    see ``anchors.sources``. Equal rows stay as many as they were. An empty table
    gives an empty table; other columns are ignored.
    """
    rule = Rule(percent, n)
    src = anchors.sources(docs, id_col, text_col)
    seed = 0
    while True:
        d = cut_lineage(src.mapInArrow(_describe(n, seed), "did long, rid long, size long, cls long, check long"))
        # Two different sets with one class number: number the classes anew.
        mixed = d.groupBy("cls").agg(F.min("check").alias("a"), F.max("check").alias("b")).where("a <> b")
        if not mixed.limit(1).count():
            break
        seed += 1
    comp = link_classes(src, d.drop("check"), rule, seed)
    d = _with_comp(d, comp, "cls", "comp")
    low = d.groupBy("comp").agg(F.min("did").alias("low"))
    j = d.join(low, "comp")
    own = F.when(F.col("size") == 0, F.col("did")).otherwise(F.col("low"))
    return j.select("did", "rid", F.col("size").alias("n_shingles"), own.alias("component_id"), "comp")
