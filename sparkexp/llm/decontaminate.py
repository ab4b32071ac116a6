"""Benchmark decontamination.

Words are runs of letters and digits in lower case, so punctuation and case
do not hide a copy. One pass over the corpus finds every n-gram of every item,
however common, and cuts out the passage around each. Passages with too few of
the item's words to reach its score in any order go; the others are scored
against the item by Smith-Waterman alignment of words, which also finds
paraphrased and edited copies. No text is shuffled.

Benchmark items are sent to the tasks in slices of bounded size; a larger
benchmark takes more slices, each with its own pass.
"""

from __future__ import annotations

from functools import reduce
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkexp.llm import anchors
from sparkexp.llm.anchors import U, mix
from sparkexp.llm.text import or_empty

# Letters and digits: ASCII ones in lower case, and all bytes of longer characters.
_CODE = np.zeros(256, np.uint8)
for _a, _b in ((48, 58), (97, 123), (128, 256)):
    _CODE[_a:_b] = np.arange(_a, _b)
_CODE[65:91] = np.arange(97, 123)

MATCH, MISMATCH, GAP = 2, -1, -1
#: Benchmark text sent to the tasks at a time.
SLICE_BYTES = 16 << 20
#: Words of passages looked at together.
PART_WORDS = 1 << 20


def word_hashes(raw: np.ndarray, off: np.ndarray):
    """Word hashes of documents and the words' offsets."""
    low = _CODE[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = low > 0
    edge = np.zeros(len(raw) + 1, bool)
    edge[off] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    h = mix(anchors.PrefixHash(anchors.BYTE_CODE[low]).of(start, end) + (end - start).astype(U))
    return h, np.searchsorted(start, off)


def smith_waterman(items: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair of rows and the passage word it ends at
    (exclusive). Rows are padded with 0 (items) and 1 (passages). One step per
    item word over all pairs; gaps along the passage are a running maximum."""
    c, n = passages.shape
    prev = np.zeros((c, n + 1), np.int32)
    best, at = np.zeros(c, np.int32), np.zeros(c, np.int64)
    slope = np.arange(n + 1, dtype=np.int32) * -GAP
    for i in range(items.shape[1]):
        hit = passages == items[:, i : i + 1]
        row = np.zeros((c, n + 1), np.int32)
        row[:, 1:] = np.maximum(prev[:, :-1] + np.where(hit, MATCH, MISMATCH), prev[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        high = row.max(axis=1)
        better = high > best
        at = np.where(better, row.argmax(axis=1), at)
        best = np.maximum(best, high)
        prev = row
    return best, at


class Benchmark:
    """Items of one slice, ready to be sent: word hashes and n-grams."""

    def __init__(self, texts: list[str], n: int):
        raw, off = anchors.text_bytes(pa.array(texts, pa.string()))
        self.words, self.off = word_hashes(raw, off)
        self.n = n
        ln = np.diff(self.off)
        per = np.maximum(ln - n + 1, 0)
        self.item = np.repeat(np.arange(len(texts)), per)
        start = np.repeat(self.off[:-1] - (np.cumsum(per) - per), per) + np.arange(per.sum())
        self.at = start - self.off[self.item]
        gram = anchors.PrefixHash(self.words).of(start, start + n) if len(start) else np.zeros(0, U)
        self.grams, self.gram = np.unique(gram, return_inverse=True)
        # Words of agreement that count as a copy, as an alignment score.
        self.need = MATCH * np.minimum(np.minimum(13, np.maximum(8, 0.4 * ln)), 0.8 * ln)

        o = np.argsort(self.gram, kind="stable")
        self.s_gram, self.s_item, self.s_at = self.gram[o], self.item[o], self.at[o]
        # Every (item, word) once, as item * vocabulary + word, and how often it is there.
        self.vocab, word = np.unique(self.words, return_inverse=True)
        self.item_word, self.times = np.unique(np.repeat(np.arange(len(texts)), ln) * np.int64(len(self.vocab)) + word, return_counts=True)

    def possible(self, part, w):
        """Whether each passage (document, item, from, to) has enough of its item's
        words for an alignment that counts, whatever their order."""
        _, t, a, b = np.array(part, np.int64).reshape(-1, 4).T
        which = np.repeat(np.arange(len(t)), b - a)
        word = w[np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())]
        v = np.minimum(np.searchsorted(self.vocab, word), len(self.vocab) - 1)
        key = t[which] * np.int64(len(self.vocab)) + v
        k = np.minimum(np.searchsorted(self.item_word, key), len(self.item_word) - 1)
        in_item = (self.vocab[v] == word) & (self.item_word[k] == key)
        pair, n = np.unique(which[in_item] * np.int64(len(self.item_word)) + k[in_item], return_counts=True)
        most = np.bincount(pair // len(self.item_word), np.minimum(n, self.times[pair % len(self.item_word)]), len(t))
        return MATCH * most >= self.need[t]

    def hits(self, raw, off):
        """(document, word position, n-gram) of every benchmark n-gram, the words
        and their offsets, over a group of documents."""
        w, woff = word_hashes(raw, off)
        n = self.n
        if len(w) < n or not len(self.grams):
            z = np.zeros(0, np.int64)
            return z, z, z, w, woff
        h = anchors.PrefixHash(w).rolling(n)
        g = np.searchsorted(self.grams, h)
        g[g == len(self.grams)] = 0
        pos = np.flatnonzero(self.grams[g] == h)
        doc = np.searchsorted(woff, pos, side="right") - 1
        ok = pos + n <= woff[doc + 1]
        return doc[ok], pos[ok], g[pos[ok]], w, woff


def _align(bench: Benchmark, slack: int):
    def candidates(doc, pos, g, woff):
        """Passages (document, item, from, to) around the n-grams, merged where
        they overlap."""
        lo = np.searchsorted(bench.s_gram, g)
        n = np.searchsorted(bench.s_gram, g, side="right") - lo
        rep = np.repeat(np.arange(len(g)), n)
        k = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item, shift, d = bench.s_item[k], pos[rep] - bench.s_at[k], doc[rep]
        ln = bench.off[item + 1] - bench.off[item]
        reach = slack + ln // 4
        a, b = np.maximum(shift - reach, woff[d]), np.minimum(shift + ln + reach, woff[d + 1])
        o = np.lexsort((a, item, d))
        d, item, a, b = d[o], item[o], a[o], b[o]
        i = 0
        while i < len(d):
            j, end = i + 1, b[i]
            while j < len(d) and d[j] == d[i] and item[j] == item[i] and a[j] <= end:
                end = max(end, b[j])
                j += 1
            yield int(d[i]), int(item[i]), int(a[i]), int(end)
            i = j

    def parts(found, most):
        """At most so many passages at a time, and not many more than PART_WORDS words."""
        part, size = [], 0
        for x in found:
            part.append(x)
            size += x[3] - x[2]
            if len(part) == most or size > PART_WORDS:
                yield part
                part, size = [], 0
        if part:
            yield part

    def score(part, w):
        items = [bench.words[bench.off[t] : bench.off[t + 1]] for _, t, _, _ in part]
        passages = [w[a:b] for _, _, a, b in part]
        pad = lambda xs, v: np.array([np.pad(x, (0, m - len(x)), constant_values=v) for x in xs]) if (m := max(map(len, xs))) else None
        best, end = smith_waterman(pad(items, 0), pad(passages, 1))
        need = bench.need[[t for _, t, _, _ in part]]
        found = np.flatnonzero((best >= need) & (best > 0))
        if len(found):
            # Backwards from the end, the best alignment ends where it began.
            back = [passages[i][: end[i]][::-1] for i in found]
            _, start = smith_waterman(pad([items[i][::-1] for i in found], 0), pad(back, 1))
            for i, s in zip(found, start, strict=True):
                yield part[i], int(best[i]), int(end[i] - s), int(end[i])

    def run(batches):
        for batch in batches:
            raw, off = anchors.text_bytes(batch.column("text"))
            out: dict[tuple[int, int], tuple] = {}
            for a, b in anchors.groups(off):
                doc, pos, g, w, woff = bench.hits(raw[off[a] : off[b]], off[a : b + 1] - off[a])
                todo = []
                for part in parts(candidates(doc, pos, g, woff), 4096):
                    todo += compress(part, bench.possible(part, w))
                todo.sort(key=lambda x: x[3] - x[2])
                for part in parts(todo, 256):
                    for (d, t, lo, _), s, x, y in score(part, w):
                        key = (a + d, t)
                        if key not in out or out[key][0] < s:
                            out[key] = (s, int(lo - woff[d] + x), int(lo - woff[d] + y))
            rows = [k for k in out]
            ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, batch.column("th").take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.int64()),
                    pa.array([out[r][0] for r in rows], pa.int64()), pa.array([out[r][1] for r in rows], pa.int64()), pa.array([out[r][2] for r in rows], pa.int64()),
                ],
                names=["doc_id", "th", "item", "score", "start_word", "end_word"],
            )

    return run


def _one_slice(d: DataFrame, items: DataFrame, n: int, slack: int) -> DataFrame:
    rows = items.select("item_id", "text").collect()  # bounded by SLICE_BYTES
    bench = Benchmark([r["text"] for r in rows], n)
    kind = d.schema["doc_id"].dataType.simpleString()
    found = d.mapInArrow(_align(bench, slack), f"doc_id {kind}, th long, item long, score long, start_word long, end_word long")
    schema = T.StructType([T.StructField("item", T.LongType()), items.schema["item_id"], T.StructField("item_words", T.LongType())])
    words = np.diff(bench.off)
    names = d.sparkSession.createDataFrame([(i, r["item_id"], int(words[i])) for i, r in enumerate(rows)], schema)
    return found.join(F.broadcast(names), "item").select(
        "doc_id", "th", "item_id", "score", (F.col("score") / (MATCH * F.col("item_words"))).alias("share"), "start_word", "end_word"
    )


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", n: int = 4, slack: int = 4, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """``doc_id, th, item_id, score, share, start_word, end_word`` for every row of
    ``docs`` and benchmark item that it copies.

    ``score`` is the best alignment (2 a matching word, -1 a mismatch or gap),
    ``share`` that score over the item's own, the words are those of the aligned
    passage. A copy has a score of 2 * min(13, max(8, 0.4 * words), 0.8 * words)
    at least, words being the item's. th is a hash of the text. Items of fewer
    than ``n`` words and NULL texts match nothing; NULL ids are passed on; equal
    rows give equal results; empty tables give an empty table.
    """
    d = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    d = d.select("doc_id", F.lower("text").alias("text"), F.xxhash64(or_empty(F.col("text"))).alias("th"))
    b = items.select(F.col(f"`{item_id_col}`").alias("item_id"), F.lower(F.col(f"`{item_text_col}`")).alias("text")).where("text is not null")
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    longest = b.agg(F.max(F.octet_length("text"))).first()[0] or 0
    if longest > slice_bytes:
        raise ValueError("a single benchmark item exceeds slice_bytes")
    slices = max(1, -(-2 * size // slice_bytes))
    part = F.pmod(F.xxhash64("text"), F.lit(slices))
    return reduce(DataFrame.unionByName, [_one_slice(d, b.where(part == i), n, slack) for i in range(slices)])
