"""Windows of k tokens that occur more than once, found by sampled anchors.

A token is a byte or a word. Every window of k tokens elects one anchor: the
m-token seed in it with the smallest hash, leftmost on ties. Equal windows elect
the same seed at the same place, so only windows whose seed occurs elsewhere can
repeat. Consecutive windows with one anchor form a span; spans, not windows,
travel. The steps:

1. ``seeds``: per block of rows, each distinct seed is sent once to a hash bucket.
   A seed that is already shared inside the block is reported for its rows at
   once and sent without rows, so a seed that a third of all rows hold costs one
   entry per block.
2. the buckets report back the seeds that also occur elsewhere, one entry per
   bucket and group of rows; the groups put them together, row by row;
3. ``spans``: rows with such seeds send the spans around them to the seed's
   bucket, again once per block and distinct text;
4. the caller's function compares the spans of each bucket, token by token, and
   reports token intervals: one entry per bucket and group of rows, in which each
   row's touching intervals are one;
5. the groups of rows put the intervals of all buckets together, row by row.

Blocks are Arrow batches of one task; a block's outcome does not depend on how
rows are batched, only the amount of traffic does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkexp.llm.text import or_empty

U = np.uint64
# Odd multipliers of the polynomial hash and the final mixer; any would do.
BASE = 0xC2B2AE3D27D4EB4F
MIXER = 0xD6E8FEB86659FD93
#: Tokens hashed at a time, so that the arrays stay in the processor's cache.
GROUP = 1 << 16
#: Ids that are NULL come after all others.
NO_ID = (1 << 63) - 1

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_pow: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_pow[0]) < n:
        size = max(n, GROUP * 2)
        for j, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            p = np.full(size, U(b))
            p[0] = 1
            _pow[j] = np.multiply.accumulate(p)
    return _pow[0][:n], _pow[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x *= U(MIXER)
    x ^= x >> U(29)
    return x


class PrefixHash:
    """Polynomial hashes of any range of a token array from prefix sums."""

    def __init__(self, tokens: np.ndarray):
        n = len(tokens)
        up, self.down = powers(n + 1)
        self.pre = np.zeros(n + 1, U)
        np.cumsum(tokens * up[:n], out=self.pre[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.pre[end] - self.pre[start]) * self.down[start]

    def rolling(self, m: int) -> np.ndarray:
        return (self.pre[m:] - self.pre[:-m]) * self.down[: len(self.pre) - m]


def elect(tokens: np.ndarray, offsets: np.ndarray, k: int, m: int):
    """Spans of the documents at ``offsets``: (seed hash, first window, number of
    windows, document) per span, in order."""
    empty = np.zeros(0, np.int64)
    n_win = np.maximum(np.diff(offsets) - k + 1, 0)
    total = int(n_win.sum())
    if not total:
        return np.zeros(0, U), empty, empty, empty
    seed = mix(PrefixHash(tokens).rolling(m))
    bits = U(max(1, len(seed).bit_length()))
    # The place in the low bits: the smallest key is the leftmost smallest hash.
    key = ((seed >> bits) << bits) | np.arange(len(seed), dtype=U)
    w, have, low = k - m + 1, 1, key
    while have * 2 <= w:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < w:
        low = np.minimum(low[: len(key) - w + 1], low[w - have :])
    start = np.repeat(offsets[:-1] - (np.cumsum(n_win) - n_win), n_win) + np.arange(total)
    place = (low[start] & ((U(1) << bits) - U(1))).astype(np.int64)
    cut = np.flatnonzero(np.diff(place, prepend=-1))
    first = start[cut]
    return seed[place[cut]], first, np.diff(np.append(cut, total)), np.searchsorted(offsets, first, side="right") - 1


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 offsets of a string column; NULL is empty."""
    col = pc.fill_null(col, "").cast(pa.large_binary())
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def groups(offsets: np.ndarray, size: int = GROUP) -> Iterator[tuple[int, int]]:
    """Runs of documents [a, b) with about ``size`` units, one at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


class Bytes:
    """Every byte is a token."""

    @staticmethod
    def split(raw: np.ndarray, off: np.ndarray):
        return BYTE_CODE[raw], off, None

    @staticmethod
    def span(raw, places, a, b) -> bytes:
        return raw[a:b].tobytes()


class Words:
    """Maximal runs of bytes other than the six ASCII spaces are tokens."""

    SPACE = np.zeros(256, bool)
    SPACE[[32, 9, 10, 11, 12, 13]] = True

    @classmethod
    def split(cls, raw: np.ndarray, off: np.ndarray):
        inside = np.zeros(len(raw) + 2, bool)
        inside[1:-1] = ~cls.SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[off] = True
        start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
        end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
        h = mix(PrefixHash(BYTE_CODE[raw]).of(start, end) + (end - start).astype(U))
        return h, np.searchsorted(start, off), (start, end)

    @staticmethod
    def span(raw, places, a, b) -> bytes:
        start, end = places
        whole = raw[start[a] : end[b - 1]].tobytes()
        return b" ".join(whole.split())


def sources(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """did, rid, text: did is the id (NULL last), and (did, rid) tells rows apart
    unless id and text are equal, in which case they share their results."""
    i, t = F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")
    return docs.select(F.coalesce(i, F.lit(NO_ID)).alias("did"), F.xxhash64(i, or_empty(t)).alias("rid"), t.alias("text"))


def with_id(df: DataFrame) -> DataFrame:
    """``did`` turned back into ``doc_id``."""
    return df.withColumn("did", F.nullif("did", F.lit(NO_ID))).withColumnRenamed("did", "doc_id")


def bucket_count(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ragged(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Binary column of the slices of ``values`` at ``cuts``."""
    return pa.array([values[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())


def pack(h: np.ndarray) -> bytes:
    """The upper six bytes of every hash: enough to rule seeds out."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpack(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(b, np.uint8).reshape(-1, 6)
    return out.view(U).ravel()


SEED_ROWS = "bucket int, did long, rid long, h binary, d binary, dids binary, rids binary"


def window_seeds(tokens, k: int, m: int):
    """Per batch: seed hash and row of every span, and the rows' keys. Here rid
    alone is the key: rows that share it by chance only get more candidates."""

    def extract(batch):
        raw, off = text_bytes(batch.column("text"))
        hs, ds = [np.zeros(0, U)], [np.zeros(0, np.int64)]
        for a, b in groups(off):
            tok, toff, _ = tokens.split(raw[off[a] : off[b]], off[a : b + 1] - off[a])
            h, _, _, doc = elect(tok, toff, k, m)
            hs.append(h)
            ds.append(doc + a)
        return np.concatenate(hs), np.concatenate(ds), None, np.asarray(batch.column("rid"), dtype=np.int64)

    return extract


def _seed_rows(extract: Callable, n_buckets: int, by_row: bool):
    """by_row: a seed must occur in two rows, not just twice."""
    schema = pa.schema([("bucket", pa.int32()), ("did", pa.int64()), ("rid", pa.int64()), *[(c, pa.binary()) for c in ("h", "d", "dids", "rids")]])

    def run(batches):
        for batch in batches:
            h, d, dids, rids = extract(batch)
            wide = dids is not None
            dids = dids if wide else np.zeros(len(rids), np.int64)
            o = np.lexsort((d, h))
            h, d = h[o] >> U(16) << U(16), d[o]
            if by_row and len(h):  # a row's own repeats do not count
                keep = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])]
                h, d = h[keep], d[keep]
            if not len(h):
                continue
            new = np.r_[True, h[1:] != h[:-1]]
            size = np.diff(np.append(np.flatnonzero(new), len(h)))
            shared = np.repeat(size > 1, size)
            # Seeds shared in this block: their rows are told at once.
            sd, sh = d[shared], h[shared]
            o = np.lexsort((sh, sd))
            sd, sh = sd[o], sh[o]
            if len(sd):
                keep = np.r_[True, (sh[1:] != sh[:-1]) | (sd[1:] != sd[:-1])]
                sd, sh = sd[keep], sh[keep]
                cut = np.append(np.flatnonzero(np.r_[True, sd[1:] != sd[:-1]]), len(sd))
                who = sd[cut[:-1]]
                none = pa.nulls(len(who), pa.binary())
                spread = (np.abs(rids[who]) % n_buckets).astype(np.int32)
                packed = pa.array([pack(sh[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(spread), pa.array(dids[who]), pa.array(rids[who]), packed, none, none, none], schema=schema)
            # One entry for each seed; -1: shared already.
            eh, ed = h[new], np.where(shared[new], -1, d[new]).astype(np.int32)
            bucket = (eh >> U(33)) % U(n_buckets)
            o = np.argsort(bucket, kind="stable")
            eh, ed, bucket = eh[o], ed[o], bucket[o]
            cut = np.append(np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]), len(eh))
            rows = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                used, at = np.unique(ed[a:b], return_inverse=True)
                known = used[used >= 0]
                at = at - (len(used) - len(known))
                small = at.astype(np.int16 if len(known) < 1 << 15 else np.int32)
                rows.append((int(bucket[a]), pack(eh[a:b]), small.tobytes(), dids[known].tobytes() if wide else b"", rids[known].tobytes()))
            cols = list(zip(*rows, strict=True))
            none = pa.nulls(len(rows), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), none, none, *[pa.array(c, pa.binary()) for c in cols[1:]]], schema=schema)

    return run


def _by_row(did: np.ndarray, rid: np.ndarray, *values: np.ndarray) -> pa.Table:
    """One output row for each (did, rid), with the values as binaries."""
    o = np.lexsort((rid, did))
    did, rid = did[o], rid[o]
    cut = np.flatnonzero(np.r_[True, (did[1:] != did[:-1]) | (rid[1:] != rid[:-1])]) if len(did) else np.zeros(0, np.int64)
    ends = np.append(cut, len(did))
    return pa.table([pa.array(did[cut]), pa.array(rid[cut]), *[_ragged(v[o], ends) for v in values]], names=["did", "rid", *"abc"[: len(values)]])


def _shared_seeds(n_buckets: int):
    """Of one bucket: the seeds that occur in another row or twice, one entry per
    group of rows. One row's entries, which only come from several blocks if rows
    are equal, count one by one."""

    def run(table: pa.Table) -> pa.Table:
        told = table.filter(pc.is_valid(table["rid"]))
        rest = table.filter(pc.is_null(table["rid"]))
        size = np.array([len(x) // 6 for x in told["h"].to_pylist()], np.int64)
        out = [(unpack(b"".join(told["h"].to_pylist())), *(np.repeat(told[c].to_numpy(), size) for c in ("did", "rid")))]
        hs, did, rid, here = [], [], [], []
        for h, d, dids, rids in zip(*(rest[c].to_pylist() for c in ("h", "d", "dids", "rids")), strict=True):
            h = unpack(h)
            d = np.frombuffer(d, np.int16 if len(d) == 2 * len(h) else np.int32).astype(np.int64)
            rids = np.append(np.frombuffer(rids, np.int64), 0)
            dids = np.append(np.frombuffer(dids, np.int64), 0) if dids else np.zeros(len(rids), np.int64)
            hs.append(h)
            did.append(dids[d])
            rid.append(rids[d])
            here.append(d >= 0)
        if hs:
            h, did, rid, here = map(np.concatenate, (hs, did, rid, here))
            _, inv, n = np.unique(h, return_inverse=True, return_counts=True)
            hot = (n[inv] > 1) & here
            out.append((h[hot], did[hot], rid[hot]))
        h, did, rid = map(np.concatenate, zip(*out, strict=True))
        o = np.lexsort((rid, did))
        h, did, rid = h[o], did[o].astype(np.int64), rid[o].astype(np.int64)
        rows = [(group, *keys, pack(h[part])) for group, part, keys in _deal(did, rid, n_buckets)]
        return pa.Table.from_pylist([dict(zip(_DEALT_SCHEMA.names, r, strict=True)) for r in rows], schema=_DEALT_SCHEMA)

    return run


def _gather_seeds(table: pa.Table) -> pa.Table:
    """The seeds of all buckets in one group of rows, row by row."""
    rows = table.to_pylist()
    did, rid = map(np.concatenate, zip(*map(_unpack_keys, rows), strict=True))
    t = _by_row(did, rid, unpack(b"".join(x["a"] for x in rows)))
    return t.set_column(2, "a", pa.array([pack(np.frombuffer(x, U)) for x in t["a"].to_pylist()], pa.binary()))


SPAN_ROWS = "bucket int, n int, did binary, rid binary, at binary, a binary, b binary, h binary, lens binary, spans binary"
DEALT = "bucket int, n int, did binary, rid binary, at binary, a binary"
PACKED = f"{DEALT}, b binary"
INTERVALS = "did long, rid long, a binary, b binary"
_SPAN_SCHEMA = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), *[(c, pa.binary()) for c in ("did", "rid", "at", "a", "b", "h", "lens", "spans")]])
_PACKED_SCHEMA = pa.schema(list(_SPAN_SCHEMA)[:7])
_DEALT_SCHEMA = pa.schema(list(_SPAN_SCHEMA)[:6])
#: First word of a span that stands for spans settled in their block.
MARK = -1


def squeeze(x: np.ndarray) -> bytes:
    """Numbers, their lowest bytes first, then the next ones, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()
    return pa.compress(planes, codec="zstd", asbytes=True)


def unsqueeze(z: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(z, n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, n).T).view(kind).ravel()


def _pack_keys(row: np.ndarray, dids: np.ndarray, rids: np.ndarray) -> list:
    """Cells n, did, rid, at: the key of each row once, and whose each entry is."""
    used, at = np.unique(row, return_inverse=True)
    return [len(row), squeeze(dids[used]), rids[used].tobytes(), squeeze(np.diff(at, prepend=0).astype(np.int32))]


def _unpack_keys(x: dict) -> tuple[np.ndarray, np.ndarray]:
    rid = np.frombuffer(x["rid"], np.int64)
    at = np.cumsum(unsqueeze(x["at"], x["n"], np.int32))
    return unsqueeze(x["did"], len(rid), np.int64)[at], rid[at]


def _deal(did: np.ndarray, rid: np.ndarray, n_buckets: int):
    """Entries, sorted by row, dealt to groups of rows: per group its number, its
    entries and the cells of their keys."""
    group = rid % n_buckets
    o = np.argsort(group, kind="stable")
    for part in np.split(o, np.flatnonzero(np.diff(group[o])) + 1) if len(o) else []:
        d, r = did[part], rid[part]
        new = np.r_[True, (d[1:] != d[:-1]) | (r[1:] != r[:-1])]
        yield int(group[part[0]]), part, _pack_keys(np.cumsum(new) - 1, d[new], r[new])


def _unpack_intervals(x: dict) -> tuple[np.ndarray, ...]:
    did, rid = _unpack_keys(x)
    a = unsqueeze(x["a"], x["n"], np.int32)
    return did, rid, a, a + unsqueeze(x["b"], x["n"], np.int32)


def merged(did: np.ndarray, rid: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
    """The intervals by row, touching ones of a row as one."""
    if not len(did):
        return did, rid, a, b
    o = np.lexsort((a, rid, did))
    did, rid, a, b = did[o], rid[o], a[o].astype(np.int64), b[o].astype(np.int64)
    row = np.cumsum(np.r_[False, (did[1:] != did[:-1]) | (rid[1:] != rid[:-1])]) << 32
    end = np.maximum.accumulate(row + b)
    new = np.flatnonzero(np.r_[True, (row + a)[1:] > end[:-1]])
    return did[new], rid[new], a[new], end[np.append(new[1:], len(end)) - 1] - row[new]


def _pack_intervals(found: list[tuple], n_buckets: int) -> pa.Table:
    """Intervals dealt to the groups of rows, one entry for each."""
    rows = []
    if found:
        did, rid, a, b = merged(*map(np.concatenate, zip(*found, strict=True)))
        for group, part, keys in _deal(did, rid, n_buckets):
            rows.append((group, *keys, squeeze(a[part].astype(np.int32)), squeeze((b - a)[part].astype(np.int32))))
    return pa.Table.from_pylist([dict(zip(_PACKED_SCHEMA.names, r, strict=True)) for r in rows], schema=_PACKED_SCHEMA)


def _gather(table: pa.Table) -> pa.Table:
    """The intervals of all buckets in one group of rows, row by row."""
    did, rid, a, b = merged(*map(np.concatenate, zip(*map(_unpack_intervals, table.to_pylist()), strict=True)))
    return _by_row(did, rid, a.astype(np.int32), b.astype(np.int32))


def _span_rows(tokens, k: int, m: int, n_buckets: int, settle: Callable):
    """``settle(places)`` decides what one block knows about equal spans: from a
    list of (did, ...) it returns (indices that repeat for sure, indices to send,
    whether to send a mark that stands for all of them)."""

    def run(batches):
        for batch in batches:
            raw, off = text_bytes(batch.column("text"))
            dids, rids = (np.asarray(batch.column(c), dtype=np.int64) for c in ("did", "rid"))
            shared = batch.column("shared").to_pylist()
            seen: dict[bytes, list] = {}
            for a, b in groups(off):
                part = raw[off[a] : off[b]]
                tok, toff, places = tokens.split(part, off[a : b + 1] - off[a])
                h, first, n, doc = elect(tok, toff, k, m)
                edge = np.searchsorted(doc, np.arange(b - a + 1))
                for i in range(b - a):
                    x, y = edge[i], edge[i + 1]
                    if x == y:
                        continue
                    wanted = unpack(b"".join(shared[a + i]))
                    for j in np.flatnonzero(np.isin(h[x:y] >> U(16) << U(16), wanted)) + x:
                        f = int(first[j])
                        span = tokens.span(part, places, f, f + int(n[j]) + k - 1)
                        seen.setdefault(span, []).append((a + i, f - int(toff[i]), int(n[j]), int(h[j])))
            sure, send = [], []
            for span, at in seen.items():
                known, rest, mark = settle([(dids[x[0]], *x) for x in at])
                sure += [at[j] for j in known]
                send += [(at[j], span) for j in rest]
                if mark:
                    send.append(((at[0][0], MARK, *at[0][2:]), span))
            if sure:
                x = np.array([x[:3] for x in sure], np.int64)
                places = [*_pack_keys(x[:, 0], dids, rids), squeeze(x[:, 1].astype(np.int32))]
                yield row(int(rids[x[0, 0]]) % n_buckets, places, squeeze((x[:, 2] + k - 1).astype(np.int32)), b"", b"", b"")
            h = np.array([x[3] for x, _ in send], U)
            bucket = (h >> U(33)) % U(n_buckets)
            order = np.argsort(bucket, kind="stable")
            cut = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1))
            for part in np.split(order, cut[1:]) if len(order) else []:
                x = np.array([send[j][0][:2] for j in part], np.int64)
                spans = [send[j][1] for j in part]
                lens = np.array([len(z) for z in spans], np.int32)
                # In a bucket 32 bits tell seeds apart; the spans are compared anyway.
                low = h[part].astype(np.uint32)
                places = [*_pack_keys(x[:, 0], dids, rids), squeeze(x[:, 1].astype(np.int32))]
                yield row(int(bucket[part[0]]), places, None, low.tobytes(), squeeze(lens), pa.compress(b"".join(spans), codec="zstd", asbytes=True))

    def row(bucket, places, *rest):
        cells = [bucket, *places, *rest]
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(cells, _SPAN_SCHEMA, strict=True)], schema=_SPAN_SCHEMA)

    return run


def shared_seeds(src: DataFrame, extract: Callable, by_row: bool) -> DataFrame:
    """did, rid, a: per row its seeds (see ``pack``) that occur elsewhere too, if
    it has any."""
    n = bucket_count(src)
    seeds = src.mapInArrow(_seed_rows(extract, n, by_row), SEED_ROWS)
    dealt = seeds.groupBy("bucket").applyInArrow(_shared_seeds(n), DEALT)
    return dealt.groupBy("bucket").applyInArrow(_gather_seeds, "did long, rid long, a binary")


def _join(src: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """On rid only, so that the shuffle of the texts is the same in every join and
    Spark does it once."""
    return src.join(other.withColumnRenamed("rid", "o_rid"), F.col("rid") == F.col("o_rid"), how).drop("o_rid")


def repeated_intervals(src: DataFrame, tokens, k: int, m: int, by_row: bool, settle: Callable, compare: Callable) -> DataFrame:
    """did, rid, a, b: lists of token intervals [a, b) (int32 binaries) that
    repeated windows cover, per row of ``src`` that has any.

    ``compare(h, did, spans)`` gets the spans of one bucket (did None: a mark) and
    yields (index, first window, number of windows) of what repeats.
    """
    n_buckets = bucket_count(src)
    shared = shared_seeds(src, window_seeds(tokens, k, m), by_row).groupBy("rid").agg(F.collect_list("a").alias("shared"))
    spans = _join(src, shared).mapInArrow(_span_rows(tokens, k, m, n_buckets, settle), SPAN_ROWS)

    def bucket(table: pa.Table) -> pa.Table:
        out, h, did, rid, first, texts = [], [], [], [], [], []
        for x in table.to_pylist():
            if x["b"] is not None:
                out.append(_unpack_intervals(x))
                continue
            d, r = _unpack_keys(x)
            a = unsqueeze(x["a"], x["n"], np.int32)
            lens = unsqueeze(x["lens"], x["n"], np.int32)
            data = pa.decompress(x["spans"], int(lens.sum()), codec="zstd", asbytes=True)
            cut = np.cumsum(lens).tolist()
            texts += [data[i:j] for i, j in zip([0, *cut], cut, strict=False)]
            h.append(np.frombuffer(x["h"], np.uint32))
            did.append(d)
            rid.append(r)
            first.append(a)
        if h:
            h, did, rid, first = map(np.concatenate, (h, did, rid, first))
            owner = [None if f == MARK else d for d, f in zip(did.tolist(), first.tolist(), strict=True)]
            got = [x for x in compare(h, owner, texts) if owner[x[0]] is not None]
            if got:
                g = np.array(got, np.int64)
                at = first[g[:, 0]] + g[:, 1]
                out.append((did[g[:, 0]], rid[g[:, 0]], at, at + g[:, 2] + k - 1))
        return _pack_intervals(out, n_buckets)

    return spans.groupBy("bucket").applyInArrow(bucket, PACKED).groupBy("bucket").applyInArrow(_gather, INTERVALS)


def covered(src: DataFrame, intervals: DataFrame) -> DataFrame:
    """did, rid, text, found of every row of ``src``: its intervals joined back as
    a list of (did, a, b), NULL without any."""
    per_row = intervals.groupBy("rid").agg(F.collect_list(F.struct("did", "a", "b")).alias("found"))
    return _join(src, per_row, "left")


def flags(n: int, did: int, found: list[dict] | None) -> np.ndarray:
    """Which of the n tokens of row ``did`` the intervals cover."""
    own = [x for x in found or [] if x["did"] == did]
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.frombuffer(b"".join(x["a"] for x in own), np.int32), 1)
    np.add.at(step, np.frombuffer(b"".join(x["b"] for x in own), np.int32), -1)
    return np.cumsum(step[:-1]) > 0
