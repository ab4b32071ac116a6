"""Weighted acyclic automata over words, as arrays.

A ``Transducer`` reads a phrase word by word and gives its count. Words are
positive ranks in a sorted word list. It is built from sorted phrases: phrases
with a common beginning share its arcs, and states with equal arcs (word, weight,
target) are one state, level by level from the ends, so that common endings are
shared as well. ``paths`` lists its phrases, ``weights`` is the composition with a
list of phrases (the acceptor), and ``union`` adds several up.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sparkexp.llm.anchors import MIXER, PrefixHash, U, mix

#: Longest phrase. Two words' ranks fill a 64-bit key.
DEPTH = 4
_EMPTY = np.zeros(0, np.int64)


def keys(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases (rows of ranks, 0 after the end) as two 64-bit keys, in their order."""
    g = grams.astype(U)
    return g[:, 0] << U(32) | g[:, 1], g[:, 2] << U(32) | g[:, 3]


def grams(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    low = U(0xFFFFFFFF)
    return np.stack([hi >> U(32), hi & low, lo >> U(32), lo & low], axis=1).astype(np.int64)


def summed(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(hi):
        return hi, lo, n
    o = np.lexsort((lo, hi)) if lo.any() else np.argsort(hi, kind="stable")
    hi, lo, n = hi[o], lo[o], n[o]
    cut = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
    return hi[cut], lo[cut], np.add.reduceat(n, cut)


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for each run."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Transducer:
    """Per level: ``first`` (where each state's arcs begin, and the end), and the
    arcs' ``word``, ``weight`` (0: no phrase ends here) and ``target`` (-1: none)."""

    def __init__(self, levels: list[tuple[np.ndarray, ...]]):
        self.levels = levels

    @classmethod
    def build(cls, g: np.ndarray, weight: np.ndarray) -> Transducer:
        """From sorted distinct phrases."""
        changed = np.ones((len(g), DEPTH), bool)
        if len(g):
            changed[1:] = np.logical_or.accumulate(g[1:] != g[:-1], axis=1)
        at = [np.flatnonzero(changed[:, j] & (g[:, j] > 0)) for j in range(DEPTH)]
        levels: list[tuple[np.ndarray, ...]] = []
        state_of = np.full(len(at[-1]), -1)
        for j in range(DEPTH - 1, -1, -1):
            rows = at[j]
            ends = g[rows, j + 1] == 0 if j + 1 < DEPTH else np.ones(len(rows), bool)
            arcs = [g[rows, j], np.where(ends, weight[rows], 0), state_of]
            # The arc before each state, one level up; level 0 has one state.
            parent = np.searchsorted(at[j - 1], rows, side="right") - 1 if j else np.zeros(len(rows), np.int64)
            begin = np.flatnonzero(np.diff(parent, prepend=-1)) if len(rows) else _EMPTY
            size = np.diff(np.append(begin, len(rows)))
            state = cls._merge(arcs, begin, size) if j else np.zeros(len(begin), np.int64)
            own, keep = np.unique(state, return_index=True)
            take = _spread(begin[keep], size[keep])
            levels.append((np.concatenate([[0], np.cumsum(size[keep])]), *[a[take] for a in arcs]))
            if j:
                state_of = np.full(len(at[j - 1]), -1)
                state_of[parent[begin]] = np.searchsorted(own, state)
        return cls(levels[::-1])

    @staticmethod
    def _merge(arcs: list[np.ndarray], begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """A state for each run of arcs; runs with equal arcs have the same."""
        if not len(begin):
            return _EMPTY
        token = np.zeros(len(arcs[0]), U)
        for a in arcs:
            token = mix(token * U(MIXER) + (a + 1).astype(U))
        sign = PrefixHash(token).of(begin, begin + size)
        _, keep, state = np.unique(sign, return_index=True, return_inverse=True)
        other = keep[state]
        same = size == size[other]
        rest = np.flatnonzero(same)
        x, y = _spread(begin[rest], size[rest]), _spread(begin[other[rest]], size[rest])
        equal = np.logical_and.reduce([a[x] == a[y] for a in arcs])
        bad = np.bincount(np.repeat(rest, size[rest])[~equal], minlength=len(begin)) > 0
        alone = np.flatnonzero(~same | bad)  # equal hashes, other arcs
        state[alone] = len(keep) + np.arange(len(alone))
        return state

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """All phrases, in order, and their weights."""
        found, counts = [], []
        state, head = np.zeros(min(1, len(self.levels[0][0]) - 1), np.int64), np.zeros((1, DEPTH), np.int64)
        for j, (first, word, weight, target) in enumerate(self.levels):
            size = first[state + 1] - first[state]
            arc = _spread(first[state], size)
            head = np.repeat(head[: len(state)], size, axis=0)
            head[:, j] = word[arc]
            ends = weight[arc] > 0
            found.append(head[ends])
            counts.append(weight[arc][ends])
            on = target[arc] >= 0
            state, head = target[arc][on], head[on]
        g = np.concatenate(found)
        o = np.lexsort(g.T[::-1])
        return g[o], np.concatenate(counts)[o]

    def weights(self, g: np.ndarray) -> np.ndarray:
        """Weight of each phrase; 0 if it has none."""
        out, state, live = np.zeros(len(g), np.int64), np.zeros(len(g), np.int64), np.arange(len(g))
        for j, (first, word, weight, target) in enumerate(self.levels):
            if not len(live) or not len(word):
                break
            of = np.repeat(np.arange(len(first) - 1), np.diff(first)).astype(U) << U(32) | word.astype(U)
            want = state[live].astype(U) << U(32) | g[live, j].astype(U)
            k = np.minimum(np.searchsorted(of, want), len(of) - 1)
            hit = of[k] == want
            last = g[live, j + 1] == 0 if j + 1 < DEPTH else np.ones(len(live), bool)
            out[live[hit & last]] = weight[k[hit & last]]
            go = hit & ~last & (target[k] >= 0)
            live, k = live[go], k[go]
            state[live] = target[k]
        return out

    def pack(self) -> bytes:
        def narrow(a):
            a = a + 1
            top = int(a.max()) if len(a) else 0
            return a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))

        raw = pickle.dumps([[narrow(a) for a in level] for level in self.levels])
        return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)

    @classmethod
    def unpack(cls, b: bytes) -> Transducer:
        raw = pa.decompress(b[8:], int.from_bytes(b[:8], "little"), codec="zstd", asbytes=True)
        return cls([tuple(a.astype(np.int64) - 1 for a in level) for level in pickle.loads(raw)])


def packed(words: pa.Array, g: np.ndarray, weight: np.ndarray) -> tuple[pa.Array, bytes]:
    """The words that sorted phrases use, and their transducer over these."""
    used = np.unique(g)
    used = used[used > 0]
    small = np.where(g > 0, np.searchsorted(used, g) + 1, 0)
    return words.take(pa.array(used - 1)), Transducer.build(small, weight).pack()


def union(words: Sequence[pa.Array], blobs: Sequence[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Sorted word list, sorted phrases and summed weights of several transducers,
    each with its own word list."""
    coded = pa.chunked_array([w.cast(pa.string()) for w in words], pa.string()).combine_chunks()
    coded = (coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.zeros(len(order) + 1, np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hi, lo, n = [np.zeros(0, U)], [np.zeros(0, U)], [_EMPTY]
    begin = 0
    for w, b in zip(words, blobs, strict=True):
        g, k = Transducer.unpack(b).paths()
        own = np.concatenate([[0], rank[at[begin : begin + len(w)]]])
        begin += len(w)
        a, c = keys(own[g])
        hi.append(a)
        lo.append(c)
        n.append(k)
    h, c, k = summed(np.concatenate(hi), np.concatenate(lo), np.concatenate(n))
    return coded.dictionary.take(pa.array(order)), grams(h, c), k
