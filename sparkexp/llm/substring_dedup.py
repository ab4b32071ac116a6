"""Substring dedup over a compacted de Bruijn graph.

Each window of k words is an edge from its first k-1 words to its last. Windows
with one anchor (see ``anchors``) follow each other without a branch, so they
travel as one compacted path: its first node and the words along it. Paths with
one seed meet; two paths share an edge only where their words agree. Edges seen
twice are repeated; neighbouring repeated edges compact into runs, and the runs
of all paths of a document are joined by their source coordinates, where
touching runs become one long repeated span, cut from the source text itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkexp.llm import anchors

SEED = 10


def _settle(at):
    """In one block: a path seen twice repeats at every place; a mark is sent."""
    if len(at) > 1:
        return list(range(len(at))), [], True
    return [], [0], False


def _edges(path: bytes, k: int) -> list[bytes]:
    """The words of each edge along a path, joined by a blank."""
    cut = [-1, *[i for i, c in enumerate(path) if c == 32], len(path)]
    return [path[cut[i] + 1 : cut[i + k]] for i in range(len(cut) - k)]


def _compare(k: int):
    def run(h, did, paths):
        times: dict[bytes, int] = {}
        of_seed: dict[int, set] = {}
        for i, p in enumerate(paths):
            times[p] = times.get(p, 0) + (2 if did[i] is None else 1)
            of_seed.setdefault(int(h[i]), set()).add(p)
        partly: dict[bytes, list[bool]] = {}
        for ps in of_seed.values():
            if len(ps) > 1:  # paths that branch off each other: edge by edge
                seen: dict[bytes, int] = {}
                along = {p: _edges(p, k) for p in ps}
                for p, edges in along.items():
                    for e in edges:
                        seen[e] = seen.get(e, 0) + times[p]
                for p, edges in along.items():
                    partly[p] = [seen[e] > 1 for e in edges]
        for i, p in enumerate(paths):
            if times[p] > 1:
                yield i, 0, p.count(b" ") + 2 - k
            elif p in partly:
                edge = np.flatnonzero(np.diff(np.r_[0, np.array(partly[p], np.int8), 0]))
                for a, b in zip(edge[::2], edge[1::2], strict=True):
                    yield i, int(a), int(b - a)

    return run


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35) -> DataFrame:
    """``doc_id, text, n_words, n_removed, starts, ends`` of every row.

    Removed is each word covered by a window of ``length`` words whose sequence
    also starts anywhere else, in the same row included; ``text`` is the kept
    words joined by one blank, ``starts`` and ``ends`` the removed runs in words.
    Equal rows repeat each other. NULL text has no words, texts under ``length``
    words stay whole, an empty table gives an empty table. ``length`` is 14 at
    least.
    """
    if length < SEED + 4:
        raise ValueError("length must be 14 words at least")
    src = anchors.sources(docs, id_col, text_col)
    found = anchors.repeated_intervals(src, anchors.Words, length, SEED, False, _settle, _compare(length))

    def cut(batches):
        for batch in batches:
            raw, off = anchors.text_bytes(batch.column("text"))
            did, found = batch.column("did").to_pylist(), batch.column("found").to_pylist()
            kept, n_words, n_removed, starts, ends = [], [], [], [], []
            for i in range(batch.num_rows):
                words = raw[off[i] : off[i + 1]].tobytes().split()
                if found[i]:
                    f = anchors.flags(len(words), did[i], found[i])
                    edge = np.flatnonzero(np.diff(np.r_[0, f.astype(np.int8), 0]))
                    left = [w for w, gone in zip(words, f.tolist(), strict=True) if not gone]
                else:
                    edge, left = np.zeros(0, np.int64), words
                kept.append(b" ".join(left).decode())
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                starts.append(edge[::2])
                ends.append(edge[1::2])
            yield pa.RecordBatch.from_arrays(
                [batch.column("did"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))],
                names=["did", "text", "n_words", "n_removed", "starts", "ends"],
            )

    out = anchors.covered(src, found).mapInArrow(
        cut, "did long, text string, n_words long, n_removed long, starts array<long>, ends array<long>"
    )
    return anchors.with_id(out)
