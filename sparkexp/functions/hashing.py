"""Seeded, engine-independent pseudo-random numbers.

u = first 8 hex digits of md5('seed|k1|k2...') / 2^32. Spark and DuckDB both
compute it exactly, so splits, folds, samples and bootstrap weights can be
repeated by the SQL oracle. (A hash of the key, not a generator state, so the
value of a row never depends on partitioning or task retries.)
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _key(seed: int, *cols: Column | str) -> Column:
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.concat_ws("|", *parts)


def seeded_hash32(seed: int, *cols: Column | str) -> Column:
    """Integer in [0, 2^32) from md5 of the seeded key."""
    return F.conv(F.substring(F.md5(_key(seed, *cols)), 1, 8), 16, 10).cast("bigint")


def seeded_uniform(seed: int, *cols: Column | str) -> Column:
    return seeded_hash32(seed, *cols) / F.lit(TWO_32)


def seeded_hash32_sql(seed: int, *cols: str) -> str:
    """The same value in DuckDB SQL."""
    key = " || '|' || ".join([f"'{seed}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT)"


def seeded_uniform_sql(seed: int, *cols: str) -> str:
    return f"({seeded_hash32_sql(seed, *cols)} / {TWO_32!r})"


def poisson1_cdf(kmax: int = 16) -> list[float]:
    """CDF of Poisson(1) at 0..kmax, computed from its rule e^-1 * sum 1/i!."""
    out, acc = [], 0.0
    for k in range(kmax + 1):
        acc += 1.0 / math.factorial(k)
        out.append(math.exp(-1.0) * acc)
    return out


# ---------------------------------------------------------------- vectorised 32-bit hash
# For per-(row, replicate) draws a cryptographic hash per pair is too slow.
# The "lowbias32" integer mixer (C. Wellons, public domain) is a bijection on
# 32-bit integers with full avalanche; NumPy evaluates it on whole weight
# matrices and DuckDB repeats it with UBIGINT arithmetic.
# Mixer multipliers and the replicate salt constant.
MIX_A = 0x7FEB352D
MIX_B = 0x846CA68B
REP_SALT = 0x9E3779B9
MASK32 = 0xFFFFFFFF


def h32_np(x):
    """lowbias32 on a NumPy uint64 array holding 32-bit values."""
    import numpy as np

    x = np.asarray(x, dtype=np.uint64)
    x = ((x ^ (x >> np.uint64(16))) * np.uint64(MIX_A)) & np.uint64(MASK32)
    x = ((x ^ (x >> np.uint64(15))) * np.uint64(MIX_B)) & np.uint64(MASK32)
    return x ^ (x >> np.uint64(16))


def row_base_np(seed: int, ids):
    """Per-row hash base from a seed and int64 ids (two's-complement words)."""
    import numpy as np

    ids = np.asarray(ids, dtype=np.int64)
    low = (ids & np.int64(MASK32)).astype(np.uint64)
    high = ((ids >> np.int64(32)) & np.int64(MASK32)).astype(np.uint64)
    s = h32_np(np.uint64(seed & MASK32))
    return h32_np(h32_np(low ^ s) ^ high)


def rep_salt_np(n_rep: int):
    import numpy as np

    return h32_np(np.arange(n_rep, dtype=np.uint64) ^ np.uint64(REP_SALT))


def poisson1_weights_np(seed: int, ids, n_rep: int, kmax: int = 16):
    """rows x replicates matrix of Poisson(1) weights."""
    import numpy as np

    return poisson1_counts_np(row_base_np(seed, ids), rep_salt_np(n_rep), kmax).T.astype(np.int64)


def poisson1_counts_np(base, salts, kmax: int = 16):
    """Poisson(1) weights as bytes, one row per replicate: the number of CDF values that
    the pair's hash / 2^32 reaches, compared as whole numbers (the product is exact)."""
    import numpy as np

    steps = [math.ceil(c * TWO_32) for c in poisson1_cdf(kmax)]
    steps = np.array([s for s in steps if s <= MASK32], np.uint32)
    h = np.asarray(salts, np.uint32)[:, None] ^ np.asarray(base, np.uint32)[None, :]
    for shift, factor in ((16, MIX_A), (15, MIX_B)):  # lowbias32; products wrap at 32 bits
        h ^= h >> np.uint32(shift)
        h *= np.uint32(factor)
    h ^= h >> np.uint32(16)
    w = np.zeros(h.shape, np.uint8)
    for s in steps[:4]:
        w += h >= s
    rare = np.flatnonzero(w.ravel() == 4)
    w.ravel()[rare] = np.searchsorted(steps, h.ravel()[rare], side="right")
    return w


def h32_sql_stages(src: str, out: str) -> list[str]:
    """DuckDB expressions computing lowbias32 of column ``src`` in stages
    (each refers to the previous), ending in column ``out``."""
    a, b = f"{out}_m1", f"{out}_m2"
    return [
        f"(xor({src}, {src} >> 16) * {MIX_A}::UBIGINT) & {MASK32}::UBIGINT AS {a}",
        f"(xor({a}, {a} >> 15) * {MIX_B}::UBIGINT) & {MASK32}::UBIGINT AS {b}",
        f"xor({b}, {b} >> 16) AS {out}",
    ]
