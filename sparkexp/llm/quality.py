"""Quality rules: fixed base rules and robust multivariate outliers.

Counts per document are array expressions on the row itself, so no word is
shuffled. Documents that pass the base rules are described by four transformed
statistics; a minimum covariance determinant (MCD) estimate per language and
source gives each a robust Mahalanobis distance, and documents beyond the
cutoff are rejected. Groups too small for an estimate take that of their whole
language, and languages too small for one that of all documents.

The MCD is found by concentration steps: start from medians and median absolute
deviations, then repeatedly re-estimate mean and covariance from the ``support``
share of the group with the smallest distances. The share is cut on a fixed
logarithmic grid of distances (bin counts per group), so a group that holds a
third of all rows is only ever summed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkexp.llm.text import lines, or_empty, strip_space, with_words
from sparkexp.session import cut_lineage

STATS = ["x0", "x1", "x2", "x3"]
P = len(STATS)
#: Smallest standard deviation taken for each statistic: a group in which most
#: documents agree exactly must not reject a document for one symbol more.
FLOORS = [0.5, 0.15, 0.05, 0.2]


def base_counts(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` as struct ``row`` plus n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words. NULL text counts as empty: all zero."""
    text = or_empty(F.col(f"`{text_col}`"))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), text.alias("text"))
    d = with_words(d, "text", "words")
    filled = F.filter(lines(F.col("text")), lambda x: strip_space(x) != "")
    d = d.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        filled.alias("filled"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("wh"),
    )
    d = d.withColumn("n_dup_lines", (F.size("filled") - F.size(F.array_distinct("filled"))).cast("long")).drop("filled")
    at = lambda i, k: F.get("wh", i + k)
    windows = F.transform(
        F.slice("wh", F.lit(1), F.greatest(F.size("wh") - 4, F.lit(0))),
        lambda x, i: F.xxhash64(x, at(i, 1), at(i, 2), at(i, 3), at(i, 4)),
    )
    d = d.withColumn("win", windows).drop("wh")
    d = d.withColumn("repeats", F.size("win") > F.size(F.array_distinct("win")))
    # Only documents with a repeated window pay for sorting their windows.
    marked = F.sort_array(F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("marked", F.when(F.col("repeats"), marked)).drop("win")
    like = lambda x, k: F.coalesce(F.get("marked", k)["h"] == x["h"], F.lit(False))
    twice = F.filter("marked", lambda x, k: like(x, k - 1) | like(x, k + 1))
    d = d.withColumn("starts", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("marked")
    covered = F.aggregate(
        "starts", F.struct(F.lit(0).alias("n"), F.lit(-5).alias("last")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(5), s - a["last"])).alias("n"), s.alias("last")),
    )["n"]
    return d.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def statistics() -> list[Column]:
    """Transformed statistics: log length, log mean word length, symbol share and
    repetition share on a square-root scale."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return [
        F.log(n), F.log(chars / n), F.sqrt(F.col("n_symbols") / chars),
        F.sqrt((F.col("n_repeat_words") + F.col("n_dup_lines")) / n),
    ]


def _chi2_cdf(x: float, dof: int) -> float:
    """For even dof: one minus a finite Poisson sum."""
    return 1.0 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dof // 2))


def chi2_quantile(p: float, dof: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, dof) < p else (lo, mid)
    return hi


def _cholesky(est: DataFrame) -> DataFrame:
    """Adds l_ij, the Cholesky factor of the covariance columns c_ij."""
    for i in range(P):
        for j in range(i + 1):
            s = F.col(f"c_{i}_{j}")
            for k in range(j):
                s = s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            est = est.withColumn(f"l_{i}_{j}", F.sqrt(s) if i == j else s / F.col(f"l_{j}_{j}"))
    return est


def _same(keys: list[str]) -> Column:
    """Null-safe equality of the keys with those named e_ and the key."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"e_{k}")) for k in keys])


def _other(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"e_{k}" for k in keys})


def _distances(x: DataFrame, est: DataFrame, keys: list[str]) -> DataFrame:
    """x joined to its group's estimate, with squared distance ``d2``: forward
    substitution with the Cholesky factor. No estimate: NULL."""
    e = est.select(*keys, *[f"m_{i}" for i in range(P)], *[f"l_{i}_{j}" for i in range(P) for j in range(i + 1)])
    j = x.join(_other(e, keys), _same(keys), "left")
    for i in range(P):
        z = F.col(STATS[i]) - F.col(f"m_{i}")
        for k in range(i):
            z = z - F.col(f"l_{i}_{k}") * F.col(f"z_{k}")
        j = j.withColumn(f"z_{i}", z / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(1, P)), F.col("z_0") * F.col("z_0"))
    return j.select(*x.columns, d2.alias("d2"))


def fit_levels(x: DataFrame, min_rows: int) -> DataFrame:
    """Per (lang, source) of ``x``: ``level``, whose estimate its documents take (0 its own,
    1 its language's, 2 that of all, NULL none as all are under ``min_rows``), and
    ``pools``, which of 1 and 2 its documents are needed for."""
    n = x.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_lang = n.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    total = by_lang.agg(F.sum("n_lang").alias("n_all"), F.min("n_lang").alias("least_lang"))
    g = n.join(_other(by_lang, ["lang"]), _same(["lang"])).crossJoin(F.broadcast(total))  # one row
    level = F.when(F.col("n") >= min_rows, 0).when(F.col("n_lang") >= min_rows, 1).when(F.col("n_all") >= min_rows, 2)
    one, two = (F.col("least") < min_rows) & (F.col("n_lang") >= min_rows), (F.col("least_lang") < min_rows) & (F.col("n_all") >= min_rows)
    pools = F.filter(F.array(F.when(one, 1), F.when(two, 2)), lambda k: k.isNotNull())
    return cut_lineage(g.select("lang", "source", level.alias("level"), pools.alias("pools")))


def _at_level(level: Column) -> list[Column]:
    """Keys of the estimate of a row's language and source at a level."""
    return [F.when(level < 2, F.col("lang")).alias("lang"), F.when(level < 1, F.col("source")).alias("source"), level.alias("level")]


def fit_mcd(x: DataFrame, support: float = 0.75, steps: int = 4, min_rows: int = 40, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Robust mean and Cholesky factor per ``keys`` of ``x`` (columns ``keys``,
    x0..x3). Groups with fewer than ``min_rows`` rows get none.
    """
    keys = list(keys)
    med = x.groupBy(*keys).agg(F.count("*").alias("n"), *[F.percentile_approx(s, 0.5, 10_000).alias(f"m_{i}") for i, s in enumerate(STATS)])
    med = _other(med.where(F.col("n") >= min_rows), keys)
    same = _same(keys)
    dev = x.join(med, same).groupBy(*keys).agg(
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in range(P)],
        *[F.percentile_approx(F.abs(F.col(s) - F.col(f"m_{i}")), 0.5, 10_000).alias(f"a_{i}") for i, s in enumerate(STATS)],
    )
    # 1.4826 makes the median absolute deviation a normal standard deviation.
    for i in range(P):
        for k in range(i + 1):
            c = F.pow(1.4826 * F.col(f"a_{i}"), 2) + FLOORS[i] ** 2 if i == k else F.lit(0.0)
            dev = dev.withColumn(f"c_{i}_{k}", c)
    est = cut_lineage(_cholesky(dev))
    # Consistency of a covariance taken from the central `support` of a normal.
    scale = support / _chi2_cdf(chi2_quantile(support, P), P + 2)
    for _ in range(steps):
        d = _distances(x, est, keys).where(F.col("d2").isNotNull())
        d = d.withColumn("bin", F.floor(64 * F.log2(F.greatest("d2", F.lit(1e-6)))))
        bins = d.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
        run = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin"))
        total = F.sum("n").over(Window.partitionBy(*keys))
        cut = bins.withColumn("run", run).withColumn("total", total).where(F.col("run") >= support * F.col("total"))
        cut = _other(cut.groupBy(*keys).agg(F.min("bin").alias("cut")), keys)
        core = d.join(cut, same).where(F.col("bin") <= F.col("cut"))
        agg = core.groupBy(*keys).agg(
            *[F.avg(s).alias(f"m_{i}") for i, s in enumerate(STATS)],
            *[F.covar_pop(STATS[i], STATS[k]).alias(f"v_{i}_{k}") for i in range(P) for k in range(i + 1)],
        )
        for i in range(P):
            for k in range(i + 1):
                agg = agg.withColumn(f"c_{i}_{k}", F.col(f"v_{i}_{k}") * scale + (FLOORS[i] ** 2 if i == k else 0.0))
        est = cut_lineage(_cholesky(agg))
    return est


def judge(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    tail: float = 1e-6, support: float = 0.75, steps: int = 4, min_rows: int = 40,
    keep: list[str] | None = None,
) -> DataFrame:
    """``row`` (the columns ``keep``, with language and source among them, of the input row as a struct), the five counts, base_failed, d2
    (squared robust distance) and kept, one per input row.

    The estimates use the documents that pass the base rules; a document beyond
    the chi-square quantile at ``1 - tail`` is rejected. NULL languages and
    sources are groups of their own. Groups under ``min_rows`` passing documents
    are judged by the estimate of all passing documents of their language, and if
    these are too few by that of all. In tables under ``min_rows`` passing documents
    and on ties nothing is rejected beyond the base rules. NULL and empty texts
    fail them (no words).
    """
    c = base_counts(docs, text_col, keep)
    c = c.select(
        "*", F.col("row").getField(lang_col).alias("lang"), F.col("row").getField(source_col).alias("source"),
        base_failed().alias("base_failed"), *[s.alias(n) for s, n in zip(statistics(), STATS)],
    )
    # The counts are the expensive part: they are written once (without the text
    # unless ``keep`` has it) and every concentration step reads them.
    c = cut_lineage(c)
    x = c.where(~F.col("base_failed")).select("lang", "source", *STATS)
    groups, own = _other(fit_levels(x, min_rows), ["lang", "source"]), ["lang", "source"]
    level = F.explode(F.concat(F.when(F.col("level") == 0, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")), "pools")).alias("at")
    x = x.join(groups, _same(own)).select("lang", "source", *STATS, level)
    x = cut_lineage(x.select(*_at_level(F.col("at")), *STATS))
    keys = [*own, "level"]
    est = fit_mcd(x, support, steps, min_rows, tuple(keys))
    rest = [k for k in c.columns if k not in own]
    c = c.join(groups, _same(own), "left").select(*rest, *_at_level(F.col("level")))
    out = _distances(c, est, keys)
    inside = F.col("d2").isNull() | (F.col("d2") <= chi2_quantile(1 - tail, P))
    return out.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "d2", (~F.col("base_failed") & inside).alias("kept"),
    )
