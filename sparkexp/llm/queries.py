"""Queries of the numbered operators over the driver tables, with oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_WS = r"[\x20\x09-\x0D]"
_NOT_WS = r"[^\x20\x09-\x0D]+"
#: The six space characters as a DuckDB expression.
_SPACES = "(chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13))"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------ 6: mixing
MIX_SEED = 17
OP6_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_NOT_WS}')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k
  FROM d GROUP BY source
), s2 AS (
  SELECT *, CASE k % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2.0::DOUBLE * source_size AS cap,
         1.5::DOUBLE * sum(source_size) OVER () AS total FROM s
), fill(step, k, w, cap, capped) AS (
  SELECT 0, k, w, cap, false FROM s2
  UNION ALL
  SELECT step + 1, k, w, cap,
         capped OR cap <= w * ((SELECT any_value(total) FROM s2) - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())
                        / nullif(sum(CASE WHEN capped THEN 0 ELSE w END) OVER (), 0)
  FROM fill WHERE step < (SELECT count(*) FROM s2)
), last AS (
  SELECT k, w, cap, coalesce(capped, true) AS capped FROM fill WHERE step = (SELECT max(step) FROM fill)
), t AS (
  SELECT k, CASE WHEN capped THEN cap
    ELSE w * ((SELECT any_value(total) FROM s2) - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())
           / nullif(sum(CASE WHEN capped THEN 0 ELSE w END) OVER (), 0) END AS target FROM last
), j AS (
  SELECT d.doc_id, d.size, s2.source_size, t.target,
         CASE WHEN s2.source_size > 0 THEN least(t.target / s2.source_size, 2.0) ELSE 0.0 END AS rate,
         CAST(('0x' || substr(md5('{MIX_SEED}|' || coalesce(CAST(d.doc_id AS VARCHAR), '~')), 1, 12)) AS BIGINT) / 281474976710656.0 AS u
  FROM d JOIN s2 ON d.source IS NOT DISTINCT FROM s2.source JOIN t USING (k)
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM j
"""


@query("op6_mixing", OP6_SQL)
def op6(spark, sf_dir):
    from sparkexp.llm.mixing import mix

    m = mix(table(spark, sf_dir, "documents"), seed=MIX_SEED)
    return m.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), (F.col("size") * F.col("copies")).alias("taken")
    )


# -------------------------------------------------------------- 7: line dedup
OP7_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents
), k AS (
  SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), bad AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(bad.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bad.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN bad USING (key) GROUP BY doc_id
"""


@query("op7_line_dedup", OP7_SQL)
def op7(spark, sf_dir):
    from sparkexp.llm.line_dedup import dedup_lines

    d = dedup_lines(table(spark, sf_dir, "documents"), min_docs=10)
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# ----------------------------------------------------------- 9: quality rules
@query("op9_quality_rules")
def op9(spark, sf_dir):
    from sparkexp.llm.quality import judge

    q = judge(table(spark, sf_dir, "documents"), keep=["doc_id", "lang", "source"])
    return q.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


# ----------------------------------------------------------- 10: licence scan
def _op10_sql() -> str:
    from sparkexp.llm.licenses import KNOWN_NOTICES, SPELLINGS

    def canonical(x: str) -> str:
        t = f"regexp_replace(lower(coalesce({x}, '')), '(^|\\n)[\\x20\\x09]*(copyright|\\(c\\)|©|all rights reserved)[^\\n]*', chr(10), 'g')"
        words = f"list_filter(regexp_split_to_array({t}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
        pairs = ", ".join(f"'{a}': '{b}'" for a, b in SPELLINGS.items())
        return f"array_to_string(list_transform({words}, lambda w: coalesce(MAP {{{pairs}}}[w], w)), ' ')"

    known = ", ".join(f"('{i}', '{t}')" for i, t in KNOWN_NOTICES)
    return f"""
WITH known AS (
  SELECT sha256({canonical('text')}) AS digest, min(license_id) AS license_id FROM (VALUES {known}) v(license_id, text) GROUP BY 1
), whole AS (
  SELECT doc_id, {canonical('text')} AS c FROM documents
), notes AS (
  SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS ids, count(DISTINCT license_id) AS n
  FROM (SELECT doc_id, {canonical('line')} AS c FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents))
  JOIN known ON sha256(c) = known.digest GROUP BY doc_id
)
SELECT doc_id, CASE WHEN c <> '' THEN sha256(c) END AS digest, license_id, coalesce(ids, '') AS notice_ids, coalesce(n, 0) AS n_notices
FROM whole LEFT JOIN known ON c <> '' AND sha256(c) = known.digest LEFT JOIN notes USING (doc_id)
"""


@query("op10_license_scan")
def op10(spark, sf_dir):
    from sparkexp.llm.licenses import known_notices, scan

    s = scan(table(spark, sf_dir, "documents"), known_notices(spark))
    return s.select(
        "doc_id", "digest", "license_id", F.array_join("notice_ids", ",").alias("notice_ids"),
        F.size("notice_ids").cast("long").alias("n_notices"),
    )


ORACLES["op10_license_scan"] = _op10_sql()


# -------------------------------------------------------- 2: substring dedup
@query("op2_substring_dedup")
def op2(spark, sf_dir):
    from sparkexp.llm.substring_dedup import dedup_words

    d = dedup_words(table(spark, sf_dir, "documents"), length=35)
    return d.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


# ----------------------------------------------------------- 4: suffix dedup
@query("op4_suffix_dedup")
def op4(spark, sf_dir):
    from sparkexp.llm.suffix_dedup import dedup_bytes

    d = dedup_bytes(table(spark, sf_dir, "documents"), length=50)
    return d.select(
        "doc_id", "n_bytes", "n_removed", F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


# ------------------------------------------------------ 3: n-gram Jaccard join
@query("op3_jaccard_join")
def op3(spark, sf_dir):
    from sparkexp.llm.anchors import NO_ID
    from sparkexp.llm.setjoin import jaccard_components

    j = jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)
    return j.select(F.nullif("did", F.lit(NO_ID)).alias("doc_id"), "n_shingles", F.nullif("component_id", F.lit(NO_ID)).alias("component_id"))


# ------------------------------------------------- 1: benchmark decontamination
@query("op1_decontaminate")
def op1(spark, sf_dir):
    from sparkexp.llm.decontaminate import find_leaks

    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select("doc_id", "item_id", "score", F.round("share", 6).alias("share"), "start_word", "end_word")


# -------------------------------------------------------- 5: HTML extraction
@query("op5_html_text")
def op5(spark, sf_dir):
    from sparkexp.llm.html_text import extract

    p = extract(table(spark, sf_dir, "pages"), "html")
    return p.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


# --------------------------------------------------------- 8: personal data
@query("op8_personal_data")
def op8(spark, sf_dir):
    from sparkexp.llm.pii import find_personal

    p = find_personal(table(spark, sf_dir, "documents"))
    return p.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


# ------------------------------------------ 11: conversation structure repair
def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults put in by the checksum of ``conv_id:turn``: rows
    dropped (0 copies), emptied, without sentence marks, doubled or given to the
    user. NULLs are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                     (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("k"))
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("k") == 0, 0).when(F.col("k") == 3, 2).otherwise(1)
    return d.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


#: Moves of the automaton over the states nothing (0), s (1), u (2), a (3): phases 0 and 1
#: insert a user and an assistant turn, phase 2 takes the next row.
_OP11_MOVES = ", ".join(
    [f"({p}, {q}, NULL, {q}, 0, '', NULL)" for p in (0, 1) for q in range(4)]
    + [f"(0, {q}, NULL, 2, 5, 'I', 'user')" for q in (0, 1, 3)]
    + ["(1, 2, NULL, 3, 5, 'I', 'assistant')"]
    + [f"(2, {q}, NULL, {q}, 2, 'D', NULL)" for q in range(4)]
    + [f"(2, {q}, '{i}', {r}, 0, 'K', NULL)" for q, i, r in ((0, "s", 1), (0, "u", 2), (1, "u", 2), (3, "u", 2), (2, "a", 3))]
    + [f"(2, {q}, NULL, {r}, 1, 'R', '{w}')" for q, r, w in ((0, 2, "user"), (1, 2, "user"), (3, 2, "user"), (2, 3, "assistant"))]
)
OP11_SQL = f"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), crc AS (
  SELECT name, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda x: x::BIGINT)),
      lambda v, x: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT) % 20 AS k
  FROM (SELECT DISTINCT name FROM c)
), d AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 0 THEN [] WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM c JOIN crc USING (name)
), r0 AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, trim(text, {_SPACES}) AS core FROM d
), r AS (
  SELECT *, CASE WHEN core = '' THEN 'B' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'D'
                 WHEN right(core, 1) NOT IN ('.', '!', '?') THEN 'T' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM r0
), facts AS (
  SELECT o.conv_id, count(r.i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'B') AS blank, count(*) FILTER (fault = 'D') AS duplicate, count(*) FILTER (fault = 'T') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN r ON o.conv_id IS NOT DISTINCT FROM r.conv_id GROUP BY o.conv_id
), moves(phase, q, initial, q2, cost, edit, put) AS (VALUES {_OP11_MOVES}),
st(step, conv_id, q, cost, audit, repaired) AS (
  SELECT 0, conv_id, 0, 0, '', CAST([] AS VARCHAR[]) FROM facts
  UNION ALL
  SELECT * FROM (
    SELECT s.step + 1 AS step, s.conv_id, m.q2 AS q,
           s.cost + m.cost + CASE WHEN m.edit IN ('K', 'R') AND r.fault = 'T' THEN 5 ELSE 0 END AS cost, s.audit || m.edit AS audit,
           CASE m.edit WHEN 'I' THEN list_append(s.repaired, m.put || ':') WHEN 'K' THEN list_append(s.repaired, r.role || ':' || r.text)
                       WHEN 'R' THEN list_append(s.repaired, m.put || ':' || r.text) ELSE s.repaired END AS repaired
    FROM st AS s JOIN facts AS f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.step < 3 * f.n + 2
    JOIN moves AS m ON m.phase = s.step % 3 AND m.q = s.q
    LEFT JOIN r ON s.step % 3 = 2 AND r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.step // 3 + 1
    WHERE m.edit NOT IN ('K', 'R') OR (r.fault IN ('', 'T') AND (m.edit = 'R' OR left(r.role, 1) = m.initial))
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1
), best AS (
  SELECT st.* FROM st JOIN facts AS f ON st.conv_id IS NOT DISTINCT FROM f.conv_id AND st.step = 3 * f.n + 2 WHERE q IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY st.conv_id ORDER BY cost, audit) = 1
)
SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit,
       sha256(array_to_string(repaired, chr(10))) AS repaired_sha256
FROM facts AS f JOIN best ON f.conv_id IS NOT DISTINCT FROM best.conv_id
"""


@query("op11_conversation_repair", OP11_SQL)
def op11(spark, sf_dir):
    from sparkexp.llm.conversations import audit_conversations, with_digest

    turns = damaged(table(spark, sf_dir, "conversations"))
    return with_digest(turns, audit_conversations(turns, copies_col="copies"), copies_col="copies")


# -------------------------------------------------------------- 12: toxicity
@query("op12_toxicity")
def op12(spark, sf_dir):
    from sparkexp.llm.toxicity import fit_model, score

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = fit_model(docs, labels.where(~held))
    s = score(docs, model, keep=["doc_id"])
    return s.select("doc_id", held.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.3).cast("int").alias("predicted"))


# ------------------------------------------------------ 13: phrase collocations
OP13_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n\\x0B\\f\\r]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p
), total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, k, gram, count(*) AS c FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS gram
    FROM w, (VALUES (1), (2), (3), (4)) AS v(k) WHERE len(ws) >= k
  ) GROUP BY lang, k, gram HAVING count(*) >= 30
), cand AS (SELECT *, string_split(gram, ' ') AS ws FROM f WHERE k >= 2),
halves AS (
  SELECT *, array_to_string(ws[1:j], ' ') AS head, array_to_string(ws[j + 1:k], ' ') AS tail FROM cand, (VALUES (1), (2), (3)) AS v(j) WHERE j < k
), cuts AS (
  SELECT c.lang, c.gram, c.c AS a, l.c AS l, r.c AS r, j,
         CAST((CAST(2000000 AS HUGEINT) * c.c) // (CAST(l.c AS HUGEINT) + r.c) AS BIGINT) AS score
  FROM halves AS c JOIN f AS l ON l.lang = c.lang AND l.gram = c.head JOIN f AS r ON r.lang = c.lang AND r.gram = c.tail
), best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, j) = 1),
inner_parts AS (
  SELECT c.lang, array_to_string(c.ws[i:i + m - 1], ' ') AS gram, max(c.c) AS longer
  FROM cand AS c, (VALUES (1), (2), (3)) AS s(i), (VALUES (2), (3)) AS t(m) WHERE m < c.k AND i + m - 1 <= c.k GROUP BY 1, 2
), ranked AS (
  SELECT b.lang, b.gram AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.gram) AS rank
  FROM best AS b LEFT JOIN inner_parts AS i ON i.lang = b.lang AND i.gram = b.gram
  WHERE i.longer IS NULL OR 100 * CAST(i.longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", OP13_SQL)
def op13(spark, sf_dir):
    from sparkexp.llm.collocations import mine

    return mine(table(spark, sf_dir, "documents"), min_count=30, inside=80, top=2000)
