"""The queries of the numbered operators, and their results as DuckDB SQL where SQL can express them.

Each applies its operator to the whole of its table with production
parameters; the contract's digest columns are derived here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import chat, decontam, divergence, hosts, licenses, mixing, packing, quality, resampling, simhash, tokens, toxicity, warc
from kiln.llm.common import table
from kiln.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

#: The conversation added to those of the table: both turns hold control strings.
CONTROL_CONVERSATION = -7
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op1_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_components(table(spark, d, "documents"))


def op2_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


def op3_licenses(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, d, "documents")).withColumn("spans", F.to_json("spans"))


def op4_warc(spark: SparkSession, d: str) -> DataFrame:
    folder = scratch_dir(spark, "warc-responses")
    files = warc.capture(table(spark, d, "pages"), folder)
    derived, out = warc.build_derivatives(spark, files, folder)
    return warc.digests(warc.read_warc(derived, out))


def op5_tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokens.tokenize(spark, table(spark, d, "documents"))


def op6_chat(spark: SparkSession, d: str) -> DataFrame:
    conversations = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(CONTROL_CONVERSATION).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat.read_back(*chat.formatted(conversations.unionByName(added)))


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_documents(table(spark, d, "documents"), table(spark, d, "labels"))


def op8_hosts(spark: SparkSession, d: str) -> DataFrame:
    return hosts.host_rules(table(spark, d, "documents"))


def op9_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.report(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op10_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"))


def op11_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(table(spark, d, "documents"))


def op12_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op13_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(table(spark, d, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_simhash, op2_quality, op3_licenses, op4_warc, op5_tokens, op6_chat, op7_toxicity, op8_hosts,
    op9_decontamination, op10_mixing, op11_divergence, op12_resampling, op13_packing)}

_BLANK = r"[\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE_SQL: dict[str, str] = {
    "op6_chat": rf"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -7, 1, 'assistant', '{CONTROL_TEXT}'),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t, role, text,
    CASE WHEN role IN ('user', 'assistant', 'system', 'tool') THEN length(role) ELSE 1 + 2 * strlen(coalesce(role, '')) END AS mark
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(4 + mark + 2 + 8 + 2 * length(t) - length(translate(t, '\#<', ''))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op8_hosts": rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, list_filter(string_split_regex(text, '{_BLANK}'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (SELECT k, i, list_slice(words, i, i + 7) AS win
        FROM (SELECT k, words, unnest(range(1, greatest(1, len(words) - 6))) AS i FROM w)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS n FROM win) WHERE n > 1),
rep AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT k, i + j AS p FROM twice, range(8) AS r(j)) GROUP BY k),
m AS (
  SELECT d.k, doc_id, source, CAST(len(words) AS BIGINT) AS n_words, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS word_chars,
    length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d JOIN w USING (k) LEFT JOIN rep USING (k)),
f AS (
  SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2, 10 * n_symbols > word_chars AS f3,
    10 * n_dup_lines > 3 * n_lines AS f4, word_chars > 20 * n_words OR word_chars < 2 * n_words AS f5 FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (f1 OR f2 OR f3 OR f4 OR f5) AS f FROM f GROUP BY source),
mean AS (SELECT sum(f) / sum(n) AS m, sum(n) AS total, count(*) AS hosts FROM h),
spread AS (SELECT sum(n * pow(f / n - m, 2)) / any_value(total) - any_value(m * (1 - m) * (hosts - 1) / total) AS v, any_value(m) AS m FROM h, mean),
prior AS (SELECT m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, {hosts.MIN_STRENGTH}), {hosts.MAX_STRENGTH}) ELSE {hosts.MAX_STRENGTH} END AS s
        FROM spread),
post AS (SELECT source, m, f + m * s AS a, n - f + (1 - m) * s AS b FROM h, prior),
verdict AS (SELECT source, a / (a + b) - {hosts.TAIL} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > m AS distrusted FROM post)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2) AND NOT (distrusted AND (f1 OR f2 OR f3 OR f4 OR f5)) AS kept
FROM f JOIN verdict ON f.source IS NOT DISTINCT FROM verdict.source""",
    "op9_decontamination": rf"""
WITH items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, m, list_slice(w, i, i + m - 1) AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
lens AS (SELECT DISTINCT m FROM win),
place AS (SELECT k, m, i, list_slice(w, i, i + m - 1) AS win
          FROM (SELECT k, w, m, unnest(range(1, greatest(1, len(w) - m + 2))) AS i FROM d, lens)),
hit AS (SELECT k, place.m, i, item_id FROM place JOIN win ON place.m = win.m AND place.win = win.win),
words AS (SELECT k, count(DISTINCT i + j) AS n FROM (SELECT DISTINCT k, m, i FROM hit), range(13) AS r(j) WHERE j < m GROUP BY k),
ids AS (SELECT k, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
  sha256(coalesce(ids.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN ids USING (k)""",
    "op11_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
o AS (SELECT k, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY lang, source, term),
c AS (SELECT g.lang, g.source, kept.term, coalesce(n.n, 0) AS n, v.v
      FROM g JOIN kept ON g.lang = kept.lang JOIN v ON g.lang = v.lang
      LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = kept.term),
gn AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
ln AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
lt AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
p AS (SELECT c.lang, c.source, c.term, c.n,
        CAST(1 + CAST(1000000000 AS HUGEINT) * (c.n + 5) // (gn.total + 5 * c.v) AS BIGINT) AS p,
        CAST(1 + CAST(1000000000 AS HUGEINT) * (lt.n + 5) // (ln.total + 5 * c.v) AS BIGINT) AS q
      FROM c JOIN gn ON gn.lang = c.lang AND gn.source = c.source JOIN ln ON ln.lang = c.lang
        JOIN lt ON lt.lang = c.lang AND lt.term = c.term),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(far.value, 0) AS BIGINT) AS value
          FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
both_parts AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM both_parts)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50""",
}
