"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff_lm, chat_format, decontamination, divergence, exact_dedup, fill_in_middle, html_extraction, packing, pipeline, quality, simhash, suffix_dedup, toxicity, warc
from .common import remainder, table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), keep="largest")


OP1_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM d JOIN g USING (body)
"""

def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held", remainder(F.col("doc_id"), 7) == 2)
    return backoff_lm.score_documents(docs)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("target_uri")


# DuckDB's sha1() gives bare lower-case hex.
OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
m AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS last_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM m
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, sf_dir, "benchmark")).drop("row")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: A conversation whose texts look like the template's own control strings.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text")
    )
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(probe))).drop("all_turns_back")


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), r AS (
  SELECT *, '### ' || CASE role WHEN 'user' THEN 'User' WHEN 'assistant' THEN 'Assistant' WHEN 'system' THEN 'System' WHEN 'tool' THEN 'Tool' ELSE '=' || role END
    || ': ' || regexp_replace(text, '(\\*)(### |</turn>)', '\\\1\2', 'g') || ' </turn>' || chr(10) AS rendered FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(rendered)) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=3, distance=3)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    back = made.withColumn("restored", fill_in_middle.restored(F.col("output"), F.col("form")))
    return back.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


OP11_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS body, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, body, length(body) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
), c AS (
  SELECT doc_id, body, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (SELECT *, substring(body, 1, a) AS prefix, substring(body, a + 1, b - a) AS middle, substring(body, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN body WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(body) AS restored_sha256
FROM p
"""


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages, html_extraction.fit(pages))


# What the sample's own template marks as the article, by SQL alone: an independent reading of the pages.
OP12_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(regexp_replace(replace(body, '<br>', ' '), '</?b>', '', 'g'), '</?(?:h1|p)>'),
  lambda x: trim(regexp_replace(replace(replace(regexp_replace(x, '&quot;', '"', 'g'), '&amp;', '&'), '&amp', '&'), '\s+', ' ', 'g'))) AS blocks FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(blocks, lambda x: x <> ''), chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), t AS (SELECT row, lang, source, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
o AS (SELECT row, lang, source, term, count(*) AS n FROM t GROUP BY ALL),
kept AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(*) >= 30),
c AS (SELECT lang, source, term, sum(n) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
ln AS (SELECT lang, sum(total) AS total FROM gn GROUP BY lang),
p AS (
  SELECT gn.lang, gn.source, kept.term, coalesce(c.n, 0) AS n,
    CAST(1 + (CAST(1000000000 AS HUGEINT) * CAST(coalesce(c.n, 0) + 5 AS HUGEINT)) // CAST(gn.total + 5 * v.v AS HUGEINT) AS BIGINT) AS p
  FROM gn JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = kept.term
), q AS (
  SELECT lang, term, CAST(1 + (CAST(1000000000 AS HUGEINT) * CAST(sum(n) + 5 AS HUGEINT)) // CAST(any_value(ln.total) + 5 * any_value(v.v) AS HUGEINT) AS BIGINT) AS q
  FROM p JOIN ln USING (lang) JOIN v USING (lang) GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT lang, source, part, item, CAST(value AS BIGINT) AS value FROM pairs
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.lang NOT IN (SELECT lang FROM v)
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
), ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_exact_dedup": op1_exact_dedup, "op2_best_fit_packing": op2_best_fit_packing, "op3_suffix_dedup": op3_suffix_dedup, "op4_backoff_lm": op4_backoff_lm, "op5_toxicity": op5_toxicity, "op6_warc": op6_warc, "op7_decontamination": op7_decontamination, "op8_quality": op8_quality, "op9_chat_format": op9_chat_format, "op10_simhash": op10_simhash, "op11_fill_in_middle": op11_fill_in_middle, "op12_html_extraction": op12_html_extraction, "op13_source_divergence": op13_source_divergence, "pipeline": pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op6_warc": OP6_SQL, "op9_chat_format": OP9_SQL, "op11_fill_in_middle": OP11_SQL, "op12_html_extraction": OP12_SQL, "op13_source_divergence": OP13_SQL}
