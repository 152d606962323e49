"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierlake.llm import (
    chat, decontamination, fill_middle, importance, jaccard_join, language_id, line_dedup,
    lm_scoring, page_text, quality_hosts, secrets, sentencepiece_bpe, toxicity)
from tierlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The vocabulary of the SentencePiece query.
PIECES = "piece_bpe_32k.model"


def pieces_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(PIECES)


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = lm_scoring.score(docs, table(spark, sf_dir, "labels"))
    return made.select("doc_id", "n_words", *(
        F.round(c, 6).alias(c) for c in ("ce_target", "ce_background", "score")))


LM_SQL = """
WITH tokens AS (
  SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) AS place
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents)),
target AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(toxic) = 0),
pairs AS (SELECT n.doc_id, coalesce(lag(w) OVER (PARTITION BY n.doc_id ORDER BY place), ' start')
                 AS h, w, target.doc_id IS NOT NULL AS good
          FROM tokens n LEFT JOIN target ON n.doc_id = target.doc_id),
counts AS (SELECT h, w, count(*) AS b, count(*) FILTER (good) AS t FROM pairs GROUP BY h, w),
histories AS (SELECT h, sum(b) AS b, sum(t) AS t FROM counts GROUP BY h),
sizes AS (SELECT sum(b) + count(DISTINCT w) AS b, sum(t) + count(DISTINCT w) AS t FROM counts),
singles AS (SELECT w, 20.0 * (sum(c.b) + 1.0) / any_value(z.b) AS b,
                   20.0 * (sum(c.t) + 1.0) / any_value(z.t) AS t
            FROM counts c, sizes z GROUP BY w),
losses AS (SELECT c.h, c.w, -ln((c.t + s.t) / (h.t + 20.0)) AS t,
                  -ln((c.b + s.b) / (h.b + 20.0)) AS b
           FROM counts c JOIN histories h ON c.h = h.h JOIN singles s ON c.w = s.w),
scores AS (SELECT doc_id, count(*) AS n, avg(t) AS t, avg(b) AS b
           FROM pairs JOIN losses ON pairs.h = losses.h AND pairs.w = losses.w GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, round(coalesce(t, 0.0), 6) AS ce_target,
       round(coalesce(b, 0.0), 6) AS ce_background, round(coalesce(t - b, 0.0), 6) AS score
FROM documents d LEFT JOIN scores s ON d.doc_id = s.doc_id
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_dedup.delete_copies(table(spark, sf_dir, "documents"), count_as="n_deleted_lines")
    return made.select("doc_id", "n_deleted_lines", F.length("text").alias("n_chars_kept"),
                       sha256(F.col("text")).alias("text_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_hosts.judge(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = sentencepiece_bpe.encode_and_decode(table(spark, sf_dir, "documents"), pieces_path())
    return made.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(docs))
    base = ("assign", "access", "hex")
    return found.select(
        "doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k in base),
        sha256(secrets.listed(base)).alias("base_sha256"),
        secrets.listed(secrets.KINDS).alias("spans"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents"))


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


CHAT_SQL = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations
               WHERE conv_id IS NOT NULL),
chats AS (SELECT conv_id, count(*) AS n,
                 string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10),
                            '' ORDER BY turn, role, text) AS chat
          FROM turns GROUP BY conv_id),
firsts AS (SELECT min(conv_id) AS conv_id, any_value(n) AS n, chat FROM chats GROUP BY chat)
SELECT conv_id, CAST(n AS INTEGER) AS n_turns, chat FROM firsts a
WHERE NOT EXISTS (SELECT 1 FROM firsts b WHERE length(b.chat) > length(a.chat)
                  AND starts_with(b.chat, a.chat))
"""


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract(table(spark, sf_dir, "pages"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *(
        sha256(F.col(c)).alias(f"{c}_sha256") for c in ("output", "restored")))


FILL_MIDDLE_SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
numbers AS (
  SELECT doc_id, text, n, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (n + 1) AS c1,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (n + 1) AS c2,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS plain_draw,
         CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS form_draw FROM drawn),
forms AS (
  SELECT doc_id, text, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>')
                   OR contains(text, '<M>') OR plain_draw >= 90 THEN 'plain'
              WHEN form_draw < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (
  SELECT doc_id, text, n, form, a, b, substring(text, 1, a) AS prefix,
         substring(text, a + 1, b - a) AS middle, substring(text, b + 1, n - b) AS suffix
  FROM forms)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle
              END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return importance.resample(docs, importance.fit(docs, table(spark, sf_dir, "benchmark")))


#: crc32 byte by byte, with the table of its polynomial made by rule.
RESAMPLING_SQL = """
WITH RECURSIVE steps(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
texts AS (
  SELECT true AS corpus, doc_id, text, row_number() OVER () AS row_id FROM documents
  UNION ALL SELECT false, NULL, text, 0 FROM benchmark),
words AS (
  SELECT corpus, doc_id, row_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM texts),
found AS (
  SELECT corpus, row_id, unnest(list_concat(w, list_transform(
           range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
names AS (SELECT f, hex(encode(f)) AS h FROM found GROUP BY f),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(h), 2),
                  lambda i: CAST('0x' || substr(h, i, 2) AS BIGINT))),
                lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM names, crc_table),
placed AS (SELECT corpus, row_id, bucket FROM found JOIN hashed USING (f)),
sums AS (SELECT count(*) FILTER (corpus) AS s, count(*) FILTER (NOT corpus) AS t FROM placed),
gains AS (
  SELECT bucket, floor(1000 * ln(
           (count(*) FILTER (NOT corpus) + 1) * (any_value(sums.s) + 10000.0)
           / ((count(*) FILTER (corpus) + 1) * (any_value(sums.t) + 10000.0)))) AS gain
  FROM placed, sums GROUP BY bucket),
weights AS (
  SELECT row_id, count(*) AS n, floor(sum(gain) / count(*)) AS weight
  FROM placed JOIN gains USING (bucket) WHERE corpus GROUP BY row_id),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
         CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(
           '7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5)
           / 4294967296.0))) AS BIGINT) AS score
  FROM words LEFT JOIN weights USING (row_id) WHERE corpus),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20
                               ORDER BY score DESC, doc_id NULLS LAST) AS place,
         25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS wanted
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= wanted THEN place END AS rank
FROM ranked
"""


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_toxicity, op2_language_id, op3_lm_scoring, op4_line_dedup, op5_quality_rules,
    op6_sentencepiece, op7_decontamination, op8_secrets, op9_jaccard_join, op10_chat, op11_html_extraction,
    op12_fill_middle, op13_importance_resampling)}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op3_lm_scoring": LM_SQL, "op10_chat": CHAT_SQL, "op12_fill_middle": FILL_MIDDLE_SQL,
    "op13_importance_resampling": RESAMPLING_SQL}
