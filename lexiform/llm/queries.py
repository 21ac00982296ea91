"""Registered queries of the operators in this subpackage, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.llm import ctw, exact_dedup, importance, kneser_ney, license_scan, line_dedup, mixing, png_media, prefix_trie, scratch, sentencepiece_codec, simhash, token_rollup, toxicity

#: Another folder with the public vocabulary files than that of their package; a parameter of the deployment.
TOKENIZERS = os.environ.get("LEXIFORM_TOKENIZERS")
PIECES, RANKS = (os.path.join(TOKENIZERS, n) if TOKENIZERS else str(public_tokenizers.path(n)) for n in ("piece_bpe_32k.model", "byte_bpe_50k.tiktoken"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids, decoded text and source spans of every document, as digests."""
    return sentencepiece_codec.digest_documents(table(spark, sf_dir, "documents"), PIECES)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of every document; 1 is predicted from 0.3 on."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cut=0.3)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens by source, language and tokenizer version, after batches of signed changes of all documents.

    The first inserts every document, as yet without its text, and a second one with a negative id beside it; the next revises
    the documents to their texts and deletes the others; it comes twice. What is left are the documents.
    """
    rollup = token_rollup.Rollup(spark, scratch.folder(spark, "rollup"), [PIECES, RANKS])
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    early = docs.withColumn("text", F.lit(""))
    beside = early.withColumn("doc_id", -1 - F.col("doc_id"))
    rollup.apply(1, early.unionByName(beside).withColumn("kind", F.lit("insert")))
    changes = docs.withColumn("kind", F.lit("revise")).unionByName(beside.withColumn("kind", F.lit("delete")))
    rollup.apply(2, changes)
    rollup.apply(2, changes)  # committed before: nothing happens
    return rollup.totals()


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3, segments=2)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each use of a document in a mix of as many tokens as there are, of nearly even entropy, no source over four times."""
    return mixing.mix(table(spark, sf_dir, "documents"), budget_share=1.0, entropy_share=0.98, repeats=4.0)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and which row of it stays."""
    out = exact_dedup.deduplicate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op7_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and context-tree scores of every document, learned from those not held out."""
    return ctw.score(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document as a file below its source and language, its own or inherited."""
    files = license_scan.document_paths(table(spark, sf_dir, "documents"))
    return license_scan.scan(files).withColumn("doc_id", F.element_at(F.split("path", "/"), -1).cast("long"))


def op9_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's payload as PNG in a binary column, read back."""
    return png_media.read_media(png_media.with_media(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("hash", "error")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document by a model of trusted text, its language's threshold, and whether it stays."""
    return kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"), every=20, heads=4)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after those that stand in ten documents or more have gone."""
    out = line_dedup.deduplicate(table(spark, sf_dir, "documents"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and place in the draw of every document, towards the texts of ``benchmark``."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, min_words=20, orders=1, buckets=10_000, seed=2024)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


_OP6_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""

#: CRC-32 of a UTF-8 text: table of the reflected polynomial, then a fold over the bytes.
_CRC_SQL = r"""
CREATE_TABLE AS (
  SELECT list(c ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END, b) AS c
    FROM (SELECT unnest(range(256)) AS b)))"""


def _crc(text: str) -> str:
    """SQL: the unsigned CRC-32 of ``text``; a column ``crc`` has the table."""
    byte = f"('0x' || substr(hex(encode({text})), CAST(2 * k + 1 AS INT), 2))::BIGINT"
    return f"xor(4294967295, list_reduce(range(strlen({text})), lambda a, k: xor(a >> 8, crc[CAST(xor(a & 255, {byte}) + 1 AS INT)]), 4294967295))"


_OP11_SQL = (
    "WITH RECURSIVE " + _CRC_SQL.strip().replace("CREATE_TABLE", "crcs") + r""",
t AS (
  SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS idx
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv, conv - conv % 20 AS base, CRC_OF_CONV % 4 AS h
  FROM (SELECT DISTINCT conv, CAST(conv AS VARCHAR) AS name FROM t), crcs),
r AS (
  SELECT conv, role, text, row_number() OVER (PARTITION BY conv ORDER BY idx) AS depth FROM (
    SELECT c.conv, t.idx, t.role, t.text FROM c JOIN t ON t.conv = c.base AND t.idx <= c.h
    UNION ALL
    SELECT c.conv, t.idx, t.role, t.text FROM c JOIN t ON t.conv = c.conv AND t.idx > c.h)),
p AS (
  SELECT conv, 0::BIGINT AS depth, sha256('') AS digest, NULL::VARCHAR AS parent, 0::BIGINT AS words FROM c
  UNION ALL
  SELECT p.conv, r.depth, sha256(p.digest || strlen(r.role) || ':' || r.role || r.text), p.digest,
         len(regexp_extract_all(r.text, '[^\x20\x09-\x0D]+'))
  FROM p JOIN r ON r.conv = p.conv AND r.depth = p.depth + 1),
whole AS (SELECT conv, max(depth) AS whole FROM p GROUP BY conv),
n AS (
  SELECT depth, digest, min(conv) AS conv, any_value(parent) AS parent, count(*) AS n_convs,
         (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(CAST(conv AS VARCHAR), ',' ORDER BY conv) FILTER (WHERE depth = whole), '')) AS ends_sha256
  FROM p JOIN whole USING (conv) GROUP BY depth, digest),
kids AS (SELECT depth - 1 AS depth, parent AS digest, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
full_n AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (depth, digest)),
up AS (
  SELECT a.depth, a.digest, sum(b.saved) AS saved_tokens, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves
  FROM full_n b JOIN p a ON a.conv = b.conv AND a.depth <= b.depth GROUP BY ALL)
SELECT f.conv AS conv_id, f.depth, m.conv AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves,
       CAST(u.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_n f JOIN up u USING (depth, digest) LEFT JOIN n m ON m.depth = f.depth - 1 AND m.digest = f.parent
"""
).replace("CRC_OF_CONV", _crc("name"))

_OP12_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
k AS (
  SELECT doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY doc_id
"""

_OP13_SQL = (
    "WITH " + _CRC_SQL.strip().replace("CREATE_TABLE", "crcs") + r""",
w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM documents),
bw AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
b AS (SELECT word, CRC_OF_WORD % 10000 AS bucket FROM (SELECT word FROM w UNION SELECT word FROM bw), crcs),
s AS (SELECT bucket, count(*) AS s FROM w JOIN b USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN b USING (word) GROUP BY bucket),
n AS (SELECT (SELECT count(*) FROM w) AS all_s, (SELECT count(*) FROM bw) AS all_t),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((s + 1)::DOUBLE * (all_t + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), n),
v AS (SELECT doc_id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM w JOIN b USING (word) JOIN g USING (bucket) GROUP BY doc_id),
x AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM documents LEFT JOIN v USING (doc_id)),
o AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 10 * count(*) OVER () // 100 AS draws
  FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= draws THEN place END AS rank
FROM x LEFT JOIN o USING (doc_id)
"""
).replace("CRC_OF_WORD", _crc("word"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_toxicity": op2_toxicity,
        "op3_token_counts": op3_token_counts,
        "op4_simhash": op4_simhash,
        "op5_source_mixing": op5_source_mixing,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_ctw": op7_ctw,
        "op8_license_scan": op8_license_scan,
        "op9_png_media": op9_png_media,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_line_dedup": op12_line_dedup,
        "op13_importance": op13_importance,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": _OP6_SQL, "op11_prefix_trie": _OP11_SQL, "op12_line_dedup": _OP12_SQL, "op13_importance": _OP13_SQL}
