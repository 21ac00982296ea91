"""Ranks, caps, flags and doubts of fields, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions.vocabulary import alternatives
from lexiform.operators import fields, gates
from lexiform.plans.text_queries import BLOCKS
from lexiform.sources import bridges as br

_MADE = """SELECT o_orderkey AS doc_id, CASE o_orderkey % 4 WHEN 0 THEN 'governing_law' WHEN 1 THEN 'jurisdiction' WHEN 2 THEN 'effective_date' ELSE 'expiration_date' END AS field,
  CASE o_orderkey % 7 WHEN 0 THEN '本契約の準拠法は日本法とする' WHEN 1 THEN '東京地方裁判所を第一審の専属的合意管轄裁判所とする' WHEN 2 THEN '効力発生日は 契約締結日 とする' WHEN 3 THEN 'Effective Date until expiration' WHEN 4 THEN '有効期間は満了日まで' WHEN 5 THEN 'governed by the laws of Japan' ELSE '適用法' END AS sentence,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '裁判所' ELSE 'x' END AS value, CAST(CASE o_orderkey % 6 WHEN 0 THEN NULL ELSE 0.4 + 0.1 * (o_orderkey % 6) END AS DOUBLE) AS confidence, CAST(0.1 * (o_orderkey % 3) AS DOUBLE) AS scope, o_orderkey % 2 = 0 AS in_clause, o_orderkey % 3 = 0 AS related, o_orderkey % 8 > 0 AS accepted, o_orderkey % 9 = 0 AS anchor, CAST(o_orderkey % 10 AS INT) AS flags,
  CASE o_orderkey % 5 WHEN 0 THEN 'anchor' WHEN 1 THEN 'relative_term' WHEN 2 THEN 'placeholder_term' WHEN 3 THEN 'renewable_term' ELSE 'absolute' END AS semantic,
  CASE o_orderkey % 3 WHEN 0 THEN 'MISSING_GOVERNING_LAW,source_not_explicit_governing_law,kept' WHEN 1 THEN 'MISSING_JURISDICTION,MISSING_EFFECTIVE_DATE' ELSE '' END AS told"""


def _made(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_MADE + " FROM {orders}", orders=br.table(spark, sf, "orders"))


def candidate_ranks(spark: SparkSession, sf: str) -> DataFrame:
    c = [F.col(n) for n in ("field", "sentence", "value", "confidence", "scope", "in_clause", "related", "accepted", "anchor", "flags")]
    return _made(spark, sf).select("doc_id", gates.candidate_rank(*c).alias("rank"))


def capped_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _made(spark, sf).select("doc_id", F.round(gates.capped(F.col("field"), F.col("semantic"), F.coalesce("confidence", F.lit(1.2))), 6).alias("confidence"))


def resolved_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = F.filter(F.split("told", ","), lambda x: x != "")
    return _made(spark, sf).select("doc_id", F.array_join(gates.resolved_flags(F.col("field"), F.col("value"), flags), ",").alias("flags"))


def unnamed_laws(spark: SparkSession, sf: str) -> DataFrame:
    return gates.unnamed_laws(br.contract_blocks(spark, sf))


def relative_issues(spark: SparkSession, sf: str) -> DataFrame:
    """Courts as they were found, with doubts where only a place is named; every tenth was of low quality before."""
    b = br.contract_blocks(spark, sf)
    found = fields.best(fields.candidates(b)).filter("field = 'jurisdiction'").select("doc_id", "value")
    all_ = br.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), (F.col("o_orderkey") % 10 == 0).alias("low_quality")).join(found, "doc_id", "left")
    return gates.relative_issues(all_, fields.relative_courts(b))


QUERIES = {f.__name__: f for f in (candidate_ranks, capped_confidence, resolved_flags, unnamed_laws, relative_issues)}

_M = f"WITH m AS ({_MADE} FROM orders)"
_WORDS = " + ".join(f"CASE WHEN field = '{f}' AND regexp_matches(c, '{alternatives(w)}') THEN {p}::DOUBLE ELSE 0 END" for f, w, p in gates.RANKS)
_CAP = "CASE " + " ".join(f"WHEN field = '{f}' AND semantic = '{k}' THEN {c}" for f, k, c in gates.CAPS) + " ELSE 0.99 END"
SQL = {
    "candidate_ranks": _M + f", c AS (SELECT *, lower(regexp_replace(sentence, '\\s+', '', 'g')) AS c FROM m) SELECT doc_id, round(coalesce(confidence, 0) + scope + CASE WHEN in_clause THEN 0.16::DOUBLE ELSE 0 END + CASE WHEN related THEN 0.08::DOUBLE ELSE 0 END + {_WORDS} - CASE WHEN field = 'jurisdiction' AND value = '裁判所' THEN 0.3::DOUBLE ELSE 0 END - CASE WHEN value IS NULL THEN 0 WHEN NOT accepted THEN 0.8::DOUBLE ELSE CASE WHEN anchor THEN 0.1::DOUBLE ELSE 0 END + least(0.35::DOUBLE, flags * 0.05::DOUBLE) END, 6) AS rank FROM c",
    "capped_confidence": _M + f" SELECT doc_id, round(greatest(0, least(({_CAP})::DOUBLE, coalesce(confidence, 1.2))), 6)::DOUBLE AS confidence FROM m",
    "resolved_flags": _M + " SELECT doc_id, CASE WHEN value IS NULL THEN told WHEN field = 'governing_law' THEN array_to_string(list_filter(string_split(told, ','), lambda x: x NOT IN ('MISSING_GOVERNING_LAW', 'source_not_explicit_governing_law')), ',') ELSE array_to_string(list_filter(string_split(told, ','), lambda x: x <> CASE field WHEN 'jurisdiction' THEN 'MISSING_JURISDICTION' WHEN 'effective_date' THEN 'MISSING_EFFECTIVE_DATE' ELSE 'MISSING_EXPIRATION_DATE' END), ',') END AS flags FROM m",
    "unnamed_laws": BLOCKS + ", r AS (SELECT doc_id, replace(norm, ' ', '') AS c, row_number() OVER (PARTITION BY doc_id ORDER BY ord DESC) <= 32 AS late FROM n), g AS (SELECT doc_id, coalesce(bool_or(late AND regexp_matches(c, '準拠法|適用法|日本法|日本国法')), false) AS ln, coalesce(bool_or(late AND regexp_matches(c, '合意管轄|管轄裁判所|第一審|地方裁判所|簡易裁判所|高等裁判所|家庭裁判所|紛争|訴え')), false) AS lc, bool_or(regexp_matches(c, '準拠法|適用法|日本法|日本国法')) AS a, bool_or(regexp_matches(c, '合意管轄|管轄裁判所|第一審|地方裁判所|簡易裁判所|高等裁判所|家庭裁判所|紛争|訴え')) AS b FROM r GROUP BY doc_id) SELECT doc_id, CASE WHEN ln THEN false WHEN lc THEN true ELSE NOT a AND b END AS unnamed FROM g",
    "relative_issues": BLOCKS + " SELECT k AS doc_id, CASE nation % 5 WHEN 0 THEN '東京地方裁判所' WHEN 1 THEN '大阪地方裁判所' WHEN 2 THEN '名古屋簡易裁判所' END AS value, CASE WHEN nation % 5 = 3 THEN 'relative_jurisdiction_expression' WHEN k % 10 = 0 THEN 'low_quality' END AS why, CASE WHEN nation % 5 = 3 THEN 'relative_jurisdiction_expression:甲の所在地を管轄する裁判所' END AS flag FROM p",
}
