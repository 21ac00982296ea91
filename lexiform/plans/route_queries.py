"""Routes, courts, laws, roles of dates and candidates of the last part, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions.vocabulary import alternatives
from lexiform.operators import routes
from lexiform.plans.text_queries import BLOCKS
from lexiform.sources import bridges as br


def _routes(spark: SparkSession, sf: str) -> DataFrame:
    b = br.contract_blocks(spark, sf)
    return routes.contract_routes(b, b.filter("ord = 2 and doc_id % 5 > 0").select("doc_id", F.col("norm").alias("hint")))


def contract_route(spark: SparkSession, sf: str) -> DataFrame:
    """By the first blocks, with the title as a hint for four of five contracts."""
    return _routes(spark, sf)


def route_margins(spark: SparkSession, sf: str) -> DataFrame:
    f = F.explode(F.array(*[F.lit(x) for x in ("governing_law", "jurisdiction", "effective_date", "expiration_date", "counterparties", "title")])).alias("field")
    r = _routes(spark, sf).select("route").distinct().select("route", f)
    return r.select("route", "field", F.round(routes.replacement_margin(F.col("route"), F.col("field")), 6).alias("margin"), routes.tail_bonus(F.col("route"), F.col("field")).alias("bonus"))


_TEXTS = """SELECT o_orderkey AS doc_id, CASE o_orderkey % 8 WHEN 0 THEN '東京地方裁判所又は大阪簡易裁判所' WHEN 1 THEN '地方裁判所' WHEN 2 THEN '知的財産裁判所を' WHEN 3 THEN '管轄裁判所' WHEN 4 THEN concat('第', o_orderkey, '高等裁判所') WHEN 5 THEN '札幌裁判所、仙台裁判所' WHEN 6 THEN '法廷' ELSE '裁判所' END AS court,
  CASE o_orderkey % 7 WHEN 0 THEN '準拠法は日本国法とする' WHEN 1 THEN 'the laws of Japan' WHEN 2 THEN 'governed by the laws of the State of New York' WHEN 3 THEN '準拠法' WHEN 4 THEN '本契約の成立、効力及び解釈は日本法による' WHEN 5 THEN '英国法' ELSE 'law of England' END AS law, CASE o_orderkey % 3 WHEN 0 THEN 'NDA' WHEN 1 THEN 'SERVICE' ELSE 'UNKNOWN' END AS route,
  CASE o_orderkey % 4 WHEN 0 THEN '東京地方裁判所' WHEN 1 THEN NULL ELSE '大阪' END AS value, CAST(CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE 0.5 + 0.1 * (o_orderkey % 5) END AS DOUBLE) AS confidence, o_orderkey % 6 > 0 AS accepted, o_orderkey % 7 = 0 AS anchor, o_orderkey % 9 = 0 AS flagged,
  CASE o_orderkey % 10 WHEN 0 THEN NULL ELSE '名古屋地方裁判所' END AS new_value, CAST(0.86 AS DOUBLE) AS new_confidence, o_orderkey % 11 = 0 AS new_anchor, o_orderkey % 13 = 0 AS new_flagged"""


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_TEXTS + " FROM {orders}", orders=br.table(spark, sf, "orders"))


def court_names(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(spark, sf).select("doc_id", routes.specific_court(F.col("court")).alias("court"), routes.law_name(F.col("law")).alias("law"), routes.law_confidence(F.col("law"), F.col("route")).alias("confidence"))


def field_supplement(spark: SparkSession, sf: str) -> DataFrame:
    return routes.supplemented(_texts(spark, sf).withColumn("field", F.lit("jurisdiction"))).select("doc_id", "replace", "result")


def date_roles(spark: SparkSession, sf: str) -> DataFrame:
    """Points of the first and the last date of a contract's period clause."""
    from lexiform.functions import dates

    b = br.contract_blocks(spark, sf).filter("ord = 10001")
    every = dates.all_dates(F.col("norm"))
    first, last = F.coalesce(F.try_element_at(every, F.lit(1)), F.lit("契約締結日")), F.coalesce(F.try_element_at(every, F.lit(-1)), F.lit("-"))
    return b.select("doc_id", routes.date_role("effective_date", F.col("norm"), first).alias("begins"), routes.date_role("expiration_date", F.col("norm"), last).alias("ends"), routes.date_role("expiration_date", F.col("norm"), first).alias("wrong"))


def tail_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return routes.tail_candidates(br.contract_blocks(spark, sf), _routes(spark, sf)).select("doc_id", "field", "value", "confidence", "block_id")


QUERIES = {f.__name__: f for f in (contract_route, route_margins, court_names, field_supplement, date_roles, tail_candidates)}

_has = lambda c, w: f"regexp_matches({c}, '{alternatives(w)}')"
_SUMS = ", ".join(f"sum(CASE WHEN {_has('compact', words)} THEN {points}::DOUBLE ELSE 0 END) FILTER (rank <= 40) + max(CASE WHEN ord = 2 AND doc_id % 5 > 0 AND {_has('compact', hint)} THEN {more}::DOUBLE ELSE 0 END) AS {name}" for name, words, points, hint, more in routes.ROUTES)
_R = BLOCKS + f", rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rank FROM n), sm AS (SELECT doc_id, {_SUMS} FROM rk GROUP BY doc_id), rt AS (SELECT doc_id, round(greatest(LICENSE_OR_ITAKU, NDA, SERVICE), 6)::DOUBLE AS score, CASE WHEN greatest(LICENSE_OR_ITAKU, NDA, SERVICE) < 1.2 THEN 'UNKNOWN' WHEN LICENSE_OR_ITAKU >= greatest(NDA, SERVICE) THEN 'LICENSE_OR_ITAKU' WHEN NDA >= SERVICE THEN 'NDA' ELSE 'SERVICE' END AS route FROM sm)"
_case = lambda table, value: "CASE " + " ".join(f"WHEN route = '{r}' AND field IN ({', '.join(repr(f) for f in fields)}) THEN {points}" for r, (points, fields) in table.items()) + f" ELSE {value} END"
_T = f"WITH t AS ({_TEXTS} FROM orders)"
SQL = {
    "contract_route": _R + " SELECT doc_id, route, score FROM rt",
    "route_margins": _R + f", ff AS (SELECT route, unnest(['governing_law', 'jurisdiction', 'effective_date', 'expiration_date', 'counterparties', 'title']) AS field FROM (SELECT DISTINCT route FROM rt)) SELECT route, field, round({_case({r: (0.05, f) for r, f in routes.BIASED.items()}, 0.08)}, 6)::DOUBLE AS margin, ({_case(routes.BONUS, 0)})::DOUBLE AS bonus FROM ff",
    "court_names": _T + f", c AS (SELECT *, regexp_extract_all(court, '{routes.COURT}', 1) AS kinds, list_filter(regexp_extract_all(court, '{routes.ANY_COURT}', 1), lambda x: x NOT IN ('裁判所', '地方裁判所', '簡易裁判所', '家庭裁判所', '高等裁判所') AND NOT {_has('x', routes.NOT_A_COURT)}) AS others, regexp_extract(law, '(?i)laws? of (?:the )?(?:State of )?([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)?)', 1) AS e FROM t) SELECT doc_id, CASE WHEN len(kinds) > 0 THEN kinds[-1] WHEN len(others) > 0 THEN others[-1] END AS court, CASE WHEN {_has('law', ['日本法', '日本国法'])} OR lower(e) = 'japan' THEN '日本法' WHEN e <> '' THEN concat(e, ' law') WHEN law IN ('法', '準拠法', '適用法') THEN NULL ELSE law END AS law, round(least(0.96, 0.80 + CASE WHEN route = 'NDA' THEN 0.03 ELSE 0 END + CASE WHEN {_has('law', ['準拠法', '適用法'])} THEN 0.04 ELSE 0 END + CASE WHEN {_has('law', ['日本法', '日本国法'])} THEN 0.03 ELSE 0 END + CASE WHEN contains(law, '成立') AND contains(law, '効力') AND contains(law, '解釈') THEN 0.03 ELSE 0 END), 6)::DOUBLE AS confidence FROM c",
    "field_supplement": _T + ", s AS (SELECT *, new_value IS NOT NULL AND (NOT accepted OR value IS NULL OR anchor AND NOT new_anchor OR flagged AND NOT new_flagged OR coalesce(confidence, 0) + CASE WHEN route = 'NDA' THEN 0.05 ELSE 0.08 END < new_confidence) AS replace FROM t) SELECT doc_id, replace, CASE WHEN replace THEN new_value ELSE value END AS result FROM s",
    "date_roles": BLOCKS + " SELECT k AS doc_id, CASE k % 3 WHEN 0 THEN 0.34 WHEN 1 THEN 0.16 ELSE 0.24 END::DOUBLE AS begins, CASE k % 3 WHEN 0 THEN 0.50 WHEN 1 THEN 0.0 ELSE 0.40 END::DOUBLE AS ends, CASE k % 3 WHEN 0 THEN -0.12 WHEN 1 THEN 0.0 ELSE 0.0 END::DOUBLE AS wrong FROM p",
    "tail_candidates": _R + ", w AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS cnt, max(page) OVER (PARTITION BY doc_id) AS lp FROM rk), tl AS (SELECT * FROM w JOIN rt USING (doc_id) WHERE rank > least(floor(cnt * 0.7), greatest(0, cnt - 10)) OR page >= lp - 1), c AS (SELECT doc_id, page, printf('p%d_b%05d', page, ord) AS block_id, 'governing_law' AS field, '日本法' AS value, round(least(0.96, 0.83 + CASE WHEN route = 'NDA' THEN 0.03 ELSE 0 END + CASE WHEN contains(norm, '準拠法') THEN 0.04 ELSE 0 END), 6) AS confidence FROM tl WHERE contains(norm, '日本法') OR contains(norm, '日本国法') UNION ALL SELECT doc_id, page, printf('p%d_b%05d', page, ord), 'jurisdiction', regexp_extract(norm, '、([一-龥]{1,12}(地方|簡易|家庭|高等)裁判所)', 1), round(0.84 + CASE WHEN contains(norm, '専属') AND contains(norm, '合意') THEN 0.04 ELSE 0 END + CASE route WHEN 'NDA' THEN 0.03 WHEN 'UNKNOWN' THEN 0 ELSE 0.02 END, 6) FROM tl WHERE regexp_matches(norm, '(地方|簡易|家庭|高等)裁判所') AND contains(norm, '管轄')) SELECT doc_id, field, value, confidence::DOUBLE AS confidence, block_id FROM c QUALIFY row_number() OVER (PARTITION BY doc_id, field, value ORDER BY confidence DESC, page, block_id) = 1",
}
