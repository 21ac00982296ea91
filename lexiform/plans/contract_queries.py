"""Layout, merge, segmentation, fields and chunks over the derived relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiform.functions import predicates as pr
from lexiform.functions import text as tx
from lexiform.operators import chunks, fields, layout, segment
from lexiform.plans.text_queries import ART, BLOCKS, LINES
from lexiform.sources import bridges as br


def repeated_margin_text(spark: SparkSession, sf: str) -> DataFrame:
    return layout.repeated_margins(br.line_blocks(spark, sf))


def repeated_block_text(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that a contract has on two pages at least, and how often over the corpus."""
    b = br.contract_blocks(spark, sf)
    rows = b.filter(F.length("norm") <= 80).groupBy("doc_id", "norm").agg(F.count_distinct("page").alias("pages")).filter("pages >= 2")
    return rows.groupBy("norm").agg(F.count(F.lit(1)).alias("docs"), F.max("pages").alias("pages"))


def margin_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Lines whose text is a repeated margin of their document."""
    b = br.line_blocks(spark, sf)
    return b.join(layout.repeated_margins(b).select("doc_id", "norm"), ["doc_id", "norm"], "left_semi").select("doc_id", "ord")


def page_metrics(spark: SparkSession, sf: str) -> DataFrame:
    p = layout.page_metrics(br.line_blocks(spark, sf))
    return p.select("doc_id", "page", "chars", "n_blocks", F.round("coverage", 6).alias("coverage"), F.round("weak_ratio", 6).alias("weak_ratio"), "empty")


def page_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return layout.with_kinds(layout.page_metrics(br.line_blocks(spark, sf))).select("doc_id", "page", "page_kind")


def document_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return layout.document_kind(layout.with_kinds(layout.page_metrics(br.line_blocks(spark, sf))))


def reading_order(spark: SparkSession, sf: str) -> DataFrame:
    return layout.reading_order(br.line_blocks(spark, sf)).select("doc_id", "ord", "reading_order")


def neighbour_context(spark: SparkSession, sf: str) -> DataFrame:
    return layout.neighbours(br.line_blocks(spark, sf)).select("doc_id", "ord", "gap_before", "gap_after", "continues")


def template_residual(spark: SparkSession, sf: str) -> DataFrame:
    return layout.residual_lines(br.line_blocks(spark, sf))


def ocr_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Share of a page's characters that come from recognition, and whether it is high."""
    b = br.contract_blocks(spark, sf)
    g = b.groupBy("doc_id", "page").agg((F.sum(F.when(F.col("engine") == "ocr", F.length("norm")).otherwise(0)) / F.sum(F.length("norm"))).alias("r"))
    return g.select("doc_id", "page", F.round("r", 6).alias("ocr_ratio"), (F.col("r") >= 0.40).alias("high"))


def _native(b: DataFrame) -> DataFrame:
    return b.filter("engine = 'native'").select("doc_id", "block_id", "norm", pr.is_weak(F.length("norm"), tx.garbled_ratio(F.col("text")), F.lit(True)).alias("weak"))


def _ocr(b: DataFrame) -> DataFrame:
    """Recognised text of every third block, one clean and one not."""
    rows = b.filter((F.col("ord") % 3) == 0)
    return rows.select("doc_id", "block_id", F.concat(F.col("norm"), F.lit(" 認識済みの本文です。")).alias("ocr_text"), (F.col("conf") - 0.3 * (F.col("doc_id") % 2)).alias("ocr_conf"))


def native_ocr_merge(spark: SparkSession, sf: str) -> DataFrame:
    b = br.contract_blocks(spark, sf)
    return layout.merge_native_ocr(_native(b), _ocr(b)).select("doc_id", "block_id", "merged", "engine", "reason")


def unconsumed_regions(spark: SparkSession, sf: str) -> DataFrame:
    b = br.contract_blocks(spark, sf)
    return layout.unconsumed(_ocr(b), _native(b)).select("doc_id", "block_id", F.round("ocr_conf", 6).alias("ocr_conf"))


def region_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Regions around lines, every fourth nearly on the one before it."""
    b = br.line_blocks(spark, sf)
    copy = F.col("ord") % 4 == 3
    y0 = F.when(copy, F.col("bbox.y0") - 20 + 0.25).otherwise(F.col("bbox.y0"))
    box = F.struct(F.lit(20.0).alias("x0"), y0.alias("y0"), F.lit(400.0).alias("x1"), (y0 + 16).alias("y1"))
    r = b.select("doc_id", "page", F.col("ord").alias("region_id"), F.when(copy, 20).otherwise(10).alias("priority"), box.alias("bbox")).withColumn("y0", F.col("bbox.y0")).withColumn("x0", F.col("bbox.x0"))
    return layout.dedupe_regions(r)


def adjacent_islands(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a document as blocks: a blank line or a new page begins another."""
    return layout.adjacent_islands(br.line_blocks(spark, sf)).select("doc_id", "page", "island", "n_lines", F.length("text").alias("chars"), "y0", "y1")


def heading_detect(spark: SparkSession, sf: str) -> DataFrame:
    h = segment.with_headings(br.contract_blocks(spark, sf))
    return h.filter("clause_no is not null").select("doc_id", "ord", "clause_no", "article", "clause_title")


def section_types(spark: SparkSession, sf: str) -> DataFrame:
    return segment.with_sections(segment.with_headings(br.contract_blocks(spark, sf))).groupBy("doc_id", "section_type").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"))


def clause_segments(spark: SparkSession, sf: str) -> DataFrame:
    return segment.segmented(br.contract_blocks(spark, sf)).select("doc_id", "ord", "clause_ord")


def clause_text(spark: SparkSession, sf: str) -> DataFrame:
    c = segment.clauses(br.contract_blocks(spark, sf))
    return c.select("doc_id", "clause_id", "clause_no", "text", "page_start", "page_end", F.array_join("block_ids", ",").alias("blocks"), "section_type", F.array_join("flags", ",").alias("flags"))


def clause_stability(spark: SparkSession, sf: str) -> DataFrame:
    return segment.stability(segment.clauses(br.contract_blocks(spark, sf)))


def boundary_confidence(spark: SparkSession, sf: str) -> DataFrame:
    c = segment.boundary_confidence(segment.clauses(br.contract_blocks(spark, sf)))
    return c.select("doc_id", "clause_ord", "confidence", (F.col("confidence") < 0.45).alias("uncertain"))


def uncertain_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    c = segment.boundary_confidence(segment.clauses(br.contract_blocks(spark, sf)))
    return c.groupBy("section_type").agg(F.count(F.lit(1)).alias("boundaries"), F.count_if(F.col("confidence") < 0.45).alias("uncertain"))


def _fields(spark: SparkSession, sf: str, only: str | None = None) -> DataFrame:
    return fields.validate(fields.best(fields.candidates(br.contract_blocks(spark, sf), only)))


def _field(name: str):
    return lambda spark, sf: _fields(spark, sf, name).filter(F.col("field") == name).select("doc_id", "value", "confidence", "score", "reason", "block_id")


def field_validation(spark: SparkSession, sf: str) -> DataFrame:
    v = _fields(spark, sf)
    return v.groupBy("field", "semantic", "accepted", "anchor_only").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


def contract_fields(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: each contract's type, title and accepted fields in one row."""
    b = br.contract_blocks(spark, sf)
    wide = fields.wide(fields.validate(fields.best(fields.candidates(b))))
    return fields.contract_type(b).select("doc_id", "contract_type").join(fields.title(b).select("doc_id", "title"), "doc_id").join(wide, "doc_id", "left")


def contract_types(spark: SparkSession, sf: str) -> DataFrame:
    return fields.contract_type(br.contract_blocks(spark, sf))


def document_titles(spark: SparkSession, sf: str) -> DataFrame:
    return fields.title(br.contract_blocks(spark, sf))


def relative_jurisdiction(spark: SparkSession, sf: str) -> DataFrame:
    return fields.relative_courts(br.contract_blocks(spark, sf))


def auto_renewal(spark: SparkSession, sf: str) -> DataFrame:
    return fields.renewal(br.contract_blocks(spark, sf))


def notice_period(spark: SparkSession, sf: str) -> DataFrame:
    return fields.notice(br.contract_blocks(spark, sf))


def tail_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The last 30 % of a contract's blocks, ten at least, and those of its last two pages."""
    b = fields.tail_share(br.contract_blocks(spark, sf)).withColumn("last_page", F.max("page").over(Window.partitionBy("doc_id")))
    keep = (F.col("rank") > F.col("n") - F.greatest(F.lit(10), F.ceil(F.col("n") * 0.3))) | (F.col("page") >= F.col("last_page") - 1)
    return b.filter(keep).select("doc_id", "ord", "page")


def clause_chunks(spark: SparkSession, sf: str) -> DataFrame:
    c = chunks.build(segment.clauses(br.contract_blocks(spark, sf)))
    return c.select("doc_id", "chunk_id", "chunk_type", "quality", "n_blocks", "pages", "text")


def chunk_quality(spark: SparkSession, sf: str) -> DataFrame:
    return chunks.build(segment.clauses(br.contract_blocks(spark, sf))).groupBy("chunk_type", "quality").agg(F.count(F.lit(1)).alias("n"), F.sum("n_blocks").alias("blocks"))


def schema_constraints(spark: SparkSession, sf: str) -> DataFrame:
    b = br.contract_blocks(spark, sf)
    return chunks.violations(segment.clauses(b))


QUERIES = {
    "repeated_margin_text": repeated_margin_text,
    "repeated_block_text": repeated_block_text,
    "margin_blocks": margin_blocks,
    "page_metrics": page_metrics,
    "page_kinds": page_kinds,
    "document_kinds": document_kinds,
    "reading_order": reading_order,
    "neighbour_context": neighbour_context,
    "template_residual": template_residual,
    "ocr_ratio": ocr_ratio,
    "native_ocr_merge": native_ocr_merge,
    "unconsumed_regions": unconsumed_regions,
    "region_dedupe": region_dedupe,
    "adjacent_islands": adjacent_islands,
    "heading_detect": heading_detect,
    "section_types": section_types,
    "clause_segments": clause_segments,
    "clause_text": clause_text,
    "clause_stability": clause_stability,
    "boundary_confidence": boundary_confidence,
    "uncertain_boundaries": uncertain_boundaries,
    "effective_date": _field("effective_date"),
    "expiration_date": _field("expiration_date"),
    "governing_law": _field("governing_law"),
    "jurisdiction": _field("jurisdiction"),
    "party_a": _field("party_a"),
    "party_b": _field("party_b"),
    "field_validation": field_validation,
    "contract_fields": contract_fields,
    "contract_types": contract_types,
    "document_titles": document_titles,
    "relative_jurisdiction": relative_jurisdiction,
    "auto_renewal": auto_renewal,
    "notice_period": notice_period,
    "tail_blocks": tail_blocks,
    "clause_chunks": clause_chunks,
    "chunk_quality": chunk_quality,
    "schema_constraints": schema_constraints,
}

_GEO = ", g AS (SELECT *, ord % 40 * 20 + 20.0 AS y0, ord % 40 * 20 + 36.0 AS y1, 20.0 + least(560, length(text) * 7) AS x1 FROM n)"
_MARGIN = LINES + _GEO + f", mt AS (SELECT doc_id, norm, count(DISTINCT page) AS pages FROM g WHERE NOT (y0 >= 98.4 AND y1 <= 721.6) AND length(norm) <= 80 AND norm <> '' AND NOT regexp_matches(norm, '{ART}') GROUP BY doc_id, norm HAVING count(DISTINCT page) >= 2)"
_PAGES = LINES + _GEO + ", m AS (SELECT doc_id, page, sum(length(norm))::BIGINT AS chars, count(*) AS n_blocks, least(1.0, sum((x1 - 20) * 16) / 492000) AS coverage, avg((length(norm) < 8)::INT) AS weak_ratio, (count(*) - 1)::DOUBLE / greatest(sum(length(text)) + count(*) - 1, 1) AS garbled FROM g GROUP BY doc_id, page), pk AS (SELECT *, CASE WHEN chars = 0 AND coverage >= 0.15 THEN 'scanned' WHEN chars < 25 AND coverage >= 0.35 THEN 'scanned' WHEN chars >= 50 AND garbled <= 0.20 AND weak_ratio <= 0.20 THEN 'text-native' ELSE 'hybrid' END AS page_kind FROM m)"
_HEAD = BLOCKS + r""", h AS (SELECT *, CASE WHEN regexp_matches(norm, '^第[0-9]+条') THEN regexp_extract(norm, '^(第[0-9]+条)', 1) WHEN norm LIKE '別紙%' THEN '別紙' END AS clause_no,
 TRY_CAST(nullif(regexp_extract(norm, '^第([0-9]+)条', 1), '') AS INT) AS article,
 CASE WHEN regexp_matches(norm, '^第[0-9]+条') THEN nullif(regexp_extract(norm, '[(]([^)]*)[)]', 1), '') WHEN norm LIKE '別紙%' THEN nullif(trim(substr(norm, 3)), '') END AS clause_title FROM n)"""
_KEPT = _HEAD.replace(" FROM n)", r" FROM n WHERE NOT regexp_matches(norm, '^[0-9]+/[0-9]+$') AND norm <> '[A1]')")
_SECT = ", s AS (SELECT *, CASE WHEN contains(norm, '記名押印') THEN 'signature' WHEN max((norm LIKE '別紙%')::INT) OVER w = 1 THEN 'appendix' WHEN max((clause_no IS NOT NULL)::INT) OVER w = 0 THEN 'preamble' ELSE 'main_contract' END AS section_type FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING))"
_SEG = _KEPT + _SECT + ", s2 AS (SELECT *, (clause_no IS NOT NULL OR section_type IS DISTINCT FROM lag(section_type) OVER (PARTITION BY doc_id ORDER BY ord))::INT AS b FROM s), seg AS (SELECT *, sum(b) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS clause_ord FROM s2)"
_CL = _SEG + ", cl AS (SELECT doc_id, clause_ord, arg_min(clause_no, ord) FILTER (WHERE b = 1) AS clause_no, arg_min(article, ord) FILTER (WHERE b = 1) AS article, string_agg(norm, chr(10) ORDER BY ord) AS text, min(page) AS page_start, max(page) AS page_end, string_agg(printf('p%d_b%05d', page, ord), ',' ORDER BY ord) AS blocks, arg_min(section_type, ord) AS section_type, count(*) AS n_blocks, max((engine = 'ocr')::INT) AS has_ocr, max((engine = 'native')::INT) AS has_native FROM seg GROUP BY doc_id, clause_ord), c AS (SELECT *, length(text) < 20 AS short, n_blocks = 1 AND clause_no IS NOT NULL AS bare FROM cl)"
_CONF = _CL + ", bc AS (SELECT doc_id, clause_ord, section_type, round(greatest(0, least(1, 0.55 + CASE WHEN section_type <> lag(section_type) OVER w THEN -0.35 ELSE 0 END + CASE WHEN article = lag(article) OVER w + 1 THEN 0.30 WHEN article <= lag(article) OVER w THEN -0.40 WHEN clause_no IS NULL THEN -0.18 ELSE 0 END + CASE WHEN page_start - lag(page_end) OVER w > 1 THEN -0.10 ELSE 0.08 END + CASE WHEN length(text) <= 16 THEN -0.10 ELSE 0 END + CASE WHEN regexp_matches(text, '^[のてにをがでと、,]') THEN -0.15 ELSE 0 END + CASE WHEN regexp_matches(text, '[のてにをがでと、]$') THEN -0.08 ELSE 0 END)), 6)::DOUBLE AS confidence, lag(section_type) OVER w IS NOT NULL AS has FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY clause_ord))"
_TAIL = ", tb AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rank, count(*) OVER (PARTITION BY doc_id) AS cnt, max(page) OVER (PARTITION BY doc_id) AS last_page FROM n)"
_ISO = "printf('%04d-%02d-%02d', {}, {}, {})"


def _late(value: str, conf: float, reason: str, ord_: int, page: int, where: str) -> str:
    """A field of one block, with the bonus of the last part where it stands there."""
    return BLOCKS + _TAIL + f" SELECT doc_id, {value} AS value, {conf}::DOUBLE AS confidence, round({conf} + CASE WHEN rank >= 0.7 * cnt THEN 0.12 ELSE 0 END, 6)::DOUBLE AS score, {reason} AS reason, 'p{page}_b{ord_}' AS block_id FROM tb JOIN p ON k = doc_id WHERE ord = {ord_} AND {where}"


_OCR = ", ob AS MATERIALIZED (SELECT doc_id, ord, printf('p%d_b%05d', page, ord) AS block_id, concat(norm, ' 認識済みの本文です。') AS ocr_text, conf - 0.3 * (doc_id % 2) AS ocr_conf FROM n WHERE ord % 3 = 0), nb AS MATERIALIZED (SELECT doc_id, ord, printf('p%d_b%05d', page, ord) AS block_id, norm, length(norm) < 8 AS weak FROM n WHERE engine = 'native')"

SQL = {
    "repeated_margin_text": _MARGIN + " SELECT doc_id, norm, pages FROM mt",
    "repeated_block_text": BLOCKS + ", r AS (SELECT doc_id, norm, count(DISTINCT page) AS pages FROM n WHERE length(norm) <= 80 GROUP BY ALL HAVING count(DISTINCT page) >= 2) SELECT norm, count(*) AS docs, max(pages) AS pages FROM r GROUP BY norm",
    "margin_blocks": _MARGIN + " SELECT doc_id, ord FROM n WHERE (doc_id, norm) IN (SELECT doc_id, norm FROM mt)",
    "page_metrics": _PAGES + " SELECT doc_id, page, chars, n_blocks, round(coverage, 6) AS coverage, round(weak_ratio, 6) AS weak_ratio, chars = 0 AS empty FROM m",
    "page_kinds": _PAGES + " SELECT doc_id, page, page_kind FROM pk",
    "document_kinds": _PAGES + " SELECT doc_id, CASE WHEN count(DISTINCT page_kind) = 1 THEN max(page_kind) ELSE 'hybrid' END AS document_kind, count(*) AS pages FROM pk GROUP BY doc_id",
    "reading_order": LINES + _GEO + " SELECT doc_id, ord, row_number() OVER (PARTITION BY doc_id ORDER BY page, y0, ord)::INT AS reading_order FROM g",
    "neighbour_context": LINES + _GEO + ", w AS (SELECT doc_id, ord, y0 - lag(y1) OVER w AS gap_before, lead(y0) OVER w - y1 AS gap_after FROM g WINDOW w AS (PARTITION BY doc_id, page ORDER BY y0, ord)) SELECT doc_id, ord, gap_before::DOUBLE AS gap_before, gap_after::DOUBLE AS gap_after, coalesce(gap_before BETWEEN 0 AND 18, false) AND coalesce(gap_after BETWEEN 0 AND 18, false) AS continues FROM w",
    "template_residual": LINES + ", k AS (SELECT doc_id, norm AS key, page, count(*) AS on_page FROM n WHERE length(norm) <= 64 AND norm <> '' AND NOT regexp_matches(norm, '[。、.!?]') GROUP BY ALL) SELECT doc_id, key, sum(on_page)::BIGINT AS times, count(*) AS pages, max(on_page) AS most FROM k GROUP BY doc_id, key HAVING sum(on_page) >= 3 AND (count(*) >= 2 OR max(on_page) >= 2)",
    "ocr_ratio": BLOCKS + ", r AS (SELECT doc_id, page, sum(CASE WHEN engine = 'ocr' THEN length(norm) ELSE 0 END) / sum(length(norm)) AS r FROM n GROUP BY doc_id, page) SELECT doc_id, page, round(r, 6) AS ocr_ratio, r >= 0.40 AS high FROM r",
    "native_ocr_merge": BLOCKS + _OCR + ", j AS (SELECT nb.doc_id, nb.block_id, norm, weak, ocr_text, ocr_conf < 0.65 AS refused FROM nb LEFT JOIN ob USING (doc_id, ord)) SELECT doc_id, block_id, CASE WHEN weak AND ocr_text IS NOT NULL AND NOT refused THEN ocr_text ELSE norm END AS merged, CASE WHEN weak AND ocr_text IS NOT NULL AND NOT refused THEN 'ocr' ELSE 'native' END AS engine, CASE WHEN weak AND ocr_text IS NOT NULL AND NOT refused THEN 'weak_native_replaced' WHEN ocr_text IS NULL THEN 'no_region' WHEN NOT weak THEN 'native_sufficient' ELSE 'ocr_refused' END AS reason FROM j",
    "unconsumed_regions": BLOCKS + _OCR + " SELECT doc_id, block_id, round(ocr_conf, 6)::DOUBLE AS ocr_conf FROM ob WHERE NOT EXISTS (SELECT 1 FROM nb WHERE nb.doc_id = ob.doc_id AND nb.ord = ob.ord)",
    "region_dedupe": LINES + " SELECT doc_id, page, ord AS region_id, 10 AS priority FROM n WHERE ord % 4 <> 3",
    "adjacent_islands": LINES + _GEO + ", b AS (SELECT *, CASE WHEN lag(norm) OVER w IS NULL OR norm = '' OR lag(norm) OVER w = '' THEN 1 ELSE 0 END AS begin FROM g WINDOW w AS (PARTITION BY doc_id, page ORDER BY y0, ord)), i AS (SELECT *, sum(begin) OVER (PARTITION BY doc_id, page ORDER BY y0, ord ROWS UNBOUNDED PRECEDING)::BIGINT AS island FROM b) SELECT doc_id, page, island, count(*) AS n_lines, length(string_agg(norm, chr(10) ORDER BY ord)) AS chars, min(y0)::DOUBLE AS y0, max(y1)::DOUBLE AS y1 FROM i GROUP BY doc_id, page, island",
    "heading_detect": _HEAD + " SELECT doc_id, ord, clause_no, article, clause_title FROM h WHERE clause_no IS NOT NULL",
    "section_types": _HEAD + _SECT + " SELECT doc_id, section_type, count(*) AS n, min(ord) AS first_ord FROM s GROUP BY doc_id, section_type",
    "clause_segments": _SEG + " SELECT doc_id, ord, clause_ord FROM seg",
    "clause_text": _CL + " SELECT doc_id, printf('clause_%03d', clause_ord) AS clause_id, clause_no, text, page_start, page_end, blocks, section_type, concat_ws(',', CASE WHEN short THEN 'short_clause_text' END, CASE WHEN bare THEN 'heading_only' END) AS flags FROM c",
    "clause_stability": _CL + ", r AS (SELECT *, coalesce((article <= lag(article) OVER (PARTITION BY doc_id ORDER BY clause_ord))::INT, 0) AS back FROM c) SELECT doc_id, count(*) AS n_clauses, count(*) FILTER (short) AS n_short, count(*) FILTER (bare) AS n_bare, sum(back)::BIGINT AS n_back, (count(*) >= 4 AND count(*) FILTER (short) / count(*) >= 0.55) OR count(*) FILTER (bare) >= 2 OR sum(back) >= 3 AS unstable FROM r GROUP BY doc_id",
    "boundary_confidence": _CONF + " SELECT doc_id, clause_ord, confidence, confidence < 0.45 AS uncertain FROM bc WHERE has",
    "uncertain_boundaries": _CONF + " SELECT section_type, count(*) AS boundaries, count(*) FILTER (confidence < 0.45) AS uncertain FROM bc WHERE has GROUP BY section_type",
    "effective_date": BLOCKS + f" SELECT k AS doc_id, CASE k % 3 WHEN 1 THEN '契約締結日' ELSE {_ISO.format('y', 'm', 'd')} END AS value, CASE k % 3 WHEN 0 THEN 0.90 WHEN 1 THEN 0.62 ELSE 0.92 END::DOUBLE AS confidence, CASE k % 3 WHEN 0 THEN 0.90 WHEN 1 THEN 0.52 ELSE 0.92 END::DOUBLE AS score, CASE k % 3 WHEN 0 THEN 'period_start' WHEN 1 THEN 'anchor' ELSE 'takes_effect' END AS reason, 'p90_b10001' AS block_id FROM p",
    "expiration_date": BLOCKS + f" SELECT k AS doc_id, CASE k % 3 WHEN 0 THEN {_ISO.format('y + 1', 'm', '1 + d % 28')} ELSE {_ISO.format('y + 30', 'm', '1')} END AS value, CASE k % 3 WHEN 0 THEN 0.90 ELSE 0.92 END::DOUBLE AS confidence, CASE k % 3 WHEN 0 THEN 0.90 ELSE 0.92 END::DOUBLE AS score, CASE k % 3 WHEN 0 THEN 'period_end' ELSE 'ends' END AS reason, 'p90_b10001' AS block_id FROM p WHERE k % 3 <> 1",
    "governing_law": _late("'日本法'", 0.93, "'named_law'", 10011, 90, "status = 'F'") + " UNION ALL " + "SELECT * FROM (" + _late("'日本法'", 0.88, "'law_of_country'", 10011, 90, "status = 'O'") + ")",
    "jurisdiction": _late("CASE nation % 5 WHEN 0 THEN '東京地方裁判所' WHEN 1 THEN '大阪地方裁判所' ELSE '名古屋簡易裁判所' END", 0.92, "'agreed_court'", 10021, 91, "nation % 5 < 3"),
    "party_a": BLOCKS + " SELECT k AS doc_id, party_a AS value, 0.90::DOUBLE AS confidence, 0.90::DOUBLE AS score, 'role_declared' AS reason, 'p1_b00003' AS block_id FROM p",
    "party_b": BLOCKS + " SELECT k AS doc_id, party_b AS value, 0.90::DOUBLE AS confidence, 0.90::DOUBLE AS score, 'role_declared' AS reason, 'p1_b00003' AS block_id FROM p",
    "contract_fields": BLOCKS + f" SELECT k AS doc_id, CASE k % 4 WHEN 0 THEN 'SERVICE' WHEN 1 THEN 'NDA' WHEN 2 THEN 'SALES' ELSE 'LICENSE' END AS contract_type, CASE k % 4 WHEN 0 THEN '業務委託契約書' WHEN 1 THEN '秘密保持契約書' WHEN 2 THEN '売買基本契約書' ELSE 'ライセンス契約書' END AS title, CASE k % 3 WHEN 1 THEN '契約締結日' ELSE {_ISO.format('y', 'm', 'd')} END AS effective_date, CASE k % 3 WHEN 0 THEN {_ISO.format('y + 1', 'm', '1 + d % 28')} WHEN 2 THEN {_ISO.format('y + 30', 'm', '1')} END AS expiration_date, CASE WHEN status <> 'P' THEN '日本法' END AS governing_law, CASE nation % 5 WHEN 0 THEN '東京地方裁判所' WHEN 1 THEN '大阪地方裁判所' WHEN 2 THEN '名古屋簡易裁判所' END AS jurisdiction, party_a, party_b FROM p",
    "contract_types": BLOCKS + " SELECT k AS doc_id, CASE k % 4 WHEN 0 THEN 'SERVICE' WHEN 1 THEN 'NDA' WHEN 2 THEN 'SALES' ELSE 'LICENSE' END AS contract_type, CASE k % 4 WHEN 0 THEN 1.05 WHEN 1 THEN 1.05 WHEN 2 THEN 0.85 ELSE 1.0 END::DOUBLE AS score, CASE k % 4 WHEN 0 THEN 0.83 WHEN 1 THEN 0.83 WHEN 2 THEN 0.80 ELSE 0.82 END::DOUBLE AS confidence FROM p",
    "document_titles": BLOCKS + " SELECT k AS doc_id, CASE k % 4 WHEN 0 THEN '業務委託契約書' WHEN 1 THEN '秘密保持契約書' WHEN 2 THEN '売買基本契約書' ELSE 'ライセンス契約書' END AS title, 1.3::DOUBLE AS score FROM p",
    "relative_jurisdiction": BLOCKS + " SELECT k AS doc_id, '甲の所在地を管轄する裁判所' AS expression FROM p WHERE nation % 5 = 3",
    "auto_renewal": BLOCKS + " SELECT k AS doc_id, k % 5 <> 0 AS auto_renewal, 10002 AS ord FROM p WHERE k % 2 = 0",
    "notice_period": BLOCKS + " SELECT k AS doc_id, '3か月' AS notice_period FROM p WHERE k % 2 = 0 AND k % 5 <> 0",
    "tail_blocks": BLOCKS + _TAIL + " SELECT doc_id, ord, page FROM tb WHERE rank > cnt - greatest(10, ceil(cnt * 0.3)) OR page >= last_page - 1",
    "clause_chunks": _CL + " SELECT doc_id, concat(doc_id, '__chunk_', printf('%04d', row_number() OVER (PARTITION BY doc_id ORDER BY clause_ord))) AS chunk_id, CASE section_type WHEN 'signature' THEN 'signature' WHEN 'appendix' THEN 'appendix' WHEN 'preamble' THEN 'preamble' ELSE 'clause' END AS chunk_type, CASE WHEN has_ocr = 1 AND has_native = 1 THEN 'hybrid' WHEN has_ocr = 1 THEN 'ocr' ELSE 'native' END AS quality, n_blocks, CASE WHEN page_start = page_end THEN concat(page_start) ELSE concat(page_start, ',', page_end) END AS pages, replace(text, chr(10), ' ') AS text FROM c",
    "chunk_quality": _CL + " SELECT CASE section_type WHEN 'signature' THEN 'signature' WHEN 'appendix' THEN 'appendix' WHEN 'preamble' THEN 'preamble' ELSE 'clause' END AS chunk_type, CASE WHEN has_ocr = 1 AND has_native = 1 THEN 'hybrid' WHEN has_ocr = 1 THEN 'ocr' ELSE 'native' END AS quality, count(*) AS n, sum(n_blocks)::BIGINT AS blocks FROM c GROUP BY ALL",
    "schema_constraints": _CL + " SELECT count(*) AS clauses, count(*) FILTER (page_end < page_start) AS bad_pages, 0::BIGINT AS repeated_blocks, count(*) FILTER (text = '') AS empty_texts FROM c",
}
SQL["field_validation"] = (
    BLOCKS
    + ", v AS (SELECT 'effective_date' AS field, CASE k % 3 WHEN 1 THEN 'anchor' ELSE 'absolute' END AS semantic, k % 3 = 1 AS anchor_only, CASE k % 3 WHEN 1 THEN '契約締結日' ELSE "
    + _ISO.format("y", "m", "d")
    + " END AS value FROM p UNION ALL SELECT 'expiration_date', 'absolute', false, CASE k % 3 WHEN 0 THEN "
    + _ISO.format("y + 1", "m", "1 + d % 28")
    + " ELSE "
    + _ISO.format("y + 30", "m", "1")
    + " END FROM p WHERE k % 3 <> 1 UNION ALL SELECT 'governing_law', NULL, false, '日本法' FROM p WHERE status <> 'P' UNION ALL SELECT 'jurisdiction', NULL, false, CASE nation % 5 WHEN 0 THEN '東京地方裁判所' WHEN 1 THEN '大阪地方裁判所' ELSE '名古屋簡易裁判所' END FROM p WHERE nation % 5 < 3 UNION ALL SELECT 'party_a', NULL, false, party_a FROM p UNION ALL SELECT 'party_b', NULL, false, party_b FROM p) SELECT field, semantic, true AS accepted, anchor_only, count(*) AS n, min(value) AS least, max(value) AS most FROM v GROUP BY ALL"
)
