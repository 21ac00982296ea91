"""Headings inside blocks, sections, and repairs of clauses, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions import vocabulary as v
from lexiform.operators import segment
from lexiform.plans import role_queries as rq
from lexiform.sources import bridges as br

#: Portable SQL: ten clauses of an order as a splitter may leave them.
_DRAFTS = """SELECT k AS doc_id, i AS clause_ord, CASE WHEN t IN (1, 4, 7) THEN NULL WHEN t = 5 THEN concat('第', 150 + i, '条') WHEN t = 9 THEN '第1条' ELSE concat('第', 10 + i, '条') END AS clause_no,
  CAST(CASE WHEN t IN (1, 4, 7) THEN NULL WHEN t = 5 THEN 150 + i WHEN t = 9 THEN 1 ELSE 10 + i END AS INT) AS article, CASE WHEN t = 6 THEN '目的' END AS clause_title,
  CASE WHEN i >= 8 AND k % 2 = 0 THEN 'appendix' ELSE 'main_contract' END AS section_type, 1 + CAST(floor(i / 3) AS INT) + CASE WHEN i > 5 THEN k % 2 * 3 ELSE 0 END AS page,
  CASE t WHEN 1 THEN 'を含むものとする。' WHEN 4 THEN '前項の場合において、乙は甲に対し報告する。' WHEN 7 THEN '(別途協議)' WHEN 5 THEN concat('第', 150 + i, '条に定める方法により通知する。') WHEN 9 THEN '第1条 短い。'
    WHEN 10 THEN concat('第', 10 + i, '条第2項の規定') WHEN 11 THEN concat('第', 10 + i, '条 第', 10 + i, '条 (報告) (報告) 乙は報告する。') ELSE concat('第', 10 + i, '条 乙は、甲に対し、委託業務の内容を遅滞なく報告する。') END AS text"""
_T = "(k * 3 + i * i + i) % 12"


def drafts(spark: SparkSession, sf: str) -> DataFrame:
    o = br.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i")).withColumn("t", F.expr(_T))
    c = spark.sql(_DRAFTS + " FROM {o}", o=o)
    return c.withColumns({"page_start": F.col("page"), "page_end": F.col("page"), "block_ids": F.array(F.format_string("b%d", "clause_ord")), "flags": F.array().cast("array<string>")})


def clause_post_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Clauses after all merges."""
    c = segment.repaired(drafts(spark, sf))
    return c.select("doc_id", "clause_ord", "clause_no", "page_end", "text", F.array_join("block_ids", ",").alias("blocks"), F.array_join("flags", ",").alias("flags"))


def _one_merge(name: str):
    return lambda spark, sf: segment.repaired(drafts(spark, sf), [name]).select("doc_id", "clause_ord", F.size("block_ids").alias("merged"), F.array_join("flags", ",").alias("flags"))


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_JOINED + " FROM {orders}", orders=br.table(spark, sf, "orders"))


_JOINED = """SELECT o_orderkey AS doc_id, CASE o_orderkey % 4
  WHEN 0 THEN concat('甲は代金を支払う。第', o_orderkey % 20 + 1, '条(納品) 乙は納品する。民法第415条に基づき解除する。(以下略)第', o_orderkey % 20 + 2, '条 乙は保証する。第3条に定める。')
  WHEN 1 THEN concat('第', o_orderkey % 9 + 1, '条 甲は、第2条第1項により通知する。 第', o_orderkey % 9 + 2, '条 以上')
  WHEN 2 THEN '前文のみ' ELSE concat('[注]第', o_orderkey % 7 + 1, '条(期間): 第十二条(雑則)') END AS norm,
  CASE o_orderkey % 5 WHEN 0 THEN '第1章 総則 第1章 総則' WHEN 1 THEN '第2節総則規定第2節総則規定' WHEN 2 THEN concat('第', o_orderkey % 8 + 1, '章 通則') WHEN 3 THEN '第1条 第1条' ELSE '第3編 総 則 第3編 総則' END AS heading"""


def embedded_headings(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf).select("doc_id", F.posexplode(segment.embedded_headings(F.col("norm"))).alias("pos", "part"))


def repeated_headings(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf).select("doc_id", segment.single_heading(F.col("heading")).alias("heading"))


def block_sections(spark: SparkSession, sf: str) -> DataFrame:
    """What section a block speaks of, whether its words open it, why its boundary is doubtful, and what kind of title or
    citation it is."""
    from pyspark.sql import Window

    norm, no = F.col("norm"), F.col("clause_no")
    rows = segment.with_headings(rq.lines(spark, sf))
    seen = F.coalesce(F.max(no.startswith("第")).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)), F.lit(False))
    rows = rows.withColumn("section_type", segment.section_of(norm, F.coalesce(no, F.lit("")), seen))
    last = F.last(no, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    return rows.select("doc_id", "ord", "section_type", segment.boundary_signal(norm, F.col("section_type")).alias("opens"), segment.boundary_category(norm, F.col("section_type")).alias("category"), segment.subtitle_candidate(norm, last, F.lit(True)).alias("subtitle"))


def article_references(spark: SparkSession, sf: str) -> DataFrame:
    """Texts that begin with an article number: headings, or citations by what follows."""
    d = drafts(spark, sf)
    return d.filter("text like '第%'").select("doc_id", "clause_ord", segment.in_body_reference(F.col("text")).alias("cites"))


QUERIES = {f.__name__: f for f in (clause_post_merge, embedded_headings, repeated_headings, block_sections, article_references)} | {
    "orphan_paragraphs": _one_merge("attached_orphan_paragraph"),
    "trailing_fragments": _one_merge("merged_trailing_fragment"),
    "reversed_numbers": _one_merge("repaired_reversed_clause_number"),
    "citation_clauses": _one_merge("merged_citation_like_clause"),
}

_N = v.NUMBER
_SCORE = "greatest(0, least(1, 0.55 + CASE WHEN r.section_type <> f.hs THEN -0.35 ELSE 0 END + CASE WHEN r.article = f.ha + 1 THEN 0.30 WHEN r.article <= f.ha THEN -0.40 WHEN r.article IS NOT NULL AND f.ha IS NOT NULL THEN 0 WHEN r.clause_no IS NULL THEN -0.18 ELSE 0 END + CASE WHEN r.page_start - f.hp <= 1 THEN 0.08 ELSE -0.10 END + CASE WHEN length(r.flat) <= 16 THEN -0.10 ELSE 0 END + CASE WHEN regexp_matches(r.flat, '^[のてにをがでと、,]') THEN -0.15 ELSE 0 END + CASE WHEN regexp_matches(r.flat, '[のてにをがでと、]$') THEN -0.08 ELSE 0 END))"
_NONE = "r.section_type = f.hs AND r.clause_no IS NULL AND f.hn IS NOT NULL"
_HOLDS = {
    "attached_orphan_paragraph": f"{_NONE} AND r.flat <> '' AND length(r.flat) <= 140 AND NOT starts_with(r.flat, '第')",
    "merged_trailing_fragment": f"{_NONE} AND (length(r.flat) <= 20 OR regexp_matches(r.flat, '^[のてにをがでと、,]'))",
    "repaired_reversed_clause_number": f"r.section_type = f.hs AND r.article < f.ha AND length(r.flat) <= 80 AND len(string_split(r.text, chr(10))) <= 3 AND round({_SCORE}, 6) < 0.45",
    "merged_citation_like_clause": f"f.hs = 'main_contract' AND r.section_type = 'main_contract' AND r.article IS NOT NULL AND r.clause_title IS NULL AND starts_with(r.c, r.clause_no) AND (regexp_matches(r.after, '^第{_N}(項|号|節|款)') OR r.article >= 150 AND (r.after = '' OR regexp_matches(r.after, '^{v.CITATION_TAIL}')))",
}
_FLAT = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_LESS = f"replace(replace({_FLAT}, '(報告) (報告)', '(報告)'), '(別途協議) (別途協議)', '(別途協議)')"
_HEAD = f"CASE WHEN starts_with({_LESS}, concat(clause_no, ' ', clause_no)) THEN concat(clause_no, ' ', ltrim(substr({_LESS}, 2 * length(clause_no) + 2))) ELSE {_LESS} END"
_ONCE = f"CASE WHEN {_HEAD} = {_FLAT} THEN text ELSE {_HEAD} END"


def _merges(names: list[str]) -> str:
    """Recursive steps over a document's clauses, for each merge in turn."""
    sql = f"WITH RECURSIVE o AS (SELECT o_orderkey AS k, unnest(range(10))::INT AS i FROM orders), o1 AS (SELECT *, {_T} AS t FROM o), m0 AS ({_DRAFTS}, i::VARCHAR AS blocks, '' AS flags FROM o1), z0 AS (SELECT doc_id, clause_ord, clause_no, article, clause_title, section_type, page AS page_start, page AS page_end, text, concat('b', blocks) AS blocks, flags FROM m0)"
    for k, name in enumerate(names, 1):
        text = _ONCE if name == "merged_citation_like_clause" else "text"
        sql += (
            f", y{k} AS MATERIALIZED (SELECT * REPLACE ({text} AS text), row_number() OVER (PARTITION BY doc_id ORDER BY clause_ord) AS rn FROM z{k - 1}), r{k} AS MATERIALIZED (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat, regexp_replace(text, '\\s+', '', 'g') AS c, substr(regexp_replace(text, '\\s+', '', 'g'), length(clause_no) + 1) AS after FROM y{k})"
            f", f{k} AS (SELECT doc_id, rn, clause_ord AS h, clause_no AS hn, article AS ha, section_type AS hs, page_end AS hp FROM r{k} WHERE rn = 1 UNION ALL SELECT doc_id, rn, CASE WHEN holds THEN h ELSE clause_ord END, CASE WHEN holds THEN hn ELSE clause_no END, CASE WHEN holds THEN ha ELSE article END, CASE WHEN holds THEN hs ELSE section_type END, CASE WHEN holds THEN greatest(hp, page_end) ELSE page_end END FROM (SELECT r.*, f.h, f.hn, f.ha, f.hs, f.hp, coalesce({_HOLDS[name]}, false) AS holds FROM f{k} f JOIN r{k} r ON r.doc_id = f.doc_id AND r.rn = f.rn + 1))"
            f", z{k} AS (SELECT doc_id, h AS clause_ord, arg_min(CASE WHEN clause_ord = h THEN clause_no END, rn) FILTER (clause_ord = h) AS clause_no, arg_min(article, rn) FILTER (clause_ord = h) AS article, arg_min(clause_title, rn) FILTER (clause_ord = h) AS clause_title, arg_min(section_type, rn) FILTER (clause_ord = h) AS section_type, min(page_start) FILTER (clause_ord = h) AS page_start, max(page_end) AS page_end, string_agg(text, chr(10) ORDER BY rn) AS text, string_agg(blocks, ',' ORDER BY rn) AS blocks, concat_ws(',', nullif(arg_min(flags, rn) FILTER (clause_ord = h), ''), CASE WHEN count(*) > 1 THEN '{name}' END) AS flags FROM f{k} JOIN r{k} USING (doc_id, rn) GROUP BY doc_id, h)"
        )
    return sql


_one = lambda name: _merges([name]) + " SELECT doc_id, clause_ord, len(string_split(blocks, ','))::INT AS merged, flags FROM z1"
_MARKED = f"regexp_replace(regexp_replace(norm, '([。.:;)\\]】]\\s?)(第{_N}条)', '\\1\x1f\\2', 'g'), '\x1f(第{_N}条\\s*{v.CITATION_TAIL})', '\\1', 'g')"
SQL = {
    "clause_post_merge": _merges(list(_HOLDS))
    + f", z5 AS (SELECT *, {_FLAT} AS flat, lag(article) OVER w AS ha, lag(section_type) OVER w AS hs, lag(page_end) OVER w AS hp FROM z4 WINDOW w AS (PARTITION BY doc_id ORDER BY clause_ord)) SELECT doc_id, clause_ord, clause_no, page_end, text, blocks, concat_ws(',', nullif(flags, ''), CASE WHEN hs = section_type AND article < ha THEN 'REVERSED_CLAUSE_NUMBER' END, CASE WHEN hs = section_type AND section_type = 'main_contract' AND round({_SCORE.replace('r.', '').replace('f.', '')}, 6) < 0.45 THEN 'LOW_BOUNDARY_CONFIDENCE' END) AS flags FROM z5",
    "orphan_paragraphs": _one("attached_orphan_paragraph"),
    "trailing_fragments": _one("merged_trailing_fragment"),
    "reversed_numbers": _one("repaired_reversed_clause_number"),
    "citation_clauses": _one("merged_citation_like_clause"),
    "embedded_headings": f"WITH j AS ({_JOINED} FROM orders), s AS (SELECT doc_id, list_filter(list_transform(string_split({_MARKED}, '\x1f'), lambda x: trim(x)), lambda x: x <> '') AS p FROM j) SELECT doc_id, i::INT - 1 AS pos, p[i] AS part FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM s)",
    "repeated_headings": f"WITH j AS ({_JOINED} FROM orders), s AS (SELECT doc_id, heading, regexp_matches(heading, '^{v.HEADING_UNITS}') AS h, string_split(heading, ' ') AS w, replace(heading, ' ', '') AS c FROM j) SELECT doc_id, CASE WHEN h AND len(w) >= 4 AND len(w) % 2 = 0 AND w[:len(w) // 2] = w[len(w) // 2 + 1:] THEN array_to_string(w[:len(w) // 2], ' ') WHEN h AND length(c) >= 8 AND length(c) % 2 = 0 AND left(c, length(c) // 2) = right(c, length(c) // 2) THEN left(c, length(c) // 2) ELSE heading END AS heading FROM s",
    "block_sections": rq._L
    + f", hh AS (SELECT doc_id, ord, norm, CASE WHEN regexp_matches(norm, '^第[0-9]+条') THEN regexp_extract(norm, '^(第[0-9]+条)', 1) WHEN regexp_matches(norm, '^(附則|別紙|別表)') THEN left(norm, 2) END AS no FROM l), ss AS (SELECT *, coalesce(bool_or(starts_with(no, '第')) OVER (PARTITION BY doc_id ORDER BY ord ROWS UNBOUNDED PRECEDING), false) AS seen, last_value(no IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before, trim(regexp_extract(norm, '^\\s*[(]([^)]{{1,60}})[)]\\s*$', 1)) AS title FROM hh)"
    + f", st AS (SELECT *, CASE WHEN norm = '' OR starts_with(coalesce(no, ''), '第') THEN 'main_contract' WHEN contains(norm, '特記事項') THEN 'special_provisions' WHEN regexp_matches(norm, '{v.APPENDIX_SIGNAL}|{v.RESTART_SIGNAL}') THEN 'appendix' WHEN regexp_matches(norm, '{v.INSTRUCTION}') THEN 'instruction' WHEN regexp_matches(norm, '{v.FORM_SIGNAL}|{v.TAIL_FORM_SIGNAL}|{v.BLANK_ARTICLE}') THEN 'form' WHEN regexp_matches(norm, '{v.EXECUTION}') OR regexp_matches(norm, '{v.SIGNATURE_SIGNAL}') AND regexp_matches(norm, '記名押印|署名|押印欄|住所|氏名|代表者') THEN 'signature' WHEN NOT seen THEN 'preamble' ELSE 'main_contract' END AS section_type FROM ss)"
    + f" SELECT doc_id, ord, section_type, CASE section_type WHEN 'special_provisions' THEN contains(norm, '特記事項') WHEN 'appendix' THEN regexp_matches(norm, '{v.APPENDIX_SIGNAL}|{v.RESTART_SIGNAL}') WHEN 'form' THEN regexp_matches(norm, '{v.FORM_SIGNAL}|{v.TAIL_FORM_SIGNAL}') WHEN 'instruction' THEN regexp_matches(norm, '{v.INSTRUCTION}') WHEN 'signature' THEN regexp_matches(norm, '{v.SIGNATURE_SIGNAL}|{v.EXECUTION}') WHEN 'main_contract' THEN regexp_matches(norm, '^\\s*第{_N}\\s*条') ELSE false END AS opens, CASE WHEN regexp_matches(norm, '{v.RESTART_SIGNAL}') THEN 'tail_restart' WHEN section_type = 'signature' THEN 'signature' WHEN section_type IN ('form', 'instruction') THEN 'form_instruction' WHEN section_type = 'appendix' THEN 'appendix' ELSE 'other' END AS category, coalesce(starts_with(before, '第'), false) AND title <> '' AND length(title) <= 22 AND NOT regexp_matches(title, '[。、:;]') AS subtitle FROM st",
    "article_references": f"WITH o AS (SELECT o_orderkey AS k, unnest(range(10))::INT AS i FROM orders), o1 AS (SELECT *, {_T} AS t FROM o), d AS ({_DRAFTS} FROM o1) SELECT doc_id, clause_ord, regexp_matches(regexp_extract(regexp_replace(text, '\\s+', '', 'g'), '^第[^条]*条(.*)$', 1), '^({v.CITATION_TAIL}|{v.REFERENCE_CHAIN})') AS cites FROM d WHERE text LIKE '第%'",
}
