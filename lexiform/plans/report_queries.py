"""Batches, scorecards, comparisons, counters and page regions, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.operators import reports
from lexiform.plans import source_queries as sq
from lexiform.sources import bridges as br
from lexiform.sources import layouts


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return br.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.run_summary(_orders(spark, sf).select(F.expr("CASE k % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped_missing' ELSE 'success' END").alias("status")))


def run_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """A line for each customer: the orders' values that its run has, or none."""
    runs = _orders(spark, sf).filter("c % 4 > 0").groupBy(F.concat(F.lit("c"), F.col("c").cast("string")).alias("stem")).agg(F.count(F.lit(1)).alias("orders"), F.slice(F.array_sort(F.collect_list(F.col("k").cast("string"))), 1, 2).alias("first"), F.max(F.lit(None).cast("string")).alias("none"))
    stems = br.table(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("stem"))
    lines = reports.scorecard_lines(stems, runs, ["orders", "first", "none"])
    return lines.select("stem", "line")


def fixed_table(spark: SparkSession, sf: str) -> DataFrame:
    n = br.table(spark, sf, "nation").select("n_nationkey", "n_name", reports.ratio(F.when(F.col("n_nationkey") > 3, F.col("n_nationkey") / 7)).alias("r"))
    return reports.fixed_width(n, {"n_nationkey": 4, "n_name": 6, "r": 7})


def _engines(spark: SparkSession, sf: str) -> DataFrame:
    b = sq.pages(spark, sf).select("doc_id", "page", F.posexplode("blocks").alias("i", "b"))
    a = b.select("doc_id", "page", F.lit("current").alias("engine"), F.when(F.col("b.type") == 0, "text").otherwise("image").alias("label"), F.col("i").alias("reading_order"), F.concat(F.lit("b"), F.col("i").cast("string")).alias("text"))
    return a.unionByName(a.filter("reading_order % 2 = 0").withColumns({"engine": F.lit("other"), "reading_order": -F.col("reading_order"), "label": F.when(F.col("doc_id") % 2 == 0, "figure").otherwise("text")}))


def engine_comparison(spark: SparkSession, sf: str) -> DataFrame:
    e = _engines(spark, sf)
    counts = reports.engine_counts(e)
    return counts.join(reports.reading_orders(e, 4), ["doc_id", "engine"]).select("doc_id", "engine", "pages", "blocks", "labels", F.array_join("texts", ",").alias("texts"))


def match_counters(spark: SparkSession, sf: str) -> DataFrame:
    law = "CASE k % 4 WHEN 0 THEN '日本法' WHEN 1 THEN '日本' WHEN 2 THEN '' ELSE '○○法' END"
    rows = _orders(spark, sf).selectExpr("CASE WHEN k % 9 > 0 THEN '日本法' END AS expected_law", f"{law} AS law", "10 AS expected_clauses", "8 + k % 5 AS clauses", "k % 3 = 0 AS expected_review", "k % 2 = 0 AS reviewed", "CASE k % 4 WHEN 0 THEN array('form found', 'more information') WHEN 1 THEN array('signature block') ELSE array('header row', 'plain') END AS issues")
    return reports.match_counters(rows, ["law"])


def signature_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Signing lines with a date some blocks further on, on their page or not."""
    o = _orders(spark, sf).select("k", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("j"))
    text = F.expr("CASE WHEN j = 1 THEN '本契約締結の証として本書を作成する。' WHEN j = 2 + k % 10 THEN '令和  年  月  日' WHEN j = 11 THEN '年 月 日' ELSE '余白' END")
    b = o.select(F.col("k").alias("doc_id"), F.col("j").alias("ord"), F.when((F.col("k") % 3 == 0) & (F.col("j") > 4), 2).otherwise(1).alias("page"), text.alias("norm"))
    return reports.signature_dates(b)


def page_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with their image regions and weak blocks; scanned ones without any as one region."""
    p = sq.pages(spark, sf)
    kinds = p.select("doc_id", "page", "width", "height", F.when(F.col("doc_id") % 3 == 0, "scanned").otherwise("hybrid").alias("page_kind"), F.lit("measured").alias("reason"))
    weak = layouts.text_blocks(p).filter("doc_id % 4 = 1").select("doc_id", "page", F.concat("block_id", F.lit("_fallback")).alias("region_id"), "bbox")
    r = reports.page_regions(kinds, weak, layouts.image_regions(p))
    return r.select("doc_id", "page_kind", F.array_join("regions", ",").alias("regions"), F.round("ocr_ratio", 6).alias("ocr_ratio"), "reason")


QUERIES = {f.__name__: f for f in (run_summary, run_scorecard, fixed_table, engine_comparison, match_counters, signature_dates, page_decisions)}

_B = "WITH b AS (SELECT o_orderkey AS doc_id, unnest(range(6))::INT AS i FROM orders), e AS (SELECT doc_id, 'current' AS engine, CASE WHEN i % 2 = 0 THEN 'text' ELSE 'image' END AS label, i AS ro, i FROM b UNION ALL SELECT doc_id, 'other', CASE WHEN doc_id % 2 = 0 THEN 'figure' ELSE 'text' END, -i, i FROM b WHERE i % 2 = 0)"
SQL = {
    "run_summary": "SELECT count(*) AS total, count(*) FILTER (o_orderkey % 5 > 1) AS success, count(*) FILTER (o_orderkey % 5 = 0) AS failed, count(*) FILTER (o_orderkey % 5 = 1) AS skipped, count(*) FILTER (o_orderkey % 5 > 0) > 0 AS done FROM orders",
    "run_scorecard": "WITH r AS (SELECT o_custkey AS c, count(*) AS n, array_to_string(list_sort(list(o_orderkey::VARCHAR))[1:2], '; ') AS f FROM orders WHERE o_custkey % 4 > 0 GROUP BY 1) SELECT concat('c', c_custkey) AS stem, CASE WHEN n IS NULL THEN concat('c', c_custkey, chr(9), 'MISSING_RUN') ELSE concat('c', c_custkey, chr(9), n, chr(9), f, chr(9)) END AS line FROM customer LEFT JOIN r ON c = c_custkey",
    "fixed_table": "SELECT concat_ws(' ', rpad(n_nationkey::VARCHAR, 4, ' '), rpad(n_name, 6, ' '), rpad(CASE WHEN n_nationkey > 3 THEN printf('%.3f', n_nationkey / 7) ELSE '-' END, 7, ' ')) AS line FROM nation",
    "engine_comparison": _B + ", l AS (SELECT doc_id, engine, label, count(*) AS n FROM e GROUP BY ALL), c AS (SELECT doc_id, engine, 1 AS pages, sum(n)::BIGINT AS blocks, string_agg(concat(label, ':', n), ',' ORDER BY label) AS labels FROM l GROUP BY ALL), t AS (SELECT doc_id, engine, array_to_string(list(concat('b', i) ORDER BY ro)[1:4], ',') AS texts FROM e GROUP BY ALL) SELECT * FROM c JOIN t USING (doc_id, engine)",
    "match_counters": "WITH c AS (SELECT o_orderkey AS k, concat('law:', CASE WHEN o_orderkey % 9 = 0 THEN 'unscored' ELSE CASE o_orderkey % 4 WHEN 0 THEN 'exact' WHEN 1 THEN 'partial' WHEN 2 THEN 'missing' ELSE 'placeholder' END END) AS m FROM orders) SELECT m AS metric, count(*) AS n FROM c GROUP BY m UNION ALL SELECT 'clause_count_error', sum(abs(k % 5 - 2))::BIGINT FROM c UNION ALL SELECT 'true_review', count(*) FILTER (k % 6 = 0) FROM c UNION ALL SELECT 'false_clean', count(*) FILTER (k % 3 = 0 AND k % 2 = 1) FROM c UNION ALL SELECT 'form_contamination', 2 * count(*) FILTER (k % 4 = 0) FROM c UNION ALL SELECT 'signature_leakage', count(*) FILTER (k % 4 = 1) FROM c UNION ALL SELECT 'header_footer_leakage', count(*) FILTER (k % 4 > 1) FROM c",
    "signature_dates": "WITH s AS (SELECT o_orderkey AS k, 2 + o_orderkey % 10 AS place FROM orders) SELECT k AS doc_id, 1 AS ord, '令和  年  月  日' AS date FROM s WHERE place <= 9 AND (k % 3 > 0 OR place <= 4)",
    "page_decisions": "WITH g AS (SELECT o_orderkey AS k, unnest([{'n': 2, 'x0': o_orderkey % 500, 'y0': o_orderkey % 700, 'w': o_orderkey % 90, 'h': 30}, {'n': 4, 'x0': 560, 'y0': 300, 'w': o_orderkey % 40, 'h': 60}, {'n': 6, 'x0': 100, 'y0': 400, 'w': CASE WHEN o_orderkey % 7 = 0 THEN 400 ELSE 0 END, 'h': CASE WHEN o_orderkey % 7 = 0 THEN 300 ELSE 0 END}]) AS b FROM orders), i AS (SELECT k, 10 AS p, printf('p1_img%03d', b.n) AS id, b.w * b.h AS area FROM g WHERE b.w > 0 AND b.w * b.h / 480000.0 >= 0.0015 AND NOT ((b.y0 + b.h <= 120 OR b.x0 + b.w <= 72 OR b.x0 >= 528) AND b.w * b.h / 480000.0 < 0.006) UNION ALL SELECT o_orderkey, 20, unnest(['p1_n001_fallback', 'p1_n003_fallback']), 4800 FROM orders WHERE o_orderkey % 4 = 1), f AS (SELECT k, string_agg(id, ',' ORDER BY p, id) AS ids, sum(area) AS area, count(*) AS n FROM i GROUP BY k) SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 3 = 0 THEN 'scanned' ELSE 'hybrid' END AS page_kind, CASE WHEN n > 0 THEN ids WHEN o_orderkey % 3 = 0 THEN 'p1_full' ELSE '' END AS regions, round(CASE WHEN n > 0 THEN least(1, area / 480000.0) WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END, 6)::DOUBLE AS ocr_ratio, concat('measured;ocr_regions=', CASE WHEN n > 0 THEN n WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) AS reason FROM orders LEFT JOIN f ON k = o_orderkey",
}
