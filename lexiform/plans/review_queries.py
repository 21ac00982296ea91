"""Issues, review queues, evaluation and identity of inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.operators import evaluate, fields, review
from lexiform.plans.contract_queries import _fields
from lexiform.plans.text_queries import BLOCKS
from lexiform.sources import bridges as br
from lexiform.sources import readers

FILLED = ["effective_date", "expiration_date", "governing_law", "jurisdiction", "party_a"]


def _issues(spark: SparkSession, sf: str) -> DataFrame:
    docs = br.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return fields.issues(docs, _fields(spark, sf))


def issue_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Issues that came in twice, once each."""
    i = _issues(spark, sf)
    twice = i.withColumn("again", F.explode(F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("again")
    return review.distinct_issues(twice).groupBy("severity", "reason_code", "field").agg(F.count(F.lit(1)).alias("n"), F.count("block_id").alias("with_block"))


def _signals(spark: SparkSession, sf: str) -> DataFrame:
    return review.signals(review.distinct_issues(_issues(spark, sf)), review.catalogue(spark))


def review_signals(spark: SparkSession, sf: str) -> DataFrame:
    return _signals(spark, sf)


def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    return review.queue(_signals(spark, sf)).select("doc_id", "review_id", "reason_code", "level", "score", "severity")


def review_summary(spark: SparkSession, sf: str) -> DataFrame:
    return review.summary(review.queue(_signals(spark, sf)))


def top_issues(spark: SparkSession, sf: str) -> DataFrame:
    return review.top_issues(_signals(spark, sf))


def _expected(spark: SparkSession, sf: str) -> DataFrame:
    """What a contract was made with: its law and court as they should come out."""
    return spark.sql("SELECT o_orderkey AS doc_id, CASE WHEN o_orderstatus <> 'P' THEN '日本法' END AS law, CASE c_nationkey % 5 WHEN 0 THEN '東京 地方裁判所' WHEN 1 THEN '大阪' WHEN 2 THEN '名古屋地方裁判所' WHEN 3 THEN '甲の所在地' END AS court FROM {orders} JOIN {customer} ON o_custkey = c_custkey", orders=br.table(spark, sf, "orders"), customer=br.table(spark, sf, "customer"))


def field_match_classes(spark: SparkSession, sf: str) -> DataFrame:
    got = fields.wide(_fields(spark, sf))
    rows = _expected(spark, sf).join(got, "doc_id", "left")
    pair = F.explode(F.array(F.struct(F.lit("law").alias("field"), evaluate.match_class(F.col("law"), F.col("governing_law")).alias("class")), F.struct(F.lit("court").alias("field"), evaluate.match_class(F.col("court"), F.col("jurisdiction")).alias("class")))).alias("m")
    return rows.select(pair).groupBy("m.field", "m.class").agg(F.count(F.lit(1)).alias("n"))


def field_fill_rate(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.fill_rate(fields.wide(_fields(spark, sf)), FILLED).select("doc_id", "filled", "fill_rate")


def _verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """What is filled, what is wrong, critical signals and courts by place only, and the verdict.

    Pages of every 37th contract could not be recognised: a critical signal."""
    b = br.contract_blocks(spark, sf)
    f = fields.validate(fields.best(fields.candidates(b)))
    got = lambda name: F.count_if(F.col("accepted") & (F.col("field") == name))
    low = lambda name: F.count_if(~F.col("accepted") & F.col("field").startswith(name))
    said = lambda name: F.max(F.when(F.col("accepted") & (F.col("field") == name), F.when(F.col("semantic") == "anchor", "anchor_only").otherwise(F.col("semantic"))))
    filled = F.count_if(F.col("accepted") & F.col("field").isin(FILLED))
    g = f.groupBy("doc_id").agg(filled.alias("filled"), *[got(n).alias(f"has_{n}") for n, _ in fields.WANTED], F.count_if("anchor_only").alias("anchors"), low("party").alias("low_party"), low("jurisdiction").alias("low_court"), low("governing_law").alias("low_law"), said("effective_date").alias("effective_type"), said("expiration_date").alias("expiration_type"))
    failed = br.table(spark, sf, "orders").filter("o_orderkey % 37 = 0").select(F.col("o_orderkey").alias("doc_id"), F.lit("recoverable").alias("severity"), F.lit("OCR_FAILURE").alias("reason_code"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("block_id"))
    criticals = review.summary(review.queue(review.signals(failed, review.catalogue(spark)))).select("doc_id", "criticals")
    rows = g.join(criticals, "doc_id", "left").join(fields.relative_courts(b), "doc_id", "left")
    gone = lambda n: F.when(F.col(f"has_{n}") > 0, 0).otherwise(1).cast("long")
    rows = rows.withColumns({
        "fill_rate": F.round(F.col("filled") / len(FILLED), 6), "missing": sum((gone(n) for n, _ in fields.WANTED), F.lit(0)), "missing_law": gone("governing_law"), "missing_court": gone("jurisdiction"),
        "criticals": F.coalesce("criticals", F.lit(0)), "relative": F.col("expression").isNotNull(), "anchor_fields": F.col("anchors"), "quality_flags": F.lit(0), "has_quality": F.lit(True), "source": F.lit("document"),
    })
    return evaluate.passes(evaluate.quality_score(rows))


def document_pass_fail(spark: SparkSession, sf: str) -> DataFrame:
    return _verdicts(spark, sf).select("doc_id", "fill_rate", "quality", "missing", "anchors", "verdict")


def corpus_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    v = _verdicts(spark, sf)
    return v.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("verdict") == "pass").alias("passed"), F.round(F.avg("fill_rate"), 4).alias("fill_rate"), F.round(F.avg("quality"), 4).alias("quality"), F.sum("anchors").alias("anchors"))


def false_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents of poor quality that a plain look at their lines would not send to review."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    rows = d.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    odd = F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s]")) / F.greatest(F.length("text"), F.lit(1))
    seen = odd > 0.06
    return rows.select((F.col("quality") == 0).alias("expected"), seen.alias("emitted")).groupBy("expected", "emitted").agg(F.count(F.lit(1)).alias("n"))


def manifest_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by language, by source and over all, of labelled and other documents."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "source")
    rows = d.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality"), "doc_id", "left")
    return spark.sql("SELECT lang, source, count(*) AS documents, count(quality) AS labelled FROM {rows} GROUP BY GROUPING SETS ((lang), (source), ())", rows=rows)


def content_hash_id(spark: SparkSession, sf: str) -> DataFrame:
    return readers.with_identity(spark.read.parquet(f"{sf}/documents.parquet").select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("stem"), F.encode("text", "UTF-8").alias("content"))).select("stem", "source_hash", "doc_id")


def permissive_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines, some broken: objects come through, other lines are counted as errors."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    lines = e.select("event_id", F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("{broken "), F.col("props"))).when(F.col("event_id") % 50 == 1, "[1, 2]").otherwise(F.col("props")).alias("value"))
    return readers.json_lines(lines).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "issue_union_distinct": issue_union_distinct,
    "review_signals": review_signals,
    "review_queue": review_queue,
    "review_summary": review_summary,
    "top_issues": top_issues,
    "field_match_classes": field_match_classes,
    "field_fill_rate": field_fill_rate,
    "document_pass_fail": document_pass_fail,
    "corpus_scorecard": corpus_scorecard,
    "false_clean": false_clean,
    "manifest_profile": manifest_profile,
    "content_hash_id": content_hash_id,
    "permissive_json": permissive_json,
}

_I = (
    BLOCKS
    + ", iss AS (SELECT k AS doc_id, 'MISSING_EXPIRATION_DATE' AS reason_code, 'expiration_date' AS field, NULL::VARCHAR AS block_id FROM p WHERE k % 3 = 1 UNION ALL SELECT k, 'MISSING_GOVERNING_LAW', 'governing_law', NULL FROM p WHERE status = 'P' UNION ALL SELECT k, 'MISSING_JURISDICTION', 'jurisdiction', NULL FROM p WHERE nation % 5 >= 3 UNION ALL SELECT k, 'ANCHOR_ONLY_EFFECTIVE_DATE', 'effective_date', 'p90_b10001' FROM p WHERE k % 3 = 1 UNION ALL SELECT k, 'LOW_CONFIDENCE', 'effective_date', 'p90_b10001' FROM p WHERE k % 3 = 1)"
    + ", sg AS (SELECT doc_id, reason_code, 1 AS level, CASE reason_code WHEN 'MISSING_EXPIRATION_DATE' THEN 0.60 WHEN 'ANCHOR_ONLY_EFFECTIVE_DATE' THEN 0.50 WHEN 'LOW_CONFIDENCE' THEN 0.55 ELSE 0.65 END::DOUBLE AS score, count(*) AS n_issues, coalesce(string_agg(DISTINCT block_id), '') AS blocks, string_agg(DISTINCT field) AS fields FROM iss GROUP BY doc_id, reason_code)"
    + ", q AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level DESC, score DESC, reason_code) AS turn, CASE WHEN score >= 0.65 THEN 'high' ELSE 'medium' END AS severity FROM sg)"
)
_V = (
    _I
    + ", w AS (SELECT k AS doc_id, 2 + (k % 3 <> 1)::INT + (status <> 'P')::INT + (nation % 5 < 3)::INT AS filled, nation % 5 = 3 AS rel FROM p), v AS (SELECT doc_id, filled, rel, round(filled / 5, 6) AS fill_rate, count(iss.reason_code) FILTER (iss.reason_code LIKE 'MISSING%') AS missing, count(iss.reason_code) FILTER (iss.reason_code IN ('MISSING_GOVERNING_LAW', 'MISSING_JURISDICTION')) AS mlc, count(iss.reason_code) FILTER (iss.reason_code LIKE 'ANCHOR%') AS anchors FROM w LEFT JOIN iss USING (doc_id) GROUP BY doc_id, filled, rel), vv AS (SELECT v.*, round(greatest(0, least(1, 1 - 0.16 * anchors - CASE doc_id % 3 WHEN 1 THEN 0.06 ELSE 0 END + CASE WHEN rel THEN 0.12 ELSE 0 END)), 6)::DOUBLE AS quality FROM v), x AS (SELECT *, CASE WHEN doc_id % 37 = 0 OR mlc - rel::INT >= 2 OR fill_rate < 0.60 OR quality < 0.55 THEN 'fail' ELSE 'pass' END AS verdict FROM vv)"
)
SQL = {
    "issue_union_distinct": _I + " SELECT 'review' AS severity, reason_code, field, count(*) AS n, count(block_id) AS with_block FROM iss GROUP BY reason_code, field",
    "review_signals": _I + " SELECT * FROM sg",
    "review_queue": _I + " SELECT doc_id, printf('rev_%04d', turn) AS review_id, reason_code, level, score, severity FROM q",
    "review_summary": _I + " SELECT doc_id, count(*) AS warnings, 0::BIGINT AS criticals, count(*) FILTER (severity = 'high') AS high, count(*) FILTER (severity = 'medium') AS medium, 0::BIGINT AS low, round(least(1.0, sum(score) / 3), 6) AS overall, true AS review_required, count(*) FILTER (severity = 'high') = 0 AS compare_ready FROM q GROUP BY doc_id",
    "top_issues": _I + ", t AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n_issues DESC, reason_code) AS place FROM sg) SELECT doc_id, string_agg(concat(reason_code, ':', n_issues), '; ' ORDER BY place) AS top_issues FROM t WHERE place <= 3 GROUP BY doc_id",
    "field_match_classes": BLOCKS + ", m AS (SELECT 'law' AS field, CASE WHEN status = 'P' THEN 'unscored' ELSE 'exact' END AS class FROM p UNION ALL SELECT 'court', CASE nation % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'partial' WHEN 2 THEN 'wrong' WHEN 3 THEN 'missing' ELSE 'unscored' END FROM p) SELECT field, class, count(*) AS n FROM m GROUP BY field, class",
    "field_fill_rate": _V + " SELECT doc_id, filled, fill_rate FROM x",
    "document_pass_fail": _V + " SELECT doc_id, fill_rate, quality, missing, anchors, verdict FROM x",
    "corpus_scorecard": _V + " SELECT count(*) AS documents, count(*) FILTER (verdict = 'pass') AS passed, round(avg(fill_rate), 4) AS fill_rate, round(avg(quality), 4) AS quality, sum(anchors)::BIGINT AS anchors FROM x",
    "false_clean": r"SELECT quality = 0 AS expected, (length(text) - length(regexp_replace(text, '[^\p{L}\p{N}\s]', '', 'g'))) / greatest(length(text), 1) > 0.06 AS emitted, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY ALL",
    "manifest_profile": "SELECT lang, source, count(*) AS documents, count(quality) AS labelled FROM documents LEFT JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((lang), (source), ())",
    "content_hash_id": "SELECT concat('doc ', doc_id) AS stem, concat('sha256:', sha256(text)) AS source_hash, concat('doc_', doc_id, '_', substr(sha256(text), 1, 12)) AS doc_id FROM documents",
    "permissive_json": "SELECT CASE WHEN event_id % 50 = 0 THEN 'malformed' WHEN event_id % 50 = 1 THEN 'not_an_object' ELSE 'object' END AS status, count(*) AS n FROM events GROUP BY 1",
}
