"""Issues to ranked review signals and a queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Reason code, score.
SCORES = {
    "OCR_FAILURE": 0.95, "PARTIAL_EXTRACTION_FAILURE": 0.85, "HIGH_OCR_RATIO": 0.70, "UNSTABLE_CLAUSE_SPLIT": 0.65, "LOW_CONFIDENCE": 0.55,
    "MISSING_CONTRACT_TYPE": 0.75, "MISSING_EFFECTIVE_DATE": 0.65, "MISSING_EXPIRATION_DATE": 0.60, "MISSING_GOVERNING_LAW": 0.65, "MISSING_JURISDICTION": 0.65,
    "LOW_QUALITY_COUNTERPARTY": 0.70, "LOW_QUALITY_GOVERNING_LAW": 0.68, "LOW_QUALITY_JURISDICTION": 0.72, "LOW_QUALITY_EXPIRATION_DATE": 0.62, "ANCHOR_ONLY_EFFECTIVE_DATE": 0.50,
    "TABLE_CONTENT_UNPARSED": 0.45, "APPENDIX_DETECTED_NOT_PARSED": 0.42, "MISSING_TITLE": 0.68, "PARTIAL_COUNTERPARTY": 0.66, "SECTION_BOUNDARY_UNCERTAIN": 0.72,
}
DEFAULT_SCORE = 0.30
#: Codes that are no warning when their severity is review.
QUIET = ("OCR_FAILURE", "PARTIAL_EXTRACTION_FAILURE")


def catalogue(spark: SparkSession) -> DataFrame:
    """(reason_code, base_score): twenty rows."""
    return spark.createDataFrame(list(SCORES.items()), "reason_code string, base_score double")


def level(severity: Column, code: Column) -> Column:
    """2 critical, 1 warning, 0 info."""
    warns = code.isin([c for c in SCORES if c not in QUIET])
    return F.when(severity == "fatal", 2).when((severity == "recoverable") & (code == "OCR_FAILURE"), 2).when(severity == "recoverable", 1).when(warns, 1).otherwise(0)


def distinct_issues(issues: DataFrame) -> DataFrame:
    """Issues without repetition over all their columns."""
    return issues.dropDuplicates(["doc_id", "severity", "reason_code", "field", "block_id"])


def signals(issues: DataFrame, codes: DataFrame) -> DataFrame:
    """A row for each document and reason code: highest level and score, the blocks and fields behind it."""
    rows = issues.join(F.broadcast(codes), "reason_code", "left").withColumn("score", F.coalesce("base_score", F.lit(DEFAULT_SCORE))).withColumn("level", level(F.col("severity"), F.col("reason_code")))
    return rows.groupBy("doc_id", "reason_code").agg(F.max("level").alias("level"), F.max("score").alias("score"), F.count(F.lit(1)).alias("n_issues"), F.array_join(F.array_sort(F.collect_set("block_id")), ",").alias("blocks"), F.array_join(F.array_sort(F.collect_set("field")), ",").alias("fields"))


def queue(sigs: DataFrame) -> DataFrame:
    """Signals numbered in order of level, score and code, with a severity for comparison."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("level"), F.desc("score"), "reason_code")
    severity = F.when(F.col("level") == 2, "high").when((F.col("level") == 1) & (F.col("score") >= 0.65), "high").when(F.col("level") == 1, "medium").otherwise("low")
    return sigs.withColumn("turn", F.row_number().over(w)).withColumn("review_id", F.format_string("rev_%04d", "turn")).withColumn("severity", severity)


def summary(q: DataFrame) -> DataFrame:
    """Counts for each document; it is ready for comparison without high severities."""
    count = lambda c: F.count_if(c)
    g = q.groupBy("doc_id").agg(count(F.col("level") == 1).alias("warnings"), count(F.col("level") == 2).alias("criticals"), count(F.col("severity") == "high").alias("high"), count(F.col("severity") == "medium").alias("medium"), count(F.col("severity") == "low").alias("low"), F.round(F.least(F.lit(1.0), F.sum("score") / 3), 6).alias("overall"))
    return g.withColumn("review_required", (F.col("warnings") + F.col("criticals")) > 0).withColumn("compare_ready", F.col("high") == 0)


def top_issues(q: DataFrame, n: int = 3) -> DataFrame:
    """Of each document its n most frequent codes as 'code:count', by count and then code."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("n_issues"), "reason_code")
    rows = q.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("place", F.concat_ws(":", "reason_code", "n_issues").alias("t")))), lambda x: x.t)
    return rows.groupBy("doc_id").agg(F.array_join(parts, "; ").alias("top_issues"))
