"""Writers of nested documents, chunks, reviews and scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def documents(clauses: DataFrame, fields: DataFrame, issues: DataFrame) -> DataFrame:
    """(doc_id, json): clauses in order, fields as a map, issues parted into errors and warnings."""
    c = clauses.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("clause_ord", "clause_id", "clause_no", "clause_title", "text", "page_start", "page_end", "block_ids", "section_type", "flags"))).alias("clauses"))
    f = fields.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", F.struct("value", "confidence", "reason", "block_id"))))).alias("fields"))
    hard = F.col("severity").isin("fatal", "recoverable")
    row = F.struct("severity", "reason_code", "field", "block_id")
    i = issues.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.when(hard, row))).alias("errors"), F.array_sort(F.collect_list(F.when(~hard, row))).alias("warnings"))
    out = c.join(f, "doc_id", "left").join(i, "doc_id", "left")
    return out.select("doc_id", F.to_json(F.struct("doc_id", "clauses", "fields", "errors", "warnings")).alias("json"))


def write_json_lines(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_text(rows: DataFrame, column: str, path: str) -> None:
    rows.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_scorecard(rows: DataFrame, path: str, sep: str = "\t") -> None:
    """Header and values; arrays are joined."""
    flat = rows.select(*[F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in rows.dtypes])
    flat.write.mode("overwrite").option("header", "true").option("sep", sep).csv(path)
