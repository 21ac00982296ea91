"""Ingest tables of text blocks: ``python -m lexiform.cli INPUT --output-dir DIR``.

INPUT is Parquet or JSON lines with doc_id, ord, page, text, conf and engine, and if they are known block_type, searchable, bbox
and layout_engine. DIR takes documents (one JSON for each), chunks, the review queue and a summary of the run, and below ``tables`` the blocks, clauses and fields that they are made from: each step
reads what the one before has written, so that its plan stays small and a lost executor costs one step.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions import text as tx
from lexiform.operators import chunks, clause_state, extract, fields, issues, reports, review, segment
from lexiform.settings import Settings
from lexiform.sources import sinks

BOX = "struct<x0: double, y0: double, x1: double, y1: double>"
KNOWN = f"block_type string, searchable boolean, bbox {BOX}, layout_engine string"
BLOCKS = "doc_id long, ord int, page int, text string, conf double, engine string"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lexiform", description="Fields, clauses, chunks and reviews of contracts")
    p.add_argument("input", help="Parquet or JSON lines of text blocks")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--doc-id", type=int, help="only this document")
    p.add_argument("--log-level", default="WARN", choices=["DEBUG", "INFO", "WARN", "ERROR"])
    p.add_argument("--layout-engine", default="current", choices=["current", "ppstructure", "compare"], help="whose blocks count, where the input has several")
    return p


def read(spark: SparkSession, path: str, layout_engine: str = "current") -> DataFrame:
    """Blocks with what is not given filled in; of an input with layout_engine the rows of the engine that is asked for."""
    rows = spark.read.schema(f"{BLOCKS}, {KNOWN}").json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)
    for name, kind in (("block_type", "string"), ("searchable", "boolean"), ("bbox", BOX), ("layout_engine", "string")):
        rows = rows if name in rows.columns else rows.withColumn(name, F.lit(None).cast(kind))
    rows = rows if layout_engine == "compare" else rows.filter(F.coalesce("layout_engine", F.lit(layout_engine)) == layout_engine)
    rows = rows.withColumns({"norm": tx.normalize_text(F.col("text")), "block_type": F.coalesce("block_type", F.lit("text")), "searchable": F.coalesce("searchable", F.lit(True)), "bbox": F.col("bbox").cast(BOX)})
    return rows.withColumn("compact", tx.compact(F.col("norm"))).withColumn("block_id", F.format_string("p%d_b%05d", "page", "ord"))


def _table(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def run(spark: SparkSession, path: str, output: str, doc_id: int | None = None, settings: Settings | None = None, layout_engine: str = "current") -> DataFrame:
    """Write the outputs; the summary of the run.

    A document fails if its clauses break the output's schema, and is skipped if it has none; neither stops the others, and only
    documents that succeed are written. Recognised blocks below ``low_confidence`` and fields below it are issues.
    """
    settings = settings or Settings.from_env()
    blocks = read(spark, path, layout_engine)
    if doc_id is not None:
        blocks = blocks.filter(F.col("doc_id") == doc_id)
    blocks = _table(blocks, f"{output}/tables/blocks")
    first = _table(clause_state.clauses(blocks), f"{output}/tables/first_clauses")
    clauses = _table(segment.repaired(first).withColumn("clause_id", F.format_string("clause_%03d", "clause_ord")), f"{output}/tables/clauses")
    broken = (F.col("page_end") < F.col("page_start")) | (F.size(F.array_distinct("block_ids")) < F.size("block_ids")) | (F.col("text") == "")
    told = clauses.groupBy("doc_id").agg(F.when(F.bool_or(broken), "failed").otherwise("success").alias("told"))
    status = blocks.select("doc_id").distinct().join(told, "doc_id", "left").select("doc_id", F.coalesce("told", F.lit("skipped_no_clauses")).alias("status"))
    good = status.filter("status = 'success'").select("doc_id")
    clauses, own = clauses.join(good, "doc_id", "left_semi"), blocks.join(good, "doc_id", "left_semi")
    with_evidence = chunks.evidence_of(clauses, own)
    found = _table(extract.contract_fields(own, with_evidence), f"{output}/tables/fields")
    parties = fields.validate(fields.best(fields.candidates(own))).filter(F.col("field").startswith("party") & F.col("accepted"))
    low = own.filter((F.col("engine") == "ocr") & (F.col("conf") < settings.low_confidence))
    streams = [
        issues.issue(low, F.col("ord"), F.lit("LOW_CONFIDENCE"), "recognised block of low confidence", F.col("page"), F.col("block_id"), {"confidence": F.col("conf")}),
        issues.of_clauses(clauses), issues.of_doubts(clause_state.doubts(own)), issues.of_fields(found, settings.low_confidence),
    ]
    listed = _table(issues.union(streams), f"{output}/tables/issues").withColumn("field", F.col("details")["field_name"])
    named = found.filter("value is not null").select("doc_id", "field", "value", "confidence", "reason", "block_id")
    sinks.write_text(sinks.documents(clauses, named.unionByName(parties.select(named.columns)), listed), "json", f"{output}/documents")
    sinks.write_json_lines(chunks.build(with_evidence).select("doc_id", "chunk_id", "chunk_type", "quality", "pages", "confidence", "text"), f"{output}/chunks")
    sinks.write_json_lines(review.queue(review.signals(listed, review.catalogue(spark))).drop("turn"), f"{output}/review")
    summary = reports.run_summary(status)
    sinks.write_json_lines(summary, f"{output}/run")
    return summary


def main(argv: list[str] | None = None) -> int:
    """0 if a document was ingested or skipped, else 1."""
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("lexiform").getOrCreate()
    spark.sparkContext.setLogLevel(a.log_level)
    return 0 if run(spark, a.input, a.output_dir, a.doc_id, layout_engine=a.layout_engine).first()["done"] else 1


if __name__ == "__main__":
    raise SystemExit(main())
