"""Clauses to retrieval chunks with their evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import text as tx


def evidence_of(clauses: DataFrame, blocks: DataFrame) -> DataFrame:
    """Clauses whose block_ids come from elsewhere, with their evidence looked up: ids without a block are left out, order is
    kept."""
    ids = clauses.select("doc_id", "clause_ord", F.posexplode("block_ids").alias("pos", "block_id"))
    found = ids.join(blocks.select("doc_id", "block_id", "page", "engine", "conf"), ["doc_id", "block_id"])
    rows = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.struct("block_id", "page", "engine", "conf").alias("e")))), lambda x: x.e)
    return clauses.drop("evidence").join(found.groupBy("doc_id", "clause_ord").agg(rows.alias("evidence")), ["doc_id", "clause_ord"], "left")


def build(clauses: DataFrame) -> DataFrame:
    """A chunk for each clause with text and evidence (an array of block_id, page, engine, conf, as clauses carry it)."""
    e = F.col("evidence")
    engines = F.array_distinct(F.transform(e, lambda x: x.engine))
    rows = clauses.filter(F.size(e) > 0).withColumn("n_blocks", F.size(F.array_distinct(F.transform(e, lambda x: x.block_id))).cast("long"))
    rows = rows.withColumn("pages", F.array_join(F.array_sort(F.array_distinct(F.transform(e, lambda x: x.page))), ",")).withColumn("confidence", F.array_min(F.transform(e, lambda x: x.conf)))
    quality = F.when(F.size(engines) == 2, "hybrid").otherwise(engines[0])
    kind = F.when(F.col("section_type").isin("signature", "appendix", "preamble"), F.col("section_type")).otherwise("clause")
    rows = rows.withColumn("quality", quality).withColumn("chunk_type", kind).withColumn("text", tx.normalize_whitespace(F.col("text"))).filter("text <> ''")
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("clause_ord"))
    return rows.withColumn("chunk_id", F.format_string("%d__chunk_%04d", F.col("doc_id"), turn))


def violations(clauses: DataFrame) -> DataFrame:
    """How many clauses break a rule of the output's schema."""
    return clauses.agg(
        F.count(F.lit(1)).alias("clauses"),
        F.count_if(F.col("page_end") < F.col("page_start")).alias("bad_pages"),
        F.count_if(F.size(F.array_distinct("block_ids")) < F.size("block_ids")).alias("repeated_blocks"),
        F.count_if(F.col("text") == "").alias("empty_texts"),
    )
