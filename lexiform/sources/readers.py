"""Readers: files with identity, JSON lines and documents read permissively, CSV inventories, and a page-engine interface."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = "path string, page int, width double, height double, block_id string, block_type int, text string, x0 double, y0 double, x1 double, y1 double, error string"


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, content, stem of all files below ``path`` that match."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return rows.select("path", "content", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("stem"))


def with_identity(rows: DataFrame) -> DataFrame:
    """Adds source_hash of the content and doc_id: the stem with underscores and twelve digits of the hash."""
    digest = F.sha2("content", 256)
    return rows.withColumn("source_hash", F.concat(F.lit("sha256:"), digest)).withColumn("doc_id", F.concat_ws("_", F.replace(F.col("stem"), F.lit(" "), F.lit("_")), F.substring(digest, 1, 12)))


def json_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Adds parsed (variant) and status: object, blank, malformed or not_an_object. Errors are rows, not failures."""
    v = F.try_parse_json(F.col(value))
    status = F.when(F.trim(F.col(value)) == "", "blank").when(v.isNull(), "malformed").when(F.schema_of_variant(v).startswith("OBJECT"), "object").otherwise("not_an_object")
    return lines.withColumn("parsed", v).withColumn("status", status)


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document in each file; a malformed one keeps its text in _corrupt_record."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", "true").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").json(path)


def inventory(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("header", "true")
    return (reader.schema(schema) if schema else reader).csv(path)


def first_file_wins(rows: DataFrame, key: str, path: str = "path") -> DataFrame:
    """Of rows with the same key the one of the first path."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), path).alias("row_")).select("row_.*")


def listed(spark: SparkSession, names: list[str], found: DataFrame) -> DataFrame:
    """Wanted names with the path where they were found; the others are skipped_missing."""
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    return wanted.join(found.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "path"), "name", "left").withColumn("status", F.when(F.col("path").isNull(), "skipped_missing").otherwise("found"))


def pages(rows: DataFrame, engine: Callable[[str, bytes], Iterator[dict]]) -> DataFrame:
    """Blocks of pages by a page engine: a function of (path, content) that yields rows of PAGE without path and error.

    An engine's failure is a row with its message.
    """
    names = [c.split()[0] for c in PAGE.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    out += [{"path": path, "error": None} | r for r in engine(path, content)]
                except Exception as e:
                    out.append({"path": path, "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(out, columns=names, dtype=object)

    return rows.select("path", "content").mapInPandas(run, PAGE)


def polygons(points: Column) -> Column:
    from lexiform.functions import geometry

    return geometry.from_polygon(points)
