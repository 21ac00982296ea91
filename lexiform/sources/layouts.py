"""What page engines give, as relations: text and image blocks, pixel boxes, recognition requests and results, and where
files are found.

``pages``: doc_id, page, width, height, blocks: array of (type, x0, y0, x1, y1, lines: array of arrays of span texts), as a
page engine's dictionary has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import text as tx

#: Shares of a page below which an image is no region, anywhere and near the top or a side.
LEAST, LEAST_OUTER = 0.0015, 0.0060
DPI = 220


def _exploded(pages: DataFrame, kind: int) -> DataFrame:
    """Blocks of a type with their number among all blocks of the page, from 1."""
    rows = pages.select("doc_id", "page", "width", "height", F.posexplode("blocks").alias("at", "b"))
    return rows.filter(F.col("b.type") == kind).withColumn("at", F.col("at") + 1)


def _box(b: str = "b") -> Column:
    return F.struct(*[F.col(f"{b}.{n}").cast("double").alias(n) for n in ("x0", "y0", "x1", "y1")])


def text_blocks(pages: DataFrame) -> DataFrame:
    """doc_id, page, block_id, text, norm, bbox: lines and spans joined without anything between them. Blocks are numbered by
    place on the page before those without text go."""
    rows = _exploded(pages, 0).withColumn("text", F.array_join(F.transform("b.lines", lambda spans: F.array_join(spans, "")), ""))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("at"))).withColumn("norm", tx.normalize_whitespace(F.col("text")))
    return rows.filter("norm <> ''").select("doc_id", "page", F.format_string("p%d_n%03d", "page", "n").alias("block_id"), "text", "norm", _box().alias("bbox"))


def image_regions(pages: DataFrame) -> DataFrame:
    """doc_id, page, region_id, bbox, share: image blocks that are large enough, larger near the top or a side."""
    b = F.col("b")
    area = (b["x1"] - b["x0"]) * (b["y1"] - b["y0"]) / F.greatest(F.col("width") * F.col("height"), F.lit(1.0))
    outer = (b["y1"] <= F.col("height") * 0.15) | (b["x1"] <= F.col("width") * 0.12) | (b["x0"] >= F.col("width") * 0.88)
    rows = _exploded(pages, 1).filter((b["x1"] > b["x0"]) & (b["y1"] > b["y0"])).withColumn("share", area)
    kept = rows.filter((F.col("share") >= LEAST) & ~(outer & (F.col("share") < LEAST_OUTER)))
    return kept.select("doc_id", "page", F.format_string("p%d_img%03d", "page", "at").alias("region_id"), _box().alias("bbox"), "share")


def image_coverage(pages: DataFrame) -> DataFrame:
    """(doc_id, page, coverage): area of all images over that of the page, 1 at most; 0 without images."""
    of = F.aggregate(F.filter("blocks", lambda b: b.type == 1), F.lit(0.0), lambda a, b: a + (b.x1 - b.x0) * (b.y1 - b.y0))
    return pages.select("doc_id", "page", F.least(F.lit(1.0), of / F.greatest(F.col("width") * F.col("height"), F.lit(1.0))).alias("coverage"))


def pixel_box(box: Column, width: Column, height: Column, dpi: int = DPI) -> Column:
    """A page's box as whole pixels of its rendering: clipped to the page, cut off, not rounded. Null if nothing is left."""
    zoom = dpi / 72
    at = lambda v, top: F.floor(F.greatest(F.lit(0.0), F.least(v, top)) * zoom).cast("int")
    out = F.struct(at(box["x0"], width).alias("x0"), at(box["y0"], height).alias("y0"), at(box["x1"], width).alias("x1"), at(box["y1"], height).alias("y1"))
    return F.when((out["x1"] > out["x0"]) & (out["y1"] > out["y0"]), out)


def requests(regions: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page, crops, failed): what is to be recognised, only of pages with regions; regions that leave no pixels."""
    size = pages.select("doc_id", "page", "width", "height")
    rows = regions.join(size, ["doc_id", "page"]).withColumn("px", pixel_box(F.col("bbox"), F.col("width"), F.col("height")))
    some, none = F.when(F.col("px").isNotNull(), F.struct("region_id", "px")), F.when(F.col("px").isNull(), F.col("region_id"))
    return rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(some)).alias("crops"), F.array_sort(F.collect_list(none)).alias("failed"))


def recognised(results: DataFrame, result: str = "result") -> DataFrame:
    """Adds text, confidence and line to the rows of ``results``, once for each recognised line.

    ``result`` is an engine's JSON: lines of [box, [text, confidence]], or a list of such lists. Confidence is held between 0
    and 1; what isn't of such a shape gives no lines.
    """
    spark = results.sparkSession
    nested = "schema_of_variant(try_variant_get(v_, '$[0][0][1][0]', 'variant')) = 'STRING'"
    rows = results.withColumn("v_", F.try_parse_json(F.col(result))).withColumn("v_", F.expr(f"CASE WHEN {nested} THEN variant_get(v_, '$[0]', 'variant') ELSE v_ END"))
    keep = ", ".join(f"r.`{c}`" for c in results.columns)
    lines = spark.sql(f"SELECT {keep}, e.pos + 1 AS line, try_variant_get(e.value, '$[1][0]', 'string') AS text, try_variant_get(e.value, '$[1][1]', 'double') AS confidence FROM {{rows}} AS r, LATERAL variant_explode(r.v_) AS e", rows=rows)
    return lines.filter("text is not null and confidence is not null").withColumn("confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "confidence")))


def labelled_order(blocks: DataFrame) -> DataFrame:
    """Adds reading_order to another engine's blocks (label, page, bbox, hint): by page, place and the engine's own order."""
    w = Window.partitionBy("doc_id").orderBy("page", "bbox.y0", "bbox.x0", "hint")
    return blocks.withColumn("reading_order", F.row_number().over(w))


def discovered(listed: DataFrame, found: DataFrame) -> DataFrame:
    """(name, path, turn): folders that a manifest lists, then the others that were found, each name once; by turn they are in the
    manifest's order and then in that of their names."""
    a = listed.select("name", "path", F.lit(0).alias("k"), F.col("turn").cast("long").alias("i"))
    b = found.select("name", "path", F.lit(1).alias("k"), F.lit(0).cast("long").alias("i"))
    first = a.unionByName(b).groupBy("name").agg(F.min(F.struct("k", "i", "path")).alias("x"))
    return first.select("name", "x.path", F.struct("x.k", "x.i", "name").alias("turn"))


def resolved(wanted: DataFrame, files: DataFrame, roots: list[str]) -> DataFrame:
    """Adds found to ``wanted`` (path): the path itself if it is there, else below the first root that has it; null if none."""
    tries = F.posexplode(F.concat(F.array(F.col("path")), F.array(*[F.concat(F.lit(r.rstrip("/") + "/"), F.col("path")) for r in roots]))).alias("turn_", "found")
    near = wanted.select("path").distinct().select("path", tries).join(files.select(F.col("path").alias("found")).distinct(), "found", "left_semi")
    return wanted.join(near.groupBy("path").agg(F.min_by("found", "turn_").alias("found")), "path", "left")
