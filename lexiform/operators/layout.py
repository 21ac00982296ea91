"""Page and block measures: margins that repeat, page kinds, reading order, regions and their merge with recognised text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import geometry as geo
from lexiform.functions import predicates as pr
from lexiform.functions import roles
from lexiform.functions import text as tx
from lexiform.functions import vocabulary as v


def repeated_margins(blocks: DataFrame, height: float = 820.0, band: float = 0.12) -> DataFrame:
    """(doc_id, norm, pages): texts of top and bottom bands on two pages at least."""
    inside = (F.col("bbox.y0") >= height * band) & (F.col("bbox.y1") <= height * (1 - band))
    rows = blocks.filter(~inside & (F.length("norm") <= 80) & (F.col("norm") != "") & ~pr.is_article_heading(F.col("norm")))
    return rows.groupBy("doc_id", "norm").agg(F.count_distinct("page").alias("pages")).filter("pages >= 2")


def page_metrics(blocks: DataFrame, width: float = 600.0, height: float = 820.0) -> DataFrame:
    """Characters, blocks, coverage, garbled ratio of the joined text, and whether the page is empty."""
    chars = F.sum(F.length("norm"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x.text), "\n")
    g = blocks.groupBy("doc_id", "page").agg(chars.alias("chars"), F.count(F.lit(1)).alias("n_blocks"), F.least(F.lit(1.0), F.sum(geo.area(F.col("bbox"))) / (width * height)).alias("coverage"), tx.garbled_ratio(joined).alias("garbled"), F.avg(pr.is_weak(F.length("norm"), F.lit(0.0), F.lit(True)).cast("int")).alias("weak_ratio"))
    return g.withColumn("empty", F.col("chars") == 0)


def with_kinds(pages: DataFrame) -> DataFrame:
    return pages.withColumn("page_kind", pr.page_kind(F.col("chars"), F.col("coverage"), F.col("garbled"), F.col("weak_ratio")))


def document_kind(pages: DataFrame) -> DataFrame:
    """The kind that all pages share, else hybrid."""
    one = F.count_distinct("page_kind") == 1
    return pages.groupBy("doc_id").agg(F.when(one, F.max("page_kind")).otherwise("hybrid").alias("document_kind"), F.count(F.lit(1)).alias("pages"))


def reading_order(blocks: DataFrame) -> DataFrame:
    """Adds reading_order from 1 over pages, by place on the page."""
    w = Window.partitionBy("doc_id").orderBy("page", "bbox.y0", "bbox.x0", "ord")
    return blocks.withColumn("reading_order", F.row_number().over(w))


def neighbours(blocks: DataFrame) -> DataFrame:
    """Adds gap_before and gap_after to the blocks next to it on the page, and whether it goes on between two of them."""
    w = Window.partitionBy("doc_id", "page").orderBy("bbox.y0", "bbox.x0", "ord")
    before, after = F.lag("bbox.y1").over(w), F.lead("bbox.y0").over(w)
    rows = blocks.withColumn("gap_before", F.col("bbox.y0") - before).withColumn("gap_after", after - F.col("bbox.y1"))
    close = lambda c: F.coalesce(F.col(c).between(0, 18), F.lit(False))
    return rows.withColumn("continues", close("gap_before") & close("gap_after"))


def residual_lines(blocks: DataFrame) -> DataFrame:
    """Template lines of a document: a short line without sentence marks that it has three times, on two pages or twice on one."""
    key = F.when((F.length("norm") <= 64) & (F.col("norm") != "") & ~F.col("norm").rlike("[。、.!?]"), F.col("norm"))
    rows = blocks.withColumn("key", key).filter("key is not null")
    pages = rows.groupBy("doc_id", "key", "page").agg(F.count(F.lit(1)).alias("on_page"))
    g = pages.groupBy("doc_id", "key").agg(F.sum("on_page").alias("times"), F.count(F.lit(1)).alias("pages"), F.max("on_page").alias("most"))
    return g.filter("times >= 3 and (pages >= 2 or most >= 2)")


def merge_native_ocr(native: DataFrame, ocr: DataFrame) -> DataFrame:
    """Native blocks with the recognised text of their regions: weak ones are replaced where it is accepted.

    ``native``: doc_id, block_id, norm, weak. ``ocr``: doc_id, block_id, ocr_text, ocr_conf. A native block without a region
    stays; text of low confidence or little value is refused.
    """
    joined = native.join(ocr, ["doc_id", "block_id"], "left")
    refused = pr.is_annotation(F.col("ocr_text")) | (F.col("ocr_conf") < 0.65) | (pr.fragment_score(F.col("ocr_text")) >= 4)
    taken = F.col("weak") & F.col("ocr_text").isNotNull() & ~F.coalesce(refused, F.lit(True))
    reason = F.when(taken, "weak_native_replaced").when(F.col("ocr_text").isNull(), "no_region").when(~F.col("weak"), "native_sufficient").otherwise("ocr_refused")
    return joined.withColumn("reason", reason).withColumn("merged", F.when(taken, F.col("ocr_text")).otherwise(F.col("norm"))).withColumn("engine", F.when(taken, "ocr").otherwise("native"))


def unconsumed(regions: DataFrame, native: DataFrame) -> DataFrame:
    """Regions that no native block stands for."""
    return regions.join(native.select("doc_id", "block_id"), ["doc_id", "block_id"], "left_anti")


def keep_first(items: Column, same) -> Column:
    """Of an ordered array, each element that is not the ``same`` as one that is kept before it."""
    start = F.slice(items, 1, 0)
    return F.aggregate(items, start, lambda kept, x: F.when(F.exists(kept, lambda k: same(k, x)), kept).otherwise(F.concat(kept, F.array(x))))


def dedupe_regions(regions: DataFrame, limit: float = 0.90) -> DataFrame:
    """Regions of a page, the first by priority and place where two overlap beyond the limit (IoU).

    Greedy, so it is a fold; a page's regions are few."""
    rows = regions.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(F.struct("priority", "y0", "x0", "region_id", "bbox"))).alias("items"))
    kept = keep_first(F.col("items"), lambda k, x: geo.iou(k.bbox, x.bbox) > limit)
    return rows.select("doc_id", "page", F.explode(kept).alias("r")).select("doc_id", "page", "r.region_id", "r.priority")


def adjacent_islands(blocks: DataFrame, gap: float = 6.0) -> DataFrame:
    """Neighbouring body lines of a page as one block: text joined by line ends, boxes united."""
    w = Window.partitionBy("doc_id", "page").orderBy("bbox.y0", "bbox.x0", "ord")
    heading = pr.is_article_heading(F.col("norm"))
    near = (F.col("bbox.y0") - F.lag("bbox.y1").over(w) <= gap) & ~heading & ~F.lag(heading).over(w) & (F.col("norm") != "") & (F.lag("norm").over(w) != "")
    rows = blocks.withColumn("begin", (~F.coalesce(near, F.lit(False))).cast("int"))
    rows = rows.withColumn("island", F.sum("begin").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "norm"))), lambda x: x.norm), "\n")
    return rows.groupBy("doc_id", "page", "island").agg(text.alias("text"), F.count(F.lit(1)).alias("n_lines"), F.min("bbox.y0").alias("y0"), F.max("bbox.y1").alias("y1"), F.max("bbox.x1").alias("x1"))


def page_extents(blocks: DataFrame) -> DataFrame:
    """(doc_id, page, height, width): how far the content of a page reaches; 1000 where nothing does."""
    reach = lambda c: F.when(F.max(c) > 0, F.max(c)).otherwise(F.lit(1000.0))
    return blocks.groupBy("doc_id", "page").agg(reach("bbox.y1").alias("height"), reach("bbox.x1").alias("width"))


def mark_repeated(blocks: DataFrame) -> DataFrame:
    """Adds ``repeated``: whether the text stands on two pages at least in the outer 12 % or as a narrow note at the right."""
    w = Window.partitionBy("doc_id", "page")
    rows = blocks.withColumns({"high_": F.max("bbox.y1").over(w), "wide_": F.max("bbox.x1").over(w)})
    norm, n, box = F.col("norm"), F.length("norm"), F.col("bbox")
    beside = (box["x0"] >= F.col("wide_") * 0.82) & (box["x1"] - box["x0"] <= F.col("wide_") * 0.24) & (n <= 40) & ~roles.sentence(norm)
    outer = (box["y1"] <= F.col("high_") * 0.12) | (box["y0"] >= F.col("high_") * 0.88) | beside
    where = F.when(outer & (n > 0) & (n <= 80) & ~pr.is_article_heading(norm), F.col("page"))
    same = Window.partitionBy("doc_id", "norm")
    return rows.withColumn("repeated", F.coalesce(F.min(where).over(same) < F.max(where).over(same), F.lit(False))).drop("high_", "wide_")


def template_key(norm: Column, sentence: Column) -> Column:
    """Key of a template's header: one of two shapes in 64 characters without sentence marks; else null."""
    c = F.regexp_replace(norm, r"\s+", "")
    plain = (norm != "") & (F.length(norm) <= 64) & ~sentence & ~c.rlike("[。:;]")
    pair = c.contains(v.TEMPLATE_PAIR[0]) & c.contains(v.TEMPLATE_PAIR[1])
    return F.when(plain & pair, F.lit("".join(v.TEMPLATE_PAIR))).when(plain & c.rlike(v.TEMPLATE_HEADER), c)


def template_headers(blocks: DataFrame) -> DataFrame:
    """Blocks (with signs) that are a template's header, three times in the document, on two pages or twice on theirs, in the
    upper 70 % of their page or in brackets: what is left of a form, not of the contract."""
    rows = blocks.withColumn("key", template_key(F.col("norm"), F.col("sentence")))
    top = F.max("bbox.y1").over(Window.partitionBy("doc_id", "page"))
    rows = rows.withColumn("reach_", top).filter("key is not null")
    of, on = Window.partitionBy("doc_id", "key"), Window.partitionBy("doc_id", "key", "page")
    often = (F.count(F.lit(1)).over(of) >= 3) & ((F.min("page").over(of) < F.max("page").over(of)) | (F.count(F.lit(1)).over(on) >= 2))
    placed = (F.col("bbox.y0") <= F.col("reach_") * 0.70) | F.col("key").startswith("(")
    return rows.withColumn("residual", often & placed).filter("residual").drop("reach_", "residual")


def mirror_key(norm: Column) -> Column:
    """The text without blanks and without punctuation at its ends: what mirrored copies share."""
    return F.regexp_replace(F.regexp_replace(norm, r"\s+", ""), "^[、。.,::;]+|[、。.,::;]+$", "")


def drop_mirrored(blocks: DataFrame) -> DataFrame:
    """Body blocks without those that mirror one kept before them on the page: the same ten characters or more, beside each
    other at the same height, on either side of the page's middle. Greedy in the order of place, so it is a fold."""
    w = Window.partitionBy("doc_id", "page")
    rows = blocks.withColumns({"key": mirror_key(F.col("norm")), "left_": F.min("bbox.x0").over(w), "right_": F.max("bbox.x1").over(w)})
    item = F.struct("bbox.y0", "bbox.x0", "ord", "key", "bbox", "left_", "right_", "norm")
    pages = rows.groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(item)).alias("items"))

    def mirrors(a: Column, b: Column) -> Column:
        size = lambda x, lo, hi: x.bbox[hi] - x.bbox[lo]
        shared = lambda lo, hi: F.greatest(F.lit(0.0), F.least(a.bbox[hi], b.bbox[hi]) - F.greatest(a.bbox[lo], b.bbox[lo]))
        tall, wide = ([F.least(size(a, *e), size(b, *e)), F.greatest(size(a, *e), size(b, *e))] for e in (("y0", "y1"), ("x0", "x1")))
        width = F.greatest(F.lit(1.0), a.right_ - a.left_)
        middle = a.left_ + width / 2
        at, bt = (a.bbox.x0 + a.bbox.x1) / 2, (b.bbox.x0 + b.bbox.x1) / 2
        alike = (tall[0] > 0) & (wide[0] > 0) & (tall[1] <= tall[0] * 1.25) & (wide[1] <= wide[0] * 1.35) & (shared("y0", "y1") >= tall[0] * 0.85) & (shared("x0", "x1") <= wide[0] * 0.15)
        return (a.key == b.key) & (F.length(a.key) >= 10) & alike & (F.abs(at - bt) >= F.greatest(F.lit(120.0), width * 0.28)) & ((at < middle) & (bt > middle) | (at > middle) & (bt < middle))

    return pages.select("doc_id", "page", F.explode(keep_first(F.col("items"), mirrors)).alias("r")).select("doc_id", "page", "r.ord", "r.norm", "r.bbox")
