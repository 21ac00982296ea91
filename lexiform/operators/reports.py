"""Runs and reports: summaries of batches, scorecards of inventories, comparisons of engines, counters of matches, and what is
to be recognised on each page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import geometry as geo
from lexiform.operators import evaluate, layout

#: A date with blanks for its numbers, with and without an era.
HOLDER = "((令和|平成|昭和)\\s*[0-9○◯〇□\\s]*年[○◯〇□\\s]*月[○◯〇□\\s]*日|[○◯〇□\\s]*年[○◯〇□\\s]*月[○◯〇□\\s]*日)"
EXECUTION = "上記契約の成立を証するため|本契約(締結)?の証として|記名押印|署名"


def run_summary(runs: DataFrame) -> DataFrame:
    """Counts of a batch by status, and whether it counts as done: with a success or a skip."""
    n = lambda s: F.count_if(F.col("status") == s)
    g = runs.agg(F.count(F.lit(1)).alias("total"), n("success").alias("success"), n("failed").alias("failed"), F.count_if(F.col("status").startswith("skipped")).alias("skipped"))
    return g.withColumn("done", (F.col("success") + F.col("skipped")) > 0)


def scorecard_lines(inventory: DataFrame, runs: DataFrame, columns: list[str]) -> DataFrame:
    """(stem, line): for each row of the inventory its run's values, tab-separated; MISSING_RUN where there is none."""
    rows = inventory.select("stem").join(runs.select("stem", F.lit(True).alias("ran_"), *columns), "stem", "left")
    value = lambda c, t: F.coalesce(F.array_join(c, "; ") if t.startswith("array") else F.col(c).cast("string"), F.lit(""))
    kinds = dict(runs.dtypes)
    line = F.concat_ws("\t", "stem", *[value(c, kinds[c]) for c in columns])
    return rows.select("stem", F.when(F.col("ran_"), line).otherwise(F.concat_ws("\t", F.col("stem"), F.lit("MISSING_RUN"))).alias("line"))


def fixed_width(rows: DataFrame, widths: dict[str, int]) -> DataFrame:
    """(line): columns padded or cut to their widths, with single blanks between them."""
    return rows.select(F.concat_ws(" ", *[F.rpad(F.coalesce(F.col(c).cast("string"), F.lit("-")), w, " ") for c, w in widths.items()]).alias("line"))


def ratio(c: Column) -> Column:
    """A share as text with three decimals; a dash for none."""
    return F.when(c.isNotNull(), F.format_string("%.3f", c.cast("double"))).otherwise("-")


def engine_counts(blocks: DataFrame) -> DataFrame:
    """(doc_id, engine, pages, blocks, labels): what each engine found, its labels with their counts by name."""
    by = blocks.groupBy("doc_id", "engine", "label").agg(F.count(F.lit(1)).alias("n"), F.collect_set("page").alias("pages"))
    return by.groupBy("doc_id", "engine").agg(F.size(F.array_distinct(F.flatten(F.collect_list("pages")))).alias("pages"), F.sum("n").alias("blocks"), F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "label", "n"))), ",").alias("labels"))


def reading_orders(blocks: DataFrame, first: int = 40) -> DataFrame:
    """(doc_id, engine, texts): the first texts of each engine in its order, side by side, not joined."""
    w = Window.partitionBy("doc_id", "engine").orderBy("reading_order")
    rows = blocks.withColumn("turn_", F.row_number().over(w)).filter(F.col("turn_") <= first)
    return rows.groupBy("doc_id", "engine").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn_", "text"))), lambda x: x.text).alias("texts"))


def match_counters(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(metric, n) over documents: classes of each field's match, clauses too many or too few, reviews that were right or
    missed, and issues that speak of form, signature or header and footer.

    Needs expected_<field> and <field>, expected_clauses and clauses, expected_review and reviewed, and issues (array of texts).
    """
    classes = [F.concat(F.lit(f"{f}:"), evaluate.match_class(F.col(f"expected_{f}"), F.col(f))) for f in fields]
    counted = rows.select(F.explode(F.array(*classes)).alias("metric"), F.lit(1).cast("long").alias("n"))
    told = lambda word: F.size(F.filter("issues", lambda x: x.contains(word))).cast("long")
    sums = {
        "clause_count_error": F.abs(F.col("clauses") - F.col("expected_clauses")).cast("long"),
        "true_review": (F.col("expected_review") & F.col("reviewed")).cast("long"),
        "false_clean": (F.col("expected_review") & ~F.col("reviewed")).cast("long"),
        "form_contamination": told("form"), "signature_leakage": told("signature"), "header_footer_leakage": told("header"),
    }
    summed = rows.agg(*[F.sum(c).alias(k) for k, c in sums.items()]).select(F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in sums]), F.array(*[F.col(k) for k in sums]))).alias("metric", "n"))
    return counted.groupBy("metric").agg(F.sum("n").alias("n")).unionByName(summed)


def signature_dates(blocks: DataFrame, reach: int = 8) -> DataFrame:
    """(doc_id, ord, date): blocks of signing with the first date with blanks in themselves or the next blocks of their page."""
    w = Window.partitionBy("doc_id", "page").orderBy("ord").rowsBetween(0, reach)
    date = F.nullif(F.trim(F.regexp_extract("norm", HOLDER, 1)), F.lit(""))
    rows = blocks.withColumn("date", F.first(date, ignorenulls=True).over(w))
    return rows.filter(F.col("norm").rlike(EXECUTION) & F.col("date").isNotNull()).select("doc_id", "ord", "date")


def page_regions(pages: DataFrame, weak: DataFrame, images: DataFrame) -> DataFrame:
    """(doc_id, page, page_kind, regions, ocr_ratio, reason): what is to be recognised on each page.

    ``pages``: doc_id, page, width, height, page_kind, reason. Regions of weak blocks (priority 20) and images (10), the first of
    those that overlap; a scanned page without any is one region. The ratio is their area over the page's, 1 at most.
    """
    keys = ["doc_id", "page"]
    some = weak.select(*keys, "region_id", "bbox", F.lit(20).alias("priority")).unionByName(images.select(*keys, "region_id", "bbox", F.lit(10).alias("priority")))
    some = some.withColumns({"y0": F.col("bbox.y0"), "x0": F.col("bbox.x0")})
    kept = layout.dedupe_regions(some).select(*keys, "region_id").join(some, [*keys, "region_id"]).groupBy(*keys).agg(F.collect_list(F.struct("priority", "region_id", "bbox")).alias("found"))
    whole = F.array(F.struct(F.lit(10).alias("priority"), F.format_string("p%d_full", "page").alias("region_id"), F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.col("width").cast("double").alias("x1"), F.col("height").cast("double").alias("y1")).alias("bbox")))
    rows = pages.join(kept, keys, "left").withColumn("found", F.when(F.col("found").isNotNull(), F.array_sort("found")).when(F.col("page_kind") == "scanned", whole).otherwise(F.slice(whole, 1, 0)))
    area = F.aggregate("found", F.lit(0.0), lambda a, x: a + geo.area(x["bbox"]))
    share = F.least(F.lit(1.0), area / F.greatest(F.col("width") * F.col("height"), F.lit(1.0)))
    return rows.select(*keys, "page_kind", F.transform("found", lambda x: x["region_id"]).alias("regions"), share.alias("ocr_ratio"), F.concat("reason", F.lit(";ocr_regions="), F.size("found").cast("string")).alias("reason"))
