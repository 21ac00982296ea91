"""Pages as engines give them, recognition results and file discovery, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.sources import bridges as br
from lexiform.sources import layouts, readers


def pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page of 600 x 800 for each order: a text block for each of three lines, one of them blank, and three images."""
    o = br.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    number = lambda *c: F.array(*[F.array(*[x if not isinstance(x, str) else F.lit(x) for x in line]) for line in c])
    k = F.col("k")

    def block(kind: int, x0, y0, w, h, lines: Column) -> Column:
        x0, y0 = (v if not isinstance(v, (int, float)) else F.lit(float(v)) for v in (x0, y0))
        return F.struct(F.lit(kind).alias("type"), x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), (x0 + w).cast("double").alias("x1"), (y0 + h).cast("double").alias("y1"), lines.alias("lines"))

    none = F.array().cast("array<array<string>>")
    blocks = F.array(
        block(0, 60, 50, 300, 16, number([F.concat(F.lit("第"), k.cast("string")), "条 "], ["納品"])),
        block(1, k % 500, k % 700, k % 90, 30, none),
        block(0, 60, 90, 300, 16, number([" ", "\t"])),
        block(1, 560, 300, k % 40, 60, none),
        block(0, 60, 130, 300, 16, number(["乙は"], ["納品する。"])),
        block(1, 100, 400, F.when(k % 7 == 0, 400).otherwise(0), F.when(k % 7 == 0, 300).otherwise(0), none),
    )
    return o.select(k.alias("doc_id"), F.lit(1).alias("page"), F.lit(600.0).alias("width"), F.lit(800.0).alias("height"), blocks.alias("blocks"))


def page_text_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return layouts.text_blocks(pages(spark, sf)).select("doc_id", "block_id", "text", "norm", F.col("bbox.y0").alias("y0"))


def page_image_regions(spark: SparkSession, sf: str) -> DataFrame:
    return layouts.image_regions(pages(spark, sf)).select("doc_id", "region_id", F.round("share", 6).alias("share"))


def page_image_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return layouts.image_coverage(pages(spark, sf)).select("doc_id", F.round("coverage", 8).alias("coverage"))


def recognition_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Pixel boxes of regions, some beyond the page's edge."""
    p = pages(spark, sf)
    r = p.select("doc_id", "page", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("i")).filter("doc_id % 3 > 0")
    x0 = ((F.col("doc_id") * 7) % 500 + F.col("i") * 70).cast("double")
    r = r.select("doc_id", "page", F.format_string("r%d", "i").alias("region_id"), F.struct(x0.alias("x0"), F.lit(700.5).alias("y0"), (x0 + 33.3).alias("x1"), F.lit(830.0).alias("y1")).alias("bbox"))
    q = layouts.requests(r, p)
    return q.select("doc_id", F.size("crops").alias("crops"), F.col("crops")[0]["px"]["x0"].alias("x0"), F.element_at(F.col("crops"), -1)["px"]["x1"].alias("x1"), F.col("crops")[0]["px"]["y1"].alias("y1"), F.array_join("failed", ",").alias("failed"))


def recognised_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Results of two nestings, with odd ones among them."""
    line = "[[[1,2],[3,2]],[\"文字%d\",%s]]"
    one = F.format_string(line, F.col("o_orderkey"), F.lit("1.25"))
    two = F.format_string(line, F.col("o_orderkey") + 1, F.lit("0.5"))
    k = F.col("o_orderkey") % 5
    result = F.when(k == 0, F.concat(F.lit("["), one, F.lit(","), two, F.lit("]"))).when(k == 1, F.concat(F.lit("[["), one, F.lit(","), two, F.lit("]]"))).when(k == 2, "[]").when(k == 3, "broken").otherwise("[null]")
    o = br.table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderkey", result.alias("result")).drop("o_orderkey")
    return layouts.recognised(o).select("doc_id", "line", "text", "confidence")


def labelled_order(spark: SparkSession, sf: str) -> DataFrame:
    p = pages(spark, sf).select("doc_id", "page", F.posexplode("blocks").alias("hint", "b"))
    b = p.select("doc_id", "page", "hint", F.struct("b.x0", "b.y0", "b.x1", "b.y1").alias("bbox"))
    return layouts.labelled_order(b).select("doc_id", "hint", "reading_order")


def file_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Paths of suppliers' files, found as they are or below one of two roots, and the first file of each name."""
    s = br.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    wanted = s.select("k", F.concat(F.lit("f"), F.col("k").cast("string")).alias("path"))
    place = F.expr("CASE k % 4 WHEN 0 THEN array('') WHEN 1 THEN array('b/') WHEN 2 THEN array('b/', 'a/') ELSE array() END")
    files = s.select(F.explode(place).alias("root"), "k").select(F.concat("root", F.lit("f"), F.col("k").cast("string")).alias("path"))
    return layouts.resolved(wanted, files, ["a", "b"]).select("k", "found")


def folder_discovery(spark: SparkSession, sf: str) -> DataFrame:
    s = br.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    name = F.concat(F.lit("n"), (F.col("k") % 50).cast("string"))
    listed = s.filter("k % 3 = 0").select(name.alias("name"), F.concat(F.lit("m/"), F.col("k").cast("string")).alias("path"), (-F.col("k")).alias("turn"))
    found = s.select(name.alias("name"), F.concat(F.lit("d/"), F.col("k").cast("string")).alias("path"))
    return layouts.discovered(listed, found).select("name", "path", F.col("turn.k").alias("kind"))


def first_files(spark: SparkSession, sf: str) -> DataFrame:
    s = br.table(spark, sf, "supplier").select((F.col("s_suppkey") % 10).alias("doc_id"), F.concat(F.lit("d/"), F.col("s_suppkey").cast("string")).alias("path"))
    return readers.first_file_wins(s, "doc_id")


QUERIES = {f.__name__: f for f in (page_text_blocks, page_image_regions, page_image_coverage, recognition_requests, recognised_lines, labelled_order, file_resolution, folder_discovery, first_files)}

_I = "WITH i AS (SELECT o_orderkey AS k, unnest([2, 4, 6]) AS n FROM orders), g AS (SELECT k, n, CASE n WHEN 2 THEN k % 500 WHEN 4 THEN 560 ELSE 100 END AS x0, CASE n WHEN 2 THEN k % 700 WHEN 4 THEN 300 ELSE 400 END AS y0, CASE n WHEN 2 THEN k % 90 WHEN 4 THEN k % 40 WHEN 6 THEN CASE WHEN k % 7 = 0 THEN 400 ELSE 0 END END AS w, CASE n WHEN 2 THEN 30 WHEN 4 THEN 60 ELSE CASE WHEN k % 7 = 0 THEN 300 ELSE 0 END END AS h FROM i), s AS (SELECT *, w * h / 480000.0 AS share FROM g)"
_PX = "CAST(floor(greatest(0, least({}, {})) * (220 / 72.0::DOUBLE)) AS INT)"
SQL = {
    "page_text_blocks": "SELECT o_orderkey AS doc_id, 'p1_n001' AS block_id, concat('第', o_orderkey, '条 納品') AS text, concat('第', o_orderkey, '条 納品') AS norm, 50.0::DOUBLE AS y0 FROM orders UNION ALL SELECT o_orderkey, 'p1_n003', '乙は納品する。', '乙は納品する。', 130.0 FROM orders",
    "page_image_regions": _I + " SELECT k AS doc_id, printf('p1_img%03d', n) AS region_id, round(share, 6)::DOUBLE AS share FROM s WHERE w > 0 AND share >= 0.0015 AND NOT ((y0 + h <= 120 OR x0 + w <= 72 OR x0 >= 528) AND share < 0.006)",
    "page_image_coverage": _I + " SELECT k AS doc_id, round(least(1.0::DOUBLE, sum(w * h)::DOUBLE / 480000), 8) AS coverage FROM s GROUP BY k",
    "recognition_requests": f"WITH r AS (SELECT o_orderkey AS doc_id, unnest([0, 1, 2]) AS i FROM orders WHERE o_orderkey % 3 > 0), b AS (SELECT *, ((doc_id * 7) % 500 + i * 70)::DOUBLE AS x FROM r), p AS (SELECT doc_id, i, {_PX.format('x', 600)} AS x0, {_PX.format('x + 33.3::DOUBLE', 600)} AS x1, {_PX.format(830, 800)} AS y1 FROM b) SELECT doc_id, count(*) FILTER (x1 > x0)::INT AS crops, arg_min(x0, i) FILTER (x1 > x0) AS x0, arg_max(x1, i) FILTER (x1 > x0) AS x1, max(y1) AS y1, coalesce(string_agg(concat('r', i), ',' ORDER BY i) FILTER (x1 <= x0), '') AS failed FROM p GROUP BY doc_id",
    "recognised_lines": "SELECT o_orderkey AS doc_id, 1 AS line, concat('文字', o_orderkey) AS text, 1.0::DOUBLE AS confidence FROM orders WHERE o_orderkey % 5 < 2 UNION ALL SELECT o_orderkey, 2, concat('文字', o_orderkey + 1), 0.5 FROM orders WHERE o_orderkey % 5 < 2",
    "labelled_order": "WITH b AS (SELECT o_orderkey AS doc_id, unnest([{'h': 0, 'x': 60, 'y': 50}, {'h': 1, 'x': o_orderkey % 500, 'y': o_orderkey % 700}, {'h': 2, 'x': 60, 'y': 90}, {'h': 3, 'x': 560, 'y': 300}, {'h': 4, 'x': 60, 'y': 130}, {'h': 5, 'x': 100, 'y': 400}]) AS b FROM orders) SELECT doc_id, b.h::INT AS hint, row_number() OVER (PARTITION BY doc_id ORDER BY b.y, b.x, b.h)::INT AS reading_order FROM b",
    "file_resolution": "SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN concat('f', s_suppkey) WHEN 1 THEN concat('b/f', s_suppkey) WHEN 2 THEN concat('a/f', s_suppkey) END AS found FROM supplier",
    "folder_discovery": "WITH s AS (SELECT s_suppkey AS k, concat('n', s_suppkey % 50) AS name FROM supplier), a AS (SELECT name, 0 AS kind, -k AS i, concat('m/', k) AS path FROM s WHERE k % 3 = 0 UNION ALL SELECT name, 1, 0, concat('d/', k) FROM s) SELECT name, path, kind FROM a QUALIFY row_number() OVER (PARTITION BY name ORDER BY kind, i, path) = 1",
    "first_files": "SELECT s_suppkey % 10 AS doc_id, min(concat('d/', s_suppkey)) AS path FROM supplier GROUP BY 1",
}
