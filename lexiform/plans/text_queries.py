"""Text functions and predicates over line blocks and contract blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions import dates, geometry, vocabulary
from lexiform.functions import predicates as pr
from lexiform.functions import roles
from lexiform.functions import text as tx
from lexiform.sources import bridges as br

#: Portable SQL for normalised lines and blocks.
NORM = r"trim(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '\s+', ' ', 'g'))"
LINES = f"WITH {br.LINES}, n AS (SELECT doc_id, ord, ord // 40 + 1 AS page, text, {NORM} AS norm FROM lines)"
BLOCKS = f"WITH {br.CONTRACTS}, n AS (SELECT doc_id, CAST(ord AS INT) AS ord, page, text, text AS norm, regexp_replace(text, '\\s+', '', 'g') AS compact, CAST(conf AS DOUBLE) AS conf, engine FROM blocks)"
#: Portable SQL for sentences, with hiragana counted as hira and English words as words.
_PARTICLES = " + ".join(f"contains(norm, '{x}')::INT" for x in vocabulary.SENTENCE_PARTICLES)
SENTENCE = f"(length(norm) >= 16 AND regexp_matches(norm, '{vocabulary.alternatives(vocabulary.SENTENCE_MARKS)}') OR length(norm) >= 14 AND {_PARTICLES} >= 2 AND hira >= 3 OR length(norm) >= 16 AND hira >= 5 OR words >= 4 AND regexp_matches(lower(norm), '{vocabulary.alternatives(vocabulary.ENGLISH_MARKS)}') OR words >= 6 AND regexp_matches(norm, '[.;]$') OR length(norm) >= 24 AND hira >= 3)"
ART = f"^\\s*第[{tx.NUMERAL}]+\\s*条"


def text_normalize(spark: SparkSession, sf: str) -> DataFrame:
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select("doc_id", F.sha2(tx.normalize_text(F.col("text")), 256).alias("norm_sha"), F.length(tx.normalize_text(F.col("text"))).alias("n"))


def digits_normalize(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    wide = F.translate(F.concat(F.lit("第"), F.col("o_orderkey").cast("string"), F.lit("号")), tx.DIGITS, tx.FULL_DIGITS)
    return o.select("o_orderkey", tx.normalize_digits(wide).alias("digits"), F.length(wide).alias("n"))


def garbled_ratio(spark: SparkSession, sf: str) -> DataFrame:
    d = spark.read.parquet(f"{sf}/documents.parquet")
    t = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("��\x01\n"))).otherwise(F.col("text"))
    return d.select("doc_id", F.round(tx.garbled_ratio(t), 6).alias("ratio"))


def compact_text(spark: SparkSession, sf: str) -> DataFrame:
    b = br.line_blocks(spark, sf)
    return b.select("doc_id", "ord", tx.compact(F.col("norm")).alias("compact"), tx.snippet(F.col("norm"), 80).alias("snippet"))


_KANJI = "一二三四五六七八九"


def article_number(spark: SparkSession, sf: str) -> DataFrame:
    """Kanji numerals of 1 to 399 and digits, back to numbers."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", (F.col("o_orderkey") % 399 + 1).cast("int").alias("v"))
    digit = lambda c: F.substring(F.lit(_KANJI), c, F.lit(1))
    part = lambda c, unit: F.when(c == 0, "").when(c == 1, unit).otherwise(F.concat(digit(c), F.lit(unit)))
    h, t, u = (F.floor(F.col("v") / 100).cast("int"), F.floor(F.col("v") % 100 / 10).cast("int"), F.col("v") % 10)
    kanji = F.concat(part(h, "百"), part(t, "十"), F.when(u == 0, "").otherwise(digit(u)))
    shown = F.concat(F.lit("第"), F.when(F.col("v") % 2 == 0, kanji).otherwise(F.col("v").cast("string")), F.lit("条"))
    return o.select("o_orderkey", tx.article_number(shown).alias("article"))


def _dates(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), (F.day("o_orderdate") + F.col("o_orderkey") % 3).alias("d"))


def jp_date_to_iso(spark: SparkSession, sf: str) -> DataFrame:
    c = F.format_string("契約は%d年%d月%d日から", "y", "m", "d")
    return _dates(spark, sf).select("o_orderkey", dates.iso_date(c).alias("iso"))


def era_date_to_iso(spark: SparkSession, sf: str) -> DataFrame:
    return _dates(spark, sf).select("o_orderkey", dates.iso_date(F.format_string("令和%d年%d月%d日", F.col("y") - 1990, "m", "d")).alias("iso"), dates.kept_date(F.format_string("令和%d年%d月%d日", F.col("y") - 1990, "m", "d")).alias("kept"))


def en_date_to_iso(spark: SparkSession, sf: str) -> DataFrame:
    name = F.element_at(F.array(*[F.lit(m) for m in dates.MONTHS]), F.col("m").cast("int"))
    first = F.format_string("as of %s %d, %d", name, F.col("d"), F.col("y"))
    then = F.format_string("on %d %s %d", F.col("d"), F.substring(name, 1, 3), F.col("y"))
    return _dates(spark, sf).select("o_orderkey", dates.iso_date(first).alias("month_first"), dates.iso_date(then).alias("day_first"))


_ISO_SQL = "CASE WHEN d + k % 3 <= day(last_day(make_date(y::INT, m::INT, 1))) THEN printf('%04d-%02d-%02d', {y}, m, d + k % 3) END"
_D = "WITH t AS (SELECT o_orderkey AS k, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders)"


def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    b = br.contract_blocks(spark, sf).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda x: x.text), "\n").alias("text"))
    s = tx.sentences(F.col("text"))
    return b.select("doc_id", F.size(s).alias("n"), s[0].alias("first"), F.element_at(s, -1).alias("last"))


def all_dates(spark: SparkSession, sf: str) -> DataFrame:
    b = br.contract_blocks(spark, sf).filter("ord = 10001")
    d = dates.all_dates(F.col("norm"))
    return b.select("doc_id", F.size(d).alias("n"), F.array_join(d, ",").alias("dates"))


def bbox_iou(spark: SparkSession, sf: str) -> DataFrame:
    """IoU of each line's box with that of the next line, moved up."""
    from pyspark.sql import Window

    b = br.line_blocks(spark, sf)
    w = Window.partitionBy("doc_id", "page").orderBy("ord")
    nxt = F.lead("bbox").over(w)
    up = F.struct(nxt["x0"].alias("x0"), (nxt["y0"] - 12).alias("y0"), nxt["x1"].alias("x1"), (nxt["y1"] - 12).alias("y1"))
    return b.withColumn("up", F.when(nxt.isNotNull(), up)).filter("up is not null").select("doc_id", "ord", F.round(geometry.iou(F.col("bbox"), F.col("up")), 6).alias("iou"))


def _flagged(test):
    return lambda spark, sf: br.line_blocks(spark, sf).filter(test(F.col("norm"))).select("doc_id", "ord", "norm")


def _on_blocks(test):
    return lambda spark, sf: br.contract_blocks(spark, sf).filter(test(F.col("norm"))).select("doc_id", "ord", "norm")


def table_lines(spark: SparkSession, sf: str) -> DataFrame:
    b = br.line_blocks(spark, sf)
    return roles.with_signs(b.withColumns({"height": F.lit(820.0), "repeated": F.lit(False)})).filter("table").select("doc_id", "ord")


def block_types(spark: SparkSession, sf: str) -> DataFrame:
    b = br.contract_blocks(spark, sf)
    y0 = (F.col("ord") % 40 * 20 + 20).cast("double")
    return b.select("doc_id", "ord", pr.native_type(F.col("norm"), y0, y0 + 16, F.lit(820.0)).alias("block_type"))


def fragment_scores(spark: SparkSession, sf: str) -> DataFrame:
    b = br.line_blocks(spark, sf)
    return b.select("doc_id", "ord", pr.fragment_score(F.col("norm")).alias("fragment_score"))


def date_semantics(spark: SparkSession, sf: str) -> DataFrame:
    o = _dates(spark, sf).withColumn("v", F.expr("CASE o_orderkey % 6 WHEN 0 THEN format_string('%04d-%02d-%02d', y, m, d) WHEN 1 THEN '契約締結日' WHEN 2 THEN '本契約締結日から1年間' WHEN 3 THEN '令和○○年○○月○○日まで' WHEN 4 THEN '1年ごとに自動更新する' ELSE format_string('%d年%d月%d日', y, m, d) END"))
    return o.select("o_orderkey", pr.semantic_type(F.col("v"), "effective").alias("effective"), pr.semantic_type(F.col("v"), "expiration").alias("expiration"))


_FRAG = "CASE WHEN norm = '' THEN true WHEN norm IN ('甲', '乙') OR regexp_matches(norm, '" + ART + r"') THEN false ELSE length(norm) <= 2 OR regexp_matches(norm, '^[\[\]【】()0-9]+$') END"

QUERIES = {
    "text_normalize": text_normalize,
    "digits_normalize": digits_normalize,
    "garbled_ratio": garbled_ratio,
    "compact_text": compact_text,
    "article_number": article_number,
    "jp_date_to_iso": jp_date_to_iso,
    "era_date_to_iso": era_date_to_iso,
    "en_date_to_iso": en_date_to_iso,
    "sentence_split": sentence_split,
    "all_dates": all_dates,
    "bbox_iou": bbox_iou,
    "noise_lines": _flagged(pr.is_noise),
    "page_number_blocks": _on_blocks(pr.is_page_number),
    "annotation_blocks": _on_blocks(pr.is_annotation),
    "fragment_lines": _flagged(pr.is_fragment),
    "sentence_lines": _flagged(roles.sentence),
    "table_lines": table_lines,
    "block_types": block_types,
    "fragment_scores": fragment_scores,
    "date_semantics": date_semantics,
}

SQL = {
    "text_normalize": f"SELECT doc_id, sha256({NORM}) AS norm_sha, length({NORM}) AS n FROM documents",
    "digits_normalize": "SELECT o_orderkey, concat('第', o_orderkey, '号') AS digits, length(concat('第', o_orderkey, '号')) AS n FROM orders",
    "garbled_ratio": "SELECT doc_id, round(CASE WHEN doc_id % 7 = 0 THEN least(1.0, (length(text) - length(replace(text, chr(10), '')) + 1 + 2 + 2) / (length(text) + 4)) ELSE (length(text) - length(replace(text, chr(10), ''))) / greatest(length(text), 1) END, 6) AS ratio FROM documents",
    "compact_text": LINES + r" SELECT doc_id, ord, regexp_replace(norm, '\s+', '', 'g') AS compact, substr(norm, 1, 80) AS snippet FROM n",
    "article_number": "SELECT o_orderkey, CAST(o_orderkey % 399 + 1 AS INT) AS article FROM orders",
    "jp_date_to_iso": _D + " SELECT k AS o_orderkey, " + _ISO_SQL.format(y="y") + " AS iso FROM t",
    "era_date_to_iso": _D + ", u AS (SELECT k, y + 28 AS y, m, d FROM t), v AS (SELECT k, d, m, " + _ISO_SQL.format(y="y") + " AS iso, y FROM u) SELECT k AS o_orderkey, iso, coalesce(iso, concat('令和', y - 2018, '年', m, '月', d + k % 3, '日')) AS kept FROM v",
    "en_date_to_iso": _D + " SELECT k AS o_orderkey, " + _ISO_SQL.format(y="y") + " AS month_first, " + _ISO_SQL.format(y="y") + " AS day_first FROM t",
    "sentence_split": BLOCKS + ", s AS (SELECT doc_id, list_filter(list_transform(string_split(replace(string_agg(text, chr(10) ORDER BY ord), '。', chr(10)), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS s FROM n GROUP BY doc_id) SELECT doc_id, len(s) AS n, s[1] AS first, s[-1] AS last FROM s",
    "all_dates": BLOCKS + ", e AS (SELECT doc_id, y, m, d, k FROM p, (SELECT doc_id FROM n WHERE ord = 10001) WHERE doc_id = k) SELECT doc_id, CASE k % 3 WHEN 1 THEN 0 ELSE 2 END AS n, CASE k % 3 WHEN 0 THEN concat(printf('%04d-%02d-%02d', y, m, d), ',', printf('%04d-%02d-%02d', y + 1, m, 1 + d % 28)) WHEN 1 THEN '' ELSE concat(printf('%04d-%02d-%02d', y, m, d), ',', printf('%04d-%02d-%02d', y + 30, m, 1)) END AS dates FROM e",
    "bbox_iou": LINES + ", g AS (SELECT doc_id, ord, page, 20.0 AS x0, 20 + least(560, length(text) * 7) AS x1 FROM n), h AS (SELECT *, lead(x1) OVER (PARTITION BY doc_id, page ORDER BY ord) AS nx FROM g), i AS (SELECT doc_id, ord, (least(x1, nx) - x0) * 8.0 AS i, (x1 - x0) * 16.0 + (nx - x0) * 16.0 AS a FROM h WHERE nx IS NOT NULL) SELECT doc_id, ord, round(CASE WHEN a - i <= 0 THEN 0.0 ELSE i / (a - i) END, 6) AS iou FROM i",
    "noise_lines": LINES + r" SELECT doc_id, ord, norm FROM n WHERE norm = '' OR regexp_matches(norm, '^[0-9]+$') OR (length(norm) <= 2 AND regexp_matches(norm, '^[^\p{L}\p{N}]+$')) OR regexp_matches(norm, '^[-_=]{3,}$')",
    "page_number_blocks": BLOCKS + r" SELECT doc_id, ord, norm FROM n WHERE norm <> '' AND (regexp_matches(norm, '(?i)^\s*(page\s*)?[0-9]{1,4}\s*(/\s*[0-9]{1,4})?\s*(ページ|頁)?\s*$') OR regexp_matches(norm, '^\s*[IVXLCDM]{1,8}\s*$'))",
    "annotation_blocks": BLOCKS + r" SELECT doc_id, ord, norm FROM n WHERE regexp_matches(norm, '^\s*\[[^\]]{1,20}\]\s*$')",
    "fragment_lines": LINES + f" SELECT doc_id, ord, norm FROM n WHERE {_FRAG}",
    "sentence_lines": LINES + f", h AS (SELECT *, len(regexp_extract_all(norm, '[぀-ゟ]')) AS hira, len(regexp_extract_all(lower(norm), '[a-z]+')) AS words FROM n) SELECT doc_id, ord, norm FROM h WHERE {SENTENCE}",
    "table_lines": LINES + f", h AS (SELECT *, len(regexp_extract_all(norm, '[぀-ゟ]')) AS hira, len(regexp_extract_all(lower(norm), '[a-z]+')) AS words, least(560, length(text) * 7) AS w, list_filter(string_split(norm, ' '), lambda x: x <> '') AS cells FROM n) SELECT doc_id, ord FROM h WHERE contains(norm, '|') OR w >= 240 AND len(cells) >= 3 AND len(list_filter(cells, lambda x: length(x) <= 8)) >= 3 AND NOT {SENTENCE} OR length(norm) >= 8 AND w > 260 AND len(regexp_extract_all(norm, '[0-9,./:%]')) / length(norm) >= 0.45",
    "block_types": BLOCKS + ", g AS (SELECT *, ord % 40 * 20 + 20 AS y0 FROM n) SELECT doc_id, ord, CASE WHEN length(norm) <= 60 AND y0 + 16 <= 82 THEN 'header' WHEN length(norm) <= 60 AND y0 >= 738 THEN 'footer' WHEN contains(norm, '署名') OR contains(norm, '印') THEN 'signature_area' WHEN contains(norm, '別紙') THEN 'appendix' WHEN contains(norm, '|') THEN 'table' ELSE 'text' END AS block_type FROM g",
    "fragment_scores": LINES + f" SELECT doc_id, ord, (length(norm) <= 4)::INT + (length(norm) <= 8)::INT + regexp_matches(norm, '^[^\\p{{L}}]*$')::INT + regexp_matches(norm, '^[0-9\\-/. ]+$')::INT + ({_FRAG})::INT + (NOT regexp_matches(norm, '[。、.,]'))::INT AS fragment_score FROM n",
    "date_semantics": "SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'absolute' WHEN 1 THEN 'anchor' WHEN 2 THEN 'relative_term' WHEN 3 THEN 'placeholder_term' WHEN 4 THEN 'renewable_term' ELSE 'absolute' END AS effective, CASE o_orderkey % 6 WHEN 0 THEN 'absolute' WHEN 1 THEN 'relative_term' WHEN 2 THEN 'relative_term' WHEN 3 THEN 'placeholder_term' WHEN 4 THEN 'renewable_term' ELSE 'absolute' END AS expiration FROM orders",
}
