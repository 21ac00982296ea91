"""Roles of text blocks, from signs in their text and from their place on the page.

Signs are columns, each made once from those before it (``with_signs``); a role is then a table of conditions of which the
first that holds decides. Rows need ``norm`` (normalised text), ``bbox``, ``height`` (of the page) and ``repeated`` (whether
the text is a margin that repeats); ``continuation`` needs doc_id and page besides.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import predicates as pr
from lexiform.functions import vocabulary as v


#: So many words are looked for one by one; more are one pattern.
FEW = 4
#: Signs without which a text has no small Latin letters in lower case.
LATIN = "[A-Za-z\u0130\u212a]"


def has(c: Column, words: list[str]) -> Column:
    return pr.any_of(c, words) if len(words) <= FEW else c.rlike(v.alternatives(words))


def _any(conditions: list[Column]) -> Column:
    """Whether one holds; none is asked after one that does."""
    return functools.reduce(lambda a, b: a | b, conditions)


def apart(c: Column) -> Column:
    """The same value by way of a lambda, for one cheap column of a projection with many patterns.

    A projection with a lambda is compiled by itself, in small methods. Others are fused with their neighbours into one method,
    and the JVM only interprets a method of more than 8,000 bytes. What stands in a lambda is interpreted, hence cheap.
    """
    return F.element_at(F.transform(F.array(c), lambda x: x), 1)


def first_of(table: list[tuple[str | None, Column]], otherwise: str | None) -> Column:
    """The name beside the first condition that holds."""
    out = F.when(F.coalesce(table[0][1], F.lit(False)), F.lit(table[0][0]))
    for name, holds in table[1:]:
        out = out.when(F.coalesce(holds, F.lit(False)), F.lit(name))
    return out.otherwise(F.lit(otherwise))


def _count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def _total(conditions: list[tuple[Column, int]]) -> Column:
    return sum((F.when(c, n).otherwise(0) for c, n in conditions), F.lit(0))


def given(cheap: Column, then: Column) -> Column:
    """``cheap & then``, where ``then`` is worked out only if ``cheap`` holds.

    A part that a projection has twice is worked out ahead for every row, also where it stands behind an ``&``; not in a branch.
    """
    return F.when(cheap, then).otherwise(False)


def _english(norm: Column, then) -> Column:
    """``then`` of the text in lower case, asked only of texts that can have small Latin letters."""
    return given(norm.rlike(LATIN), then(F.lower(norm)))


def sentence(norm: Column) -> Column:
    """Long enough, with sentence marks, particles or hiragana, or English words of contracts."""
    n = F.length(norm)
    # what is left of a text without the runs of others: most of its signs match, and a search would stop at each
    hiragana = F.when(n >= 14, F.length(F.regexp_replace(norm, "[^぀-ゟ]+", ""))).otherwise(0)
    particles = _total([(norm.contains(p), 1) for p in v.SENTENCE_PARTICLES])
    words = lambda low: _count(low, "[a-z]+")
    shapes = [
        given(n >= 16, has(norm, v.SENTENCE_MARKS)),
        (n >= 16) & (hiragana >= 5) | (n >= 24) & (hiragana >= 3),
        given((n >= 14) & (hiragana >= 3), particles >= 2),
        _english(norm, lambda low: has(low, v.ENGLISH_MARKS) & (words(low) >= 4) | norm.rlike("[.;]$") & (words(low) >= 6)),
    ]
    return _any(shapes)


def critical(norm: Column) -> Column:
    """A short line that speaks of law, court or date of effect."""
    c = F.regexp_replace(norm, r"\s+", "")
    head, tail, n = F.substring(c, 1, 1), F.substring(c, -1, 1), F.length(c)
    barred = (n == 0) | (n > 36) | head.isin(v.PARTICLES) | (n <= 18) & tail.isin(v.OPEN_ENDS) | pr.is_annotation(c) | pr.is_page_number(c) | has(c, v.CRITICAL_EXCLUDED)
    return given(has(c, v.CRITICAL_JAPANESE) | _english(norm, lambda low: has(low, v.CRITICAL_ENGLISH)), ~barred)


def with_signs(blocks: DataFrame) -> DataFrame:
    """Adds the signs that roles are told by."""
    norm, box, high = F.col("norm"), F.col("bbox"), F.col("height")
    n, width = F.length(norm), box["x1"] - box["x0"]
    symbols, katakana = _count(norm, r"[\[\]{}<>|/\\*#@]"), _count(norm, "[゠-ヿ]")
    ascii_, kana = _count(norm, "[A-Za-z0-9]"), F.length(F.regexp_replace(norm, "[^぀-ヿ一-鿿]+", ""))
    rows = blocks.withColumns({
        "chars": apart(n), "width": width, "symbols": symbols, "kana": kana,
        "ascii_heavy": given(n <= 12, (ascii_ >= F.greatest(F.lit(3), F.floor(n * 0.6))) & (kana <= 2)),
        "ocr_noise": given(n <= 18, (katakana >= 2) & (ascii_ + symbols >= 3)),
        "head": F.substring(norm, 1, 1), "tail": F.substring(norm, -1, 1),
        "heading": pr.is_article_heading(norm), "appendix": pr.matches(norm, v.APPENDIX_HEADING, v.APPENDIX_STEMS), "page_no": pr.is_page_number(norm), "tagged": pr.is_annotation(norm),
        "sentence": sentence(norm), "critical": critical(norm), "legal": has(norm, v.LEGAL),
    })
    points = _total([
        (F.col("head").isin(v.PARTICLES), 2),
        (given(n <= 18, norm.rlike(f"^({v.alternatives(v.CONNECTIVES)})")), 1),
        (given(F.col("tail").isin(v.LOOSE_ENDS), ~has(norm, v.TERMINALS)), 1),
        ((n <= 18) & ~F.col("sentence"), 1),
        (given(n <= 16, ~has(norm, v.PREDICATES)), 1),
        (F.col("symbols") >= 2, 1),
        (F.col("ascii_heavy"), 1),
        (F.col("ocr_noise"), 1),
    ])
    rows = rows.withColumns({"points": points, "heading": apart(F.col("heading"))})
    right = (box["x0"] >= 420) & ~F.col("sentence") & (n > 0)
    margin = lambda share: (box["y1"] <= high * share) | (box["y0"] >= high * (1 - share))
    plain = given(~F.col("sentence") & (n <= 24), ~has(norm, v.CONTRACT_TOKENS))
    worthless = first_of([
        ("yes", n == 0),
        ("no", F.col("heading") | norm.isin("甲", "乙")),
        ("yes", (n <= 10) & (F.col("symbols") >= 2) | F.col("ascii_heavy") | (n <= 8) & (F.col("symbols") >= 1) & (F.col("kana") <= 2) | F.col("ocr_noise")),
        ("no", F.col("legal") & F.col("critical")),
        ("yes", (F.col("points") >= 3) & (n <= 20) | (F.col("points") >= 4) & (n <= 28) & ~F.col("sentence")),
    ], "no") == "yes"
    cells = F.filter(F.split(norm, " "), lambda x: x != "")
    short_cells = F.size(F.filter(cells, lambda x: F.length(x) <= 8))
    table = norm.contains("|") | given(norm.contains(" ") & (width >= 240) & ~F.col("sentence"), (F.size(cells) >= 3) & (short_cells >= 3)) | given((n >= 8) & (width > 260), _count(norm, "[0-9,./:%]") / F.greatest(n, F.lit(1)) >= 0.45)
    return rows.withColumns({
        "margin12": apart(margin(0.12)),
        "note": given(right & (F.col("width") <= 170) & (n <= 24), has(norm, v.NOTE_TOKENS) | norm.rlike(v.NOTE_PREFIX)),
        "side_note": right & (F.col("width") <= 240) & (F.col("repeated") | F.col("critical") & (F.length(F.regexp_replace(norm, r"\s+", "")) <= 24) & ((box["x0"] >= 460) | margin(0.16))),
        "outer": (n > 0) & (F.col("repeated") | F.col("page_no") | plain & ((box["y1"] <= high * 0.06) | (box["y0"] >= high * 0.96))),
        "worthless": worthless, "table": table, "signature": signature(norm, F.col("sentence"), box, high),
    })


def signature(norm: Column, sentence_: Column, box: Column, high: Column) -> Column:
    """Words of signing; in the lowest 28 % of a page also parties, companies and labels in company."""
    n = F.length(norm)
    terms = has(norm, v.SIGNATURE_TERMS) | norm.contains("押印") & (n <= 40)
    party, company, label = has(norm, ["甲", "乙"]), has(norm, v.COMPANIES), has(norm, v.SIGNATURE_LABELS)
    date = norm.contains("年月日") | norm.contains("年") & norm.contains("月") & norm.contains("日") & (n <= 24)
    signs = has(norm, v.SIGNATURE_SIGNS)
    low = (high >= 700) & (box["y0"] >= high * 0.72)
    cues = _total([(x, 1) for x in (party, company, label, date, signs)])
    below = _any([
        terms & (n <= 48) & ~sentence_,
        norm.contains("署名") & (n <= 18) & ~sentence_ & (signs | label),
        party & company & (signs | date) & (n <= 48),
        label & signs & (party | company | date) & (n <= 48),
        (n <= 48) & ~sentence_ & (cues >= 4),
    ])
    barred = sentence_ & (n >= 18) | (n > 72)
    return F.when(barred, False).when(low, given(~(sentence_ & (n >= 14)), below)).otherwise(given((n <= 40) & ~sentence_, terms))


def with_continuation(rows: DataFrame) -> DataFrame:
    """Adds ``continues``: whether a block goes on from or into neighbours on its page that fit it in text and geometry."""
    w = Window.partitionBy("doc_id", "page").orderBy("bbox.y0", "bbox.x0", "ord")
    fit = (F.col("chars") > 0) & ~F.col("repeated") & ~F.col("page_no") & ~F.col("tagged") & ~F.col("note") & ~F.col("outer")
    fit = fit & ~(F.col("signature") & ~F.col("sentence") & ~F.col("critical")) & (F.col("critical") | ~F.col("worthless") & ((F.col("chars") >= 10) | F.col("sentence")))
    shape = (F.col("chars") <= 28) & (F.col("head").isin(v.PARTICLES) | F.col("tail").isin(v.LOOSE_ENDS))
    rows = rows.withColumns({"shape": shape, "beside": F.struct(fit.alias("fit"), F.col("bbox").alias("box"))})
    rows = rows.withColumns({"before_": F.lag("beside").over(w), "after_": F.lead("beside").over(w)})
    box, high = F.col("bbox"), F.col("height")

    def meets(other: Column, gap: Column) -> Column:
        o = other["box"]
        width, wide = F.col("width"), o["x1"] - o["x0"]
        least, most = F.least(width, wide), F.greatest(width, wide, F.lit(1.0))
        shared = F.greatest(F.lit(0.0), F.least(box["x1"], o["x1"]) - F.greatest(box["x0"], o["x0"])) / F.greatest(least, F.lit(1.0))
        tall = F.least(box["y1"] - box["y0"], o["y1"] - o["y0"])
        near = (F.abs(box["x0"] - o["x0"]) <= F.greatest(F.lit(26.0), least * 0.16)) & (least / most >= 0.70) & (shared >= 0.72) & gap.between(-4, F.greatest(F.lit(64.0), tall * 2.8))
        return F.coalesce(other["fit"] & near, F.lit(False))

    told = F.col("critical") | F.col("sentence") | F.col("shape")
    open_ = told & ~(F.col("repeated") & ~F.col("sentence")) & ~F.col("note")
    a, b = meets(F.col("before_"), box["y0"] - F.col("before_.box.y1")), meets(F.col("after_"), F.col("after_.box.y0") - box["y1"])
    edge = (box["y1"] <= high * 0.15) | (box["y0"] >= high * 0.84)
    return rows.withColumn("continues", open_ & (a & b | (a | b) & edge)).drop("beside", "before_", "after_")


def text_role() -> Column:
    """body, annotation, header_footer or signature."""
    norm, n = F.col("norm"), F.col("chars")
    return first_of([
        ("annotation", n == 0),
        ("body", F.col("heading") | F.col("appendix")),
        ("annotation", F.col("tagged") | F.col("note") | F.col("side_note")),
        ("header_footer", F.col("page_no")),
        ("body", F.col("continues")),
        ("annotation", F.col("critical") & F.col("margin12")),
        ("body", F.col("critical") | (n >= 18) & F.col("sentence")),
        ("header_footer", F.col("outer")),
        ("annotation", F.col("worthless")),
        ("signature", F.col("signature")),
        ("annotation", F.col("table")),
        ("annotation", (n <= 8) & ~F.col("sentence") & ~has(norm, ["契約", "条", "甲", "乙", "法", "裁判所"])),
        ("annotation", (n <= 14) & (F.col("symbols") >= 2) & ~has(norm, ["契約", "条", "甲", "乙", "法"])),
        ("annotation", pr.is_fragment(norm) & ~has(norm, ["甲", "乙", *v.COMPANIES, "第", "条"])),
    ], "body")


def block_type() -> Column:
    """text, other, header, footer, signature_area, table or stamp_area. Margins that repeat are not known here."""
    norm, n, box, high = F.col("norm"), F.col("chars"), F.col("bbox"), F.col("height")
    plain = ~F.col("sentence") & (n <= 28)
    return first_of([
        ("other", n == 0),
        ("text", F.col("heading")),
        ("other", F.col("tagged")),
        ("footer", F.col("page_no")),
        ("header", F.col("outer") & (box["y1"] <= high * 0.10)),
        ("footer", F.col("outer")),
        ("other", F.col("note") | F.col("side_note")),
        ("text", F.col("appendix")),
        ("other", F.col("critical") & F.col("margin12") & (F.col("width") <= 260) & (n <= 28)),
        ("text", F.col("critical") | (n >= 18) & F.col("sentence")),
        ("other", F.col("worthless")),
        ("signature_area", F.col("signature")),
        ("table", F.col("table")),
        ("header", plain & (box["y1"] <= high * 0.08)),
        ("footer", plain & (box["y0"] >= high * 0.95)),
        ("signature_area", has(norm, ["記名押印", "署名欄"]) & (n <= 40) & ~F.col("sentence")),
        ("signature_area", norm.contains("署名") & (n <= 18) & (box["y0"] >= high * 0.70) & ~F.col("sentence")),
        ("stamp_area", norm.contains("印")),
    ], "text")


def weak_reason(garbled: Column, searchable: Column, role: Column) -> Column:
    """Why a native block is read again; null where it isn't."""
    weak = (F.col("chars") < 8) | (garbled > 0.20) | ~searchable | pr.is_noise(F.col("norm"))
    return first_of([
        (None, ~weak | role.isin("annotation", "header_footer")),
        ("empty_native_text", F.col("chars") == 0),
        ("garbled_native_text", garbled > 0.20),
        ("weak_signature_text", role == "signature"),
    ], "weak_native_text")


def appendix_like(norm: Column) -> Column:
    return given(pr.any_of(norm, v.APPENDIX_STEMS), norm.rlike(v.APPENDIX_HEADING) | (F.length(norm) <= 24) & has(norm, v.APPENDIX_WORDS))


def candidate_kind() -> Column:
    """What a merge candidate is; needs ``block_type`` besides the signs."""
    norm, n, kind = F.col("norm"), F.col("chars"), F.col("block_type")
    return first_of([
        ("annotation", n == 0),
        ("table", kind == "table"),
        ("signature", kind.isin("signature_area", "stamp_area")),
        ("header_footer", kind.isin("header", "footer")),
        ("appendix", appendix_like(norm)),
        ("body", F.col("heading")),
        ("annotation", F.col("tagged") | F.col("note")),
        ("signature", F.col("signature")),
        ("header_footer", F.col("outer")),
        ("body", F.col("critical")),
        ("table", F.col("table")),
        ("annotation", F.col("worthless")),
        ("annotation", (n <= 8) & ~F.col("sentence") & ~has(norm, ["契約", "条", "甲", "乙", "法", "裁判所"])),
        ("annotation", (n <= 14) & (F.col("symbols") >= 2) & ~has(norm, ["契約", "条", "甲", "乙", "法"])),
        ("annotation", pr.is_fragment(norm) & ~has(norm, ["甲", "乙", *v.COMPANIES, "第", "条"])),
    ], "body")


def merge_section() -> Column:
    """Section of a merge candidate; needs ``block_type`` and ``kind``."""
    norm = F.col("norm")
    return first_of([
        ("signature", F.col("block_type").isin("signature_area", "stamp_area") | (F.col("kind") == "signature")),
        ("main_contract", norm == ""),
        ("signature", pr.matches(norm, v.EXECUTION, ["証", "作成", "電磁的記録", "電子署名"])),
        ("special_provisions", norm.contains("特記事項")),
        ("appendix", appendix_like(norm)),
        ("instruction", pr.matches(norm, v.INSTRUCTION, ["要領", "記載例"])),
        ("form", pr.matches(norm, v.FORM, ["様式", "書", "追加", "任意記載"])),
        ("signature", (F.length(norm) <= 56) & has(norm, ["記名押印", "署名欄", "押印", "住所", "氏名", "代表者"])),
    ], "main_contract")
