"""Row classifiers over normalised text (NFKC, single blanks) as boolean or string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexiform.functions.text import NUMERAL

ARTICLE = f"^\\s*第[{NUMERAL}]+\\s*条"
#: Marks of commentary.
COMMENTARY = ["コメントの追加", "コメント", "解説編", "解説", "ひな形", "記入例", "オプション条項"]
#: The same without those that have another one in them.
STEMS = [w for w in COMMENTARY if not any(x in w for x in COMMENTARY if x != w)]
SIGNATURE = ["記名押印", "署名", "捺印", "印"]
APPENDIX = ["別紙", "別表", "附則"]


def any_of(c: Column, words: list[str]) -> Column:
    out = c.contains(words[0])
    for w in words[1:]:
        out = out | c.contains(w)
    return out


def matches(c: Column, pattern: str, words: list[str]) -> Column:
    """``c.rlike(pattern)``, asked only of texts with one of ``words``, of which every match must have one.

    Looking for a word compares bytes where they lie; a pattern needs the text as a string first.
    """
    return any_of(c, words) & c.rlike(pattern)


def is_noise(norm: Column) -> Column:
    return (norm == "") | norm.rlike("^[0-9]+$") | ((F.length(norm) <= 2) & norm.rlike(r"^[^\p{L}\p{N}]+$")) | norm.rlike("^[-_=]{3,}$")


def is_article_heading(norm: Column) -> Column:
    return matches(norm, ARTICLE, ["条"])


def is_page_number(norm: Column) -> Column:
    # no article heading is written like this, so it need not be asked for
    return (norm != "") & norm.rlike(r"^\s*(?:(?i:page\s*)?[0-9]{1,4}\s*(?:/\s*[0-9]{1,4})?\s*(?:ページ|頁)?|[IVXLCDM]{1,8})\s*$")


def is_annotation(norm: Column) -> Column:
    strong = matches(norm, r"^\s*\[[^\]]{1,20}\]\s*$", ["]"]) | matches(norm, r"^\s*0{2,4}年\s*0{1,2}月\s*0{1,2}日\s*$", ["00年"]) | matches(norm, r"^\s*\(\s*(住所|代表者名)\s*\)\s*$", ["住所", "代表者名"]) | any_of(norm, STEMS)
    weak = any_of(norm, ["適宜", "参照"]) & (F.length(norm) <= 20)
    return (norm != "") & (strong | weak) & ~is_article_heading(norm)


def is_fragment(norm: Column) -> Column:
    return F.when(norm == "", True).when(norm.isin("甲", "乙") | is_article_heading(norm), False).otherwise((F.length(norm) <= 2) | norm.rlike(r"^[\[\]【】()0-9]+$"))


def native_type(norm: Column, y0: Column, y1: Column, height: Column) -> Column:
    """header and footer in the outer tenths (60 characters at most), then signature, appendix and table."""
    short = F.length(norm) <= 60
    return F.when(short & (y1 <= height * 0.1), "header").when(short & (y0 >= height * 0.9), "footer").when(any_of(norm, SIGNATURE), "signature_area").when(any_of(norm, APPENDIX), "appendix").when(norm.contains("|"), "table").otherwise("text")


def page_kind(chars: Column, coverage: Column, garbled: Column, weak: Column) -> Column:
    return F.when((chars == 0) & (coverage >= 0.15), "scanned").when((chars < 25) & (coverage >= 0.35), "scanned").when((chars >= 50) & (garbled <= 0.20) & (weak <= 0.20), "text-native").otherwise("hybrid")


def is_weak(chars: Column, garbled: Column, searchable: Column) -> Column:
    return (chars < 8) | (garbled > 0.20) | ~searchable


def fragment_score(norm: Column) -> Column:
    """Signs of little value, added up."""
    n = F.length(norm)
    signs = [n <= 4, n <= 8, norm.rlike(r"^[^\p{L}]*$"), norm.rlike(r"^[0-9\-/. ]+$"), is_fragment(norm), ~norm.rlike(r"[。、.,]")]
    return sum((F.coalesce(s, F.lit(False)).cast("int") for s in signs), F.lit(0))


def semantic_type(value: Column, field: str) -> Column:
    """What a date value says: expiration looks for renewal first, effective for an absolute date."""
    absolute = value.rlike(r"^\d{4}-\d{2}-\d{2}$")
    written = value.rlike(r"\d{4}年\d{1,2}月\d{1,2}日")
    anchor = value.rlike("(締結|契約)日|execution date|signing date")
    relative = value.rlike(r"から\s*\d+\s*(年|か月|ヶ月|月|日)|\d+\s*(年|か月|ヶ月)間")
    holder = value.rlike(r"[○◯〇□]{1,}\s*年|年\s+月\s+日|[○◯□]{2,}")
    renewal = value.rlike("更新")
    if field == "expiration":
        return F.when(renewal, "renewable_term").when(absolute, "absolute").when(holder, "placeholder_term").when(relative, "relative_term").when(written, "absolute").otherwise("relative_term")
    return F.when(absolute, "absolute").when(relative, "relative_term").when(anchor, "anchor").when(holder, "placeholder_term").when(renewal, "renewable_term").when(written, "absolute").otherwise("relative_term")
