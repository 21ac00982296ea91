"""Text functions as columns. Each takes and gives columns; nothing here needs Python at run time but :func:`nfkc`."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

FULL_DIGITS, DIGITS = "０１２３４５６７８９", "0123456789"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"
#: Kanji digits and multipliers.
KANJI_DIGITS = {"〇": 0, "零": 0, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
KANJI_TENS = {"十": 10, "百": 100, "千": 1000}
NUMERAL = "0-9０-９一二三四五六七八九十百千〇零"


def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def nfkc(c: Column) -> Column:
    """NFKC, which the engine has no function for: applied once, when text comes in."""
    return F.pandas_udf(_nfkc, "string")(c)


def normalize_digits(c: Column) -> Column:
    return F.translate(c, FULL_DIGITS, DIGITS)


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, CONTROL, "")


def normalize_whitespace(c: Column) -> Column:
    """Control characters go; runs of white space, the ideographic space included, become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(strip_control(c), r"(?U)[\s　]+", " "))


def normalize_text(c: Column) -> Column:
    return normalize_whitespace(nfkc(c))


def compact(norm: Column) -> Column:
    return F.regexp_replace(norm, r"(?U)\s+", "")


def garbled_ratio(c: Column) -> Column:
    """Replacement and control characters over the length, at most 1; controls count twice, tab and line ends once."""
    bad = F.regexp_count(c, F.lit("�")) + F.regexp_count(c, F.lit(CONTROL)) + F.regexp_count(c, F.lit(r"[\x00-\x1F\x7F]"))
    return F.when(F.length(c) == 0, 0.0).otherwise(F.least(F.lit(1.0), bad / F.greatest(F.length(c), F.lit(1))))


def kanji_number(token: Column) -> Column:
    """Value of a kanji numeral; a digit replaces the digit before it, as positions have no meaning here."""
    digits = F.create_map(*[F.lit(x) for kv in KANJI_DIGITS.items() for x in kv])
    tens = F.create_map(*[F.lit(x) for kv in KANJI_TENS.items() for x in kv])
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("now"), F.lit(True).alias("ok"))

    def step(acc: Column, ch: Column) -> Column:
        d, m = F.try_element_at(digits, ch), F.try_element_at(tens, ch)
        total = F.when(m.isNotNull(), acc.total + F.greatest(acc.now, F.lit(1)) * m).otherwise(acc.total)
        now = F.when(d.isNotNull(), d).when(m.isNotNull(), F.lit(0)).otherwise(acc.now)
        return F.struct(total.alias("total"), now.alias("now"), (acc.ok & (d.isNotNull() | m.isNotNull())).alias("ok"))

    end = lambda acc: F.when(acc.ok, acc.total + acc.now)
    return F.when(F.length(token) > 0, F.aggregate(F.split(token, ""), start, step, end))


def article_number(c: Column) -> Column:
    """Number in 第N条, in digits or kanji; null without one."""
    token = normalize_digits(F.regexp_extract(c, f"第([{NUMERAL}]+)条", 1))
    return F.when(token.rlike("^[0-9]+$"), token.try_cast("int")).otherwise(kanji_number(F.nullif(token, F.lit(""))))


def sentences(c: Column, norm=normalize_whitespace) -> Column:
    """Parts between 。 and line ends, normalised, without empty ones; the whole if nothing is left."""
    parts = F.filter(F.transform(F.split(c, "[。\n]"), norm), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(norm(c)))


def snippet(c: Column, size: int) -> Column:
    return F.substring(c, 1, size)
