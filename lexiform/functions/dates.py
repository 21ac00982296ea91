"""Date tokens to ISO strings. A shape that matches decides; a calendar date that does not exist is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English month names.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_MONTH = "|".join(m[:3] + (f"(?:{m[3:]})?" if m[3:] else "") for m in MONTHS)
ISO = r"(\d{4})-(\d{1,2})-(\d{1,2})"
REIWA = r"令和\s*(元|\d{1,2})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日"
SLASHED = r"(\d{4})[/.](\d{1,2})[/.](\d{1,2})"
JAPANESE = r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日"
MONTH_FIRST = rf"(?i)\b({_MONTH})\.?\s+(\d{{1,2}}),?\s+(\d{{4}})\b"
DAY_FIRST = rf"(?i)\b(\d{{1,2}})\s+({_MONTH})\.?,?\s+(\d{{4}})\b"
#: Any absolute date, without groups.
ANY = r"(?:令和\s*(?:元|\d{1,2})\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日|\d{4}\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日|\d{4}[-/.]\d{1,2}[-/.]\d{1,2})"


def _iso(y: Column, m: Column, d: Column) -> Column:
    text = F.format_string("%04d-%02d-%02d", y.try_cast("int"), m.try_cast("int"), d.try_cast("int"))
    return F.try_to_date(text, "yyyy-MM-dd").cast("string")


def _month(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (m[:3].lower(), i)])
    return F.try_element_at(table, F.lower(F.substring(name, 1, 3)))


def _parts(c: Column, pattern: str) -> list[Column]:
    return [F.regexp_extract(c, pattern, k) for k in (1, 2, 3)]


def japanese_date(c: Column) -> Column:
    """Y年M月D日."""
    return F.when(c.rlike(JAPANESE), _iso(*_parts(c, JAPANESE)))


def reiwa_date(c: Column) -> Column:
    y, m, d = _parts(c, REIWA)
    year = F.when(y == "元", F.lit(2019)).otherwise(y.try_cast("int") + 2018)
    return F.when(c.rlike(REIWA), _iso(year, m, d))


def english_date(c: Column) -> Column:
    m1, d1, y1 = _parts(c, MONTH_FIRST)
    d2, m2, y2 = _parts(c, DAY_FIRST)
    return F.when(c.rlike(MONTH_FIRST), _iso(y1, _month(m1), d1)).when(c.rlike(DAY_FIRST), _iso(y2, _month(m2), d2))


def iso_date(c: Column) -> Column:
    """The whole ladder: ISO, Reiwa, slashes or dots, English, Japanese."""
    english = c.rlike(MONTH_FIRST) | c.rlike(DAY_FIRST)
    return F.when(c.rlike(ISO), _iso(*_parts(c, ISO))).when(c.rlike(REIWA), reiwa_date(c)).when(c.rlike(SLASHED), _iso(*_parts(c, SLASHED))).when(english, english_date(c)).otherwise(japanese_date(c))


def kept_date(c: Column) -> Column:
    """Reiwa, then Y年M月D日, then slashes; a token of no such shape stays as it is."""
    return F.coalesce(reiwa_date(c), japanese_date(c), F.when(c.rlike(SLASHED), _iso(*_parts(c, SLASHED))), c)


def all_dates(c: Column) -> Column:
    """ISO strings of all absolute dates in order."""
    return F.filter(F.transform(F.regexp_extract_all(c, F.lit(ANY), F.lit(0)), iso_date), lambda x: x.isNotNull())
