"""Kind of contract, what it adds to the confidence of its fields, candidates from a contract's last part, and when they take
the place of what was found before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import dates
from lexiform.functions.roles import has
from lexiform.operators.fields import tail_share

#: Route, words of its texts, score of a text with one, words of a hint, score of the hint.
ROUTES = [
    ("LICENSE_OR_ITAKU", ["委託", "使用許諾", "利用許諾", "ライセンス", "許諾"], 0.85, ["許諾", "ライセンス", "委託"], 1.0),
    ("NDA", ["秘密保持", "秘密情報", "開示", "目的外利用", "守秘義務"], 1.05, ["秘密保持", "NDA"], 1.6),
    ("SERVICE", ["業務委託", "成果物", "検収", "再委託", "委託業務"], 1.0, ["業務委託", "準委任"], 1.2),
]
LEAST = 1.2
#: Route, fields whose replacement it eases by 0.03.
BIASED = {
    "NDA": ["governing_law", "jurisdiction", "expiration_date", "effective_date"],
    "SERVICE": ["effective_date", "expiration_date", "counterparties", "governing_law"],
    "LICENSE_OR_ITAKU": ["counterparties", "jurisdiction", "expiration_date", "governing_law", "effective_date"],
}
#: Route, bonus, fields whose candidates from the last part it makes surer.
BONUS = {"NDA": (0.03, ["governing_law", "jurisdiction", "expiration_date"]), "SERVICE": (0.02, ["effective_date", "expiration_date", "jurisdiction"]), "LICENSE_OR_ITAKU": (0.02, ["expiration_date", "jurisdiction", "effective_date"])}
COURT = "([一-龥々A-Za-z0-9○◯]{1,12}(?:地方|簡易|家庭|高等)裁判所)"
ANY_COURT = "([一-龥々A-Za-z0-9○◯]{2,12}裁判所)"
GENERIC = ["裁判所", "地方裁判所", "簡易裁判所", "家庭裁判所", "高等裁判所"]
NOT_A_COURT = ["管轄", "専属", "第一審", "訴え", "紛争", "は", "を", "とする"]
#: Field, words and points; words in English likewise.
DATE_WORDS = {
    "effective_date": (["効力発生日", "発効日", "契約締結日", "契約締結の日", "締結日"], ["effectivedate", "executiondate", "datedasof"]),
    "expiration_date": (["有効期間", "契約期間", "満了日", "終了日", "まで", "満了", "終了"], ["expiration", "termination", "until"]),
}


def contract_routes(blocks: DataFrame, hints: DataFrame | None = None, first: int = 40) -> DataFrame:
    """(doc_id, route, score): points for each of the first blocks with a route's words, and for the hint (doc_id, hint).

    Below the least score the route is UNKNOWN; of equals the first by name counts."""
    head = tail_share(blocks).filter(F.col("rank") <= first).withColumn("c", F.replace("norm", F.lit(" "), F.lit("")))
    sums = head.groupBy("doc_id").agg(*[F.sum(F.when(has(F.col("c"), words), points).otherwise(0.0)).alias(name) for name, words, points, _, _ in ROUTES])
    rows = sums.join(hints.select("doc_id", F.replace("hint", F.lit(" "), F.lit("")).alias("hint")), "doc_id", "left") if hints is not None else sums.withColumn("hint", F.lit(None).cast("string"))
    least = F.array_min(F.array(*[F.struct((-F.round(F.col(name) + F.when(has(F.coalesce("hint", F.lit("")), words), points).otherwise(0.0), 6)).alias("less"), F.lit(name).alias("route")) for name, _, _, words, points in ROUTES]))
    return rows.withColumn("best", least).select("doc_id", F.when(F.col("best.less") <= -LEAST, F.col("best.route")).otherwise("UNKNOWN").alias("route"), (-F.col("best.less")).alias("score"))


def field_bias(route: Column, field: Column) -> Column:
    out = F.lit(0.0)
    for name, fields in BIASED.items():
        out = F.when((route == name) & field.isin(fields), 0.03).otherwise(out)
    return out


def replacement_margin(route: Column, field: Column) -> Column:
    return F.greatest(F.lit(0.04), 0.08 - field_bias(route, field))


def tail_bonus(route: Column, field: Column) -> Column:
    out = F.lit(0.0)
    for name, (points, fields) in BONUS.items():
        out = F.when((route == name) & field.isin(fields), points).otherwise(out)
    return out


def law_confidence(text: Column, route: Column) -> Column:
    marks = [(has(text, ["準拠法", "適用法"]), 0.04), (has(text, ["日本法", "日本国法"]), 0.03), (text.contains("成立") & text.contains("効力") & text.contains("解釈"), 0.03)]
    return F.round(F.least(F.lit(0.96), 0.80 + tail_bonus(route, F.lit("governing_law")) + sum((F.when(c, p).otherwise(0.0) for c, p in marks), F.lit(0.0))), 6)


def law_name(text: Column) -> Column:
    """日本法 for Japan's; English "laws of X" as "X law"; words for law alone name none."""
    english = F.regexp_extract(text, "(?i)laws? of (?:the )?(?:State of )?([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)?)", 1)
    return F.when(has(text, ["日本法", "日本国法"]) | (F.lower(english) == "japan"), "日本法").when(english != "", F.concat(english, F.lit(" law"))).when(text.isin("法", "準拠法", "適用法"), None).otherwise(text)


def specific_court(text: Column) -> Column:
    """The last court of a kind, else the last that is no generic one; null if none is named."""
    kinds = F.regexp_extract_all(text, F.lit(COURT), F.lit(1))
    others = F.filter(F.regexp_extract_all(text, F.lit(ANY_COURT), F.lit(1)), lambda x: ~x.isin(GENERIC) & ~has(x, NOT_A_COURT))
    return F.when(F.size(kinds) > 0, F.element_at(kinds, -1)).when(F.size(others) > 0, F.element_at(others, -1))


def date_role(field: str, sentence: Column, value: Column) -> Column:
    """Points for a date of a sentence as a field's value: words, and its place among the sentence's dates."""
    c = F.regexp_replace(sentence, r"\s+", "")
    japanese, english = DATE_WORDS[field]
    every = dates.all_dates(sentence)
    some, many = F.size(every) > 0, F.size(every) >= 2
    first, last = some & (F.try_element_at(every, F.lit(1)) == value), some & (F.try_element_at(every, F.lit(-1)) == value)
    since, until = has(c, ["から", "より"]), c.contains("まで")
    near, far = (first, last) if field == "effective_date" else (last, first)
    opened, closed = (since, until) if field == "effective_date" else (until, since)
    marks = [(has(c, japanese), 0.16), (has(F.lower(c), english), 0.12), (many & near, 0.24), (many & far, -0.16), (opened & near, 0.10), (closed & far, -0.12)]
    return F.round(sum((F.when(F.coalesce(h, F.lit(False)), p).otherwise(0.0) for h, p in marks), F.lit(0.0)), 6)


def with_tail(blocks: DataFrame) -> DataFrame:
    """Adds ``in_tail``: whether a block is of a document's last part: three tenths, ten at least, and its last two pages."""
    rows = tail_share(blocks).withColumn("last_page", F.max("page").over(Window.partitionBy("doc_id")))
    return rows.withColumn("in_tail", (F.col("rank") > F.least(F.floor(F.col("n") * 0.7), F.greatest(F.lit(0), F.col("n") - 10))) | (F.col("page") >= F.col("last_page") - 1))


def tail(blocks: DataFrame) -> DataFrame:
    """Blocks of a document's last part."""
    return with_tail(blocks).filter("in_tail").drop("in_tail")


def tail_candidates(blocks: DataFrame, routes: DataFrame) -> DataFrame:
    """(doc_id, field, value, confidence, page, block_id): laws and courts that the last part names, each value once, by
    confidence, page and block."""
    rows = tail(blocks).join(routes.select("doc_id", "route"), "doc_id")
    norm, route = F.col("norm"), F.col("route")
    law = F.when(has(norm, ["準拠法", "適用法", "日本法", "日本国法"]) & has(norm, ["日本法", "日本国法"]), F.struct(F.lit("governing_law").alias("field"), law_name(norm).alias("value"), law_confidence(norm, route).alias("confidence")))
    agreed = norm.contains("専属") & norm.contains("合意")
    court = specific_court(norm)
    sure = F.round(0.84 + F.when(agreed, 0.04).otherwise(0.0) + tail_bonus(route, F.lit("jurisdiction")), 6)
    place = F.when(norm.contains("管轄") & court.isNotNull(), F.struct(F.lit("jurisdiction").alias("field"), court.alias("value"), sure.alias("confidence")))
    found = rows.select("doc_id", "page", "block_id", F.explode(F.filter(F.array(law, place), lambda x: x.isNotNull())).alias("c")).select("doc_id", "page", "block_id", "c.*")
    w = Window.partitionBy("doc_id", "field", "value").orderBy(F.desc("confidence"), "page", "block_id")
    return found.withColumn("turn_", F.row_number().over(w)).filter("turn_ = 1").select("doc_id", "field", "value", "confidence", "page", "block_id")


def supplemented(rows: DataFrame) -> DataFrame:
    """Adds replace and the resulting value: whether a candidate takes the place of the current value of a field.

    Needs value, confidence, accepted, anchor, flagged (of the current value) and the same with new_ of the best candidate
    that was accepted (null: none), and route and field. It does where nothing acceptable was found, where an anchor meets a
    date, a flagged value a clean one, or a confidence one that is larger by more than the route's margin.
    """
    margin = replacement_margin(F.col("route"), F.col("field"))
    better = F.coalesce("confidence", F.lit(0.0)) + margin < F.coalesce("new_confidence", F.lit(0.0))
    wins = ~F.col("accepted") | F.col("value").isNull() | F.col("anchor") & ~F.col("new_anchor") | F.col("flagged") & ~F.col("new_flagged") | better
    replace = F.coalesce(F.col("new_value").isNotNull() & wins, F.lit(False))
    return rows.withColumn("replace", replace).withColumn("result", F.when(replace, F.col("new_value")).otherwise(F.col("value")))
