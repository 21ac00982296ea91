"""Key fields of a contract: scored candidates from rules, the best of each field, and validation.

Rules are data: a pattern, a base confidence and a reason. A candidate's score is its confidence and bonuses for where it
stands; the best has the highest score, then confidence, then the smaller reason, then the earlier block.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions import dates
from lexiform.functions import predicates as pr

DATE = r"((?:令和\s*(?:元|\d{1,2})|\d{4})\s*年\s*\d{1,2}\s*月\s*\d{1,2}\s*日)"
COURT = r"([\p{IsHan}]{2,4}?(?:地方|簡易|家庭|高等)裁判所)"
#: field, pattern with one group (of the text without blanks; with them if it is in English), confidence, reason.
RULES = [
    ("effective_date", f"{DATE}から", 0.90, "period_start"),
    ("effective_date", f"{DATE}に発効", 0.92, "takes_effect"),
    ("effective_date", "(契約締結日)から", 0.62, "anchor"),
    ("expiration_date", f"{DATE}まで(?:とする|有効)", 0.90, "period_end"),
    ("expiration_date", f"{DATE}に終了", 0.92, "ends"),
    ("governing_law", "準拠法は([^。]{1,12}?法)と", 0.93, "named_law"),
    ("governing_law", "(日本)国の法令に準拠", 0.88, "law_of_country"),
    ("governing_law", r"(?i)governed by(?: and construed in accordance with)? the laws of (?:the )?([A-Za-z]{2,40}(?: [A-Z][a-z]{1,40})?)", 0.90, "english_law"),
    ("jurisdiction", f"、{COURT}を(?:第一審の)?(?:専属的)?(?:合意)?管轄裁判所", 0.92, "agreed_court"),
    ("party_a", "^(.{2,40}?)[(（]以下「甲」", 0.90, "role_declared"),
    ("party_b", "[)）]と(.{2,40}?)[(（]以下「乙」", 0.90, "role_declared"),
]
DATES = ("effective_date", "expiration_date")
#: Words of which every match of a rule has one, by reason: texts without them are not matched.
WORDS = {"period_start": "日から", "takes_effect": "に発効", "anchor": "契約締結日", "period_end": "日まで", "ends": "に終了", "named_law": "準拠法は", "law_of_country": "国の法令に準拠", "english_law": " ", "agreed_court": "管轄裁判所", "role_declared": "以下「"}
#: title words, contract type, score.
TYPES = [("業務委託", "SERVICE", 1.05), ("秘密保持", "NDA", 1.05), ("ライセンス", "LICENSE", 1.0), ("売買", "SALES", 0.85)]


def tail_share(blocks: DataFrame) -> DataFrame:
    """Adds rank and n: a block's place among those of its document. Blocks that come with both keep them."""
    if {"rank", "n"} <= set(blocks.columns):
        return blocks
    w = Window.partitionBy("doc_id")
    return blocks.withColumn("rank", F.row_number().over(w.orderBy("ord"))).withColumn("n", F.count(F.lit(1)).over(w))


def candidates(blocks: DataFrame, only: str | None = None) -> DataFrame:
    """doc_id, field, value, confidence, score, reason, block_id, ord; of the field ``only``, or of all. One pass over the blocks:
    every rule is a column."""
    made, told = [], []
    for field, pattern, confidence, reason in RULES:
        if only not in (None, field):
            continue
        text = F.col("norm" if pattern.startswith("(?i)") else "compact")
        told.append(text.contains(WORDS[reason]))
        raw = F.when(told[-1], F.regexp_extract(text, pattern, 1))
        made.append(F.struct(F.lit(field).alias("field"), raw.alias("raw"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason")))
    rows = tail_share(blocks).filter(functools.reduce(operator.or_, told))
    found = rows.withColumn("c", F.explode(F.filter(F.array(*made), lambda x: x["raw"] != "")))
    # made of what was generated, so that no pattern is matched again wherever its group is looked at
    raw, field = F.col("c.raw"), F.col("c.field")
    law = F.when(F.lower(raw).isin("日本", "japan"), "日本法").when(F.col("c.reason") == "english_law", F.concat(raw, F.lit(" law"))).otherwise(raw)
    # DATE has no other shapes than these two
    value = F.when(field.isin(*DATES), F.coalesce(dates.reiwa_date(raw), dates.japanese_date(raw), raw)).when(field == "governing_law", law).otherwise(raw)
    bonus = F.when((F.col("rank") >= 0.7 * F.col("n")) & F.col("c.field").isin("governing_law", "jurisdiction"), 0.12).otherwise(0.0) - F.when(F.col("c.reason") == "anchor", 0.10).otherwise(0.0)
    return found.select("doc_id", field.alias("field"), value.alias("value"), "c.confidence", "c.reason", F.round(F.col("c.confidence") + bonus, 6).alias("score"), "block_id", "ord")


def best(found: DataFrame) -> DataFrame:
    """The best candidate of each document and field."""
    w = Window.partitionBy("doc_id", "field").orderBy(F.desc("score"), F.desc("confidence"), "reason", "ord")
    return found.withColumn("turn", F.row_number().over(w)).filter("turn = 1").drop("turn")


def validate(found: DataFrame) -> DataFrame:
    """Adds accepted, why and semantic: what each field's value must look like."""
    v, field = F.col("value"), F.col("field")
    semantic = F.when(field == "effective_date", pr.semantic_type(v, "effective")).when(field == "expiration_date", pr.semantic_type(v, "expiration"))
    why = (
        F.when((field == "jurisdiction") & ~v.rlike("(地方|簡易|家庭|高等)裁判所$"), "generic_court")
        .when((field == "governing_law") & ((F.length(v) < 2) | v.isin("準拠", "適用法")), "no_law_named")
        .when(field.startswith("party") & ~v.rlike("(株式会社|合同会社|有限会社|法人)."), "entity_type_only")
        .when((field == "expiration_date") & v.rlike("0年間"), "zero_length_effective_period")
    )
    return found.withColumn("semantic", semantic).withColumn("why", why).withColumn("accepted", why.isNull()).withColumn("anchor_only", (field == "effective_date") & (semantic == "anchor"))


def relative_courts(blocks: DataFrame) -> DataFrame:
    """Documents whose court is only described by a place: never a value, always a flag."""
    hit = F.regexp_extract("compact", "([甲乙].{0,6}所在地を管轄する裁判所)", 1)
    return blocks.withColumn("expression", F.nullif(hit, F.lit(""))).filter("expression is not null").groupBy("doc_id").agg(F.min_by("expression", "ord").alias("expression"))


def renewal(blocks: DataFrame) -> DataFrame:
    """The first block that speaks of renewal decides; a refusal in it goes first."""
    c = F.col("compact")
    said = F.when(c.rlike("自動更新しない|更新しない"), False).when(c.contains("自動更新") | c.contains("同一条件で更新"), True)
    return blocks.withColumn("auto_renewal", said).filter("auto_renewal is not null").groupBy("doc_id").agg(F.min_by("auto_renewal", "ord").alias("auto_renewal"), F.min("ord").alias("ord"))


def notice(blocks: DataFrame) -> DataFrame:
    """Notice period as it is written, from the first block that has one."""
    c = F.nullif(F.regexp_extract("compact", "(\\d+(?:か月|ヶ月|日|年))前までに", 1), F.lit(""))
    return blocks.withColumn("notice_period", c).filter("notice_period is not null").groupBy("doc_id").agg(F.min_by("notice_period", "ord").alias("notice_period"))


def contract_type(blocks: DataFrame, first: int = 40) -> DataFrame:
    """doc_id, contract_type, score, confidence: word scores over the first blocks; the earlier rule wins a tie."""
    head = tail_share(blocks).filter(F.col("rank") <= first)
    sums = head.groupBy("doc_id").agg(*[F.sum(F.when(F.col("compact").contains(w), s).otherwise(0.0)).alias(t) for w, t, s in TYPES])
    scored = F.array(*[F.struct(F.round(F.col(t), 6).alias("score"), F.lit(-i).alias("turn"), F.lit(t).alias("type")) for i, (_, t, _) in enumerate(TYPES)])
    top = F.array_max(scored)
    rows = sums.withColumn("top", top)
    known = F.col("top.score") > 0
    return rows.select("doc_id", F.when(known, F.col("top.type")).otherwise("UNKNOWN").alias("contract_type"), F.col("top.score").alias("score"), F.when(known, F.round(F.least(F.lit(0.96), 0.68 + 0.14 * F.least(F.col("top.score"), F.lit(2.0))), 2)).otherwise(0.0).alias("confidence"))


def wide(found: DataFrame) -> DataFrame:
    """A row for each document with its accepted values."""
    fields = sorted({r[0] for r in RULES})
    return found.filter("accepted").groupBy("doc_id").pivot("field", fields).agg(F.first("value"))


#: Field, code of its issue when it is missing.
WANTED = [("effective_date", "MISSING_EFFECTIVE_DATE"), ("expiration_date", "MISSING_EXPIRATION_DATE"), ("governing_law", "MISSING_GOVERNING_LAW"), ("jurisdiction", "MISSING_JURISDICTION")]


def issues(documents: DataFrame, found: DataFrame) -> DataFrame:
    """doc_id, severity, reason_code, field, block_id: missing, rejected, anchor-only and low-confidence fields as rows.

    ``found`` is read once: a document has few fields, so its issues are made from one array of them.
    """
    have = found.groupBy("doc_id").agg(F.collect_list(F.struct("field", "block_id", "confidence", "accepted", "anchor_only")).alias("f"))
    rows = documents.select("doc_id").join(have, "doc_id", "left").withColumn("f", F.coalesce("f", F.expr("array()").cast(have.schema["f"].dataType)))
    issue = lambda severity, code, field, block: F.struct(F.lit(severity).alias("severity"), code.alias("reason_code"), field.alias("field"), block.alias("block_id"))
    f = F.col("f")
    is_field = lambda name: lambda x: x.accepted & (x.field == name)
    missing = [F.when(~F.exists(f, is_field(name)), issue("review", F.lit(code), F.lit(name), F.lit(None).cast("string"))) for name, code in WANTED]
    of = lambda keep, severity, code: F.transform(F.filter(f, keep), lambda x: issue(severity, code(x), x.field, x.block_id))
    made = F.concat(
        F.filter(F.array(*missing), lambda x: x.isNotNull()),
        of(lambda x: x.anchor_only, "review", lambda x: F.lit("ANCHOR_ONLY_EFFECTIVE_DATE")),
        of(lambda x: x.confidence < 0.65, "review", lambda x: F.lit("LOW_CONFIDENCE")),
        of(lambda x: ~x.accepted, "recoverable", lambda x: F.concat(F.lit("LOW_QUALITY_"), F.upper(x.field))),
    )
    return rows.select("doc_id", F.explode(made).alias("i")).select("doc_id", "i.*")


def title(blocks: DataFrame) -> DataFrame:
    """doc_id, title, score: the best line of the first two pages; the earlier wins a tie."""
    n, c = F.length("norm"), F.col("norm")
    score = F.when(c.rlike("契約書$|覚書$|合意書$"), 1.0).otherwise(0.0) + F.when(n.between(4, 30), 0.3).otherwise(0.0) - F.when(c.contains("。"), 0.5).otherwise(0.0) - F.when(pr.is_article_heading(c), 0.6).otherwise(0.0)
    rows = blocks.filter("page <= 2").withColumn("score", F.round(score, 6))
    return rows.groupBy("doc_id").agg(F.max_by("norm", F.struct("score", -F.col("ord"))).alias("title"), F.max("score").alias("score"))
