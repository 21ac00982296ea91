"""Names of parties: their forms, who may be one, and the two parties of a contract from declarations and signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.functions.predicates import any_of, matches
from lexiform.functions.roles import has
from lexiform.functions.vocabulary import alternatives
from lexiform.operators.segment import once

#: Kinds of entities, what names them, and words that no name has.
TYPES_ALONE = ["株式会社", "合同会社", "有限会社", "公立大学法人", "国立大学法人", "独立行政法人"]
ENTITY = ["株式会社", "合同会社", "有限会社", "法人", "大学", "研究所", "機構", "協会", "組合", "銀行"]
ENTITY_PATTERNS = [
    "([^\\s、。]{2,50}(?:株式会社|合同会社|有限会社))",
    "((?:公立大学法人|国立大学法人|学校法人)[^\\s、。]{1,30})",
    "((?:一般社団法人|一般財団法人|公益社団法人|公益財団法人|医療法人|社会福祉法人)[^\\s、。]{1,20})",
    "([^\\s、。]{2,40}(?:研究所|機構|協会))",
]
NOT_A_PARTY = ["締結", "契約", "以下", "第", "条", "という", "とする"]
NOT_A_CANDIDATE = ["という。", "コメント", "解説", "参照", "本契約", "締結する", "業務委託", "契約書", "大学案内", "作成", "仕様書", "別紙", "の間", "協議", "紛争", "管轄", "条", "項", "号", "規程", "規定", "ものとする", "次の各", "各号"]
CUT_AT = ["規程", "規定", "協議", "紛争", "管轄", "条", "項", "号", "契約", "予算", "決算", "事務"]
SIGNATURE_HINTS = ["記名押印", "署名", "住 所", "住所", "氏名", "代表者", "委託者", "受託者"]
ROLES = {"甲": ["甲", "委託者", "ライセンサー"], "乙": ["乙", "受託者", "ライセンシー"]}
FORMAL = "^(株式会社|合同会社|有限会社|一般社団法人|一般財団法人|公益社団法人|公益財団法人|国立大学法人|公立大学法人|独立行政法人|学校法人|医療法人|社会福祉法人)"
PLACEHOLDER = "^[□■◻◼○◯〇]+$"
EDGES = " 、。,:;()\\[\\]【】"
#: Pattern with the name, role before or after it, score.
DECLARED = [("([^\\n]{2,140}?)\\s*[(]?以下\\s*[「『]?(甲|乙)", "name_first", 1.00), ("(甲|乙)\\s*:\\s*([^\\n]{2,140})", "role_first", 0.90), ("([^\\n]{2,140}?)\\s*を\\s*(甲|乙)\\s*とし", "name_first", 0.80)]

#: A word that every match of the pattern has.
DECLARED_BY = ["以下", ":", "とし"]


def _strip(c: Column, signs: str = EDGES) -> Column:
    return F.regexp_replace(c, f"^[{signs}]+|[{signs}]+$", "")


def balanced(c: Column) -> Column:
    """Without brackets where they don't pair."""
    return F.when(F.regexp_count(c, F.lit("[(]")) != F.regexp_count(c, F.lit("[)]")), F.trim(F.translate(c, "()", ""))).otherwise(c)


def party_name(c: Column) -> Column:
    """A party's name as it is declared: no alias, short forms written out, no particles or signs at its ends."""
    for pattern, to in (("以下\\s*[「『]?[甲乙].*$", ""), ("という。?[)]?\\s*(と、?)?\\s*$", ""), ("[(]\\s*株\\s*[)]", "株式会社"), ("[(]\\s*同\\s*[)]", "合同会社"), ("^[、,。\\s]+", ""), ("\\s+", " ")):
        c = F.regexp_replace(c, pattern, to)
    c = _strip(_strip(c, " :、,。;"), " ")
    c = F.regexp_replace(_strip(F.regexp_replace(c, "(御中|様)$", ""), " "), "[と、のはにを]+$", "")
    return once(c, balanced)


def is_placeholder(name: Column) -> Column:
    return (F.length(name) >= 2) & F.regexp_replace(name, "\\s+", "").rlike(PLACEHOLDER)


def is_party(name: Column) -> Column:
    return (F.length(name) >= 2) & ~name.isin("甲", "乙", "当事者", *TYPES_ALONE) & ~name.rlike("(と|と、|の|は|に|を|で)$") & ~name.rlike("^[0-9]+$") & ~has(name, NOT_A_PARTY)


def _all(c: Column, pattern: str, group: int, words: list[str] | None = None) -> Column:
    """A group of all matches; with ``words``, of which every match has one, texts without them are not matched."""
    found = F.regexp_extract_all(c, F.lit(pattern), F.lit(group))
    return F.when(any_of(c, words), found).otherwise(F.array().cast("array<string>")) if words else found


def entities(c: Column) -> Column:
    """Names of companies and corporations in a text, in the order of their patterns."""
    return F.array_distinct(F.concat(*[_all(c, p, 1, [w]) for p, w in zip(ENTITY_PATTERNS[:3], ("会社", "法人", "法人"), strict=True)]))


def last_entity(c: Column) -> Column:
    found = F.concat(*[F.regexp_extract_all(c, F.lit(p), F.lit(1)) for p in ENTITY_PATTERNS])
    return once(found, lambda every: F.when(F.size(every) > 0, _strip(F.element_at(every, -1))))


def finder_name(c: Column) -> Column:
    """A name in a line of a preamble or signature: the last entity, or what stands before words that end a name."""
    c = F.regexp_replace(F.regexp_replace(c, "以下\\s*[「『]?[甲乙].*$", ""), "^(委託者|受託者|甲|乙)\\s*:?", "")
    c = F.regexp_replace(F.regexp_replace(c, "^(と|及び|または|又は)\\s*[、,]?\\s*", ""), "^.*?氏\\s*名", "")
    return once(c, _named)


def _named(c: Column) -> Column:
    cut = F.regexp_replace(c, f"(との間|の間に|について|により|ものとする|こととする|{alternatives(CUT_AT)}).*$", "")
    named = F.coalesce(last_entity(c), cut)
    bare = _strip(F.regexp_replace(F.regexp_replace(named, "^\\s*という。?[)]?\\s*(と、?)?", ""), "(取扱|[(]?平成|第).*$", ""))
    return F.regexp_replace(bare, "^(と|及び|または|又は)\\s*[、,]?\\s*", "")


def is_candidate(name: Column) -> Column:
    kana = F.regexp_count(name, F.lit("[぀-ヿ一-鿿]"))
    known = has(name, ENTITY) | (F.length(name) <= 16) & (kana >= 3)
    return F.length(name).between(2, 90) & ~has(name, NOT_A_CANDIDATE) & ~name.rlike("^[はがをにでとの]") & ~name.isin("甲", "乙", "委託者", "受託者") & ~name.rlike("(と|と、|の|は)$") & known


def role(c: Column) -> Column:
    return F.when(c.isin(ROLES["甲"]), "甲").when(c.isin(ROLES["乙"]), "乙")


def is_bad_fragment(c: Column) -> Column:
    """Too little or too broken for a party."""
    signs = F.regexp_count(c, F.lit("[\\[\\]{}<>|/\\\\*#@]"))
    return (
        (c == "") | has(c, ["という。", "ひな形", "コメント", "参照"]) | c.isin("以下甲", "以下乙", "甲", "乙", "委託者", "受託者", *TYPES_ALONE) | c.rlike("[。、,;:]$") & (F.length(c) <= 16)
        | c.rlike("(と|と、|及び|または|又は|の)$") | c.rlike("^(という|及び|と)") | (balanced(c) != c) | (F.length(c) <= 16) & (signs >= 2) | (F.length(c) <= 4) & ~has(c, ["会社", *ENTITY[3:], "センター"])
    )


def is_entity(c: Column) -> Column:
    kana = F.regexp_count(c, F.lit("[぀-ヿ一-鿿]"))
    named = has(c, [*ENTITY, "センター"]) | (F.length(c) >= 4) & (kana >= 3) & ~is_bad_fragment(c)
    return F.length(c).between(2, 80) & ~c.rlike("^[0-9]+$") & ~c.isin("甲", "乙", "当事者", "本契約", *TYPES_ALONE) & ~c.rlike("(という。?|と|の|は)$") & named


def without_aliases(names: Column) -> Column:
    """Names in order, a short form and its full form as one: the full form, where the first of them stands."""
    base = lambda x: F.trim(F.regexp_replace(x, FORMAL, ""))

    def alike(a: Column, b: Column) -> Column:
        longer, shorter = F.when(F.length(a) >= F.length(b), a).otherwise(b), F.when(F.length(a) >= F.length(b), b).otherwise(a)
        core = F.regexp_replace(base(shorter), "\\s+", "")
        formal = (base(a) != a) | (base(b) != b)
        return (a == b) | (F.length(core) >= 2) & formal & (F.endswith(base(longer), base(shorter)) | F.endswith(longer, shorter))

    def better(a: Column, b: Column) -> Column:
        fa, fb = base(a) != a, base(b) != b
        return F.when(fb & ~fa, b).when(fa & ~fb, a).when(F.length(b) > F.length(a), b).otherwise(a)

    def step(kept: Column, x: Column) -> Column:
        at = F.array_position(F.transform(kept, lambda k: alike(k, x)), True)
        merged = F.transform(kept, lambda k, i: F.when(i + 1 == at, better(k, x)).otherwise(k))
        return F.when(at > 0, merged).otherwise(F.concat(kept, F.array(x)))

    return F.aggregate(F.filter(names, lambda x: x != ""), F.filter(names, lambda x: F.lit(False)), step)


def without_lookalikes(names: Column, most: int = 4) -> Column:
    """Names in order without those that begin like one kept before and are longer or shorter by eight characters at most."""
    near = lambda a, b: (F.startswith(a, b) | F.startswith(b, a)) & (F.abs(F.length(a) - F.length(b)) <= 8)
    kept = F.aggregate(names, F.filter(names, lambda x: F.lit(False)), lambda k, x: F.when(F.exists(k, lambda y: near(x, y)), k).otherwise(F.concat(k, F.array(x))))
    return F.slice(kept, 1, most)


def windows(blocks: DataFrame) -> DataFrame:
    """Adds preamble and signing: which blocks of a document are looked through for its parties."""
    w = Window.partitionBy("doc_id")
    hint = (F.col("page") >= F.col("last_page") - 1) & has(F.col("norm"), SIGNATURE_HINTS)
    rows = blocks.withColumns({"rank": F.row_number().over(w.orderBy("ord")), "n": F.count(F.lit(1)).over(w), "last_page": F.max("page").over(w)})
    first = (F.col("page") <= 2) & (F.col("rank") <= 30)
    rows = rows.withColumns({"first_": first, "hint_": hint})
    rows = rows.withColumns({"firsts_": F.count_if("first_").over(w), "hints_": F.count_if("hint_").over(w)})
    preamble = F.when(F.col("firsts_") >= 6, F.col("first_")).otherwise(F.col("rank") <= F.greatest(F.lit(10), F.floor(F.col("n") / 3)))
    signing = F.when(F.col("hints_") > 0, F.col("hint_")).otherwise(F.col("rank") > F.col("n") - 12)
    return rows.withColumns({"preamble": preamble, "signing": signing}).drop("first_", "hint_", "firsts_", "hints_")


def _matches(text: Column, pattern: str, order: str, name_of=lambda c: c, words: list[str] | None = None) -> Column:
    """(name, role) of each match."""
    a, b = (_all(text, pattern, k, words) for k in (1, 2))
    names, roles = (a, b) if order == "name_first" else (b, a)
    return F.transform(F.arrays_zip(names.alias("name"), roles.alias("role")), lambda x: F.struct(name_of(x["name"]).alias("name"), x["role"].alias("role")))


def _with(items: Column, *more: Column) -> Column:
    """Each (name, role) of an array with further fields."""
    return F.transform(items, lambda x: F.struct(x["name"].alias("name"), x["role"].alias("role"), *more))


def declared(blocks: DataFrame) -> DataFrame:
    """(doc_id, role, name, score, block_id): of each role the best declaration in the first blocks, the earliest of equals.

    A block is read alone and with the next one of its page; blocks of the last page or with words of signing count more,
    then the first thirty."""
    w = Window.partitionBy("doc_id").orderBy("ord")
    rows = windows(blocks).filter(F.col("rank") <= F.greatest(F.lit(80), F.least(F.col("n"), F.lit(180))))
    after = F.when((F.lead("page").over(w) == F.col("page")) & (F.lead("rank").over(w) - F.col("rank") <= 2), F.lead("norm").over(w))
    zone = (F.col("page") == F.col("last_page")) | has(F.col("norm"), ["記名押印", "署名", "住所", "代表者"])
    rows = rows.withColumns({"after_": after, "bonus_": F.when(zone, 0.25).when(F.col("rank") <= 30, 0.18).otherwise(0.0)})
    # nothing is declared without one of these
    rows = rows.filter(matches(F.concat_ws(" ", "norm", "after_"), "以下|[甲乙]\\s*:|[甲乙]\\s*とし", ["以下", ":", "とし"]))
    both = F.array(F.struct(F.col("norm").alias("text"), F.lit(0.0).alias("less")), F.struct(F.concat_ws(" ", "norm", "after_").alias("text"), F.lit(0.04).alias("less")))
    texts = rows.select("doc_id", "rank", "block_id", "bonus_", F.explode(F.when(F.col("after_").isNotNull(), both).otherwise(F.slice(both, 1, 1))).alias("t")).select("doc_id", "rank", "block_id", "bonus_", "t.*")
    found = F.concat(*[_with(_matches(F.col("text"), pattern, order, words=[word]), F.lit(score).alias("base"), F.lit(i).alias("turn")) for i, ((pattern, order, score), word) in enumerate(zip(DECLARED, DECLARED_BY, strict=True))])
    # an outer generator has no filter before it that makes all matches again; texts without one have no name and go below
    hits = texts.select("doc_id", "rank", "block_id", "bonus_", "less", F.explode_outer(found).alias("h"))
    # a generated column: the optimiser would write the whole expression out wherever the name is looked at
    hits = hits.select("*", "h.role", "h.base", "h.turn", F.explode(F.array(party_name(F.col("h.name")))).alias("name"))
    hits = hits.withColumn("score", F.col("base") + F.col("bonus_") - F.col("less") - F.when(is_placeholder(F.col("name")), 0.06).otherwise(0.0))
    good = hits.filter(is_party(F.col("name")) | is_placeholder(F.col("name"))).withColumn("score", F.round("score", 6))
    best = Window.partitionBy("doc_id", "role").orderBy(F.desc("score"), "rank", "less", "turn")
    return good.withColumn("turn_", F.row_number().over(best)).filter("turn_ = 1").select("doc_id", "role", "name", "score", "block_id")


def counterparties(found: DataFrame) -> DataFrame:
    """(doc_id, parties, confidence): 甲 before 乙; surer with both."""
    g = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(F.when(F.col("role") == "甲", 0).otherwise(1).alias("i"), "name"))).alias("p"))
    return g.select("doc_id", F.transform("p", lambda x: x["name"]).alias("parties"), F.when(F.size("p") == 2, 0.92).otherwise(0.76).alias("confidence"))


def finders(blocks: DataFrame) -> DataFrame:
    """(doc_id, name, role, confidence): candidates from preamble and signature blocks, one of each name.

    Declarations and labels give roles, entities without a role less confidence."""
    norm = F.col("norm")

    def rows_of(flag: str, parts: list[tuple[Column, float]]) -> Column:
        return F.when(F.col(flag), F.concat(*[F.transform(_with(a, F.lit(c).alias("confidence")), lambda x: x.withField("role", role(x["role"]))) for a, c in parts])).otherwise(F.array())

    alone = F.transform(entities(norm), lambda x: F.struct(finder_name(x).alias("name"), F.lit(None).cast("string").alias("role")))
    label = _matches(norm, "(甲|乙|委託者|受託者)\\s*:\\s*([^\\n]{2,120})", "role_first", finder_name, [":"])
    said = _matches(norm, "([^。\\n]{2,120}?)\\s*[(]?\\s*以下\\s*[「『]?(甲|乙|委託者|受託者)", "name_first", finder_name, ["以下"])
    signed = _matches(norm, "(委託者|受託者|甲|乙)\\s*(?:[(]?(?:甲|乙)?[)])?\\s*:?\\s*([^\\n]{0,120})", "role_first", finder_name)
    every = F.concat(rows_of("preamble", [(said, 0.90), (label, 0.85), (alone, 0.72)]), rows_of("signing", [(signed, 0.82), (alone, 0.70)]))
    # as above: no filter makes all names again
    hits = windows(blocks).filter("preamble or signing").select("doc_id", F.explode_outer(every).alias("h")).select("doc_id", "h.*").filter(is_candidate(F.col("name")))
    best = Window.partitionBy("doc_id", "name").orderBy(F.desc("confidence"), F.col("role").isNull(), "role")
    return hits.withColumn("turn_", F.row_number().over(best)).filter("turn_ = 1").drop("turn_")


def merged(found: DataFrame) -> DataFrame:
    """(doc_id, parties): the surest of each role, then others that look like none before them, four at most."""
    w = Window.partitionBy("doc_id", "role").orderBy(F.desc("confidence"), "name")
    ranked = found.withColumn("turn_", F.row_number().over(w)).filter(F.col("role").isNull() | (F.col("turn_") == 1))
    place = F.struct(F.when(F.col("role") == "甲", 0).when(F.col("role") == "乙", 1).otherwise(2).alias("a"), (-F.col("confidence")).alias("b"), F.col("name").alias("name"))
    g = ranked.groupBy("doc_id").agg(F.array_sort(F.collect_list(place)).alias("p"))
    return g.select("doc_id", without_lookalikes(F.transform("p", lambda x: x["name"])).alias("parties"))
