"""Extracted values against expectations, and corpus scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.functions import roles


def squeezed(c: Column) -> Column:
    """Without white space, in lower case."""
    return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))


def match_class(expected: Column, got: Column) -> Column:
    """unscored, missing, placeholder, exact, partial (one within the other) or wrong."""
    e, g = squeezed(expected), squeezed(got)
    return F.when(expected.isNull(), "unscored").when(got.isNull() | (g == ""), "missing").when(g.rlike("[○◯□]"), "placeholder").when(e == g, "exact").when(g.contains(e) | e.contains(g), "partial").otherwise("wrong")


def list_match(expected: Column, got: Column) -> Column:
    """The same for lists: exact if the sets are equal, partial if they meet."""
    same = (F.size(F.array_except(expected, got)) == 0) & (F.size(F.array_except(got, expected)) == 0)
    return F.when(expected.isNull(), "unscored").when(got.isNull() | (F.size(got) == 0), "missing").when(same, "exact").when(F.size(F.array_intersect(expected, got)) > 0, "partial").otherwise("wrong")


def fill_rate(wide: DataFrame, fields: list[str]) -> DataFrame:
    filled = sum((F.coalesce((F.col(f).isNotNull() & (F.col(f) != "")).cast("int"), F.lit(0)) for f in fields), F.lit(0))
    return wide.withColumn("filled", filled).withColumn("fill_rate", F.round(filled / len(fields), 6))


#: Field, what a date says, and what that costs; semantic types that count.
SEMANTIC_PENALTIES = [("effective", "anchor_only", 0.06), ("effective", "relative_term", 0.04), ("effective", "placeholder_term", 0.05), ("effective", "renewable_term", 0.03), ("expiration", "relative_term", 0.05), ("expiration", "placeholder_term", 0.04), ("expiration", "renewable_term", 0.03)]
SEMANTIC_TYPES = ["absolute", "anchor_only", "relative_term", "placeholder_term", "renewable_term"]
#: Keys of a manifest row, of its expected fields, and those whose values are strings.
MANIFEST_KEYS = ["doc_id", "doc_type", "expected_fields", "language", "native_or_scanned", "notes", "path", "status"]
EXPECTED_KEYS = ["counterparties", "effective_date", "expiration_date", "governing_law", "jurisdiction"]
STRING_KEYS = ["doc_id", "path", "doc_type", "language", "native_or_scanned", "notes", "status"]
#: Kind of field, what was expected, what is accepted besides the same.
ACCEPTED = {
    "effective": {"placeholder_or_relative": ["placeholder", "relative"], "relative_or_placeholder": ["relative", "placeholder"]},
    "governing": {"unknown": ["present", "absent"]},
    "jurisdiction": {"relative_or_absent": ["relative", "absent"], "unknown_or_fragment_risk": ["explicit", "relative", "absent"]},
    "counterparties": {"one_side_only_or_blank": ["one_side_only", "absent"]},
}
ANCHORS = ["契約締結日から", "本契約締結日から", "締結日から"]
INVALID_TERMS = ["0年間", "0年", "0日間", "O0年間", "O年間"]
PERIOD = "日|週間|週|か月|ヶ月|ヵ月|月|年間|年"
BLANK_DATE = "^\\s*[○◯〇□■◻◼]*\\s*年\\s*[○◯〇□■◻◼]*\\s*月\\s*[○◯〇□■◻◼]*\\s*日\\s*$"
BLANK_NAME = "^[\\s□■◻◼○◯〇]+$"


def known_semantic(c: Column) -> Column:
    return F.when(F.trim(c).isin(SEMANTIC_TYPES), F.trim(c))


def quality_score(rows: DataFrame) -> DataFrame:
    """Adds quality, between 0 and 1: what is left of a base after penalties.

    Needs low_party, low_court, low_law, anchors (counts of reason codes), anchor_fields, quality_flags (counts of field
    metadata), effective_type, expiration_type, relative (court by place only, which gives credit), has_quality and source
    (document, no_fields or review_only). Without metadata the base is 0.85; without fields 0.75, without a document 0.80, and
    then reason codes alone count.
    """
    codes = 0.18 * F.col("low_party") + 0.20 * F.col("low_court") + 0.18 * F.col("low_law") + 0.10 * F.col("anchors")
    said = sum((F.when(known_semantic(F.col(f"{f}_type")) == t, x).otherwise(0.0) for f, t, x in SEMANTIC_PENALTIES), F.lit(0.0))
    fields = 0.06 * F.col("anchor_fields") + 0.04 * F.col("quality_flags") + said - F.when(F.col("relative"), 0.12).otherwise(0.0)
    base = F.when(F.col("source") == "review_only", 0.80).when(F.col("source") == "no_fields", 0.75).when(F.col("has_quality"), 1.0).otherwise(0.85)
    left = base - codes - F.when(F.col("source") == "document", fields).otherwise(0.0)
    return rows.withColumn("quality", F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), left)), 6)).withColumn("degraded", (F.col("source") != "document") | ~F.col("has_quality"))


def passes(rows: DataFrame) -> DataFrame:
    """Adds verdict. fail: a critical signal, law and court both missing, three low-quality values, or too little filled or
    too poor. A court by place only makes up for one missing court, and for one of low quality."""
    missing = F.col("missing_law") + F.col("missing_court") - F.when(F.col("relative") & (F.col("missing_court") > 0), 1).otherwise(0)
    low = F.col("low_party") + F.col("low_court") + F.col("low_law") + F.col("anchors") - F.when(F.col("relative") & (F.col("low_court") > 0), 1).otherwise(0)
    fail = (F.col("criticals") > 0) | (missing >= 2) | (low >= 3) | (F.col("fill_rate") < 0.60) | (F.col("quality") < 0.55)
    return rows.withColumn("verdict", F.when(fail, "fail").otherwise("pass"))


def nested_field(payload: Column, name: str) -> Column:
    """A field's value in a JSON result of any of five shapes; null where none has it."""
    at = lambda path: F.get_json_object(payload, f"$.{path}")
    tries = []
    for root in ("fields", "result.fields", "extracted_fields"):
        bare = at(f"{root}.{name}")
        # an object without a value is no value
        tries += [at(f"{root}.{name}.value"), F.when(~bare.startswith("{"), bare)]
    return F.coalesce(*tries)


def reason_codes(issue: Column) -> Column:
    """Codes of a JSON issue: reason_codes (a string or an array), reason_code (a string or an object), or code."""
    many = F.get_json_object(issue, "$.reason_codes")
    listed = F.filter(F.from_json(many, "array<string>"), lambda x: x.isNotNull() & (x != ""))
    one = F.coalesce(F.get_json_object(issue, "$.reason_code.value"), F.get_json_object(issue, "$.reason_code"), F.get_json_object(issue, "$.code"))
    none = F.array().cast("array<string>")
    return F.when(many.startswith("["), F.coalesce(listed, none)).when(many.isNotNull(), F.array(many)).when(one.isNotNull(), F.array(one)).otherwise(none)


def manifest_errors(row: Column, index: Column) -> Column:
    """What is wrong with a manifest row (JSON), as texts; empty if nothing is."""
    say = lambda *parts: F.concat(F.lit("row "), index.cast("string"), F.lit(": "), *parts)
    gone = lambda want, have: F.array_except(F.array(*[F.lit(k) for k in want]), F.coalesce(have, F.array().cast("array<string>")))
    fields = F.get_json_object(row, "$.expected_fields")
    top, inner = gone(MANIFEST_KEYS, F.json_object_keys(row)), gone(EXPECTED_KEYS, F.json_object_keys(fields))
    whole = F.coalesce(fields.startswith("{"), F.lit(False))
    v = F.try_parse_json(row)
    text = lambda k: F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant")) != "STRING"
    found = [
        F.when(F.size(top) > 0, say(F.lit("missing keys: "), F.array_join(top, ", "))),
        F.when(~whole, say(F.lit("expected_fields must be an object"))),
        F.when(whole & (F.size(inner) > 0), say(F.lit("expected_fields missing keys: "), F.array_join(inner, ", "))),
        *[F.when(F.coalesce(text(k), F.lit(False)), say(F.lit(f"{k} must be a string"))) for k in STRING_KEYS],
        F.when(F.coalesce(~F.get_json_object(row, "$.expected_structure").startswith("{"), F.lit(False)), say(F.lit("expected_structure must be an object when present"))),
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def effective_class(value: Column, semantic: Column, flags: Column) -> Column:
    """absent, invalid_or_ocr_anomaly, anchor_only, placeholder, relative or present."""
    flag = lambda *names: F.arrays_overlap(flags, F.array(*[F.lit(n) for n in names]))
    return roles.first_of([
        ("absent", value.isNull()),
        ("invalid_or_ocr_anomaly", roles.has(value, INVALID_TERMS) | flag("ocr_numeric_anomaly")),
        ("anchor_only", (semantic == "anchor_only") | flag("anchor_only_effective_date")),
        ("placeholder", (semantic == "placeholder_term") | flag("placeholder_date")),
        ("relative", semantic.isin("relative_term", "renewable_term") | flag("relative_period_only")),
        ("anchor_only", roles.has(value, ANCHORS)),
        ("placeholder", value.rlike(BLANK_DATE) | value.rlike("[○◯〇]")),
        ("relative", value.contains("から") & value.rlike(PERIOD)),
    ], "present")


def court_class(value: Column) -> Column:
    return F.when(value.isNull() | (value == ""), "absent").when(value.contains("所在地"), "relative").otherwise("explicit")


def parties_class(names: Column, flags: Column) -> Column:
    """absent, one_side_only, both, or both_with_placeholder_or_partial."""
    partial = F.arrays_overlap(flags, F.array(F.lit("counterparty_partial_accept"), F.lit("counterparty_placeholder"))) | F.exists(names, lambda x: x.rlike(BLANK_NAME))
    return F.when(names.isNull() | (F.size(names) == 0), "absent").when(F.size(names) == 1, "one_side_only").when(partial, "both_with_placeholder_or_partial").otherwise("both")


def accepted(kind: str, expected: Column, got: Column) -> Column:
    """Whether a class meets what was expected; some expectations accept several."""
    out = expected == got
    for name, classes in ACCEPTED[kind].items():
        out = F.when(expected == name, got.isin(classes)).otherwise(out)
    return out


def field_quality(flags: Column) -> Column:
    """What flags say of a field, as a struct: anchor_only, semantic_type, relative_expression, quality_flags; null if nothing."""
    after = lambda prefix: F.element_at(F.concat(F.transform(F.filter(flags, lambda x: x.startswith(prefix)), lambda x: F.substring_index(F.substr(x, F.lit(len(prefix) + 1)), "\x00", 1)), F.array(F.lit(None).cast("string"))), 1)
    low = F.filter(flags, lambda x: x.startswith("low_quality") | x.startswith("counterparty_") | (x == "rejected_by_validator"))
    anchor = F.when(F.array_contains(flags, "anchor_only_effective_date"), F.lit(True))
    semantic, relative = after("semantic_type:"), after("relative_jurisdiction_expression:")
    low = F.when(F.size(low) > 0, low)
    return F.when(anchor.isNotNull() | semantic.isNotNull() | relative.isNotNull() | low.isNotNull(), F.struct(anchor.alias("anchor_only"), semantic.alias("semantic_type"), relative.alias("relative_expression"), low.alias("quality_flags")))


def is_filled(value: Column) -> Column:
    """Whether a JSON value says something: no null, no blank text, no list of blanks; false does."""
    listed = F.filter(F.from_json(value, "array<string>"), lambda x: F.trim(x) != "")
    return F.coalesce(F.when(value.startswith("["), F.size(listed) > 0).otherwise(F.trim(value) != ""), F.lit(False))
