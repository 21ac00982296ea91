"""Manifests, payloads of several shapes and classes of fields, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions.vocabulary import alternatives
from lexiform.operators import evaluate
from lexiform.sources import bridges as br

#: Portable SQL: results, issues, manifest rows and fields of an order, in shapes that vary with it.
_MADE = """SELECT o_orderkey AS doc_id,
  CASE o_orderkey % 7 WHEN 0 THEN '{"fields":{"law":{"value":"日本法"}}}' WHEN 1 THEN '{"fields":{"law":"日本法"}}' WHEN 2 THEN '{"result":{"fields":{"law":{"value":"日本法"}}}}' WHEN 3 THEN '{"result":{"fields":{"law":"日本法"}}}'
    WHEN 4 THEN '{"extracted_fields":{"law":"日本法"}}' WHEN 5 THEN '{"fields":{"law":{"value":null,"flags":[]}}}' ELSE '{"fields":{}}' END AS payload,
  CASE o_orderkey % 6 WHEN 0 THEN '{"reason_codes":"A"}' WHEN 1 THEN '{"reason_codes":["A","",null,"B"]}' WHEN 2 THEN '{"reason_code":"C"}' WHEN 3 THEN '{"reason_code":{"value":"D"}}' WHEN 4 THEN '{"code":"E"}' ELSE '{"other":1}' END AS issue,
  CASE o_orderkey % 5 WHEN 0 THEN '{"doc_id":"x","path":"p","doc_type":"nda","language":"ja","native_or_scanned":"native","notes":"","status":"ready","expected_fields":{"governing_law":"l","jurisdiction":"j","effective_date":"e","expiration_date":"x","counterparties":[]}}'
    WHEN 1 THEN '{"doc_id":7,"path":"p","expected_fields":{"governing_law":"l"}}' WHEN 2 THEN '{"doc_id":"x","path":"p","doc_type":"nda","language":"ja","native_or_scanned":"native","notes":"","status":"ready","expected_fields":[]}'
    WHEN 3 THEN '{}' ELSE '{"doc_id":"x","path":"p","doc_type":"nda","language":"ja","native_or_scanned":"native","notes":null,"status":"ready","expected_structure":[1],"expected_fields":{"governing_law":"l","jurisdiction":"j","effective_date":"e","expiration_date":"x","counterparties":[]}}' END AS manifest,
  CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '2024-01-05' WHEN 2 THEN '契約締結日から' WHEN 3 THEN '○年○月○日' WHEN 4 THEN '本日から1年間' WHEN 5 THEN '0年間' WHEN 6 THEN '令和〇年' WHEN 7 THEN '2023年4月1日' ELSE '年 月 日' END AS effective,
  CASE o_orderkey % 4 WHEN 0 THEN 'anchor_only' WHEN 1 THEN 'odd' ELSE NULL END AS semantic,
  CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '甲の所在地を管轄する裁判所' ELSE '東京地方裁判所' END AS court,
  CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '山田商店' WHEN 2 THEN '山田商店,海山商事' WHEN 3 THEN '○○○,海山商事' ELSE '山田商店,海山商事,青空' END AS parties,
  CASE o_orderkey % 8 WHEN 0 THEN 'anchor_only_effective_date' WHEN 1 THEN 'semantic_type:relative_term,low_quality_date' WHEN 2 THEN 'relative_jurisdiction_expression:甲の所在地' WHEN 3 THEN 'counterparty_partial_accept' WHEN 4 THEN 'plain' WHEN 5 THEN 'placeholder_date,rejected_by_validator' ELSE '' END AS flags,
  CASE o_orderkey % 3 WHEN 0 THEN 'placeholder_or_relative' WHEN 1 THEN 'present' ELSE 'anchor_only' END AS wanted_date, CASE o_orderkey % 2 WHEN 0 THEN 'relative_or_absent' ELSE 'explicit' END AS wanted_court, CASE o_orderkey % 3 WHEN 0 THEN 'one_side_only_or_blank' ELSE 'both' END AS wanted_parties,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN '[]' WHEN 3 THEN '[" ","x"]' WHEN 4 THEN 'false' WHEN 5 THEN '[""]' ELSE 'x' END AS value"""


def _made(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_MADE.replace("{", "{{").replace("}", "}}") + " FROM {orders}", orders=br.table(spark, sf, "orders"))


def nested_fields(spark: SparkSession, sf: str) -> DataFrame:
    m = _made(spark, sf)
    return m.select("doc_id", evaluate.nested_field(F.col("payload"), "law").alias("law"), evaluate.is_filled(F.col("value")).alias("filled"))


def issue_codes(spark: SparkSession, sf: str) -> DataFrame:
    return _made(spark, sf).select("doc_id", F.array_join(evaluate.reason_codes(F.col("issue")), ",").alias("codes"))


def manifest_validation(spark: SparkSession, sf: str) -> DataFrame:
    m = _made(spark, sf)
    return m.select("doc_id", F.array_join(evaluate.manifest_errors(F.col("manifest"), F.col("doc_id")), "; ").alias("errors"))


def field_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of date, court and parties, and whether they meet what was expected."""
    flags = F.filter(F.split("flags", ","), lambda x: x != "")
    names = F.filter(F.split("parties", ","), lambda x: x != "")
    m = _made(spark, sf).select("*", evaluate.effective_class(F.col("effective"), evaluate.known_semantic(F.col("semantic")), flags).alias("date"), evaluate.court_class(F.col("court")).alias("place"), evaluate.parties_class(names, flags).alias("sides"))
    met = [evaluate.accepted(k, F.col(w), F.col(g)).alias(f"{g}_met") for k, w, g in (("effective", "wanted_date", "date"), ("jurisdiction", "wanted_court", "place"), ("counterparties", "wanted_parties", "sides"))]
    return m.select("doc_id", "date", "place", "sides", *met)


def field_quality(spark: SparkSession, sf: str) -> DataFrame:
    q = evaluate.field_quality(F.filter(F.split("flags", ","), lambda x: x != ""))
    m = _made(spark, sf).withColumn("q", q)
    return m.select("doc_id", F.col("q").isNotNull().alias("told"), "q.anchor_only", "q.semantic_type", "q.relative_expression", F.array_join("q.quality_flags", ",").alias("quality_flags"))


QUERIES = {f.__name__: f for f in (nested_fields, issue_codes, manifest_validation, field_classes, field_quality)}

_M = f"WITH m AS ({_MADE} FROM orders)"
_TOP = "['" + "', '".join(evaluate.MANIFEST_KEYS) + "']"
_INNER = "['" + "', '".join(evaluate.EXPECTED_KEYS) + "']"
SQL = {
    "nested_fields": _M + " SELECT doc_id, coalesce(payload->>'$.fields.law.value', CASE WHEN json_type(payload, '$.fields.law') = 'VARCHAR' THEN payload->>'$.fields.law' END, payload->>'$.result.fields.law.value', CASE WHEN json_type(payload, '$.result.fields.law') = 'VARCHAR' THEN payload->>'$.result.fields.law' END, payload->>'$.extracted_fields.law') AS law, value IS NOT NULL AND trim(value) NOT IN ('', '[]', '[\"\"]') AS filled FROM m",
    "issue_codes": _M + """ SELECT doc_id, CASE json_type(issue, '$.reason_codes') WHEN 'ARRAY' THEN array_to_string(list_filter(from_json(issue->'$.reason_codes', '["VARCHAR"]'), lambda x: x IS NOT NULL AND x <> ''), ',') WHEN 'VARCHAR' THEN issue->>'$.reason_codes' ELSE coalesce(issue->>'$.reason_code.value', CASE WHEN json_type(issue, '$.reason_code') = 'VARCHAR' THEN issue->>'$.reason_code' END, issue->>'$.code', '') END AS codes FROM m""",
    "manifest_validation": _M + f""" , e AS (SELECT doc_id, manifest, list_sort(list_filter({_TOP}, lambda k: NOT list_contains(json_keys(manifest), k))) AS gone, json_type(manifest, '$.expected_fields') AS kind, list_sort(list_filter({_INNER}, lambda k: NOT list_contains(coalesce(CASE WHEN json_type(manifest, '$.expected_fields') = 'OBJECT' THEN json_keys(manifest, '$.expected_fields') END, []), k))) AS inner_ FROM m)
      SELECT doc_id, concat_ws('; ', CASE WHEN len(gone) > 0 THEN concat('row ', doc_id, ': missing keys: ', array_to_string(gone, ', ')) END, CASE WHEN kind IS DISTINCT FROM 'OBJECT' THEN concat('row ', doc_id, ': expected_fields must be an object') END, CASE WHEN kind = 'OBJECT' AND len(inner_) > 0 THEN concat('row ', doc_id, ': expected_fields missing keys: ', array_to_string(inner_, ', ')) END,
        {", ".join(f"CASE WHEN json_type(manifest, '$.{k}') <> 'VARCHAR' THEN concat('row ', doc_id, ': {k} must be a string') END" for k in evaluate.STRING_KEYS)}, CASE WHEN json_type(manifest, '$.expected_structure') <> 'OBJECT' THEN concat('row ', doc_id, ': expected_structure must be an object when present') END) AS errors FROM e""",
    "field_classes": _M + f""", c AS (SELECT *, CASE WHEN effective IS NULL THEN 'absent' WHEN regexp_matches(effective, '{alternatives(evaluate.INVALID_TERMS)}') THEN 'invalid_or_ocr_anomaly' WHEN semantic = 'anchor_only' OR contains(flags, 'anchor_only_effective_date') THEN 'anchor_only' WHEN contains(flags, 'placeholder_date') THEN 'placeholder' WHEN regexp_matches(effective, '{alternatives(evaluate.ANCHORS)}') THEN 'anchor_only' WHEN regexp_matches(effective, '{evaluate.BLANK_DATE}') OR regexp_matches(effective, '[○◯〇]') THEN 'placeholder' WHEN contains(effective, 'から') AND regexp_matches(effective, '{evaluate.PERIOD}') THEN 'relative' ELSE 'present' END AS date,
      CASE WHEN coalesce(court, '') = '' THEN 'absent' WHEN contains(court, '所在地') THEN 'relative' ELSE 'explicit' END AS place, CASE WHEN parties = '' THEN 'absent' WHEN NOT contains(parties, ',') THEN 'one_side_only' WHEN contains(flags, 'counterparty_partial_accept') OR regexp_matches(parties, '(^|,)[□■◻◼○◯〇]+(,|$)') THEN 'both_with_placeholder_or_partial' ELSE 'both' END AS sides FROM m)
      SELECT doc_id, date, place, sides, CASE wanted_date WHEN 'placeholder_or_relative' THEN date IN ('placeholder', 'relative') ELSE wanted_date = date END AS date_met, CASE wanted_court WHEN 'relative_or_absent' THEN place IN ('relative', 'absent') ELSE wanted_court = place END AS place_met, CASE wanted_parties WHEN 'one_side_only_or_blank' THEN sides IN ('one_side_only', 'absent') ELSE wanted_parties = sides END AS sides_met FROM c""",
    "field_quality": _M + """, q AS (SELECT doc_id, CASE WHEN contains(flags, 'anchor_only_effective_date') THEN true END AS anchor_only, nullif(regexp_extract(flags, 'semantic_type:([^,]+)', 1), '') AS semantic_type, nullif(regexp_extract(flags, 'relative_jurisdiction_expression:([^,]+)', 1), '') AS relative_expression, list_filter(string_split(flags, ','), lambda x: starts_with(x, 'low_quality') OR starts_with(x, 'counterparty_') OR x = 'rejected_by_validator') AS low FROM m)
      SELECT doc_id, anchor_only IS NOT NULL OR semantic_type IS NOT NULL OR relative_expression IS NOT NULL OR len(low) > 0 AS told, anchor_only, semantic_type, relative_expression, CASE WHEN len(low) > 0 THEN array_to_string(low, ',') END AS quality_flags FROM q""",
}
