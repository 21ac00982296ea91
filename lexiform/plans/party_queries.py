"""Parties of contracts and forms of their names, each with SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiform.functions.vocabulary import alternatives
from lexiform.operators import parties
from lexiform.plans.text_queries import BLOCKS
from lexiform.sources import bridges as br

#: Portable SQL: names as they stand in contracts, one for each customer.
_RAW = """SELECT c_custkey AS k, CASE c_custkey % 16
  WHEN 0 THEN concat('(株)山田', c_custkey, '商店(以下「甲」という。)と') WHEN 1 THEN concat('、株式会社サンプル', c_custkey, ' 御中') WHEN 2 THEN '株式会社' WHEN 3 THEN concat('(同) 青葉', c_custkey)
  WHEN 4 THEN '○○○株式会社' WHEN 5 THEN '本契約の当事者' WHEN 6 THEN concat(c_custkey) WHEN 7 THEN concat('東京都千代田区 氏名 佐藤', c_custkey % 9, '太郎') WHEN 8 THEN concat('委託者: 北海', c_custkey, '株式会社 代表取締役')
  WHEN 9 THEN concat('国立大学法人大空', c_custkey % 7, '大学') WHEN 10 THEN '甲' WHEN 11 THEN concat('受託者は海山', c_custkey, '合同会社との間') WHEN 12 THEN '山田商店の' WHEN 13 THEN 'みどり規程による' WHEN 14 THEN 'ACME' ELSE concat('(有) 川上(', c_custkey) END AS raw,
  CASE c_custkey % 4 WHEN 0 THEN '委託者' WHEN 1 THEN 'ライセンシー' WHEN 2 THEN '甲' ELSE '第三者' END AS said"""


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(_RAW + " FROM {customer}", customer=br.table(spark, sf, "customer"))


def party_names(spark: SparkSession, sf: str) -> DataFrame:
    name = parties.party_name(F.col("raw"))
    return _raw(spark, sf).select("k", name.alias("name"), parties.is_party(name).alias("valid"), parties.is_placeholder(name).alias("placeholder"), parties.role(F.col("said")).alias("role"))


def finder_names(spark: SparkSession, sf: str) -> DataFrame:
    name = parties.finder_name(F.col("raw"))
    return _raw(spark, sf).select("k", name.alias("name"), parties.is_candidate(name).alias("candidate"))


def party_entities(spark: SparkSession, sf: str) -> DataFrame:
    name = parties.party_name(F.col("raw"))
    return _raw(spark, sf).select("k", parties.is_bad_fragment(name).alias("bad"), parties.is_entity(name).alias("entity"), F.array_join(parties.entities(F.col("raw")), ";").alias("entities"))


def party_aliases(spark: SparkSession, sf: str) -> DataFrame:
    """Four names of a customer, short and full forms among them, and what is left of them."""
    s = br.table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    name = F.concat(F.lit("青空"), F.col("k").cast("string"))
    full = F.concat(F.lit("株式会社"), name)
    names = F.when(F.col("k") % 3 == 0, F.array(name, full, F.lit("合同会社海山"))).when(F.col("k") % 3 == 1, F.array(full, F.concat(full, F.lit("東京支店")), name, F.lit("海山"))).otherwise(F.array(F.lit("海山"), F.lit("青空"), F.concat(F.lit("海山"), F.col("k").cast("string"))))
    return s.select("k", F.array_join(parties.without_aliases(names), ";").alias("merged"), F.array_join(parties.without_lookalikes(names), ";").alias("apart"))


def party_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = parties.windows(br.contract_blocks(spark, sf))
    return w.filter("preamble or signing").select("doc_id", "ord", "preamble", "signing")


def counterparties(spark: SparkSession, sf: str) -> DataFrame:
    """Both parties where each is declared in a block of its own; every third contract declares them in one, where the second
    can't be told from what stands before it."""
    b = br.contract_blocks(spark, sf)
    parts = F.when((F.col("ord") == 3) & (F.col("doc_id") % 3 > 0), F.split("norm", "(?<=。[)])と")).otherwise(F.array("norm"))
    b = b.select("doc_id", "page", "block_id", "ord", F.posexplode(parts).alias("i", "norm")).withColumn("ord", F.col("ord") + F.col("i"))
    c = parties.counterparties(parties.declared(b))
    return c.select("doc_id", F.array_join("parties", ";").alias("parties"), "confidence")


def found_parties(spark: SparkSession, sf: str) -> DataFrame:
    """The same contracts with the kind of company after its name."""
    b = br.contract_blocks(spark, sf).withColumn("norm", F.regexp_replace("norm", "(株式会社|合同会社)([A-Za-z0-9]+)", "$2$1"))
    m = parties.merged(parties.finders(b))
    return m.select("doc_id", F.array_join("parties", ";").alias("parties"))


QUERIES = {f.__name__: f for f in (party_names, finder_names, party_entities, party_aliases, party_windows, counterparties, found_parties)}

_alt = alternatives
_chain = lambda c, steps: c if not steps else _chain(f"regexp_replace({c}, '{steps[0][0]}', '{steps[0][1]}', 'g')", steps[1:])
_edge = lambda s: f"^[{s}]+|[{s}]+$"
_NAME = _chain("raw", [("以下\\s*[「『]?[甲乙].*$", ""), ("という。?[)]?\\s*(と、?)?\\s*$", ""), ("[(]\\s*株\\s*[)]", "株式会社"), ("[(]\\s*同\\s*[)]", "合同会社"), ("^[、,。\\s]+", ""), ("\\s+", " "), (_edge(" :、,。;"), ""), ("(御中|様)$", ""), (_edge(" "), ""), ("[と、のはにを]+$", "")])
_BALANCED = "CASE WHEN len(regexp_extract_all({c}, '[(]')) <> len(regexp_extract_all({c}, '[)]')) THEN trim(replace(replace({c}, '(', ''), ')', '')) ELSE {c} END"
_P = f"WITH r AS ({_RAW} FROM customer), q AS (SELECT *, {_NAME} AS q FROM r), n AS (SELECT *, {_BALANCED.format(c='q')} AS name FROM q)"
_types = ", ".join(f"'{t}'" for t in parties.TYPES_ALONE)
_m = lambda c, p: f"regexp_matches({c}, '{p}')"
_BAD = f"(name = '' OR {_m('name', _alt(['という。', 'ひな形', 'コメント', '参照']))} OR name IN ('以下甲', '以下乙', '甲', '乙', '委託者', '受託者', {_types}) OR {_m('name', '[。、,;:]$')} AND length(name) <= 16 OR {_m('name', '(と|と、|及び|または|又は|の)$')} OR {_m('name', '^(という|及び|と)')} OR ({_BALANCED.format(c='name')}) <> name OR length(name) <= 16 AND len(regexp_extract_all(name, '[\\[\\]{{}}<>|/\\\\*#@]')) >= 2 OR length(name) <= 4 AND NOT {_m('name', _alt(['会社', *parties.ENTITY[3:], 'センター']))})".replace("{{}}", "{}")
_found = lambda n: " || ".join(f"regexp_extract_all(raw, '{p}', 1)" for p in parties.ENTITY_PATTERNS[:n])
_EVERY = " || ".join(f"regexp_extract_all(c, '{p}', 1)" for p in parties.ENTITY_PATTERNS)
_CUT = _chain("raw", [("以下\\s*[「『]?[甲乙].*$", ""), ("^(委託者|受託者|甲|乙)\\s*:?", ""), ("^(と|及び|または|又は)\\s*[、,]?\\s*", ""), ("^.*?氏\\s*名", "")])
_F = f"WITH r AS ({_RAW} FROM customer), a AS (SELECT *, {_CUT} AS c FROM r), e AS (SELECT *, {_EVERY} AS found FROM a), g AS (SELECT k, {_chain('CASE WHEN len(found) > 0 THEN ' + _chain('found[-1]', [(_edge(parties.EDGES), '')]) + ' ELSE ' + _chain('c', [(f'(との間|の間に|について|により|ものとする|こととする|{_alt(parties.CUT_AT)}).*$', '')]) + ' END', [('^\\s*という。?[)]?\\s*(と、?)?', ''), ('(取扱|[(]?平成|第).*$', ''), (_edge(parties.EDGES), ''), ('^(と|及び|または|又は)\\s*[、,]?\\s*', '')])} AS name FROM e)"
_W = BLOCKS + f", w AS (SELECT doc_id, ord, page, norm, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS rank, count(*) OVER (PARTITION BY doc_id) AS cnt, max(page) OVER (PARTITION BY doc_id) AS lp FROM n), w2 AS (SELECT *, page <= 2 AND rank <= 30 AS f1, page >= lp - 1 AND {_m('norm', _alt(parties.SIGNATURE_HINTS))} AS h1 FROM w), w3 AS (SELECT *, count(*) FILTER (f1) OVER (PARTITION BY doc_id) AS fs, count(*) FILTER (h1) OVER (PARTITION BY doc_id) AS hs FROM w2), w4 AS (SELECT doc_id, ord, CASE WHEN fs >= 6 THEN f1 ELSE rank <= greatest(10, floor(cnt / 3)) END AS preamble, CASE WHEN hs > 0 THEN h1 ELSE rank > cnt - 12 END AS signing FROM w3)"
SQL = {
    "party_names": _P + f" SELECT k, name, length(name) >= 2 AND name NOT IN ('甲', '乙', '当事者', {_types}) AND NOT {_m('name', '(と|と、|の|は|に|を|で)$')} AND NOT {_m('name', '^[0-9]+$')} AND NOT {_m('name', _alt(parties.NOT_A_PARTY))} AS valid, length(name) >= 2 AND regexp_matches(regexp_replace(name, '\\s+', '', 'g'), '{parties.PLACEHOLDER}') AS placeholder, CASE WHEN said IN ('甲', '委託者', 'ライセンサー') THEN '甲' WHEN said IN ('乙', '受託者', 'ライセンシー') THEN '乙' END AS role FROM n",
    "finder_names": _F + f" SELECT k, name, length(name) BETWEEN 2 AND 90 AND NOT {_m('name', _alt(parties.NOT_A_CANDIDATE))} AND NOT {_m('name', '^[はがをにでとの]')} AND name NOT IN ('甲', '乙', '委託者', '受託者') AND NOT {_m('name', '(と|と、|の|は)$')} AND ({_m('name', _alt(parties.ENTITY))} OR length(name) <= 16 AND len(regexp_extract_all(name, '[぀-ヿ一-鿿]')) >= 3) AS candidate FROM g",
    "party_entities": _P + f" SELECT k, {_BAD} AS bad, length(name) BETWEEN 2 AND 80 AND NOT {_m('name', '^[0-9]+$')} AND name NOT IN ('甲', '乙', '当事者', '本契約', {_types}) AND NOT {_m('name', '(という。?|と|の|は)$')} AND ({_m('name', _alt([*parties.ENTITY, 'センター']))} OR length(name) >= 4 AND len(regexp_extract_all(name, '[぀-ヿ一-鿿]')) >= 3 AND NOT {_BAD}) AS entity, array_to_string({_found(3)}, ';') AS entities FROM n",
    "party_aliases": "WITH s AS (SELECT c_custkey AS k, concat('青空', c_custkey) AS n FROM customer) SELECT k, CASE k % 3 WHEN 0 THEN concat('株式会社', n, ';合同会社海山') WHEN 1 THEN concat('株式会社', n, ';株式会社', n, '東京支店;海山') ELSE concat('海山;青空;海山', k) END AS merged, CASE k % 3 WHEN 0 THEN concat(n, ';株式会社', n, ';合同会社海山') WHEN 1 THEN concat('株式会社', n, ';', n, ';海山') ELSE '海山;青空' END AS apart FROM s",
    "party_windows": _W + " SELECT doc_id, ord, preamble, signing FROM w4 WHERE preamble OR signing",
    "counterparties": BLOCKS + " SELECT k AS doc_id, CASE WHEN k % 3 > 0 THEN concat(party_a, ';', party_b) ELSE party_a END AS parties, CASE WHEN k % 3 > 0 THEN 0.92 ELSE 0.76 END::DOUBLE AS confidence FROM p",
    "found_parties": BLOCKS + " SELECT k AS doc_id, concat(replace(party_a, '株式会社', ''), '株式会社;', replace(party_b, '合同会社', ''), '合同会社') AS parties FROM p",
}
