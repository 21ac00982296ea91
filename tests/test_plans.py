"""Costs that show in a plan: what is made once must not be put into every condition on it."""

import re

from pyspark.sql import functions as F

from lexiform.functions import predicates as pr
from lexiform.functions import roles
from lexiform.functions import vocabulary as v
from lexiform.operators import fields, segment
from lexiform.plans import catalogue
from lexiform.sources import bridges as br


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_are_normalised_once_whatever_is_asked_of_them(spark, sf_dir):
    plan = optimized(segment.segmented(br.contract_blocks(spark, sf_dir)))
    assert plan.count("x1F") <= 2  # twenty conditions of a filter each had the pattern
    assert plan.count("上記契約の成立を証するため") == 1  # and the section its own


def test_merges_of_clauses_are_folded_once_each(spark, sf_dir):
    plan = optimized(catalogue.queries()["clause_post_merge"](spark, sf_dir))
    assert plan.count("aggregate(") == 4  # 274 before: every fold named its items twice


def test_doubts_come_from_one_pass_of_the_state(spark, sf_dir):
    plan = optimized(catalogue.queries()["boundary_doubts"](spark, sf_dir))
    assert plan.count("Relation") == 6  # each table of the contracts was read twice
    assert plan.count("信用保証協会|中小") == 1


def test_blocks_of_contracts_bring_their_places(spark, sf_dir):
    blocks = br.contract_blocks(spark, sf_dir)
    told = blocks.select("doc_id", "ord", "rank", "n")
    counted = fields.tail_share(blocks.drop("rank", "n")).select("doc_id", "ord", "rank", "n")
    assert told.exceptAll(counted).isEmpty() and counted.exceptAll(told).isEmpty()
    assert "Window" not in optimized(fields.candidates(blocks))  # all blocks were sorted for the few that have a field


def test_rules_are_matched_once_and_only_where_a_word_of_theirs_stands(spark, sf_dir):
    blocks = br.contract_blocks(spark, sf_dir)
    plan = optimized(fields.candidates(blocks))
    assert plan.count("(契約締結日)から") == 1 and plan.count("に発効,") <= 3  # every look at a group matched its pattern again
    assert "agreed_court" not in optimized(fields.candidates(blocks, "party_a"))
    texts = [("2024年1月2日から2025年1月1日まで有効",), ("令和5年3月4日に発効し、令和元年5月6日に終了する",), ("令和5年13月1日から",), ("契約締結日から",), ("governed by the laws of Japan",), ("GOVERNED BY the laws of the State",), ("準拠法は日本法とする",), ("、東京地方裁判所を管轄裁判所",), ("株式会社A(以下「甲」という)と合同会社B(以下「乙」",)]
    for (text,) in texts:
        assert any(re.search(p.replace(r"\p{IsHan}", "一-龥"), text) and fields.WORDS[r] in text for _, p, _, r in fields.RULES), text
    rows = spark.createDataFrame([(1, i, t, t, f"b{i}") for i, (t,) in enumerate(texts)], "doc_id long, ord int, norm string, compact string, block_id string")
    got = {(r["ord"], r["field"]): r["value"] for r in fields.candidates(rows).collect()}
    assert got[0, "effective_date"] == "2024-01-02" and got[0, "expiration_date"] == "2025-01-01"
    assert got[1, "effective_date"] == "2023-03-04" and got[1, "expiration_date"] == "2019-05-06"
    assert got[2, "effective_date"] == "令和5年13月1日" and got[3, "effective_date"] == "契約締結日"
    assert got[4, "governing_law"] == "日本法" and got[5, "governing_law"] == "State law" and got[7, "jurisdiction"] == "東京地方裁判所"


def test_words_before_patterns_change_no_verdict(spark):
    texts = ["別紙1", "本契約 別添", "付属資料", "仕様書", "約款本文", "業務委託契約約款", "記入要領", "記載例", "様式第2号", "通知書を出す", "必要に応じて追加", "任意記載", "第○条 受託者", "本契約締結の証として", "この契約書は二通作成し", "電磁的記録", "電子署名", "甲 : 記名押印", "乙:住所", "署名欄", "住所", "Page 3 / 9", "12頁", "XIV", "第1条", "第1条(参照)", "[A1]", "0000年00月00日", "( 住所 )", "コメント", "解説編", "適宜", "乙は、納入する。", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    t, none = F.col("t"), F.lit("")
    signed = t.rlike(v.SIGNATURE_SIGNAL) & roles.has(t, ["記名押印", "署名", "押印欄", "住所", "氏名", "代表者"])
    plain = roles.first_of([
        ("main_contract", t == ""), ("special_provisions", t.contains("特記事項")), ("appendix", t.rlike(v.APPENDIX_SIGNAL) | t.rlike(v.RESTART_SIGNAL)), ("instruction", t.rlike(v.INSTRUCTION)),
        ("form", t.rlike(f"{v.FORM_SIGNAL}|{v.TAIL_FORM_SIGNAL}|{v.BLANK_ARTICLE}")), ("signature", t.rlike(v.EXECUTION) | signed),
    ], None)
    head = t.rlike(pr.ARTICLE)
    page = (t != "") & ~head & (t.rlike(r"(?i)^\s*(?:page\s*)?[0-9]{1,4}\s*(?:/\s*[0-9]{1,4})?\s*(?:ページ|頁)?\s*$") | t.rlike(r"^\s*[IVXLCDM]{1,8}\s*$"))
    strong = t.rlike(r"^\s*\[[^\]]{1,20}\]\s*$") | t.rlike(r"^\s*0{2,4}年\s*0{1,2}月\s*0{1,2}日\s*$") | t.rlike(r"^\s*\(\s*(住所|代表者名)\s*\)\s*$") | pr.any_of(t, pr.COMMENTARY)
    note = (t != "") & ~head & (strong | (F.length(t) <= 20) & pr.any_of(t, ["適宜", "参照"]))
    same = segment.section_said(t, none).eqNullSafe(plain) & (pr.is_page_number(t) == page) & (pr.is_annotation(t) == note) & (pr.is_article_heading(t) == head)
    assert rows.filter(~same).collect() == []
    assert pr.matches(t, "x", ["x"])._jc.toString().count("contains") == 1


def test_names_of_parties_are_made_once(spark, sf_dir):
    plan = optimized(catalogue.queries()["counterparties"](spark, sf_dir))
    assert plan.count("(御中|様)$") == 1  # where brackets are counted each count made the name again
    assert plan.count("を\\s*(甲|乙)\\s*とし") + plan.count("を\\\\s*(甲|乙)\\\\s*とし") <= 2  # a filter before the generator matched all patterns again


def test_contracts_unfold_in_tasks_of_bounded_size(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(br, "ITEMS_A_TASK", 500)
    items = br.table(spark, sf_dir, "lineitem").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # as where line items and orders are many
    try:
        assert items > 4000 and br.contract_blocks(spark, sf_dir).rdd.getNumPartitions() == -(-items // 500)  # one task unfolded them all
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scopes_of_a_field_read_clauses_once(spark, sf_dir):
    plan = optimized(catalogue.queries()["field_scopes"](spark, sf_dir))
    assert plan.count("Relation") == 12 and plan.count("信用保証協会|中小") == 1  # the clause state was made twice


def test_signs_that_are_guarded_change_no_verdict(spark):
    texts = ["", "本契約", "甲は、乙に対し、業務の内容を遅滞なく報告するものとする。", "ひらがなばかりでじゅうろくもじこえる", "This Agreement shall be governed by the laws of Japan.", "THIS AGREEMENT SHALL BE GOVERNED", "one two three four five six.", "one two three four five", "カタカナA1#@", "準拠法は日本法", "日本法の", "氏名 準拠法", "[A1]", "東京地方裁判所を管轄とする", "Effective Date", "12/34 %", "𠮷野家は、これをもってあれとするものである", "dated as of 2020", "İ governed by"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    t, low = F.col("t"), F.lower("t")
    n, hiragana, words = F.length("t"), F.regexp_count("t", F.lit("[぀-ゟ]")), F.regexp_count(low, F.lit("[a-z]+"))
    particles = sum((F.when(t.contains(p), 1).otherwise(0) for p in v.SENTENCE_PARTICLES), F.lit(0))
    said = (n >= 16) & roles.has(t, v.SENTENCE_MARKS) | (n >= 14) & (particles >= 2) & (hiragana >= 3) | (n >= 16) & (hiragana >= 5) | (words >= 4) & roles.has(low, v.ENGLISH_MARKS) | (words >= 6) & t.rlike("[.;]$") | (n >= 24) & (hiragana >= 3)
    c = F.regexp_replace("t", r"\s+", "")
    m = F.length(c)
    barred = (m == 0) | (m > 36) | F.substring(c, 1, 1).isin(v.PARTICLES) | (m <= 18) & F.substring(c, -1, 1).isin(v.OPEN_ENDS) | pr.is_annotation(c) | pr.is_page_number(c) | roles.has(c, v.CRITICAL_EXCLUDED)
    weighty = ~barred & (roles.has(c, v.CRITICAL_JAPANESE) | roles.has(low, v.CRITICAL_ENGLISH))
    assert rows.filter(~(roles.sentence(t) == said) | ~(roles.critical(t) == weighty)).collect() == []
    # a part that stands twice is worked out ahead for every row unless it stands in a branch
    plan = rows.select(roles.sentence(t), roles.critical(t))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") > 0 and "AND RLIKE(lower(" not in plan


def test_folds_of_a_page_are_made_once(spark, sf_dir):
    plan = optimized(catalogue.queries()["local_residuals"](spark, sf_dir))
    assert plan.count("aggregate(") == 2 and "Filter ((size(" not in plan  # 8 before: each name of the items was a fold


def test_what_is_unfolded_is_made_once(spark, sf_dir):
    for name in ("clause_state", "law_scopes"):
        assert "Filter ((size(" not in optimized(catalogue.queries()[name](spark, sf_dir))  # a filter before the generator made it again
