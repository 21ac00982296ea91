"""Golden cases of text, dates, boxes, predicates and readers."""

import pytest
from pyspark.sql import functions as F

from lexiform.functions import dates, geometry
from lexiform.functions import predicates as pr
from lexiform.functions import text as tx
from lexiform.operators import evaluate, fields, layout, segment
from lexiform.sources import readers, sinks
from lexiform.streaming import intake, run


def one(spark, make, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(make(F.col("v"))).collect()]


def test_dates(spark):
    got = one(spark, dates.iso_date, "2025/01/01", "2025.01.01", "令和5年6月30日", "令和元年5月1日", "April 1, 2025", "1 Apr 2025", "2023年2月30日", "none", None)
    assert got == ["2025-01-01", "2025-01-01", "2023-06-30", "2019-05-01", "2025-04-01", "2025-04-01", None, None, None]
    assert one(spark, dates.kept_date, "令和○年") == ["令和○年"]


def test_article_numbers(spark):
    assert one(spark, tx.article_number, "第10条", "第二十三条", "第百五条", "第一二条", "第１２条", "条", None) == [10, 23, 105, 2, 12, None, None]


def test_normalize(spark):
    assert one(spark, tx.normalize_text, "（ａ）　b\n\tc\x07 ", "①㈱", None) == ["(a) b c", "1(株)", None]
    assert one(spark, tx.garbled_ratio, "", "a\x01", "\n") == [0.0, 1.0, 1.0]


def test_predicates(spark):
    assert one(spark, pr.is_page_number, "3", "1/12", "12 頁", "IV", "第3条", "x") == [True, True, True, True, False, False]
    assert one(spark, pr.is_annotation, "[A1]", "(住所)", "ひな形です", "参照", "第1条 参照", "普通の文") == [True, True, True, True, False, False]
    assert one(spark, pr.is_fragment, "甲", "ab", "[1]", "", "本文です") == [False, True, True, True, False]
    assert one(spark, lambda c: pr.semantic_type(c, "expiration"), "1年ごとに自動更新するものとする", "令和○○年○○月○○日まで") == ["renewable_term", "placeholder_term"]
    assert one(spark, lambda c: pr.semantic_type(c, "effective"), "本契約締結日から1年間", "2025-01-01", "契約締結日") == ["relative_term", "absolute", "anchor"]


def test_boxes(spark):
    row = spark.sql("SELECT named_struct('x0', 0d, 'y0', 0d, 'x1', 10d, 'y1', 10d) a, named_struct('x0', 5d, 'y0', 0d, 'x1', 15d, 'y1', 10d) b, array(array(10d, 20d), array(60d, 20d), array(60d, 80d), array(10d, 80d)) p")
    got = row.select(geometry.iou(F.col("a"), F.col("b")), geometry.from_polygon(F.col("p")), geometry.overlap_x(F.col("a"), F.col("b")), geometry.union(F.col("a"), F.col("b"))).first()
    assert got[0] == pytest.approx(1 / 3) and tuple(got[1]) == (10, 20, 60, 80) and got[2] == 0.5 and tuple(got[3]) == (0, 0, 15, 10)


def blocks(spark, *texts, page=1):
    rows = [("d", i, page, t, t, t.replace(" ", ""), f"b{i}") for i, t in enumerate(texts, 1)]
    return spark.createDataFrame(rows, "doc_id string, ord int, page int, text string, norm string, compact string, block_id string")


def test_clauses(spark):
    c = segment.clauses(blocks(spark, "契約書", "第1条(委託期間)", "期間は一年とする。", "3", "第2条(委託料)", "[A1]", "別に定める。")).orderBy("clause_ord").collect()
    assert [(r.clause_no, r.clause_title, r.section_type) for r in c] == [(None, None, "preamble"), ("第1条", "委託期間", "main_contract"), ("第2条", "委託料", "main_contract")]
    assert c[2].text == "第2条(委託料)\n別に定める。"


def test_fields(spark):
    b = blocks(spark, "株式会社サンプル(以下「甲」という。)と合同会社テスト(以下「乙」という。)は", "本契約は、契約締結日から令和5年6月30日まで有効とする。", "本契約の準拠法は日本法とする。", "紛争は、東京地方裁判所を第一審の専属的合意管轄裁判所とする。")
    got = {r.field: (r.value, r.accepted) for r in fields.validate(fields.best(fields.candidates(b))).collect()}
    assert got == {"party_a": ("株式会社サンプル", True), "party_b": ("合同会社テスト", True), "effective_date": ("契約締結日", True), "expiration_date": ("2023-06-30", True), "governing_law": ("日本法", True), "jurisdiction": ("東京地方裁判所", True)}


def test_keep_first_is_greedy(spark):
    got = spark.sql("SELECT array(1, 2, 3, 5) a").select(layout.keep_first(F.col("a"), lambda k, x: F.abs(k - x) <= 1)).first()[0]
    assert got == [1, 3, 5]


def test_matches(spark):
    df = spark.sql("SELECT * FROM VALUES ('東京 地裁', '東京地裁'), ('東京', '東京地裁'), (NULL, 'x'), ('x', NULL), ('a', 'b') t(e, g)")
    assert [r[0] for r in df.select(evaluate.match_class(F.col("e"), F.col("g"))).collect()] == ["exact", "partial", "unscored", "missing", "wrong"]


def test_readers_and_engine(spark, tmp_path):
    (tmp_path / "a b.txt").write_bytes(b"x")
    (tmp_path / "bad.txt").write_bytes(b"!")
    rows = readers.with_identity(readers.files(spark, str(tmp_path), "*.txt"))
    assert {r.doc_id[:5] for r in rows.collect()} == {"a_b_2", "bad_b"}

    def engine(path, content):
        if content == b"!":
            raise ValueError("empty")
        yield {"page": 1, "width": 1.0, "height": 1.0, "block_id": "p1_n001", "block_type": 0, "text": content.decode(), "x0": 0.0, "y0": 0.0, "x1": 1.0, "y1": 1.0}

    got = {r.text: r.error for r in readers.pages(rows, engine).collect()}
    assert got == {"x": None, None: "ValueError: empty"}
    listed = readers.listed(spark, ["bad.txt", "gone.txt"], rows.select("path"))
    assert {r.name: r.status for r in listed.collect()} == {"bad.txt": "found", "gone.txt": "skipped_missing"}


def test_json_lines(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("{",), ("",), ("[1]",)], "value string")
    assert [r.status for r in readers.json_lines(df).collect()] == ["object", "malformed", "blank", "not_an_object"]


def test_document_sink(spark, tmp_path):
    b = blocks(spark, "第1条(目的)", "本契約の目的を定めるものとする。")
    found = fields.validate(fields.best(fields.candidates(b)))
    docs = sinks.documents(segment.clauses(b), found, fields.issues(b.select("doc_id").distinct(), found))
    sinks.write_text(docs, "json", str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out")).first()
    assert back.clauses[0].clause_no == "第1条" and len(back.warnings) == 4 and back.errors == []


def test_streaming_intake_drops_repeats(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("SELECT * FROM VALUES (1L, 'x', timestamp'2025-01-01 00:00:00'), (2L, 'x', timestamp'2025-01-01 00:01:00'), (3L, 'y', timestamp'2025-01-01 00:02:00') t(doc_id, text, arrived)").write.parquet(src)
    q = run(intake(spark, src, "doc_id long, text string, arrived timestamp"), lambda d: d.select("text"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert sorted(r.text for r in spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out")).collect()) == ["x", "y"]
