"""Settings, the command line, readers, sinks and odd inputs of the plans."""

import json

import pytest
from pyspark.sql import functions as F

from lexiform import cli
from lexiform.functions import predicates as pr
from lexiform.operators import evaluate
from lexiform.settings import Settings
from lexiform.sources import bridges, readers


def test_settings():
    assert Settings.from_env({}) == Settings()
    assert Settings.from_env({"LEXIFORM_RENDER_DPI": "150", "LEXIFORM_LOW_CONFIDENCE": " 0.5 "}).render_dpi == 150
    for bad in ({"LEXIFORM_RENDER_DPI": "1.5"}, {"LEXIFORM_REGION_OVERLAP": "-1"}):
        with pytest.raises(ValueError, match=next(iter(bad))):
            Settings.from_env(bad)


def test_arguments():
    a = cli.parser().parse_args(["in", "--output-dir", "out"])
    assert (a.layout_engine, a.doc_id, a.log_level) == ("current", None, "WARN")
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["in", "--output-dir", "out", "--layout-engine", "other"])


def test_ingest(spark, tmp_path):
    # full-width digits and brackets: text is normalised before anything is looked for
    lines = [(1, 1, 1, "業務委託契約書"), (1, 2, 1, "第１条（目的）"), (1, 3, 1, "乙は業務を行う。"), (1, 4, 1, "を含むものとする。"), (1, 5, 2, "第２条（準拠法）"), (1, 6, 2, "本契約の準拠法は日本法とする。"), (2, 1, 1, "覚書")]
    spark.createDataFrame([(*r, 0.9, "native") for r in lines], cli.BLOCKS).coalesce(1).write.json(f"{tmp_path}/in.jsonl")
    s = cli.run(spark, f"{tmp_path}/in.jsonl", f"{tmp_path}/out").first()
    assert (s.total, s.success, s.skipped, s.done) == (2, 1, 1, True)  # two characters are no clause
    docs = {json.loads(r.value)["doc_id"]: json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out/documents").collect()}
    assert docs[1]["fields"]["governing_law"]["value"] == "日本法"
    assert [(c.get("clause_no"), c.get("clause_title")) for c in docs[1]["clauses"]] == [(None, "前文"), ("第1条", None), ("第2条", "準拠法")]
    assert list(docs) == [1] and {w["reason_code"] for w in docs[1]["warnings"]} >= {"MISSING_JURISDICTION"}
    assert spark.read.json(f"{tmp_path}/out/chunks").count() == 3
    assert {r.reason_code for r in spark.read.json(f"{tmp_path}/out/review").collect()} >= {"MISSING_JURISDICTION", "MISSING_EFFECTIVE_DATE"}
    assert cli.run(spark, f"{tmp_path}/in.jsonl", f"{tmp_path}/one", doc_id=2).first().total == 1


def test_null_texts_stay_as_lines(spark, tmp_path):
    spark.createDataFrame([(1, None), (2, "a\nb")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted((r.doc_id, r.norm) for r in bridges.line_blocks(spark, str(tmp_path)).collect()) == [(1, ""), (2, "a"), (2, "b")]


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text("{broken")
    rows = readers.json_documents(spark, str(tmp_path), "x int").collect()
    assert {(r.x, r._corrupt_record is not None) for r in rows} == {(1, False), (None, True)}
    (tmp_path / "i.csv").write_text("name,n\nq,1\n")
    assert readers.inventory(spark, f"{tmp_path}/i.csv", "name string, n int").collect()[0].n == 1
    box = spark.range(1).select(readers.polygons(F.array(F.array(F.lit(1.0), F.lit(5.0)), F.array(F.lit(3.0), F.lit(2.0)))).alias("b")).first().b
    assert tuple(box) == (1.0, 2.0, 3.0, 5.0)


def test_list_matches_and_noise(spark):
    d = spark.createDataFrame([(["a", "b"], ["b", "a"]), (["a"], ["a", "c"]), (["a"], ["z"]), (["a"], []), (None, ["a"])], "e array<string>, g array<string>")
    assert [r[0] for r in d.select(evaluate.list_match(F.col("e"), F.col("g"))).collect()] == ["exact", "partial", "wrong", "missing", "unscored"]
    n = spark.createDataFrame([(x,) for x in ("", "123", "*", "---", "本文", "第1条")], "norm string")
    assert [r[0] for r in n.select(pr.is_noise(F.col("norm"))).collect()] == [True, True, True, True, False, False]


def test_ingest_by_engine_and_by_limits(spark, tmp_path):
    rows = [(1, 1, 1, "第1条 本契約の準拠法は日本法とする。", 0.5, "ocr", "current"), (1, 2, 1, "第2条 紛争は、大阪地方裁判所を管轄裁判所とする。", 0.9, "native", "ppstructure"), (2, 1, 1, "3", 0.9, "native", "current")]
    spark.createDataFrame(rows, f"{cli.BLOCKS}, layout_engine string").write.parquet(f"{tmp_path}/in")
    s = cli.run(spark, f"{tmp_path}/in", f"{tmp_path}/a").first()
    assert (s.total, s.success, s.skipped, s.failed) == (2, 1, 1, 0)
    codes = lambda name: {r.reason_code for r in spark.read.json(f"{tmp_path}/{name}/review").collect()}
    assert codes("a") >= {"LOW_CONFIDENCE", "MISSING_JURISDICTION"}
    cli.run(spark, f"{tmp_path}/in", f"{tmp_path}/b", settings=Settings(low_confidence=0.4), layout_engine="compare")
    assert not codes("b") & {"LOW_CONFIDENCE", "MISSING_JURISDICTION", "MISSING_GOVERNING_LAW"}
