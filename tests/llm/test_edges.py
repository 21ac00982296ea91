"""Odd tables for every operator and stage, and brute-force versions of verdicts and of the mix's order."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexiform.llm import exact_dedup, kneser_ney, mixing, png_media, sentencepiece_codec, simhash, token_rollup, toxicity
from lexiform.llm.queries import PIECES, RANKS

WORDS = "the of and thion erst ander stble inge oner reat thed heou anst tion".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(1)
    rows = [(i, prose(rng, 60), "en" if i % 2 else None, f"s{i % 3}", 1) for i in range(30)]
    rows += [(100, None, None, None, None), (101, "", "en", "s0", 0), (102, " \t\n", "en", "s1", 3), (103, rows[3][1], "en", "s2", 1), (104, prose(rng, 30_000), "en", "s1", 1)]
    rows += [rows[5], (None, rows[6][1], "en", "s0", 1), (None, "null id", None, "s0", 1), (7, rows[8][1], "de", "s1", 1)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"Keep": F.lit("k"), "N_Bytes": F.lit(2), "row_": F.lit(3), "gone_id_": F.lit(4), "token_IDS": F.lit("t"), "digest": F.lit("d"), "component_id": F.lit(5), "used_times_": F.lit(6)}).repartition(3)


@pytest.fixture(scope="module")
def labels_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_and_empty_tables(spark, odd, labels_dir, k):
    name, stage = corpus_pipeline.STAGES[k]
    out = stage(spark, odd, labels_dir)
    have = [c for c in odd.columns if k < 4 or c != "token_IDS"]
    assert [c for c in out.columns if c in have] == have and 0 < out.count()
    none = stage(spark, odd.limit(0), labels_dir)
    assert none.count() == 0 and none.columns == out.columns


def test_exact_dedup_of_null_and_repeated_ids(spark):
    d = spark.createDataFrame([(1, "a b", "x"), (2, "ab", "y"), (None, "ab", "z"), (None, "zz", "n"), (None, "zz", "n"), (3, "q", "1"), (3, "q", "2"), (3, "r", "3"), (4, "q ", "5"), (5, None, "e"), (6, "", "e2")], "doc_id long, text string, kept string")
    assert sorted((str(r.doc_id), r.text) for r in exact_dedup.keep_one(d).collect()) == [("1", "a b"), ("3", "r"), ("4", "q "), ("5", None), ("None", "zz")]
    once = {tuple(r) for r in exact_dedup.keep_one(d).collect()}
    assert all({tuple(r) for r in exact_dedup.keep_one(d.repartition(n)).collect()} == once for n in (2, 5))
    keep = {(str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact_dedup.deduplicate(d).collect()}
    assert {("None", None, 2, True), ("None", 1, 3, False), ("2", 1, 3, False), ("3", 4, 3, False), ("3", 3, 1, True)} <= keep


def test_near_dedup_keeps_rows_of_null_ids(spark, odd):
    assert {r.doc_id for r in simhash.keep_one(odd).collect()} >= {None, 100, 104}


def test_rollup_takes_one_change_for_all_tokenizers(spark, tmp_path):
    r = token_rollup.Rollup(spark, f"file://{tmp_path}/r", [PIECES, RANKS])
    rows = [(1, "insert", "A", "en", "many words in this text here"), (1, "insert", "B", "en", "few"), (2, "delete", None, None, None), (None, "insert", "C", "en", "x")]
    r.apply(1, spark.createDataFrame(rows, "doc_id long, kind string, source string, lang string, text string"))
    got = r.totals().collect()
    assert {(x.source, x.docs) for x in got} == {("B", 1)} and len(got) == 2
    later = [(1, "revise", "B", "en", "few more", 1), (1, "delete", None, None, None, 2), (3, "insert", "A", "de", None, 1)]
    changes = spark.createDataFrame(later, "doc_id long, kind string, source string, lang string, text string, seq int")
    assert r.apply(2, changes) and not r.apply(2, changes)
    assert {(x.source, x.lang, x.docs, x.tokens) for x in r.totals().collect()} == {("A", "de", 1, 0)}


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(30)], "doc_id long, toxic int")
    got = toxicity.score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = collections.defaultdict(set)
    for r in got:
        by[r.doc_id].add(r.score)
    assert by[5] == {next(iter(by[5]))} and by[100] == by[101]


def test_result_columns_replace_columns_of_any_case(spark):
    d = spark.createDataFrame([(1, "some text", 5, 6, 7)], "doc_id long, text string, Token_IDs int, DECODED int, Media int")
    e = sentencepiece_codec.encode_documents(d, PIECES)
    assert e.columns == ["doc_id", "text", "Media", "token_ids", "decoded", "span_start", "span_end"] and e.collect()[0].decoded == "some text"
    m = png_media.with_media(d.select("doc_id", "text", "Media"))
    assert m.columns == ["doc_id", "text", "n_bytes", "media"] and bytes(m.collect()[0].media).startswith(b"\x89PNG")


def test_quality_verdicts_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, int(rng.integers(5, 90))), "en" if i % 4 else None) for i in range(700)]
    rows += [(1000 + i, "".join(chr(int(x)) for x in rng.integers(33, 126, 300)), "en") for i in range(10)] + [(2000, None, "en"), (5, rows[5][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(700)], "doc_id long, quality int")
    got = kneser_ney.classify(docs, labels).collect()
    draw = {r.doc_id: r.d for r in docs.select("doc_id", kneser_ney._draw().alias("d")).collect()}
    shared, share = kneser_ney.train(docs, labels)
    model = kneser_ney.Model(*shared.value)
    n, lp = model.score([(t or "").encode() for _, t, _ in rows])
    trusted = [k for k, (i, _, _) in enumerate(rows) if i < 700 and draw[i] >= int(share * 1_000_000)]
    mean = -lp[trusted].sum() / n[trusted].sum()
    s = (-lp + kneser_ney.PRIOR_BYTES * mean) / (n + kneser_ney.PRIOR_BYTES)

    def limit(ks):
        x = np.sort(s[ks])
        return x[math.ceil(kneser_ney.QUANTILE * len(x)) - 1] + x.std() * kneser_ney.ERRORS * kneser_ney.QUANTILE_ERROR / math.sqrt(len(x))

    of_en = [k for k in trusted if rows[k][2] == "en"]
    limits = {None: limit(trusted), "en": limit(of_en) if len(of_en) >= kneser_ney.MIN_TRUSTED else limit(trusted)}
    want = collections.Counter((i, bool(s[k] <= limits[lang])) for k, (i, _, lang) in enumerate(rows))
    assert collections.Counter((r.doc_id, r.keep) for r in got) == want
    assert {i for i, keep in want if not keep} >= set(range(1000, 1010))
    assert {r.doc_id for r in kneser_ney.keep_good(docs, labels).collect()} == {i for i, keep in want if keep}


@pytest.mark.parametrize("budget", [0.7, 1.6, None])
def test_mix_order_equals_brute_force(spark, monkeypatch, budget):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(mixing, "STRETCH", 3)
    rng = np.random.default_rng(9)
    rows = [(i, prose(rng, int(rng.integers(1, 40))), "abc"[min(int(rng.integers(0, 6)), 2)]) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seed = 17
    got = {(r.doc_id, r.epoch): r.order_key for r in mixing.mix(docs, budget_share=budget, repeats=3.0, seed=seed).collect()}
    items = {i: (s, len(t.split())) for i, t, s in rows}
    n = collections.Counter()
    for s, k in items.values():
        n[s] += k
    whole = sum(n.values())
    totals = spark.createDataFrame(list(n.items()), "source string, n long")
    b = None if budget is None else min(int(budget * whole), 3 * whole)
    quota = {r.source: r.quota for r in mixing.weights(totals, b, mixing.exponent(totals, b, repeats=3.0)).collect()}
    assert budget is not None or all(quota[s] >= n[s] for s in n)
    key = lambda *c: F.xxhash64(*c, F.lit(seed))
    want = {}
    for s in n:
        blocks = math.ceil(n[s] / 50)
        for epoch in range(math.ceil(quota[s] / n[s])):
            e = F.lit(epoch).cast("long")
            mine = docs.filter(F.col("source") == s).select("doc_id", F.pmod(key(F.col("doc_id"), e, F.lit(0)), F.lit(blocks).cast("long")).alias("b"), key(F.col("doc_id"), e, F.lit(2)).alias("k2"))
            mine = mine.select("*", F.pmod(key(F.col("b"), e, F.lit(3)), F.lit(math.ceil(blocks / 3)).cast("long")).alias("st"), key(F.col("b"), e, F.lit(1)).alias("k1"))
            end = epoch * n[s]
            for r in sorted(mine.collect(), key=lambda r: (r.st, r.k1, r.b, r.k2, r.doc_id)):
                start, end = end, end + items[r.doc_id][1]
                if end <= quota[s]:
                    want[r.doc_id, epoch] = start / quota[s]
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def png(*chunks):
    body = b"".join(len(c).to_bytes(4, "big") + k + c + zlib.crc32(c, zlib.crc32(k)).to_bytes(4, "big") for k, c in chunks)
    return b"\x89PNG\r\n\x1a\n" + body


def head(width, height):
    return width.to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])


def test_unsound_images_give_a_reason_and_nulls(spark):
    data = zlib.compress(b"\0\1\2" * 2)
    cases = {
        "header of another size": png((b"IHDR", b"\0\0\0\1\0"), (b"IDAT", data), (b"IEND", b"")),
        "an image without samples": png((b"IHDR", head(0, 0)), (b"IDAT", zlib.compress(b"")), (b"IEND", b"")),
        "image data of another size": png((b"IHDR", head(2, 2)), (b"IDAT", zlib.compress(b"\0" * 10_000_000)), (b"IEND", b"")),
        "no header or no end": png((b"IHDR", head(2, 2)), (b"IDAT", data)),
        "unknown row filter": png((b"IHDR", head(2, 2)), (b"IDAT", zlib.compress(b"\x09\1\2" * 2)), (b"IEND", b"")),
        "a chunk is cut short": png((b"IHDR", head(2, 2)), (b"IDAT", data))[:-3],
    }
    rows = [(i, 4, b) for i, b in enumerate(cases.values())] + [(90, 4, png((b"IHDR", head(0, 2)), (b"IDAT", zlib.compress(b"\0\0")), (b"IEND", b""))), (91, 4, None), (92, 4, png((b"IHDR", head(2, 2)), (b"IDAT", data), (b"IEND", b"")))]
    got = {r.doc_id: r for r in png_media.read_media(spark.createDataFrame(rows, "doc_id long, n_bytes long, media binary")).collect()}
    for i, why in enumerate(cases):
        assert why in got[i].error and got[i].payload_sha256 is None, why
    assert got[90].error and got[91].error and got[92].error is None and got[92].payload_bytes == 4
