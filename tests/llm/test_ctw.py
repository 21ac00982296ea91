"""Context-tree weighting against recursion over dictionaries."""

import collections
import math
import zlib

import numpy as np
import pytest

from lexiform.llm import context_tree, ctw
from lexiform.llm.queries import op7_ctw

WORDS = "the of and thion erst ander stble inge oner reat thed heou anst tion".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def form(text):
    return b" ".join((text or "").encode("utf-8", "replace").lower().split()) + b"\n"


def plain_ctw(train, depth):
    """Natural logarithm of a text's probability."""
    counts, kids = collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for t in train:
        data = ctw.END * depth + t
        for i in range(depth, len(data)):
            for d in range(depth + 1):
                counts[data[i - d : i]][data[i]] += 1
                if d:
                    kids[data[i - d + 1 : i]].add(data[i - d : i])

    def pair(c, level, prefix):
        z = sum(k for s, k in counts[c].items() if s >> (7 - level) == 2 * prefix) if c in counts else 0
        o = sum(k for s, k in counts[c].items() if s >> (7 - level) == 2 * prefix + 1) if c in counts else 0
        return z, o

    def kt(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1)

    memo = {}

    def weighted(c, level, prefix):
        key = (c, level, prefix)
        if key not in memo:
            own = kt(*pair(c, level, prefix))
            memo[key] = own if len(c) == depth else np.logaddexp(own, sum(weighted(k, level, prefix) for k in kids[c])) - math.log(2)
        return memo[key]

    def chance(context, level, prefix):
        told, mass, fall = 0.0, 1.0, 0.5
        for d in range(depth + 1):
            c = context[depth - d :]
            z, o = pair(c, level, prefix)
            if not z + o:
                break
            here = (o + 0.5) / (z + o + 1)
            w = 1.0 if d == depth else math.exp(kt(z, o) - math.log(2) - weighted(c, level, prefix))
            told, mass, fall = told + mass * w * here, mass * (1 - w), (here + fall) / 2
        return told + mass * fall

    def score(t):
        data, out = ctw.END * depth + t, 0.0
        for i in range(depth, len(data)):
            for level in range(8):
                p = chance(data[i - depth : i], level, data[i] >> (8 - level))
                out += math.log(p if data[i] >> (7 - level) & 1 else 1 - p)
        return out

    return score


@pytest.mark.parametrize("chunk_bytes", [200, ctw.CHUNK_BYTES])
def test_scores_and_base(spark, chunk_bytes):
    rng = np.random.default_rng(7)
    texts = [prose(rng, int(rng.integers(1, 12))) for _ in range(30)] + ["", None, "ÄB the", "  x\ny ", prose(rng, 3000)]
    rows = [(i, t, 1, "s") for i, t in enumerate(texts)] + [(3, texts[3], 1, "s"), (None, "the thion", 2, "t"), (None, None, 2, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int, id string").repartition(3)
    got = ctw.score(docs, chunk_bytes).collect()
    known = {r.doc_id: r for r in got}
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    train = [t for i, t, *_ in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    c = collections.Counter()
    for t in train:
        c.update([*form(t).split(), b"\n"])
    n, v = sum(c.values()), len(c)
    score = plain_ctw([form(t) for t in train], ctw.DEPTH)
    for i, r in known.items():
        if i is None:
            assert r.held_out is False
            continue
        ws = [*form(texts[i]).split(), b"\n"]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ws), sum(c[w] > 0 for w in ws), n, zlib.crc32(str(i).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel=1e-9)
        if i in (0, 2, 5, 30, 31, 32, 33):
            want = score(form(texts[i]))
            assert r.score == pytest.approx(want / math.log(10), rel=1e-5)
            assert r.bits_per_byte == pytest.approx(-want / math.log(2) / len(form(texts[i])), rel=1e-5)


def test_no_rows_and_no_training(spark):
    assert ctw.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = ctw.score(spark.createDataFrame([(only, "ab")], "doc_id long, text string")).collect()[0]
    assert r.score == pytest.approx(3 * math.log10(1 / 256), rel=1e-6) and (r.train_tokens, r.base_score, r.n_known) == (0, 0, 0)


def test_byte_chances_add_up():
    rng = np.random.default_rng(3)
    seen = np.unique(rng.integers(0, 1 << 24, 50).astype(np.uint64))
    for context in (0, int(seen[7] >> np.uint64(8)), 9):
        every = np.arange(256, dtype=np.uint64) | np.uint64(context << 8)
        keys, counts = context_tree.merged(np.concatenate([seen, every]), np.concatenate([np.full(len(seen), 3), np.zeros(256, np.int64)]))
        logs = context_tree.Subtree(keys, counts, 0, 2).logs()
        assert np.exp(logs[np.searchsorted(keys, every)]).sum() == pytest.approx(1)


def test_large_counts_follow_the_gamma_function():
    z, o = np.array([0, 3, 5000, 10**7]), np.array([0, 10**6, 5000, 2])
    want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(z, o, strict=True)]
    assert context_tree.block(z, o) == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_held_out_documents_are_better_than_by_the_base(spark, sf_dir):
    r = op7_ctw(spark, sf_dir.replace("0.001", "0.1")).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


def test_rows_and_shards_of_any_size_give_the_same_scores(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id < 40")
    cols = ["doc_id", "score", "base_score", "n_known"]
    whole = sorted(tuple(r) for r in ctw.score(docs).select(*cols).collect())
    monkeypatch.setattr(ctw, "PIECE", 500)
    monkeypatch.setattr(ctw, "SHARD_BYTES", 5_000)
    parts = sorted(tuple(r) for r in ctw.score(docs, chunk_bytes=20_000).select(*cols).collect())
    assert [r[0] for r in parts] == [r[0] for r in whole] and all(a == pytest.approx(b, rel=1e-6) for x, y in zip(parts, whole, strict=True) for a, b in zip(x, y, strict=True))
