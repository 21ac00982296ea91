"""Prefix trie, line dedup and importance resampling against plain Python over odd tables."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiform.llm import importance, line_dedup, prefix_trie

CLASHES = ("conv", "idx", "depth", "digest", "words", "h1", "t1", "pos", "kept", "score", "rank", "n_words", "parts", "drops", "n", "part", "lines", "bucket")


def clash(df):
    return df.withColumns({c: F.lit(7) for c in CLASHES})


BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# prefix trie


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    return {c: own.get(c - int(math.fmod(c, 20)), [])[: (h := zlib.crc32(str(c).encode()) % 4)] + v[h:] for c, v in own.items()}


def brute_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for seq, who in members.items():
        sub = [s for s in members if s[: len(seq)] == seq]
        saved = sum((len(members[s]) - 1) * (len(WORD.findall(s[-1][1])) if s else 0) for s in sub)
        kids = sum(len(s) == len(seq) + 1 for s in sub)
        leaves = sum(not any(len(x) == len(s) + 1 and x[: len(s)] == s for x in sub) for s in sub)
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(seq))))
        out.append((min(who), len(seq), min(members[seq[:-1]]) if seq else None, len(who), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def conversations(rng):
    texts = ["a b", "c", "", None, "dé\tf", "a  b"]
    rows = [(int(c), int(t) if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), texts[rng.integers(len(texts))]) for c in [*range(0, 30), *range(15000, 15045), -7, -20, 2**40] for t in range(rng.integers(1, 6))]
    rows += [rows[3], (None, 1, "user", "no conversation"), (41, 0, "user", "one turn only"), (42, 0, "user", "one turn only"), (19, 9, "user", "w " * 50_000)]
    rows += [(100, i, "user", f"t{i}") for i in range(150)] + [(101 + k, i, "user", f"t{i}") for k in range(3) for i in range(100 + k)]
    return rows


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0], r[1]))


@pytest.fixture(scope="module")
def talks(spark):
    rows = conversations(np.random.default_rng(3))
    return rows, clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(3)


def test_trie_of_rebuilt_conversations(talks):
    rows, df = talks
    assert told(prefix_trie.trie(df, every=20)) == brute_trie(rebuilt(rows))


def test_trie_of_plain_conversations_and_small_lists(talks, monkeypatch):
    rows, df = talks
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    assert told(prefix_trie.trie(df)) == brute_trie({c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()})


def test_trie_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(none, every=20).count() == 0


def test_a_long_shared_conversation_makes_rows_in_proportion(spark):
    rows = spark.range(6).selectExpr("id as conv_id", "explode(sequence(0L, 1999L)) as turn").selectExpr("*", "'user' as role", "concat('x y ', if(turn > 1990 + conv_id, conv_id, 0)) as text")
    out = prefix_trie.trie(rows)
    root = out.filter("depth = 0").first()
    assert (root.n_convs, root.n_children, root.n_leaves) == (6, 1, 6)
    assert root.saved_tokens == 3 * (5 * 1991 + 5 + 4 + 3 + 2 + 1)


# line dedup


def brute_lines(rows, min_docs, keep_first):
    key = lambda line: re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(BLANKS))
    docs = {(d, t or "") for d, t in rows}
    holds, first = defaultdict(set), {}
    for d, t in docs:
        for i, line in enumerate(t.split("\n")):
            if k := key(line):
                holds[k].add((d, t))
    out = []
    for d, t in rows:
        t = t or ""
        drops = [i for i, line in enumerate(t.split("\n")) if len(holds[key(line)]) >= min_docs]
        out.append((d, t, drops))
    if keep_first:
        order = lambda x: (x[0] is not None, x[0] or 0, hashes[x[1]], x[2])
        hashes = dict.fromkeys({t for _, t in docs}, 0)
        for k, who in holds.items():
            if len(who) >= min_docs:
                first[k] = min(((d, t, i) for d, t in who for i, line in enumerate(t.split("\n")) if key(line) == k), key=order)
        out = [(d, t, [i for i in drops if first[key(t.split("\n")[i])] != (d, t, i)]) for d, t, drops in out]
    text = lambda t, drops: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(drops))
    return sorted(((-1 if d is None else d), len(t.split("\n")), len(drops), text(t, drops)) for d, t, drops in out)


@pytest.fixture(scope="module")
def pages():
    rng = np.random.default_rng(4)
    common = ["Home | About", " home | ABOUT\r", "Éa", "éa", "Share this", "\x0b\t", "", "ÀB x", "Àb X "]
    rows = []
    for d in range(60):
        lines = [common[rng.integers(len(common))] if rng.random() < 0.5 else f"line {rng.integers(400)}" for _ in range(rng.integers(1, 12))]
        rows.append((d, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, "\n".join(f"own {i % 700}" for i in range(5000)) + "\nShare this"), (204, "Share this"), (205, "\n" * 3 + "Share this\nend\n"), (None, "Share this\nnull id"), (None, "Share this\nnull id")]
    rows += [(206, "\n".join(["x"] * 64 + ["Share this"] * 70 + ["y"] * 200 + ["SHARE THIS"]))]
    return rows


@pytest.mark.parametrize(("min_docs", "keep_first"), [(10, False), (1, False), (2, True), (1, True), (10_000, False)])
def test_lines(spark, pages, min_docs, keep_first):
    df = clash(spark.createDataFrame(pages, "doc_id long, text string")).repartition(3)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in line_dedup.deduplicate(df, min_docs, keep_first).collect())
    assert got == brute_lines(pages, min_docs, keep_first)


def test_bitmaps_are_words_of_dropped_lines(spark, pages):
    df = spark.createDataFrame(pages, "doc_id long, text string")
    maps = {r.doc_id: [(w.word, w.bits) for w in r.drops] for r in line_dedup.bitmaps(df).collect()}
    assert maps[205] == [(0, 8)] and maps[204] == [(0, 1)] and 201 not in maps
    assert maps[206] == [(1, -1), (2, 63), (5, 1 << 14)] and maps[203][0][0] == 5000 // 64
    assert line_dedup.deduplicate(df.limit(0)).count() == 0 and line_dedup.bitmaps(df.limit(0)).count() == 0


def test_the_window_takes_the_ranges_as_they_are(spark, pages):
    plan = line_dedup.dropped(spark.createDataFrame(pages, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning(h1" not in plan and "Python" not in plan


# importance


def plain_features(text, orders):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
    return [zlib.crc32(" ".join(words[i : i + n]).encode()) for n in range(1, orders + 1) for i in range(len(words) - n + 1)]


TEXTS = ["The cat,the DOG", None, "", "x", "Ünï cödé漢字 9to5", "a" * 300 + " " + "B" * 64 + "-" + "c" * 65, "...", "ab", "cd", "é", "tail ", "\0null\x7f byte", "ab cd ef gh ab"]


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_features_are_those_of_plain_crcs(orders):
    for column in (pa.array(TEXTS), pa.array(TEXTS).slice(3, 6), pa.array(["joined", "words"]), pa.array([], pa.string()), pa.array([None, None], pa.string())):
        row, crc = importance.features(column, orders)
        got = defaultdict(list)
        for r, c in zip(row.tolist(), crc.tolist(), strict=True):
            got[r].append(c)
        assert {i: sorted(x) for i, t in enumerate(column.to_pylist()) if (x := plain_features(t, orders))} == {r: sorted(c) for r, c in got.items()}


def brute_draw(rows, target, percent, min_words, orders, buckets, seed):
    count = lambda texts: np.bincount([c % buckets for t in texts for c in plain_features(t, orders)], minlength=buckets)
    s, t = count([x for _, x in rows]).tolist(), count(target).tolist()
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for d, text in rows:
        f = plain_features(text, orders)
        w = sum(gain[c % buckets] for c in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_features(text, 1))])
    able = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    rank = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((str(r[0]), *r[1:4], rank.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize(("orders", "percent", "min_words", "buckets"), [(1, 10, 20, 10_000), (2, 50, 1, 97), (1, 100, 0, 10)])
def test_draws(spark, orders, percent, min_words, buckets):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(50)]
    rows = [(int(i), " ".join(rng.choice(words, rng.integers(1, 60)))) for i in range(150)] + list(enumerate(TEXTS, 1000)) + [(None, "no id " * 20), (None, "no id either " * 20), (5, "again " * 30), (7, "long text " * 200_000)]
    rows.append(rows[2])
    target = [" ".join(words[:10]), "w1 w2 w3", None, ""]
    df = clash(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted(((str(r.doc_id), r.n_features, r.weight, r.score, r["rank"]) for r in importance.resample(df, goal, percent, min_words, orders, buckets).collect()), key=str)
    assert got == brute_draw(rows, target, percent, min_words, orders, buckets, 2024)


def test_draws_from_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 10), (2, "d " * 30)], "doc_id long, text string")
    assert importance.resample(none, some).count() == 0
    assert sorted(r["rank"] for r in importance.resample(some, none.select("text"), percent=100).collect()) == [1, 2]
