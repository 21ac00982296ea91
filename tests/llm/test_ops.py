"""Each operator against plain Python over small and odd tables."""

import collections
import hashlib
import math
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexiform.llm import exact_dedup, grams, kneser_ney, license_scan, mixing, png_media, sentencepiece_codec, simhash, token_rollup, toxicity
from lexiform.llm.queries import PIECES, RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, n long, sig string"
WORDS = "the of and thion erst ander stble inge oner reat thed heou anst tion".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + ("" if rng.random() < 0.5 else rng.choice(WORDS)) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for i in range(60):
        out.append([i, prose(rng, int(rng.integers(3, 200))), "en" if i % 3 else "de", f"src{i % 4}"])
    out[7][1] = out[3][1]
    out[9][1] = " " + out[3][1].replace(" ", "\n") + " "
    out[11][1] = out[10][1] + " extra words here"
    out[12] = [12, None, None, None]
    out[13][1] = ""
    out[14][1] = " \t\n\x0b\x0c\r"
    out[15][1] = "▁x  ▁▁ é漢字🎉\0\x01 end"
    out[16][1] = prose(rng, 20000)
    out[17][1] = "one two"
    out[18][1] = "x" * 3000
    out.append(list(out[20]))  # a repeated row
    return [(*r, len(r[1] or ""), 0.5, "k", 1, "s") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 1


def test_pieces_equal_the_library(docs, rows, empty):
    c = sentencepiece_codec.codec(PIECES)
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.spans_tile) for r in sentencepiece_codec.digest_documents(docs, PIECES).collect())
    want = []
    for r in rows:
        ids = c.library.encode(r[1] or "", add_bos=True, add_eos=True)
        want.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(c.library.decode(ids).encode()).hexdigest(), True))
    assert got == sorted(want)
    assert sentencepiece_codec.digest_documents(empty, PIECES).count() == 0


def test_spans_are_the_pieces_bytes(docs):
    c = sentencepiece_codec.codec(PIECES)
    for r in sentencepiece_codec.encode_documents(docs.filter("doc_id < 16"), PIECES).collect():
        data = (r.text or "").encode()
        for k, a, b in zip(r.token_ids, r.span_start, r.span_end):
            assert c.surface[k].strip(b" ") in data[a:b].replace("▁".encode(), b" ")


def test_decode_of_any_ids(docs):
    c, rng = sentencepiece_codec.codec(PIECES), np.random.default_rng(1)
    for _ in range(500):
        ids = [int(x) for x in rng.choice([rng.integers(0, 32000), rng.integers(0, 262), rng.integers(180, 262)], rng.integers(0, 9))]
        assert c.decode(ids) == c.library.decode(ids)


def test_character_map_takes_the_longest_prefix():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    n = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = pb.ModelProto()
    proto.ParseFromString(n.serialized_model_proto())
    c = object.__new__(sentencepiece_codec.Codec)
    c.map = sentencepiece_codec.CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    spec = proto.normalizer_spec
    c.prefix, c.squeeze, c.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
    for text in ("ｶﾞ①㈱ﬁn", "Ａ　ｂ​ c", "éx", "plain", "", "㍿x"):
        data, source = c.normalise(text)
        assert data.decode() == n.normalize(text)
        assert len(source) == len(data) + 1 and (np.diff(source) >= 0).all() and source[-1] <= len(text.encode())


# 2


def test_toxicity_learns_words_and_stems(spark, empty):
    rng, bad = np.random.default_rng(2), ["moron", "vequta", "vequre", "vequll", "id10t"]
    data, labels = [], []
    for i in range(900):
        toxic = int(i % 9 == 0)
        words = prose(rng, 60).split()
        if toxic:
            for w in rng.choice(bad, 4):
                words.insert(int(rng.integers(len(words))), str(w))
        data.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    d = spark.createDataFrame([*data, (9000, None), (9001, "")], "doc_id long, text string")
    l = spark.createDataFrame([*labels, labels[0]], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(d, l).collect()}
    held = [r for i, r in got.items() if zlib.crc32(str(i).encode()) % 4 == 2 and i < 900]
    assert all(r.held_out for r in held) and sum(r.held_out for r in got.values()) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in got)
    truth = {i: t for i, _, t in labels}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert got[9000].score == got[9001].score and all(0 <= r.score <= 1 for r in got.values())
    none = toxicity.score(d, l.limit(0)).agg(F.max("score")).first()[0]
    assert none == 0 and toxicity.score(empty, l).count() == 0


def test_isotonic_rises():
    x, y = np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1])
    _, p = toxicity.isotonic(x, y)
    assert (np.diff(p) > 0).all()


# 3


def test_rollup_is_additive_and_idempotent(spark, docs, rows, tmp_path):
    r = token_rollup.Rollup(spark, f"file://{tmp_path}/state", [PIECES, RANKS])
    load = docs.withColumn("kind", F.lit("insert"))
    assert r.apply(1, load) and not r.apply(1, load)
    texts = {x[0]: (x[3], x[2], x[1] or "") for x in rows}

    def want(state):
        out = collections.defaultdict(lambda: [0, 0])
        for s, l, t in state.values():
            for path in (PIECES, RANKS):
                key = (s, l, path.rsplit("/", 1)[1])
                out[key][0] += 1
                out[key][1] += token_rollup.count_tokens(path, [t])[0]
        return dict(out)

    got = lambda: {(x.source, x.lang, x.tokenizer): [x.docs, x.tokens] for x in r.totals().collect()}
    assert got() == want(texts)
    changes = [(1, "delete", None, None, None, 1), (2, "revise", "src9", "fr", "un deux trois", 1), (3, "revise", "a", "a", "a", 1), (3, "delete", None, None, None, 2), (777, "delete", None, None, None, 1), (None, "insert", "a", "a", "a", 1)]
    batch = spark.createDataFrame(changes, "doc_id long, kind string, source string, lang string, text string, seq int")
    assert r.apply(2, batch) and not r.apply(2, batch)
    del texts[1], texts[3]
    texts[2] = ("src9", "fr", "un deux trois")
    assert got() == want(texts)
    with pytest.raises(ValueError):
        r.apply(0, batch)


# 4


def plain_fingerprint(text, n):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(ids, linked):
    label = {i: i for i in ids}
    while True:
        new = {i: min(label[j] for j in ids if linked(i, j)) for i in ids}
        if new == label:
            return label
        label = new


def test_fingerprints_and_components(docs, rows, empty):
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    fps = {r[0]: plain_fingerprint(r[1], 3) for r in rows}
    label = classes(sorted(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    assert got == {i: (fps[i], label[i]) for i in fps}
    assert simhash.near_duplicates(docs).count() == len(rows) and simhash.near_duplicates(empty).count() == 0


def test_links_of_a_crowded_ball(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = int(rng.integers(2**63))
    fps = {base ^ sum(1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))) for _ in range(150)} | {int(x) for x in rng.integers(0, 2**63, 60)}
    signed = sorted(x - 2**64 if x >= 2**63 else x for x in fps)
    from lexiform.llm.components import components

    got = {r.node: r.label for r in components(simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()}
    label = classes(signed, lambda i, j: ((i ^ j) & (2**64 - 1)).bit_count() <= 3)
    assert {x: got.get(x, x) for x in signed} == label


def test_components_of_a_chain(spark):
    from lexiform.llm.components import components

    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_similar_documents(spark, empty):
    rng = np.random.default_rng(4)
    data = []
    for i in range(40):
        words = prose(rng, 300).split()
        data.append((3 * i, " ".join(words)))
        words[50] = "changed"
        data.append((3 * i + 1, " ".join(words)))
    data += [(500, None), (501, " "), (502, "a b"), (503, "A  b")]
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got == {i: i - i % 3 for i in range(120) if i % 3 < 2} | {500: 500, 501: 500, 502: 502, 503: 502}
    kept = simhash.keep_one(spark.createDataFrame([(*x, "z") for x in data], "doc_id long, text string, gone string"))
    assert kept.count() == 42 and kept.columns == ["doc_id", "text", "gone"] and simhash.keep_one(empty).count() == 0


def test_similar_documents_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(21)
    texts = {}
    for i in range(60):
        words = [f"w{x}" for x in rng.integers(0, 10**9, int(rng.integers(40, 400)))]
        texts[10 * i] = " ".join(words)
        for j in (1, 2):  # 0.7 to 0.9 to the first
            other, share = list(words), rng.uniform(0.05, 0.18)
            for at in rng.choice(len(words) // 5, int(share * len(words) / 5) + 1, replace=False):
                other[5 * at + 2] = "changed"
            texts[10 * i + j] = " ".join(other)
        texts[10 * i + 3] = " ".join(words[: int(len(words) * rng.uniform(0.7, 0.9))])
    common = [f"c{x}" for x in range(200)]  # a crowd about the limit
    for i in range(100):
        texts[1000 + i] = " ".join(common + [f"c{i}x{x}" for x in range(int(rng.integers(15, 40)))])
    few = "a b c d e f g h".split()  # four shingles of five, and of six
    texts |= {2000: " ".join(few), 2001: " ".join([*few, "i"]), 2002: " ".join([*few, "i", "j"]), 2003: "z " + " ".join([*few, "i", "j"])}
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in texts.items()}
    jaccard = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    ids = sorted(sets)
    near = [(i, j) for i in ids for j in ids if i < j and 0.7 <= jaccard(i, j) < 0.9]
    assert sum(jaccard(*p) >= 0.8 for p in near) > 50 and sum(jaccard(*p) < 0.8 for p in near) > 50
    got = {r.doc_id: r.component_id for r in simhash.similar_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == classes(ids, lambda i, j: jaccard(i, j) >= 0.8)


# 5


def test_exponent_meets_targets(spark):
    n = {"a": 1000, "b": 100, "c": 10}
    t = spark.createDataFrame(list(n.items()), "source string, n long")
    h = 0.9 * math.log(3)
    p = mixing.exponent(t, 1110, entropy=h)
    w = {s: (x / 1110) ** p for s, x in n.items()}
    z = sum(w.values())
    assert -sum(x / z * math.log(x / z) for x in w.values()) == pytest.approx(h, abs=1e-6)
    q = mixing.exponent(t, 1110, repeats=3.0)
    z = sum((x / 1110) ** q for x in n.values())
    assert max(1110 * (x / 1110) ** q / z / x for x in n.values()) == pytest.approx(3.0, abs=1e-5)
    assert mixing.exponent(t, 1110) == 1.0


def test_mix_keeps_quotas(docs, rows, empty, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 300)
    got = mixing.mix(docs, budget_share=1.0, entropy_share=0.99, repeats=4.0).collect()
    tokens = collections.Counter()
    for r in rows:
        tokens[r[0]] += max(1, len((r[1] or "").encode().split()))
    source = {r[0]: r[3] or "" for r in rows}
    sizes = collections.Counter()
    for i, k in tokens.items():
        sizes[source[i]] += k
    budget, used = sum(sizes.values()), collections.Counter()
    for r in got:
        assert r.tokens == tokens[r.doc_id] and r.source == source[r.doc_id] and 0 <= r.order_key < 1
        used[r.source] += r.tokens
    weight = {r.source: r.weight for r in got}
    for s, k in used.items():
        biggest = max(tokens[i] for i in source if source[i] == s)
        assert weight[s] * budget - biggest - 1 <= k <= weight[s] * budget + 1
    times = collections.Counter((r.doc_id, r.epoch) for r in got)
    assert max(times.values()) == 1
    assert mixing.mix(empty).count() == 0


def test_whole_mix_is_the_table(docs, rows):
    got = mixing.mixed_documents(docs, budget_share=1.0)
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.collect()) == sorted(r[0] for r in rows)


# 6


def test_exact_groups(docs, rows, empty):
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in exact_dedup.deduplicate(docs).collect())
    groups = collections.defaultdict(list)
    key = {}
    for r in rows:
        t = (r[1] or "").translate({ord(c): None for c in exact_dedup.BLANKS})
        key[r[0]] = t
        groups[t].append(((-len(r[1] or ""), r[0])))
    want = []
    for r in rows:
        g = groups[key[r[0]]]
        want.append((r[0], min(g)[1], len(g), r[0] == min(g)[1], hashlib.sha256(key[r[0]].encode()).hexdigest()))
    assert got == sorted(want)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({w[1] for w in want})
    assert exact_dedup.deduplicate(empty).count() == 0 and exact_dedup.keep_one(empty).count() == 0


def test_cuckoo_inserts_deletes_and_grows():
    index, digests = exact_dedup.CuckooIndex(4), [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    for i, d in enumerate(digests):
        assert index.insert(d, i) and not index.insert(d, i)
    assert index.resizes > 0 and index.size == 3000
    assert all(index.delete(d) and not index.delete(d) for d in digests[::2])
    assert [index.get(d) for d in digests] == [None if i % 2 == 0 else i for i in range(3000)]
    # the same fingerprint and bucket, another digest: the stored digest tells them apart
    twin = digests[1][:8] + b"\0" * 24
    assert index.get(twin) is None and index.insert(twin, "t") and index.get(digests[1]) == 1
    for i in range(30):
        index.insert(digests[1][:8] + bytes([i + 1]) * 24, i)
        if i > 8:
            break


def test_deletes_leave_the_index(docs):
    rows = exact_dedup.thin(docs)
    index = exact_dedup.live_index(rows, 3)
    gone = rows.filter("doc_id in (3, 10, 20)")
    left = exact_dedup.apply_deletes(index, gone, 3)
    assert left.count() == index.count() - 3 and left.join(gone, "digest", "left_semi").count() == 0


# 8


def test_licences_and_inheritance(spark, empty):
    files = [
        ("a/LICENSE", "Released under the MIT License.\n" + "words of no licence at all in here\n" * 3),
        ("a/b/x.py", "code"),
        ("a/b/y.py", "# Licensed under the Apache License, Version 2.0.\ncode and more code here and there"),
        ("a/b/c/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/d/z.py", None),
        ("q/w.py", "version 2.0 of nothing; licence talk only"),
        ("top.py", ""),
        ("a/b/x.py", "code"),
    ]
    d = spark.createDataFrame([(p, t, "x", "y") for p, t in files], "path string, text string, licence string, how string")
    got = sorted((r.path, r.licence, r.how, r.from_dir) for r in license_scan.scan(d).collect())
    assert got == sorted([("a/LICENSE", "MIT", "file", None), ("a/b/x.py", "MIT", "inherited", "a"), ("a/b/x.py", "MIT", "inherited", "a"), ("a/b/y.py", "Apache-2.0", "header", None), ("a/b/c/COPYING.txt", "GPL-3.0", "file", None), ("a/b/c/d/z.py", "GPL-3.0", "inherited", "a/b/c"), ("q/w.py", None, "none", None), ("top.py", None, "none", None)])
    assert license_scan.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_cosines_equal_plain_ones(spark):
    texts = ["Licensed under the Apache License, Version 2.0.", "We are licensed under CC BY-NC 4.0, mostly.", "All rights reserved. By us.", "nothing", "GNU General Public License version 3"]
    d = spark.createDataFrame([(f"p/{i}", t) for i, t in enumerate(texts)], "path string, text string")
    found = collections.Counter(t for x in texts for t in set(license_scan.terms(x)) & set(license_scan.VOCABULARY))
    idf, other = license_scan.weights(found, len(texts))
    vectors = license_scan.template_vectors(idf)
    want = {}
    for i, x in enumerate(texts):
        import re

        for s in re.sub(r"([.!?])[ \t]+", r"\1\n", x).split("\n"):
            c = collections.Counter(license_scan.terms(s))
            norm = math.sqrt(sum((k * idf.get(t, other)) ** 2 for t, k in c.items())) or 1
            best = max((round(sum(k * idf.get(t, other) * v.get(t, 0) for t, k in c.items()) / norm, 6) for _, v in vectors), default=0)
            if best >= license_scan.THRESHOLD:
                want[f"p/{i}"] = max(best, want.get(f"p/{i}", 0))
    got = {r.path: r.similarity for r in license_scan.matches(d).collect()}
    assert got == pytest.approx(want, abs=2e-6) and len(got) >= 3


# 9


def test_media_round_trip(docs, rows, empty):
    got = {r.doc_id: r for r in png_media.read_media(png_media.with_media(docs)).collect()}
    for r in rows:
        data = (r[1] or "").encode()
        raw = data + b"\0" * (max(64, -(-len(data) // 64) * 64) - len(data))
        x = got[r[0]]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32, x.error) == (len(data), len(raw), hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-64:]), None)
    assert got[3].feature == got[7].feature and got[3].media_sha256 == got[7].media_sha256
    assert png_media.read_media(png_media.with_media(empty)).count() == 0


def test_all_row_filters():
    rng = np.random.default_rng(9)
    image = rng.integers(0, 256, (10, 7)).astype(np.uint8)
    kinds = np.array([0, 1, 2, 2, 3, 3, 4, 4, 1, 2], np.uint8)
    rows = np.zeros_like(image)
    for y in range(10):
        for x in range(7):
            a = int(image[y, x - 1]) if x else 0
            b = int(image[y - 1, x]) if y else 0
            c = int(image[y - 1, x - 1]) if x and y else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            rows[y, x] = (int(image[y, x]) - (0, a, b, (a + b) // 2, paeth)[kinds[y]]) % 256
    assert (png_media.unfilter(kinds, rows) == image).all()


def test_broken_media_say_why(spark):
    good = png_media.write_png(np.arange(128, dtype=np.uint8).reshape(2, 64))
    bad = [good[:40], b"x" + good[1:], good[:50] + b"\0" + good[51:], None]
    d = spark.createDataFrame([(i, 1, x) for i, x in enumerate([bytearray(good), *[None if b is None else bytearray(b) for b in bad]])], "doc_id long, n_bytes long, media binary")
    got = {r.doc_id: r.error for r in png_media.read_media(d).collect()}
    assert got[0] is None and all(got[i] for i in range(1, 5))


# 10


def test_kneser_ney_equals_plain(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "then the end came"]
    t = kneser_ney.fit(spark.createDataFrame([(x,) for x in texts], "text string")).toArrow()
    model = kneser_ney.Model(*(t.column(k).to_numpy() for k in ("kind", "n", "g", "v")))
    order, lead = kneser_ney.ORDER, kneser_ney.LEAD
    top = collections.Counter()
    for x in texts:
        data = lead + x.encode()
        top.update(data[i - order + 1 : i + 1] for i in range(order - 1, len(data)))
    counts = {order: top}
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])

    def discount(n):
        k = [sum(1 for c in counts[n].values() if c == j) for j in (1, 2, 3, 4)]
        y = k[0] / (k[0] + 2 * k[1]) if k[0] else 0.5
        d = [j - (j + 1) * y * b / a if a else 0.5 * j for j, a, b in zip((1, 2, 3), k, k[1:])]
        return [min(max(x, 0.1), j) for j, x in zip((1, 2, 3), d)]

    def chance(n, g):
        if n == 0:
            return 1 / 256
        d = discount(n)
        same = [c for h, c in counts[n].items() if h[:-1] == g[:-1]]
        low = chance(n - 1, g[1:])
        if not same:
            return low
        c = counts[n].get(g, 0)
        return (max(c - d[min(c, 3) - 1], 0) if c else 0) / sum(same) + sum(d[min(x, 3) - 1] for x in same) / sum(same) * low

    for x in ("the cat", "zq", "a log came then"):
        data = lead + x.encode()
        want = sum(math.log(chance(order, data[i - order + 1 : i + 1])) for i in range(order - 1, len(data)))
        assert model.score([x.encode()])[1][0] == pytest.approx(want, rel=1e-4)


def test_classifier_rejects_junk(spark, empty):
    rng = np.random.default_rng(10)
    good = [(i, prose(rng, 80), "en" if i % 2 else None) for i in range(200)]
    junk = [(1000 + i, "".join(chr(int(x)) for x in rng.integers(33, 126, 400)), "en") for i in range(20)]
    edge = [(2000, None, "en"), (2001, "", "xx")]
    d = spark.createDataFrame([(*x, "s") for x in good + junk + edge], "doc_id long, text string, lang string, keep string")
    l = spark.createDataFrame([(i, 1, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.classify(d, l).collect()}
    assert not any(got[x[0]].keep for x in junk) and sum(got[x[0]].keep for x in good) >= 195 and got[2000].keep and got[2001].perplexity is None
    kept = kneser_ney.keep_good(d, l)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.keep}
    assert kneser_ney.classify(d, l.limit(0)).filter("not keep").count() == 0
    assert kneser_ney.classify(empty, l).count() == 0


def test_gram_table_and_counts():
    rng = np.random.default_rng(11)
    keys = np.unique(rng.integers(0, 2**62, 5000).astype(np.uint64))
    t = grams.GramTable(keys, np.arange(len(keys), dtype=np.float32))
    found, value = t.get(np.concatenate([keys, keys + np.uint64(2**62)]))
    assert found[: len(keys)].all() and not found[len(keys) :].any() and (value[: len(keys)] == np.arange(len(keys))).all()
    texts = [b"abcabc", b"", b"ab"]
    got = collections.Counter()
    for k, n in grams.counted(iter(texts), 3, b"\n\n", 10**6):
        got.update({int(a): int(b) for a, b in zip(k, n)})
    want = collections.Counter()
    for x in texts:
        data = b"\n\n" + x
        want.update(int.from_bytes(data[i - 2 : i + 1], "big") for i in range(2, len(data)))
    assert got == want


def test_long_texts_cross_chunks(monkeypatch):
    monkeypatch.setattr(grams, "CHUNK", 7)
    texts = [b"abcdefghijklmnopqrstuvwxyz", b"", b"0123456789"]
    got = collections.Counter()
    for k, n in grams.counted(iter(texts), 3, b"\n\n", 10**6):
        got.update({int(a): int(b) for a, b in zip(k, n)})
    want = collections.Counter()
    for x in texts:
        data = b"\n\n" + x
        want.update(int.from_bytes(data[i - 2 : i + 1], "big") for i in range(2, len(data)))
    assert got == want
