"""SimHash near-duplicate detection with multi-index hashing.

A 64-bit fingerprint is cut into segments. Two fingerprints within ``radius`` bits agree in one segment up to
``radius // segments`` bits, so each fingerprint looks up the small Hamming ball around each of its segments in a table of
segment values and verifies the complete distance of what it meets. Equal fingerprints are one node from the start.

A segment value that very many different fingerprints share would make pairs with the square of their number: its
fingerprints are dealt into blocks of bounded size, blocks meet blocks, and each meeting hands on a forest that links what
is linked, not all pairs. No link is lost and no bucket is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.llm import scratch
from lexiform.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints in one block of a shared segment value, on average.
BLOCK = 512
#: Shingles hashed before their bits are counted.
CHUNK = 65_536


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of each shingle of ``words`` space-joined words, A-Z in lower case; repeats are kept.

    Fewer words: the whole sequence is the only shingle. No words: no hashes.
    """
    ws = text.encode("utf-8", "replace").lower().split()
    if not ws:
        return np.zeros(0, np.uint64)
    joined = b" ".join(ws)
    h = xxhash.xxh64_intdigest
    if len(ws) <= words:
        return np.array([h(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = [0, *(ends[: len(ws) - words] + 1).tolist()]
    return np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str | None, words: int = 3) -> int:
    """Bit i is set if it is set in over half the shingle hashes. No words: zero."""
    hashes = shingle_hashes(text or "", words)
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer. Null texts count as empty."""
    scratch.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, 1):
            fps = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, "doc_id long, fp long")


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the nodes of two blocks to the smallest node that they reach by links between the blocks."""
    link = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= radius
    # rows and columns without a link to a different fingerprint need no edge
    different = link & (a[:, None] != b[None, :])
    rows, cols = np.flatnonzero(different.any(1)), np.flatnonzero(different.any(0))
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    link, la, lb = link[np.ix_(rows, cols)], a[rows].copy(), b[cols].copy()
    top = np.iinfo(np.int64).max
    while True:
        nb = np.minimum(lb, np.where(link, la[:, None], top).min(0))
        na = np.minimum(la, np.where(link, nb[None, :], top).min(1))
        if (nb == lb).all() and (na == la).all():
            break
        la, lb = na, nb
    u, v = np.concatenate([a[rows], b[cols]]), np.concatenate([la, lb])
    keep = u != v
    return u[keep], v[keep]


def _segments(fp: Column, count: int) -> list[tuple[int, Column]]:
    """(width, value) of ``count`` segments of near-equal width, from the low bits up."""
    out, low = [], 0
    for i in range(count):
        width = BITS // count + (i < BITS % count)
        out.append((width, F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))))
        low += width
    return out


def links(nodes: DataFrame, radius: int = 3, segments: int = 2) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp) whose components are those of all links up to ``radius``."""
    ball = radius // segments
    if ball > 1 or segments < 2:
        raise ValueError("two segments at least, and enough that balls of one bit do")
    scratch.ship(nodes.sparkSession)
    cut = _segments(F.col("fp"), segments)
    own = reduce(DataFrame.unionByName, [nodes.select("fp", F.lit(i).alias("seg"), key.alias("key")) for i, (_, key) in enumerate(cut)])
    table = own.groupBy("seg", "key").agg(F.count(F.lit(1)).alias("n"))
    around = [nodes.select("fp", F.lit(i).alias("seg"), key.alias("key"), F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("bit")) for i, (width, key) in enumerate(cut)]
    probes = reduce(DataFrame.unionByName, around).select("fp", "seg", F.expr("key ^ shiftleft(1L, bit)").alias("key"))
    # what the balls meet; a segment value matters if its own fingerprints and those that meet it are two at least
    met = probes.join(table.select("seg", "key").hint("shuffle_hash"), ["seg", "key"]).withColumn("own", F.lit(False)) if ball else None
    rows = own.withColumn("own", F.lit(True))
    rows = scratch.save(rows.unionByName(met) if ball else rows, "met")
    size = rows.groupBy("seg", "key").agg(F.sum(F.col("own").cast("long")).alias("n_own"), F.sum((~F.col("own")).cast("long")).alias("n_met")).filter("n_own + n_met > 1")
    dealt = rows.join(size, ["seg", "key"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.ceil(F.when(F.col("own"), F.col("n_own")).otherwise(F.col("n_met")) / BLOCK)))
    blocks = scratch.save(dealt.groupBy("seg", "key", "own", "block").agg(F.collect_list("fp").alias("fps")), "blocks")
    left = blocks.filter("own").select("seg", "key", F.col("block").alias("at"), F.col("fps").alias("a"))
    right = blocks.select("seg", "key", "own", "block", F.col("fps").alias("b"))
    meetings = left.join(right, ["seg", "key"]).filter("not own or at <= block").filter("not own or at < block or size(a) > 1").select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            us, vs = [], []
            av, ao = a.flatten().to_numpy(zero_copy_only=False), a.value_lengths().to_numpy(zero_copy_only=False)
            bv, bo = b.flatten().to_numpy(zero_copy_only=False), b.value_lengths().to_numpy(zero_copy_only=False)
            x = y = 0
            for n, m in zip(ao.tolist(), bo.tolist(), strict=True):
                u, v = _forest(av[x : x + n], bv[y : y + m], radius)
                us.append(u)
                vs.append(v)
                x, y = x + n, y + m
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us) if us else [], pa.int64()), pa.array(np.concatenate(vs) if vs else [], pa.int64())], names=["u", "v"])

    edges = scratch.save(meetings.mapInArrow(run, "u long, v long").distinct(), "links")
    scratch.drop(rows, blocks)
    return edges


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, segments: int = 2) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id that links reach, itself included): a row for each row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other. A repeated doc_id gives a row each time. Columns
    besides doc_id and text are not looked at. An empty table gives no rows.
    """
    fps = scratch.save(fingerprints(docs, words), "fingerprints")
    nodes = scratch.save(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    edges = links(nodes.select("fp"), radius, segments)
    label = components(edges).select(F.col("node").alias("fp"), "label")
    linked = nodes.join(label, "fp")
    least = linked.groupBy("label").agg(F.min("first").alias("least"))
    ids = scratch.save(nodes.join(linked.join(least, "label").select("fp", "least"), "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "ids")
    scratch.drop(edges, nodes)
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of the unsigned value."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# Near copies by similarity. At a Jaccard similarity of 0.8 of five-word shingles the 64-bit fingerprints differ in 10 bits
# (median) and up to 18, far beyond what balls in segments can reach. So documents meet by bands of min-wise hashes of their
# shingles, long SimHash fingerprints drop what is clearly apart, and the shingle sets themselves decide.

LANES = 16
#: A pair at 0.8 shares no band with probability (1 - 0.8^3)^20 = 6e-7.
BANDS, ROWS = 20, 3
#: Fingerprints only drop pairs whose estimate is so much below the wanted similarity: five standard deviations at least.
SLACK = 0.15
#: Shingles in one block of a shared band key, on average; more only in a block of one set.
BLOCK_VALUES = 1 << 16
#: Sets below this size are not judged by fingerprints, whose ties make the distances of small sets larger.
SMALL = 64
_LANE_FACTORS = np.random.default_rng(42).integers(1, 2**63, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW_FACTORS = np.random.default_rng(43).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Hash of the one pseudo-shingle of a text without words.
NOTHING = 0x6E6F7468696E6721


def _mixed(h: np.ndarray, factor: np.ndarray | np.uint64) -> np.ndarray:
    x = (h ^ (h >> np.uint64(32))) * factor
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes in order; a text without words has one pseudo-shingle."""
    h = np.unique(shingle_hashes(text or "", words))
    return h if len(h) else np.array([NOTHING], np.uint64)


def _set_key(h: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63)


def long_signature(text: str | None, words: int) -> tuple[int, int, bytes, list[int]]:
    """(key of the set of shingles, its size, fingerprint of LANES x 64 bits over it, a key for each band of min-wise hashes)."""
    h = shingle_set(text, words)
    counts = np.zeros((LANES, BITS), np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 4096):
        part = h[at : at + 4096]
        for i, f in enumerate(_LANE_FACTORS):
            bits = np.unpackbits(_mixed(part, f).view(np.uint8).reshape(-1, 8), axis=1)
            for k in range(0, len(bits), 255):  # sums of 255 bits fit in a byte
                counts[i] += np.add.reduce(bits[k : k + 255], axis=0, dtype=np.uint8)
        for b in range(0, BANDS * ROWS, ROWS):
            least[b : b + ROWS] = np.minimum(least[b : b + ROWS], _mixed(part, _ROW_FACTORS[b : b + ROWS, None]).min(1))
    keys = [xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes(), b) - (1 << 63) for b in range(BANDS)]
    return _set_key(h), len(h), np.packbits(2 * counts > len(h), axis=1).tobytes(), keys


def _reach(similarity: float) -> int:
    """Bits in which fingerprints of two sets of that Jaccard similarity differ, on average."""
    cosine = 2 * similarity / (1 + similarity)
    return int(np.arccos(cosine) / np.pi * LANES * BITS)


def _links_within(a: tuple, b: tuple, similarity: float) -> tuple[list[int], list[int]]:
    """Links between two blocks' sets that join all whose Jaccard similarity is ``similarity`` or more, labels being joined.

    A block is (keys, labels, set sizes, fingerprints, values of the sets, their ends). Sets that links or labels join already
    are not compared; all others are, unless fingerprints or sizes are too far apart.
    """
    (ka, la, na, sa, ha, ea), (kb, lb, nb, sb, hb, eb) = a, b
    far = np.zeros((len(ka), len(kb)), np.int32)
    for w in range(sa.shape[1]):
        far += np.bitwise_count(sa[:, None, w] ^ sb[None, :, w])
    small, large = np.minimum(na[:, None], nb[None, :]), np.maximum(na[:, None], nb[None, :])
    maybe = (small >= similarity * large) & ((far <= _reach(similarity - SLACK)) | (small < SMALL))
    la, lb = la.copy(), lb.copy()
    us, vs = [], []
    for i in np.flatnonzero((maybe & (la[:, None] != lb[None, :])).any(1)).tolist():
        js = np.flatnonzero(maybe[i] & (lb != la[i]))
        if not len(js):
            continue
        mine = ha[ea[i] - na[i] : ea[i]]
        theirs = np.concatenate([hb[eb[j] - nb[j] : eb[j]] for j in js.tolist()])
        hit = mine[np.minimum(mine.searchsorted(theirs), len(mine) - 1)] == theirs
        both = np.add.reduceat(hit, np.cumsum(nb[js]) - nb[js], dtype=np.int64)
        js = js[both / (na[i] + nb[js] - both) >= similarity]
        labels, at = np.unique(lb[js], return_index=True)
        us += [int(ka[i])] * len(at)
        vs += kb[js[at]].tolist()
        la[np.isin(la, labels)] = la[i]
        lb[np.isin(lb, labels)] = la[i]
    return us, vs


def _linked(nodes: DataFrame, sizes: DataFrame, sets: DataFrame, similarity: float, own: bool) -> DataFrame:
    """Links (u, v) of the sets of ``nodes`` (node, label, band, key), found in blocks of the band keys in ``sizes``.

    ``own`` looks into each block, otherwise the blocks of a band key meet one another.
    """
    # another deal in each band, so that the blocks of a crowd overlap
    dealt = nodes.join(sizes, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("node", "band"), F.col("blocks"))).select("node", "label", "band", "key", "block")
    blocks = dealt.join(sets, "node").groupBy("band", "key", "block").agg(F.collect_list(F.struct("node", "label", "n", "sig", "h")).alias("m"))
    if own:
        meetings = blocks.filter("size(m) > 1").select(F.col("m").alias("a"))
    else:
        blocks = scratch.save(blocks, "blocks")
        left = blocks.select("band", "key", F.col("block").alias("at"), F.col("m").alias("a"))
        meetings = left.join(blocks.withColumnRenamed("m", "b"), ["band", "key"]).filter("at < block").select("a", "b")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(m: pa.StructArray) -> tuple:
            node, label, n, sig, h = m.flatten()
            node, label, n = (x.to_numpy(zero_copy_only=False) for x in (node, label, n))
            return node, label, n, np.frombuffer(b"".join(sig.to_pylist()), np.uint64).reshape(-1, LANES), h.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum(n)

        for batch in batches:
            for i in range(batch.num_rows):
                a = side(batch.column(0)[i].values)
                u, v = _links_within(a, a if own else side(batch.column(1)[i].values), similarity)
                if u:
                    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    out = scratch.save(meetings.mapInArrow(meet, "u long, v long").distinct(), "links")
    scratch.drop(blocks)
    return out


def similar_documents(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, component_id (the smallest doc_id that links reach, itself included): a row for each doc_id.

    Two documents are linked if the Jaccard similarity of their shingle sets (of 64-bit hashes) is ``similarity`` or more. Bands
    bring a pair at 0.8 together with probability 1 - 6e-7; each pair that they bring is compared by its sets, unless
    fingerprints or sizes are too far apart or links already join it. Texts without words are alike. Null texts count as empty.
    Of rows that repeat a doc_id one counts.
    """
    scratch.ship(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, 1):
            node, n, sig, keys = zip(*[long_signature(t, words) for t in b.column(1).to_pylist()], strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "node", "n", "sig", "keys"])

    signed = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(sign, "doc_id long, node long, n long, sig binary, keys array<long>")
    every = scratch.save(signed, "signatures")
    # equal sets are one node
    nodes = scratch.save(every.groupBy("node").agg(F.min("doc_id").alias("first"), *[F.min_by(c, "doc_id").alias(c) for c in ("n", "sig", "keys")]), "nodes")
    rows = nodes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    many = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("many"), F.sum("n").alias("total"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")).filter("many > 1")
    # band keys of the same sets are one
    once = many.groupBy("many", "total", "who").agg(F.min(F.struct("band", "key")).alias("k"))
    sizes = scratch.save(once.select("k.band", "k.key", F.greatest(F.ceil(F.col("many") / BLOCK), F.ceil(F.col("total") / BLOCK_VALUES)).alias("blocks")), "crowds")
    meeting = scratch.save(rows.join(sizes.select("band", "key"), ["band", "key"]).select("node", "band", "key"), "meeting")
    wanted = nodes.join(meeting.select("node").distinct(), "node", "left_semi").select(F.col("first").alias("doc_id"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, 0):
            made = [shingle_set(t, words) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([_set_key(h) for h in made], pa.int64()), pa.array([len(h) for h in made], pa.int64()), pa.array([h.view(np.int64) for h in made], pa.list_(pa.int64()))], names=["node", "n", "h"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi").select("text")
    made = texts.mapInArrow(make, "node long, n long, h array<long>")
    sets = scratch.save(made.join(nodes.select("node", "sig"), "node"), "sets")
    early = _linked(meeting.withColumn("label", F.col("node")), sizes, sets, similarity, own=True)
    # blocks of a crowd meet where links do not join all of it yet
    now = meeting.join(components(early), "node", "left").withColumn("label", F.coalesce("label", "node")).join(sizes.filter("blocks > 1").select("band", "key"), ["band", "key"])
    mixed = now.groupBy("band", "key").agg(F.min("label").alias("l"), F.max("label").alias("h")).filter("l < h").select("band", "key")
    late = _linked(now, sizes.join(mixed, ["band", "key"]), sets, similarity, own=False)
    label = components(early.unionByName(late))
    named = nodes.select("node", "first").join(label, "node", "left").select("node", "first", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    ids = named.join(least, "label").select("node", "component_id")
    out = scratch.save(every.select("doc_id", "node").join(ids, "node").groupBy("doc_id").agg(F.min("component_id").alias("component_id")), "similar")
    scratch.drop(every, nodes, sizes, meeting, sets, early, late)
    return out


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its group, with their columns. Rows that repeat such a doc_id stay."""
    found = similar_documents(docs, words, similarity)
    # few beside those that stay: as a table of known size they need not make the texts move
    gone = scratch.save(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone_id_")), "gone-ids")
    scratch.drop(found)
    return docs.join(gone, docs["doc_id"] == gone["gone_id_"], "left_anti")
