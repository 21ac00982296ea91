"""Language-model scores by context-tree weighting over bytes.

The scored form of a text is that of its tokens: A-Z in lower case, words with single blanks between them, and an end. The
tree holds every context of up to ``DEPTH`` bytes that the training texts have, however rare, so it grows with the corpus and
no machine holds all of it:

1. Map tasks take up chunks of texts and write, for each chunk, its distinct windows of ``DEPTH + 1`` bytes with their training
   counts and its distinct words with theirs, dealt into shards by the three latest context bytes (words: by hash).
2. Each shard adds up the counts of its windows. Whole subtrees lie in one shard, so it can weight them. What the two upper
   depths need, sums by context of two bytes and decision, is a bounded table (65,536 x 511 numbers at most, a few thousand
   contexts in text) that the driver works on and broadcasts.
3. Each shard takes in the chunks' windows again and answers with their log probabilities and word counts.
4. Each chunk meets its answers and scores its texts.

What moves are sorted integers as compressed differences, about a third of the text's size, and the text once. A chunk takes
up CHUNK_BYTES of text (or one longer text), a shard the distinct windows below its three-byte contexts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.llm import grams, scratch
from lexiform.llm.context_tree import Subtree, merged

DEPTH = 6
#: Contexts of fewer bytes than this are weighted on the driver.
TOP = 3
END = b"\n"
LEAD = END * DEPTH
CHUNK_BYTES = 20_000_000
#: Text that a shard is planned for, and windows of a row of its table: cells stay far below what Arrow and the JVM can hold.
SHARD_BYTES, PIECE = 64_000_000, 2_000_000
#: Windows that wait to be added up.
PENDING = 1_500_000
WINDOWS, WORDS, TEXT = 0, 1, 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def held_out() -> Column:
    """Null ids count as empty text here."""
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7) == 2


def _word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))


def windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(windows, number of the text) of every byte of the texts, in pieces of bounded size."""
    for data, owner, lead in grams.streams(texts, LEAD):
        n = len(data) - lead
        keys = np.zeros(n, np.uint64)
        for back in range(1, DEPTH + 1):
            keys <<= np.uint64(8)
            keys |= data[lead - back : lead - back + n]
        keys <<= np.uint64(8)
        keys |= data[lead:]
        own = owner[lead:]
        keep = own >= 0
        yield keys[keep], own[keep]


def pack(x: np.ndarray, ordered: bool = False) -> bytes:
    """Numbers as compressed byte planes, of their differences if they are in order."""
    x = np.ascontiguousarray(np.diff(x, prepend=x.dtype.type(0)) if ordered and len(x) else x)
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes() if len(x) else b"", 1)


def unpack(b: bytes, kind: type, ordered: bool = False) -> np.ndarray:
    size = np.dtype(kind).itemsize
    x = np.ascontiguousarray(np.frombuffer(zstandard.decompress(b), np.uint8).reshape(size, -1).T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if ordered else x


def _union(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of both with their counts added up; those of ``a`` may be changed."""
    (keys, counts), (more, n) = a, b
    at = np.searchsorted(keys, more)
    met = at < len(keys)
    met[met] = keys[at[met]] == more[met]
    counts[at[met]] += n[met]
    at, more, n = at[~met], more[~met], n[~met]
    if not len(more):
        return keys, counts
    at += np.arange(len(at))
    old = np.ones(len(keys) + len(more), bool)
    old[at] = False
    out = []
    for x, y in ((keys, more), (counts, n)):
        z = np.empty(len(old), x.dtype)
        z[at], z[old] = y, x
        out.append(z)
    return out[0], out[1]


class _Sums:
    """Distinct keys with counts; what waits is added up when it is much, beside what is held."""

    def __init__(self, kind: type = np.int64) -> None:
        self.held = np.zeros(0, np.uint64), np.zeros(0, kind)
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(PENDING, len(self.held[0]) // 4):
            self._settle()

    def _settle(self) -> None:
        keys, counts = merged(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts])) if len(self.parts) > 1 else self.parts[0]
        self.parts, self.waiting = [], 0
        self.held = _union(self.held, (keys, counts.astype(self.held[1].dtype)))

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self.parts:
            self._settle()
        return self.held


def _distinct(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.concatenate(pieces)
    x.sort()
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), x[1:] != x[:-1]]))
    return x[first], np.diff(np.append(first, len(x)))


def _shards(keys: np.ndarray, kind: int, shards: int) -> np.ndarray:
    part = keys >> np.uint64(8 * (DEPTH + 1 - TOP)) if kind == WINDOWS else keys
    return ((part * _MIX >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _by_shard(keys: np.ndarray, counts: np.ndarray, kind: int, shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sorted keys with their counts by shard. Windows of one shard are whole runs of them, which are cut out as they are."""
    if kind == WINDOWS:
        top = keys >> np.uint64(8 * (DEPTH + 1 - TOP))
        first = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), top[1:] != top[:-1]]))
        del top
    else:
        first = np.arange(len(keys))
    where, ends = _shards(keys[first], kind, shards), np.append(first[1:], len(keys))
    by = np.argsort(where, kind="stable")
    cuts = np.searchsorted(where[by], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(cuts)):
        runs = by[cuts[s] : cuts[s + 1]]
        if kind == WINDOWS:
            pairs = [slice(a, b) for a, b in zip(first[runs].tolist(), ends[runs].tolist(), strict=True)]
            yield int(s), np.concatenate([keys[r] for r in pairs]), np.concatenate([counts[r] for r in pairs])
        else:
            yield int(s), keys[runs], counts[runs]


_CHUNKS = "chunk long, shard int, kind tinyint, keys binary, vals binary"


def _rows(schema: list[str], rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"chunk": pa.int64(), "shard": pa.int32(), "kind": pa.int8(), "total": pa.int64(), "many": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.binary())) for n, c in zip(schema, zip(*rows, strict=True), strict=True)], names=schema)


def chunks(docs: DataFrame, shards: int, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Step 1. ``vals`` are counts; in rows of kind TEXT, ``keys`` is the text and ``vals`` the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        names = ["chunk", "shard", "kind", "keys", "vals"]

        def out(forms: list[bytes], learn: list[bool], ids: list[int | None], words: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
            sums = _Sums(np.uint32)  # a chunk is less than 4 GB
            for wanted in (True, False):
                waiting: list[np.ndarray] = []
                texts = [f for f, w in zip(forms, learn, strict=True) if w == wanted]
                for keys, _ in windows(texts) if texts else ():
                    waiting.append(keys)
                    if len(waiting) >= 8:
                        k, c = _distinct(waiting)
                        sums.add(k, c * wanted)
                        waiting = []
                if waiting:
                    k, c = _distinct(waiting)
                    sums.add(k, c * wanted)
            known = list(words)
            at = _word_keys(known)
            order = np.argsort(at)
            for kind, keys, counts in ((WINDOWS, *sums.whole()), (WORDS, at[order], np.fromiter(words.values(), np.int64, len(words))[order])):
                for s, k, c in _by_shard(keys, counts, kind, shards):
                    yield _rows(names, [(number, s, kind, pack(k, True), pack(c.astype(np.uint64)))])
            del sums
            numbers = np.array([i or 0 for i in ids], np.int64).tobytes() + np.array([i is None for i in ids], np.uint8).tobytes()
            yield _rows(names, [(number, 0, TEXT, zstandard.compress(b"".join(forms), 3), numbers)])

        forms, learn, ids, held = [], [], [], 0
        words: dict[bytes, int] = Counter()
        for b in scratch.slices(batches, 1):
            for i, t, h in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                ws = [*words_of(t), END]
                if h:
                    for w in ws:
                        words.setdefault(w, 0)
                else:
                    words.update(ws)
                forms.append(b" ".join(ws[:-1]) + END)
                learn.append(not h)
                ids.append(i)
                held += len(forms[-1])
                if held >= chunk_bytes:
                    yield from out(forms, learn, ids, words)
                    forms, learn, ids, held = [], [], [], 0
                    words = Counter()
                    number += 1
        if forms:
            yield from out(forms, learn, ids, words)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out")).mapInArrow(run, _CHUNKS)


_MERGED = "shard int, kind tinyint, keys binary, vals binary, total long, many long, roots binary, weights binary, pairs binary, counts binary"


def merge(parts: DataFrame, shards: int) -> DataFrame:
    """Step 2: sums of a shard, in rows of PIECE keys, and in the first of them what the upper depths need of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], _Sums] = {}
        for b in batches:
            for s, kind, k, c in zip(*(b.column(n).to_pylist() for n in ("shard", "kind", "keys", "vals")), strict=True):
                sums.setdefault((s, kind), _Sums()).add(unpack(k, np.uint64, True), unpack(c, np.uint64).astype(np.int64))
        for (s, kind), of in sums.items():
            keys, counts = of.whole()
            upper = [b""] * 4
            if kind == WINDOWS:
                tree = Subtree(keys, counts, TOP, DEPTH)
                names, weights = tree.roots()
                short = tree.keys[TOP]
                pairs, n = merged((short >> np.uint64(16) << np.uint64(8)) | (short & np.uint64(255)), tree.counts[TOP])
                upper = [pack(names, True), weights.tobytes(), pack(pairs, True), pack(n.astype(np.uint64))]
            for at in range(0, max(len(keys), 1), PIECE):
                k, c = keys[at : at + PIECE], counts[at : at + PIECE]
                yield _rows([n.split()[0] for n in _MERGED.split(", ")], [(s, kind, pack(k, True), pack(c.astype(np.uint64)), int(c.sum()), int((c > 0).sum()), *(upper if at == 0 else [None] * 4))])

    return parts.filter(F.col("kind") < TEXT).select("shard", "kind", "keys", "vals").repartitionById(shards, "shard").mapInArrow(run, _MERGED)


def upper(sums: DataFrame) -> tuple[np.ndarray, ...] | None:
    """The states that the contexts of two bytes hand down: a bounded table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for names, weights, pairs, counts in zip(*(b.column(n).to_pylist() for n in ("roots", "weights", "pairs", "counts")), strict=True):
                for kind, k, v in ((0, unpack(names, np.uint64, True), np.frombuffer(weights)), (1, unpack(pairs, np.uint64, True), unpack(counts, np.uint64).astype(np.float64))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int8)), pa.array(k.view(np.int64)), pa.array(v)], names=["kind", "name", "v"])

    rows = sums.filter((F.col("kind") == WINDOWS) & F.col("roots").isNotNull()).select("roots", "weights", "pairs", "counts").mapInArrow(run, "kind tinyint, name long, v double")
    got = rows.groupBy("kind", "name").agg(F.sum("v").alias("v")).toArrow()
    kind, name, v = (got.column(n).to_numpy() for n in ("kind", "name", "v"))
    if not len(name):
        return None
    order = np.argsort(name)
    kind, name, v = kind[order], name[order].view(np.uint64), v[order]
    tree = Subtree(name[kind == 1], np.rint(v[kind == 1]).astype(np.int64), 0, TOP - 1)
    return tree.states((name[kind == 0], v[kind == 0]))


def answers(parts: DataFrame, sums: DataFrame, states: tuple[np.ndarray, ...] | None, shards: int) -> DataFrame:
    """Step 3: for a chunk's keys in a shard, log probabilities (windows) or counts (words)."""
    shared = parts.sparkSession.sparkContext.broadcast(states)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        pieces: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}

        def table(of: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
            """A shard's keys and their answers, made when the first chunk asks; its rows have all come by then."""
            if of not in tables:
                parts = sorted(pieces.pop(of), key=lambda p: int(p[0][0]) if len(p[0]) else 0)
                keys, counts = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts, strict=True))
                tables[of] = keys, (Subtree(keys, counts, TOP, DEPTH).logs(shared.value).astype(np.float32) if of[1] == WINDOWS else counts.astype(np.float64))
            return tables[of]

        for b in batches:
            for first, chunk, s, kind, k, v in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                keys = unpack(k, np.uint64, True)
                if first == 0:
                    pieces.setdefault((s, kind), []).append((keys, unpack(v, np.uint64).astype(np.int64)))
                else:
                    at, vals = table((s, kind))
                    yield _rows(["chunk", "shard", "kind", "keys", "vals"], [(chunk, s, kind, k, pack(vals[np.searchsorted(at, keys)]))])

    old = parts.filter(F.col("kind") < TEXT).select(F.lit(1).alias("first"), "chunk", "shard", "kind", "keys", F.lit(None).cast("binary").alias("vals"))
    new = sums.select(F.lit(0).alias("first"), F.lit(-1).cast("long").alias("chunk"), "shard", "kind", "keys", "vals")
    return new.union(old).repartitionById(shards, "shard").sortWithinPartitions("first").mapInArrow(run, _CHUNKS)


class Lookup:
    """Values of keys that are all known, by hashing; keys that meet in a slot are looked up in the next table."""

    def __init__(self, keys: np.ndarray, vals: np.ndarray):
        self.tables = []
        for factor in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9):
            bits = max(4, int(3 * len(keys)).bit_length())
            factor, shift = np.uint64(factor), np.uint64(64 - bits)
            slot = (keys * factor >> shift).astype(np.int64)
            last, number = np.empty(1 << bits, np.int32), np.arange(len(keys), dtype=np.int32)
            last[slot] = number
            met = slot[last[slot] != number]
            del last
            table = np.full(1 << bits, np.nan, np.float32)
            table[slot] = vals
            table[met] = np.nan
            self.tables.append((factor, shift, table))
            left = np.isnan(table[slot])
            keys, vals = keys[left], vals[left]
        order = np.argsort(keys)
        self.keys, self.vals = keys[order], vals[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        factor, shift, table = self.tables[0]
        out = table[keys * factor >> shift]
        left = np.flatnonzero(np.isnan(out))
        for factor, shift, table in self.tables[1:]:
            out[left] = table[keys[left] * factor >> shift]
            left = left[np.isnan(out[left])]
        if len(left):
            out[left] = self.vals[np.searchsorted(self.keys, keys[left])]
        return out


_SCORED = "id long, n long, known long, n_bytes long, base double, lm double"


def scored(parts: DataFrame, answered: DataFrame) -> DataFrame:
    """Step 4. ``base``: sum of log10(c + 1)."""

    def texts(text: bytes, ids: bytes, found: dict[int, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        forms = [f + END for f in zstandard.decompress(text).split(END)[:-1]]
        n = len(forms)
        numbers, null = np.frombuffer(ids[: 8 * n], np.int64), np.frombuffer(ids[8 * n :], np.uint8) > 0
        logs = Lookup(*(np.concatenate(x) for x in zip(*found[WINDOWS], strict=True)))
        lm = np.zeros(n)
        for keys, own in windows(forms):
            first = int(own[0])
            sums = np.bincount(own - first, logs(keys).astype(np.float64))
            lm[first : first + len(sums)] += sums
        del logs
        keys, vals = (np.concatenate(x) for x in zip(*found[WORDS], strict=True))
        order = np.argsort(keys)
        keys, vals = keys[order], np.log10(vals[order] + 1.0)
        distinct: set[bytes] = {END}
        for f in forms:
            distinct.update(f.split())
        distinct_list = list(distinct)
        gain = dict(zip(distinct_list, vals[np.searchsorted(keys, _word_keys(distinct_list))].tolist(), strict=True))
        size, known, base = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
        for i, f in enumerate(forms):
            got = [gain[w] for w in f.split()]
            got.append(gain[END])
            size[i], known[i], base[i] = len(got), len(got) - got.count(0.0), sum(got)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, mask=null), *(pa.array(x) for x in (size, known, np.fromiter(map(len, forms), np.int64, n), base, lm / np.log(10)))],
            names=["id", "n", "known", "n_bytes", "base", "lm"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WINDOWS: [], WORDS: []}
        for b in batches:
            for kind, k, v in zip(*(b.column(n) for n in ("kind", "keys", "vals")), strict=True):
                kind, k, v = kind.as_py(), k.as_py(), v.as_py()
                if kind == TEXT:
                    yield from texts(k, v, found)
                    pa.default_memory_pool().release_unused()
                    found = {WINDOWS: [], WORDS: []}
                else:
                    found[kind].append((unpack(k, np.uint64, True), unpack(v, np.float32 if kind == WINDOWS else np.float64)))

    both = answered.union(parts.filter(F.col("kind") == TEXT))
    return both.repartition(scratch.partitions(parts), "chunk").sortWithinPartitions("chunk", "kind").select("kind", "keys", "vals").mapInArrow(run, _SCORED)


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte: a row for each row of ``docs``.

    ``score``: log10 of the probability of the token form of the text; ``bits_per_byte``: its code length by bytes of that form,
    end included. Null texts count as empty: one end. Null ids count as empty text where rows are told apart, and stay null.
    Repeated rows are learned from and scored each time. Other columns are not looked at. Without training rows every byte has
    probability 1/256 and every token the base probability 1.
    """
    scratch.ship(docs.sparkSession)
    # the corpus decides how many shards there are, as a shard's table stands in one task's memory
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(scratch.partitions(docs), -(-size // SHARD_BYTES))
    parts = scratch.save(chunks(docs, shards, chunk_bytes), "ctw-chunks")
    sums = scratch.save(merge(parts, shards), "ctw-sums")
    words = sums.filter(F.col("kind") == WORDS).agg(F.sum("total").alias("n"), F.sum("many").alias("v")).first()
    n, v = int(words["n"] or 0), int(words["v"] or 0)
    out = scored(parts, answers(parts, sums, upper(sums), shards))
    return out.select(
        F.col("id").alias("doc_id"),
        ((F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))) % 7) == 2).alias("held_out"),
        F.col("n").alias("n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        F.col("lm").alias("score"),
        (-F.col("lm") / F.lit(float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"),
    )
