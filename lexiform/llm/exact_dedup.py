"""Exact deduplication over a sharded cuckoo-filter index.

Digests are dealt to shards. A shard's filter holds 16-bit fingerprints in buckets of four; the full digests stand in the
same buckets, and a hit counts only after the bucket's digests have been compared. Live digests can be deleted. A bucket pair
that overflows makes the filter double, rebuilt from the stored digests.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiform.llm import scratch

SLOTS = 4
KICKS = 200
#: Live digests that a map task holds before it hands them on, and that a shard is planned for.
HELD = 100_000
SHARD = 250_000
BLANKS = " \t\n\x0b\x0c\r"


class CuckooIndex:
    """Digests (bytes, 8 or more, evenly spread) to payloads, behind a cuckoo filter."""

    def __init__(self, buckets: int = 64):
        self._start(1 << max(2, (buckets - 1).bit_length()))
        #: Digests of which more share both buckets than fit: no size of the filter would part them.
        self.stash: dict[bytes, list] = {}
        self.hits = self.verified = self.resizes = 0

    def _start(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.marks = [0] * (buckets * SLOTS)
        self.stored: list[list | None] = [None] * (buckets * SLOTS)
        self.size = 0

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & self.mask

    def _find(self, digest: bytes) -> int:
        mark, a, b = self._places(digest)
        for bucket in (a, b) if a != b else (a,):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.marks[slot] == mark:
                    self.hits += 1
                    if self.stored[slot][0] == digest:
                        self.verified += 1
                        return slot
        return -1

    def get(self, digest: bytes):
        slot = self._find(digest)
        if slot < 0:
            return self.stash[digest][1] if digest in self.stash else None
        return self.stored[slot][1]

    def insert(self, digest: bytes, payload) -> bool:
        """Whether the digest is new. A live digest's payload is replaced."""
        slot = self._find(digest)
        if slot >= 0:
            self.stored[slot][1] = payload
            return False
        if digest in self.stash:
            self.stash[digest][1] = payload
            return False
        self._place([digest, payload])
        return True

    def delete(self, digest: bytes) -> bool:
        """Whether the digest was live."""
        slot = self._find(digest)
        if slot < 0:
            return self.stash.pop(digest, None) is not None
        self.marks[slot], self.stored[slot] = 0, None
        self.size -= 1
        return True

    def _place(self, entry: list) -> None:
        mark, a, b = self._places(entry[0])
        bucket = a
        for kick in range(KICKS):
            for at in (a, b) if not kick else (bucket,):
                for slot in range(at * SLOTS, at * SLOTS + SLOTS):
                    if not self.marks[slot]:
                        self.marks[slot], self.stored[slot] = mark, entry
                        self.size += 1
                        return
            slot = (bucket if kick else b) * SLOTS + kick % SLOTS
            home = slot // SLOTS
            mark, self.marks[slot] = self.marks[slot], mark
            entry, self.stored[slot] = self.stored[slot], entry
            bucket = self._other(home, mark)
        self._grow(entry)

    def _grow(self, homeless: list) -> None:
        """Twice the buckets, filled again from the stored digests; a filter that is nearly empty needs no more of them."""
        if self.size * 4 < len(self.marks):
            self.stash[homeless[0]] = homeless
            return
        entries = [e for e in self.stored if e is not None]
        self._start(2 * (self.mask + 1))
        self.resizes += 1
        for e in entries:
            self._place(e)
        self._place(homeless)

    def items(self) -> Iterator[tuple[bytes, object]]:
        return ((e[0], e[1]) for entries in (self.stored, self.stash.values()) for e in entries if e is not None)


#: Ids of several rows are broadcast up to this number, joined beyond it.
FEW = 100_000


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def thin(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, points): SHA-256 of the normalised text and the code points of the original, all in the JVM."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256)).alias("digest"), F.length(text).cast("long").alias("points"))


def _rank(points: int, doc_id: int | None) -> tuple:
    return points, doc_id is not None, -(doc_id or 0)


def _merge(index: CuckooIndex, digest: bytes, n: int, points: int, doc_id: int | None) -> None:
    """Signed count and best row of a digest. At a count of zero or below the digest leaves the index."""
    had = index.get(digest)
    if had is None:
        if n > 0:
            index.insert(digest, [n, points, doc_id])
        return
    had[0] += n
    if had[0] <= 0:
        index.delete(digest)
    elif n > 0 and _rank(points, doc_id) > _rank(*had[1:]):
        had[1:] = [points, doc_id]


_SCHEMA = "digest binary, n long, points long, doc_id long"


def _rows(entries: list[tuple[bytes, list]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d for d, _ in entries], pa.binary()), *(pa.array([p[k] for _, p in entries], pa.int64()) for k in range(3))], names=["digest", "n", "points", "doc_id"])


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of what one task reads, in an index of bounded size: a hot group leaves the task as a few rows."""
    index = CuckooIndex()
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            _merge(index, *row)
        if index.size > HELD:
            yield _rows(list(index.items()))
            index = CuckooIndex()
    yield _rows(list(index.items()))


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index = CuckooIndex()
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
            _merge(index, *row)
    entries = list(index.items())
    for at in range(0, len(entries), 10_000):
        yield _rows(entries[at : at + 10_000])


def live_index(rows: DataFrame, shards: int) -> DataFrame:
    """(digest, n, points, doc_id): the live digests after insertion of all ``rows`` (doc_id, digest, points)."""
    scratch.ship(rows.sparkSession)
    inserts = rows.select("digest", F.lit(1).cast("long").alias("n"), "points", "doc_id")
    return inserts.mapInArrow(_combine, _SCHEMA).repartition(shards, "digest").mapInArrow(_shard, _SCHEMA)


def apply_deletes(index: DataFrame, deletes: DataFrame, shards: int) -> DataFrame:
    """The index without the digests of ``deletes``: whole groups leave; digests that are not live change nothing."""
    scratch.ship(index.sparkSession)
    gone = deletes.select("digest").distinct()
    # a stored digest comes before its deletion within its shard
    both = index.select("digest", "n", "points", "doc_id", F.lit(0).alias("k")).unionByName(gone.select("digest", F.lit(-(1 << 62)).cast("long").alias("n"), F.lit(0).cast("long").alias("points"), F.lit(0).cast("long").alias("doc_id"), F.lit(1).alias("k")))
    dealt = both.repartition(shards, "digest").sortWithinPartitions("k").select("digest", "n", "points", "doc_id")
    return dealt.mapInArrow(_shard, _SCHEMA)


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, digest, keep_id, group_size, kept: a row for each row of ``docs``.

    Of equal texts (null: empty) the row with the most code points stays, then the smallest doc_id, null ones last. Rows that
    repeat a doc_id are members of their groups each and are kept or dropped together. Other columns are not looked at; no
    rows give no rows.
    """
    rows = scratch.save(thin(docs), "digests")
    shards = max(scratch.partitions(docs), -(-rows.count() // SHARD))
    index = live_index(rows, shards)
    best = index.select("digest", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size"))
    return rows.join(best, "digest").select("doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns: one of each group.

    A doc_id of one row is kept or dropped by that id alone. Of rows that repeat a doc_id, those of one digest are told apart
    by the hash of all their columns: the smallest stays; null ids count as one that repeats.
    """
    judged = scratch.save(deduplicate(docs), "judged")
    ids = judged.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("again_"), F.bool_or("kept").alias("kept_")).withColumn("again_", F.col("again_") | F.col("doc_id").isNull())
    # ids that go, few beside those that stay, and ids of several rows, hardly any: tables of known size
    gone = scratch.save(ids.filter("again_ or not kept_").filter("doc_id is not null").select(F.col("doc_id").alias("gone_id_")), "gone-ids")
    several = scratch.save(ids.filter("again_ and kept_").select(F.col("doc_id").alias("several_id_")), "several-ids")
    own = docs["doc_id"].cast("long")
    single = docs.filter(own.isNotNull()).join(gone, own == gone["gone_id_"], "left_anti")
    again = docs.join(F.broadcast(several) if several.count() <= FEW else several, own.eqNullSafe(several["several_id_"]), "left_semi")
    digest = F.unhex(F.sha2(F.encode(normalised(F.col("text")), "UTF-8"), 256))
    rows = again.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row_"), own.alias("id_"), digest.alias("digest_"), F.length(F.coalesce("text", F.lit(""))).alias("points_"))
    stay = judged.filter("kept").select(F.col("doc_id").alias("stay_id_"), F.col("digest").alias("stay_digest_")).distinct()
    met = rows.join(stay, F.col("id_").eqNullSafe(F.col("stay_id_")) & (F.col("digest_") == F.col("stay_digest_")), "left_semi")
    # equal hashes: equal rows
    first = met.groupBy("id_", "digest_").agg(F.min_by("row_", F.struct((-F.col("points_")).alias("p"), F.xxhash64(F.to_json("row_")).alias("h"))).alias("row_"))
    return single.unionByName(first.select("row_.*"))
