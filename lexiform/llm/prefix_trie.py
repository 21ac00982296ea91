"""Trie of conversation prefixes: shared beginnings of conversations, and the tokens that sharing them would save.

Each turn has a SHA-256 of its role and text, made where the texts lie; a conversation's prefix of d turns has the chained digest
SHA-256(digest of d - 1 turns, turn). Every prefix is a row, and rows of one (depth, digest) are a node, named by its smallest
member. A member that has the smallest id of one node of its path has it of all deeper ones, so the nodes that are named after one
conversation are a run at the end of its path. Sums over subtrees explode to ancestors: a run is added up within itself first and
then goes to each ancestor above it, so a conversation of n turns makes n rows and not their square.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.llm import scratch

WORD = r"[^\x20\x09-\x0D]+"
ROOT = hashlib.sha256(b"").digest()
#: Ids of 2^CHUNK consecutive integers are one text of a node's list.
CHUNK = 13
NODE = ["depth", "digest"]


def turns(rows: DataFrame) -> DataFrame:
    """(conv, idx, turn_digest, words): turns of each conversation numbered from 1 in the order of ``turn`` (null first); ties
    go by role and text. Null roles and texts are empty; rows without a conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the role's length keeps ("ab", "c") apart from ("a", "bc")
    digest = F.unhex(F.sha2(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256))
    thin = rows.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"), role.alias("role"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), digest.alias("turn_digest"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "turn_digest")
    return thin.select("conv", F.row_number().over(order).alias("idx"), "turn_digest", "words")


def rebuilt(numbered: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """(conv, idx, turn_digest, words): conversation c begins with the first h turns of c - c % ``every`` and goes on with its own
    after its first h; h is the CRC-32 of c modulo ``heads``. Each conversation has a row of idx 0 without a turn."""
    head = (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % heads).cast("int")
    convs = numbered.select("conv").distinct().select("conv", head.alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    none = convs.select("conv", F.lit(0).alias("idx"), F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("long").alias("words"))
    first = numbered.filter((F.col("conv") % every == 0) & (F.col("idx") < heads)).withColumnRenamed("conv", "base")
    begun = convs.join(first, "base").filter("idx <= h").select("conv", "idx", "turn_digest", "words")
    own = numbered.withColumn("h", head).filter("idx > h").select("conv", "idx", "turn_digest", "words")
    return none.unionByName(begun).unionByName(own)


def plain(numbered: DataFrame) -> DataFrame:
    """(conv, idx, turn_digest, words): conversations as they are, each with a row of idx 0 without a turn."""
    none = numbered.select("conv").distinct().select("conv", F.lit(0).alias("idx"), F.lit(None).cast("binary").alias("turn_digest"), F.lit(0).cast("long").alias("words"))
    return none.unionByName(numbered.select("conv", "idx", "turn_digest", "words"))


_PREFIX = "conv long, depth int, digest binary, parent binary, words long, last boolean"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chained digests of rows in order of (conv, idx). One row is held back, as only the next one tells whether it is the last of
    its conversation; nothing else is kept."""
    held, conv, depth, digest = None, None, 0, ROOT

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["conv", "depth", "digest", "parent", "words", "last"])

    for b in batches:
        out = []
        for c, turn, words in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            if held is not None:
                out.append((*held, c != conv))
            if c != conv:
                conv, depth, digest, parent = c, 0, ROOT, None
            else:
                depth, digest, parent = depth + 1, hashlib.sha256(digest + turn).digest(), digest
            held = (conv, depth, digest, parent, words)
        yield batch(out)
    if held is not None:
        yield batch([(*held, True)])


def prefixes(sequences: DataFrame) -> DataFrame:
    """(conv, depth, digest, parent, words, last): a row for each prefix of every conversation, the empty one included."""
    scratch.ship(sequences.sparkSession)
    dealt = sequences.repartition(scratch.partitions(sequences), "conv").sortWithinPartitions("conv", "idx")
    return dealt.select("conv", "turn_digest", "words").mapInArrow(_chain, _PREFIX)


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's comma-joined ids, from texts in order; one hash is open at a time."""
    key, h = None, None
    for b in batches:
        keys, sums = [], []
        for depth, digest, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (depth, digest) != key:
                if key is not None:
                    keys.append(key)
                    sums.append(h.hexdigest())
                key, h = (depth, digest), hashlib.sha256()
            else:
                h.update(b",")
            h.update(text.encode())
        yield _sums(keys, sums)
    if key is not None:
        yield _sums([key], [h.hexdigest()])


def _sums(keys: list[tuple], sums: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.binary()), pa.array(sums, pa.string())], names=["depth", "digest", "ends_sha256"])


def ends(rows: DataFrame) -> DataFrame:
    """(depth, digest, ends_sha256): hash of the ids of conversations that end at a node, in numeric order.

    A hash is made by one task, so a hot node's ids reach it as texts of up to 2^13 ids that others have put together."""
    chunk = F.shiftright("conv", CHUNK)
    listed = rows.filter("last").groupBy(*NODE, chunk.alias("chunk")).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    dealt = listed.repartition(scratch.partitions(rows), *NODE).sortWithinPartitions(*NODE, "chunk")
    return dealt.select(*NODE, "ids").mapInArrow(_digest_lists, "depth int, digest binary, ends_sha256 string")


def _sum0(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("long")


def nodes(rows: DataFrame) -> DataFrame:
    """A row for each node of :func:`prefixes`: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, all but the last long."""
    merged = rows.groupBy(*NODE).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.min("parent").alias("parent"), F.max("words").alias("words"))
    own = scratch.save(merged.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-nodes")
    # the run of each conversation: where it begins, where it ends and what it saves
    runs = own.groupBy("conv").agg(F.min("depth").alias("top"), F.max_by("digest", "depth").alias("deepest"), F.max("depth").alias("bottom"), F.sum("saved").alias("saved"), F.min_by("parent", "depth").alias("hangs"))
    hung = runs.filter("top > 0").groupBy((F.col("top") - 1).alias("depth"), F.col("hangs").alias("digest")).agg(F.count(F.lit(1)).alias("hung"))
    # a run's deepest node is a leaf unless other runs hang from it; its other nodes are none
    by_end = runs.join(hung.select(F.col("depth").alias("bottom"), F.col("digest").alias("deepest"), "hung"), ["bottom", "deepest"], "left")
    runs = scratch.save(by_end.select("conv", "top", "bottom", "saved", F.when(F.col("hung").isNull(), 1).otherwise(0).cast("long").alias("leaf")), "trie-runs")
    above = rows.select("conv", *NODE).join(runs.filter("top > 0").select("conv", "top", "saved", "leaf"), "conv").filter("depth < top")
    below = above.groupBy(*NODE).agg(F.sum("saved").alias("saved_below"), F.sum("leaf").alias("leaves_below"), F.count_if(F.col("depth") == F.col("top") - 1).alias("hung"))
    down = Window.partitionBy("conv").orderBy(F.desc("depth"))
    summed = own.withColumn("saved_run", F.sum("saved").over(down)).join(runs.select("conv", "top", "bottom", "leaf"), "conv")
    told = summed.join(below, NODE, "left").join(ends(rows), NODE, "left")
    named = told.select(
        "conv", "depth", "parent", "top", "n_convs",
        (_sum0("hung") + F.when(F.col("depth") < F.col("bottom"), 1).otherwise(0)).cast("long").alias("n_children"),
        (F.col("leaf") + _sum0("leaves_below")).alias("n_leaves"),
        (F.col("saved_run") + _sum0("saved_below")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(ROOT.hex())).alias("ends_sha256"),
    )
    # within a run the parent has the same name; only the run's top looks it up
    inner = named.filter("depth > top or depth = 0").withColumn("parent_conv_id", F.when(F.col("depth") > F.col("top"), F.col("conv")))
    tops = named.filter("depth = top and depth > 0")
    names = own.select((F.col("depth") + 1).alias("depth"), F.col("digest").alias("parent"), F.col("conv").alias("parent_conv_id"))
    whole = inner.unionByName(tops.join(names, ["depth", "parent"], "left"))
    return whole.select(F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame, every: int | None = None, heads: int = 4) -> DataFrame:
    """The nodes of the trie of ``conversations`` (conv_id, turn, role, text), rebuilt if ``every`` is given.

    The root has depth 0 and no parent. Conversations without turns are members of the root alone. Repeated rows are turns each;
    other columns are not looked at; an empty table has no nodes. A conversation's digests follow one another and are made by one
    task, a turn at a time, whatever its length.
    """
    numbered = scratch.save(turns(conversations), "trie-turns")
    rows = scratch.save(prefixes(plain(numbered) if every is None else rebuilt(numbered, every, heads)), "trie-prefixes")
    return nodes(rows)
