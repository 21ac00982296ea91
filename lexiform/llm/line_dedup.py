"""Line deduplication over range-partitioned hashes, with DataFrame functions only.

A line's key is the line without blanks at its ends and with A-Z lower-cased; its hash has 128 bits. Hashes are dealt by range and
sorted by document and position, so that a window streams each hash's occurrences and tells the first one of the hash and of
every document. A hash that holds more than a fixed share of all occurrences is dealt in salted parts, and what holds for all its
parts comes from an aggregation that is combined before it shuffles. What goes out are bitmaps, not texts: for each document the
64-line words in which lines are dropped.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiform.llm import scratch

BLANKS = " \t\n\x0b\x0c\r"
#: A hash is salted if it holds more than 1 / (PARTS x shuffle partitions) of all occurrences: never more hashes than that.
PARTS = 4
#: Lines of a bitmap's word.
WORD = 64
ID = ["doc_id", "t1", "t2"]


def key(line: Column) -> Column:
    """The line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.length(bare) == F.octet_length(bare), F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def _hashes(text: Column) -> list[Column]:
    """128 bits as two longs of different seeds."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, text): null texts are empty; the text's hash tells rows of one id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    t1, t2 = _hashes(text)
    return docs.select(F.col("doc_id"), t1.alias("t1"), t2.alias("t2"), text.alias("text"))


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, t1, t2, pos, h1, h2): the lines of ``docs`` whose keys have one code point at least."""
    lines = _identified(docs).select(*ID, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = lines.select(*ID, "pos", key(F.col("line")).alias("key")).filter("key <> ''")
    h1, h2 = _hashes(F.col("key"))
    return keyed.select(*ID, "pos", h1.alias("h1"), h2.alias("h2"))


def _hot(occ: DataFrame, limit: int) -> DataFrame:
    """(h1, h2, parts, all_docs, first): hashes of more than ``limit`` rows, with their documents and their first occurrence.
    As all rows are ``limit`` x PARTS x partitions, it has that many rows at most."""
    many = scratch.save(occ.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select("h1", "h2", F.ceil(F.col("n") / limit).alias("parts")), "hot-lines")
    of_doc = occ.join(F.broadcast(many), ["h1", "h2"]).groupBy("h1", "h2", *ID).agg(F.min("pos").alias("pos"))
    whole = of_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("all_docs"), F.min(F.struct(*ID, "pos")).alias("first"))
    out = scratch.save(many.join(F.broadcast(whole), ["h1", "h2"]), "hot-lines")
    scratch.drop(many)
    return out


def dropped(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """(doc_id, t1, t2, pos): lines whose key stands in ``min_docs`` documents or more; with ``keep_first`` the first one in the
    order of doc_id (null first), text hash and position stays."""
    occ = scratch.save(occurrences(docs), "lines")
    partitions = scratch.partitions(docs)
    limit = occ.count() // (PARTS * partitions) + 1
    hot = _hot(occ, limit)
    dealt = occ.join(F.broadcast(hot), ["h1", "h2"], "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*ID), F.col("parts"))))
    # a range of (h1, h2, part) keeps each such group in one partition: the window needs no other exchange
    group = ["h1", "h2", "part"]
    ranged = dealt.repartitionByRange(partitions, *group).sortWithinPartitions(*group, *ID, "pos")
    stream = Window.partitionBy(*group).orderBy(*ID, "pos")
    at, before = F.row_number().over(stream), F.lag(F.struct(*ID)).over(stream)
    seen = ranged.withColumn("at", at).withColumn("part_first", F.first(F.struct(*ID, "pos")).over(stream)).withColumn("opens", F.when((F.col("at") == 1) | ~before.eqNullSafe(F.struct(*ID)), 1).otherwise(0))
    told = seen.withColumn("n_docs", F.coalesce("all_docs", F.sum("opens").over(Window.partitionBy(*group))))
    # by value: rows that repeat a document share its first line
    is_first = F.struct(*ID, "pos").eqNullSafe(F.coalesce("first", "part_first"))
    gone = told.filter(F.col("n_docs") >= min_docs)
    return (gone.filter(~is_first) if keep_first else gone).select(*ID, "pos")


def bitmaps(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """(doc_id, t1, t2, drops): for each document that loses lines its bitmap, an array of (word, bits) in order of ``word``.

    Bit ``b`` of word ``w`` stands for line ``64 w + b`` (from 0); words that lose no line are left out, and so are documents that
    keep every line. A document is a row's id with its text: rows that repeat both are one. Null texts are one empty line; lines
    of blanks have no key and stay. Columns other than doc_id and text are not looked at; an empty table gives no rows.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD)
    words = dropped(docs, min_docs, keep_first).groupBy(*ID, (F.col("pos") / WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy(*ID).agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("drops"))


def _dense(drops: Column) -> Column:
    """All words up to the last that loses a line."""
    behind = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(drops, i - 1)["word"])
    return F.flatten(F.transform(drops, lambda w, i: F.concat(F.array_repeat(F.lit(0).cast("long"), w["word"] - behind(i) - 1), F.array(w["bits"]))))


def apply(docs: DataFrame, maps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): a row for each row of ``docs``, its text without the lines that ``maps`` drops."""
    rows, m = _identified(docs), maps.withColumnsRenamed({c: f"{c}_" for c in ID}).withColumn("words", _dense(F.col("drops")))
    # a document has one bitmap, so those are what a task holds, and texts stream past them without a sort
    met = rows.join(m.hint("shuffle_hash"), rows["doc_id"].eqNullSafe(m["doc_id_"]) & (rows["t1"] == m["t1_"]) & (rows["t2"] == m["t2_"]), "left")
    lines = F.split("text", "\n")
    # shifts take six bits of their distance; beyond the last word nothing is dropped
    stays = lambda _, i: F.coalesce(F.getbit(F.get("words", (i / WORD).cast("int")), i % WORD), F.lit(0)) == 0
    kept = F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, stays), "\n"))
    n_dropped = F.coalesce(F.aggregate("drops", F.lit(0).cast("long"), lambda a, w: a + F.bit_count(w["bits"])), F.lit(0))
    n_lines = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return met.select("doc_id", n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"), kept.alias("kept"))


def deduplicate(docs: DataFrame, min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """:func:`apply` with the :func:`bitmaps` of the same documents."""
    return apply(docs, bitmaps(docs, min_docs, keep_first))
