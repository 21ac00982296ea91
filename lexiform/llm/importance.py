"""Target-distribution importance resampling of documents by hashed word features.

A byte automaton without a loop over characters: the bytes of an Arrow batch's UTF-8 buffer are classified by one lookup, words
begin and end where the class changes, and the CRCs of all words advance by one byte at a time together. Buckets are counted in
every task and added up by bucket, so that two tables of ``BUCKETS`` numbers are all that the corpus and the target come to.
A document's weight is its mean gain; Gumbel noise of its id makes the highest scores a sample without replacement. Ranks come
from a histogram of the whole-numbered scores, not from a sort of all documents.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiform.llm import scratch

BUCKETS = 10_000
#: Bytes of a word that all words take together; what is left of longer ones is handed to zlib, one word at a time.
TOGETHER = 64
#: Gains and scores are thousandths.
SCALE = 1000


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte's lower-case form (0: no byte of a word), and the steps of the reflected CRC-32 (fixed polynomial)."""
    low = np.zeros(256, np.uint8)
    low[0x30:0x3A], low[0x61:0x7B], low[0x80:] = np.arange(0x30, 0x3A), np.arange(0x61, 0x7B), np.arange(0x80, 0x100)
    low[0x41:0x5B] = np.arange(0x61, 0x7B)
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, np.uint32(0xEDB88320) ^ (crc >> np.uint32(1)), crc >> np.uint32(1))
    return low, crc


LOW, CRC = _tables()


def _advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC registers of all words after their own bytes."""
    state = state.copy()
    live = np.flatnonzero(lengths > 0)
    for k in range(TOGETHER):
        if not live.size:
            return state
        s = state[live]
        state[live] = CRC[(s ^ data[starts[live] + k]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
        live = live[lengths[live] > k + 1]
    for i in live:
        rest = data[starts[i] + TOGETHER : starts[i] + lengths[i]]
        state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def features(column: pa.Array, orders: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(row, crc) of each run of 1 to ``orders`` consecutive words of the texts, repeats included. Null texts have none."""
    texts = column.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = LOW[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]] if len(texts) else LOW[:0]
    ends = ends - ends[0] if len(texts) else ends
    if texts.null_count:  # what stands below a null is not defined
        for i in np.flatnonzero(pc.is_null(texts).to_numpy(zero_copy_only=False)):
            data[ends[i] : ends[i + 1]] = 0
    inside = data != 0
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    # a word ends with its text, even if the next one goes on at once
    cuts = np.unique(ends[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    opens[cuts] |= inside[cuts]
    closes[cuts - 1] |= inside[cuts - 1]
    starts = np.flatnonzero(opens)
    lengths = np.flatnonzero(closes) - starts + 1
    row = np.searchsorted(ends[1:], starts, side="right")
    state = _advance(np.full(starts.size, 0xFFFFFFFF, np.uint32), data, starts, lengths)
    rows, crcs = [row], [state ^ np.uint32(0xFFFFFFFF)]
    for n in range(1, orders):
        # the run from word i goes on over a blank and word i + n, if that belongs to the same text
        goes = np.flatnonzero(row[: max(row.size - n, 0)] == row[n:])
        s = state[goes]
        s = CRC[(s ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
        state = state.copy()
        state[goes] = _advance(s, data, starts[goes + n], lengths[goes + n])
        rows.append(row[goes])
        crcs.append(state[goes] ^ np.uint32(0xFFFFFFFF))
    return np.concatenate(rows), np.concatenate(crcs)


def bucket_counts(texts: DataFrame, orders: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of the column ``text`` by bucket; a task hands on one row for each bucket that it met."""
    scratch.ship(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in scratch.slices(batches, 0):
            _, crc = features(b.column(0), orders)
            total += np.bincount(crc % buckets, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    return texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, orders: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """What a feature of each bucket adds: thousandths of the log ratio of its smoothed shares in the target and the corpus."""

    def counted(texts: DataFrame) -> np.ndarray:
        out = np.zeros(buckets, np.int64)
        for bucket, n in bucket_counts(texts, orders, buckets).collect():  # one row for each bucket at most
            out[bucket] = n
        return out

    s, t = counted(docs), counted(target)
    all_s, all_t = int(s.sum()), int(t.sum())
    return np.array([math.floor(SCALE * math.log((float(b) + 1) * (all_s + buckets) / ((float(a) + 1) * (all_t + buckets)))) for a, b in zip(s, t, strict=True)], np.int64)


def _noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-SCALE * math.log(-math.log((h + 0.5) / 4294967296)))


def _scorer(gain: np.ndarray, orders: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, 1):
            row, crc = features(b.column(1), orders)
            n = np.bincount(row, minlength=b.num_rows)
            g = np.zeros(b.num_rows, np.int64)
            np.add.at(g, row, gain[crc % gain.size])
            weight = np.where(n > 0, g // np.maximum(n, 1), 0)
            words = n if orders == 1 else np.bincount(features(b.column(1), 1)[0], minlength=b.num_rows)
            score = weight + np.array([_noise(d, seed) for d in b.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.int64()) for x in (words, n, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return scored


def scores(docs: DataFrame, target: DataFrame, orders: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of ``docs``, all long."""
    gain = gains(docs, target, orders, buckets)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scorer(gain, orders, seed), "doc_id long, n_words long, n_features long, weight long, score long")


def _offsets(spark: SparkSession, histogram: DataFrame, percent: int) -> tuple[int, DataFrame]:
    """How many are drawn, and (score, above): documents of higher scores, of each score that is drawn from.

    Scores are thousandths of logarithms of 64-bit counts and of 32-bit noise: fewer than 200,000 values at any size of the corpus.
    """
    by_score = sorted(histogram.collect(), key=lambda r: -r["score"])
    draws = percent * sum(r["n"] for r in by_score) // 100
    above, rows = 0, []
    for r in by_score:
        if above >= draws:
            break
        rows.append((r["score"], above))
        above += r["n"]
    return draws, spark.createDataFrame(rows, "score_ long, above long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, orders: int = 1, buckets: int = BUCKETS, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every row of ``docs``, and its place in the draw (null: not drawn).

    Of the rows with ``min_words`` words, ``percent`` of 100 are drawn, those of the highest scores; ties go to smaller ids, null
    ids last. Null and empty texts have no features and weight 0; an empty target leaves gains to the smoothing alone. Rows that
    repeat an id are drawn each by its own score. Columns other than doc_id and text are not looked at; no rows give no rows.
    """
    spark = docs.sparkSession
    rows = scratch.save(scores(docs, target, orders, buckets, seed), "importance")
    draws, offsets = _offsets(spark, rows.filter(F.col("n_words") >= min_words).groupBy("score").agg(F.count(F.lit(1)).alias("n")), percent)
    high = rows.join(F.broadcast(offsets), (rows["score"] == offsets["score_"]) & (rows["n_words"] >= min_words), "left")
    # documents of one score are a small share of all whatever the texts, as their noise differs
    place = F.row_number().over(Window.partitionBy("score_").orderBy(F.col("doc_id").asc_nulls_last(), "weight", "n_features"))
    ranked = high.filter("score_ is not null").withColumn("rank", F.col("above") + place).withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = high.filter("score_ is null").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
