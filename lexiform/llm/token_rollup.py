"""Token counts by source, language and tokenizer version as delta-maintained rollups.

A batch of signed changes (insert, delete, revise) is counted, compared with the ledger of live counts, and becomes additive
deltas. A batch is committed by the success marker of its delta table, which is written last; a batch that is applied again
changes nothing, and one that was cut off is written anew. Totals are sums over committed deltas, so a batch costs what it
changes, not what is stored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiform.llm import scratch
from lexiform.llm.sentencepiece_codec import codec

_RANKS: dict[str, object] = {}


def _tiktoken(path: str):
    if path not in _RANKS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _RANKS[path] = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _RANKS[path]


def count_tokens(path: str, texts: list[str]) -> list[int]:
    """Ids of each text, without begin and end, by the vocabulary in ``path``."""
    if path.endswith(".model"):
        return [len(x) // 4 - 2 for x in codec(path).encode_many(texts)]
    encoding = _tiktoken(path)
    return [len(encoding.encode_ordinary(t)) for t in texts]


def counted(docs: DataFrame, tokenizers: list[str], keep: str | None = None) -> DataFrame:
    """doc_id, source, lang, tokenizer (the vocabulary's file name), tokens: a row for each row and tokenizer. Null texts count
    as empty. With ``keep`` (a struct column) instead doc_id, source, lang, that column and an array of the counts."""
    scratch.ship(docs.sparkSession)
    if keep:

        def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in scratch.slices(batches, 4):
                texts = [t or "" for t in b.column(4).to_pylist()]
                every = [list(x) for x in zip(*(count_tokens(path, texts) for path in tokenizers), strict=True)]
                yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(every, pa.list_(pa.int64()))], names=["doc_id", "source", "lang", keep, "tokens"])

        kind = docs.schema[keep].dataType.simpleString()
        return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), keep, "text").mapInArrow(arrays, f"doc_id long, source string, lang string, {keep} {kind}, tokens array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scratch.slices(batches, 3):
            texts = [t or "" for t in b.column(3).to_pylist()]
            for path in tokenizers:
                n = pa.array(count_tokens(path, texts), pa.int64())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array([os.path.basename(path)] * len(texts), pa.string()), n], names=["doc_id", "source", "lang", "tokenizer", "tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text")).mapInArrow(run, "doc_id long, source string, lang string, tokenizer string, tokens long")


class Rollup:
    """The state in one folder: ``ledger/batch=N`` (counts of a batch's documents) and ``deltas/batch=N``."""

    LEDGER = "doc_id long, source string, lang string, tokenizer string, tokens long, live boolean"
    DELTA = "source string, lang string, tokenizer string, docs long, tokens long"

    def __init__(self, spark: SparkSession, folder: str, tokenizers: list[str]):
        self.spark, self.folder, self.tokenizers = spark, folder.rstrip("/"), tokenizers

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def batches(self) -> list[int]:
        """Committed batches in order."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/deltas")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        found = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(x[6:]) for x in found if x.startswith("batch=") and self._exists(f"{self.folder}/deltas/{x}/_SUCCESS"))

    def _read(self, what: str, schema: str) -> DataFrame | None:
        parts = [self.spark.read.schema(schema).parquet(f"{self.folder}/{what}/batch={n}").withColumn("batch", F.lit(n)) for n in self.batches()]
        return reduce(DataFrame.unionByName, parts) if parts else None

    def ledger(self, of: DataFrame | None = None) -> DataFrame | None:
        """Live counts: of each document those of its latest batch; only of the documents in ``of`` if it is given."""
        rows = self._read("ledger", self.LEDGER)
        if rows is None:
            return None
        if of is not None:  # the history of other documents takes no part
            rows = rows.join(of.select("doc_id").distinct(), "doc_id", "left_semi")
        last = Window.partitionBy("doc_id")
        return rows.withColumn("last", F.max("batch").over(last)).filter("batch = last and live").select("doc_id", "source", "lang", "tokenizer", "tokens")

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit ``changes`` (doc_id, kind, source, lang, text; optional seq) as ``batch``; False if it was committed before.

        insert and revise set a document's counts, delete takes them away; delete of a document that isn't live and insert of
        the same content change no total. Of several changes of a document the one with the largest seq counts (without seq,
        or with ties: the largest in the order of kind, source, lang and SHA-256 of the text), for all tokenizers alike. Null
        doc_ids are left out.
        """
        done = self.batches()
        if batch in done:
            return False
        if done and batch < done[-1]:
            raise ValueError("batches are applied in order")
        seq = F.col("seq").cast("double") if "seq" in changes.columns else F.lit(0.0)
        digest = F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256)
        rows = changes.filter("doc_id is not null").select("doc_id", "source", "lang", F.struct(seq.alias("seq"), F.col("kind").alias("kind"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), digest.alias("digest")).alias("turn_"), F.when(F.col("kind") != "delete", F.col("text")).alias("text"))
        # counted first, so that no text moves; then one change of each document stays
        last = counted(rows, self.tokenizers, "turn_").groupBy("doc_id").agg(F.max_by(F.struct("source", "lang", "tokens", (F.col("turn_.kind") != "delete").alias("live")), "turn_").alias("r"))
        names = F.array(*[F.lit(os.path.basename(p)) for p in self.tokenizers])
        new = last.filter("r.live").select("doc_id", "r.source", "r.lang", F.explode(F.arrays_zip(names.alias("tokenizer"), F.col("r.tokens").alias("tokens"))).alias("z"), F.lit(True).alias("live")).select("doc_id", "source", "lang", "z.tokenizer", "z.tokens", "live")
        gone = last.filter("not r.live").select("doc_id", *[F.lit(None).cast(t).alias(n) for n, t in (("source", "string"), ("lang", "string"), ("tokenizer", "string"), ("tokens", "long"))], F.lit(False).alias("live"))
        target = f"{self.folder}/ledger/batch={batch}"
        new.unionByName(gone).write.mode("overwrite").parquet(target)
        written = self.spark.read.schema(self.LEDGER).parquet(target)
        signed = [written.filter("live").select("source", "lang", "tokenizer", F.lit(1).cast("long").alias("docs"), "tokens")]
        before = self.ledger(written)
        if before is not None:
            signed.append(before.select("source", "lang", "tokenizer", F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).alias("tokens")))
        deltas = reduce(DataFrame.unionByName, signed).groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        deltas.filter("docs <> 0 or tokens <> 0").write.mode("overwrite").parquet(f"{self.folder}/deltas/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, docs, tokens over all committed batches; groups without documents are left out."""
        rows = self._read("deltas", self.DELTA)
        if rows is None:
            rows = self.spark.createDataFrame([], self.DELTA)
        return rows.groupBy("source", "lang", "tokenizer").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0")
