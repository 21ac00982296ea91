"""Mixing sources to target weights, with DataFrame functions only.

Token shares are raised to an exponent between 0 (even) and 1 (natural) that is bisected until the weights meet a target
entropy or a limit on repetition; of two targets the exponent that meets both counts. Five bisections are answered by one
aggregation over the sources. Weights become token quotas of a budget, and quotas become permutations: each source's rows
are dealt by hash into blocks of bounded size, blocks and rows within them are ordered by hash anew in every epoch, whole
epochs are taken as they are and the last one up to what is left of the quota. Only one block of a source is cut.

``order_key`` is how far a row lies through its source's quota, so any prefix of the rows in that order has the weights.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiform.llm import scratch

#: Tokens of a block, and blocks of a stretch, on average.
BLOCK_TOKENS, STRETCH = 100_000, 10_000
#: Bisections answered by one aggregation, and aggregations.
DEPTH, ROUNDS = 5, 8
WORD = r"[^\x20\x09-\x0D]+"


def items(docs: DataFrame) -> DataFrame:
    """(doc_id, source, tokens): words of the text, 1 at least. A null source counts as the empty one. Rows that repeat a
    doc_id are one item, of the smallest of their sources."""
    tokens = F.greatest(F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)), F.lit(1)).cast("long")
    return docs.select(F.col("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("source"), tokens.alias("tokens")).groupBy("doc_id").agg(F.min("source").alias("source"), F.sum("tokens").alias("tokens"))


def exponent(totals: DataFrame, budget: int | None, entropy: float | None = None, repeats: float | None = None) -> float:
    """The exponent for ``totals`` (source, n): the largest that still has the entropy (nats), or the smallest whose most
    repeated source is met ``repeats`` times at most; with both, the repetition limit goes first. 1 where no exponent does.
    Without a budget, the least used source is met once."""
    whole = totals.agg(F.sum("n").alias("n")).first()["n"]
    if not whole:
        return 1.0
    log_p = F.log(F.col("n") / F.lit(float(whole)))

    def meets(points: list[float], seek_entropy: bool) -> list[bool]:
        grid = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("t")) for i, t in enumerate(points)])).alias("g")
        at = totals.select(log_p.alias("lp"), grid).select("lp", "g.i", "g.t").withColumn("w", F.exp(F.col("lp") * F.col("t")))
        rows = at.groupBy("i").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.col("t") * F.col("lp")).alias("e"), F.max(F.exp(F.col("lp") * (F.col("t") - 1))).alias("m"), F.min(F.exp(F.col("lp") * (F.col("t") - 1))).alias("l")).collect()
        by = {r["i"]: r for r in rows}
        h = [math.log(by[i]["z"]) - by[i]["e"] / by[i]["z"] for i in range(len(points))]
        most = [by[i]["m"] / by[i]["l"] if budget is None else budget / whole * by[i]["m"] / by[i]["z"] for i in range(len(points))]
        # true from the exponent on that is looked for
        return [x < entropy for x in h] if seek_entropy else [x <= repeats * (1 + 1e-12) for x in most]

    def search(seek_entropy: bool) -> float:
        low, high = 0.0, 1.0
        if meets([low], seek_entropy)[0]:
            return low
        for _ in range(ROUNDS):
            n = 2**DEPTH
            points = [low + (high - low) * k / n for k in range(1, n)]
            told = meets(points, seek_entropy)
            # the midpoints that DEPTH bisections ask for are among the points
            a, b = 0, n
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (a, mid) if told[mid - 1] else (mid, b)
            low, high = low + (high - low) * a / n, low + (high - low) * b / n
        return high

    found = 0.0 if entropy is not None or repeats is not None else 1.0
    if entropy is not None:
        found = max(found, search(True))
    if repeats is not None:
        found = max(found, search(False))
    return found


def weights(totals: DataFrame, budget: int | None, power: float) -> DataFrame:
    """(source, n, share, weight, quota): quotas are whole tokens of the budget. Without a budget it is the least that takes
    all of every source."""
    whole = totals.agg(F.sum("n").alias("n")).first()["n"] or 1
    z = totals.agg(F.sum(F.pow(F.col("n") / F.lit(float(whole)), F.lit(power))).alias("z")).first()["z"] or 1.0
    share = F.col("n") / F.lit(float(whole))
    weight = F.pow(share, F.lit(power)) / F.lit(float(z))
    if budget is None:
        least = totals.agg(F.max(F.col("n") / weight).alias("b")).first()["b"] or 0.0
        return totals.select("source", "n", share.alias("share"), weight.alias("weight"), F.greatest("n", F.floor(weight * F.lit(float(least)))).cast("long").alias("quota"))
    return totals.select("source", "n", share.alias("share"), weight.alias("weight"), F.floor(weight * F.lit(float(budget)) + F.lit(1e-6)).cast("long").alias("quota"))


def mix(docs: DataFrame, budget_share: float | None = 1.0, entropy_share: float | None = None, repeats: float | None = None, seed: int = 17) -> DataFrame:
    """doc_id, source, tokens, weight, epoch, block, order_key: a row for each time that an item is used.

    ``budget_share``: budget as a share of all tokens; None: as many as it takes to use every item once at least.
    ``entropy_share``: target entropy as a share of that of even weights. ``repeats``: no source is used more often on average;
    a budget beyond that is lowered to it. Empty tables give no rows.
    Ties of hashes fall back on doc_id.
    """
    rows = scratch.save(items(docs), "mix-items")
    totals = scratch.save(rows.groupBy("source").agg(F.sum("tokens").alias("n")), "mix-totals")
    head = totals.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    whole = int(head["n"] or 0)
    budget = None if budget_share is None else int(budget_share * whole)
    if repeats is not None and budget is not None:
        budget = min(budget, int(repeats * whole))
    power = exponent(totals, budget, None if entropy_share is None else entropy_share * math.log(max(head["k"], 1)), repeats)
    quotas = weights(totals, budget, power).withColumn("blocks", F.ceil(F.col("n") / BLOCK_TOKENS)).withColumn("last", F.floor(F.col("quota") / F.col("n")))
    key = lambda *c: F.xxhash64(*c, F.lit(seed))
    used = rows.join(quotas, "source").filter("quota > 0").select("doc_id", "source", "tokens", "n", "weight", "quota", "blocks", F.explode(F.expr("sequence(0L, if(last * n < quota, last, last - 1))")).alias("epoch"))
    used = used.withColumn("block", F.pmod(key(F.col("doc_id"), F.col("epoch"), F.lit(0)), F.col("blocks")))
    sizes = used.groupBy("source", "epoch", "block").agg(F.sum("tokens").alias("block_tokens"))
    # blocks are ordered within stretches and stretches within an epoch, so that no window holds all blocks of a source
    stretch = F.pmod(key(F.col("block"), F.col("epoch"), F.lit(3)), F.ceil(F.col("blocks") / STRETCH))
    sizes = sizes.join(quotas.select("source", "blocks"), "source").withColumn("stretch", stretch)
    by_stretch = Window.partitionBy("source", "epoch").orderBy("stretch")
    before = sizes.groupBy("source", "epoch", "stretch").agg(F.sum("block_tokens").alias("stretch_tokens"))
    before = before.withColumn("ahead", F.sum("stretch_tokens").over(by_stretch.rowsBetween(Window.unboundedPreceding, 0)) - F.col("stretch_tokens"))
    by_block = Window.partitionBy("source", "epoch", "stretch").orderBy(key(F.col("block"), F.col("epoch"), F.lit(1)), "block")
    inside = sizes.withColumn("inside", F.sum("block_tokens").over(by_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("block_tokens"))
    starts = inside.join(before.select("source", "epoch", "stretch", "ahead"), ["source", "epoch", "stretch"]).withColumn("start", F.col("inside") + F.col("ahead"))
    within = Window.partitionBy("source", "epoch", "block").orderBy(key(F.col("doc_id"), F.col("epoch"), F.lit(2)), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    placed = used.withColumn("end", F.sum("tokens").over(within)).join(starts.select("source", "epoch", "block", "start"), ["source", "epoch", "block"])
    reached = F.col("epoch") * F.col("n") + F.col("start") + F.col("end")
    return placed.filter(reached <= F.col("quota")).select("doc_id", "source", "tokens", "weight", "epoch", "block", ((reached - F.col("tokens")) / F.col("quota")).alias("order_key"))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as often as :func:`mix` uses them, with their columns."""
    used = mix(docs, **how).groupBy(F.col("doc_id").alias("used_id_")).agg(F.count(F.lit(1)).alias("used_times_"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row_"), F.col("doc_id").alias("join_id_"))
    joined = rows.join(used, F.col("join_id_").eqNullSafe(F.col("used_id_")))
    return joined.select("row_", F.explode(F.expr("sequence(1L, used_times_)")).alias("time_")).select("row_.*")
