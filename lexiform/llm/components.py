"""Connected components by alternating large-star and small-star steps, all on DataFrames.

Every step halves distances to the smallest node at least; edges are pre-aggregated by ``min`` before they are joined, so a
node with very many edges is one grouped row on one side of a join that AQE splits on the other. Nothing goes to the driver
but two numbers for each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiform.llm import scratch


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return int(row["n"]), int(row["h"])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): for each node of an edge (columns u, v; longs) the smallest node that it reaches.

    Loops and repeated edges are allowed; no edges give no rows.
    """
    e = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).filter("u <> v")
    table = scratch.save(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _signature(table)
    while before[0]:
        both = table.unionByName(table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        mid = scratch.save(large, "large-star")
        low = mid.groupBy("u").agg(F.min("v").alias("m"))
        small = mid.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u <> v").distinct()
        new = scratch.save(small, "edges")
        after = _signature(new)
        scratch.drop(table, mid)
        table = new
        if after == before:
            break
        before = after
    nodes = table.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return nodes.unionByName(table.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
