"""Connected components of an edge table, without collecting a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagyard.llm.frames import cut_lineage


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b; longs), component being the smallest node of its component.

    Alternating large-star and small-star contraction: each round hangs every
    neighbour on the smallest one, by a minimum (combined before the shuffle) and
    a join that Spark can split where a node has very many edges.  Each round's
    edges are written to the shared folder.  Loops and nulls are left out."""
    # (hi, lo) with hi > lo
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = cut_lineage(now, "edges")
    state = None
    for _ in range(most_rounds):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
        now = cut_lineage(small.select("e.hi", "e.lo").where("hi <> lo").distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if (seen["n"], seen["h"]) == state:
            break
        state = (seen["n"], seen["h"])
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
