"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.session import stage_table


def _hop(pairs: DataFrame) -> DataFrame:
    """One star step: everything a node sees, and the node itself, goes to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_m")).withColumn("_m", F.least("u", "_m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node of an edge; the component is its smallest node.

    Alternates the large-star and small-star steps until every edge leads to the
    smallest node of its component. Each step is a group-by with partial sums and
    a join on the node, so a node with many neighbours is never gathered; each
    round is written to the shared folder. Loops and repeated edges do no harm,
    edges with a null end are left out, no edges give no rows.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    e = stage_table(e.distinct(), "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hop(both).where("v > u").select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()
        small = _hop(large).select(F.explode(F.array("u", "v")).alias("u"), F.col("_m").alias("v"))
        after = stage_table(small.where("u > v").distinct(), "edges")
        mark = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        e, same, before = after, mark == before, mark
        if same:
            break
    ends = e.groupBy("v").agg(F.count(F.lit(1)).alias("_n")).select(F.col("v").alias("u"), "v")
    return e.unionByName(ends).select(F.col("u").alias("node"), F.col("v").alias("component"))
