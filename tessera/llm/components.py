"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import save


def _least_neighbour(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (columns a, b, long, not null):
    ``label`` is the least node of its component.

    Each round hangs the larger neighbours of every node below its least one,
    then the smaller ones; rounds end when the edges no longer change and every
    component is a star.  A round is written to the shared folder, so that its
    lineage is cut and it outlives lost executors.  An empty table gives none.
    """
    e = save(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"),
                                           F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_least_neighbour(both), "u").filter("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = _least_neighbour(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
        e = save(small.filter("u <> v").distinct(), "edges")
        mark = e.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"),
                     F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
