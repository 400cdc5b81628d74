"""Connected components by alternating large-star and small-star steps, on DataFrames.

Every step is an aggregation that combines on the map side and a join on its key; a step's edges are written to the
shared folder, which cuts the lineage. The number of edges never grows beyond twice the input's. Adaptive execution
splits the joins where one vertex has very many edges. Steps end when the edges no longer change, after a number that
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwell.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """edges: (a, b) long, any order, loops and repeats allowed. Returns (v, label) for every vertex that has an edge to
    another one; the label is the smallest vertex of the component."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _mark(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b").distinct()
        now = written(small, "edges")
        after = _mark(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("a").alias("v"), F.col("b").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("v"), "label").distinct())
