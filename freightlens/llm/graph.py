"""Connected components as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: longs); the root is the smallest node that it reaches.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the smallest one, then
    every smaller one.  Each round is written to the shared folder; the number of rounds grows with the logarithm of
    the size of a component, and no round has more edges than the first.  Null ends and loops are left out.
    """
    now = edges.where("a is not null and b is not null and a <> b")
    now = materialize(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select("b", "b").distinct()
            )
        seen = mark
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("u"), F.least("low", "a").alias("low"))
        large = both.join(low, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "u")
        small = large.join(low, F.col("a") == F.col("u")).select(
            F.explode(F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")
        )
        now = materialize(small.select("e.*").where("a <> b").distinct(), "edges")
