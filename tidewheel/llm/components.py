"""Connected components of a table of edges, with joins only (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.shared import forget, written


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of edges (a, b: bigint); root is the smallest node that it is linked with.

    Alternates two steps until nothing changes: every node points its larger neighbours at its
    smallest one, then its smaller ones. Each round writes its edges to the shared folder, at most
    as many as there were. Nulls and loops are left out; without an edge there is no row.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v and a is not null and b is not null").distinct())
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").unionByName(below.select("u", F.col("m").alias("v"))).distinct()
        new = written(small)
        now = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        forget(e)
        e = new
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
