"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreage.llm.scratch import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches. ``links`` has long columns a and b.

    Each round every node hangs its larger neighbours onto its smallest one, and
    then all its neighbours that are not smaller (two hash-partitioned passes);
    it ends when no link changes. A node's neighbours are never gathered: both
    passes are an aggregate and a join, and Spark splits a hot node's side.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    said = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(down.select("a", F.col("m").alias("b"))).distinct()
        edges = written(small, "links")
        now = edges.agg(F.count("*"), F.countDistinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == said or now[0] == now[1]:  # each node hangs onto one; it is a star unless that one hangs too
            hanging = edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi").limit(1).count()
            if not hanging:
                break
        said = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
