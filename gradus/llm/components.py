"""Connected components of a table of links, by alternating large and small stars; nothing comes to the driver but a count."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def components(links: DataFrame) -> DataFrame:
    """links (a, b) of longs -> (node, label), label the smallest node reachable; nodes without links are absent."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        small = pairs.select(F.greatest("b", "m").alias("u"), F.least("b", "m").alias("v")).where("u <> v").unionByName(pairs.select(F.col("a").alias("u"), F.col("m").alias("v")))
        edges = stored(small.select(F.col("u").alias("a"), F.col("v").alias("b")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    labels = edges.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "node")
    return labels.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
