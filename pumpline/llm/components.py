"""Connected components of a graph given as a DataFrame of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pumpline.llm.common import stored


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Alternating large-star and small-star steps (Kiveris et al. 2014) over
    edges (a, b); returns (node, root), root the smallest node reached, for
    every node that has an edge to another.  Every step is a grouped minimum
    and an equi-join, stored in the shared folder; the number of rounds grows
    with the logarithm of the longest path."""
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    seen = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = stored(small.distinct(), name)
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
