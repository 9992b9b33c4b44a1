"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadweir.llm.common import forget, staged


#: Rows of a table that is small enough to be worked on by one task, without an exchange.
ONE_TASK = 200_000


def in_one_task(df: DataFrame, rows: int, most: int = ONE_TASK) -> DataFrame:
    """``df``, in a single partition if it has ``most`` rows or fewer: then no step on it has to shuffle.

    Only the plan depends on it, not the result. Adaptive execution does much the same, one stage at a time.
    """
    return df.coalesce(1) if rows <= most else df


def components(edges: DataFrame, a: str = "a", b: str = "b", small: bool = False) -> DataFrame:
    """``node`` and ``root``, the smallest node it can reach, for every node of an edge.

    Each round lets every node point its larger neighbours, then its smaller ones, to the smallest
    node it sees; the number of rounds grows with the logarithm of the longest path. A round is
    written to the shared folder, so a lost executor costs no earlier round. Edges with a null end
    and loops are left out; an empty table gives an empty result. With ``small``, rounds over few
    edges (:data:`ONE_TASK`) run in one task each.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    pairs = staged(pairs.where((F.col(a) != F.col(b))).distinct(), "edges")
    spark, seen = edges.sparkSession, None
    while True:
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if now == seen:
            return pairs.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
                pairs.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
            )
        seen = now
        few = now[0] if small else ONE_TASK + 1
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        both = in_one_task(both, few)
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large-star")
        both = in_one_task(large, few)
        least = both.groupBy("u").agg(F.min("v").alias("v"))
        low = both.join(least.withColumnRenamed("v", "m"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = in_one_task(low.where("u <> v").unionByName(least), few)
        before, pairs = pairs, staged(low.distinct(), "small-star")
        forget(spark, before, large)
