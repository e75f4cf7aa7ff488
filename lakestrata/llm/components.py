"""Connected components by alternating large and small stars (Kiveris et al., 2014), as joins and minima."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.frames import Scratch


def _round(edges: DataFrame, work: Scratch) -> DataFrame:
    """Edges (a, b) with ``a > b``: one large-star and one small-star step, which keep the components."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    large = work.table(large, "large-star")
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a")
    return work.table(small.select("a", F.col("m").alias("b")).unionByName(
        small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct(), "small-star")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` of every number that an edge names; the component is its smallest number.

    Ends when a round changes nothing; every number then points to its component. Rounds grow with the
    logarithm of the number of nodes. Edges are narrow rows, and no step collects the neighbours of a node.
    The tables of a round are deleted when the next one is done.
    """
    spark, before = edges.sparkSession, None
    work = Scratch(spark, "components")
    held = work.table(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct(), "edges")
    while True:
        mark = held.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before or not mark[0]:
            break
        before, last, work = mark, work, Scratch(spark, "components")
        held = _round(held, work)
        last.close()
    return held.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        held.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
