"""Connected components of an edge table, by alternating large-star and small-star rounds.

A large star connects every larger neighbour of a node to the least of its
neighbourhood, a small star the smaller ones; the edges become stars around
the least node of each component in a logarithmic number of rounds.  Each
round is aggregations and joins over stored edges, so no neighbourhood is
gathered in one place, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.session import remove_scratch, scratch_path


def _apart(edges: DataFrame) -> DataFrame:
    return edges.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).where("a < b").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of every node (long) that has an edge in ``edges`` (a, b); the label is the component's least node."""
    spark = edges.sparkSession
    base, number, seen = scratch_path(spark, "components"), 0, None
    now = _apart(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    while True:
        now.write.parquet(f"{base}/{number}")
        now = spark.read.parquet(f"{base}/{number}")
        if number:
            remove_scratch(spark, f"{base}/{number - 1}")
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or state[0] == 0:
            break
        seen, number = state, number + 1
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        now = _apart(small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v"))))
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).union(now.select("a", "a").distinct())
