"""Global running starts over a stored, ordered table, without a one-task pass over its rows.

A writer keeps with every stored row its part (the partition that wrote it;
parts are in order) and the total before it within the part.  The starts of
the parts are a running sum over one row per part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def part_starts(stored: DataFrame, amount: str) -> DataFrame:
    """(part, part_start): what all earlier parts hold of ``amount``."""
    totals = stored.groupBy("part").agg(F.sum(amount).alias("_total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("long").alias("part_start"))
