"""Simulation table and the cleaning chain applied before scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from groundstop.functions import blank_to_null, flag_text, flight_id, hour_text, iso_week, yes_no
from groundstop.schemas import ROW_KEY

# The simulation table's columns, in table order.
SIMULATION_COLUMNS = [
    "fl_id", "fl_date", "op_carrier", "op_carrier_fl_num", "origin", "dest", "crs_dep_time",
    "crs_arr_time", "cancelled", "crs_elapsed_time", "distance", "hour", "week", "cancel",
]


def simulation_frame(flights: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Every column as text, plus the ``*``-joined flight id and a YES/NO label.

    The flag goes through int first so that it reads ``"1"`` / ``"0"``,
    and the hour is taken from integer text (``"930"`` -> ``"09"``).
    ``keep`` names further input columns to carry along unchanged.
    """
    key = [ROW_KEY] if ROW_KEY in flights.columns else []
    return flights.select(
        *key,
        flight_id("fl_date", "op_carrier", "op_carrier_fl_num", "origin", "dest", "crs_dep_time").alias("fl_id"),
        F.col("fl_date").cast("string").alias("fl_date"),
        "op_carrier",
        "op_carrier_fl_num",
        "origin",
        "dest",
        F.col("crs_dep_time").cast("string").alias("crs_dep_time"),
        F.col("crs_arr_time").cast("string").alias("crs_arr_time"),
        flag_text("cancelled").alias("cancelled"),
        F.col("crs_elapsed_time").cast("string").alias("crs_elapsed_time"),
        F.col("distance").cast("string").alias("distance"),
        hour_text("crs_dep_time").alias("hour"),
        iso_week("fl_date").cast("string").alias("week"),
        yes_no("cancelled").alias("cancel"),
        *keep,
    )


# Label spellings the scoring side expects.
CANCEL_MAP = {"YES": "Yes", "NO": "No"}
CANCELLED_MAP = {"1": "Yes", "0": "No"}


def clean_values(df: DataFrame) -> DataFrame:
    """Relabel ``cancel`` and ``cancelled``, then one-blank-character text -> null.

    Opening a one-element array computes the input's columns once per row; a
    filter on the cleaned values, which Spark moves below this projection,
    would compute each of them again at every use.
    """
    once = df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
    out = once.na.replace(CANCEL_MAP, subset=["cancel"]).na.replace(CANCELLED_MAP, subset=["cancelled"])
    text_cols = [f.name for f in out.schema.fields if f.dataType.simpleString() == "string"]
    return out.withColumns({c: blank_to_null(c) for c in text_cols})


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any column."""
    return df.na.drop(how="any")


# Hex digits of the two histogram levels: 4096 buckets, each of 4096 parts.
_COARSE, _FINE = 3, 3


def sample_exact(df: DataFrame, n: int, key: str = ROW_KEY) -> DataFrame:
    """Exactly ``min(n, rows)`` pseudo-random rows, the same ones on every run (in no order).

    The rows with the least md5 of the key (then the key) stay; a null key
    counts as an empty one.  A histogram
    of digest prefixes (partial counts in every task, 2^24 buckets at most)
    gives the one bucket that the n-th row falls into.  Rows of lesser buckets
    stay without a sort; only that bucket's rows, a 2^24th of all, are ranked.
    The same plan serves every ``n``.
    """
    hashed = df.withColumn("_h", F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, _COARSE + _FINE))
    parts = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_top", F.substring("_b", 1, _COARSE))
    tops = parts.groupBy("_top").agg(F.sum("_n").alias("_m"))  # 4096 rows at most
    until = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("_top", F.coalesce(F.sum("_m").over(until(Window.orderBy("_top"))), F.lit(0)).alias("_before"))
    inner = F.coalesce(F.sum("_n").over(until(Window.partitionBy("_top").orderBy("_b"))), F.lit(0))
    edge = (
        parts.withColumn("_inner", inner).join(tops, "_top")
        .withColumn("_before", F.col("_before") + F.col("_inner"))
        .where((F.col("_before") < n) & (F.col("_before") + F.col("_n") >= n))
        .select("_b", (F.lit(n) - F.col("_before")).alias("_left"))
    )  # one row, or none when there are fewer than n rows
    bound, left = F.coalesce(edge.select("_b").scalar(), F.lit("g")), F.coalesce(edge.select("_left").scalar(), F.lit(0))
    below = hashed.where(F.col("_b") < bound) if n > 0 else hashed.limit(0)
    ranked = hashed.where(F.col("_b") == bound).withColumn("_rank", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
    return below.drop("_h", "_b").unionByName(ranked.where(F.col("_rank") <= left).drop("_h", "_b", "_rank"))


def simulation_sample(sim: DataFrame, n: int = 10_000, key: str = ROW_KEY) -> DataFrame:
    """The cleaning chain before scoring: exact-n sample -> relabel -> blanks to null -> complete rows."""
    return drop_incomplete(clean_values(sample_exact(sim, n, key)))
