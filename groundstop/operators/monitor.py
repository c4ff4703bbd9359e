"""Production monitoring: delayed labels, global positions, accuracy per block, metric records.

Global position (``with_position``) is the scalable replacement of a loop
over rows in arrival order.  A ``row_number()`` window without a
partition would pull every row into one task; instead:

1. store the input (its plan runs once; stored files are read as they are),
   range-partition it on the order key
   (AQE sizes the partitions; merged partitions stay contiguous ranges) and
   sort within partitions,
2. tag each row with its partition id and in-partition ordinal
   (``monotonically_increasing_id`` = partition << 33 | ordinal),
3. freeze the tags by writing the rows as a parquet table below the shared
   checkpoint folder (this cuts the lineage; partition id and ordinal are
   stored columns, so the later passes and any task retry after an
   executor loss see the same values),
4. count rows per partition id (one row per partition), turn the counts
   into offsets with a running sum over that tiny table, and broadcast it
   back (its size is the partition count, not the data size).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundstop.functions import epoch_ms_to_timestamp
from groundstop.operators.nested import flatten
from groundstop.session import remove_scratch, scratch_path

_ORDINAL_MASK = (1 << 33) - 1


def attach_labels(scored: DataFrame, labels: DataFrame, key: str = "uuid") -> DataFrame:
    """Scored rows whose ground truth has arrived (inner equi-join on the id)."""
    return scored.join(labels, key, "inner")


def pending_labels(scored: DataFrame, labels: DataFrame, key: str = "uuid") -> DataFrame:
    """Scored rows still waiting for ground truth (left anti join)."""
    return scored.join(labels, key, "left_anti")


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    *,
    name: str = "position",
    total: str | None = None,
    num_partitions: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Add the 1-based global position of each row in ``order``.

    ``order`` must be a total order (end it with a unique key) for the
    result to be repeatable.  ``total`` names an optional column holding
    the row count.  ``stored``: ``df`` is no more than a scan of files that
    stay, with a filter or a projection, so it can be read twice and is not
    stored again.
    """
    spark = df.sparkSession
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    source = None if stored else scratch_path(spark, "unordered")  # range partitioning samples its input: compute that once
    if source:
        df.write.option("compression", "zstd").parquet(source)
        df = spark.read.parquet(source)
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    tagged = ranged.sortWithinPartitions(*cols).select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mid")
    )
    path = scratch_path(spark, "positions")
    tagged.write.option("compression", "zstd").parquet(path)
    if source:
        remove_scratch(spark, source)
    frozen = spark.read.parquet(path)
    counts = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_total"),
    )
    out = frozen.join(F.broadcast(offsets), "_pid").withColumn(
        name, F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_ORDINAL_MASK)) + 1
    )
    if total:
        out = out.withColumnRenamed("_total", total)
    return out.drop("_pid", "_mid", "_offset", "_total")


def progress(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``position`` and ``progress`` = position / rows, in ``order``."""
    pos = with_position(df, order, total="_rows")
    return pos.withColumn("progress", F.col("position") / F.col("_rows")).drop("_rows")


def accuracy_by_block(
    labelled: DataFrame,
    order: Sequence[str | Column] = ("timestamp_ms", "uuid"),
    block_size: int = 100,
    *,
    label: str = "final_label",
    prediction: str = "prediction",
    ts: str = "timestamp_ms",
    stored: bool = False,
) -> DataFrame:
    """Accuracy of each full block of ``block_size`` rows in arrival order.

    A trailing block with fewer rows is not emitted.  Output: ``block``,
    ``n``, ``accuracy``, ``start_ms`` / ``end_ms`` (first and last time
    stamp of the block).  ``stored`` as in ``with_position``.
    """
    if all(isinstance(c, str) for c in order):
        # Only the columns the block figures need travel through the sort and checkpoint.
        labelled = labelled.select(*dict.fromkeys([*order, label, prediction, ts]))
    pos = with_position(labelled, list(order), stored=stored)
    block = F.floor((F.col("position") - 1) / F.lit(block_size)).cast("long")
    correct = F.when(F.col(label).cast("int") == F.col(prediction).cast("int"), 1.0).otherwise(0.0)
    return (
        pos.groupBy(block.alias("block"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(correct).alias("accuracy"),
            F.min(ts).alias("start_ms"),
            F.max(ts).alias("end_ms"),
        )
        .where(F.col("n") == block_size)
    )


def with_late_labels(scored_requests: DataFrame, labels: DataFrame, key: str = "uuid") -> DataFrame:
    """Every scored row with its label, null while the label is pending (left join)."""
    return scored_requests.join(labels, key, "left")


def prediction_records(rows: DataFrame, deployment: str, key: str = "uuid") -> DataFrame:
    """One nested metric record per prediction (``rows`` from ``with_late_labels``)."""
    return rows.select(
        F.col(key).alias("record_id"),
        F.col("timestamp_ms").alias("startTimeStampMs"),
        F.col("timestamp_ms").alias("endTimeStampMs"),
        F.struct(
            F.lit(None).cast("double").alias("accuracy"),
            F.struct(F.col("feature").alias("feature")).alias("input_data"),
            F.col("p_cancel").cast("double").alias("proba"),
            (F.col("final_label") == 1).alias("final_label"),
        ).alias("metrics"),
        F.lit(deployment).alias("modelDeploymentCrn"),
    )


def block_records(blocks: DataFrame, deployment: str) -> DataFrame:
    """One nested aggregate record per block."""
    return blocks.select(
        F.concat(F.lit("block-"), F.lpad(F.col("block").cast("string"), 9, "0")).alias("record_id"),
        F.col("start_ms").alias("startTimeStampMs"),
        F.col("end_ms").alias("endTimeStampMs"),
        F.struct(
            F.col("accuracy").cast("double").alias("accuracy"),
            F.struct(F.lit(None).cast("string").alias("feature")).alias("input_data"),
            F.lit(None).cast("double").alias("proba"),
            F.lit(None).cast("boolean").alias("final_label"),
        ).alias("metrics"),
        F.lit(deployment).alias("modelDeploymentCrn"),
    )


def metrics_frame(rows: DataFrame, deployment: str, block_size: int = 100, stored: bool = False) -> DataFrame:
    """Flat, cleaned metric records, per prediction and per full block (``rows`` from ``with_late_labels``).

    Epoch milliseconds become timestamps with their difference, a missing
    accuracy is -1, values get their published types.  ``stored`` as in
    ``with_position``.
    """
    blocks = accuracy_by_block(rows.where(F.col("final_label").isNotNull()), block_size=block_size, stored=stored)
    flat = flatten(prediction_records(rows, deployment).unionByName(block_records(blocks, deployment)))
    return flat.select(
        "record_id",
        epoch_ms_to_timestamp("startTimeStampMs").alias("start_ts"),
        epoch_ms_to_timestamp("endTimeStampMs").alias("end_ts"),
        (F.col("endTimeStampMs") - F.col("startTimeStampMs")).alias("processing_time_ms"),
        F.coalesce(F.col("metrics_accuracy"), F.lit(-1.0)).alias("metrics_accuracy"),
        F.col("metrics_input_data_feature").cast("string").alias("metrics_input_data_feature"),
        F.col("metrics_proba").cast("double").alias("metrics_proba"),
        F.col("metrics_final_label").cast("boolean").alias("metrics_final_label"),
        F.col("modelDeploymentCrn").alias("model_deployment_crn"),
    )
