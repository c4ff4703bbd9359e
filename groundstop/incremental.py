"""Accuracy per block of only what is new: a monitoring run that carries its open ends to the next.

The prediction log and the labels grow by numbered batches
(``sources.batches``).  A run reads the batches since the last one, joins
them with what was left open, closes the blocks that fill, and stores what
stays open:

* predictions still without a label, and labels that came before their
  prediction;
* the labelled rows after the last full block (fewer than a block).

So a run sorts and joins what arrived, not the log.  A block holds rows in
the order in which runs saw them, within a run by (timestamp, id), and is
emitted once, when it is full.

Everything a run stores is a partition ``run = n`` of four tables; the run
counts only when the progress view is pointed at it, in one statement.  A run
that is cut off leaves the state before it, and the next one overwrites what
it had written.  One run at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundstop.operators.monitor import with_position
from groundstop.session import scratch_path, scratch_scope
from groundstop.sources.batches import new_batches
from groundstop.sources.tables import ensure_database

_FIELDS = {
    "pending": "uuid string, timestamp_ms long, prediction int",
    "early": "uuid string, final_label int",
    "open": "uuid string, timestamp_ms long, prediction int, final_label int, place long",
    "blocks": "block long, n long, accuracy double, start_ms long, end_ms long",
}


def _table(state: str, part: str) -> str:
    return f"{state}__{part}"


def progress(spark: SparkSession, state: str) -> dict[str, int]:
    """Last complete run, the last batches of log and labels that it read, and the blocks closed so far."""
    view = _table(state, "progress")
    if not spark.catalog.tableExists(view):
        return {"run": 0, "log_no": 0, "label_no": 0, "blocks": 0}
    return spark.table(view).first().asDict()


def _stored(spark: SparkSession, state: str, part: str, run: int) -> DataFrame:
    if run == 0:
        # Known to be empty when the query is planned, so a union with it is the other side alone, with its buckets.
        return spark.createDataFrame([], _FIELDS[part]).where(F.lit(False))
    return spark.table(_table(state, part)).where(F.col("run") == run).drop("run")


def _store(spark: SparkSession, df: DataFrame, state: str, part: str, run: int) -> None:
    """Write one run's partition, over whatever an unfinished run left there."""
    table = _table(state, part)
    if not spark.catalog.tableExists(table):
        ensure_database(spark, table)
        spark.sql(f"CREATE TABLE {table} ({_FIELDS[part]}, run long) USING parquet OPTIONS (compression 'zstd') PARTITIONED BY (run)")
    # A static partition, so that it is emptied also where the run has no rows.
    view = f"run_part_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    names = ", ".join(f.split(" ")[0] for f in _FIELDS[part].split(", "))
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (run = {run}) SELECT {names} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def monitor_increment(spark: SparkSession, log_table: str, labels_table: str, state: str, block_size: int = 100) -> dict[str, int]:
    """Take in the batches since the last run; the progress after it.

    ``state`` names the stored state (``db.name``).  A label that names no
    prediction yet waits for it; of several labels of one prediction in a run
    the least is taken.  Without new batches nothing changes.
    """
    last = progress(spark, state)
    logged, log_no = new_batches(spark, log_table, last["log_no"])
    labels, label_no = new_batches(spark, labels_table, last["label_no"])
    if (log_no, label_no) == (last["log_no"], last["label_no"]):
        return last
    run = last["run"] + 1
    with scratch_scope(spark):
        waiting = logged.select("uuid", "timestamp_ms", F.col("prediction").cast("int").alias("prediction")).union(_stored(spark, state, "pending", last["run"]))
        told = labels.select("uuid", F.col("final_label").cast("int").alias("final_label")).union(_stored(spark, state, "early", last["run"]))
        told = told.groupBy("uuid").agg(F.min("final_label").alias("final_label"))
        path = scratch_path(spark, "increment")
        waiting.join(told, "uuid", "full_outer").write.option("compression", "zstd").parquet(path)
        joined = spark.read.parquet(path)
        matched = joined.where("timestamp_ms IS NOT NULL AND final_label IS NOT NULL")
        rows = _stored(spark, state, "open", last["run"]).unionByName(matched.withColumn("place", F.lit(None).cast("long")))
        # Rows carried over come first, in their places.
        placed = with_position(rows, [F.col("place").asc_nulls_last(), "timestamp_ms", "uuid"], total="_rows", stored=True)
        full = F.floor(F.col("_rows") / block_size) * block_size
        block = (F.floor((F.col("position") - 1) / block_size) + last["blocks"]).cast("long")
        closed = placed.where(F.col("position") <= full).groupBy(block.alias("block")).agg(
            F.count(F.lit(1)).alias("n"), F.avg((F.col("final_label") == F.col("prediction")).cast("double")).alias("accuracy"),
            F.min("timestamp_ms").alias("start_ms"), F.max("timestamp_ms").alias("end_ms"))
        _store(spark, closed, state, "blocks", run)
        _store(spark, placed.where(F.col("position") > full).withColumn("place", F.col("position")), state, "open", run)
        _store(spark, joined.where("final_label IS NULL"), state, "pending", run)
        _store(spark, joined.where("timestamp_ms IS NULL"), state, "early", run)
    blocks = last["blocks"] + spark.table(_table(state, "blocks")).where(F.col("run") == run).count()
    spark.sql(f"CREATE OR REPLACE VIEW {_table(state, 'progress')} AS SELECT CAST({run} AS BIGINT) AS run, CAST({log_no} AS BIGINT) AS log_no, "
              f"CAST({label_no} AS BIGINT) AS label_no, CAST({blocks} AS BIGINT) AS blocks")
    if run > 2:  # the state before the last stays for readers that have begun
        for part in ("open", "pending", "early"):
            spark.sql(f"ALTER TABLE {_table(state, part)} DROP IF EXISTS PARTITION (run = {run - 2})")
    return progress(spark, state)


def closed_blocks(spark: SparkSession, state: str) -> DataFrame:
    """``(block, n, accuracy, start_ms, end_ms)`` of all blocks of complete runs."""
    return spark.table(_table(state, "blocks")).where(F.col("run") <= progress(spark, state)["run"]).drop("run")


def waiting_predictions(spark: SparkSession, state: str) -> DataFrame:
    """Predictions that no label has reached yet."""
    return _stored(spark, state, "pending", progress(spark, state)["run"])
