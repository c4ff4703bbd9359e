"""Tables that grow by numbered batches, each written once however often it is tried.

A batch has a name given by its writer and a number given here.  Its rows
are one partition (``batch_no``), bucketed on the key, and the batch counts
only once it is in the register ``<table>__batches``: a batch found there is
not written again, one that was cut off before is overwritten as a whole,
and readers see registered batches only.  Numbers grow, so what came after a
known number is a partition filter.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundstop.sources.tables import ensure_database

BATCH_NO = "batch_no"


def now_ms() -> int:
    """The current time in epoch milliseconds."""
    return time.time_ns() // 1_000_000


def register_of(table: str) -> str:
    return f"{table}__batches"


def batches(spark: SparkSession, table: str) -> DataFrame:
    """``(batch, batch_no, started_ms)`` of every complete batch."""
    if not spark.catalog.tableExists(register_of(table)):
        return spark.createDataFrame([], "batch string, batch_no long, started_ms long")
    return spark.table(register_of(table))


def known_batch(spark: SparkSession, table: str, batch: str) -> tuple[int, int] | None:
    """``(batch_no, started_ms)`` of a complete batch."""
    row = batches(spark, table).where(F.col("batch") == batch).first()
    return (row["batch_no"], row["started_ms"]) if row else None


def append_batch(rows: DataFrame, table: str, batch: str, key: str, buckets: int, started_ms: int | None = None, fmt: str = "parquet") -> bool:
    """Append a batch, bucketed and sorted by ``key``; False if it is there already.  One writer at a time."""
    spark = rows.sparkSession
    ensure_database(spark, table)
    if known_batch(spark, table, batch) is not None:
        return False
    number = (batches(spark, table).agg(F.max(BATCH_NO)).first()[0] or 0) + 1
    dealt = rows.repartition(buckets, key)
    if spark.catalog.tableExists(table):
        names = [c for c in spark.table(table).columns if c != BATCH_NO]
        view = f"batch_{uuid.uuid4().hex}"
        dealt.select(*names).createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({BATCH_NO} = {number}) SELECT * FROM {view}")
        finally:
            spark.catalog.dropTempView(view)
    else:
        dealt = dealt.withColumn(BATCH_NO, F.lit(number).cast("long"))
        dealt.write.format(fmt).option("compression", "zstd").partitionBy(BATCH_NO).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    stamp = spark.createDataFrame([(batch, number, now_ms() if started_ms is None else started_ms)], "batch string, batch_no long, started_ms long")
    stamp.write.format(fmt).mode("append").saveAsTable(register_of(table))
    return True


def new_batches(spark: SparkSession, table: str, after: int = 0) -> tuple[DataFrame, int]:
    """The rows of the complete batches numbered above ``after`` (a partition filter), and the highest number."""
    last = batches(spark, table).agg(F.max(BATCH_NO)).first()[0] or 0
    return spark.table(table).where((F.col(BATCH_NO) > after) & (F.col(BATCH_NO) <= last)), last
