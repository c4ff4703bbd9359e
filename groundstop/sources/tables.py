"""Catalog tables: save, create-if-absent, append, safe replace, describe, scan."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_database(spark: SparkSession, table: str) -> None:
    """Create the database (or catalog namespace) that a dotted table name lies in."""
    namespace, _, _ = table.rpartition(".")
    if namespace:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")


def save_table(df: DataFrame, table: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Save as a managed table, replacing any previous content."""
    ensure_database(df.sparkSession, table)
    writer = df.write.format(fmt).mode("overwrite")
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")  # about half of what the default writes of ids and texts
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    return table


def save_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, mode: str = "append", fmt: str = "parquet"
) -> str:
    """Write ``df`` hash-bucketed and sorted by ``key`` (append by default).

    Two tables bucketed on their join key with the same bucket count join
    without a shuffle (the sort-merge join reads bucket i of both sides in
    one task).  Choose ``buckets`` so a bucket holds a few hundred MB.  Rows
    are first dealt to the buckets, so a write leaves one file per bucket at
    most instead of one per task and bucket.
    """
    ensure_database(df.sparkSession, table)
    dealt = df.repartition(buckets, key)
    dealt.write.format(fmt).mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return table


def create_if_absent(df: DataFrame, table: str, fmt: str = "parquet") -> bool:
    """Write ``df`` only when ``table`` does not exist yet; True if written.

    The existence test looks at the target table itself (database and
    name), and ``mode("ignore")`` keeps a concurrent writer from replacing
    a table created in between.
    """
    spark = df.sparkSession
    ensure_database(spark, table)
    if spark.catalog.tableExists(table):
        return False
    df.write.format(fmt).mode("ignore").saveAsTable(table)
    return True


@contextlib.contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """Inserts replace the partitions that they have rows for (the writer's own option does not reach ``insertInto``)."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def save_slices(
    df: DataFrame, table: str, slices: list[str], sort: list[str], bloom: list[str] | None = None, fmt: str = "orc"
) -> str:
    """Write ``df`` as the slices (partitions named by the columns ``slices``) that it has rows for.

    Dynamic partition overwrite: the named slices are replaced as a whole, so
    a repeated load leaves one copy, and all others stay.  Rows are dealt by
    slice and the month of the first sort column (a date), so a slice with a
    third of all rows is written by many tasks, and sorted within the files;
    ORC's stripe statistics then skip stripes by the sort columns, and bloom
    filters by the columns named.
    """
    spark = df.sparkSession
    ensure_database(spark, table)
    order = [*slices, *sort]
    dealt = df.repartition(*slices, F.date_trunc("month", F.col(sort[0]))).sortWithinPartitions(*order)
    if spark.catalog.tableExists(table):
        with _dynamic_overwrite(spark):
            dealt.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
        return table
    writer = dealt.write.format(fmt).partitionBy(*slices)
    if bloom and fmt == "orc":
        writer = writer.option("orc.bloom.filter.columns", ",".join(bloom)).option("orc.bloom.filter.fpp", "0.01")
    writer.saveAsTable(table)
    return table


def append_table(df: DataFrame, table: str, fmt: str = "orc") -> str:
    """Append a slice; creates the table on first use."""
    ensure_database(df.sparkSession, table)
    df.write.format(fmt).mode("append").saveAsTable(table)
    return table


def replace_table(df: DataFrame, table: str, fmt: str = "parquet") -> str:
    """Replace the table's content and schema; the old table stays until the new one is written.

    The rows go to a table of another name first (``df`` may read the old
    one).  Only after that write has succeeded are the two exchanged by
    renaming, and the old one is put back if that fails.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:10]
    fresh, old = f"{table}__new_{mark}", f"{table}__old_{mark}"
    try:
        save_table(df, fresh, fmt)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    existed = spark.catalog.tableExists(table)
    if existed:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        if existed:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    if existed:
        spark.sql(f"DROP TABLE {old}")
    return table


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    """``SELECT *`` of a catalog table; later filters and projections push into the scan."""
    return spark.sql(f"SELECT * FROM {table}")


def show_tables(spark: SparkSession, database: str) -> DataFrame:
    """Tables of a database (``SHOW TABLES IN db``): namespace, tableName, isTemporary."""
    return spark.sql(f"SHOW TABLES IN {database}")


def show_databases(spark: SparkSession) -> DataFrame:
    """Databases of the current catalog (``SHOW DATABASES``)."""
    return spark.sql("SHOW DATABASES")


def describe_formatted(spark: SparkSession, table: str) -> DataFrame:
    """Columns and table properties (``DESCRIBE FORMATTED``)."""
    return spark.sql(f"DESCRIBE FORMATTED {table}")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    """Column names and types of a catalog table (``DESCRIBE TABLE``)."""
    return spark.sql(f"DESCRIBE TABLE {table}").where("col_name NOT LIKE '#%' AND col_name <> ''")
