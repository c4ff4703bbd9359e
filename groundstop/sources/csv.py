"""CSV layouts, always read with an explicit schema (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from groundstop.schemas import (
    LEGACY_DDL,
    LEGACY_SCHEMA,
    MODERN_DDL,
    MODERN_SCHEMA,
    REGISTRY_DDL,
    TRAINING_SCHEMA,
    with_row_key,
)


#: Column that holds the text of a line that does not fit the layout.
RESCUED = "_rescued"
#: Column that names the file of a line.
SOURCE_FILE = "_source_file"


def _read_layout(
    spark: SparkSession, path: str, schema: T.StructType, null_value: str | None = None, broken: str = "fail"
) -> DataFrame:
    """Header CSV in a declared layout.

    Columns are read by position, so every file's header must name the
    layout's columns in order; another header is refused.  ``broken``: what a
    line with more or fewer fields, or with a value that is not of its
    column's type, does.  ``"fail"``: it fails the job.  ``"rescue"``: it
    comes back with its text in ``_rescued`` (null in whole lines) and its
    file in ``_source_file``.  All fields are parsed whichever columns are
    selected later, so the same lines are found every time.
    """
    reader = spark.read.option("header", True).option("sep", ",").option("enforceSchema", False).option("columnPruning", False)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if broken == "fail":
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    if broken != "rescue":
        raise ValueError(f"broken must be 'fail' or 'rescue', not {broken!r}")
    wide = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType())])
    rows = reader.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED).csv(path)
    return rows.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))


def read_legacy_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, with_key: bool = False, broken: str = "fail"
) -> DataFrame:
    """One header CSV (or a folder of them) in the legacy layout (29 columns).

    ``with_key``: the files carry a leading ``row_key`` column (test fixtures).
    """
    return _read_layout(spark, path, schema or (with_row_key(LEGACY_DDL) if with_key else LEGACY_SCHEMA), broken=broken)


def read_modern_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, with_key: bool = False, broken: str = "fail"
) -> DataFrame:
    """A folder of header CSV files in the modern layout (27 columns); ``NA`` is null."""
    return _read_layout(spark, path, schema or (with_row_key(MODERN_DDL) if with_key else MODERN_SCHEMA), "NA", broken)


def whole_rows(rescued: DataFrame) -> DataFrame:
    """The lines that fit the layout (of a frame read with ``broken="rescue"``)."""
    return rescued.where(F.col(RESCUED).isNull()).drop(RESCUED, SOURCE_FILE)


def broken_rows(rescued: DataFrame, layout: str) -> DataFrame:
    """``(layout, source_file, text, fields_read)`` of the lines that do not fit; ``fields_read`` is what could be read, as JSON."""
    fields = [c for c in rescued.columns if c not in (RESCUED, SOURCE_FILE)]
    return rescued.where(F.col(RESCUED).isNotNull()).select(
        F.lit(layout).alias("layout"), F.col(SOURCE_FILE).alias("source_file"), F.col(RESCUED).alias("text"),
        F.to_json(F.struct(*fields)).alias("fields_read"))


def read_training_csv(spark: SparkSession, path: str, with_key: bool = False) -> DataFrame:
    """The exported training sample read back with its declared types."""
    schema = T.StructType(
        ([T.StructField("row_key", T.StringType())] if with_key else []) + TRAINING_SCHEMA.fields
    )
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str, null_value: str | None = None, mode: str = "overwrite") -> str:
    """Write a header CSV folder in parallel (one file per task, no collect)."""
    writer = df.write.mode(mode).option("header", True)
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)
    return path


def read_registry_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Nested registry records (JSON lines) with an explicit nested schema: structs, no maps."""
    return spark.read.schema(schema or REGISTRY_DDL).json(path)
