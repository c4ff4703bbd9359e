"""Missing-value profile: null count per column in one global aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame) -> DataFrame:
    """One row; for each column, how many of its values are null.

    A single pass: every scan task emits one partial row, the final
    aggregate adds them up.
    """
    return df.agg(
        *[F.sum(F.isnull(F.col(c)).cast("int")).cast("long").alias(c) for c in df.columns]
    )


def unused_columns(df: DataFrame, min_count: int = 1) -> DataFrame:
    """``(column_name, null_count)`` for columns with at least ``min_count`` nulls.

    The one-row profile is turned sideways with ``unpivot`` in Spark; no
    round trip through pandas.
    """
    wide = null_counts(df)
    long = wide.unpivot([], wide.columns, "column_name", "null_count")
    return long.where(F.col("null_count") >= min_count)
