"""Training sample, model features, category dictionaries, feature scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from groundstop.functions import content_key, hour_of_departure, iso_week
from groundstop.operators.monitor import with_position
from groundstop.operators.sampling import undersample
from groundstop.schemas import CATEGORICAL_FEATURES, FLIGHT_KEY, LABEL, NUMERIC_FEATURES, ROW_KEY, TRAINING_COLUMNS


def with_hour_week(df: DataFrame) -> DataFrame:
    """HOUR from the scheduled departure (``floor(HHMM / 100)``) and ISO WEEK from the date."""
    return df.withColumns({"hour": hour_of_departure("crs_dep_time"), "week": iso_week("fl_date")})


def training_sample(flights: DataFrame, fraction: float = 0.03, method: str = "hash") -> DataFrame:
    """All cancelled flights plus ``fraction`` of the others: row key + 12 columns.

    Input without a row key gets one from the columns that name a flight,
    so the hash sample and the later split stay repeatable and the scan
    reads no further columns for it.
    """
    if ROW_KEY not in flights.columns:
        flights = flights.withColumn(ROW_KEY, content_key(FLIGHT_KEY))
    sample = undersample(flights, fraction, method=method)
    return with_hour_week(sample).select(ROW_KEY, *TRAINING_COLUMNS)


def features_label(sample: DataFrame) -> DataFrame:
    """Complete rows only (null in any of the 12 columns drops the row), then features + label."""
    key = [ROW_KEY] if ROW_KEY in sample.columns else []
    complete = sample.na.drop(how="any", subset=TRAINING_COLUMNS)
    return complete.select(*key, *CATEGORICAL_FEATURES, *NUMERIC_FEATURES, LABEL)


def category_pairs(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """One ``(column_name, category)`` row per input row and column, from a single scan."""
    pairs = F.explode(
        F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category")) for c in columns
        ])
    )
    return df.select(*keep, pairs.alias("_p")).select(*keep, "_p.column_name", "_p.category")


def category_index(df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """``(column_name, category, idx)``: 0-based alphabetical index per column.

    The same order ``StringIndexer(stringOrderType="alphabetAsc")`` uses.
    One scan: the categorical columns are exploded into pairs and made
    distinct with partial aggregation in every task.  The categories are then
    range-sorted and numbered from the partitions' offsets (``with_position``),
    so a dictionary of any size is ranked by many tasks and never lies on the
    driver; what is broadcast is one row per column.
    """
    distinct = category_pairs(df, columns).where(F.col("category").isNotNull()).distinct()
    placed = with_position(distinct, ["column_name", "category"])
    first = placed.groupBy("column_name").agg(F.min("position").alias("_first"))
    return placed.join(F.broadcast(first), "column_name").select(
        "column_name", "category", (F.col("position") - F.col("_first")).cast("int").alias("idx"))


def onehot_slots(dictionary: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """The dictionary with ``slot``: each category's place in the one-hot vector, columns side by side in their order."""
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column_name"))
    sizes = dictionary.groupBy("column_name").agg(F.count(F.lit(1)).alias("_n"), F.first(place).alias("_place"))  # one row per column
    before = Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("column_name", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return dictionary.join(F.broadcast(starts), "column_name").select("column_name", "category", "idx", (F.col("idx") + F.col("_start")).cast("int").alias("slot"))


def with_index(
    df: DataFrame, dictionary: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, value: str = "idx", names: Sequence[str] | None = None
) -> DataFrame:
    """``df`` with each categorical column's ``value`` (``idx`` or ``slot``), looked up by join.

    Null for a category that is not in the dictionary.  A dictionary that
    Spark knows to be small is broadcast by it; a large one is shuffled.
    """
    names = names or [f"{c}_{value}" for c in columns]
    for c, name in zip(columns, names, strict=True):
        own = dictionary.where(F.col("column_name") == c).select(F.col("category").alias(c), F.col(value).alias(name))
        df = df.join(own, c, "left")
    return df


def indicator_scale(df: DataFrame, is_train: Column, columns: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """Population standard deviation, over the training rows, of every one-hot
    indicator and of the numeric features.

    The dictionary is every category of ``df`` (all rows, as the encoder is
    fitted); ``is_train`` marks the rows the scaler is fitted on.  For an
    indicator that is 1 on ``k`` of ``n`` training rows the variance is
    ``k (n - k) / n^2``; ``k`` comes from one grouped pass over exploded
    (column, category) pairs, so no wide vector is built.  The numeric
    features are further pairs without a category; their deviation is
    ``stddev_pop``, whose central moments merge across tasks without taking
    large sums apart.  The input is read once.
    ``df`` must have no nulls in ``columns`` (as after ``features_label``).
    Output ``(feature, std)`` with ``feature`` = ``column=category`` or the
    numeric column name.
    """
    none, no_value = F.lit(None).cast("string"), F.lit(None).cast("double")
    pairs = F.explode(F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("category"), no_value.alias("value")) for c in columns],
        *[F.struct(F.lit(c).alias("column_name"), none.alias("category"), F.col(c).cast("double").alias("value")) for c in NUMERIC_FEATURES]))
    flat = df.select(is_train.alias("_train"), pairs.alias("_p")).select("_train", "_p.*")
    grouped = flat.groupBy("column_name", "category").agg(
        F.count(F.when(F.col("_train"), 1)).cast("double").alias("k"),
        F.stddev_pop(F.when(F.col("_train"), F.col("value"))).alias("spread"))
    # Training rows per column: each has exactly one category per column.
    n = F.sum("k").over(Window.partitionBy("column_name"))
    numeric = F.col("column_name").isin(list(NUMERIC_FEATURES))
    return grouped.select(
        F.concat_ws("=", "column_name", "category").alias("feature"),
        F.when(numeric, F.col("spread")).otherwise(F.sqrt(F.col("k") * (n - F.col("k")) / (n * n))).alias("std"))
