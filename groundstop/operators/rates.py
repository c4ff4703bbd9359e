"""Cancellation rates by carrier, year, week and route.

One pass per rate: ``groupBy(keys).agg(count, sum(flag))``.  Spark runs a
partial aggregate in every scan task (map-side combine) and shuffles one
row per key and task, so a key that holds a third of all flights costs
nothing extra.  The two-aggregates-and-join form is kept once as
``rate_join_form`` for comparison; it scans the input twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundstop.functions import directed_route, iso_week, rate_percent, route_key


def _cancelled_flag(flag: str = "cancelled") -> Column:
    return F.when(F.col(flag) == 1, F.lit(1)).otherwise(F.lit(0))


def cancellation_rate(
    df: DataFrame,
    keys: Sequence[Column | str],
    *,
    total: str = "count_total",
    part: str = "count_delays",
    percent: str = "delay_percent",
    keep_zero: bool = False,
    flag: str = "cancelled",
) -> DataFrame:
    """Totals, cancellations and their percentage per group.

    Groups without a single cancellation are dropped (the inner-join
    semantics of the two-aggregate form) unless ``keep_zero``; so is a group
    whose key is null, which no join would match.
    """
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(total),
        F.sum(_cancelled_flag(flag)).cast("long").alias(part),
    )
    agg = agg.na.drop(subset=agg.columns[:len(keys)])
    if not keep_zero:
        agg = agg.where(F.col(part) > 0)
    return agg.withColumn(percent, rate_percent(part, total))


def rate_join_form(df: DataFrame, key: str = "op_carrier", flag: str = "cancelled") -> DataFrame:
    """Totals and cancellations as two aggregates joined on the key."""
    cancelled = (
        df.where(F.col(flag) == 1).groupBy(key).agg(F.count(F.lit(1)).alias("count_delays"))
    )
    totals = df.groupBy(key).agg(F.count(F.lit(1)).alias("count_total"))
    return (
        totals.join(cancelled, key)
        .select(key, "count_total", "count_delays")
        .withColumn("delay_percent", rate_percent("count_delays", "count_total"))
    )


def rate_by_carrier(df: DataFrame, keep_zero: bool = False) -> DataFrame:
    return cancellation_rate(df, ["op_carrier"], keep_zero=keep_zero)


def rate_by_year(df: DataFrame, keep_zero: bool = False) -> DataFrame:
    return cancellation_rate(
        df, [F.year("fl_date").cast("int").alias("year")],
        part="cancel_total", keep_zero=keep_zero,
    )


def rate_by_week(df: DataFrame, keep_zero: bool = False) -> DataFrame:
    return cancellation_rate(
        df, [iso_week("fl_date").alias("week")], part="cancel_total", keep_zero=keep_zero,
    )


def rate_by_route(df: DataFrame, keep_zero: bool = False) -> DataFrame:
    """Direction-free routes: ``A<>B`` counts flights both ways."""
    return cancellation_rate(
        df, [route_key("origin", "dest").alias("route")],
        total="count_all", part="count", percent="cancelled_percent", keep_zero=keep_zero,
    )


def cancelled_by_direction(df: DataFrame, flag: str = "cancelled") -> DataFrame:
    """Cancelled flights per directed route ``origin || dest``."""
    return (
        df.where(F.col(flag) == 1)
        .groupBy(directed_route("origin", "dest").alias("combo"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def all_rates(df: DataFrame, flag: str = "cancelled") -> DataFrame:
    """Every rate in one pass: ``(kind, key, count_total, count_delays, delay_percent)``.

    ``GROUPING SETS`` over carrier, year, ISO week, direction-free route and
    direction; each scan task keeps one partial row per key.  Groups without
    a cancellation or with a null key are left out, as in the single rates.
    """
    keys = {"carrier": "op_carrier", "year": "year", "week": "week", "route": "route", "direction": "combo"}
    rows = df.select(
        "op_carrier", F.year("fl_date").alias("year"), iso_week("fl_date").alias("week"),
        route_key("origin", "dest").alias("route"), directed_route("origin", "dest").alias("combo"), _cancelled_flag(flag).alias("_flag"))
    columns = [F.col(c) for c in keys.values()]
    sets = rows.groupingSets([[c] for c in columns], *columns).agg(
        *[F.grouping(c).alias(f"_not_{c}") for c in keys.values()],
        F.count(F.lit(1)).alias("count_total"), F.sum("_flag").cast("long").alias("count_delays"))
    kind = F.coalesce(*[F.when(F.col(f"_not_{c}") == 0, F.lit(k)) for k, c in keys.items()])
    key = F.coalesce(*[F.when(F.col(f"_not_{c}") == 0, F.col(c).cast("string")) for c in keys.values()])
    return (
        sets.select(kind.alias("kind"), key.alias("key"), "count_total", "count_delays")
        .where(F.col("key").isNotNull() & (F.col("count_delays") > 0))
        .withColumn("delay_percent", rate_percent("count_delays", "count_total"))
    )


def top_k(df: DataFrame, measure: str, key: str, k: int = 10) -> DataFrame:
    """First ``k`` rows by ``measure`` descending, ties by ``key``.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: every task keeps
    its own top ``k`` and only those rows travel; nothing is collected
    before the limit.
    """
    return df.orderBy(F.col(measure).desc(), F.col(key).asc()).limit(k)
