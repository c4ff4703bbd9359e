"""Registered queries: cancellation rates, routes, top-k, counts, null profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundstop import fixtures as fx
from groundstop.operators import profile, rates
from groundstop.plans.registry import query
from groundstop.plans.views import with_views
from groundstop.schemas import UNIFIED_COLUMNS
from groundstop.sources import load_tables

# --- oracle text -------------------------------------------------------------

_RATE_CARRIER_SQL = """
SELECT op_carrier, CAST(count(*) AS BIGINT) AS count_total,
  CAST(sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) AS BIGINT) AS count_delays,
  round(CAST(sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 6) AS delay_percent
FROM flights GROUP BY op_carrier
HAVING sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) > 0"""

_RATE_ROUTE_SQL = """
SELECT concat(least(origin, dest), '<>', greatest(origin, dest)) AS route,
  CAST(count(*) AS BIGINT) AS count_all,
  CAST(sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) AS BIGINT) AS count,
  round(CAST(sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 6) AS cancelled_percent
FROM flights GROUP BY 1
HAVING sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) > 0"""

_DIRECTED_SQL = """
SELECT concat(origin, dest) AS combo, CAST(count(*) AS BIGINT) AS count
FROM flights WHERE cancelled = 1 GROUP BY 1"""


def _rate_sql(expr: str, name: str) -> str:
    return f"""
SELECT CAST({expr} AS INT) AS {name}, CAST(count(*) AS BIGINT) AS count_total,
  CAST(sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) AS BIGINT) AS cancel_total,
  round(CAST(sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100, 6) AS delay_percent
FROM flights GROUP BY 1
HAVING sum(CASE WHEN cancelled = 1 THEN 1 ELSE 0 END) > 0"""


def _flights(spark, sf_dir):
    return fx.flights(load_tables(spark, sf_dir))


def _rounded(df, column="delay_percent"):
    """The operators keep full precision; the keys round for the comparison."""
    return df.withColumn(column, F.round(column, 6))


# --- rates -------------------------------------------------------------------


@query("rate_by_carrier", with_views(["flights"], _RATE_CARRIER_SQL + "\nORDER BY delay_percent DESC"), bench=True)
def rate_by_carrier(spark, sf_dir):
    return _rounded(rates.rate_by_carrier(_flights(spark, sf_dir))).orderBy(F.col("delay_percent").desc())


@query("rate_by_carrier_join", with_views(["flights"], _RATE_CARRIER_SQL), bench=True)
def rate_by_carrier_join(spark, sf_dir):
    return _rounded(rates.rate_join_form(_flights(spark, sf_dir), "op_carrier"))


@query("rate_by_year", with_views(["flights"], _rate_sql("year(fl_date)", "year") + "\nORDER BY year DESC"), bench=True)
def rate_by_year(spark, sf_dir):
    return _rounded(rates.rate_by_year(_flights(spark, sf_dir))).orderBy(F.col("year").desc())


@query("rate_by_week", with_views(["flights"], _rate_sql("weekofyear(fl_date)", "week") + "\nORDER BY week DESC"), bench=True)
def rate_by_week(spark, sf_dir):
    return _rounded(rates.rate_by_week(_flights(spark, sf_dir))).orderBy(F.col("week").desc())


@query("rate_by_route", with_views(["flights"], _RATE_ROUTE_SQL + "\nORDER BY cancelled_percent DESC"), bench=True)
def rate_by_route(spark, sf_dir):
    return _rounded(rates.rate_by_route(_flights(spark, sf_dir)), "cancelled_percent").orderBy(F.col("cancelled_percent").desc())


@query("cancelled_by_direction", with_views(["flights"], _DIRECTED_SQL), bench=True)
def cancelled_by_direction(spark, sf_dir):
    return rates.cancelled_by_direction(_flights(spark, sf_dir))


@query("top_carriers", with_views(["flights"], _RATE_CARRIER_SQL + "\nORDER BY CAST(count_delays AS DOUBLE) / CAST(count_total AS DOUBLE) * 100 DESC, op_carrier LIMIT 10"))
def top_carriers(spark, sf_dir):
    return _rounded(rates.top_k(rates.rate_by_carrier(_flights(spark, sf_dir)), "delay_percent", "op_carrier"))


@query("top_routes", with_views(["flights"], _RATE_ROUTE_SQL + "\nORDER BY CAST(count AS DOUBLE) / CAST(count_all AS DOUBLE) * 100 DESC, route LIMIT 10"), bench=True)
def top_routes(spark, sf_dir):
    return _rounded(rates.top_k(rates.rate_by_route(_flights(spark, sf_dir)), "cancelled_percent", "route"), "cancelled_percent")


@query("top_directed_routes", with_views(["flights"], _DIRECTED_SQL + "\nORDER BY count DESC, combo LIMIT 10"))
def top_directed_routes(spark, sf_dir):
    return rates.top_k(rates.cancelled_by_direction(_flights(spark, sf_dir)), "count", "combo")


# Flights with unknown carrier, date or airport: the two-aggregate inner join decides which groups remain.
_GAPS_SQL = """
SELECT CASE WHEN substring(row_key, 1, 1) = '1' THEN NULL ELSE op_carrier END AS op_carrier,
  CASE WHEN substring(row_key, 1, 1) = '2' THEN NULL ELSE fl_date END AS fl_date,
  CASE WHEN substring(row_key, 1, 1) = '3' THEN NULL ELSE origin END AS origin,
  CASE WHEN substring(row_key, 1, 1) IN ('3', '4') THEN NULL ELSE dest END AS dest, cancelled
FROM flights"""


def _joined_sql(kind: str, expr: str) -> str:
    return f"""
SELECT '{kind}' AS kind, CAST(t.k AS VARCHAR) AS key, t.n AS count_total, c.n AS count_delays
FROM (SELECT {expr} AS k, CAST(count(*) AS BIGINT) AS n FROM gaps GROUP BY 1) t
JOIN (SELECT {expr} AS k, CAST(count(*) AS BIGINT) AS n FROM gaps WHERE cancelled = 1 GROUP BY 1) c ON t.k = c.k"""


_ROUTE_EXPR = "CASE WHEN origin IS NOT NULL AND dest IS NOT NULL THEN concat(least(origin, dest), '<>', greatest(origin, dest)) END"


@query(
    "rates_with_gaps",
    with_views(
        ["flights"],
        "\nUNION ALL".join([
            _joined_sql("carrier", "op_carrier"), _joined_sql("year", "year(fl_date)"),
            _joined_sql("week", "weekofyear(fl_date)"), _joined_sql("route", _ROUTE_EXPR)]),
        extra=[("gaps", _GAPS_SQL)],
    ),
)
def rates_with_gaps(spark, sf_dir):
    """All rates in one pass over flights of which some lack the carrier, the date or an airport."""
    digit = F.substring("row_key", 1, 1)
    gaps = _flights(spark, sf_dir).select(
        F.when(digit != "1", F.col("op_carrier")).alias("op_carrier"), F.when(digit != "2", F.col("fl_date")).alias("fl_date"),
        F.when(digit != "3", F.col("origin")).alias("origin"), F.when(~digit.isin("3", "4"), F.col("dest")).alias("dest"), "cancelled")
    return rates.all_rates(gaps).where("kind <> 'direction'").select("kind", "key", "count_total", "count_delays")


# --- filters, counts, profile ------------------------------------------------


@query("filter_cancelled", with_views(["flights"], "SELECT * FROM flights WHERE cancelled = 1"))
def filter_cancelled(spark, sf_dir):
    return _flights(spark, sf_dir).where(F.col("cancelled") == 1)


@query("count_all", with_views(["flights"], "SELECT CAST(count(*) AS BIGINT) AS n FROM flights"))
def count_all(spark, sf_dir):
    return _flights(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


_NULL_COLS = UNIFIED_COLUMNS
_NULL_SQL = ",\n  ".join(f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in _NULL_COLS)
_UNUSED_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count FROM cancelled_rows"
    for c in _NULL_COLS
)


@query("null_profile", with_views(["flights"], f"SELECT\n  {_NULL_SQL}\nFROM flights WHERE cancelled = 1"), bench=True)
def null_profile(spark, sf_dir):
    f = _flights(spark, sf_dir).drop("row_key")
    return profile.null_counts(f.where(F.col("cancelled") == 1))


@query(
    "unused_columns",
    with_views(
        ["flights"],
        f"SELECT * FROM ({_UNUSED_SQL}) u WHERE null_count > 0",
        extra=[("cancelled_rows", "SELECT * FROM flights WHERE cancelled = 1")],
    ),
)
def unused_columns(spark, sf_dir):
    f = _flights(spark, sf_dir).drop("row_key")
    return profile.unused_columns(f.where(F.col("cancelled") == 1))
