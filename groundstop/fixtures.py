"""Views that shape the driver's TPC-H-like tables into flight data.

Mapping: shipment line -> flight; brand -> carrier; supplier nation ->
origin; customer nation -> destination; a returned line with discount >=
9% -> cancelled (about 5%, a minority class).  The same views exist as SQL
in ``groundstop.plans.views`` for the DuckDB check; here they are
DataFrame plans so that Catalyst prunes the columns each query needs down
to the parquet scans.

Joins are plain inner equi-joins: Spark picks broadcast only for sides its
statistics prove small (``autoBroadcastJoinThreshold`` / AQE runtime
sizes) and sort-merge otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from groundstop.schemas import UNIFIED_COLUMNS
from groundstop.session import scratch_path


def _memo(fn):
    """Build each view once per ``Tables`` object (a lazy plan; no data is cached)."""

    def wrapper(t, *args, **kwargs):
        if not hasattr(t, "view"):
            return fn(t, *args, **kwargs)
        key = fn.__name__ + repr(args) + repr(sorted(kwargs.items()))
        return t.view(key, lambda tt: fn(tt, *args, **kwargs))

    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


def _nation_code(c: str):
    return F.concat(F.lit("N"), F.lpad(F.col(c).cast("string"), 2, "0"))


def _when_flown(value):
    return F.when(F.col("cancelled") != 1, value)


def _when_delayed(value):
    return F.when((F.col("cancelled") == 0) & (F.col("qty") >= 30), value)


_SPLIT_TS = "1999-01-01 00:00:00"


@_memo
def flights_full(t, shipped: str | None = None) -> DataFrame:
    """Modern-layout flights plus ``row_key`` and three helper columns.

    Orders find their customers first, by rows of two columns; lines are then
    joined to orders, suppliers and parts, so the fact-sized line table is the
    probe side throughout and is dealt out by the order once, not also by the
    customer.  What only the flag needs does not travel through the joins.
    Spark picks each join's strategy.
    ``shipped`` = ``"before"`` / ``"from"`` keeps lines shipped before /
    from 1999-01-01 with a range predicate on the raw column, which the
    parquet scan can use to skip row groups.
    """
    li, o, c, s, p = t["lineitem"], t["orders"], t["customer"], t["supplier"], t["part"]
    if shipped is not None:
        bound = F.lit(_SPLIT_TS).cast("timestamp_ntz")
        li = li.where(F.col("l_shipdate") < bound if shipped == "before" else F.col("l_shipdate") >= bound)
    cancelled = F.when(
        (F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.09), F.lit(1.0)
    ).otherwise(F.lit(0.0))
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
                   cancelled.alias("cancelled"))
    with_nation = li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
    joined = with_nation.join(s, li.l_suppkey == s.s_suppkey).join(p, li.l_partkey == p.p_partkey)
    base = joined.select(
        F.concat_ws(
            "-",
            F.col("l_orderkey").cast("string"),
            F.col("l_linenumber").cast("string"),
            F.col("l_partkey").cast("string"),
            F.col("l_suppkey").cast("string"),
            F.round(F.col("l_extendedprice") * 100).cast("long").cast("string"),
        ).alias("row_key"),
        F.col("l_shipdate").cast("date").alias("fl_date"),
        F.col("p_brand").alias("op_carrier"),
        F.col("l_partkey").cast("string").alias("op_carrier_fl_num"),
        _nation_code("s_nationkey").alias("origin"),
        _nation_code("c_nationkey").alias("dest"),
        ((F.col("l_orderkey") % 24) * 100 + F.col("l_partkey") % 60).cast("string").alias("crs_dep_time"),
        (((F.col("l_orderkey") + 2) % 24) * 100 + F.col("l_partkey") % 60).cast("string").alias("crs_arr_time"),
        (F.lit(30) + F.col("l_partkey") % 300).cast("double").alias("crs_elapsed_time"),
        F.floor(F.col("l_extendedprice") / 50).cast("double").alias("distance"),
        "cancelled",
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("diverted"),
        F.col("l_quantity").alias("qty"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_orderkey").alias("order_no"),
    )
    return base.select(
        "*",
        _when_flown(F.col("crs_dep_time")).alias("dep_time"),
        _when_flown(F.col("crs_arr_time")).alias("arr_time"),
        _when_flown(F.col("crs_elapsed_time") + 5).alias("actual_elapsed_time"),
        _when_flown(F.col("crs_elapsed_time") - 20).alias("air_time"),
        _when_flown(F.col("qty") - 10).alias("dep_delay"),
        _when_flown(F.col("qty") - 5).alias("arr_delay"),
        _when_flown(F.lit(4.0)).alias("taxi_in"),
        _when_flown(F.lit(11.0)).alias("taxi_out"),
        F.when(F.col("cancelled") == 1, F.expr("substring('ABCD', CAST(line_no % 4 + 1 AS INT), 1)"))
        .alias("cancellation_code"),
        _when_delayed(F.col("qty") - 30).alias("carrier_delay"),
        _when_delayed(F.col("line_no").cast("double")).alias("weather_delay"),
        _when_delayed(F.lit(1.0)).alias("nas_delay"),
        _when_delayed(F.lit(0.0)).alias("security_delay"),
        _when_delayed(F.lit(2.0)).alias("late_aircraft_delay"),
    )


@_memo
def flights(t) -> DataFrame:
    """The unified flights table: ``row_key`` + the 25 unified columns."""
    return flights_full(t).select("row_key", *UNIFIED_COLUMNS)


@_memo
def flights_raw_1(t) -> DataFrame:
    """Legacy layout (all numbers double), rows before 1999."""
    f = flights_full(t, shipped="before")
    d = lambda c: F.col(c).cast("double")
    return f.select(
        "row_key",
        F.month("fl_date").cast("double").alias("month"),
        F.dayofmonth("fl_date").cast("double").alias("dayofmonth"),
        (F.dayofmonth("fl_date") % 7 + 1).cast("double").alias("dayofweek"),
        d("dep_time").alias("deptime"),
        d("crs_dep_time").alias("crsdeptime"),
        d("arr_time").alias("arrtime"),
        d("crs_arr_time").alias("crsarrtime"),
        F.col("op_carrier").alias("uniquecarrier"),
        d("op_carrier_fl_num").alias("flightnum"),
        F.concat(F.lit("T"), F.col("op_carrier_fl_num")).alias("tailnum"),
        F.col("actual_elapsed_time").alias("actualelapsedtime"),
        F.col("crs_elapsed_time").alias("crselapsedtime"),
        F.col("air_time").alias("airtime"),
        F.col("arr_delay").alias("arrdelay"),
        F.col("dep_delay").alias("depdelay"),
        "origin",
        "dest",
        "distance",
        F.col("taxi_in").alias("taxiin"),
        F.col("taxi_out").alias("taxiout"),
        "cancelled",
        F.col("cancellation_code").alias("cancellationcode"),
        "diverted",
        F.col("carrier_delay").alias("carrierdelay"),
        F.col("weather_delay").alias("weatherdelay"),
        F.col("nas_delay").alias("nasdelay"),
        F.col("security_delay").alias("securitydelay"),
        F.col("late_aircraft_delay").alias("lateaircraftdelay"),
        F.year("fl_date").cast("double").alias("year"),
    )


@_memo
def flights_raw_2(t) -> DataFrame:
    """Modern layout (times as text, ``NA`` for missing in the files), rows from 1999."""
    f = flights_full(t, shipped="from")
    return f.select(
        "row_key", "fl_date", "op_carrier", "op_carrier_fl_num", "origin", "dest",
        "crs_dep_time", "dep_time", "dep_delay", "taxi_out",
        F.col("dep_time").alias("wheels_off"), F.col("arr_time").alias("wheels_on"),
        "taxi_in", "crs_arr_time", "arr_time", "arr_delay", "cancelled", "cancellation_code",
        "diverted", "crs_elapsed_time", "actual_elapsed_time", "air_time", "distance",
        "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
    )


@_memo
def scored(t, with_feature: bool = False) -> DataFrame:
    """Scored log from a fixed rule standing in for a model (exact results).

    ``with_feature`` adds the request text the model was called with
    (``carrier,origin,dest,week,hour``), taken in the same pass.
    """
    return _scored_lines(t, with_feature).drop("final_label", "labelled")


def _final_label():
    return F.when(F.col("cancelled") == 1, F.lit(1)).otherwise(F.lit(0)).alias("final_label")


def _has_label():
    return F.col("line_no") != 7


def _scored_lines(t, with_feature: bool) -> DataFrame:
    """The scored log with each line's ground truth and whether that has arrived."""
    f = flights_full(t)
    r = (F.col("order_no") * 7 + F.col("line_no") * 13) % 101
    cols = [
        F.col("row_key").alias("uuid"),
        (F.lit(1700000000000) + F.col("order_no") * 1000 + F.col("line_no")).cast("long").alias("timestamp_ms"),
        (r.cast("double") / 100).alias("p_cancel"),
        F.when(r >= 50, F.lit(1)).otherwise(F.lit(0)).alias("prediction"),
    ]
    if with_feature:
        from groundstop.functions import hour_text, iso_week

        cols.append(
            F.concat_ws(
                ",", "op_carrier", "origin", "dest", iso_week("fl_date").cast("string"), hour_text("crs_dep_time")
            ).alias("feature")
        )
    return f.select(*cols, _final_label(), _has_label().alias("labelled"))


@_memo
def late_labels(t) -> DataFrame:
    """Ground truth that arrives later; rows of line 7 are still pending."""
    return flights_full(t).where(_has_label()).select(F.col("row_key").alias("uuid"), _final_label())


def stored_log(t, with_feature: bool = False) -> tuple[DataFrame, DataFrame]:
    """``scored`` and ``late_labels``, read from one stored pass over the flights.

    The same rows as the two views; a job that reads both, or one of them
    several times, runs the flights' joins once.
    """
    log = scored(t, with_feature)
    path = scratch_path(t.spark, "log")
    _scored_lines(t, with_feature).write.option("compression", "zstd").parquet(path)
    kept = t.spark.read.parquet(path)
    return kept.select(log.columns), kept.where("labelled").select("uuid", "final_label")


@_memo
def registry_flat(t) -> DataFrame:
    """Flat base columns of the model registry and of the models' deployment status (one record per supplier)."""
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    creator = (F.col("s_suppkey") % 7).cast("int")
    text = lambda prefix, c: F.concat(F.lit(prefix), c)
    return t["supplier"].select(
        key.alias("id"),
        F.col("s_nationkey").cast("int").alias("project_id"),
        text("Project ", nation).alias("project_name"),
        text("proj-", nation).alias("project_slug"),
        text("crn:project:", nation).alias("project_crn"),
        F.lit("engine").alias("project_engine"),
        (F.col("s_nationkey") + 100).cast("int").alias("owner_id"),
        text("owner-", nation).alias("owner_username"),
        F.lit("user").alias("owner_type"),
        text("crn:model:", key).alias("crn"),
        creator.alias("creator_id"),
        text("user-", creator.cast("string")).alias("creator_username"),
        F.lit("user").alias("creator_type"),
        F.col("s_name").alias("name"),
        F.lower("s_name").alias("description"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("private")).otherwise(F.lit("public")).alias("visibility"),
        text("key-", key).alias("access_key"),
        (F.col("s_acctbal") > 0).alias("auth_enabled"),
        (F.col("s_suppkey") % 4 * 1000 + 1000).cast("int").alias("cpu_millicores"),
        F.lit(2048).alias("memory_mb"),
        F.lit("fixed").alias("policy_type"),
        (F.col("s_suppkey") % 3 + 1).cast("int").alias("num_replicas"),
        text("/models/", key).alias("html_url"),
        F.lit("2020-01-01").alias("created_at"),
        F.lit("2020-02-02").alias("updated_at"),
        F.lit(None).cast("string").alias("namespace"),
        F.when(F.col("s_acctbal") > 0, F.lit("deployed")).otherwise(F.lit("stopped")).alias("deployment_status"),
        (F.col("s_suppkey") % 3).cast("int").alias("replicas_available"),
    )
