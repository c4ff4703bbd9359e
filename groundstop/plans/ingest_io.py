"""Registered queries: ingest, CSV sources, catalog sinks, prototype and simulation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundstop import fixtures as fx, jobs
from groundstop.functions import flight_id, hour_of_departure, hour_padded_ref
from groundstop.operators import ingest, simulation
from groundstop.plans.registry import query
from groundstop.plans.views import with_views
from groundstop.schemas import LEGACY_DDL, MODERN_DDL, with_row_key
from groundstop.session import scratch_path, scratch_table
from groundstop.sources import (
    create_if_absent,
    describe_formatted,
    describe_table,
    load_tables,
    read_legacy_csv,
    read_modern_csv,
    save_table,
    scan_table,
    show_databases,
    write_csv,
)


# --- oracle text (fixed values: source and target columns, label formats) --------

# Legacy rows as the unified table holds them (times and flight number as integer text).
_LEGACY_NORM_SQL = """
SELECT row_key,
  make_date(CAST(year AS INT), CAST(month AS INT), CAST(dayofmonth AS INT)) AS fl_date,
  CAST(CAST(deptime AS BIGINT) AS VARCHAR) AS dep_time,
  CAST(CAST(crsdeptime AS BIGINT) AS VARCHAR) AS crs_dep_time,
  CAST(CAST(arrtime AS BIGINT) AS VARCHAR) AS arr_time,
  CAST(CAST(crsarrtime AS BIGINT) AS VARCHAR) AS crs_arr_time,
  uniquecarrier AS op_carrier,
  CAST(CAST(flightnum AS BIGINT) AS VARCHAR) AS op_carrier_fl_num,
  actualelapsedtime AS actual_elapsed_time, crselapsedtime AS crs_elapsed_time, airtime AS air_time,
  arrdelay AS arr_delay, depdelay AS dep_delay, origin, dest, distance,
  taxiin AS taxi_in, taxiout AS taxi_out, cancelled, cancellationcode AS cancellation_code,
  CAST(diverted AS DOUBLE) AS diverted, carrierdelay AS carrier_delay, weatherdelay AS weather_delay,
  nasdelay AS nas_delay, securitydelay AS security_delay, lateaircraftdelay AS late_aircraft_delay
FROM flights_raw_1"""

_SIM_SQL = """
SELECT row_key,
  concat_ws('*', CAST(fl_date AS VARCHAR), op_carrier, op_carrier_fl_num, origin, dest, CAST(crs_dep_time AS VARCHAR)) AS fl_id,
  CAST(fl_date AS VARCHAR) AS fl_date, op_carrier, op_carrier_fl_num, origin, dest,
  CAST(crs_dep_time AS VARCHAR) AS crs_dep_time, CAST(crs_arr_time AS VARCHAR) AS crs_arr_time,
  CAST(CAST(cancelled AS INT) AS VARCHAR) AS cancelled,
  CAST(crs_elapsed_time AS VARCHAR) AS crs_elapsed_time, CAST(distance AS VARCHAR) AS distance,
  left(lpad(CAST(CAST(crs_dep_time AS INT) AS VARCHAR), 4, '0'), 2) AS hour,
  CAST(weekofyear(fl_date) AS VARCHAR) AS week,
  CASE WHEN cancelled = 1 THEN 'YES' ELSE 'NO' END AS cancel
FROM flights"""

SIM_BLANK_SQL = _SIM_SQL.replace(
    "left(lpad(CAST(CAST(crs_dep_time AS INT) AS VARCHAR), 4, '0'), 2) AS hour",
    "CASE WHEN diverted = 1 THEN ' ' ELSE left(lpad(CAST(CAST(crs_dep_time AS INT) AS VARCHAR), 4, '0'), 2) END AS hour",
)

SIM_TEXT_COLS = ["row_key"] + simulation.SIMULATION_COLUMNS


def clean_sql() -> str:
    def col(c):
        v = c
        if c == "cancel":
            v = "CASE cancel WHEN 'YES' THEN 'Yes' WHEN 'NO' THEN 'No' ELSE cancel END"
        elif c == "cancelled":
            v = "CASE cancelled WHEN '1' THEN 'Yes' WHEN '0' THEN 'No' ELSE cancelled END"
        return f"CASE WHEN regexp_matches({v}, '^\\s$') THEN NULL ELSE {v} END AS {c}"

    return "SELECT " + ",\n  ".join(col(c) for c in SIM_TEXT_COLS) + "\nFROM sim_blank"


_DUCK_TYPE = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' ELSE lower(column_type) END"


def _t(spark, sf_dir):
    return load_tables(spark, sf_dir)


# --- ingest ------------------------------------------------------------------


@query("ingest_legacy_norm", with_views(["flights_raw_1"], _LEGACY_NORM_SQL), bench=True)
def ingest_legacy_norm(spark, sf_dir):
    return ingest.normalize_legacy(fx.flights_raw_1(_t(spark, sf_dir)))


@query("ingest_unified", with_views(["flights"], "SELECT * FROM flights"), bench=True)
def ingest_unified(spark, sf_dir):
    t = _t(spark, sf_dir)
    return ingest.unify(fx.flights_raw_1(t), fx.flights_raw_2(t))


@query("proto_slice_atl", with_views(["flights_raw_1"], _LEGACY_NORM_SQL + "\nWHERE origin = 'N01' AND year >= 1997"))
def proto_slice_atl(spark, sf_dir):
    return ingest.prototype_slice(fx.flights_raw_1(_t(spark, sf_dir)), "N01", 1997)


@query(
    "proto_slice_range",
    with_views(["flights_raw_1"], _LEGACY_NORM_SQL + "\nWHERE origin = 'N01' AND year >= 1995 AND year < 1997"),
)
def proto_slice_range(spark, sf_dir):
    """The SQL form: a projecting, filtering SELECT on a registered view of the raw rows."""
    view = scratch_table(spark, "flights_raw_1").split(".")[1]
    fx.flights_raw_1(_t(spark, sf_dir)).createOrReplaceTempView(view)
    try:
        return ingest.prototype_slice_sql(spark, view, "N01", 1995, 1997)
    finally:
        spark.catalog.dropTempView(view)


# --- sources -----------------------------------------------------------------


@query("src_csv_legacy", with_views(["flights_raw_1"], "SELECT * FROM flights_raw_1"))
def src_csv_legacy(spark, sf_dir):
    path = write_csv(fx.flights_raw_1(_t(spark, sf_dir)), scratch_path(spark, "set_1"))
    return read_legacy_csv(spark, path, with_row_key(LEGACY_DDL))


@query("src_csv_dir_na", with_views(["flights_raw_2"], "SELECT * FROM flights_raw_2"))
def src_csv_dir_na(spark, sf_dir):
    path = write_csv(fx.flights_raw_2(_t(spark, sf_dir)), scratch_path(spark, "set_2"), null_value="NA")
    return read_modern_csv(spark, path, with_row_key(MODERN_DDL))


_BROKEN_NAME, _BROKEN_VALUE = "row_key LIKE '%3'", "row_key LIKE '%7'"
_VALUE_TAIL = ",soon" + ",NA" * 26


@query(
    "src_csv_quarantine",
    with_views(
        ["flights_raw_2"],
        f"SELECT CASE WHEN {_BROKEN_NAME} OR {_BROKEN_VALUE} THEN 'quarantined' ELSE 'loaded' END AS status, "
        f"CASE WHEN {_BROKEN_NAME} THEN concat(row_key, ',cut off') WHEN {_BROKEN_VALUE} THEN concat(row_key, '{_VALUE_TAIL}') ELSE row_key END AS line, "
        f"CASE WHEN NOT ({_BROKEN_NAME} OR {_BROKEN_VALUE}) THEN distance END AS distance FROM flights_raw_2",
    ),
)
def src_csv_quarantine(spark, sf_dir):
    """Files with broken lines (too few fields; a date that is none) loaded, the broken lines set apart; a file with another header refused."""
    raw = fx.flights_raw_2(_t(spark, sf_dir))
    name, value = F.expr(_BROKEN_NAME), F.expr(_BROKEN_VALUE)
    folder = scratch_path(spark, "set_2")
    write_csv(raw.where(~(name | value)), folder, null_value="NA")
    # Lines as they are, below a header of their own.
    lines = raw.where(name | value).select(
        F.when(name, F.concat("row_key", F.lit(",cut off"))).otherwise(F.concat("row_key", F.lit(_VALUE_TAIL))).alias(",".join(raw.columns)))
    lines.write.mode("append").option("header", True).option("sep", "\u0001").csv(folder)  # a separator that no line has: nothing is quoted
    legacy = write_csv(fx.flights_raw_1(_t(spark, sf_dir)).limit(0), scratch_path(spark, "set_1"))
    table, quarantine = scratch_table(spark, "checked"), scratch_table(spark, "quarantine")
    jobs.ingest_job(spark, legacy, folder, table, with_key=True, quarantine=quarantine)

    turned = write_csv(raw.select("row_key", *reversed(raw.columns[1:])), scratch_path(spark, "turned"), null_value="NA")
    try:
        read_modern_csv(spark, turned, with_key=True).write.format("noop").mode("overwrite").save()
    except Exception as refused:  # noqa: BLE001 - Spark wraps it differently by place
        if "header" not in str(refused).lower():
            raise
    else:
        raise RuntimeError("a file with another header was read")
    loaded = spark.table(table).select(F.lit("loaded").alias("status"), F.col("row_key").alias("line"), "distance")
    return loaded.union(spark.table(quarantine).select(F.lit("quarantined"), "text", F.lit(None).cast("double")))


@query("src_table_scan", with_views(["flights"], "SELECT * FROM flights"))
def src_table_scan(spark, sf_dir):
    t = _t(spark, sf_dir)
    table = save_table(ingest.unify(fx.flights_raw_1(t), fx.flights_raw_2(t)), scratch_table(spark, "flights"))
    return scan_table(spark, table)


# --- sinks and catalog -------------------------------------------------------


@query("sink_parquet_table", with_views(["flights"], "SELECT * FROM flights"))
def sink_parquet_table(spark, sf_dir):
    table = save_table(fx.flights(_t(spark, sf_dir)), scratch_table(spark, "flights_pq"), "parquet")
    return spark.table(table)


@query("sink_create_if_absent", with_views(["flights"], "SELECT * FROM flights WHERE cancelled = 1"))
def sink_create_if_absent(spark, sf_dir):
    f = fx.flights(_t(spark, sf_dir))
    table = scratch_table(spark, "flights_once")
    first = create_if_absent(f.where(F.col("cancelled") == 1), table)
    second = create_if_absent(f, table)  # must leave the table as it is
    if not first or second:
        raise RuntimeError("create-if-absent wrote the wrong number of times")
    return spark.table(table)


_AIRPORTS = ["N01", "N02", "N03"]
_YEAR_SLICES = [(1997, None), (1995, 1997)]


@query(
    "sink_orc_append",
    with_views(["flights_raw_1"], _LEGACY_NORM_SQL + "\nWHERE origin IN ('N01', 'N02', 'N03') AND year >= 1995"),
)
def sink_orc_append(spark, sf_dir):
    """Three airports x two year ranges from one scan; one slice is loaded again and is there once."""
    raw = fx.flights_raw_1(_t(spark, sf_dir))
    table = scratch_table(spark, "flight_prototype")
    jobs.prototype_job(raw, table, _AIRPORTS, _YEAR_SLICES)
    jobs.prototype_job(raw, table, _AIRPORTS[1:2], _YEAR_SLICES[:1])
    return spark.table(table).drop("year_slice")


@query(
    "catalog_describe",
    with_views(
        ["flights"],
        f"SELECT column_name AS col_name, {_DUCK_TYPE} AS data_type FROM (DESCRIBE SELECT * FROM flights) "
        "UNION ALL VALUES ('# Provider', 'parquet'), ('# Type', 'MANAGED'), ('# Databases', '1')",
    ),
)
def catalog_describe(spark, sf_dir):
    """Columns of the saved flights table, two of its properties and its database."""
    table = save_table(fx.flights(_t(spark, sf_dir)), scratch_table(spark, "flights_desc"))
    properties = describe_formatted(spark, table).where(F.col("col_name").isin("Provider", "Type")).select(
        F.concat(F.lit("# "), F.col("col_name")).alias("col_name"), "data_type")
    databases = show_databases(spark).where(F.col("namespace") == table.rpartition(".")[0]).agg(
        F.lit("# Databases").alias("col_name"), F.count(F.lit(1)).cast("string").alias("data_type"))
    return describe_table(spark, table).select("col_name", "data_type").union(properties).union(databases)


@query("simulation_table", with_views(["flights"], _SIM_SQL))
def simulation_table(spark, sf_dir):
    """CREATE TABLE ... AS SELECT over the flights table, every column text."""
    view = scratch_table(spark, "flight_prototype").split(".")[1]
    simulation.simulation_frame(fx.flights(_t(spark, sf_dir))).createOrReplaceTempView(view)
    table = scratch_table(spark, "flight_simulation")
    spark.sql(f"CREATE TABLE {table} USING parquet AS SELECT * FROM {view}")
    spark.catalog.dropTempView(view)
    return spark.table(table)


# --- scalars -------------------------------------------------------------------


@query(
    "hour_of_departure",
    with_views(["flights"], "SELECT row_key, CAST(CAST(crs_dep_time AS INT) // 100 AS INT) AS hour FROM flights"),
    bench=True,
)
def q_hour_of_departure(spark, sf_dir):
    f = fx.flights(_t(spark, sf_dir))
    return f.select("row_key", hour_of_departure("crs_dep_time").alias("hour"))


@query(
    "hour_padded_ref",
    with_views(
        ["flights"],
        "SELECT row_key, CAST(substring(CASE WHEN length(crs_dep_time) = 4 THEN crs_dep_time "
        "ELSE concat('0', crs_dep_time) END, 1, 2) AS INT) AS hour_ref FROM flights",
    ),
)
def q_hour_padded_ref(spark, sf_dir):
    f = fx.flights(_t(spark, sf_dir))
    return f.select("row_key", hour_padded_ref("crs_dep_time").alias("hour_ref"))


@query(
    "flight_id",
    with_views(
        ["flights"],
        "SELECT row_key, concat_ws('*', CAST(fl_date AS VARCHAR), op_carrier, op_carrier_fl_num, origin, dest, "
        "crs_dep_time) AS fl_id FROM flights",
    ),
)
def q_flight_id(spark, sf_dir):
    f = fx.flights(_t(spark, sf_dir))
    return f.select(
        "row_key",
        flight_id("fl_date", "op_carrier", "op_carrier_fl_num", "origin", "dest", "crs_dep_time").alias("fl_id"),
    )


# --- simulation-set cleaning ------------------------------------------------------


def simulation_with_blank_hours(spark, sf_dir):
    """Simulation rows whose hour is one blank on diverted flights, so that
    the blank-to-null rule has work to do."""
    f = fx.flights(_t(spark, sf_dir))
    sim = simulation.simulation_frame(f, keep=["diverted"])
    return sim.withColumn(
        "hour", F.when(F.col("diverted") == 1, F.lit(" ")).otherwise(F.col("hour"))
    ).drop("diverted")


@query("class_balance", with_views(["flights"], "SELECT cancel, CAST(count(*) AS BIGINT) AS n FROM sim GROUP BY cancel",
                                   extra=[("sim", _SIM_SQL)]))
def class_balance(spark, sf_dir):
    sim = simulation.simulation_frame(fx.flights(_t(spark, sf_dir)))
    return sim.groupBy("cancel").agg(F.count(F.lit(1)).alias("n"))


@query("clean_values", with_views(["flights"], clean_sql(), extra=[("sim_blank", SIM_BLANK_SQL)]))
def clean_values(spark, sf_dir):
    return simulation.clean_values(simulation_with_blank_hours(spark, sf_dir))


@query(
    "clean_dropna",
    with_views(
        ["flights"],
        "SELECT * FROM cleaned WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in SIM_TEXT_COLS),
        extra=[("sim_blank", SIM_BLANK_SQL), ("cleaned", clean_sql())],
    ),
)
def clean_dropna(spark, sf_dir):
    return simulation.drop_incomplete(simulation.clean_values(simulation_with_blank_hours(spark, sf_dir)))


@query("sample_exact_n", with_views(["flights"], "SELECT * FROM sim ORDER BY md5(row_key), row_key LIMIT 1000",
                                    extra=[("sim", _SIM_SQL)]))
def sample_exact_n(spark, sf_dir):
    sim = simulation.simulation_frame(fx.flights(_t(spark, sf_dir)))
    return simulation.sample_exact(sim, 1000)

