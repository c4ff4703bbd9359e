"""The fixture views as SQL text, for the DuckDB oracle.

Each oracle string must be self-contained (only the base tables are
registered), so the views are inlined as CTEs in dependency order.
"""

from __future__ import annotations

VIEW_SQL: dict[str, str] = {
    "flights_full": """
SELECT b.*,
  CASE WHEN cancelled = 1 THEN NULL ELSE crs_dep_time END AS dep_time,
  CASE WHEN cancelled = 1 THEN NULL ELSE crs_arr_time END AS arr_time,
  CASE WHEN cancelled = 1 THEN NULL ELSE crs_elapsed_time + 5 END AS actual_elapsed_time,
  CASE WHEN cancelled = 1 THEN NULL ELSE crs_elapsed_time - 20 END AS air_time,
  CASE WHEN cancelled = 1 THEN NULL ELSE qty - 10 END AS dep_delay,
  CASE WHEN cancelled = 1 THEN NULL ELSE qty - 5 END AS arr_delay,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST(4 AS DOUBLE) END AS taxi_in,
  CASE WHEN cancelled = 1 THEN NULL ELSE CAST(11 AS DOUBLE) END AS taxi_out,
  CASE WHEN cancelled = 1 THEN substring('ABCD', CAST(line_no % 4 + 1 AS INT), 1) END AS cancellation_code,
  CASE WHEN cancelled = 0 AND qty >= 30 THEN qty - 30 END AS carrier_delay,
  CASE WHEN cancelled = 0 AND qty >= 30 THEN CAST(line_no AS DOUBLE) END AS weather_delay,
  CASE WHEN cancelled = 0 AND qty >= 30 THEN CAST(1 AS DOUBLE) END AS nas_delay,
  CASE WHEN cancelled = 0 AND qty >= 30 THEN CAST(0 AS DOUBLE) END AS security_delay,
  CASE WHEN cancelled = 0 AND qty >= 30 THEN CAST(2 AS DOUBLE) END AS late_aircraft_delay
FROM (
  SELECT
    concat(CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(20)), '-',
           CAST(l_partkey AS VARCHAR(20)), '-', CAST(l_suppkey AS VARCHAR(20)), '-',
           CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR(20))) AS row_key,
    CAST(l_shipdate AS DATE) AS fl_date,
    p_brand AS op_carrier,
    CAST(l_partkey AS VARCHAR(20)) AS op_carrier_fl_num,
    concat('N', lpad(CAST(s_nationkey AS VARCHAR(20)), 2, '0')) AS origin,
    concat('N', lpad(CAST(c_nationkey AS VARCHAR(20)), 2, '0')) AS dest,
    CAST((l_orderkey % 24) * 100 + l_partkey % 60 AS VARCHAR(20)) AS crs_dep_time,
    CAST(((l_orderkey + 2) % 24) * 100 + l_partkey % 60 AS VARCHAR(20)) AS crs_arr_time,
    CAST(30 + l_partkey % 300 AS DOUBLE) AS crs_elapsed_time,
    CAST(floor(l_extendedprice / 50) AS DOUBLE) AS distance,
    CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cancelled,
    CASE WHEN l_suppkey % 50 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS diverted,
    l_quantity AS qty, l_linenumber AS line_no, l_orderkey AS order_no
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
) b""",
    "flights": """
SELECT row_key, fl_date, dep_time, crs_dep_time, arr_time, crs_arr_time, op_carrier,
  op_carrier_fl_num, actual_elapsed_time, crs_elapsed_time, air_time, arr_delay, dep_delay,
  origin, dest, distance, taxi_in, taxi_out, cancelled, cancellation_code, diverted,
  carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay
FROM flights_full""",
    "flights_raw_1": """
SELECT row_key,
  CAST(month(fl_date) AS DOUBLE) AS month, CAST(day(fl_date) AS DOUBLE) AS dayofmonth,
  CAST(day(fl_date) % 7 + 1 AS DOUBLE) AS dayofweek,
  CAST(dep_time AS DOUBLE) AS deptime, CAST(crs_dep_time AS DOUBLE) AS crsdeptime,
  CAST(arr_time AS DOUBLE) AS arrtime, CAST(crs_arr_time AS DOUBLE) AS crsarrtime,
  op_carrier AS uniquecarrier, CAST(op_carrier_fl_num AS DOUBLE) AS flightnum,
  concat('T', op_carrier_fl_num) AS tailnum,
  actual_elapsed_time AS actualelapsedtime, crs_elapsed_time AS crselapsedtime, air_time AS airtime,
  arr_delay AS arrdelay, dep_delay AS depdelay, origin, dest, distance,
  taxi_in AS taxiin, taxi_out AS taxiout, cancelled, cancellation_code AS cancellationcode, diverted,
  carrier_delay AS carrierdelay, weather_delay AS weatherdelay, nas_delay AS nasdelay,
  security_delay AS securitydelay, late_aircraft_delay AS lateaircraftdelay,
  CAST(year(fl_date) AS DOUBLE) AS year
FROM flights_full WHERE year(fl_date) < 1999""",
    "flights_raw_2": """
SELECT row_key, fl_date, op_carrier, op_carrier_fl_num, origin, dest, crs_dep_time, dep_time, dep_delay,
  taxi_out, dep_time AS wheels_off, arr_time AS wheels_on, taxi_in, crs_arr_time, arr_time, arr_delay,
  cancelled, cancellation_code, diverted, crs_elapsed_time, actual_elapsed_time, air_time, distance,
  carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay
FROM flights_full WHERE year(fl_date) >= 1999""",
    "scored": """
SELECT row_key AS uuid,
  CAST(1700000000000 + order_no * 1000 + line_no AS BIGINT) AS timestamp_ms,
  CAST((order_no * 7 + line_no * 13) % 101 AS DOUBLE) / 100 AS p_cancel,
  CASE WHEN (order_no * 7 + line_no * 13) % 101 >= 50 THEN 1 ELSE 0 END AS prediction
FROM flights_full""",
    "scored_requests": """
SELECT row_key AS uuid,
  CAST(1700000000000 + order_no * 1000 + line_no AS BIGINT) AS timestamp_ms,
  CAST((order_no * 7 + line_no * 13) % 101 AS DOUBLE) / 100 AS p_cancel,
  CASE WHEN (order_no * 7 + line_no * 13) % 101 >= 50 THEN 1 ELSE 0 END AS prediction,
  concat_ws(',', op_carrier, origin, dest, CAST(weekofyear(fl_date) AS VARCHAR),
            left(lpad(CAST(CAST(crs_dep_time AS INT) AS VARCHAR), 4, '0'), 2)) AS feature
FROM flights_full""",
    "late_labels": """
SELECT row_key AS uuid, CASE WHEN cancelled = 1 THEN 1 ELSE 0 END AS final_label
FROM flights_full WHERE line_no <> 7""",
    "registry_flat": """
SELECT CAST(s_suppkey AS VARCHAR(20)) AS id, CAST(s_nationkey AS INT) AS project_id,
  concat('Project ', CAST(s_nationkey AS VARCHAR(20))) AS project_name,
  concat('proj-', CAST(s_nationkey AS VARCHAR(20))) AS project_slug,
  concat('crn:project:', CAST(s_nationkey AS VARCHAR(20))) AS project_crn, 'engine' AS project_engine,
  CAST(s_nationkey + 100 AS INT) AS owner_id, concat('owner-', CAST(s_nationkey AS VARCHAR(20))) AS owner_username,
  'user' AS owner_type, concat('crn:model:', CAST(s_suppkey AS VARCHAR(20))) AS crn,
  CAST(s_suppkey % 7 AS INT) AS creator_id, concat('user-', CAST(s_suppkey % 7 AS VARCHAR(20))) AS creator_username,
  'user' AS creator_type, s_name AS name, lower(s_name) AS description,
  CASE WHEN s_suppkey % 2 = 0 THEN 'private' ELSE 'public' END AS visibility,
  concat('key-', CAST(s_suppkey AS VARCHAR(20))) AS access_key, s_acctbal > 0 AS auth_enabled,
  CAST(s_suppkey % 4 * 1000 + 1000 AS INT) AS cpu_millicores, CAST(2048 AS INT) AS memory_mb, 'fixed' AS policy_type,
  CAST(s_suppkey % 3 + 1 AS INT) AS num_replicas, concat('/models/', CAST(s_suppkey AS VARCHAR(20))) AS html_url,
  '2020-01-01' AS created_at, '2020-02-02' AS updated_at, CAST(NULL AS VARCHAR(20)) AS namespace,
  CASE WHEN s_acctbal > 0 THEN 'deployed' ELSE 'stopped' END AS deployment_status,
  CAST(s_suppkey % 3 AS INT) AS replicas_available
FROM supplier""",
}

VIEW_DEPS: dict[str, tuple[str, ...]] = {
    "flights_full": (),
    "flights": ("flights_full",),
    "flights_raw_1": ("flights_full",),
    "flights_raw_2": ("flights_full",),
    "scored": ("flights_full",),
    "scored_requests": ("flights_full",),
    "late_labels": ("flights_full",),
    "registry_flat": (),
}


def with_views(views: list[str] | tuple[str, ...], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH v1 AS (...), ... <body>`` with all dependencies, in order.

    ``extra`` adds further named CTEs (name, sql) after the views.
    """
    order: list[str] = []

    def add(v: str) -> None:
        for dep in VIEW_DEPS[v]:
            add(dep)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    ctes = [f"{v} AS ({VIEW_SQL[v]}\n)" for v in order]
    ctes += [f"{name} AS ({sql}\n)" for name, sql in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n" + body
