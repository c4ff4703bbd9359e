"""Physical-plan properties: pushdown, pruning, partial aggregation, bounded top-k."""

from pyspark.sql import functions as F

from groundstop import fixtures as fx
from groundstop.functions import blank_to_null
from groundstop.operators import rates
from groundstop.session import scratch_table
from groundstop.sources import load_tables, save_table, scan_table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _stored_flights(spark, sf_dir):
    table = save_table(fx.flights(load_tables(spark, sf_dir)), scratch_table(spark, "flights_plan"))
    return scan_table(spark, table)


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    flights = _stored_flights(spark, sf_dir)
    plan = _plan(rates.cancelled_by_direction(flights))
    assert "PushedFilters: [IsNotNull(cancelled), EqualTo(cancelled,1.0)]" in plan
    assert "ReadSchema: struct<origin:string,dest:string,cancelled:double>" in plan


def test_rate_is_one_scan_with_partial_aggregation(spark, sf_dir):
    flights = _stored_flights(spark, sf_dir)
    plan = _plan(rates.rate_by_carrier(flights))
    assert plan.count("Scan parquet") == 1
    assert "partial_count" in plan and "partial_sum" in plan
    assert "ReadSchema: struct<op_carrier:string,cancelled:double>" in plan


def test_top_k_is_take_ordered(spark, sf_dir):
    flights = _stored_flights(spark, sf_dir)
    df = rates.top_k(rates.rate_by_route(flights), "cancelled_percent", "route")
    assert "TakeOrderedAndProject" in _plan(df)


def test_no_join_is_forced_to_broadcast(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    logical = fx.flights(t)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in logical.lower()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from groundstop.sources.testdata import Tables

        plan = _plan(rates.rate_by_carrier(fx.flights(Tables(spark, sf_dir))))
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_broadcast_and_merge_joins_give_the_same_flights(spark, sf_dir):
    from groundstop.sources.testdata import Tables

    small = fx.flights(Tables(spark, sf_dir))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = fx.flights(Tables(spark, sf_dir))
        plan = _plan(rates.rate_by_carrier(large))
        assert plan.count("SortMergeJoin") == 4
        assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_catalog_describe_describes_a_table_of_the_flights(spark, sf_dir):
    from groundstop.plans.ingest_io import catalog_describe

    rows = catalog_describe(spark, sf_dir).collect()
    flights = fx.flights(load_tables(spark, sf_dir))
    assert [r.col_name for r in rows][:len(flights.columns)] == flights.columns
    tables = [t.name for t in spark.catalog.listTables("groundstop_scratch") if t.name.startswith("flights_desc_")]
    assert tables and all(spark.table(f"groundstop_scratch.{t}").count() == flights.count() for t in tables)


def test_cleaning_computes_each_value_once(spark, sf_dir):
    """The filter on cleaned values must not compute them again below the projection."""
    from groundstop.operators import simulation

    rows = [("k1", "1999-01-04", "AA", "12", "N01", " ", "930", "1130", 0.0, 90.0, 7.0), ("k2", "1999-01-05", "AB", "1", "N02", "N03", "30", "230", 1.0, 60.0, 8.0)]
    flights = spark.createDataFrame(rows, "row_key string, fl_date string, op_carrier string, op_carrier_fl_num string, origin string, dest string, "
                                          "crs_dep_time string, crs_arr_time string, cancelled double, crs_elapsed_time double, distance double")
    flights = flights.withColumns({"fl_date": F.to_date("fl_date"), "row_key": F.concat_ws("+", "row_key", "op_carrier")})
    clean = simulation.drop_incomplete(simulation.clean_values(simulation.simulation_frame(flights)))
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat_ws(+") == 1 and plan.count("concat_ws(*") == 1
    assert [(r.row_key, r.cancelled, r.cancel, r.hour) for r in clean.collect()] == [("k2+AB", "Yes", "Yes", "00")]


def test_blank_values_as_before(spark):
    texts = ["", " ", "\t", "\n", " \n", " \r\n", "\r\n", "  ", "  ", " a", "a", "a b", " \n\n", " ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", blank_to_null("t").alias("now"), F.when(F.col("t").rlike(r"^\s$"), None).otherwise(F.col("t")).alias("was")).collect()
    assert [r.now for r in rows] == [r.was for r in rows] and sum(r.now is None for r in rows) > 5


def test_customers_meet_their_orders_before_the_lines_do(spark, sf_dir):
    plan = fx.flights_full(load_tables(spark, sf_dir))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("(l_orderkey") < plan.index("(o_custkey")
