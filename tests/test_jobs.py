"""End-to-end jobs on the sf0.001 fixture written out as raw CSV files."""

from pyspark.sql import functions as F

from groundstop import fixtures as fx, jobs
from groundstop.session import scratch_path, scratch_table
from groundstop.__main__ import main
from groundstop.sources import load_tables, save_table, write_csv
from groundstop.sources.batches import batches, now_ms


def test_pipeline_end_to_end(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    legacy = write_csv(fx.flights_raw_1(t), scratch_path(spark, "job_set_1"))
    modern = write_csv(fx.flights_raw_2(t), scratch_path(spark, "job_set_2"), null_value="NA")
    table = scratch_table(spark, "job_flights")
    assert jobs.ingest_job(spark, legacy, modern, table, with_key=True) is True
    assert jobs.ingest_job(spark, legacy, modern, table, with_key=True) is False  # already there: left alone
    flights = spark.table(table)
    assert flights.count() == 6000

    results = jobs.analysis_job(flights)
    assert results["top_carriers"].count() == 10
    assert results["rate_by_carrier"].count() == 25

    sample_path = jobs.sample_job(flights, scratch_path(spark, "job_sample"))
    model_path = scratch_path(spark, "job_model")
    rep = {r.class_name: r for r in jobs.train_job(spark, sample_path, model_path, max_iter=3, max_depth=3).collect()}
    assert set(rep) == {"Not-cancelled", "Cancelled", "accuracy", "macro avg", "weighted avg"}
    assert 0.0 <= rep["accuracy"].f1_score <= 1.0

    sample = spark.read.option("header", True).csv(sample_path)
    requests = sample.select(
        F.col("row_key").alias("rid"),
        F.concat_ws(",", "op_carrier", "origin", "dest", "week", "hour").alias("feature"),
    )
    bad = [("week", "Brand#11,N01,N02,0,9"), ("text", "Brand#11,N01,N02,soon,9"), ("short", "Brand#11,N01"), ("long", "Brand#11,N01,N02,1,9,9"),
           ("null", None), ("blank", "Brand#11,,N02,1,9"), ("unseen", "Nobody,N01,N02,1,9")]
    scored = jobs.score_job(spark, model_path, requests.unionByName(spark.createDataFrame(bad, "rid string, feature string"))).collect()
    assert len(scored) == sample.count() + len(bad)
    invalid = [r for r in scored if not r.valid]
    assert sorted(r.rid for r in invalid) == sorted(b[0] for b in bad)
    assert all(r.prediction is None and r.p_cancel is None and r.proba is None for r in invalid)
    assert all(r.prediction in (0, 1) and 0.0 <= r.p_cancel <= 1.0 for r in scored if r.valid)


def test_partitioned_ingest(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    legacy = write_csv(fx.flights_raw_1(t), scratch_path(spark, "pj_set_1"))
    modern = write_csv(fx.flights_raw_2(t), scratch_path(spark, "pj_set_2"), null_value="NA")
    table = scratch_table(spark, "job_flights_by_year")
    assert jobs.ingest_job(spark, legacy, modern, table, partition_by_year=True, with_key=True)
    df = spark.table(table).where(F.col("year") == 1996)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan
    assert df.count() == fx.flights(t).where(F.year("fl_date") == 1996).count()


def test_monitor_job(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    out = jobs.monitor_job(fx.scored(t, with_feature=True), fx.late_labels(t), scratch_table(spark, "job_metrics"),
                           "dep-1")
    assert out.where("metrics_accuracy >= 0").count() == 50
    assert out.count() == 6000 + 50
    assert out.where("metrics_accuracy IS NULL OR processing_time_ms IS NULL OR start_ts IS NULL").count() == 0


def test_monitor_job_leaves_no_scratch_and_equals_the_key(spark, sf_dir):
    import os

    from groundstop.plans import QUERIES
    from groundstop.plans.monitoring import DEPLOYMENT
    from groundstop.session import checkpoint_dir

    base = checkpoint_dir(spark).removeprefix("file:") + "/scratch"
    t = load_tables(spark, sf_dir)
    key = QUERIES["metrics_table"](spark, sf_dir)
    before = set(os.listdir(base))
    out = jobs.monitor_job(fx.scored(t, with_feature=True), fx.late_labels(t), scratch_table(spark, "job_metrics"), DEPLOYMENT)
    assert set(os.listdir(base)) <= before
    out = out.withColumn("metrics_accuracy", F.round("metrics_accuracy", 6))
    assert out.exceptAll(key).count() == 0 and key.exceptAll(out).count() == 0


def test_score_and_monitor(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    flights = fx.flights(t)
    sample, model_path = jobs.sample_job(flights, scratch_path(spark, "sm_sample")), scratch_path(spark, "sm_model")
    jobs.train_job(spark, sample, model_path, max_iter=2, max_depth=2)
    sim = jobs.simulation_job(flights, scratch_table(spark, "sm_sim"))
    log, metrics = scratch_table(spark, "sm_log"), scratch_table(spark, "sm_metrics")
    out = jobs.score_and_monitor_job(spark, spark.table(sim), model_path, log, fx.late_labels(t), metrics, "dep", n=1000, buckets=4, started_ms=0, batch="first")
    logged = spark.table(log)
    n, labelled = logged.count(), logged.join(fx.late_labels(t), "uuid").count()
    assert 0 < n <= 1000
    assert [r.timestamp_ms for r in logged.orderBy("uuid").collect()] == list(range(1, n + 1))
    assert out.count() == n + labelled // 100
    again = ["score-and-monitor", "--simulation", sim, "--model", model_path, "--log", log, "--labels", save_table(fx.late_labels(t), scratch_table(spark, "sm_labels")),
             "--out", metrics, "--deployment", "dep", "--n", "1000", "--buckets", "4", "--batch"]
    assert main([*again, "first"], spark) == 0 and spark.table(log).count() == n  # the batch is known
    before = now_ms()
    assert main([*again, "second"], spark) == 0 and spark.table(log).count() == 2 * n
    stamps = spark.table(log).where("batch_no = 2").agg(F.min("timestamp_ms"), F.max("timestamp_ms")).first()
    started = batches(spark, log).where("batch = 'second'").first().started_ms
    assert before <= started <= now_ms() and (stamps[0], stamps[1]) == (started + 1, started + n)


def test_prototype_job_loads_every_slice(spark, sf_dir):
    raw = fx.flights_raw_1(load_tables(spark, sf_dir))
    table = jobs.prototype_job(raw, scratch_table(spark, "proto"), ["N01", "N02"], [(1997, None), (1995, 1997)])
    assert spark.table(table).count() == raw.where("origin IN ('N01', 'N02') AND year >= 1995").count()


def test_by_year_ingest_into_a_new_database(spark, sf_dir):
    import uuid

    t = load_tables(spark, sf_dir)
    legacy = write_csv(fx.flights_raw_1(t), scratch_path(spark, "nd_set_1"))
    modern = write_csv(fx.flights_raw_2(t), scratch_path(spark, "nd_set_2"), null_value="NA")
    table = f"new_db_{uuid.uuid4().hex[:8]}.flights"
    assert jobs.ingest_job(spark, legacy, modern, table, partition_by_year=True, with_key=True)
    assert spark.table(table).count() == 6000


def test_analysis_reads_the_flights_twice(spark, sf_dir):
    """One pass for all rates (stored), one for the column profile."""
    from groundstop.operators import rates

    flights = fx.flights(load_tables(spark, sf_dir))
    got = jobs.analysis_job(flights)
    for name, expected in (("rate_by_carrier", rates.rate_by_carrier(flights)), ("rate_by_year", rates.rate_by_year(flights)), ("rate_by_week", rates.rate_by_week(flights))):
        assert got[name].exceptAll(expected).count() == 0 and expected.exceptAll(got[name]).count() == 0
        assert "lineitem" not in " ".join(got[name].inputFiles())
    assert "lineitem" in " ".join(got["unused_columns"].inputFiles())


def test_real_layouts_without_key(spark, sf_dir):
    """Files in the real layouts (no row key) are read with the 29- and 27-column schemas."""
    t = load_tables(spark, sf_dir)
    legacy = write_csv(fx.flights_raw_1(t).drop("row_key"), scratch_path(spark, "nk_set_1"))
    modern = write_csv(fx.flights_raw_2(t).drop("row_key"), scratch_path(spark, "nk_set_2"), null_value="NA")
    table = scratch_table(spark, "job_flights_nokey")
    assert jobs.ingest_job(spark, legacy, modern, table)
    got = spark.table(table)
    assert len(got.columns) == 25
    assert got.exceptAll(fx.flights(t).drop("row_key")).count() == 0

    sample_path = jobs.sample_job(got, scratch_path(spark, "nk_sample"))
    rep = jobs.train_job(spark, sample_path, scratch_path(spark, "nk_model"), max_iter=2, max_depth=2)
    assert rep.count() == 5


def test_command_line_stages(spark, sf_dir):
    from groundstop.__main__ import main

    t = load_tables(spark, sf_dir)
    legacy = write_csv(fx.flights_raw_1(t).drop("row_key"), scratch_path(spark, "cli_set_1"))
    modern = write_csv(fx.flights_raw_2(t).drop("row_key"), scratch_path(spark, "cli_set_2"), null_value="NA")
    table = scratch_table(spark, "cli_flights")
    out, sample, model_path = (scratch_path(spark, n) for n in ("cli_out", "cli_sample", "cli_model"))
    assert main(["ingest", "--legacy", legacy, "--modern", modern, "--table", table], spark) == 0
    assert main(["analyse", "--table", table, "--out", out], spark) == 0
    assert spark.read.parquet(f"{out}/top_carriers").count() == 10
    assert main(["sample", "--table", table, "--out", sample], spark) == 0
    assert main(["train", "--sample", sample, "--model", model_path, "--max-iter", "2", "--max-depth", "2"],
                spark) == 0
    requests = spark.read.option("header", True).csv(sample).select(
        "row_key", F.concat_ws(",", "op_carrier", "origin", "dest", "week", "hour").alias("feature"))
    req_path, scored_path = scratch_path(spark, "cli_req"), scratch_path(spark, "cli_scored")
    requests.write.parquet(req_path)
    assert main(["score", "--model", model_path, "--requests", req_path, "--out", scored_path], spark) == 0
    assert spark.read.parquet(scored_path).count() == requests.count()

    from groundstop.sources import save_table

    raw, log, labels = (save_table(df, scratch_table(spark, n)) for df, n in (
        (fx.flights_raw_1(t), "cli_raw"), (fx.scored(t, with_feature=True), "cli_log"), (fx.late_labels(t), "cli_labels")))
    proto, sim, metrics = (scratch_table(spark, n) for n in ("cli_proto", "cli_sim", "cli_metrics"))
    assert main(["prototype", "--table", raw, "--out", proto, "--airports", "N01,N02", "--slices", "1997-,1995-1997"], spark) == 0
    assert spark.table(proto).count() == spark.table(raw).where("origin IN ('N01', 'N02') AND year >= 1995").count()
    assert main(["simulate", "--table", table, "--out", sim], spark) == 0
    assert spark.table(sim).count() == 6000
    assert main(["monitor", "--scored", log, "--labels", labels, "--out", metrics, "--deployment", "d"], spark) == 0
    assert spark.table(metrics).count() == 6000 + 50


def test_bucketed_log_and_labels_join_without_shuffle(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    log, labels = scratch_table(spark, "log_b"), scratch_table(spark, "labels_b")
    jobs.log_predictions(fx.scored(t, with_feature=True), log, buckets=8)
    jobs.store_labels(fx.late_labels(t), labels, buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        joined = jobs.labelled_rows(spark, log, labels)
        joined.write.format("noop").mode("overwrite").save()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 6000
        assert joined.where(F.col("final_label").isNull()).count() == fx.scored(t).count() - fx.late_labels(t).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
