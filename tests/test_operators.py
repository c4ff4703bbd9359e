"""Operator semantics on tiny inline frames and on the sf0.001 fixture."""

import pytest
from pyspark.sql import functions as F

from groundstop import fixtures as fx
from groundstop.operators import ingest, monitor, nested, profile, rates, report, sampling, simulation
from groundstop.schemas import LEGACY_DDL, MODERN_DDL, UNIFIED_COLUMNS, with_row_key
from groundstop.session import scratch_path
from groundstop.sources import load_tables, read_legacy_csv, read_modern_csv, write_csv


def test_rate_drops_groups_without_cancellations_unless_asked(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 0.0), ("B", 0.0)], "op_carrier string, cancelled double")
    assert {r.op_carrier for r in rates.rate_by_carrier(df).collect()} == {"A"}
    kept = {r.op_carrier: r.delay_percent for r in rates.rate_by_carrier(df, keep_zero=True).collect()}
    assert kept == {"A": 50.0, "B": 0.0}


def test_join_form_equals_one_pass(spark, sf_dir):
    f = fx.flights(load_tables(spark, sf_dir))
    a = rates.rate_by_carrier(f)
    b = rates.rate_join_form(f)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_null_flag_is_in_neither_class(spark):
    df = spark.createDataFrame([(None,), (1.0,), (0.0,)], "cancelled double")
    assert df.where(F.col("cancelled") == 1).count() == 1
    assert df.where(F.col("cancelled") == 0).count() == 1


def test_unused_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "a int, b string, c string")
    got = {r.column_name: r.null_count for r in profile.unused_columns(df).collect()}
    assert got == {"b": 2, "c": 1}


def _positions(df, parts):
    return {r.k: r.position for r in monitor.with_position(df.repartition(parts), ["k"], num_partitions=parts).collect()}


def test_positions_same_on_1_and_8_partitions(spark):
    df = spark.range(1234).select(F.format_string("%05d", F.col("id")).alias("k"))
    p1, p8 = _positions(df, 1), _positions(df, 8)
    assert p1 == p8
    assert sorted(p1.values()) == list(range(1, 1235))
    assert p1["00000"] == 1 and p1["01233"] == 1234


def test_trailing_short_block_not_emitted(spark):
    df = spark.range(250).select(
        F.format_string("u%04d", F.col("id")).alias("uuid"),
        (F.lit(1000) + F.col("id")).alias("timestamp_ms"),
        (F.col("id") % 2).cast("int").alias("final_label"),
        F.lit(0).alias("prediction"),
    )
    blocks = monitor.accuracy_by_block(df).orderBy("block").collect()
    assert [(b.block, b.n) for b in blocks] == [(0, 100), (1, 100)]
    assert blocks[0].accuracy == 0.5 and blocks[0].start_ms == 1000 and blocks[0].end_ms == 1099


def test_classification_report_by_hand(spark):
    rows = [(0, 0)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(1, 1)] * 4
    df = spark.createDataFrame(rows, "final_label int, prediction int")
    rep = {r.class_name: r for r in report.classification_report(df).collect()}
    assert rep["Not-cancelled"].precision == pytest.approx(3 / 5)
    assert rep["Not-cancelled"].recall == pytest.approx(3 / 4)
    assert rep["Cancelled"].precision == pytest.approx(4 / 5)
    assert rep["Cancelled"].recall == pytest.approx(4 / 6)
    assert rep["accuracy"].f1_score == pytest.approx(0.7)
    assert rep["weighted avg"].support == 10
    f0, f1 = 2 * 0.6 * 0.75 / 1.35, 2 * 0.8 * (4 / 6) / (0.8 + 4 / 6)
    assert rep["macro avg"].f1_score == pytest.approx((f0 + f1) / 2, abs=1e-6)


def test_report_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "final_label int, prediction int")
    rep = {r.class_name: r for r in report.classification_report(df).collect()}
    assert rep["Cancelled"].precision == 0.0 and rep["Cancelled"].support == 0


def test_flatten_nested(spark):
    df = spark.sql("SELECT named_struct('b', 1, 'c', named_struct('d', 'x')) AS a, 2 AS e")
    out = nested.flatten(df)
    assert out.columns == ["a_b", "a_c_d", "e"]
    assert tuple(out.first()) == (1, "x", 2)


def test_sampling_layout_independent_and_balanced(spark, sf_dir):
    f = fx.flights(load_tables(spark, sf_dir))
    a = {r.row_key for r in sampling.undersample(f.coalesce(1)).collect()}
    b = {r.row_key for r in sampling.undersample(f.repartition(8)).collect()}
    assert a == b
    cancelled = f.where("cancelled = 1").count()
    assert len(a) > cancelled
    bern = sampling.undersample(f, method="bernoulli").count()
    assert bern >= cancelled


def test_exact_n_sample(spark, sf_dir):
    sim = simulation.simulation_frame(fx.flights(load_tables(spark, sf_dir)))
    a = sorted(r.row_key for r in simulation.sample_exact(sim.repartition(3), 100).collect())
    b = sorted(r.row_key for r in simulation.sample_exact(sim.coalesce(1), 100).collect())
    assert len(a) == 100 and a == b


@pytest.mark.parametrize("n", [0, 1, 7, 59, 60, 61, 10**9])
def test_exact_n_is_exact_for_every_n(spark, n):
    import hashlib

    rows = [(f"k{i % 50}",) for i in range(60)]
    df = spark.createDataFrame(rows, "row_key string")
    expected = sorted((r[0] for r in rows), key=lambda k: (hashlib.md5(k.encode()).hexdigest(), k))[:n]
    assert sorted(r.row_key for r in simulation.sample_exact(df, n).collect()) == sorted(expected)


def test_ingest_identity_through_csv(spark, sf_dir):
    """CSV round trip of both raw layouts, ingest, compare with the flights table."""
    t = load_tables(spark, sf_dir)
    p1 = write_csv(fx.flights_raw_1(t), scratch_path(spark, "id_set_1"))
    p2 = write_csv(fx.flights_raw_2(t), scratch_path(spark, "id_set_2"), null_value="NA")
    raw1 = read_legacy_csv(spark, p1, with_row_key(LEGACY_DDL))
    raw2 = read_modern_csv(spark, p2, with_row_key(MODERN_DDL))
    unified = ingest.unify(raw1, raw2)
    expected = fx.flights(t)
    assert unified.columns == ["row_key"] + UNIFIED_COLUMNS
    assert unified.exceptAll(expected).count() == 0
    assert expected.exceptAll(unified).count() == 0


def test_random_split_option(spark, sf_dir):
    fl = fx.flights(load_tables(spark, sf_dir))
    train, test = sampling.train_test_split(fl, method="random")
    assert train.count() + test.count() == fl.count()


def test_prediction_log_stream_is_exactly_once_on_restart(spark, sf_dir):
    """A second run over the same source and checkpoint adds nothing."""
    from groundstop.streaming import prediction_log_stream

    scored = fx.scored(load_tables(spark, sf_dir), with_feature=True).withColumn(
        "prediction", F.col("prediction").cast("int"))
    src, sink, ckpt = (scratch_path(spark, n) for n in ("s_in", "s_out", "s_ckpt"))
    scored.write.parquet(src)
    prediction_log_stream(spark, src, sink, ckpt).awaitTermination()
    first = spark.read.parquet(sink).count()
    prediction_log_stream(spark, src, sink, ckpt).awaitTermination()
    assert spark.read.parquet(sink).count() == first == scored.count()


def test_positions_with_adaptive_partition_count(spark):
    df = spark.range(3000).select(F.format_string("%05d", F.col("id")).alias("k")).repartition(5)
    pos = {r.k: r.position for r in monitor.with_position(df, ["k"]).collect()}
    assert pos == {f"{i:05d}": i + 1 for i in range(3000)}


def test_hot_timestamp_is_split_across_range_partitions(spark):
    """A third of all rows share one time stamp; the unique id in the sort key splits them."""
    n = 9000
    df = spark.range(n).select(
        F.format_string("u%05d", F.col("id")).alias("uuid"),
        F.when(F.col("id") % 3 == 0, F.lit(5000)).otherwise(F.col("id")).cast("long").alias("timestamp_ms"),
    )
    sizes = [r[1] for r in df.repartitionByRange(8, "timestamp_ms", "uuid")
             .groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < n / 4  # balanced: no partition holds the hot third
    pos = monitor.with_position(df, ["timestamp_ms", "uuid"], num_partitions=8)
    got = [r.uuid for r in pos.orderBy("position").collect()]
    want = [r.uuid for r in df.orderBy("timestamp_ms", "uuid").collect()]
    assert got == want


def test_split_is_layout_independent(spark, sf_dir):
    f = fx.flights(load_tables(spark, sf_dir))
    a = {r.row_key for r in sampling.train_test_split(f.coalesce(1))[0].collect()}
    b = {r.row_key for r in sampling.train_test_split(f.repartition(7))[0].collect()}
    assert a == b and 0.70 < len(a) / f.count() < 0.80


def test_label_join_stream_restart_adds_nothing(spark, sf_dir):
    from groundstop.streaming import label_join_stream

    t = load_tables(spark, sf_dir)
    labels = fx.late_labels(t).withColumn("final_label", F.col("final_label").cast("int"))
    src, sink, ckpt = (scratch_path(spark, n) for n in ("l_in", "l_out", "l_ckpt"))
    labels.write.parquet(src)
    label_join_stream(spark, src, fx.scored(t), sink, ckpt).awaitTermination()
    first = spark.read.parquet(sink).count()
    label_join_stream(spark, src, fx.scored(t), sink, ckpt).awaitTermination()  # nothing new arrived
    assert spark.read.parquet(sink).count() == first == labels.count()


def test_show_tables(spark, sf_dir):
    from groundstop.session import scratch_table
    from groundstop.sources import save_table, show_tables

    table = save_table(fx.flights(load_tables(spark, sf_dir)).limit(5), scratch_table(spark, "shown"))
    db, name = table.split(".")
    assert name in {r.tableName for r in show_tables(spark, db).collect()}


def test_prototype_sql_equals_dataframe_form(spark, sf_dir):
    raw = fx.flights_raw_1(load_tables(spark, sf_dir))
    origin = raw.groupBy("origin").count().orderBy(F.desc("count"), "origin").first().origin
    raw.createOrReplaceTempView("raw_legacy_t")
    try:
        for lo, hi in [(1996, None), (1995, 1997)]:
            a = ingest.prototype_slice_sql(spark, "raw_legacy_t", origin, lo, hi)
            b = ingest.prototype_slice(raw, origin, lo, hi)
            assert a.count() > 0
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.catalog.dropTempView("raw_legacy_t")


def test_simulation_sample_chain(spark, sf_dir):
    f = fx.flights(load_tables(spark, sf_dir))
    sim = simulation.simulation_frame(f, keep=["diverted"]).withColumn(
        "hour", F.when(F.col("diverted") == 1, F.lit(" ")).otherwise(F.col("hour"))).drop("diverted")
    out = simulation.simulation_sample(sim, 1000)
    rows = out.collect()
    assert 0 < len(rows) <= 1000
    assert {r.cancel for r in rows} <= {"Yes", "No"} and {r.cancelled for r in rows} <= {"Yes", "No"}
    assert all(r.hour is not None and r.hour.strip() for r in rows)


def test_failed_replace_keeps_the_old_table(spark):
    from groundstop.session import scratch_table
    from groundstop.sources import replace_table, save_table

    table = save_table(spark.range(10), scratch_table(spark, "safe"))
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        replace_table(broken, table)
    assert spark.table(table).count() == 10
    replace_table(spark.table(table).where("id < 4").withColumn("more", F.lit(1)), table)  # reads what it replaces
    assert spark.table(table).columns == ["id", "more"] and spark.table(table).count() == 4
    database = table.rpartition(".")[0]
    left = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if "__new_" in r.tableName or "__old_" in r.tableName]
    assert left == []


def test_bucketed_write_leaves_a_file_per_bucket_at_most(spark):
    from groundstop.session import scratch_table
    from groundstop.sources import save_bucketed

    table = save_bucketed(spark.range(10_000, numPartitions=16), scratch_table(spark, "bucketed"), "id", 8)
    assert len(spark.table(table).inputFiles()) <= 8


def test_null_airport_carrier_and_date_make_no_group(spark):
    rows = [("A", "2001-01-02", "X", None, 1.0), (None, "2001-01-02", None, "X", 1.0), ("A", None, "X", "Y", 1.0), ("A", "2001-01-02", "Y", "X", 0.0)]
    df = spark.createDataFrame(rows, "op_carrier string, d string, origin string, dest string, cancelled double").withColumn("fl_date", F.col("d").cast("date"))
    assert [tuple(r) for r in rates.rate_by_route(df).collect()] == [("X<>Y", 2, 1, 50.0)]
    assert [r.op_carrier for r in rates.rate_by_carrier(df).collect()] == ["A"]
    assert rates.rate_by_carrier(df).exceptAll(rates.rate_join_form(df)).count() == 0
    assert [r.year for r in rates.rate_by_year(df).collect()] == [2001]
    got = {(r.kind, r.key): (r.count_total, r.count_delays) for r in rates.all_rates(df).collect()}
    assert got == {("carrier", "A"): (3, 2), ("year", "2001"): (3, 2), ("week", "1"): (3, 2), ("route", "X<>Y"): (2, 1), ("direction", "XY"): (1, 1)}


def test_fraction_one_keeps_every_row(spark):
    df = spark.createDataFrame([(f"k{i}", 0.0) for i in range(50)], "row_key string, cancelled double")
    assert sampling.undersample(df, 1.0).count() == 50
    train, test = sampling.train_test_split(df, 1.0)
    assert (train.count(), test.count()) == (50, 0)


def test_request_texts_keep_their_places(spark):
    from groundstop.operators import scoring

    df = spark.createDataFrame([("UA", None, "BOS", "1", "16")], "op_carrier string, origin string, dest string, week string, hour string")
    text = scoring.request_frame(df)
    assert text.first().feature == "UA,,BOS,1,16"
    parsed = scoring.parse_requests(text.select("feature")).withColumn("valid", scoring.request_valid()).first()
    assert (parsed.op_carrier, parsed.origin, parsed.dest, parsed.week, parsed.hour, parsed.valid) == ("UA", None, "BOS", 1, 16, False)


def test_batch_records(spark):
    from groundstop.operators import scoring

    record = '{"data": {"rows": [["UA", "BOS", "SFO", "1", "16"], ["UA", null, "SFO", "x", "16"], ["UA"]]}}'
    df = spark.createDataFrame([(7, record), (8, "not json"), (9, None)], "id int, record_json string")
    rows = sorted(scoring.parse_records(df, keep=["id"]).collect(), key=lambda r: (r.id, r.row_no or 0))
    assert [(r.id, r.row_no, r.op_carrier, r.week) for r in rows] == [
        (7, 0, "UA", 1), (7, 1, "UA", None), (7, 2, None, None), (8, None, None, None), (9, None, None, None)]
    scored = spark.createDataFrame([(7, 1, None, None), (7, 0, 1, "0.8"), (8, None, None, None)], "id int, row_no int, prediction int, proba string")
    head = '{"version":"1.0","data":{"colnames":["prediction","proba"],"coltypes":["INT","STRING"],"rows":['
    assert {r.id: r.reply_json for r in scoring.reply_records(scored, "id").collect()} == {7: head + '[1,"0.8"],[null,null]]}}', 8: head + "]}}"}
