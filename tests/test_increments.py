"""What grows and what is replaced: raw lines that do not fit, batches, publication, incremental blocks, slices, late labels."""

import os
import subprocess
import sys
import threading

import pytest
from pyspark.sql import functions as F

from groundstop import fixtures as fx, incremental, jobs
from groundstop.operators import features, monitor
from groundstop.session import scratch_path, scratch_table
from groundstop.sources import append_batch, load_tables, new_batches, publish_table, read_modern_csv, save_table, write_csv
from groundstop.sources.batches import batches, register_of
from groundstop.sources.publish import versions
from groundstop.streaming import late_label_stream


def text_file(spark, name, lines):
    path = scratch_path(spark, name)
    os.makedirs(path.removeprefix("file:"))
    with open(path.removeprefix("file:") + "/part.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def modern_lines(spark, sf_dir, n=20):
    raw = fx.flights_raw_2(load_tables(spark, sf_dir)).limit(n)
    return raw.columns, [",".join("NA" if v is None else str(v) for v in r) for r in raw.collect()]


def test_other_headers_are_refused(spark, sf_dir):
    names, lines = modern_lines(spark, sf_dir)
    for header in ([*names[:3], names[4], names[3], *names[5:]], names[:-1], [*names, "more"]):
        path = text_file(spark, "header", [",".join(header), *lines])
        with pytest.raises(Exception, match="(?i)header"):
            read_modern_csv(spark, path, with_key=True).select("origin", "dest").collect()
    good = text_file(spark, "header", [",".join(names).upper(), *lines])
    assert read_modern_csv(spark, good, with_key=True).count() == 20


def test_broken_lines_fail_or_are_set_apart(spark, sf_dir):
    names, lines = modern_lines(spark, sf_dir)
    broken = ["only,three,fields", lines[0] + ",one more", lines[1].replace(",", ",x", 1), ""]
    modern = text_file(spark, "broken", [",".join(names), *lines[:10], *broken, *lines[10:]])
    legacy = write_csv(fx.flights_raw_1(load_tables(spark, sf_dir)).limit(5), scratch_path(spark, "legacy"))
    table, quarantine = scratch_table(spark, "flights"), scratch_table(spark, "quarantine")
    with pytest.raises(Exception, match="(?i)malformed"):
        jobs.ingest_job(spark, legacy, modern, table, with_key=True)
    assert not spark.catalog.tableExists(table)
    for _ in range(2):  # the second finds the table and leaves both as they are
        jobs.ingest_job(spark, legacy, modern, table, with_key=True, quarantine=quarantine)
        assert spark.table(table).count() == 25
        got = spark.table(quarantine).collect()
        assert sorted(r.text for r in got) == sorted(broken[:3])  # an empty line is no line
        assert {r.layout for r in got} == {"modern"} and all(r.source_file.endswith("part.csv") and r.fields_read for r in got)


def test_without_broken_lines_there_is_no_quarantine(spark, sf_dir):
    t = load_tables(spark, sf_dir)
    legacy = write_csv(fx.flights_raw_1(t).limit(5), scratch_path(spark, "legacy"))
    modern = write_csv(fx.flights_raw_2(t).limit(5), scratch_path(spark, "modern"), null_value="NA")
    quarantine = scratch_table(spark, "quarantine")
    assert jobs.ingest_job(spark, legacy, modern, scratch_table(spark, "flights"), with_key=True, quarantine=quarantine)
    assert not spark.catalog.tableExists(quarantine)


def test_a_reader_always_finds_a_published_table(spark):
    table = scratch_table(spark, "published")
    publish_table(spark.range(10).withColumn("version", F.lit(0)), table)
    stop, seen, wrong = threading.Event(), set(), []

    def read():
        while not stop.is_set():
            try:
                rows = spark.table(table).groupBy("version").count().collect()
                seen.update(r.version for r in rows)
                if len(rows) != 1 or rows[0]["count"] != 10:
                    wrong.append(rows)
            except Exception as e:  # noqa: BLE001
                wrong.append(str(e)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    for version in range(1, 6):
        publish_table(spark.table(table).withColumn("version", F.lit(version)), table)  # reads what it replaces
    stop.set()
    reader.join()
    assert not wrong and seen
    assert spark.table(table).first().version == 5 and len(versions(spark, table)) == 2


def test_a_failed_publication_leaves_the_old_version(spark, monkeypatch):
    table = scratch_table(spark, "published")
    save_table(spark.range(3), table)  # a plain table from before
    publish_table(spark.range(4), table)
    assert spark.table(table).count() == 4
    with pytest.raises(Exception):
        publish_table(spark.range(5).select(F.raise_error(F.lit("no")).alias("id")), table)
    assert spark.table(table).count() == 4
    real = type(spark).sql

    def cut_off(self, text, *args, **kwargs):
        if "REPLACE VIEW" in text:
            raise KeyboardInterrupt
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", cut_off)
    with pytest.raises(KeyboardInterrupt):
        publish_table(spark.range(6), table)
    monkeypatch.undo()
    assert spark.table(table).count() == 4
    publish_table(spark.range(7), table)
    assert spark.table(table).count() == 7 and len(versions(spark, table)) == 2


def test_a_batch_is_written_once(spark):
    table = scratch_table(spark, "batched")
    a, b = spark.range(10).withColumn("v", F.lit("a")), spark.range(10, 15).withColumn("v", F.lit("b"))
    assert append_batch(a, table, "a", "id", 4, started_ms=7) and not append_batch(a, table, "a", "id", 4)
    assert append_batch(b, table, "b", "id", 4) and spark.table(table).count() == 15
    rows, last = new_batches(spark, table, 1)
    assert last == 2 and sorted(r.id for r in rows.collect()) == list(range(10, 15))
    assert batches(spark, table).where("batch = 'a'").first().started_ms == 7
    # A batch that was cut off before it was registered: readers do not see it, the next try writes over it.
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (batch_no = 3) SELECT id, 'half' FROM range(90, 99)")
    assert new_batches(spark, table)[0].count() == 15
    assert append_batch(spark.range(20, 22).withColumn("v", F.lit("c")), table, "c", "id", 4)
    assert sorted(r.id for r in new_batches(spark, table, 2)[0].collect()) == [20, 21]
    assert spark.table(register_of(table)).count() == 3


def scored_rows(spark, low, high):
    return spark.range(low, high).select(
        F.concat(F.lit("u"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("uuid"), (F.col("id") * 10).alias("timestamp_ms"), (F.col("id") % 3 == 0).cast("int").alias("prediction"))


def label_rows(spark, low, high):
    return scored_rows(spark, low, high).select("uuid", (F.substring("uuid", -1, 1).cast("int") % 2).alias("final_label"))


def test_runs_over_parts_close_the_blocks_of_one_run(spark, monkeypatch):
    log, truth, state = (scratch_table(spark, n) for n in ("log", "truth", "state"))
    whole = monitor.accuracy_by_block(scored_rows(spark, 0, 1050).join(label_rows(spark, 0, 1050), "uuid"))
    append_batch(scored_rows(spark, 0, 430), log, "l1", "uuid", 4)
    append_batch(label_rows(spark, 0, 500), truth, "t1", "uuid", 4)  # 430 to 499 come early
    one = incremental.monitor_increment(spark, log, truth, state)
    assert (one["run"], one["blocks"]) == (1, 4)
    assert incremental.monitor_increment(spark, log, truth, state) == one
    append_batch(scored_rows(spark, 430, 1100), log, "l2", "uuid", 4)  # the last 50 stay without a label
    append_batch(label_rows(spark, 500, 1050), truth, "t2", "uuid", 4)

    # A run that is cut off before its end counts for nothing, and the next one does its work.
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()) if "REPLACE VIEW" in text else real(self, text, *a, **k))
    with pytest.raises(KeyboardInterrupt):
        incremental.monitor_increment(spark, log, truth, state)
    monkeypatch.undo()
    assert incremental.progress(spark, state) == one and incremental.closed_blocks(spark, state).count() == 4

    read = []
    seen = incremental.with_position
    monkeypatch.setattr(incremental, "with_position", lambda df, *a, **k: read.append(df.count()) or seen(df, *a, **k))
    two = incremental.monitor_increment(spark, log, truth, state)
    assert read == [30 + 620]  # the open block and what arrived, not the log
    assert (two["run"], two["blocks"]) == (2, 10)
    assert incremental.waiting_predictions(spark, state).count() == 50
    got = incremental.closed_blocks(spark, state)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.select(got.columns).collect()))
    append_batch(label_rows(spark, 1050, 1100), truth, "t3", "uuid", 4)  # late
    assert incremental.monitor_increment(spark, log, truth, state)["blocks"] == 11
    assert incremental.waiting_predictions(spark, state).count() == 0


def test_late_labels_in_either_order_and_after_the_wait(spark):
    scored_in, labels_in, sink, ckpt = (scratch_path(spark, n) for n in ("s", "l", "out", "ckpt"))
    day = 86_400_000
    now = 1_700_000_000_000

    def drop(scored, labels):
        spark.createDataFrame([(u, t, 0.5, 1, None) for u, t in scored], "uuid string, timestamp_ms long, p_cancel double, prediction int, feature string").coalesce(1).write.mode("append").parquet(scored_in)
        spark.createDataFrame([(u, 1, t) for u, t in labels], "uuid string, final_label int, labelled_ms long").coalesce(1).write.mode("append").parquet(labels_in)
        late_label_stream(spark, scored_in, labels_in, sink, ckpt, early="1 day", wait="2 days", lateness="1 hour").awaitTermination()
        return sorted((r.uuid, r.final_label) for r in spark.read.parquet(sink).collect())

    assert drop([], [("early", now)]) == []
    assert drop([("early", now + 1000), ("late", now), ("never", now)], []) == [("early", 1)]
    assert drop([], [("late", now + day)]) == [("early", 1), ("late", 1)]
    # Time goes on: the wait of "never" is over; a label that comes after it joins nothing.
    later = drop([("next", now + 10 * day)], [("other", now + 10 * day)])
    later = drop([("next2", now + 11 * day)], [("never", now + 11 * day)])
    assert later == [("early", 1), ("late", 1), ("never", None)]
    late_label_stream(spark, scored_in, labels_in, sink, ckpt, early="1 day", wait="2 days", lateness="1 hour").awaitTermination()
    assert sorted((r.uuid, r.final_label) for r in spark.read.parquet(sink).collect()) == later


def bytes_read(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("filesSize").value() for i in range(leaves.size()))


def test_slices_are_replaced_alone_and_prune(spark, sf_dir):
    raw = fx.flights_raw_1(load_tables(spark, sf_dir))
    table = scratch_table(spark, "slices")
    airports = [r.origin for r in raw.groupBy("origin").count().orderBy(F.desc("count"), "origin").limit(3).collect()]
    slices = [(1997, None), (1995, 1997), (1996, 1998)]  # two overlap
    jobs.prototype_job(raw, table, airports, slices)
    within = {"1997-": "year >= 1997", "1995-1997": "year >= 1995 AND year < 1997", "1996-1998": "year >= 1996 AND year < 1998"}
    counts = {(a, n): raw.where(F.col("origin") == a).where(w).count() for a in airports for n, w in within.items()}
    stored = lambda: {(r.origin, r.year_slice): r["count"] for r in spark.table(table).groupBy("origin", "year_slice").count().collect()}
    assert min(counts.values()) > 0 and stored() == counts
    jobs.prototype_job(raw.withColumn("distance", F.lit(-1.0)), table, airports[1:2], slices[1:2])
    assert stored() == counts
    changed = spark.table(table).where("distance = -1").select("origin", "year_slice").distinct().collect()
    assert [tuple(r) for r in changed] == [(airports[1], "1995-1997")]
    assert 0 < bytes_read(spark.table(table).where(F.col("origin") == airports[1])) < bytes_read(spark.table(table))


def test_prototype_reads_its_source_once(spark, sf_dir):
    path = scratch_path(spark, "legacy_rows")
    fx.flights_raw_1(load_tables(spark, sf_dir)).write.parquet(path)
    from groundstop.operators import ingest

    rows = ingest.prototype_slices(spark.read.parquet(path), ["N01", "N02", "N03"], [(1997, None), (1995, 1997)])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "In(origin" in plan and "GreaterThanOrEqual(year" in plan


def test_dictionary_of_many_categories(spark):
    df = spark.range(150_000, numPartitions=6).select(
        F.concat(F.lit("c"), F.reverse(F.lpad(F.col("id").cast("string"), 6, "0"))).alias("op_carrier"), (F.col("id") % 7).cast("string").alias("origin"), F.lit(None).cast("string").alias("dest"))
    path = scratch_path(spark, "dictionary")
    features.category_index(df.union(df.limit(10))).write.parquet(path)
    index = spark.read.parquet(path)
    assert {r.column_name: (r.n, r.low, r.high) for r in index.groupBy("column_name").agg(
        F.count("*").alias("n"), F.min("idx").alias("low"), F.max("idx").alias("high")).collect()} == {"op_carrier": (150_000, 0, 149_999), "origin": (7, 0, 6)}
    ranks = index.where("column_name = 'op_carrier' AND idx % 50000 = 7").select("category", "idx").collect()
    below = {r.category: df.where(F.col("op_carrier") < r.category).count() for r in ranks}
    assert len(ranks) == 3 and below == {r.category: r.idx for r in ranks}
    slots = features.onehot_slots(index).groupBy("column_name").agg(F.min("slot").alias("low"), F.max("slot").alias("high")).collect()
    assert {r.column_name: (r.low, r.high) for r in slots} == {"op_carrier": (0, 149_999), "origin": (150_000, 150_006)}
    found = features.with_index(df.limit(50).union(spark.createDataFrame([("unseen", "3", None)], df.schema)), index).collect()
    assert all(r.origin_idx == int(r.origin) and r.dest_idx is None for r in found)
    assert [r.op_carrier_idx for r in found if r.op_carrier == "unseen"] == [None] and sum(r.op_carrier_idx is not None for r in found) == 50


def test_scale_of_large_values(spark):
    df = spark.createDataFrame([("A", "X", "Y", 10**9, 5), ("A", "X", "Y", 10**9 + 1, 5), ("B", "X", "Y", 10**9, 6), ("B", "X", "Y", 10**9 + 1, 6)],
                               "op_carrier string, origin string, dest string, week int, hour int")
    got = {r.feature: r.std for r in features.indicator_scale(df, F.lit(True)).collect()}
    assert got["week"] == pytest.approx(0.5, abs=1e-8) and got["hour"] == 0.5 and got["op_carrier=A"] == 0.5 and got["origin=X"] == 0.0


@pytest.mark.parametrize("gone", ["zstandard", "public_tokenizers", "groundstop.llm", "corpus_pipeline"])
def test_entry_without_the_training_data_operators(gone):
    code = f"import sys; sys.modules[{gone!r}] = None; import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as E; q = E.queries(); assert 'rate_by_carrier' in q and len(q) >= 64 and not any(k.startswith('op1_') for k in q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def _written(monkeypatch, module):
    """Names of the scratch folders that ``module`` asks for."""
    names, real = [], module.scratch_path
    monkeypatch.setattr(module, "scratch_path", lambda spark, name: names.append(name) or real(spark, name))
    return names


def test_first_increment_joins_buckets_without_a_shuffle(spark, monkeypatch):
    log, truth, state = (scratch_table(spark, n) for n in ("f3_log", "f3_labels", "f3_state"))
    rows = [(f"u{i:03d}", 1000 + i, i % 2) for i in range(250)]
    jobs.log_predictions(spark.createDataFrame(rows, "uuid string, timestamp_ms long, prediction int"), log, 4)
    jobs.store_labels(spark.createDataFrame([(u, 1) for u, _, _ in rows], "uuid string, final_label int"), truth, 4)
    told = new_batches(spark, truth)[0].select("uuid", "final_label").union(incremental._stored(spark, state, "early", 0))
    waiting = new_batches(spark, log)[0].select("uuid", "timestamp_ms", "prediction").union(incremental._stored(spark, state, "pending", 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = waiting.join(told.groupBy("uuid").agg(F.min("final_label")), "uuid", "full_outer")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    names = _written(monkeypatch, monitor)
    incremental.monitor_increment(spark, log, truth, state)
    assert names == ["positions"]  # the stored increment is not stored again to be sorted
    assert [tuple(r) for r in incremental.closed_blocks(spark, state).orderBy("block").collect()] == [(0, 100, 0.5, 1000, 1099), (1, 100, 0.5, 1100, 1199)]


def test_metrics_read_the_flights_once_and_store_the_join_once(spark, sf_dir, monkeypatch):
    from groundstop.plans import QUERIES

    for name in ("metrics_table", "metrics_tail", "accuracy_by_block_incremental", "labels_joined_stream"):
        built, real = [], fx._scored_lines
        monkeypatch.setattr(fx, "_scored_lines", lambda t, f: built.append(f) or real(t, f))
        names = _written(monkeypatch, monitor)
        labels = []
        monkeypatch.setattr(fx, "late_labels", lambda t: labels.append(t))
        QUERIES[name](spark, sf_dir)
        monkeypatch.undo()
        assert labels == [] and "unordered" not in names


def test_late_labels_in_drops_by_time(spark, monkeypatch):
    """Many drops: the state is cleared on the way and no pair is lost."""
    from groundstop.plans import streams

    day = 86_400_000
    rows = [(f"u{i:03d}", 1_700_000_000_000 + i * day, i / 400, i % 2) for i in range(400)]
    log = spark.createDataFrame(rows, "uuid string, timestamp_ms long, p_cancel double, prediction int")
    truth = spark.createDataFrame([(u, 1) for i, (u, *_) in enumerate(rows) if i % 7], "uuid string, final_label int")
    monkeypatch.setattr(streams, "load_tables", lambda spark, sf_dir: None)
    monkeypatch.setattr(streams.fx, "stored_log", lambda t: (log, truth))
    monkeypatch.setattr(streams, "DROP_ROWS", 80)
    started, real = [], streams.late_label_stream
    monkeypatch.setattr(streams, "late_label_stream", lambda *a, **k: started.append(real(*a, **k)) or started[-1])
    got = streams.q_labels_joined_stream(spark, "")
    assert sorted(r.uuid for r in got.collect()) == sorted(u for i, (u, *_) in enumerate(rows) if i % 7)
    state = [p.stateOperators[0].numRowsTotal for p in started[1].recentProgress if p.stateOperators]
    assert len(started) == 3 and len(state) >= 10 and max(state) < 500 < len(rows) + truth.count()


def test_label_state_lies_in_a_few_rows(spark):
    """Repeated and null ids, nulls, NaN and times that do not fit: the pairs of a left outer join, from a state of buckets."""
    day, now = 86_400_000, 1_700_000_000_000
    scored_in, labels_in, sink, ckpt = (scratch_path(spark, n) for n in ("s", "l", "out", "ckpt"))
    scored = [(f"u{i}", now + i, i / 7, i % 2) for i in range(300)]
    scored += [("twice", now, None, None), ("twice", now + 1, float("nan"), 1), (None, now, 0.5, 1), ("far", now, 0.5, 1)]
    labels = [(f"u{i}", i % 2, now + 1000) for i in range(300) if i % 3]
    labels += [("twice", 1, now), ("twice", None, now + day), (None, 1, now), ("far", 1, now + 3 * day)]

    def drop(scored, labels):
        spark.createDataFrame([(*s, None) for s in scored], "uuid string, timestamp_ms long, p_cancel double, prediction int, feature string").coalesce(1).write.mode("append").parquet(scored_in)
        spark.createDataFrame(labels, "uuid string, final_label int, labelled_ms long").coalesce(1).write.mode("append").parquet(labels_in)
        q = late_label_stream(spark, scored_in, labels_in, sink, ckpt, early="1 day", wait="2 days", lateness="1 hour")
        q.awaitTermination()
        return [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]

    state = drop([], labels[::2]) + drop(scored, labels[1::2])
    assert 0 < max(state) <= 128 < len(scored)
    for later in (10, 11):  # time goes on: what has no label comes out with null
        drop([(f"next{later}", now + later * day, 0.1, 0)], [(f"other{later}", 0, now + later * day)])
    want = []
    for u, t, p, k in scored:
        found = [v for w, v, at in labels if u is not None and u == w and t - day <= at <= t + 2 * day]
        want += [(u, t, p, k, v) for v in (found or [None])]
    got = [tuple(r) for r in spark.read.parquet(sink).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
