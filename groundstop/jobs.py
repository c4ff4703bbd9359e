"""End-to-end jobs, one per pipeline stage, composed from the operators.

Each job takes a session and locations, declares DataFrame plans and
writes its results with Spark; nothing is collected.  Table names are
fully qualified (``db.table``); paths are shared storage.

* ``ingest_job``      legacy CSV + modern CSV folder -> unified flights table (create if absent)
* ``analysis_job``    flights table -> named result DataFrames (rates, top-k, profile)
* ``sample_job``      flights table -> balanced training sample as a header CSV folder
* ``train_job``       training sample CSV -> fitted pipeline model (saved) + report on the test part
* ``score_job``       model + request texts -> prediction, probability
* ``monitor_job``     scored log + late labels -> blocks of accuracy + flat metrics table
* ``log_predictions`` / ``store_labels`` / ``labelled_rows``: the prediction log and the
  label table kept in batches bucketed on the prediction id, so their join needs no shuffle
* ``score_and_monitor_job``: sample, score, log, attach labels, publish (the batch is logged once)

Monitoring of only what is new since the last run is ``groundstop.incremental``.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from groundstop.operators import features, ingest, model, monitor, profile, rates, report, sampling, scoring, simulation
from groundstop.schemas import ROW_KEY
from groundstop.session import scratch_path, scratch_scope
from groundstop.sources import (
    append_batch,
    append_table,
    broken_rows,
    create_if_absent,
    ensure_database,
    new_batches,
    publish_table,
    read_legacy_csv,
    read_modern_csv,
    read_training_csv,
    save_slices,
    whole_rows,
    write_csv,
)
from groundstop.sources.batches import BATCH_NO, known_batch, now_ms
from groundstop.sources.csv import RESCUED


def ingest_job(
    spark: SparkSession,
    legacy_path: str,
    modern_path: str,
    table: str,
    *,
    partition_by_year: bool = False,
    with_key: bool = False,
    quarantine: str | None = None,
) -> bool:
    """Unify both raw layouts into ``table`` unless it already exists; True if written.

    No shuffle: scan -> project -> union -> write.  ``partition_by_year``
    lays the table out by flight year, so year filters prune whole folders.
    ``with_key``: the raw files carry a leading ``row_key`` (test fixtures).

    A file whose header is not the layout's fails the job.  So does a line
    that does not fit, unless ``quarantine`` names a table for such lines:
    then the others are loaded and the broken ones appended there, with
    layout, file, text and what could be read.  They are counted while the
    flights are written; the files are read again only if there are any.
    """
    mode = "rescue" if quarantine else "fail"
    legacy = read_legacy_csv(spark, legacy_path, with_key=with_key, broken=mode)
    modern = read_modern_csv(spark, modern_path, with_key=with_key, broken=mode)
    watched = {"legacy": (legacy, Observation()), "modern": (modern, Observation())}
    if quarantine:
        legacy, modern = (whole_rows(df.observe(seen, F.count(RESCUED).alias("broken"))) for df, seen in watched.values())
    flights = ingest.unify(legacy, modern)
    if partition_by_year:
        flights = flights.withColumn("year", F.year("fl_date"))
        ensure_database(spark, table)
        if spark.catalog.tableExists(table):
            return False
        flights.write.format("parquet").partitionBy("year").mode("ignore").saveAsTable(table)
    elif not create_if_absent(flights, table):
        return False
    if quarantine:
        for layout, (df, seen) in watched.items():
            if seen.get["broken"]:
                append_table(broken_rows(df, layout), quarantine, "parquet")
    return True


def analysis_job(flights: DataFrame, k: int = 10) -> dict[str, DataFrame]:
    """The exploratory results, as DataFrames (show / write them as needed).

    All rates come from one pass over the flights, stored as a small table
    (one row per carrier, year, week, route and direction) that the results
    read; the column profile is a second, pruned pass.
    """
    spark = flights.sparkSession
    path = scratch_path(spark, "rates")
    rates.all_rates(flights).write.parquet(path)
    stored = spark.read.parquet(path)

    def one(kind: str, key, total: str, part: str, percent: str) -> DataFrame:
        return stored.where(F.col("kind") == kind).select(
            key, F.col("count_total").alias(total), F.col("count_delays").alias(part), F.col("delay_percent").alias(percent))

    by_carrier = one("carrier", F.col("key").alias("op_carrier"), "count_total", "count_delays", "delay_percent")
    by_year = one("year", F.col("key").cast("int").alias("year"), "count_total", "cancel_total", "delay_percent")
    by_week = one("week", F.col("key").cast("int").alias("week"), "count_total", "cancel_total", "delay_percent")
    by_route = one("route", F.col("key").alias("route"), "count_all", "count", "cancelled_percent")
    directed = stored.where("kind = 'direction'").select(F.col("key").alias("combo"), F.col("count_delays").alias("count"))
    return {
        "rate_by_carrier": by_carrier.orderBy(F.col("delay_percent").desc()),
        "top_carriers": rates.top_k(by_carrier, "delay_percent", "op_carrier", k),
        "rate_by_year": by_year.orderBy(F.col("year").desc()),
        "rate_by_week": by_week.orderBy(F.col("week").desc()),
        "top_routes": rates.top_k(by_route, "cancelled_percent", "route", k),
        "top_directed_routes": rates.top_k(directed, "count", "combo", k),
        "unused_columns": profile.unused_columns(flights.where(F.col("cancelled") == 1)),
    }


def sample_job(flights: DataFrame, out_path: str, fraction: float = 0.03) -> str:
    """Balanced training sample (all cancelled + ``fraction`` of the rest) as header CSV."""
    return write_csv(features.training_sample(flights, fraction), out_path)


def train_job(
    spark: SparkSession, sample_path: str, model_path: str, *, max_iter: int = 100, max_depth: int = 6,
    step_size: float = 0.3,
) -> DataFrame:
    """Fit on 75% of the sample, save the model, return the report on the other 25%."""
    fl = features.features_label(read_training_csv(spark, sample_path, with_key=True)).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        train, test = sampling.train_test_split(fl)
        fitted = model.fit_model(fl, train, max_iter=max_iter, max_depth=max_depth, step_size=step_size)
        model.save_model(fitted, model_path)
        scored = model.score(fitted, test, [ROW_KEY, "cancelled"])
        rows = report.classification_report(scored, label="cancelled", prediction="prediction").collect()  # five rows
    finally:
        fl.unpersist()
    return spark.createDataFrame(rows, "class_name string, precision double, recall double, f1_score double, support long")


def score_job(spark: SparkSession, model_path: str, requests: DataFrame, feature: str = "feature") -> DataFrame:
    """Score request texts ``"carrier,origin,dest,week,hour"``: prediction and probability.

    Every request comes back.  One with a missing or unreadable part, a week
    that is not an ISO week (1-53), an hour that is not 0-24 or a category
    the model has not seen gets ``valid = false`` and null results instead
    of a score.

    Each different text is parsed and scored once and joined to its requests.
    The texts with a score are at most the model's categories multiplied with
    53 weeks and 25 hours, however many requests there are.  ``requests`` is
    read twice, so a costly one should be stored.
    """
    keep = [F.col(c) for c in requests.columns if c != feature]
    texts = requests.select(F.col(feature).alias("_text")).distinct()
    parsed = scoring.parse_requests(texts, "_text", keep=["_text"]).withColumn("_valid", scoring.request_valid())
    scored = model.score(model.load_model(model_path), parsed, ["_text", "_valid"])
    scored = _only_valid(scored, scored["_valid"]).drop("_valid")
    results = [c for c in scored.columns if c != "_text"]
    return requests.join(scored, F.col(feature).eqNullSafe(F.col("_text")), "left").select(*keep, *results)


def _only_valid(scored: DataFrame, also: Column) -> DataFrame:
    """``valid`` is ``valid and also``; results of other rows are null."""
    valid = F.col("valid") & also
    return scored.withColumns({c: F.when(valid, F.col(c)) for c in ("prediction", "p_cancel", "proba")} | {"valid": valid})


def monitor_job(
    scored_requests: DataFrame, labels: DataFrame, metrics_table: str, deployment: str, block_size: int = 100
) -> DataFrame:
    """Publish the flat, cleaned metrics table: a record per prediction and per full block.

    The label join is computed once, into a narrow stored table that both
    the prediction records and the blocks read; scratch is removed after
    the table is published.  Readers of ``metrics_table`` see the old records
    until the new ones are complete, then those.
    """
    spark = scored_requests.sparkSession
    with scratch_scope(spark):
        path = scratch_path(spark, "labelled")
        monitor.with_late_labels(scored_requests, labels).select(
            "uuid", "timestamp_ms", "feature", "p_cancel", "prediction", "final_label").write.option("compression", "zstd").parquet(path)
        publish_table(monitor.metrics_frame(spark.read.parquet(path), deployment, block_size, stored=True), metrics_table)
    return spark.table(metrics_table)


def prototype_job(source: DataFrame, table: str, airports: list[str], year_slices: list[tuple[int, int | None]]) -> str:
    """Load slices (airport x year range) of the prototype table (ORC).

    One scan of the source writes all slices; each is a partition that is
    replaced as a whole, so a load can be repeated and leaves the other
    slices as they are.  A filter on ``origin`` prunes partitions, one on the
    date skips sorted stripes, one on carrier or destination asks their bloom
    filters.
    """
    rows = ingest.prototype_slices(source, airports, year_slices)
    return save_slices(rows, table, ["origin", "year_slice"], ["fl_date"], bloom=["op_carrier", "dest"])


def simulation_job(flights: DataFrame, table: str) -> str:
    """Publish the all-text simulation table."""
    return publish_table(simulation.simulation_frame(flights), table)


def score_and_monitor_job(
    spark: SparkSession, simulation_rows: DataFrame, model_path: str, log_table: str, labels: DataFrame, metrics_table: str,
    deployment: str, *, n: int = 10_000, buckets: int = 16, started_ms: int | None = None, batch: str | None = None, key: str = ROW_KEY,
) -> DataFrame:
    """Sample, clean, score, log, attach late labels and publish the metrics table.

    ``labels`` holds ``(uuid, final_label)``.  The batch's time is taken once,
    when the job starts (``started_ms`` sets another), and kept with the
    batch; a logged prediction's time is that plus its place in the order of
    the keys.  ``batch`` names the batch: a job that is tried again under the
    same name finds it in the log and does not score or log it twice.
    Requests that cannot be scored are not logged.
    """
    started_ms = now_ms() if started_ms is None else started_ms
    batch = uuid.uuid4().hex if batch is None else batch
    if known_batch(spark, log_table, batch) is None:
        with scratch_scope(spark):
            sample = simulation.simulation_sample(simulation_rows, n, key)
            path = scratch_path(spark, "requests")
            scoring.request_frame(sample).select(F.col(key).alias("uuid"), "feature").write.parquet(path)
            requests = spark.read.parquet(path)
            scored = score_job(spark, model_path, requests.withColumn("text", F.col("feature"))).withColumnRenamed("text", "feature")
            timed = monitor.with_position(scored.where("valid").select("uuid", "feature", "prediction", "p_cancel", "proba"), ["uuid"])
            timed = timed.select("uuid", (F.lit(started_ms) + F.col("position")).cast("long").alias("timestamp_ms"), "feature", "prediction", "p_cancel", "proba")
            append_batch(timed, log_table, batch, "uuid", buckets, started_ms)
    logged, _ = new_batches(spark, log_table)
    return monitor_job(logged.drop(BATCH_NO), labels, metrics_table, deployment)


def log_predictions(scored_requests: DataFrame, table: str, buckets: int, key: str = "uuid", batch: str | None = None, started_ms: int | None = None) -> bool:
    """Append a batch of scored requests to the prediction log, bucketed on the prediction id; False if the batch is there already."""
    return append_batch(scored_requests, table, batch or uuid.uuid4().hex, key, buckets, started_ms)


def store_labels(labels: DataFrame, table: str, buckets: int, key: str = "uuid", batch: str | None = None) -> bool:
    """Append a batch of arrived ground-truth labels, bucketed like the prediction log; False if the batch is there already."""
    return append_batch(labels, table, batch or uuid.uuid4().hex, key, buckets)


def labelled_rows(spark: SparkSession, log_table: str, labels_table: str, key: str = "uuid") -> DataFrame:
    """Every logged prediction with its label (null while pending).

    Both tables are bucketed on ``key`` with the same count, so this left
    join reads matching buckets side by side: no shuffle of either table.
    """
    logged, labels = (new_batches(spark, t)[0].drop(BATCH_NO) for t in (log_table, labels_table))
    return logged.join(labels, key, "left")
