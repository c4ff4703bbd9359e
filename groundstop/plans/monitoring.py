"""Registered queries: scoring requests and responses, delayed labels, reports,
accuracy per block, metric records, prediction log, model registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from groundstop import fixtures as fx, incremental, jobs
from groundstop.functions import hash_sample
from groundstop.operators import features, monitor, nested, registry, report, scoring, simulation
from groundstop.plans.features_model import _TS_SQL
from groundstop.plans.ingest_io import _SIM_SQL
from groundstop.plans.registry import query
from groundstop.plans.views import with_views
from groundstop.session import scratch_path, scratch_table
from groundstop.sources import load_tables, new_batches, publish_table, read_registry_json
from groundstop.sources.batches import BATCH_NO

DEPLOYMENT = "deployment-crn-1"

# Least buckets of the registered prediction log, and the rows for which one more is taken: a task sorts one bucket.
LOG_BUCKETS, BUCKET_ROWS = 8, 1_000_000

# --- oracle text -------------------------------------------------------------

_LAB = ("lab", "SELECT s.uuid, s.timestamp_ms, s.p_cancel, s.prediction, l.final_label "
               "FROM scored s JOIN late_labels l ON s.uuid = l.uuid")

_BLOCKS_SQL = """
SELECT CAST((position - 1) // 100 AS BIGINT) AS block, CAST(count(*) AS BIGINT) AS n,
  round(avg(CASE WHEN final_label = prediction THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS accuracy,
  min(timestamp_ms) AS start_ms, max(timestamp_ms) AS end_ms
FROM (SELECT *, row_number() OVER (ORDER BY timestamp_ms, uuid) AS position FROM lab) p
GROUP BY 1 HAVING count(*) = 100"""

_CONF_SQL = """
SELECT count(CASE WHEN final_label = 0 AND prediction = 0 THEN 1 END) AS c00,
       count(CASE WHEN final_label = 0 AND prediction = 1 THEN 1 END) AS c01,
       count(CASE WHEN final_label = 1 AND prediction = 0 THEN 1 END) AS c10,
       count(CASE WHEN final_label = 1 AND prediction = 1 THEN 1 END) AS c11
FROM lab"""

_MET_SQL = """
SELECT CASE WHEN c00 + c10 > 0 THEN CAST(c00 AS DOUBLE) / (c00 + c10) ELSE 0 END AS p0,
       CASE WHEN c00 + c01 > 0 THEN CAST(c00 AS DOUBLE) / (c00 + c01) ELSE 0 END AS r0,
       c00 + c01 AS s0,
       CASE WHEN c11 + c01 > 0 THEN CAST(c11 AS DOUBLE) / (c11 + c01) ELSE 0 END AS p1,
       CASE WHEN c11 + c10 > 0 THEN CAST(c11 AS DOUBLE) / (c11 + c10) ELSE 0 END AS r1,
       c10 + c11 AS s1,
       CAST(c00 + c11 AS DOUBLE) / (c00 + c01 + c10 + c11) AS acc
FROM conf"""

_F1_SQL = """
SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
          CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1
FROM met"""

_REPORT_SQL = """
SELECT 'Not-cancelled' AS class_name, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM mf
UNION ALL SELECT 'Cancelled', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM mf
UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), CAST(s0 + s1 AS BIGINT) FROM mf
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(s0 + s1 AS BIGINT) FROM mf
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
  round((f0 * s0 + f1 * s1) / (s0 + s1), 6), CAST(s0 + s1 AS BIGINT) FROM mf"""

_METRICS_SQL = f"""
SELECT record_id, epoch_ms(start_ms) AS start_ts, epoch_ms(end_ms) AS end_ts,
  end_ms - start_ms AS processing_time_ms, coalesce(accuracy, CAST(-1 AS DOUBLE)) AS metrics_accuracy,
  feature AS metrics_input_data_feature, proba AS metrics_proba, final_label AS metrics_final_label,
  '{DEPLOYMENT}' AS model_deployment_crn
FROM (
  SELECT s.uuid AS record_id, s.timestamp_ms AS start_ms, s.timestamp_ms AS end_ms, CAST(NULL AS DOUBLE) AS accuracy,
    s.feature, s.p_cancel AS proba, l.final_label = 1 AS final_label
  FROM scored_requests s LEFT JOIN late_labels l ON s.uuid = l.uuid
  UNION ALL
  SELECT concat('block-', lpad(CAST(block AS VARCHAR), 9, '0')), start_ms, end_ms, accuracy,
    CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), CAST(NULL AS BOOLEAN)
  FROM blocks
) r"""

_MON_CTES = [_LAB, ("blocks", _BLOCKS_SQL)]
_REPORT_CTES = [_LAB, ("conf", _CONF_SQL), ("met", _MET_SQL), ("mf", _F1_SQL)]


def _t(spark, sf_dir):
    return load_tables(spark, sf_dir)


def _labelled(spark, sf_dir):
    t = _t(spark, sf_dir)
    return monitor.attach_labels(fx.scored(t), fx.late_labels(t))


def _published(spark, sf_dir) -> str:
    """The published metrics table of the folder's scored log."""
    log, truth = fx.stored_log(_t(spark, sf_dir), with_feature=True)
    table = scratch_table(spark, "model_metrics")
    jobs.monitor_job(log, truth, table, DEPLOYMENT)
    return table


def _metrics_for_check(spark, table):
    return spark.table(table).withColumn("metrics_accuracy", F.round("metrics_accuracy", 6))


# --- delayed labels, reports, blocks -------------------------------------------


@query("labels_joined", with_views(["scored", "late_labels"], "SELECT * FROM lab", extra=[_LAB]), bench=True)
def labels_joined(spark, sf_dir):
    return _labelled(spark, sf_dir)


@query(
    "labels_pending",
    with_views(["scored", "late_labels"],
               "SELECT s.* FROM scored s WHERE NOT EXISTS (SELECT 1 FROM late_labels l WHERE l.uuid = s.uuid)"),
    bench=True,
)
def labels_pending(spark, sf_dir):
    t = _t(spark, sf_dir)
    return monitor.pending_labels(fx.scored(t), fx.late_labels(t))


@query(
    "confusion_matrix",
    with_views(["scored", "late_labels"],
               "SELECT CAST(final_label AS INT) AS label, CAST(prediction AS INT) AS prediction, "
               "CAST(count(*) AS BIGINT) AS n FROM lab GROUP BY 1, 2", extra=[_LAB]),
)
def confusion_matrix(spark, sf_dir):
    return report.confusion_matrix(_labelled(spark, sf_dir))


@query("class_report", with_views(["scored", "late_labels"], _REPORT_SQL, extra=_REPORT_CTES), bench=True)
def class_report(spark, sf_dir):
    r = report.classification_report(_labelled(spark, sf_dir))
    return r.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1_score")})


@query("accuracy_by_block", with_views(["scored", "late_labels"], "SELECT * FROM blocks", extra=_MON_CTES), bench=True)
def accuracy_by_block(spark, sf_dir):
    return monitor.accuracy_by_block(_labelled(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


@query("accuracy_by_block_incremental", with_views(["scored", "late_labels"], "SELECT * FROM blocks", extra=_MON_CTES))
def accuracy_by_block_incremental(spark, sf_dir):
    """The same blocks from two runs, each over the batch that arrived since the last; a third finds nothing new.

    The labels of the second half's predictions come with the first batch,
    before the predictions that they belong to.
    """
    arrived, told = fx.stored_log(_t(spark, sf_dir))
    log, truth, state = (scratch_table(spark, n) for n in ("inc_log", "inc_labels", "inc_state"))
    scored = arrived.select("uuid", "timestamp_ms", "prediction")
    middle = F.lit(scored.agg(F.percentile_approx("timestamp_ms", 0.5)).first()[0])
    buckets = max(LOG_BUCKETS, arrived.count() // BUCKET_ROWS)
    jobs.store_labels(told, truth, buckets)
    for half in (F.col("timestamp_ms") <= middle, F.col("timestamp_ms") > middle):
        jobs.log_predictions(scored.where(half), log, buckets)
        incremental.monitor_increment(spark, log, truth, state)
    incremental.monitor_increment(spark, log, truth, state)
    return incremental.closed_blocks(spark, state).withColumn("accuracy", F.round("accuracy", 6))


@query(
    "progress_fraction",
    with_views(["scored"],
               "SELECT uuid, CAST(row_number() OVER (ORDER BY timestamp_ms, uuid) AS BIGINT) AS position, "
               "round(CAST(row_number() OVER (ORDER BY timestamp_ms, uuid) AS DOUBLE) / count(*) OVER (), 6) AS progress "
               "FROM scored"),
    bench=True,
)
def progress_fraction(spark, sf_dir):
    s = fx.scored(_t(spark, sf_dir)).select("uuid", "timestamp_ms")
    return monitor.progress(s, ["timestamp_ms", "uuid"]).select("uuid", "position", F.round("progress", 6).alias("progress"))


@query("metrics_table", with_views(["scored", "scored_requests", "late_labels"], _METRICS_SQL, extra=_MON_CTES), bench=True)
def metrics_table(spark, sf_dir):
    """Publish the flat metrics log; the table it replaces stays until the new one is written."""
    return _metrics_for_check(spark, _published(spark, sf_dir))


_TAIL_FIELDS = ["record_id", "model_deployment_crn", "metrics_input_data_feature", "processing_time_ms"]


@query(
    "metrics_tail",
    with_views(
        ["scored", "scored_requests", "late_labels"],
        "SELECT field, " + ", ".join(f"max(CASE WHEN n = {i} THEN v END) AS row_{i}" for i in range(1, 6)) + " FROM ("
        + " UNION ALL ".join(f"SELECT n, '{c}' AS field, CAST({c} AS VARCHAR) AS v FROM tail" for c in _TAIL_FIELDS)
        + ") u GROUP BY field",
        extra=[*_MON_CTES, ("tail", f"SELECT *, row_number() OVER (ORDER BY end_ts DESC, record_id DESC) AS n FROM ({_METRICS_SQL}) m "
                                    "ORDER BY end_ts DESC, record_id DESC LIMIT 5")],
    ),
)
def metrics_tail(spark, sf_dir):
    """The last five published records, turned sideways: a row per field, a column per record."""
    last = spark.table(_published(spark, sf_dir)).orderBy(F.col("end_ts").desc(), F.col("record_id").desc()).limit(5)
    return report.sideways(last.select(*_TAIL_FIELDS, "end_ts"), [F.col("end_ts").desc(), F.col("record_id").desc()], _TAIL_FIELDS, 5)


@query(
    "sink_replace_table",
    with_views(["flights"], "SELECT * FROM ts", extra=[("ts", _TS_SQL)]),
)
def sink_replace_table(spark, sf_dir):
    """A second publication replaces content and schema of the first in one statement; readers see one or the other."""
    f = fx.flights(_t(spark, sf_dir))
    table = scratch_table(spark, "replaced")
    publish_table(f, table)
    publish_table(features.training_sample(spark.table(table)), table)
    return spark.table(table)


# --- scoring requests and responses -----------------------------------------------

_REQ_SQL = ("SELECT row_key, fl_date, op_carrier, op_carrier_fl_num, origin, dest, crs_dep_time, crs_arr_time, "
            "cancelled, crs_elapsed_time, distance, hour, week, "
            "concat_ws(',', op_carrier, origin, dest, week, hour) AS feature FROM sim")


def _requests(spark, sf_dir):
    sim = simulation.simulation_frame(fx.flights(_t(spark, sf_dir)))
    return scoring.request_frame(sim)


@query("score_request", with_views(["flights"], _REQ_SQL, extra=[("sim", _SIM_SQL)]))
def score_request(spark, sf_dir):
    return _requests(spark, sf_dir)


@query(
    "score_request_parse",
    with_views(
        ["flights"],
        "SELECT row_key, split_part(feature, ',', 1) AS op_carrier, split_part(feature, ',', 2) AS origin, "
        "split_part(feature, ',', 3) AS dest, CAST(split_part(feature, ',', 4) AS INT) AS week, "
        "CAST(split_part(feature, ',', 5) AS INT) AS hour FROM req",
        extra=[("sim", _SIM_SQL), ("req", _REQ_SQL)],
    ),
    bench=True,
)
def score_request_parse(spark, sf_dir):
    return scoring.parse_requests(_requests(spark, sf_dir))


@query(
    "score_request_json",
    with_views(
        ["flights"],
        "SELECT row_key, to_json(struct_pack(feature := feature)) AS request_json, feature AS feature_back FROM req",
        extra=[("sim", _SIM_SQL), ("req", _REQ_SQL)],
    ),
)
def score_request_json(spark, sf_dir):
    req = _requests(spark, sf_dir).select("row_key", scoring.to_request_json("feature").alias("request_json"))
    return req.withColumn("feature_back", scoring.from_request_json("request_json"))


# Orders by the last digits of their number: whose record is null, unreadable, empty, without data.
_RECORD_KINDS = {17: None, 18: '{"data": {"rows": [[', 19: '{"data":{"rows":[]}}', 16: "{}"}
_REPLY_HEAD = '{"version":"1.0","data":{"colnames":["prediction","proba"],"coltypes":["INT","STRING"],"rows":['

_RECORDS_SQL = f"""
SELECT record_id, concat('{_REPLY_HEAD}', CASE WHEN record_id % 20 IN (16, 17, 18, 19) THEN '' ELSE cells END, ']}}}}') AS reply_json
FROM (
  SELECT record_id, string_agg(concat('[', CASE WHEN ok THEN CAST(CASE WHEN r >= 50 THEN 1 ELSE 0 END AS VARCHAR) ELSE 'null' END, ',',
    CASE WHEN ok THEN concat('"', CAST(round(greatest(CAST(r AS DOUBLE) / 100, 1 - CAST(r AS DOUBLE) / 100), 2) AS VARCHAR), '"') ELSE 'null' END, ']'),
    ',' ORDER BY uuid) AS cells
  FROM (
    SELECT uuid, CAST(split_part(uuid, '-', 1) AS BIGINT) AS record_id, split_part(uuid, '-', 2) <> '6' AS ok,
      (CAST(split_part(feature, ',', 4) AS INT) * 7 + CAST(split_part(feature, ',', 5) AS INT) * 13) % 101 AS r
    FROM scored_requests
  ) q GROUP BY record_id
) a"""


@query("score_records", with_views(["scored_requests"], _RECORDS_SQL))
def score_records(spark, sf_dir):
    """Batch records (one per order, a row per line) scored and answered: one reply per record, its rows in order.

    Some records are null, unreadable, empty or without data; the sixth line
    of an order has an hour that is none.  A fixed rule stands in for a model.
    """
    lines = fx.scored(_t(spark, sf_dir), with_feature=True).select(
        "uuid", F.split_part("uuid", F.lit("-"), F.lit(1)).cast("long").alias("record_id"),
        F.split(F.when(F.split_part("uuid", F.lit("-"), F.lit(2)) == "6", F.regexp_replace("feature", "[0-9]+$", "soon")).otherwise(F.col("feature")), ",").alias("cells"))
    rows = F.transform(F.sort_array(F.collect_list(F.struct("uuid", "cells"))), lambda r: r["cells"])
    records = lines.groupBy("record_id").agg(F.to_json(F.struct(F.struct(rows.alias("rows")).alias("data"))).alias("record_json"))
    for digits, text in _RECORD_KINDS.items():
        records = records.withColumn("record_json", F.when(F.col("record_id") % 20 == digits, F.lit(text).cast("string")).otherwise(F.col("record_json")))
    parsed = scoring.parse_records(records, keep=["record_id"])
    r = F.when(scoring.request_valid(), (F.col("week") * 7 + F.col("hour") * 13) % 101)
    scored = parsed.withColumns({"p_cancel": r.cast("double") / 100, "prediction": (r >= 50).cast("int")})
    return scoring.reply_records(scored.select("record_id", "row_no", *scoring.response_columns()), "record_id")


@query("score_threshold", with_views(["scored"], "SELECT uuid, p_cancel, p_cancel >= 0.5 AS response_label FROM scored"))
def score_threshold(spark, sf_dir):
    s = fx.scored(_t(spark, sf_dir)).select("uuid", "p_cancel")
    return scoring.threshold(s)


@query(
    "score_output",
    with_views(["scored"],
               "SELECT uuid, CAST(prediction AS INT) AS prediction, "
               "CAST(round(greatest(p_cancel, 1 - p_cancel), 2) AS VARCHAR) AS proba FROM scored"),
)
def score_output(spark, sf_dir):
    s = fx.scored(_t(spark, sf_dir))
    return s.select("uuid", *scoring.response_columns())


@query(
    "prediction_log",
    with_views(["scored_requests"],
               "SELECT uuid, timestamp_ms, feature, CAST(prediction AS INT) AS prediction, "
               "CAST(round(greatest(p_cancel, 1 - p_cancel), 2) AS VARCHAR) AS proba FROM scored_requests"),
)
def prediction_log(spark, sf_dir):
    """Append scored requests to the log in two batches, the first tried twice, and read the log back.

    The log is bucketed on the prediction id, as the production log is, so
    that the later label join is shuffle-free.
    """
    s = fx.scored(_t(spark, sf_dir), with_feature=True)
    rows = s.select("uuid", "timestamp_ms", "feature", *scoring.response_columns())
    table = scratch_table(spark, "prediction_log")
    first = hash_sample("uuid", 0.5)
    written = [jobs.log_predictions(rows.where(part), table, LOG_BUCKETS, batch=name) for part, name in ((first, "a"), (~first, "b"), (first, "a"))]
    if written != [True, True, False]:
        raise RuntimeError("a batch was logged twice or not at all")
    return new_batches(spark, table)[0].drop(BATCH_NO)


# --- model registry ------------------------------------------------------------

_REG_JSON = (
    "to_json(struct_pack(id := id, projectId := project_id, "
    "project := struct_pack(id := project_id, name := project_name, slug := project_slug, crn := project_crn, "
    "default_project_engine_type := project_engine), "
    "projectOwner := struct_pack(id := owner_id, username := owner_username, type := owner_type), "
    "crn := crn, creatorId := creator_id, "
    "creator := struct_pack(id := creator_id, username := creator_username, type := creator_type), "
    "name := name, description := description, visibility := visibility, accessKey := access_key, authEnabled := auth_enabled, "
    "defaultResources := struct_pack(cpuMillicores := cpu_millicores, memoryMb := memory_mb), "
    "defaultReplicationPolicy := struct_pack(type := policy_type, numReplicas := num_replicas), "
    "htmlUrl := html_url, createdAt := created_at, updatedAt := updated_at, namespace := namespace))"
)

_REG_FLAT = {
    "id": "id", "projectId": "project_id", "project_id": "project_id", "project_name": "project_name", "project_slug": "project_slug",
    "project_crn": "project_crn", "project_default_project_engine_type": "project_engine", "projectOwner_id": "owner_id",
    "projectOwner_username": "owner_username", "projectOwner_type": "owner_type", "crn": "crn", "creatorId": "creator_id",
    "creator_id": "creator_id", "creator_username": "creator_username", "creator_type": "creator_type", "name": "name",
    "description": "description", "visibility": "visibility", "accessKey": "access_key", "authEnabled": "auth_enabled",
    "defaultResources_cpuMillicores": "cpu_millicores", "defaultResources_memoryMb": "memory_mb",
    "defaultReplicationPolicy_type": "policy_type", "defaultReplicationPolicy_numReplicas": "num_replicas",
    "htmlUrl": "html_url", "createdAt": "created_at", "updatedAt": "updated_at", "namespace": "namespace",
}


def _record_json(df):
    return F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record_json")


def _registry(spark, sf_dir):
    return registry.nest_registry(fx.registry_flat(_t(spark, sf_dir)))


@query("registry_nested", with_views(["registry_flat"], f"SELECT id, {_REG_JSON} AS record_json FROM registry_flat"))
def registry_nested(spark, sf_dir):
    """Registry records written as JSON lines, read back with the explicit nested schema and published as a table."""
    path = scratch_path(spark, "models_json")
    _registry(spark, sf_dir).write.mode("overwrite").json(path)
    reg = spark.table(publish_table(read_registry_json(spark, path), scratch_table(spark, "models")))
    return reg.select("id", _record_json(reg))


@query(
    "registry_flatten",
    with_views(["registry_flat"], "SELECT " + ", ".join(f'{c} AS "{name}"' for name, c in _REG_FLAT.items()) + " FROM registry_flat"),
)
def registry_flatten(spark, sf_dir):
    return nested.flatten(_registry(spark, sf_dir))


@query(
    "registry_pick",
    with_views(
        ["registry_flat"],
        f"SELECT id, {_REG_JSON} AS record_json FROM registry_flat "
        "WHERE name = 'Supplier#000000003' AND creator_username = 'user-3' ORDER BY id LIMIT 1",
    ),
)
def registry_pick(spark, sf_dir):
    hit = registry.pick_model(_registry(spark, sf_dir), name="Supplier#000000003", creator="user-3")
    return hit.select("id", _record_json(hit))


@query(
    "registry_status",
    with_views(
        ["registry_flat"],
        "SELECT i.id, r.deployment_status AS status, r.replicas_available AS replica_status "
        "FROM (SELECT DISTINCT CAST(CASE WHEN l_linenumber = 1 THEN l_suppkey ELSE -l_suppkey END AS VARCHAR) AS id "
        "FROM lineitem WHERE l_returnflag = 'R') i LEFT JOIN registry_flat r ON r.id = i.id",
    ),
)
def registry_status(spark, sf_dir):
    """Status of requested ids, of which half are in no registry record."""
    li = _t(spark, sf_dir)["lineitem"]
    asked = F.when(F.col("l_linenumber") == 1, F.col("l_suppkey")).otherwise(-F.col("l_suppkey"))
    ids = li.where(F.col("l_returnflag") == "R").select(asked.cast("string").alias("id")).distinct()
    return registry.model_status(ids, registry.nest_status(fx.registry_flat(_t(spark, sf_dir))))
