"""Registered queries: training sample, features, split, encoding, scale, model."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from groundstop import fixtures as fx, jobs
from groundstop.operators import features, model, report, sampling, scoring, simulation
from groundstop.plans.ingest_io import SIM_BLANK_SQL, SIM_TEXT_COLS, clean_sql, simulation_with_blank_hours
from groundstop.plans.registry import query
from groundstop.plans.views import with_views
from groundstop.schemas import TARGET_NAMES, TRAINING_COLUMNS
from groundstop.session import scratch_path
from groundstop.sources import load_tables, read_training_csv, write_csv

# --- oracle text -------------------------------------------------------------

_TS_SQL = """
SELECT row_key, fl_date, op_carrier, op_carrier_fl_num, origin, dest, crs_dep_time, crs_arr_time,
  cancelled, crs_elapsed_time, distance,
  CAST(CAST(crs_dep_time AS INT) // 100 AS INT) AS hour, CAST(weekofyear(fl_date) AS INT) AS week
FROM flights
WHERE cancelled = 1 OR (cancelled = 0 AND substring(md5(row_key), 1, 8) < '07ae147b')"""

_FL_SQL = "SELECT row_key, op_carrier, origin, dest, week, hour, cancelled FROM ts WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in TRAINING_COLUMNS
)

_SPLIT_EXPR = "substring(md5(concat(row_key, '#split')), 1, 8) < 'c0000000'"

_CI_SQL = """
SELECT column_name, category,
  CAST(row_number() OVER (PARTITION BY column_name ORDER BY category) - 1 AS INT) AS idx
FROM (SELECT DISTINCT 'op_carrier' AS column_name, op_carrier AS category FROM fl
      UNION ALL SELECT DISTINCT 'origin', origin FROM fl
      UNION ALL SELECT DISTINCT 'dest', dest FROM fl) d"""

_FEATURE_CTES = [("ts", _TS_SQL), ("fl", _FL_SQL)]

_ONEHOT_SQL = """
SELECT fl.row_key,
  c.idx AS pos_carrier,
  CAST((SELECT count(*) FROM ci WHERE column_name = 'op_carrier') + o.idx AS INT) AS pos_origin,
  CAST((SELECT count(*) FROM ci WHERE column_name IN ('op_carrier', 'origin')) + d.idx AS INT) AS pos_dest,
  fl.week, fl.hour
FROM fl
JOIN ci c ON c.column_name = 'op_carrier' AND c.category = fl.op_carrier
JOIN ci o ON o.column_name = 'origin' AND o.category = fl.origin
JOIN ci d ON d.column_name = 'dest' AND d.category = fl.dest"""

_SCALE_SQL = """
SELECT concat_ws('=', ci.column_name, ci.category) AS feature,
  round(sqrt(coalesce(cnt.k, 0) * (tot.n - coalesce(cnt.k, 0)) / (tot.n * tot.n)), 6) AS std
FROM ci LEFT JOIN cnt ON ci.column_name = cnt.column_name AND ci.category = cnt.category
JOIN tot ON ci.column_name = tot.column_name
UNION ALL SELECT 'week', round(stddev_pop(week), 6) FROM tr
UNION ALL SELECT 'hour', round(stddev_pop(hour), 6) FROM tr"""

_SCALE_CTES = _FEATURE_CTES + [
    ("ci", _CI_SQL),
    ("tr", f"SELECT * FROM fl WHERE {_SPLIT_EXPR}"),
    ("cnt", """
SELECT 'op_carrier' AS column_name, op_carrier AS category, CAST(count(*) AS DOUBLE) AS k FROM tr GROUP BY 2
UNION ALL SELECT 'origin', origin, CAST(count(*) AS DOUBLE) FROM tr GROUP BY 2
UNION ALL SELECT 'dest', dest, CAST(count(*) AS DOUBLE) FROM tr GROUP BY 2"""),
    ("tot", "SELECT column_name, sum(k) AS n FROM cnt GROUP BY column_name"),
]

_TEST_ROWS = f"FROM fl WHERE NOT ({_SPLIT_EXPR})"


def _sample(spark, sf_dir):
    return features.training_sample(fx.flights(load_tables(spark, sf_dir)))


def _features(spark, sf_dir):
    return features.features_label(_sample(spark, sf_dir))


# --- sample, features, split -------------------------------------------------


@query("training_sample", with_views(["flights"], _TS_SQL), bench=True)
def training_sample(spark, sf_dir):
    return _sample(spark, sf_dir)


@query("sample_csv_roundtrip", with_views(["flights"], _TS_SQL))
def sample_csv_roundtrip(spark, sf_dir):
    path = write_csv(_sample(spark, sf_dir), scratch_path(spark, "training_sample"))
    return read_training_csv(spark, path, with_key=True)


@query("features_label", with_views(["flights"], "SELECT * FROM fl", extra=_FEATURE_CTES))
def features_label(spark, sf_dir):
    return _features(spark, sf_dir)


@query(
    "split_counts",
    with_views(
        ["flights"],
        f"SELECT CASE WHEN {_SPLIT_EXPR} THEN 'train' ELSE 'test' END AS split, CAST(count(*) AS BIGINT) AS n "
        "FROM fl GROUP BY 1",
        extra=_FEATURE_CTES,
    ),
)
def split_counts(spark, sf_dir):
    return sampling.split_counts(_features(spark, sf_dir))


@query("category_index", with_views(["flights"], _CI_SQL, extra=_FEATURE_CTES))
def category_index(spark, sf_dir):
    return features.category_index(_features(spark, sf_dir))


@query("onehot_positions", with_views(["flights"], _ONEHOT_SQL, extra=_FEATURE_CTES + [("ci", _CI_SQL)]))
def onehot_positions(spark, sf_dir):
    """Slots of each row's categories, looked up in the stored dictionary by join."""
    fl, path = _features(spark, sf_dir), scratch_path(spark, "dictionary")
    features.onehot_slots(features.category_index(fl)).write.parquet(path)
    names = ["pos_carrier", "pos_origin", "pos_dest"]
    return features.with_index(fl, spark.read.parquet(path), value="slot", names=names).select("row_key", *names, "week", "hour")


@query("feature_scale", with_views(["flights"], _SCALE_SQL, extra=_SCALE_CTES))
def feature_scale(spark, sf_dir):
    scale = features.indicator_scale(_features(spark, sf_dir), sampling.split_flag())
    return scale.withColumn("std", F.round("std", 6))


# --- model -------------------------------------------------------------------


# Rounds, depth and bins of the registered fits: the classifier's usual defaults.
FIT = {"max_iter": 100, "max_depth": 6, "max_bins": 64}

# A label that a right model must learn: flights of the later carriers, or departing after noon.
_RULE = "CASE WHEN op_carrier >= 'Brand#4' OR hour >= 12 THEN 1 ELSE 0 END"


@contextlib.contextmanager
def _fitted(spark, sf_dir, label=None):
    """(model, sample, test part), fitted on the stored training sample of ``sf_dir``."""
    path = scratch_path(spark, "model_sample")
    fl = _features(spark, sf_dir)
    (fl.withColumn("cancelled", F.expr(label).cast("double")) if label else fl).write.parquet(path)
    fl = spark.read.parquet(path)
    train, test = sampling.train_test_split(fl)
    yield model.fit_model(fl, train, **FIT), fl, test


@query(
    "model_train_eval",
    with_views(
        ["flights"],
        f"SELECT CAST({_RULE} AS INT) AS label, CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_prob_valid, "
        f"true AS recall_above_95, true AS precision_above_95 {_TEST_ROWS} GROUP BY 1",
        extra=_FEATURE_CTES,
    ),
)
def model_train_eval(spark, sf_dir):
    """The report on the test part of a fit on a learnable label: a row per class.

    Scores are engine-specific, so precision and recall are compared with a
    bound that a constant or broken model cannot meet.
    """
    with _fitted(spark, sf_dir, _RULE) as (fitted, _, test):
        scored = model.score(fitted, test, ["row_key", "cancelled"])
        # The scored test part is stored, as the report and the counts both read it.
        path = scratch_path(spark, "model_scored")
        scored.write.parquet(path)
    scored = spark.read.parquet(path)
    names = F.when(F.col("class_name") == TARGET_NAMES[0], 0).when(F.col("class_name") == TARGET_NAMES[1], 1)
    classes = report.classification_report(scored, label="cancelled").select(names.alias("label"), "recall", "precision").where("label IS NOT NULL")
    prob_ok = F.col("valid") & F.col("p_cancel").between(0.0, 1.0) & ((F.col("p_cancel") >= 0.5) == (F.col("prediction") == 1))
    counts = scored.groupBy(F.col("cancelled").cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(prob_ok, 1)).alias("n_prob_valid"))
    return counts.join(classes, "label").select(
        "label", "n", "n_prob_valid", (F.col("recall") > 0.95).alias("recall_above_95"), (F.col("precision") > 0.95).alias("precision_above_95"))


@query(
    "model_roundtrip",
    with_views(
        ["flights"],
        f"SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS n_equal {_TEST_ROWS}",
        extra=_FEATURE_CTES,
    ),
)
def model_roundtrip(spark, sf_dir):
    """Save, load, score again: every test prediction must be equal."""
    with _fitted(spark, sf_dir) as (fitted, _, test):
        reloaded = model.load_model(model.save_model(fitted, scratch_path(spark, "model")))
        a = model.score(fitted, test, ["row_key"])
        b = model.score(reloaded, test, ["row_key"]).select(
            "row_key", F.col("prediction").alias("prediction_2"), F.col("p_cancel").alias("p_cancel_2")
        )
    same = (F.col("prediction") == F.col("prediction_2")) & (F.col("p_cancel") == F.col("p_cancel_2"))
    return a.join(b, "row_key").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(same, 1)).alias("n_equal")
    )


# Requests as they come: some blank, short, unreadable or of a carrier that no model knows.
_BAD_SQL = f"""
SELECT row_key, op_carrier, origin, dest,
  CASE WHEN l = 1 THEN 'short' WHEN l = 2 THEN 'text' WHEN l = 3 THEN 'unseen' WHEN l = 4 THEN 'null' ELSE 'good' END AS kind
FROM (SELECT *, ascii(substring(md5(row_key), 1, 1)) - 48 AS l FROM cleaned WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SIM_TEXT_COLS)})"""


@query(
    "score_batch",
    with_views(
        ["flights"],
        "SELECT row_key, v AS valid, v AS prediction_ok, v AS probability_ok FROM (SELECT row_key, "
        "kind = 'good' AND op_carrier IN (SELECT op_carrier FROM fl) AND origin IN (SELECT origin FROM fl) "
        "AND dest IN (SELECT dest FROM fl) AS v FROM bad) q",
        extra=[*_FEATURE_CTES, ("sim_blank", SIM_BLANK_SQL), ("cleaned", clean_sql()), ("bad", _BAD_SQL)],
    ),
)
def score_batch(spark, sf_dir):
    """Clean and score every flight's request text; some of the texts cannot be scored.

    Every request comes back; the bad ones (too short, unreadable, a null
    field, an unseen carrier) are not valid and have no score.
    """
    with _fitted(spark, sf_dir) as (fitted, _, _):
        path = model.save_model(fitted, scratch_path(spark, "model"))
    clean = simulation.drop_incomplete(simulation.clean_values(simulation_with_blank_hours(spark, sf_dir)))
    requests = scoring.request_frame(clean).select("row_key", "feature")
    digit = F.ascii(F.substring(F.md5("row_key"), 1, 1)) - 48
    parts = F.split("feature", ",")
    broken = (
        F.when(digit == 1, F.substring_index("feature", ",", 3))
        .when(digit == 2, F.concat(F.substring_index("feature", ",", 3), F.lit(",soon,late")))
        .when(digit == 3, F.concat(F.lit("Nobody"), F.expr("substring(feature, length(split(feature, ',')[0]) + 1)")))
        .when(digit == 4, F.concat_ws(",", parts[0], F.lit(""), parts[2], parts[3], parts[4]))
        .otherwise(F.col("feature"))
    )
    kept = scratch_path(spark, "requests")
    requests.withColumn("feature", broken).write.option("compression", "zstd").parquet(kept)
    scored = jobs.score_job(spark, path, spark.read.parquet(kept))
    ok = lambda c: F.coalesce(c, F.lit(False))
    return scored.select(
        "row_key", "valid", ok(F.col("prediction").isin(0, 1)).alias("prediction_ok"), ok(F.col("p_cancel").between(0.0, 1.0)).alias("probability_ok"))
