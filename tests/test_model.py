"""Model pipeline properties (scores are engine-specific; properties are not)."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import functions as F

from groundstop import fixtures as fx, jobs
from groundstop.operators import features, model, sampling
from groundstop.session import scratch_path
from groundstop.sources import load_tables


@pytest.fixture(scope="module")
def fitted(spark, sf_dir):
    fl = features.features_label(features.training_sample(fx.flights(load_tables(spark, sf_dir)))).cache()
    train, test = sampling.train_test_split(fl)
    m = model.fit_model(fl, train, max_iter=5, max_depth=3)
    return m, fl, train, test


def test_probabilities_valid(fitted):
    m, _, _, test = fitted
    rows = model.score(m, test, ["row_key"]).collect()
    assert rows
    assert all(0.0 <= r.p_cancel <= 1.0 for r in rows)
    assert all(float(r.proba) >= 0.5 for r in rows)


def test_reload_gives_equal_predictions(spark, fitted):
    m, _, _, test = fitted
    path = model.save_model(m, scratch_path(spark, "model-test"))
    again = model.load_model(path)
    a = model.score(m, test, ["row_key"])
    b = model.score(again, test, ["row_key"])
    assert a.exceptAll(b).count() == 0


def test_scaler_matches_indicator_scale(fitted):
    m, fl, train, _ = fitted
    scaler = m.stages[3]
    enc_width = model.onehot_width(m)
    stds = list(scaler.std)
    assert len(stds) == enc_width + 2
    ours = {r.feature: r.std for r in features.indicator_scale(fl, sampling.split_flag()).collect()}
    labels = [lab for arr in m.stages[0].labelsArray for lab in arr]
    names = []
    for col, arr in zip(["op_carrier", "origin", "dest"], m.stages[0].labelsArray):
        names += [f"{col}={v}" for v in arr]
    names += ["week", "hour"]
    assert len(labels) == enc_width
    n = train.count()
    for name, std in zip(names, stds):  # the pipeline's scaler divides by n - 1, the operator by n
        assert ours[name] == pytest.approx(std * ((n - 1) / n) ** 0.5, abs=1e-9)


def test_unseen_and_null_values_fail_no_other_row(spark, fitted):
    m, fl, _, _ = fitted
    carrier, origin, dest = (m.stages[0].labelsArray[i][0] for i in range(3))
    rows = [(1, "ZZ", origin, dest, 1, 9), (2, carrier, None, dest, 1, 9), (3, carrier, origin, dest, None, 9), (4, carrier, origin, dest, 1, 9)]
    df = spark.createDataFrame(rows, "id int, op_carrier string, origin string, dest string, week int, hour int")
    got = {r.id: r for r in model.score(m, df, ["id", "week"]).collect()}
    assert [got[i].valid for i in (1, 2, 3, 4)] == [False, False, False, True]
    assert all(got[i].prediction is None and got[i].p_cancel is None and got[i].proba is None for i in (1, 2, 3))
    assert got[4].prediction in (0, 1) and got[3].week is None and got[1].week == 1


def test_onehot_keeps_every_category(fitted):
    m, fl, _, _ = fitted
    width = model.onehot_width(m)
    n_cats = fl.select(F.countDistinct("op_carrier") + F.countDistinct("origin") + F.countDistinct("dest")).first()[0]
    assert width == n_cats
    enc = m.transform(fl.limit(5)).select(vector_to_array("raw_features").alias("a")).collect()
    assert all(sum(r.a[:width]) == 3.0 for r in enc)


def test_trees_score_dense_vectors_with_equal_results(fitted, monkeypatch):
    m, _, _, test = fitted
    plain = PipelineModel(stages=m.stages).transform(test)
    plain = plain.select("row_key", F.col("prediction").cast("int").alias("prediction"), model.p_cancel().alias("p_cancel"))
    seen, transform = [], GBTClassificationModel._transform
    monkeypatch.setattr(GBTClassificationModel, "_transform", lambda self, df: seen.append(df) or transform(self, df), raising=False)
    got = model.score(m, test, ["row_key"]).select("row_key", "prediction", "p_cancel")
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    (given,) = seen
    vectors = [r.features for r in given.select("features").collect()]
    assert vectors and all(isinstance(v, DenseVector) for v in vectors)


def test_equal_requests_are_scored_once_and_all_come_back(spark, fitted, monkeypatch):
    m, _, _, _ = fitted
    carriers, origins, dests = m.stages[0].labelsArray
    good, other = (f"{c},{origins[0]},{dests[0]},1,9" for c in carriers[:2])
    texts = [good] * 40 + [other] * 3 + [None] * 5 + ["", "", f"Nobody,{origins[0]},{dests[0]},1,9", f"{good},9"]
    df = spark.createDataFrame([*enumerate(texts), (7, good), (None, good), (None, None)], "rid int, feature string").repartition(4)
    path = model.save_model(m, scratch_path(spark, "model-once"))
    seen, transform = [], GBTClassificationModel._transform
    monkeypatch.setattr(GBTClassificationModel, "_transform", lambda self, df: seen.append(df) or transform(self, df), raising=False)
    scored = jobs.score_job(spark, path, df)
    got = scored.collect()
    (given,) = seen
    assert given.count() == 6  # different texts, null among them
    assert scored.columns == ["rid", "valid", "prediction", "p_cancel", "proba"]
    assert len(got) == len(texts) + 3 and sorted(str(r.rid) for r in got) == sorted(map(str, [*range(len(texts)), 7, None, None]))
    assert sorted(r.rid for r in got if r.valid and r.rid is not None) == sorted([*range(43), 7])
    assert sum(r.valid for r in got if r.rid is None) == 1
    parts = spark.createDataFrame([(1, carriers[0], origins[0], dests[0], 1, 9)], "id int, op_carrier string, origin string, dest string, week int, hour int")
    (one,) = model.score(m, parts, ["id"]).collect()
    assert {r[2:] for r in got if r.rid in range(40)} == {one[2:]}
    assert all(r.valid is False and r.prediction is None and r.p_cancel is None for r in got if r.rid is not None and r.rid >= 43)
