"""Boosted-tree cancellation classifier as a ``pyspark.ml`` pipeline.

Stages: ``StringIndexer`` (alphabetical; scoring marks unseen categories) ->
``OneHotEncoder(dropLast=False)`` (keeps every category) ->
``VectorAssembler`` (one-hot blocks, then WEEK and HOUR passed through) ->
``StandardScaler(withMean=False)`` -> ``GBTClassifier``.

The encoding stages are fitted on the whole sample (every category gets a
slot, as the category dictionary is built before the split); the scaler
and the trees are fitted on the training rows only.  Training and scoring
are distributed Spark jobs: tree statistics are aggregated across
partitions, scoring is a per-row ``transform`` (no per-row service call).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundstop.schemas import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES

_IDX = [f"{c}_idx" for c in CATEGORICAL_FEATURES]
_OH = [f"{c}_oh" for c in CATEGORICAL_FEATURES]


def encoder_pipeline(handle_invalid: str = "error") -> Pipeline:
    return Pipeline(
        stages=[
            StringIndexer(
                inputCols=list(CATEGORICAL_FEATURES), outputCols=_IDX,
                stringOrderType="alphabetAsc", handleInvalid=handle_invalid,
            ),
            OneHotEncoder(inputCols=_IDX, outputCols=_OH, dropLast=False, handleInvalid="error"),
            VectorAssembler(inputCols=_OH + list(NUMERIC_FEATURES), outputCol="raw_features"),
        ]
    )


def fit_encoder(sample: DataFrame, handle_invalid: str = "error") -> PipelineModel:
    """Category dictionaries from every row of ``sample`` (a small driver-side list per column)."""
    return encoder_pipeline(handle_invalid).fit(sample)


def onehot_width(encoder: PipelineModel) -> int:
    """Number of one-hot slots (sum of the category counts)."""
    return sum(len(labels) for labels in encoder.stages[0].labelsArray)


def fit_model(
    sample: DataFrame,
    train: DataFrame,
    *,
    max_iter: int = 100,
    max_depth: int = 6,
    step_size: float = 0.3,
    max_bins: int = 64,
    seed: int = 42,
) -> PipelineModel:
    """Encoder on ``sample``; scaler + GBT on ``train``; one ``PipelineModel``.

    The defaults are those of the usual boosted-tree classifier: 100 rounds
    of trees of depth 6, and bins enough for every ISO week.
    """
    encoder = fit_encoder(sample)
    encoded = encoder.transform(train).withColumn("label", F.col(LABEL).cast("double"))
    head = Pipeline(
        stages=[
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=False, withStd=True),
            GBTClassifier(
                featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                stepSize=step_size, maxBins=max_bins, seed=seed,
            ),
        ]
    ).fit(encoded)
    return PipelineModel(stages=list(encoder.stages) + list(head.stages))


def p_cancel(probability: str = "probability") -> Column:
    """Probability of class 1 from the probability vector."""
    return vector_to_array(F.col(probability)).getItem(1)


def score(model: PipelineModel, requests: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns + ``valid``, ``prediction`` (int), ``p_cancel`` and ``proba`` text.

    ``proba`` is the winning class's probability rounded to 2 places, as the
    scoring response reports it; ``p_cancel`` is class 1's and is what a
    threshold should be applied to.  A row with a category that the model
    has not seen, or with a null feature, comes back with ``valid = false``
    and null results; it fails no other row.
    """
    keep = keep or []
    indexer, *rest = model.stages
    indexer = indexer.copy()
    indexer.setHandleInvalid("keep")  # unseen and null become one index past the last
    indexed = indexer.transform(requests)
    known = F.lit(True)
    for c, labels in zip(_IDX, indexer.labelsArray, strict=True):
        known = known & (F.col(c) < len(labels))
    for c in NUMERIC_FEATURES:
        known = known & F.col(c).isNotNull()
    indexed = indexed.withColumn("_known", known)
    stand_in = {c: F.when(F.col("_known"), F.col(c)).otherwise(F.lit(0.0)) for c in _IDX}
    stand_in |= {c: F.when(F.col("_known"), F.col(c)).otherwise(F.lit(0)) for c in NUMERIC_FEATURES}
    plain = [c for c in keep if c not in NUMERIC_FEATURES]
    kept = {f"_keep_{c}": F.col(c) for c in keep if c in NUMERIC_FEATURES}
    *prepare, trees = rest
    ready = PipelineModel(stages=prepare).transform(indexed.withColumns(kept).withColumns(stand_in))
    # A node looks its feature up by place in a dense vector and searches a sparse one; a row meets hundreds of nodes.
    at = trees.getFeaturesCol()
    scored = trees.transform(ready.withColumn(at, array_to_vector(vector_to_array(at))))
    prob = vector_to_array(F.col("probability"))
    result = {
        "prediction": F.col("prediction").cast("int"),
        "p_cancel": prob.getItem(1),
        "proba": F.round(F.greatest(prob.getItem(0), prob.getItem(1)), 2).cast("string"),
    }
    return scored.select(
        *[F.col(c) if c in plain else F.col(f"_keep_{c}").alias(c) for c in keep],
        F.col("_known").alias("valid"),
        *[F.when(F.col("_known"), v).alias(name) for name, v in result.items()],
    )


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
