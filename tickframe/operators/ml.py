"""Model training and artifacts with Spark ML.

The reference trains gradient-boosted trees (another library, not available
here); this is Spark ML's GBTClassifier with the same hyper-parameters mapped
where a counterpart exists.  Results are not value-equal to the reference.
"""

from __future__ import annotations

import json
import math

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession

from tickframe.schemas import MODEL_FEATURES, MODEL_THRESHOLD

# fixed values: the reference's tuned hyper-parameters, mapped to Spark ML names
REFERENCE_GBT = {
    "maxIter": 650,                      # n_estimators
    "maxDepth": 3,                       # max_depth
    "stepSize": 0.01178,                 # learning_rate
    "subsamplingRate": 0.8083,           # subsample
    "featureSubsetStrategy": "0.5104",   # colsample_bytree (per node here, per tree there)
    "minInstancesPerNode": 6,            # ~ min_child_weight
    "seed": 42,                          # random_state
}                                        # gamma has no counterpart (minInfoGain has another scale)


ROWS_PER_TASK = 20_000   # training rows of a task; each boosting round runs a few jobs over all tasks


def train_gbt(train: DataFrame, features: list[str] = MODEL_FEATURES, label: str = "target",
              **overrides) -> PipelineModel:
    """The tasks of a round follow from the number of training rows, not from the partitions they come in: a small
    table in many partitions would spend its rounds on starting tasks."""
    params = {**REFERENCE_GBT, **overrides}
    asm = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, **params)
    rows = train.select(*features, label).dropna().persist()
    tasks = max(1, math.ceil(rows.count() / ROWS_PER_TASK))
    model = Pipeline(stages=[asm, gbt]).fit(rows.repartition(tasks))
    rows.unpersist()
    return model


def save_artifacts(spark: SparkSession, model: PipelineModel, path: str,
                   features: list[str] = MODEL_FEATURES, threshold: float = MODEL_THRESHOLD) -> None:
    model.write().overwrite().save(f"{path}/model")
    meta = spark.createDataFrame([(json.dumps(features), float(threshold))], "columns string, threshold double")
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_artifacts(spark: SparkSession, path: str):
    """(model, feature columns, threshold); any missing part raises."""
    model = PipelineModel.load(f"{path}/model")
    row = spark.read.schema("columns string, threshold double").json(f"{path}/meta").first()
    if row is None or row["columns"] is None or row["threshold"] is None:
        raise FileNotFoundError(f"incomplete model metadata under {path}")
    return model, json.loads(row["columns"]), row["threshold"]
