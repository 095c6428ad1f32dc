"""Fraud model: training, evaluation, batch scoring with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.hashing import hash_share


def split_rows(df: DataFrame, train: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Random split into training and test rows."""
    parts = df.randomSplit([train, 1.0 - train], seed)
    return parts[0], parts[1]


def split_by_key(df: DataFrame, keys: Sequence[str], train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """A split by a hash of the key: a row is on the same side at every run, whatever the order and partitions of the rows."""
    share = hash_share(keys)
    return df.filter(share < train), df.filter(share >= train)


#: Rows that one task of a training holds: the trees keep some hundred bytes a row in memory, re-read at every level.
TASK_ROWS = 250_000


def dealt(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``df`` in so many partitions that each has about ``rows`` rows, however large the files' splits are."""
    parts = math.ceil(df.count() / rows)
    return df.repartition(parts) if parts > 1 else df


def train_fraud_model(df: DataFrame, features: Sequence[str], label: str, trees: int = 100, depth: int = 10, seed: int = 42) -> PipelineModel:
    """A forest over all rows; only the columns it needs are dealt out and kept."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    forest = RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, seed=seed, subsamplingRate=1.0
    )
    return Pipeline(stages=[assembler, forest]).fit(dealt(df.select(*features, label)))


def area_under_roc(scored: DataFrame, label: str) -> float:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(scored)


def score_rows(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Predicted class and fraud probability of every row."""
    scored = model.transform(df)
    return scored.select(*keep, F.col("prediction").cast("int").alias("fraud_prediction"), vector_to_array("probability")[1].alias("fraud_probability"))
