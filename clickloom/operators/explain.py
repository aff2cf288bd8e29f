"""Importances, coefficients and training history of fitted models, as small tables."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.tables import fine_splits

TOP_FEATURES = 12  # fixed value: length of the published importance list


def feature_importance(spark: SparkSession, model: Model, names: list[str]) -> DataFrame:
    values = model.featureImportances.toArray()
    rows = [(i, name, float(v)) for i, (name, v) in enumerate(zip(names, values, strict=True))]
    return spark.createDataFrame(rows, "slot int, name string, importance double")


def top_features(importance: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "slot").limit(n)


def used_slots(model: Model) -> list[int]:
    """Vector slots with an importance above zero, in order."""
    return [i for i, v in enumerate(model.featureImportances.toArray()) if v > 0]


def split_slots(model: Model, rows: DataFrame) -> list[int]:
    """:func:`used_slots` of a tree with Gini impurity, fitted on ``rows``; of one that pruning cut to its root, the slots it split before.

    Spark ML joins leaves that predict the same class, so where no leaf reaches half a tree's splits are all gone. A regression tree of
    the labels 0 and 1 has the same splits, as their variance is half the Gini impurity, and keeps them. All slots if no split tells labels apart.
    """
    used = used_slots(model)
    if not used:
        shared = {n: model.getOrDefault(n) for n in ("featuresCol", "labelCol", "maxDepth", "maxBins", "minInfoGain", "minInstancesPerNode", "seed")}
        with fine_splits(rows.sparkSession):
            used = used_slots(DecisionTreeRegressor(**shared).fit(rows))
    return used or list(range(model.numFeatures))


def coefficients(spark: SparkSession, model: Model, names: list[str]) -> DataFrame:
    """Intercept (slot -1) and coefficients of a linear model in feature order."""
    rows = [(-1, "(intercept)", float(model.intercept))]
    rows += [(i, n, float(b)) for i, (n, b) in enumerate(zip(names, model.coefficients.toArray(), strict=True))]
    return spark.createDataFrame(rows, "slot int, name string, beta double")


def training_history(spark: SparkSession, model: Model) -> DataFrame:
    rows = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "iteration int, objective double")
