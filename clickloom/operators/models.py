"""Training and scoring with Spark ML. Settings default to the published runs."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame

from clickloom.operators.encoding import SELECTED
from clickloom.operators.trees import fit_together
from clickloom.schema import LABEL
from clickloom.sources.tables import fine_splits

# Settings of the published models.
MODEL_SEED = 8888
BASIC_LOGISTIC = {"maxIter": 10, "regParam": 0.0, "elasticNetParam": 0.0}
FULL_LOGISTIC = {"maxIter": 100, "regParam": 0.001, "elasticNetParam": 0.5}
DECISION_TREE = {"maxDepth": 5, "seed": MODEL_SEED}
SAMPLE_GBT = {"maxIter": 20, "seed": MODEL_SEED}
FULL_GBT = {"maxIter": 50, "seed": MODEL_SEED}
RANDOM_FOREST = {"numTrees": 10, "seed": MODEL_SEED}
LINEAR_SVC = {"maxIter": 10, "regParam": 0.1}

CLASSIFIERS = {
    "logistic": (LogisticRegression, BASIC_LOGISTIC),
    "decision_tree": (DecisionTreeClassifier, DECISION_TREE),
    "gbt": (GBTClassifier, SAMPLE_GBT),
    "random_forest": (RandomForestClassifier, RANDOM_FOREST),
    "linear_svc": (LinearSVC, LINEAR_SVC),
}


def classifier(kind: str, features: str = SELECTED, label: str = LABEL, **settings):
    """An unfitted estimator: 'logistic', 'decision_tree', 'gbt', 'random_forest' or 'linear_svc'."""
    estimator, defaults = CLASSIFIERS[kind]
    return estimator(featuresCol=features, labelCol=label, **{**defaults, **settings})


def train(kind: str, df: DataFrame, features: str = SELECTED, label: str = LABEL, **settings) -> Model:
    """Fit on ``df``. Spark ML caches its own form of the rows for the passes of the fit, in parts of bounded size. Boosted trees grow over
    binned rows, which are far smaller."""
    estimator = classifier(kind, features, label, **settings)
    with fine_splits(df.sparkSession):
        grown = fit_together([estimator], df) if kind == "gbt" else None
        return grown[0][0] if grown else estimator.fit(df)


def score_batch(model: Model, df: DataFrame) -> DataFrame:
    """Adds ``rawPrediction``, ``probability`` (where the model has one) and ``prediction``; no shuffle."""
    return model.transform(df)
