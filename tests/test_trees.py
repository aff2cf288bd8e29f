"""Trees and boosted trees grown together, next to Spark ML's own fits."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickloom.operators import encoding, models, trees, tuning
from clickloom.sources.tables import stage


@pytest.fixture(scope="module")
def rows(spark):
    """Four columns of 50 values and one of three; the label follows some of them. More rows than candidate splits are taken from."""
    df = spark.range(0, 14_000, 1, 3).select("id", *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)) / 50).alias(f"x{k}") for k in range(4)])
    df = df.withColumns({"x4": F.pmod(F.col("id"), F.lit(3)).cast("double"), "label": (F.col("x0") * F.col("x1") + 0.4 * F.col("x2") + F.rand(3) * 0.5 > 0.75).cast("int")})
    return stage(encoding.assembler(["x0", "x1", "x2", "x3", "x4"], encoding.SELECTED).transform(df), "tree-rows")


def text(model) -> list[str]:
    """The model's nodes, numbers to eight digits."""
    return [re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m.group()):.8g}", line) for line in model.toDebugString.splitlines()[1:]]


@pytest.mark.parametrize("settings", [{"maxDepth": 4}, {"maxDepth": 8, "impurity": "entropy", "maxBins": 16}, {"maxDepth": 6, "maxBins": 7}])
def test_a_tree_is_spark_mls(rows, settings):
    estimator = models.classifier("decision_tree", **settings)
    own, theirs = trees.fit_together([estimator], rows)[0][0], estimator.fit(rows)
    assert text(own) == text(theirs) and own.numNodes > 9
    assert own.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray())
    for name in ("maxDepth", "maxBins", "impurity", "featuresCol", "seed"):
        assert own.getOrDefault(name) == theirs.getOrDefault(name)
    both = own.transform(rows).select("id", "probability", "prediction").exceptAll(theirs.transform(rows).select("id", "probability", "prediction"))
    assert both.count() == 0


def test_boosted_trees_are_spark_mls(rows):
    """Past the round at which margins are made again, too."""
    estimator = models.classifier("gbt", maxIter=trees.REBASE + 2, maxDepth=3)
    own, theirs = models.train("gbt", rows, maxIter=trees.REBASE + 2, maxDepth=3), estimator.fit(rows)
    assert text(own) == text(theirs) and own.treeWeights == theirs.treeWeights
    assert own.numFeatures == theirs.numFeatures and own.getNumTrees == trees.REBASE + 2


def test_small_blocks_add_up(rows, monkeypatch):
    estimator = models.classifier("decision_tree", maxDepth=5)
    whole = text(trees.fit_together([estimator], rows)[0][0])
    monkeypatch.setattr(trees, "BLOCK_ROWS", 500)
    monkeypatch.setattr(trees, "CHUNK_NODES", 2)
    assert text(trees.fit_together([estimator], rows.repartition(5))[0][0])[:1] == whole[:1]
    assert text(trees.fit_together([estimator], rows)[0][0]) == whole


def test_ties_of_opposite_slots_stay_spark_mls(spark, monkeypatch):
    """A slot and its opposite split alike, and the last digit of a sum decides: few such rows are left to Spark ML, many are not."""
    rng = np.random.default_rng(7)
    a, b, x = rng.integers(0, 2, 3000), rng.integers(0, 3, 3000), rng.normal(size=3000).round(1)
    y = rng.random(3000) < 0.2 + 0.2 * a + 0.1 * b + 0.05 * x
    data = [(Vectors.sparse(9, [int(p), 2 + int(q), 8], [1.5, 2.5, float(v)]), int(t)) for p, q, v, t in zip(a, b, x, y)]
    df = stage(spark.createDataFrame(data, [encoding.SELECTED, "label"]).coalesce(1), "opposite-slots")
    estimator = models.classifier("gbt", maxIter=3)
    monkeypatch.setattr(trees, "DENSE_SHARE", 0.6)
    assert trees.fit_together([estimator], df) is None
    assert text(models.train("gbt", df, maxIter=3)) == text(estimator.fit(df))
    monkeypatch.setattr(trees, "DENSE_BINS", 0)
    assert len(trees.fit_together([estimator], df)[0][0].trees) == 3


def test_sparse_vectors_with_rare_slots(spark, monkeypatch):
    monkeypatch.setattr(trees, "DENSE_BINS", 0)
    rng = np.random.default_rng(5)
    data = []
    for i in range(3000):
        a, b = int(rng.integers(0, 12)), 12 + int(rng.integers(0, 7))
        vector = Vectors.sparse(20, [a, b, 19], [2.0 + a, 0.5, float(rng.normal())])
        data.append((i, vector if i % 4 else Vectors.dense(vector.toArray()), int(rng.random() < 0.2 + 0.05 * a)))
    df = stage(spark.createDataFrame(data, ["id", "f", "label"]), "sparse-rows")
    estimator = DecisionTreeClassifier(featuresCol="f", maxDepth=6, seed=3)
    own, theirs = trees.fit_together([estimator], df)[0][0], estimator.fit(df)
    assert text(own) == text(theirs) and own.numNodes > 9
    estimator = GBTClassifier(featuresCol="f", maxDepth=3, maxIter=4, seed=3)
    scores = [{r["id"]: r["probability"][1] for r in m.transform(df).collect()} for m in (trees.fit_together([estimator], df)[0][0], estimator.fit(df))]
    assert scores[0] == pytest.approx(scores[1])


def test_points_grow_together(spark, rows):
    """A level of all points is one job, so deeper grids and more points do not multiply the jobs."""
    grid = {"maxDepth": [2, 5], "maxBins": [16], "maxIter": [2, 4]}
    estimator = models.classifier("gbt")
    points = tuning.param_grid(estimator, grid)
    spark.sparkContext.setJobGroup("grid", "")
    try:
        fits = tuning._fit_points(estimator, points, rows, "label")
        assert len(fits) == 4
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("grid"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 80  # some 10 for each model that is stored and loaded, and 20 levels
    for fit in fits:
        (i,) = fit.points
        assert text(fit.model) == text(estimator.copy(points[i]).fit(rows))


def test_what_is_not_grown_here(spark, rows):
    assert not trees.fits_here(models.classifier("gbt", subsamplingRate=0.5)) and not trees.fits_here(models.classifier("decision_tree", minInstancesPerNode=5))
    assert not trees.fits_here(models.classifier("random_forest")) and trees.fits_here(models.classifier("gbt"))
    one = rows.withColumn("label", F.lit(1))
    assert trees.fit_together([models.classifier("gbt")], one) is None
    wrong = spark.createDataFrame([(Vectors.dense([float("nan")]), 1), (Vectors.dense([1.0]), 0)], [encoding.SELECTED, "label"])
    with pytest.raises(Exception, match="NaN"):
        models.train("gbt", wrong)
