"""Grid search by k-fold cross-validation on exact AUC."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.evaluate import auc_from_counts, score_counts
from clickloom.operators.trees import fit_together, leaf_counts
from clickloom.schema import LABEL
from clickloom.sources.tables import fine_splits, stage

# The published parameter grids and number of folds.
GRIDS = {
    "decision_tree": {"maxDepth": [2, 4, 6, 8], "impurity": ["gini", "entropy"], "maxBins": [16, 32]},
    "decision_tree_sliced": {"maxDepth": [2, 4, 6, 8, 10], "impurity": ["gini", "entropy"], "maxBins": [16, 32]},
    "logistic": {
        "elasticNetParam": [0.0, 0.5, 1.0],
        "maxIter": [10, 50, 100],
        "regParam": [0.001, 0.002, 0.005, 0.01],
    },
    "gbt": {"maxDepth": [4, 6, 8, 10], "maxBins": [16, 32], "maxIter": [10]},
    "gbt_batch": {"maxDepth": [5, 10], "maxBins": [16, 32, 64], "maxIter": [50, 100]},
}
FOLDS = 3


def param_grid(estimator, grid: dict[str, list]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def grid_size(grid: dict[str, list]) -> int:
    return len(list(product(*grid.values())))


@dataclass
class Selection:
    """The best model, refitted on all rows; its grid point; and ``scores``: ``point, fold, auc`` of every fit, stored."""

    bestModel: Model
    points: list[dict]
    scores: DataFrame
    best: int


def _named(points: list[dict], grid: dict[str, list]) -> list[str]:
    return ["; ".join(f"{n}={point[p]}" for n in grid for p in point if p.name == n) for point in points]


@dataclass
class _Fit:
    """A fitted model and the grid points that it serves: by its own score (None), or by a score for each of its leaves."""

    model: Model
    points: dict[int, list[float] | None]


def _alike(points: list[dict], name: str) -> list[list[tuple[int, int]]]:
    """Points that differ in the integer parameter ``name`` only, as ``(value, point)``, the largest value first."""
    groups: dict[tuple, list[tuple[int, int]]] = {}
    for i, point in enumerate(points):
        values = {p.name: v for p, v in point.items()}
        groups.setdefault(tuple(sorted((n, v) for n, v in values.items() if n != name)), []).append((values[name], i))
    return [sorted(g, key=lambda x: (-x[0], x[1])) for g in groups.values()]


def _fit_logistic(estimator, points: list[dict], df: DataFrame) -> list[_Fit]:
    """One fit for points that differ in ``maxIter`` only, if it ends by itself before the smaller limits; else one more for these."""
    fits = []
    for group in _alike(points, "maxIter"):
        used = None
        for limit, i in group:
            if used is None or used > limit:
                model = estimator.copy(points[i]).fit(df)
                used = model.summary.totalIterations
                fits.append(_Fit(model, {}))
            fits[-1].points[i] = None
    return fits


def _tree_of(model: Model) -> list:
    """The model's tree as nested pairs, with the numbers of its leaves from left to right, which are those of ``leafCol``."""
    lines = [x for x in model.toDebugString.splitlines()[1:] if x.strip()]
    leaves = iter(range(len(lines)))

    def node(at: int) -> tuple[list | int, int]:
        if lines[at].strip().startswith("Predict"):
            return next(leaves), at + 1
        left, at = node(at + 1)
        right, at = node(at + 1)  # the line before it is the Else
        return [left, right], at

    return node(0)[0]


def _leaf_scores(tree, counts: dict[int, tuple[int, int]], depth: int) -> list[float]:
    """The score of each leaf if the tree had been grown to ``depth`` only: nodes there are leaves, and leaves that predict the same class
    are joined as Spark ML does. ``counts`` has a leaf's rows of label 0 and 1."""
    scores = [0.0] * len(counts)

    def cut(node, depth: int) -> tuple[list[int], int, int, bool]:
        """Leaves below, rows of label 0 and 1, and whether the node is a leaf now."""
        if isinstance(node, int):
            below, zeros, ones, leaf = [node], *counts[node], True
        else:
            (a, a0, a1, left), (b, b0, b1, right) = cut(node[0], depth - 1), cut(node[1], depth - 1)
            below, zeros, ones = a + b, a0 + b0, a1 + b1
            leaf = depth <= 0 or left and right and (a1 > a0) == (b1 > b0)
        if leaf:
            for i in below:
                scores[i] = ones / (zeros + ones)
        return below, zeros, ones, leaf

    cut(tree, depth)
    return scores


def _fit_trees(estimator, points: list[dict], df: DataFrame, label: str) -> list[_Fit]:
    """One fit, the deepest, for points that differ in ``maxDepth`` only: a tree's levels do not depend on those below. The deepest trees grow
    together. Where they cannot, Spark ML fits them, and one more pass counts the labels in their leaves."""
    groups = _alike(points, "maxDepth")
    deepest = [estimator.copy(points[group[0][1]]) for group in groups]
    grown = fit_together(deepest, df) or [(e.fit(df), None) for e in deepest]
    fits = []
    for group, (model, tree) in zip(groups, grown):
        if len(group) == 1 or model.numClasses != 2:
            fits += [_Fit(model, {group[0][1]: None}), *[_Fit(estimator.copy(points[i]).fit(df), {i: None}) for _, i in group[1:]]]
            continue
        if tree is None:
            leaves = model.copy().setLeafCol("_leaf").transform(df.select(model.getFeaturesCol(), label))
            found = leaves.groupBy(F.col("_leaf").cast("int").alias("leaf")).agg(F.count_if(F.col(label) == 0).alias("zeros"), F.count_if(F.col(label) == 1).alias("ones"))
            counts = {r["leaf"]: (r["zeros"], r["ones"]) for r in found.collect()}  # one row a leaf
        else:
            counts = leaf_counts(tree)
        fits.append(_Fit(model, {i: _leaf_scores(_tree_of(model), counts, depth) for depth, i in group}))
    return fits


def _fit_points(estimator, points: list[dict], df: DataFrame, label: str) -> list[_Fit]:
    """The models of all points. Where one fit holds the result of several points it serves them all; every point keeps its own score."""
    names = {p.name for p in points[0]} if points else set()
    if isinstance(estimator, LogisticRegression) and "maxIter" in names:
        return _fit_logistic(estimator, points, df)
    if isinstance(estimator, DecisionTreeClassifier):
        return _fit_trees(estimator, points, df, label)
    each = [estimator.copy(point) for point in points]
    grown = fit_together(each, df)
    models = [model for model, _ in grown] if grown else [e.fit(df) for e in each]
    return [_Fit(model, {i: None}) for i, model in enumerate(models)]


def _scores(fits: list[_Fit], df: DataFrame, label: str) -> DataFrame:
    """``point, score, label``: every point's score of every row, from one scan."""
    kept, each = df, []
    for i, fit in enumerate(fits):
        named = fit.model.copy()
        by_leaf = any(fit.points.values())
        for column in ("probabilityCol", "rawPredictionCol", "predictionCol", *(["leafCol"] if by_leaf else [])):
            if named.hasParam(column):
                named.set(named.getParam(column), f"_{column}_{i}")
        kept = named.transform(kept)
        by = "probabilityCol" if named.hasParam("probabilityCol") else "rawPredictionCol"
        own = vector_to_array(f"_{by}_{i}")[1]
        for point, table in fit.points.items():
            literal = F.from_json(F.lit(json.dumps(table)), "array<double>")
            score = own if table is None else F.get(literal, F.col(f"_leafCol_{i}").cast("int"))
            each.append(F.struct(F.lit(point).alias("point"), score.alias("score")))
    return kept.select(F.col(label).alias(label), F.inline(F.array(*each)))


def cross_validate(estimator, grid: dict[str, list], df: DataFrame, fold_col: str, folds: int = FOLDS, label: str = LABEL) -> Selection:
    """Exact AUC of every grid point on every fold, then the point with the best mean refitted on all rows (ties: the first point).

    Folds follow a column, such as a key hash, and do not depend on the partitioning. Each fit uses all cores, so fits run one after
    another; one fit serves several points where it holds their results (see ``_fit_points``). All points of a fold are scored in one scan of it, and their areas come from one table of counts for each score.
    """
    points = param_grid(estimator, grid)
    counts = []
    for k in range(folds):
        with fine_splits(df.sparkSession):
            seen = df.where(F.col(fold_col) != k)
            many = not isinstance(estimator, DecisionTreeClassifier | GBTClassifier)  # these keep their own form of the rows
            if many:
                seen = seen.select(estimator.getFeaturesCol(), estimator.getLabelCol()).persist()
            fits = _fit_points(estimator, points, seen, label)
            seen.unpersist()
        scored = _scores(fits, df.where(F.col(fold_col) == k), label)
        counts.append(stage(score_counts(scored, ["point"], F.col("score"), label).withColumn("fold", F.lit(k)), "fold-scores"))
    scores = stage(auc_from_counts(reduce(DataFrame.unionByName, counts), ["fold", "point"]).select("point", "fold", "auc"), "fold-areas")
    means = {r["point"]: r["auc"] for r in scores.groupBy("point").agg(F.avg("auc").alias("auc")).collect()}
    best = max(range(len(points)), key=lambda i: (means.get(i) or 0.0, -i))
    with fine_splits(df.sparkSession):
        model = _fit_points(estimator, [points[best]], df, label)[0].model
    return Selection(model, points, scores, best)


def best_params(found: Selection, grid: dict[str, list]) -> dict:
    return {p.name: v for p, v in found.points[found.best].items() if p.name in grid}


def cv_results(found: Selection, grid: dict[str, list]) -> DataFrame:
    """One row per grid point: its parameters as text, the mean exact AUC and its deviation over folds, its rank, and whether it is best."""
    names = found.scores.sparkSession.createDataFrame(list(enumerate(_named(found.points, grid))), "point int, params string")
    means = found.scores.groupBy("point").agg(F.avg("auc").alias("auc"), F.stddev_samp("auc").alias("auc_stddev"))
    # One row per grid point.
    rank = F.row_number().over(Window.orderBy(F.desc_nulls_last("auc"), "point"))
    return names.join(means, "point").select("params", "auc", "auc_stddev", rank.alias("rank"), (F.col("point") == found.best).alias("best"))
