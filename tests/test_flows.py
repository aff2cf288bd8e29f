"""The flows on the smallest tables: invariants of features, models, tuning and explanation."""

import subprocess
import sys
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickloom.operators import descent, encoding, evaluate, explain, models, sampling, tuning
from clickloom.operators.vectors import entries, vector_parts
from clickloom.plans import flows
from clickloom.sources.tables import stage
from clickloom.sources.training_view import CATEGORICAL, KEY, NUMERIC, training_view

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def view(spark):
    return stage(training_view(spark, SF_DIR), "view")


@pytest.fixture(scope="module")
def onehot(view):
    return flows.prepare_onehot(view)


@pytest.fixture(scope="module")
def means(view):
    return flows.prepare_means(view)


def moments(df):
    slots = df.select(F.posexplode(vector_to_array("selected_features")).alias("slot", "x"))
    return slots.groupBy("slot").agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).collect()


def test_vector_length_is_categories_plus_numerics(onehot):
    kept = sum(len(v) for v in onehot.folding.kept.values())
    assert set(onehot.folding.kept) == set(CATEGORICAL)
    assert kept + len(NUMERIC) <= onehot.features.size <= kept + len(CATEGORICAL) + len(NUMERIC)
    assert onehot.features.names[-len(NUMERIC) :] == NUMERIC
    sizes = onehot.rows.select(F.size(vector_to_array("selected_features")).alias("n")).distinct().collect()
    assert [r["n"] for r in sizes] == [onehot.features.size]


def test_training_part_is_standardised(view, means):
    for prepared in (flows.prepare_onehot(view, with_mean=True), means):
        for r in moments(prepared.train):
            assert r["m"] == pytest.approx(0.0, abs=1e-9)
            assert r["s"] == pytest.approx(1.0, abs=1e-9) or r["s"] == 0.0


def test_stored_features_are_pruned_by_part(onehot):
    assert onehot.train.count() + onehot.test.count() == onehot.rows.count()
    plan = onehot.train._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(data" in plan


def test_fitting_on_all_rows_and_dropping_the_last_category(view, onehot):
    full = flows.prepare_onehot(view, fit_on="all")
    short = flows.prepare_onehot(view, fit_on="all", drop_last=True)
    assert full.features.size - short.features.size == len(CATEGORICAL)
    assert full.rows.count() == onehot.rows.count()


@pytest.mark.parametrize("kind", ["logistic", "decision_tree", "random_forest"])
def test_models_rank_better_than_chance(means, kind):
    model, report = flows.train_and_report(kind, means, kind)
    rows = {r["Data"]: r for r in report.collect()}
    assert set(rows) == {"Train", "Test"} and rows["Test"]["ROC"] > 0.55
    # A leaf of a few rows can be sure and wrong, so a single tree's loss has no upper bound on 6,000 rows.
    assert 0.3 < rows["Test"]["LogLoss"] < (5.0 if kind == "decision_tree" else 0.69)


def test_centring_does_not_change_the_fitted_model(view, onehot):
    centred = flows.prepare_onehot(view, with_mean=True)
    reports = [
        flows.train_and_report("logistic", p, "LR", **models.FULL_LOGISTIC)[1].orderBy("Data").collect()
        for p in (onehot, centred)
    ]
    for a, b in zip(*reports):
        assert tuple(a)[2:] == pytest.approx(tuple(b)[2:], abs=2e-3)


def test_gbt_fits_and_reports(means):
    _, report = flows.train_and_report("gbt", means, "GBT", maxIter=3)
    assert report.count() == 2


def test_svm_reports_ranking_only(means):
    _, report = flows.train_and_report("linear_svc", means, "SVM")
    for r in report.collect():
        assert 0.0 < r["ROC"] < 1.0 and r["LogLoss"] is None


def test_published_settings():
    lr = models.classifier("logistic", **models.FULL_LOGISTIC)
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam()) == (100, 0.001, 0.5)
    assert models.classifier("gbt").getMaxIter() == 20 and models.FULL_GBT["maxIter"] == 50
    assert models.classifier("random_forest").getNumTrees() == 10
    sizes = {name: tuning.grid_size(grid) for name, grid in tuning.GRIDS.items()}
    assert sizes == {"decision_tree": 16, "decision_tree_sliced": 20, "logistic": 36, "gbt": 8, "gbt_batch": 12}


def test_slicing_keeps_the_used_slots(spark, onehot):
    tree = models.train("decision_tree", onehot.train)
    table = explain.feature_importance(spark, tree, onehot.features.names)
    used = explain.used_slots(tree)
    assert table.where("importance > 0").count() == len(used)
    top = explain.top_features(table).collect()
    assert len(top) == 12 and top[0]["importance"] == max(r["importance"] for r in top)
    narrow = flows.sliced(onehot, used)
    sizes = narrow.rows.select(F.size(vector_to_array("selected_features")).alias("n")).distinct().collect()
    assert [r["n"] for r in sizes] == [len(used)] and narrow.features.size == len(used)
    _, report = flows.train_and_report("decision_tree", narrow, "DT+S")
    assert report.count() == 2


def test_slots_of_a_tree_that_pruning_cut_to_its_root(spark):
    rows = [(float(i % 2), float(i % 3), int(i % 10 < (4 if i % 2 else 1))) for i in range(600)]
    df = encoding.assembler(["x", "z"], "selected_features").transform(spark.createDataFrame(rows, "x double, z double, label int"))
    tree = models.train("decision_tree", df, maxDepth=1)
    assert explain.used_slots(tree) == []
    assert explain.split_slots(tree, df) == [0]
    same = df.withColumn("label", F.lit(0))
    assert explain.split_slots(models.train("decision_tree", same), same) == [0, 1]


def test_coefficients_and_history(spark, onehot):
    model = models.train("logistic", onehot.train)
    table = explain.coefficients(spark, model, onehot.features.names).orderBy("slot").collect()
    assert [r["name"] for r in table] == ["(intercept)", *onehot.features.names]
    history = [r["objective"] for r in explain.training_history(spark, model).orderBy("iteration").collect()]
    assert history[-1] < history[0]


def test_threshold_on_a_fitted_model_changes_its_predictions(means):
    model = models.train("logistic", means.train)
    before = model.transform(means.test).agg(F.sum("prediction")).first()[0]
    model.setThreshold(0.2)
    assert model.transform(means.test).agg(F.sum("prediction")).first()[0] > before


def test_cross_validation_by_key_hash(means):
    rows = sampling.assign_fold(means.train, KEY)
    grid = {"maxDepth": [1, 3], "maxBins": [16]}
    found = tuning.cross_validate(models.classifier("decision_tree"), grid, rows, fold_col="fold")
    best = tuning.best_params(found, grid)
    table = tuning.cv_results(found, grid).collect()
    assert len(table) == 2 and {r["rank"] for r in table} == {1, 2} and [r["best"] for r in sorted(table, key=lambda r: r["rank"])] == [True, False]
    first = next(r for r in table if r["rank"] == 1)
    assert first["params"] == f"maxDepth={best['maxDepth']}; maxBins={best['maxBins']}"
    # Each area is that of a model fitted on the other folds, by the exact operator.
    for k in range(3):
        model = models.train("decision_tree", rows.where(F.col("fold") != k), maxDepth=best["maxDepth"], maxBins=16)
        exact = evaluate.auc_roc(model.transform(rows.where(F.col("fold") == k))).first()["auc"]
        assert found.scores.where((F.col("fold") == k) & (F.col("point") == found.best)).first()["auc"] == pytest.approx(exact, abs=1e-12)


def test_feature_pipeline_survives_save_and_load(spark, means, tmp_path):
    from pyspark.ml import PipelineModel

    path = str(tmp_path / "model")
    means.features.model.save(path)
    columns = means.features.names
    row = spark.createDataFrame([tuple(0.5 for _ in columns)], ", ".join(f"{c} double" for c in columns))
    want = means.features.model.transform(row).first()["selected_features"]
    assert PipelineModel.load(path).transform(row).first()["selected_features"] == want


def test_selection_of_a_model_without_probabilities(means):
    rows = sampling.assign_fold(means.train, KEY)
    found = tuning.cross_validate(models.classifier("linear_svc"), {"regParam": [0.1, 1.0]}, rows, fold_col="fold")
    assert found.scores.count() == 6 and found.scores.where("auc between 0.5 and 1").count() == 6


def test_batch_grid_is_the_published_one():
    assert tuning.grid_size(tuning.GRIDS["gbt_batch"]) == 12


FRESH = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.ml.functions import vector_to_array
from tests.conftest import make_session
from clickloom.plans import flows
from clickloom.sources.training_view import training_view
spark = make_session()
chain = flows.ScoringChain.load(spark, {path!r})
rows = chain.score(training_view(spark, {sf!r}), ["rk"])
rows.select("rk", vector_to_array("probability")[1].alias("p"), "prediction").write.parquet({out!r})
"""


def test_chain_scores_raw_rows_in_another_session(spark, view, tmp_path):
    """The process that scores has neither the training rows nor the model object, only the folder."""
    prepared = flows.prepare_selected(view, top=5)
    assert prepared.features.size == 5
    model = models.train("logistic", prepared.train)
    slots = [i for i, n in enumerate(flows.prepare_onehot(view).features.names) if n in prepared.features.names]
    path, out = f"{tmp_path}/chain", f"{tmp_path}/scores"
    flows.ScoringChain(prepared, model, slots=slots).save(path)
    repo = str(Path(__file__).resolve().parent.parent)
    code = FRESH.format(repo=repo, path=path, sf=SF_DIR, out=out)
    subprocess.run([sys.executable, "-c", code], check=True, cwd=repo, timeout=300)
    here = model.transform(prepared.rows).select("rk", vector_to_array("probability")[1].alias("q"), F.col("prediction").alias("c"))
    both = spark.read.parquet(out).join(here, "rk")
    assert both.count() == view.count() and both.where("abs(p - q) > 1e-12 or prediction <> c").count() == 0


def test_scoring_a_chain_does_not_shuffle(spark, view, means):
    chain = flows.ScoringChain(means, models.train("logistic", means.train))
    plan = chain.score(view, ["rk"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "")


def test_descent_on_vectors_is_descent_on_columns(view):
    rows = view.select("label", F.log1p("c01").alias("x"), (F.col("b03") == "O").cast("double").alias("y"))
    vectors = encoding.assembler(["x", "y"]).transform(rows)
    plain, vector = descent.descend(rows, ["x", "y"], steps=4)[1], descent.descend_vectors(vectors, "features", 2, steps=4)[1]
    for a, b in zip(plain, vector):
        assert a == pytest.approx(b, rel=1e-9, abs=1e-12)


def test_gradient_of_mixed_vectors_is_one_pass_in_numpy(spark):
    vectors = [Vectors.sparse(3, [0, 2], [1.0, -2.0]), Vectors.dense([0.5, 0.0, 3.0]), Vectors.sparse(3, [], []), Vectors.sparse(3, [1], [4.0])]
    y, weights = np.array([1, 0, 1, 0]), np.array([0.1, -0.4, 0.3, 0.2])
    df = spark.createDataFrame([(v, int(t)) for v, t in zip(vectors, y)], ["v", "label"]).repartition(3)
    x = np.array([v.toArray() for v in vectors])
    p = 1 / (1 + np.exp(-(weights[0] + x @ weights[1:])))
    loss, slopes = descent.vector_gradient(df, weights.tolist(), "v")
    assert loss == pytest.approx(-np.log(np.where(y == 1, p, 1 - p)).mean())
    assert slopes == pytest.approx([2 * (p - y).mean(), *(2 * ((p - y) @ x) / 4)])


def test_dense_vectors_go_to_numpy_without_null_lists(spark):
    """Spark's Arrow writer takes the longer for a NULL list the more rows its batch has."""
    found = [Vectors.dense([0.5, 0.0, 3.0]), Vectors.sparse(3, [0, 2], [1.0, -2.0]), Vectors.sparse(3, [], []), Vectors.dense([1.0, 2.0, 4.0])]
    rows = spark.createDataFrame([(v,) for v in found], ["v"]).coalesce(1).select(*vector_parts("v")).collect()
    assert [r["i"] for r in rows] == [[], [0, 2], [], []]
    row, at, x = entries(pa.array([r["i"] for r in rows], pa.list_(pa.int32())), pa.array([r["x"] for r in rows], pa.list_(pa.float64())))
    whole = np.zeros((4, 3))
    whole[row, at] = x
    assert whole.tolist() == [v.toArray().tolist() for v in found]


def test_steps_on_vectors_do_not_go_through_the_summarizer(monkeypatch, spark):
    """Its sums cost several times as much a row; a step must not ask for them."""
    df = encoding.assembler(["x"]).transform(spark.createDataFrame([(1.0, 1), (2.0, 0)], "x double, label int"))
    monkeypatch.setattr(descent, "Summarizer", None)
    assert len(descent.descend_vectors(df, "features", 1, steps=2)[1]) == 3


def test_centred_descent_is_descent_on_centred_vectors(view):
    rows = view.select("label", F.log1p("c02").alias("x"))
    mean = rows.agg(F.avg("x")).first()[0]
    there = descent.descend(rows.withColumn("x", F.col("x") - mean), ["x"], steps=3)
    weights, trace = descent.descend_vectors(encoding.assembler(["x"]).transform(rows), "features", 1, steps=3, centre=True)
    assert [t[1] for t in trace] == pytest.approx([t[1] for t in there[1]], rel=1e-9)
    assert weights == pytest.approx([there[0][0] - there[0][1] * mean, there[0][1]], rel=1e-8)


def test_descent_on_onehot_vectors_falls_and_nears_logistic(onehot):
    weights, trace = descent.descend_vectors(onehot.train, "selected_features", onehot.features.size, steps=30, centre=True)
    losses = [t[1] for t in trace]
    assert len(weights) == onehot.features.size + 1 and all(b < a for a, b in zip(losses, losses[1:]))
    model = models.train("logistic", onehot.train, maxIter=100)
    assert losses[-1] >= model.summary.objectiveHistory[-1] - 1e-9
    corr = descent.vector_score(onehot.train, weights, "selected_features").withColumnRenamed("probability", "own").drop("prediction")
    assert model.transform(corr).select("own", vector_to_array("probability")[1].alias("p")).corr("own", "p") > 0.9


def test_whole_flows(view):
    for flow, name in ((flows.onehot_logistic, "LR"), (flows.mean_logistic, "LR+BM")):
        _, report = flow(view)
        assert {(r["Name"], r["Data"]) for r in report.collect()} == {(name, "Train"), (name, "Test")}


@pytest.mark.parametrize("kind", ["means", "onehot"])
def test_stored_preparation_gives_the_same_features(spark, kind, request):
    prepared = request.getfixturevalue(kind)
    path = tempfile.mkdtemp(prefix="clickloom-test-") + "/prepared"
    prepared.save(path)
    loaded = flows.Prepared.load(spark, path)
    rows = training_view(spark, "/root/testdata/sf0.001")
    again = loaded.apply(rows, ["rk"]).withColumnRenamed("selected_features", "f")
    differ = prepared.rows.join(again, "rk").where(F.col("f") != F.col("selected_features"))
    assert loaded.features.names == prepared.features.names and again.count() == rows.count() and differ.count() == 0


@pytest.mark.parametrize("kind, grid", [("decision_tree", {"maxDepth": [1, 3, 7], "impurity": ["gini", "entropy"], "maxBins": [8, 32]}), ("logistic", {"elasticNetParam": [0.0, 1.0], "maxIter": [2, 60, 100], "regParam": [0.01]})])
def test_points_that_share_a_fit_score_as_their_own(spark, kind, grid):
    rows = spark.range(6000).select("id", *[(F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)) / 50).alias(f"x{k}") for k in range(4)])
    rows = rows.withColumn("label", (F.col("x0") * F.col("x1") + 0.4 * F.col("x2") + F.rand(3) * 0.5 > 0.75).cast("int"))
    rows = stage(encoding.assembler(["x0", "x1", "x2", "x3"], encoding.SELECTED).transform(rows), "grid-rows")
    seen, held = rows.where("id % 3 > 0"), rows.where("id % 3 = 0")
    estimator = models.classifier(kind)
    points = tuning.param_grid(estimator, grid)
    fits = tuning._fit_points(estimator, points, seen, "label")
    assert len(fits) < len(points) == sum(len(f.points) for f in fits)
    own = [tuning._Fit(estimator.copy(p).fit(seen), {i: None}) for i, p in enumerate(points)]
    scores = [
        {(r["point"], r["id"]): r["score"] for r in tuning._scores(f, held, "id").select("point", "id", "score").collect()} for f in (fits, own)
    ]
    assert len(scores[0]) == len(scores[1]) == 2000 * len(points)
    assert all(abs(scores[1][k] - v) < 1e-9 for k, v in scores[0].items())
    assert len({round(v, 9) for (p, _), v in scores[0].items()}) > 10
