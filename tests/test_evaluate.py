import math
import random
import tempfile

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clickloom.operators import descent, evaluate, models, ordered
from clickloom.operators.encoding import assembler
from clickloom.sources.tables import read_parquet, write_parquet


def scores(spark, n=400, digits=2, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        p = round(rng.random(), digits)
        rows.append((i, "Train" if i % 3 else "Test", int(rng.random() < p), p, float(p > 0.5)))
    return spark.createDataFrame(rows, "rk int, data string, label int, probability double, prediction double")


def brute_auc(rows):
    pos = [r["probability"] for r in rows if r["label"] == 1]
    neg = [r["probability"] for r in rows if r["label"] == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_auc_equals_brute_force_over_pairs(spark, digits):
    df = scores(spark, digits=digits)
    rows = df.collect()
    found = {r["data"]: r["auc"] for r in evaluate.auc_roc(df, ["data"]).collect()}
    for part in ("Train", "Test"):
        assert found[part] == pytest.approx(brute_auc([r for r in rows if r["data"] == part]), abs=1e-12)


def test_auc_equals_the_exact_evaluator(spark):
    df = scores(spark)
    raw = df.withColumn("rawPrediction", F.col("probability"))
    exact = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    assert evaluate.auc_roc(df).first()["auc"] == pytest.approx(exact, abs=1e-12)


def test_rounded_auc_treats_equal_scores_as_ties(spark):
    df = scores(spark, digits=9)
    rounded = df.withColumn("probability", F.round("probability", 1))
    assert evaluate.auc_roc(df, digits=1).first()["auc"] == evaluate.auc_roc(rounded).first()["auc"]


def test_auc_of_one_score_and_of_one_class(spark):
    constant = spark.createDataFrame([(1, 0.3), (0, 0.3), (0, 0.3)], "label int, probability double")
    assert evaluate.auc_roc(constant).first()["auc"] == 0.5
    single = spark.createDataFrame([(1, 0.3), (1, 0.7)], "label int, probability double")
    assert evaluate.auc_roc(single).first()["auc"] is None


@pytest.mark.parametrize("slices", [2, 5, 50])
def test_exact_quantiles_equal_numpy(spark, slices):
    rng = random.Random(5)
    rows = [("x", 1.0 if i % 3 == 0 else rng.choice([0.5, 2.25, rng.random() * 9])) for i in range(700)]
    rows += [("y", float(i)) for i in range(4)] + [("z", 7.0)]
    counts = spark.createDataFrame(rows, "k string, v double").groupBy("k", "v").agg(F.count("*").alias("n"))
    sliced = ordered.bucketed(counts, "v", slices)
    points = {"q1": 0.25, "median": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}
    for r in ordered.exact_quantiles(sliced, ["k"], "v", points).collect():
        values = [v for k, v in rows if k == r["k"]]
        for name, p in points.items():
            assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_log_loss_value_and_evaluator(spark):
    pair = spark.createDataFrame([(1, 0.8), (0, 0.8)], "label int, probability double")
    assert evaluate.log_loss(pair).first()["log_loss"] == pytest.approx(0.916291, abs=1e-6)
    rows = [(float(y), float(p > 0.5), Vectors.dense(1 - p, p)) for y, p in [(1, 0.9), (0, 0.2), (1, 0.4), (0, 0.7)]]
    df = spark.createDataFrame(rows, ["label", "prediction", "probability"])
    theirs = MulticlassClassificationEvaluator(metricName="logLoss").evaluate(df)
    assert evaluate.log_loss(df).first()["log_loss"] == pytest.approx(theirs, abs=1e-12)


def test_certain_and_wrong_costs_the_guarded_logarithm(spark):
    df = spark.createDataFrame([(0, 1.0)], "label int, probability double")
    assert evaluate.log_loss(df).first()["log_loss"] == pytest.approx(-math.log(1e-16))


def test_f1_without_true_positives_is_zero(spark):
    rows = [(1, 0.0), (0, 1.0), (0, 0.0)]
    df = spark.createDataFrame(rows, "label int, prediction double")
    got = evaluate.f1_metrics(evaluate.confusion_matrix(df)).first()
    assert (got["precision"], got["recall"], got["f1"]) == (0.0, 0.0, 0.0)
    nothing = spark.createDataFrame([(0, 0.0)], "label int, prediction double")
    assert evaluate.f1_metrics(evaluate.confusion_matrix(nothing)).first()["f1"] == 0.0


def test_best_threshold_takes_the_highest_on_ties(spark):
    curve = spark.createDataFrame([(0.2, 0.5), (0.4, 0.7), (0.3, 0.7)], ["threshold", "F-Measure"])
    assert tuple(evaluate.best_threshold(curve).first()) == (0.4, 0.7)


@pytest.mark.parametrize("scale", [1.0, 1 / 500])
def test_curve_at_a_threshold_equals_the_metrics_there(spark, scale):
    df = scores(spark, digits=16).withColumn("probability", F.col("probability") * scale)
    curve = {r["threshold"]: r["F-Measure"] for r in evaluate.f_by_threshold(df).collect()}
    assert len(curve) == df.select("probability").distinct().count()
    best = tuple(evaluate.best_threshold(evaluate.f_by_threshold(df)).first())
    assert best == max(curve.items(), key=lambda x: (x[1], x[0]))
    for t in sorted(curve)[::50] + [best[0]]:
        cut = evaluate.apply_threshold(df, t)
        direct = evaluate.f1_metrics(evaluate.confusion_matrix(cut)).first()["f1"]
        effect = evaluate.threshold_effect(df, [t]).first()["f1"]
        assert curve[t] == pytest.approx(direct) and effect == pytest.approx(direct)


def test_curve_bins_take_exact_points_of_the_curve(spark):
    df = scores(spark, digits=16)
    whole = {tuple(r) for r in evaluate.f_by_threshold(df).collect()}
    few = {tuple(r) for r in evaluate.f_by_threshold(df, bins=20).collect()}
    assert few < whole and len(few) == 20 and evaluate.roc_curve(df, bins=20).count() == 22


def test_missing_scores_are_left_out_of_curves_and_area(spark):
    rows = [(0.9, 1, 1.0), (0.1, 0, 0.0), (None, 1, 0.0), (float("nan"), 0, 0.0)]
    df = spark.createDataFrame(rows, "probability double, label int, prediction double")
    assert evaluate.auc_roc(df).first()["auc"] == 1.0
    assert {r["threshold"] for r in evaluate.f_by_threshold(df).collect()} == {0.1, 0.9}


def test_agreement_reports_repeated_keys(spark):
    a = spark.createDataFrame([("x", 0.2, 0.0), ("x", 0.2, 0.0), ("y", 0.9, 1.0)], "rk string, probability double, prediction double")
    b = a.dropDuplicates(["rk"])
    got = evaluate.prediction_agreement(a, b, "rk").first()
    assert (got["n"], got["n_repeated"], got["n_same_class"]) == (2, 1, 2)


def test_report_equals_single_metrics(spark):
    df = scores(spark)
    report = {r["Data"]: r for r in evaluate.evaluation_report(df, "m").collect()}
    auc = {r["data"]: r["auc"] for r in evaluate.auc_roc(df, ["data"]).collect()}
    loss = {r["data"]: r["log_loss"] for r in evaluate.log_loss(df, ["data"]).collect()}
    f1 = {
        r["data"]: r["f1"]
        for r in evaluate.f1_metrics(evaluate.confusion_matrix(df, ["data"]), ["data"]).collect()
    }
    for part, row in report.items():
        assert (row["ROC"], row["LogLoss"], row["F1-Score"]) == pytest.approx(
            (auc[part], loss[part], f1[part]), abs=1e-6
        )
    path = tempfile.mkdtemp(prefix="clickloom-test-") + "/reports"
    for _ in range(2):
        write_parquet(evaluate.evaluation_report(df, "m"), path, mode="append")
    assert read_parquet(spark, path).count() == 4
    stacked = evaluate.model_comparison([evaluate.evaluation_report(df, "m")] * 2)
    assert stacked.count() == 4


def test_gradient_step_from_zero(spark):
    df = spark.createDataFrame([(1.0, 1), (-1.0, 0)], "x double, label int")
    assert descent.loss(df, [0.0, 0.0], ["x"]).first()["loss"] == pytest.approx(0.693147, abs=1e-6)
    moved = {r["slot"]: r["weight"] for r in descent.step(df, [0.0, 0.0], ["x"]).collect()}
    assert moved == pytest.approx({0: 0.0, 1: 0.2})


def test_descent_approaches_the_fitted_logistic_model(spark):
    rows = [(float(i % 7) - 3, int((i * 5) % 11 < 3 + i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "x double, label int")
    weights, trace = descent.descend(df, ["x"], steps=60, rate=0.2)
    losses = [t[1] for t in trace]
    assert len(trace) == 61 and losses[-1] < losses[0]
    model = models.train("logistic", assembler(["x"]).transform(df), features="features", maxIter=50)
    assert weights == pytest.approx([model.intercept, model.coefficients[0]], abs=0.05)
    keyed = df.withColumn("rk", F.monotonically_increasing_id())
    own = descent.logistic_score(keyed, weights, ["x"])
    fitted = models.score_batch(model, assembler(["x"]).transform(keyed))
    agreement = evaluate.prediction_agreement(own, fitted, "rk").first()
    assert agreement["n"] == 300 and agreement["corr"] > 0.999 and agreement["max_abs_diff"] < 0.05
