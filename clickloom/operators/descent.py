"""Logistic regression by batch gradient descent. Each step is one aggregate; only d + 2 numbers reach the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import dot, sigmoid, vector_dot
from clickloom.operators.vectors import entries, vector_parts
from clickloom.schema import LABEL

# Guard inside the logarithms, learning rate, gradient factor and number of steps.
EPSILON = 1e-16
LEARNING_RATE = 0.2
GRADIENT_FACTOR = 2.0
STEPS = 100


def probability(weights: list[float], features: list[str]) -> Column:
    """Probability of label 1 for ``weights`` with the bias first."""
    return sigmoid(dot(dict(zip(features, weights[1:])), weights[0]))


def log_loss_of(p: Column, label: Column, epsilon: float = EPSILON) -> Column:
    return F.when(label == 1, -F.log(p + F.lit(epsilon))).otherwise(-F.log(F.lit(1.0) - p + F.lit(epsilon)))


def logistic_score(df: DataFrame, weights: list[float], features: list[str], threshold: float = 0.5) -> DataFrame:
    """Adds ``probability`` and ``prediction``: a narrow projection."""
    scored = df.withColumn("probability", probability(weights, features))
    return scored.withColumn("prediction", (F.col("probability") > threshold).cast("double"))


def loss(df: DataFrame, weights: list[float], features: list[str], label: str = LABEL) -> DataFrame:
    return df.agg(F.avg(log_loss_of(probability(weights, features), F.col(label))).alias("loss"))


def gradient_and_loss(df: DataFrame, weights: list[float], features: list[str], label: str = LABEL) -> DataFrame:
    """One row: the loss at ``weights`` as ``loss``, and the gradient as ``g0`` (bias), ``g1``, ..."""
    rows = df.select(label, *features, probability(weights, features).alias("p"))
    error = F.col("p") - F.col(label)
    slopes = [F.avg(error)] + [F.avg(error * F.col(f)) for f in features]
    return rows.agg(
        F.avg(log_loss_of(F.col("p"), F.col(label))).alias("loss"),
        *[(F.lit(GRADIENT_FACTOR) * g).alias(f"g{i}") for i, g in enumerate(slopes)],
    )


def step(df: DataFrame, weights: list[float], features: list[str], rate: float = LEARNING_RATE, label: str = LABEL) -> DataFrame:
    """The weights after one step, as rows ``slot, weight`` (slot 0 is the bias)."""
    row = gradient_and_loss(df, weights, features, label)
    moved = [
        F.struct(F.lit(i).alias("slot"), (F.lit(float(w)) - F.lit(rate) * F.col(f"g{i}")).alias("weight"))
        for i, w in enumerate(weights)
    ]
    return row.select(F.inline(F.array(*moved)))


def descend(
    df: DataFrame,
    features: list[str],
    steps: int = STEPS,
    rate: float = LEARNING_RATE,
    label: str = LABEL,
    start: list[float] | None = None,
) -> tuple[list[float], list[tuple]]:
    """Weights after ``steps`` and the trace ``(step, loss, weights...)``, from step 0.

    Loss and gradient at the same weights come from one job, so the run takes ``steps + 1`` jobs over the cached rows.
    """
    weights = list(start or [0.0] * (len(features) + 1))
    rows = df.select(label, *features).persist()
    trace = []
    try:
        for i in range(steps + 1):
            found = gradient_and_loss(rows, weights, features, label).first()
            trace.append((i, found["loss"], *weights))
            if i < steps:
                weights = [w - rate * found[f"g{k}"] for k, w in enumerate(weights)]
    finally:
        rows.unpersist()
    return weights, trace


def trace_table(df: DataFrame, trace: list[tuple]) -> DataFrame:
    names = ", ".join(f"w{k} double" for k in range(len(trace[0]) - 2))
    return df.sparkSession.createDataFrame(trace, f"step int, loss double, {names}")


# -- feature vectors ------------------------------------------------------------------------------------------------


def vector_score(df: DataFrame, weights: list[float], features: str, threshold: float = 0.5) -> DataFrame:
    """:func:`logistic_score` for a vector column; ``weights`` has the bias first."""
    scored = df.withColumn("probability", sigmoid(vector_dot(features, weights[1:], weights[0])))
    return scored.withColumn("prediction", (F.col("probability") > threshold).cast("double"))


def vector_gradient(df: DataFrame, weights: list[float], features: str, label: str = LABEL) -> tuple[float, list[float]]:
    """The loss at ``weights`` and the gradient, bias first, from one pass over the vectors, sparse or dense.

    Each task adds up the entries of its own rows, a batch of rows at a time, and gives one array of sums. These are merged slot by
    slot, so that no task takes an array from every other.
    """
    rows = df.select(F.col(label).cast("double").alias("y"), *vector_parts(features))
    bias, table, epsilon = float(weights[0]), np.array(weights[1:], dtype=float), EPSILON

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(table) + 3)
        for batch in batches:
            y, i, x = batch.columns
            y, (row, at, x) = y.to_numpy(zero_copy_only=False), entries(i, x)
            with np.errstate(over="ignore"):
                p = 1.0 / (1.0 + np.exp(-(bias + np.bincount(row, x * table[at], len(y)))))
            error = np.where(np.isnan(y), 0.0, p - y)
            total[:3] += -np.log(np.where(y == 1, p, 1.0 - p) + epsilon).sum(), len(y), error.sum()
            total[3:] += np.bincount(at, x * error[row], len(table))
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    slots = rows.mapInArrow(sums, "v array<double>").select(F.posexplode("v").alias("slot", "x"))
    found = {r["slot"]: r["x"] for r in slots.groupBy("slot").agg(F.sum("x").alias("x")).collect()}
    loss_sum, n = found[0], found[1]
    return loss_sum / n, [GRADIENT_FACTOR * found[k] / n for k in range(2, len(weights) + 2)]


def descend_vectors(
    df: DataFrame, features: str, size: int, steps: int = STEPS, rate: float = LEARNING_RATE, label: str = LABEL, centre: bool = False
) -> tuple[list[float], list[tuple]]:
    """:func:`descend` over vectors of ``size`` slots: weights, bias first, and the trace ``(step, loss, weights...)``.

    With ``centre`` the steps are those on centred vectors, which fall faster, while the stored vectors stay sparse: the means enter
    the margin and the gradient as numbers. The weights returned are for the vectors as they are; the trace has the centred bias.
    """
    weights, trace = [0.0] * (size + 1), []
    rows = df.select(label, features).persist()
    try:
        means = rows.agg(Summarizer.mean(F.col(features)).alias("m")).first()["m"].toArray().tolist() if centre else [0.0] * size

        def plain(centred: list[float]) -> list[float]:
            return [centred[0] - sum(w * m for w, m in zip(centred[1:], means)), *centred[1:]]

        for i in range(steps + 1):
            loss_now, slopes = vector_gradient(rows, plain(weights), features, label)
            trace.append((i, loss_now, *weights))
            if i < steps:
                slopes = [slopes[0], *[g - m * slopes[0] for g, m in zip(slopes[1:], means)]]
                weights = [w - rate * g for w, g in zip(weights, slopes)]
    finally:
        rows.unpersist()
    return plain(weights), trace
