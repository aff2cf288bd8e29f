"""Evaluation of scored rows. Counts, losses and curves come from aggregates; AUC is exact at any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import positive_probability, round6
from clickloom.operators.descent import log_loss_of
from clickloom.operators.ordered import bucketed, slice_starts, with_running_totals
from clickloom.schema import LABEL
from clickloom.sources.tables import stage


def confusion_columns(prediction: Column, label: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((prediction == 1) & (label == 1)),
        "fp": F.count_if((prediction == 1) & (label == 0)),
        "fn": F.count_if((prediction == 0) & (label == 1)),
        "tn": F.count_if((prediction == 0) & (label == 0)),
    }


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 in counts; 0.0 where precision and recall are undefined or zero."""
    return _ratio(2 * tp, 2 * tp + fp + fn)


def confusion_matrix(df: DataFrame, by: list[str] | None = None, label: str = LABEL) -> DataFrame:
    cells = confusion_columns(F.col("prediction"), F.col(label))
    return df.groupBy(*(by or [])).agg(*[c.alias(n) for n, c in cells.items()])


def f1_metrics(matrix: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 of label 1."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return matrix.select(
        *(by or []),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        f1_of(tp, fp, fn).alias("f1"),
    )


def confusion_table(matrix: DataFrame) -> DataFrame:
    """The 2x2 matrix in long form: rows are true labels, columns predicted ones."""
    cells = [(1, 1, "tp"), (1, 0, "fn"), (0, 1, "fp"), (0, 0, "tn")]
    rows = [
        F.struct(F.lit(t).alias("true_label"), F.lit(p).alias("predicted_label"), F.col(c).alias("n"))
        for t, p, c in cells
    ]
    return matrix.select(F.inline(F.array(*rows)))


def log_loss(df: DataFrame, by: list[str] | None = None, label: str = LABEL) -> DataFrame:
    p = positive_probability(df)
    return df.groupBy(*(by or [])).agg(F.avg(log_loss_of(p, F.col(label))).alias("log_loss"))


# -- ranking --------------------------------------------------------------------------------------------------------


def score_counts(
    df: DataFrame, by: list[str], score: Column, label: str = LABEL, digits: int | None = None
) -> DataFrame:
    """Positives and negatives per distinct score: ``score, pos, neg``. Rows whose score is NULL or NaN are left out; a
    ``null_audit`` of the score reports their number."""
    score = F.round(score, digits) if digits is not None else score
    return (
        df.select(*by, score.alias("score"), F.col(label).alias("_y"))
        .where(F.col("score").isNotNull() & ~F.isnan("score"))
        .groupBy(*by, "score")
        .agg(F.count_if(F.col("_y") == 1).alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    )


def auc_from_counts(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Exact area under the ROC curve by rank sums, ties counted half; NULL when a class is absent.

    ``counts`` is a stored table of :func:`score_counts`. Scores are cut into slices: pairs within a slice come from a
    window in it, pairs across slices from slice totals.
    """
    by = by or []
    sliced = bucketed(counts, "score")
    below = Window.partitionBy(*by, "slice").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    beaten = F.coalesce(F.sum("neg").over(below), F.lit(0)).cast("double") + F.col("neg") / F.lit(2.0)
    inside = (
        sliced.withColumn("won", F.col("pos").cast("double") * beaten)
        .groupBy(*by, "slice")
        .agg(F.sum("won").alias("won"))
    )
    # One row per group and slice on both sides.
    joined = inside.join(F.broadcast(slice_starts(sliced, by, ["pos", "neg"])), [*by, "slice"])
    won = F.sum(F.col("won") + F.col("pos").cast("double") * F.col("neg_before").cast("double"))
    pairs = F.max("pos_all").cast("double") * F.max("neg_all").cast("double")
    return joined.groupBy(*by).agg(F.try_divide(won, pairs).alias("auc"))


def auc_roc(
    df: DataFrame,
    by: list[str] | None = None,
    score: str = "probability",
    label: str = LABEL,
    digits: int | None = None,
) -> DataFrame:
    """Area under the ROC curve. It is exact by default; ``digits`` rounds the scores first, which keeps the table of
    distinct scores small and treats scores equal after rounding as ties."""
    counts = stage(score_counts(df, by or [], ranking_score(df, score), label, digits), "score-counts")
    return auc_from_counts(counts, by)


def ranking_score(df: DataFrame, score: str = "probability") -> Column:
    """What rows are ranked by: the probability, or the raw margin for a model that has no probability."""
    return positive_probability(df, score if score in df.columns else "rawPrediction")


def _curve(df: DataFrame, label: str, bins: int | None) -> DataFrame:
    """Counts at or above each distinct score, exact at any number of them: running totals go slice by slice.

    With ``bins`` only the scores at which the number of rows passes a further ``1 / bins`` of all rows are returned; their
    counts are exact as well.
    """
    counts = stage(score_counts(df, [], positive_probability(df), label), "score-counts")
    curve = with_running_totals(bucketed(counts, "score"), [], "score", ["pos", "neg"], descending=True)
    if bins is not None:
        upto, own, rows = F.col("pos_upto") + F.col("neg_upto"), F.col("pos") + F.col("neg"), F.col("pos_all") + F.col("neg_all")
        curve = curve.where(F.floor(upto * bins / rows) > F.floor((upto - own) * bins / rows))
    names = {"score": "threshold", "pos_upto": "tp", "neg_upto": "fp", "pos_all": "p", "neg_all": "n"}
    return curve.select(*[F.col(c).alias(n) for c, n in names.items()])


def roc_curve(df: DataFrame, label: str = LABEL, bins: int | None = None) -> DataFrame:
    """False and true positive rate per threshold, with the end points (0, 0) and (1, 1)."""
    points = _curve(df, label, bins).select(
        _ratio(F.col("fp"), F.col("n")).alias("FPR"), _ratio(F.col("tp"), F.col("p")).alias("TPR")
    )
    ends = df.sparkSession.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "FPR double, TPR double")
    return points.unionByName(ends)


def f_by_threshold(df: DataFrame, label: str = LABEL, bins: int | None = None) -> DataFrame:
    """F1 of calling rows positive whose score is at least the threshold."""
    curve = _curve(df, label, bins)
    return curve.select("threshold", f1_of(F.col("tp"), F.col("fp"), F.col("p") - F.col("tp")).alias("F-Measure"))


def best_threshold(f_curve: DataFrame) -> DataFrame:
    """The threshold of the largest F-measure; the highest one on ties, as a curve in falling order meets it first."""
    rank = F.struct("F-Measure", "threshold")
    return f_curve.agg(
        F.max_by("threshold", rank).alias("threshold"), F.max("F-Measure").alias("f_measure")
    )


def apply_threshold(df: DataFrame, threshold: float) -> DataFrame:
    return df.withColumn("prediction", (positive_probability(df) >= threshold).cast("double"))


def threshold_effect(
    df: DataFrame, thresholds: list[float], by: list[str] | None = None, label: str = LABEL
) -> DataFrame:
    """Precision, recall and F1 at each threshold, from a single scan. A score equal to the threshold counts as positive."""
    by = by or []
    p, y = positive_probability(df), F.col(label)
    cells = {}
    for i, t in enumerate(thresholds):
        prediction = F.when(p >= t, 1).otherwise(0)
        cells |= {f"{n}{i}": c for n, c in confusion_columns(prediction, y).items()}
    wide = df.groupBy(*by).agg(*[c.alias(n) for n, c in cells.items()])
    rows = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            *[F.col(f"{n}{i}").alias(n) for n in ("tp", "fp", "fn", "tn")],
        )
        for i, t in enumerate(thresholds)
    ]
    return f1_metrics(wide.select(*by, F.inline(F.array(*rows))), [*by, "threshold"])


# -- reports --------------------------------------------------------------------------------------------------------


def evaluation_report(scored: DataFrame, name: str, part: str = "data", label: str = LABEL) -> DataFrame:
    """``Name, Data, ROC, LogLoss, F1-Score`` per part, rounded to 6 places.

    Rows are scored once: the distinct scores are shuffled with a few counts each, and loss, cells and area follow from that table.
    Without probabilities the loss is NULL. Rows without a score count in neither the area nor the loss.
    """
    has_p = "probability" in scored.columns
    rows = scored.select(F.col(part).alias("Data"), F.col(label).alias("_y"), "prediction", ranking_score(scored).alias("score"))
    cells = confusion_columns(F.col("prediction"), F.col("_y"))
    counts = rows.groupBy("Data", "score").agg(
        F.count_if(F.col("_y") == 1).alias("pos"),
        F.count_if(F.col("_y") == 0).alias("neg"),
        F.count(F.lit(1)).alias("n"),
        *[cells[n].alias(n) for n in ("tp", "fp", "fn")],
    )
    counts = stage(counts, "score-counts")
    # The losses of a score, for label 1 and for the other rows; NULL for a NULL score.
    sides = [(F.col("pos"), log_loss_of(F.col("score"), F.lit(1))), (F.col("n") - F.col("pos"), log_loss_of(F.col("score"), F.lit(0)))]
    none = F.lit(None).cast("double")
    totals = counts.groupBy("Data").agg(
        (F.sum(reduce(Column.__add__, [F.coalesce(n * x, F.lit(0.0)) for n, x in sides])) if has_p else F.first(none)).alias("loss"),
        F.sum(reduce(Column.__add__, [F.when(x.isNotNull(), n).otherwise(0) for n, x in sides])).alias("rows"),
        *[F.sum(n).alias(n) for n in ("tp", "fp", "fn")],
    )
    auc = auc_from_counts(counts.where(F.col("score").isNotNull() & ~F.isnan("score")).select("Data", "score", "pos", "neg"), ["Data"])
    # One row per part on both sides.
    return totals.join(F.broadcast(auc), "Data").select(
        F.lit(name).alias("Name"),
        "Data",
        round6("auc").alias("ROC"),
        round6(F.try_divide("loss", "rows")).alias("LogLoss"),
        round6(f1_of(F.col("tp"), F.col("fp"), F.col("fn"))).alias("F1-Score"),
    )


def model_comparison(reports: list[DataFrame]) -> DataFrame:
    """All reports stacked, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b), reports)


def prediction_agreement(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How close two stored prediction sets are on the same rows, matched by key.

    The key must be unique: ``n_repeated`` is the number of matched pairs beyond one for each key, 0 for a sound result.
    """
    left = a.select(key, positive_probability(a).alias("p_a"), F.col("prediction").alias("y_a"))
    right = b.select(key, positive_probability(b).alias("p_b"), F.col("prediction").alias("y_b"))
    pairs = left.join(right, key).groupBy(key).agg(
        F.count(F.lit(1)).alias("pairs"),
        *[F.first(c).alias(c) for c in ("p_a", "p_b", "y_a", "y_b")],
    )
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col("pairs") - 1), F.lit(0)).alias("n_repeated"),
        F.corr("p_a", "p_b").alias("corr"),
        F.max(F.abs(F.col("p_a") - F.col("p_b"))).alias("max_abs_diff"),
        F.count_if(F.col("y_a") == F.col("y_b")).alias("n_same_class"),
    )
