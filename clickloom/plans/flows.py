"""End-to-end flows: clean, split, encode, train, evaluate; and grid search on prepared features."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import signed_log
from clickloom.operators.cleaning import (
    MIN_FRACTION,
    RareFolding,
    fit_folding,
    fold_counts,
    frequent_counts,
    impute_blank,
    log_transform,
)
from clickloom.operators.descent import vector_score
from clickloom.operators.encoding import (
    MEAN_SUFFIX,
    SELECTED,
    FeaturePipeline,
    TargetMeanEncoder,
    assembler,
    category_order,
    chi_square_slots,
    encoder_from_counts,
    encoder_of,
    fit_target_means,
    one_hot_from_order,
    select_slots,
    slicer,
    store_features,
)
from clickloom.operators.evaluate import evaluation_report
from clickloom.operators.models import FULL_GBT, FULL_LOGISTIC, classifier, score_batch, train
from clickloom.operators.sampling import assign_fold, assign_split
from clickloom.operators.tuning import GRIDS, best_params, cross_validate
from clickloom.schema import LABEL, categorical_columns, numeric_columns
from clickloom.sources.tables import read_parquet, stage, staging, write_parquet

PART = "data"


@dataclass
class Prepared:
    """Feature rows ``key, label, selected_features``, stored before the standardiser in one folder per part, and what made them."""

    rows: DataFrame | None
    features: FeaturePipeline
    folding: RareFolding | None = None
    encoder: TargetMeanEncoder | None = None
    categorical: list[str] = field(default_factory=list)
    numeric: list[str] = field(default_factory=list)

    @property
    def train(self) -> DataFrame:
        return self.rows.where(F.col(PART) == "Train")

    @property
    def test(self) -> DataFrame:
        return self.rows.where(F.col(PART) == "Test")

    def apply(self, new_rows: DataFrame, keep: list[str]) -> DataFrame:
        """Feature vectors of raw rows with what was learned before, next to the columns ``keep``. No statistic of the new rows is used."""
        df = new_rows
        if self.folding is not None:
            df = self.folding.apply(impute_blank(df, self.categorical))
        if self.encoder is None:
            return self.features.apply(log_transform(df, self.numeric), keep)
        means = [c + MEAN_SUFFIX for c in self.encoder.columns]
        return self.features.apply(self.encoder.apply(df).withColumns({c: signed_log(c) for c in means + self.numeric}), keep)

    def save(self, path: str) -> None:
        """Everything that ``apply`` needs, as Parquet and Spark ML folders under ``path``; not the prepared rows."""
        spark = SparkSession.getActiveSession()
        self.features.model.write().save(f"{path}/pipeline")
        settings = {"names": self.features.names, "categorical": self.categorical, "numeric": self.numeric}
        if self.folding is not None:
            settings["folding"] = {"kept": self.folding.kept, "large": self.folding.large, "threshold": self.folding.threshold, "token": self.folding.token}
            write_parquet(self.folding.table, f"{path}/folding")
        if self.encoder is not None:
            settings["encoder"] = {"columns": self.encoder.columns, "fill": self.encoder.fill}
            write_parquet(self.encoder.means, f"{path}/means")
        write_parquet(spark.createDataFrame([(json.dumps(settings),)], "settings string"), f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Prepared:
        """What ``save`` stored, without prepared rows."""
        s = json.loads(read_parquet(spark, f"{path}/settings").first()["settings"])
        folding = RareFolding(table=read_parquet(spark, f"{path}/folding"), **s["folding"]) if "folding" in s else None
        encoder = encoder_of(read_parquet(spark, f"{path}/means"), s["encoder"]["columns"], s["encoder"]["fill"]) if "encoder" in s else None
        return Prepared(None, FeaturePipeline(PipelineModel.load(f"{path}/pipeline"), s["names"]), folding, encoder, s["categorical"], s["numeric"])


def _fit_filter(fit_on: str) -> Column:
    return F.lit(True) if fit_on == "all" else F.col(PART) == "Train"


def _fit_rows(df: DataFrame, fit_on: str) -> DataFrame:
    return df.where(_fit_filter(fit_on))


def learn_categories(rows: DataFrame, categorical: list[str], min_fraction: float = MIN_FRACTION) -> tuple[RareFolding, dict[str, list[str]]]:
    """Folding of blank-filled rows, and the order of the folded categories, from one table of counts."""
    counts = stage(frequent_counts(rows, categorical, LABEL, min_fraction), "category-counts", keep=True)
    folding = fit_folding(counts, categorical, min_fraction)
    return folding, category_order(fold_counts(counts, folding.threshold), categorical)


def prepare_onehot(
    df: DataFrame,
    key: str = "rk",
    fit_on: str = "train",
    min_fraction: float = MIN_FRACTION,
    drop_last: bool = False,
    with_mean: bool = False,
    learned: tuple[RareFolding, dict[str, list[str]]] | None = None,
) -> Prepared:
    """One-hot flow over a stored table: fold rare categories, index, one-hot, log, assemble, standardise.

    ``fit_on='train'`` learns from the training part only; 'all' learns from every row, as the published runs did.
    Without ``with_mean`` the vectors are scaled but not centred, and stay sparse. A centred one-hot vector is dense: it
    takes several times the space of the raw row. Models with an intercept, and trees, do not depend on the centre. ``learned`` is
    what :func:`learn_categories` gives, if it is known.
    """
    categorical, numeric = categorical_columns(df, exclude=(key,)), numeric_columns(df)
    df = log_transform(impute_blank(assign_split(df, key, column=PART), categorical), numeric)
    with staging(df.sparkSession):
        folding, order = learned or learn_categories(_fit_rows(df, fit_on), categorical, min_fraction)
        df = folding.apply(df)
        encode, vectors = one_hot_from_order(df, order, drop_last)
        stages = [*encode.stages, assembler(vectors + numeric)]
        features, rows = store_features(df, stages, [key, LABEL, PART], _fit_filter(fit_on), with_mean, "onehot-features", (PART,))
    return Prepared(rows, features, folding, None, categorical, numeric)


def encode_means(
    df: DataFrame, key: str = "rk", fold: bool = True, min_fraction: float = MIN_FRACTION, **options
) -> tuple[DataFrame, RareFolding | None, TargetMeanEncoder]:
    """Split rows with every category replaced by its mean label in the training part.

    The kept categories and the means of the folded ones both follow from one small table of counts. Without folding,
    every category is counted.
    """
    categorical = categorical_columns(df, exclude=(key,))
    df = assign_split(df, key, column=PART)
    if not fold:
        encoder = fit_target_means(df.where(F.col(PART) == "Train"), categorical)
        return encoder.apply(df, **options), None, encoder
    df = impute_blank(df, categorical)
    train_rows = df.where(F.col(PART) == "Train")
    counts = stage(frequent_counts(train_rows, categorical, LABEL, min_fraction), "category-counts", keep=True)
    folding = fit_folding(counts, categorical, min_fraction)
    encoder = encoder_from_counts(fold_counts(counts, folding.threshold), categorical)
    return encoder.apply(folding.apply(df), **options), folding, encoder


def prepare_means(
    df: DataFrame, key: str = "rk", fold: bool = True, min_fraction: float = MIN_FRACTION, with_mean: bool = True, **options
) -> Prepared:
    """Target-mean flow over a stored table: fold (optional), encode, log, assemble, standardise on the training part.

    Of what it stores on the way, only the feature rows, the counts and the means stay.
    """
    numeric = numeric_columns(df)
    with staging(df.sparkSession):
        encoded, folding, encoder = encode_means(df, key, fold, min_fraction, **options)
        columns = [c + MEAN_SUFFIX for c in encoder.columns]
        logged = encoded.withColumns({c: signed_log(c) for c in columns + numeric})
        features, rows = store_features(logged, [assembler(columns + numeric)], [key, LABEL, PART], _fit_filter("train"), with_mean, "mean-features", (PART,))
    return Prepared(rows, features, folding, encoder, encoder.columns, numeric)


def sliced(prepared: Prepared, slots: list[int]) -> Prepared:
    """The same rows with only the given vector slots."""
    rows = slicer(slots, SELECTED, "_sliced").transform(prepared.rows).drop(SELECTED)
    features = FeaturePipeline(prepared.features.model, [prepared.features.names[i] for i in slots])
    return Prepared(rows.withColumnRenamed("_sliced", SELECTED), features, prepared.folding, prepared.encoder, prepared.categorical, prepared.numeric)


@dataclass
class ScoringChain:
    """A preparation and a classifier as one object that is stored, loaded elsewhere and applied to raw rows.

    The classifier is a Spark ML model, or fixed logistic weights with the bias first. ``slots`` are those that it takes, if not all.
    """

    prepared: Prepared
    model: Model | None = None
    weights: list[float] | None = None
    slots: list[int] | None = None

    def score(self, new_rows: DataFrame, keep: list[str]) -> DataFrame:
        """Raw rows in; the columns ``keep``, ``probability`` (where the model has one) and ``prediction`` out."""
        ready = self.prepared.apply(new_rows, keep)
        if self.slots is not None:
            ready = slicer(self.slots, SELECTED, "_sliced").transform(ready).drop(SELECTED).withColumnRenamed("_sliced", SELECTED)
        scored = score_batch(self.model, ready) if self.weights is None else vector_score(ready, self.weights, SELECTED)
        return scored.select(*[c for c in scored.columns if c in (*keep, "probability", "prediction")])

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        self.prepared.save(f"{path}/preparation")
        if self.model is not None:
            self.model.write().save(f"{path}/classifier")
        settings = json.dumps({"weights": self.weights, "slots": self.slots})
        write_parquet(spark.createDataFrame([(settings,)], "settings string"), f"{path}/chain")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ScoringChain:
        settings = json.loads(read_parquet(spark, f"{path}/chain").first()["settings"])
        model = DefaultParamsReader.loadParamsInstance(f"{path}/classifier", spark.sparkContext) if settings["weights"] is None else None
        return ScoringChain(Prepared.load(spark, f"{path}/preparation"), model, settings["weights"], settings["slots"])


def slot_table(
    df: DataFrame, key: str = "rk", min_fraction: float = MIN_FRACTION, bins: int = 4, learned: tuple[RareFolding, dict[str, list[str]]] | None = None
) -> DataFrame:
    """Chi-square of every slot of :func:`prepare_onehot` against the label, on the training part of a stored table."""
    categorical, numeric = categorical_columns(df, exclude=(key,)), numeric_columns(df)
    rows = assign_split(df, key, column=PART).where(F.col(PART) == "Train")
    rows = log_transform(impute_blank(rows, categorical), numeric)
    folding, order = learned or learn_categories(rows, categorical, min_fraction)
    return chi_square_slots(folding.apply(rows), order, numeric, LABEL, bins)


def prepare_selected(df: DataFrame, key: str = "rk", top: int = 50, **options) -> Prepared:
    """One-hot features with only the ``top`` slots by chi-square. Categories are counted once for both, unless ``options`` say how."""
    learned = None
    if not options.keys() & {"fit_on", "min_fraction", "learned"}:
        categorical = categorical_columns(df, exclude=(key,))
        learned = learn_categories(impute_blank(_fit_rows(assign_split(df, key, column=PART), "train"), categorical), categorical)
        options = {**options, "learned": learned}
    chosen = [r["slot"] for r in select_slots(slot_table(df, key, learned=learned), top).collect()]
    return sliced(prepare_onehot(df, key, **options), sorted(chosen))


def report(model: Model, prepared: Prepared, name: str) -> DataFrame:
    """Train and test metrics of a fitted model, from one scoring pass."""
    return evaluation_report(score_batch(model, prepared.rows), name, PART)


def train_and_report(kind: str, prepared: Prepared, name: str, **settings) -> tuple[Model, DataFrame]:
    model = train(kind, prepared.train, **settings)
    return model, report(model, prepared, name)


def onehot_logistic(df: DataFrame, key: str = "rk", **options) -> tuple[Model, DataFrame]:
    return train_and_report("logistic", prepare_onehot(df, key, **options), "LR", **FULL_LOGISTIC)


def onehot_gbt(df: DataFrame, key: str = "rk", **options) -> tuple[Model, DataFrame]:
    return train_and_report("gbt", prepare_onehot(df, key, **options), "GBT", **FULL_GBT)


def mean_logistic(df: DataFrame, key: str = "rk", **options) -> tuple[Model, DataFrame]:
    return train_and_report("logistic", prepare_means(df, key, **options), "LR+BM", **FULL_LOGISTIC)


def grid_search(kind: str, prepared: Prepared, name: str, grid: str | None = None, features: str = SELECTED, **options):
    """Cross-validated model of the training part, its best parameters, and its report."""
    points = GRIDS[grid or kind]
    found = cross_validate(classifier(kind, features), points, prepared.train, **options)
    return found, best_params(found, points), report(found.bestModel, prepared, name)


def gbt_batch_search(df: DataFrame, key: str = "rk", grid: str = "gbt_batch", **options):
    """The search of the published batch script: boosted trees on one-hot features, 12 grid points on 3 folds by key hash."""
    prepared = prepare_onehot(df, key, **options)
    prepared.rows = assign_fold(prepared.rows, key)
    return grid_search("gbt", prepared, "GBT+CV", grid=grid, fold_col="fold")
