"""Category encodings and feature vectors: target means, string index, one-hot, assembly, scaling, chi-square."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    Bucketizer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.lookup import BROADCAST_ROWS, HOT_SHARE, attach, attach_many
from clickloom.operators.ordered import bucketed, exact_quantiles, numbered_within
from clickloom.operators.profile import melt
from clickloom.schema import LABEL
from clickloom.sources import tables
from clickloom.sources.tables import stage

MEAN_SUFFIX = "_bm"
GLOBAL_MEAN = "global_mean"
# Most categories, over all columns, whose list is held on the driver.
MAX_VOCABULARY = 1_000_000
# From this number of columns on, long columns are looked up together.
LONG_AT_ONCE = 4
FEATURES = "features"
SELECTED = "selected_features"


# -- target means ---------------------------------------------------------------------------------------------------


def target_means(df: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    """Mean label of every category of every column, from one scan: ``feature, value, n, n_positive, mean``."""
    return (
        melt(df, [label], columns, "feature", "value")
        .groupBy("feature", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(label).cast("bigint")).alias("n_positive"),
            F.avg(label).alias("mean"),
        )
    )


@dataclass
class TargetMeanEncoder:
    """Fitted mean tables: each category is replaced by its mean label in the rows the encoder was fitted on."""

    columns: list[str]
    means: DataFrame
    sizes: dict[str, int]
    fill: float = 0.0

    def apply(self, df: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """Replaces each column ``c`` by ``c_bm``; categories without a mean get ``fill``.

        Tables up to ``broadcast_rows`` are broadcast, so that the rows are not shuffled at all. Few larger ones are looked up one after
        another, each with a shuffle of the rows; from ``LONG_AT_ONCE`` of them on, all cost one shuffle of the rows and one of their
        values together (see ``attach_many``). Next to these, a table of no more rows than may be hot is broadcast as a hot part is.
        A category that has its mean travels no further.
        """
        long = [c for c in self.columns if self.sizes[c] > broadcast_rows]
        long = [c for c in long if self.sizes[c] * HOT_SHARE > 1] or long
        for c in [c for c in self.columns if c not in long] + (long if len(long) < LONG_AT_ONCE else []):
            table = self.means.where(F.col("feature") == c)
            limit = broadcast_rows if c in long else max(broadcast_rows, self.sizes[c])
            df = attach(df, c, table, {"mean": c + MEAN_SUFFIX}, self.sizes[c], limit).drop(c)
        if len(long) >= LONG_AT_ONCE:
            df = attach_many(df, long, self.means, "mean", MEAN_SUFFIX, sum(self.sizes[c] for c in long), drop=True)
        kept = [c for c in df.columns if c not in self.columns and c not in self._outputs]
        return df.select(*kept, *self._outputs).na.fill(self.fill, subset=self._outputs)

    @property
    def _outputs(self) -> list[str]:
        return [c + MEAN_SUFFIX for c in self.columns]

    def apply_leave_one_out(self, df: DataFrame, label: str = LABEL, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """For the rows that the encoder was fitted on: each takes the mean of the other rows of its category.

        A category with one row, and one without a mean, gets ``fill``.
        """
        for c in self.columns:
            table = self.means.where(F.col("feature") == c)
            df = attach(df, c, table, {"n": "_n", "n_positive": "_p"}, self.sizes[c], broadcast_rows)
            mean = F.try_divide(F.col("_p") - F.col(label), F.col("_n") - 1)
            df = df.withColumn(c + MEAN_SUFFIX, F.coalesce(mean, F.lit(self.fill))).drop(c, "_n", "_p")
        return df


def encoder_from_counts(counts: DataFrame, columns: list[str], fill: float | str = 0.0) -> TargetMeanEncoder:
    """An encoder from counts per category (``feature, value, n, n_positive``), stored and counted per column."""
    means = counts.withColumn("mean", F.col("n_positive") / F.col("n")).sortWithinPartitions("feature")
    return encoder_of(stage(means, "target-means", keep=True), columns, fill)


def encoder_of(means: DataFrame, columns: list[str], fill: float | str = 0.0) -> TargetMeanEncoder:
    """An encoder from a stored table ``feature, value, n, n_positive, mean``. ``fill`` is a number or ``'global_mean'``."""
    bytes_of = F.coalesce(F.sum(F.octet_length("value")), F.lit(0)) + 24 * F.count(F.lit(1))
    measured = means.groupBy("feature").agg(
        F.greatest(F.count(F.lit(1)), F.ceil(bytes_of / 100)).alias("rows"), F.sum("n").alias("n"), F.sum("n_positive").alias("p")
    ).collect()
    sizes = {c: 0 for c in columns} | {r["feature"]: r["rows"] for r in measured}
    if fill == GLOBAL_MEAN:
        rows = max((r["n"] for r in measured), default=0)
        fill = max((r["p"] for r in measured if r["n"] == rows), default=0) / rows if rows else 0.0
    return TargetMeanEncoder(columns, means, sizes, float(fill))


def fit_target_means(df: DataFrame, columns: list[str], label: str = LABEL, fill: float | str = 0.0) -> TargetMeanEncoder:
    """All mean tables from the given rows in one scan."""
    return encoder_from_counts(target_means(df, columns, label).drop("mean"), columns, fill)


# -- index and one-hot ----------------------------------------------------------------------------------------------


def string_indexer(columns: list[str], handle_invalid: str = "error") -> StringIndexer:
    """Index by falling frequency, ties by value. The labels are held on the driver: use folded columns."""
    return StringIndexer(
        inputCols=columns,
        outputCols=[f"{c}_index" for c in columns],
        stringOrderType="frequencyDesc",
        handleInvalid=handle_invalid,
    )


def _check_vocabulary(categories: int) -> None:
    if categories > MAX_VOCABULARY:
        raise ValueError(f"{categories} categories are too many for the driver: fold the columns first, or encode them by target means")


def index_table(df: DataFrame, columns: list[str], model: StringIndexerModel) -> DataFrame:
    rows = [(c, v, i) for c, values in zip(columns, model.labelsArray) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "feature string, value string, slot int")


def long_index(counts: DataFrame) -> DataFrame:
    """``feature, value, n, slot``: the string index of columns of any number of categories, as a table. ``slot`` goes by falling count,
    ties by value. ``counts`` is stored (``feature, value, n``). No category reaches the driver."""
    return numbered_within(counts.select("feature", "value", "n"), "feature", [F.desc("n"), F.asc("value")], "slot")


def one_hot_long(df: DataFrame, columns: list[str], index: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, list[str]]:
    """``df`` with a sparse vector ``<c>_vec`` for each column, by a stored :func:`long_index`; and the names of these columns.

    One slot for each category; one that the index does not have is all-zero. The rows are shuffled at most once.
    """
    sizes = {r["feature"]: r["count"] for r in index.groupBy("feature").count().collect()}
    sizes = {c: sizes.get(c, 0) for c in columns}
    long = [c for c in columns if sizes[c] > broadcast_rows]
    for c in columns:
        if c not in long:
            df = attach(df, c, index.where(F.col("feature") == c), {"slot": f"{c}_index"}, sizes[c], broadcast_rows)
    if long:
        df = attach_many(df, long, index, "slot", "_index", sum(sizes[c] for c in long))
    vectors = [f"{c}_vec" for c in columns]
    encoded = df.withColumns({v: _unit_vector(F.col(f"{c}_index"), sizes[c]) for c, v in zip(columns, vectors)})
    return encoded.drop(*[f"{c}_index" for c in columns]), vectors


def _unit_vector(slot: Column, size: int) -> Column:
    """A sparse vector of ``size`` slots with 1.0 in ``slot``; all-zero where that is NULL. ``OneHotEncoder`` would give each slot a name in the
    column's metadata, which the driver holds."""
    entry = F.when(slot.isNull(), ',"indices":[],"values":[]}}').otherwise(F.concat(F.lit(',"indices":['), slot.cast("string"), F.lit('],"values":[1.0]}}')))
    text = F.concat(F.lit(f'{{"v":{{"type":0,"size":{size}'), entry)
    return F.from_json(text, T.StructType([T.StructField("v", VectorUDT())]))["v"]


def category_order(counts: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Categories of each column by falling count, ties by value: the order of a string index.

    For folded counts, of which the folding rule leaves few.
    """
    _check_vocabulary(counts.count())
    order: dict[str, list[str]] = {c: [] for c in columns}
    for row in counts.orderBy("feature", F.desc("n"), "value").collect():
        order[row["feature"]].append(row["value"])
    return order


def indexers_from_order(order: dict[str, list[str]], handle_invalid: str = "error") -> list[StringIndexerModel]:
    """String indexes from a known category order, without another pass over the rows.

    One model per column: the multi-column constructor pads lists of unequal length.
    """
    return [
        StringIndexerModel.from_labels(values, c, f"{c}_index", handle_invalid) for c, values in order.items()
    ]


def one_hot_from_order(
    df: DataFrame, order: dict[str, list[str]], drop_last: bool = False
) -> tuple[PipelineModel, list[str]]:
    """Index and one-hot ``c`` to ``c_vec``; returns the fitted stages and the vector columns they make.

    The full form has one slot per category, and an unseen category is all-zero: the index keeps a place for it, and
    that last place is the one the encoder drops. With ``drop_last`` the least frequent category is all-zero instead,
    and an unseen one is an error. A column with a single category then has no slot left, and makes no vector.
    """
    indexers = PipelineModel(indexers_from_order(order, "error" if drop_last else "keep"))
    encoded = [c for c, values in order.items() if len(values) > 1 or not drop_last]
    vectors = [f"{c}_vec" for c in encoded]
    encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in encoded], outputCols=vectors, dropLast=True)
    return PipelineModel([*indexers.stages, encoder.fit(indexers.transform(df.limit(0)))]), vectors


def fit_one_hot(df: DataFrame, columns: list[str], drop_last: bool = False) -> tuple[PipelineModel, list[str]]:
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    _check_vocabulary(sum(sizes))
    order = dict(zip(columns, string_indexer(columns).fit(df).labelsArray))
    return one_hot_from_order(df, order, drop_last)


def slot_sums(df: DataFrame, vector: str) -> DataFrame:
    """Sum of each vector slot over all rows: ``slot, total``. Partial sums are merged; rows are never exploded."""
    total = df.agg(Summarizer.sum(F.col(vector)).alias("v"))
    return total.select(F.posexplode(vector_to_array("v")).alias("slot", "total"))


def sparse_slot_sums(df: DataFrame, vectors: list[str]) -> DataFrame:
    """Sums of the slots of several long vectors from one pass: ``vector, slot, total``, for slots in which some row has an entry.

    Entries are summed by slot, first in each task, so that no task holds an array of all slots.
    """

    def entries(name: str) -> Column:
        parts = F.unwrap_udt(F.col(name))
        every = F.when(F.size(parts["values"]) > 0, F.sequence(F.lit(0), F.size(parts["values"]) - 1)).otherwise(F.array().cast("array<int>"))
        at = F.coalesce(parts["indices"], every)  # a dense vector has an entry for each slot
        return F.zip_with(at, parts["values"], lambda i, x: F.struct(F.lit(name).alias("vector"), i.alias("slot"), x.alias("x")))

    rows = df.select(F.explode(F.array(*[entries(v) for v in vectors])).alias("e")).select(F.inline("e"))
    return rows.groupBy("vector", "slot").agg(F.sum("x").alias("total"))


def vector_names(df: DataFrame, vector: str = FEATURES) -> list[str]:
    """Slot names of an assembled vector, from its column metadata: ``column=category``, or the numeric column."""
    attrs = df.schema[vector].metadata["ml_attr"]["attrs"]
    slots = sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])
    return [a["name"].replace("_vec_", "=", 1) for a in slots]


# -- feature pipelines ----------------------------------------------------------------------------------------------


def assembler(columns: list[str], output: str = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=output)


def scaler(with_mean: bool = True, input_col: str = FEATURES, output_col: str = SELECTED) -> StandardScaler:
    """Standardise by mean and sample deviation. ``with_mean=False`` keeps sparse one-hot vectors sparse."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True, withMean=with_mean)


@dataclass
class FeaturePipeline:
    """A fitted chain of feature stages, with the names of the vector slots it makes."""

    model: PipelineModel
    names: list[str] = field(default_factory=list)

    def apply(self, df: DataFrame, keep: list[str]) -> DataFrame:
        return self.model.transform(df).select(*keep, SELECTED)

    @property
    def size(self) -> int:
        return len(self.names)


def _with_names(model: PipelineModel, df: DataFrame) -> FeaturePipeline:
    return FeaturePipeline(model, vector_names(model.transform(df.limit(0))))


def fit_onehot_features(
    df: DataFrame, order: dict[str, list[str]], numeric: list[str], drop_last: bool = False, with_mean: bool = True
) -> FeaturePipeline:
    """Index, one-hot, assemble (categories first) and standardise cleaned rows."""
    encode, vectors = one_hot_from_order(df, order, drop_last)
    finish = Pipeline(stages=[assembler(vectors + numeric), scaler(with_mean)]).fit(encode.transform(df))
    return _with_names(PipelineModel([*encode.stages, *finish.stages]), df)


def fit_mean_features(
    df: DataFrame, encoded: list[str], numeric: list[str], with_mean: bool = True
) -> FeaturePipeline:
    """Assemble (target means first) and standardise mean-encoded rows."""
    return _with_names(Pipeline(stages=[assembler(encoded + numeric), scaler(with_mean)]).fit(df), df)


def store_features(df: DataFrame, stages: list[Transformer], keep: list[str], fit_on: Column, with_mean: bool, name: str, partition_by: tuple[str, ...]) -> tuple[FeaturePipeline, DataFrame]:
    """The pipeline of the fitted ``stages``, of which the last makes the assembled vectors, and a standardiser; and its feature rows.

    The vectors are made once and stored. The standardiser learns from the stored ones where ``fit_on`` holds, and is applied as rows are read.
    """
    vectors = stage(PipelineModel(stages).transform(df).select(*keep, FEATURES), name, partition_by, keep=True, row_group=tables.FIT_SPLIT)
    scale = scaler(with_mean).fit(vectors.where(fit_on))
    return FeaturePipeline(PipelineModel([*stages, scale]), vector_names(vectors)), scale.transform(vectors).select(*keep, SELECTED)


def slicer(slots: list[int], input_col: str = SELECTED, output_col: str = "sliced_features") -> Transformer:
    return VectorSlicer(inputCol=input_col, outputCol=output_col, indices=slots)


# -- chi-square -----------------------------------------------------------------------------------------------------


def chi_square_table(means: DataFrame) -> DataFrame:
    """Pearson chi-square of each column against the label, from the counts of :func:`target_means`."""
    totals = means.groupBy("feature").agg(F.sum("n").alias("rows"), F.sum("n_positive").alias("positives"))
    share = F.col("positives") / F.col("rows")

    def cell(observed, expected):
        return F.when(expected > 0, (observed - expected) * (observed - expected) / expected).otherwise(0.0)

    hit = cell(F.col("n_positive"), F.col("n") * share)
    miss = cell(F.col("n") - F.col("n_positive"), F.col("n") * (F.lit(1.0) - share))
    # One row of totals per column.
    return (
        means.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.sum(hit + miss).alias("statistic"), (F.count(F.lit(1)) - 1).alias("dof"))
    )


def select_by_chi_square(table: DataFrame, top: int = 50) -> DataFrame:
    """The ``top`` features of a :func:`chi_square_table`, by statistic per degree of freedom (ties by name): ``feature, rank``.

    P-values would all be 0.0 on large data, and leave the choice to the column order.
    """
    strength = F.coalesce(F.try_divide("statistic", "dof"), F.lit(0.0))
    best = table.select("feature", strength.alias("strength")).orderBy(F.desc("strength"), "feature").limit(top)
    # One row per column of the data.
    return best.select("feature", F.row_number().over(Window.orderBy(F.desc("strength"), "feature")).alias("rank"))


# -- chi-square of vector slots -------------------------------------------------------------------------------------


def quantile_cuts(df: DataFrame, numeric: list[str], bins: int = 4) -> dict[str, list[float]]:
    """The inner borders of ``bins`` equally full bins of each column, exact; equal ones once."""
    counts = stage(melt(df, [], numeric, "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    points = {f"q{i}": i / bins for i in range(1, bins)}
    found = exact_quantiles(bucketed(counts, "value"), ["feature"], "value", points).collect()
    return {r["feature"]: sorted({r[q] for q in points}) for r in found}


def chi_square_slots(df: DataFrame, order: dict[str, list[str]], numeric: list[str], label: str = LABEL, bins: int = 4) -> DataFrame:
    """Pearson chi-square of each slot of the one-hot features against the label: ``slot, name, statistic, dof``.

    A category's slot is there or not; a numeric slot is cut into equally full bins, its highest border belonging to the bin above. The cells
    come from one sum of sparse indicator vectors for each label, so no row is multiplied. ``df`` has cleaned, folded rows.
    """
    encode, vectors = one_hot_from_order(df, order)
    cuts = quantile_cuts(df, numeric, bins)
    stages = [Bucketizer(splits=[float("-inf"), *cuts[c], float("inf")], inputCol=c, outputCol=f"{c}_bin") for c in numeric if cuts.get(c)]
    binned = [s.getOutputCol() for s in stages]
    spread = OneHotEncoder(inputCols=binned, outputCols=[f"{c}_ind" for c in binned], dropLast=False)
    rows = PipelineModel(stages).transform(encode.transform(df))
    made = assembler(vectors + [f"{c}_ind" for c in binned], "_cells").transform(spread.fit(rows.limit(0)).transform(rows))
    sums = made.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"), Summarizer.sum(F.col("_cells")).alias("v"))
    cells = stage(sums.select("label", "rows", F.posexplode(vector_to_array("v")).alias("cell", "n")), "slot-cells")

    # Which slot a cell belongs to: one row for each slot and bin.
    names = [f"{c}={v}" for c, values in order.items() for v in values]
    places = [(i, i, n, True) for i, n in enumerate(names)]
    for k, c in enumerate(numeric):
        for _ in range(len(cuts[c]) + 1 if cuts.get(c) else 0):
            places.append((len(places), len(names) + k, c, False))
    table = df.sparkSession.createDataFrame(places, "cell int, slot int, name string, alone boolean")
    known = cells.join(F.broadcast(table), "cell")
    # The other side of a category's slot: the label's rows without it.
    absent = known.where("alone").withColumn("n", F.col("rows") - F.col("n")).withColumn("cell", F.lit(-1))
    both = known.unionByName(absent)
    bin_, slot, of_label = Window.partitionBy("slot", "cell"), Window.partitionBy("slot"), Window.partitionBy("slot", "label")
    expected = F.sum("n").over(bin_) * F.sum("n").over(of_label) / F.sum("n").over(slot)
    part = both.withColumn("e", expected).withColumn("x", F.when(F.col("e") > 0, (F.col("n") - F.col("e")) ** 2 / F.col("e")).otherwise(0.0))
    full = F.count_distinct(F.when(F.col("e") > 0, F.col("cell")))
    labels = F.count_distinct(F.when(F.col("e") > 0, F.col("label")))
    return part.groupBy("slot", "name").agg(F.sum("x").alias("statistic"), ((full - 1) * (labels - 1)).alias("dof"))


def select_slots(table: DataFrame, top: int = 50) -> DataFrame:
    """The ``top`` slots of :func:`chi_square_slots`, by statistic per degree of freedom (ties by slot): ``slot, name, rank``."""
    strength = F.coalesce(F.try_divide("statistic", "dof"), F.lit(0.0))
    best = table.select("slot", "name", strength.alias("strength")).orderBy(F.desc("strength"), "slot").limit(top)
    # At most ``top`` rows.
    return best.select("slot", "name", F.row_number().over(Window.orderBy(F.desc("strength"), "slot")).alias("rank"))
