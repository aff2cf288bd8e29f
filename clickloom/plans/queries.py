"""Named queries over the training view. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import schema
from clickloom.functions import hash_bucket, round6, z_score
from clickloom.operators import cleaning, descent, encoding, evaluate, explain, models, profile, sampling, tuning
from clickloom.plans import flows
from clickloom.sources import click_log, tables
from clickloom.sources.training_view import CATEGORICAL, KEY, NUMERIC, training_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Two scorers with fixed weights (bias first), so that metrics can be checked in SQL without training.
SCORER_A = (["c01", "c03", "c05"], [-2.2, 0.05, 0.00002, 2.0])
SCORER_B = (["c01", "c04"], [-1.5, 0.02, 0.01])
TOY_FEATURES = ["c01_ts", "b03_t1"]
TOY_WEIGHTS = [-1.0, 0.5, -0.1]
TRACE_STEPS = 10
SAMPLE_SHARE = 0.1
SCORE_DIGITS = 9
# The inputs have two decimals, so a mean has many exact ties at six.
DESCRIBE_DIGITS = 4
SMALL_BROADCAST = 50
DEFAULT_THRESHOLD = 0.5
UNSEEN = "never seen"
# Bias, then one weight for each mean and number.
CHAIN_WEIGHTS = [-1.1] + [round(0.05 * (i % 5) - 0.1, 2) for i in range(len(CATEGORICAL) + len(NUMERIC))]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: round6(f"`{c}`") for c in columns})


# -- shared inputs --------------------------------------------------------------------------------------------------


def stored_view(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The training view, or some of its columns in any order of rows, written once, for flows that pass over it several times."""
    view = training_view(spark, sf_dir, True).select(*columns) if columns else training_view(spark, sf_dir)
    return tables.stage(view, "training-view")


def scored(spark: SparkSession, sf_dir: str, scorer=SCORER_A) -> DataFrame:
    return _scored(sampling.assign_split(training_view(spark, sf_dir), KEY), scorer, [KEY, "data", "label"])


def _scored(rows: DataFrame, scorer, keep: list[str]) -> DataFrame:
    features, weights = scorer
    rows = descent.logistic_score(rows, weights, features)
    # Engines differ in the last bit of exp, which would make and break ties between scores.
    return rows.select(*keep, F.round("probability", SCORE_DIGITS).alias("probability"), "prediction")


def reports(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Reports of both scorers by name. The joins of the view run once: what the scorers take is stored, without the key."""
    scorers = {"A": SCORER_A, "B": SCORER_B}
    taken = sorted({c for features, _ in scorers.values() for c in features})
    rows = sampling.assign_split(training_view(spark, sf_dir), KEY).select("data", "label", *taken)
    rows = tables.stage(rows, "scorer-rows")
    return {name: evaluate.evaluation_report(_scored(rows, s, ["data", "label"]), name) for name, s in scorers.items()}


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.impute_blank(training_view(spark, sf_dir), CATEGORICAL)


def folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaning.impute_blank(stored_view(spark, sf_dir), CATEGORICAL)
    counts = tables.stage(cleaning.frequent_counts(rows, CATEGORICAL), "category-counts")
    return cleaning.fit_folding(counts, CATEGORICAL).apply(rows)


def raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and positives of every category, counted once from the view; profiles and folding follow from it."""
    counts = encoding.target_means(training_view(spark, sf_dir), CATEGORICAL).drop("mean")
    return tables.stage(counts, "category-counts")


def frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts of the filled categories that folding keeps, the others summed: long columns are not counted in full."""
    rows = cleaning.impute_blank(stored_view(spark, sf_dir), CATEGORICAL)
    return tables.stage(cleaning.frequent_counts(rows, CATEGORICAL), "category-counts")


def folded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = frequent(spark, sf_dir)
    return cleaning.fold_counts(counts, cleaning.count_threshold(counts))


def merged_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile states of three parts of the rows, each stored for itself, merged."""
    path = tables.stage_path(spark, "profile-states")
    rows = sampling.assign_fold(stored_view(spark, sf_dir), KEY)
    for k in range(3):
        part = rows.where(F.col("fold") == k)
        tables.write_parquet(profile.profile_state(part, NUMERIC, CATEGORICAL), path, mode="append")
    return profile.merge_states(tables.read_parquet(spark, path))


def toy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log1p and z-score of c01, and one category of b03 by equality."""
    rows = training_view(spark, sf_dir).select(KEY, "c01", "b03", "label").withColumn("c01_t", F.log1p("c01"))
    stats = rows.agg(F.avg("c01_t").alias("m"), F.stddev_samp("c01_t").alias("s")).first()
    return rows.withColumns(
        {"c01_ts": z_score("c01_t", stats["m"], stats["s"]), "b03_t1": F.when(F.col("b03") == "O", 1).otherwise(0)}
    )


def onehot(spark: SparkSession, sf_dir: str) -> flows.Prepared:
    return flows.prepare_onehot(stored_view(spark, sf_dir), KEY)


def means(spark: SparkSession, sf_dir: str, fold: bool = True) -> flows.Prepared:
    return flows.prepare_means(stored_view(spark, sf_dir), KEY, fold=fold)


# -- sources and sinks ----------------------------------------------------------------------------------------------


@query
def load_tsv(spark, sf_dir):
    # Whole numbers that are not all zero: hundredths where the column has decimals.
    whole = training_view(spark, sf_dir).drop(KEY).withColumns({c: F.round(F.col(c) * 100) for c in NUMERIC})
    path = tables.stage_path(spark, "click-log")
    click_log.write_click_log(whole, path)
    return click_log.read_click_log(spark, path, numeric=len(NUMERIC), categorical=len(CATEGORICAL))


@query
def sql_view(spark, sf_dir):
    tables.register_view(training_view(spark, sf_dir), "training_rows")
    return spark.sql(
        "SELECT b02, label, count(*) AS n, round(avg(c02), 6) AS mean_c02 FROM training_rows GROUP BY b02, label"
    )


@query
def parquet_roundtrip(spark, sf_dir):
    path = tables.stage_path(spark, "roundtrip")
    tables.write_parquet(training_view(spark, sf_dir), path)
    return tables.read_parquet(spark, path).groupBy("b01", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c01").alias("sum_c01"), F.min("c02").alias("min_c02"), F.max("rk").alias("max_rk")
    )


@query
def csv_roundtrip(spark, sf_dir):
    rows = training_view(spark, sf_dir).select("label", "c01", "c02", "b02", "b04")
    path = tables.stage_path(spark, "csv")
    tables.write_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema).groupBy("b02", "b04", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("c01").alias("sum_c01"), F.max("c02").alias("max_c02")
    )


@query
def column_roles(spark, sf_dir):
    return schema.column_roles(training_view(spark, sf_dir), KEY)


# -- samples and splits ---------------------------------------------------------------------------------------------


@query
def sample_fraction(spark, sf_dir):
    return sampling.sample_fraction(training_view(spark, sf_dir), SAMPLE_SHARE)


@query
def sample_hash(spark, sf_dir):
    return sampling.sample_hash(training_view(spark, sf_dir), KEY, SAMPLE_SHARE).select(KEY, "label", "c01", "b01")


@query
def random_split(spark, sf_dir):
    train, test = sampling.random_split(stored_view(spark, sf_dir))
    parts = train.withColumn("data", F.lit("Train")).unionByName(test.withColumn("data", F.lit("Test")))
    return sampling.count_parts(parts, "data")


@query
def train_test_split(spark, sf_dir):
    return sampling.assign_split(training_view(spark, sf_dir), KEY).select(KEY, "data")


@query
def kfold_assign(spark, sf_dir):
    return sampling.assign_fold(training_view(spark, sf_dir), KEY).select(KEY, "fold")


@query
def split_counts(spark, sf_dir):
    return sampling.count_parts(sampling.assign_split(training_view(spark, sf_dir), KEY), "data")


@query
def limit_rows(spark, sf_dir):
    return sampling.first_n(training_view(spark, sf_dir), KEY, 100).select(KEY, "c01", "b03", "label")


@query
def sample_n(spark, sf_dir):
    return sampling.sample_n(training_view(spark, sf_dir), KEY, 1000).select(KEY, *NUMERIC, "label")


@query
def top_k_rows(spark, sf_dir):
    rows = rounded(toy(spark, sf_dir).select(*TOY_FEATURES, "label"), "c01_ts")
    return sampling.top_k(rows, [*TOY_FEATURES, "label"], 5)


# -- profiles -------------------------------------------------------------------------------------------------------


@query
def label_distribution(spark, sf_dir):
    return profile.label_distribution(training_view(spark, sf_dir))


@query
def category_frequency(spark, sf_dir):
    return profile.category_frequency(training_view(spark, sf_dir), CATEGORICAL)


@query
def categorical_profile(spark, sf_dir):
    return profile.categorical_profile(profile.category_frequency(training_view(spark, sf_dir), CATEGORICAL))


@query
def kept_categories(spark, sf_dir):
    counts = frequent(spark, sf_dir)
    kept = cleaning.kept_categories(counts, cleaning.count_threshold(counts)).where(F.col("value") != cleaning.RARE_TOKEN)
    return kept.select("feature", "value", "n")


@query
def folding_profile(spark, sf_dir):
    raw = raw_counts(spark, sf_dir)
    counts = cleaning.fill_counts(raw, CATEGORICAL)
    after = cleaning.fold_counts(counts, cleaning.count_threshold(counts))
    return profile.folding_profile(raw, after, cleaning.RARE_TOKEN)


@query
def feature_space_size(spark, sf_dir):
    """Categories after folding, numerics, and the length of the vector they make, which must be the sum of both."""
    counts = folded_counts(spark, sf_dir)
    order = encoding.category_order(counts, CATEGORICAL)
    rows = training_view(spark, sf_dir)
    encode, vectors = encoding.one_hot_from_order(rows, order)
    vector = encoding.assembler(vectors + NUMERIC).transform(encode.transform(rows.limit(0)))
    return counts.agg(F.count(F.lit(1)).alias("n_categories")).select(
        "n_categories",
        F.lit(len(NUMERIC)).alias("n_numeric"),
        F.lit(len(encoding.vector_names(vector))).alias("vector_size"),
    )


@query
def numeric_describe(spark, sf_dir):
    described = profile.numeric_describe(training_view(spark, sf_dir), NUMERIC)
    return described.withColumns({c: F.round(c, DESCRIBE_DIGITS) for c in ("mean", "stddev")})


@query
def merged_numeric_profile(spark, sf_dir):
    """Exact columns of the merged numeric profile."""
    found = profile.numeric_from_state(merged_state(spark, sf_dir), NUMERIC)
    return found.select("feature", "n", "n_missing", *[F.round(c, DESCRIBE_DIGITS).alias(c) for c in ("mean", "stddev")], "min", "max")


@query
def merged_quantiles(spark, sf_dir):
    """Quartiles from merged sketches, within ``profile.QUANTILE_ERROR`` of their rank."""
    return profile.numeric_from_state(merged_state(spark, sf_dir), NUMERIC).select("feature", "q1", "median", "q3")


@query
def merged_categorical_profile(spark, sf_dir):
    """Blank rows (exact), distinct values (estimated) and the most frequent values, from merged states."""
    return profile.categorical_from_state(merged_state(spark, sf_dir), CATEGORICAL)


@query
def null_audit(spark, sf_dir):
    return profile.null_audit(training_view(spark, sf_dir))


@query
def null_audit_encoded(spark, sf_dir):
    encoded, _, _ = flows.encode_means(stored_view(spark, sf_dir), KEY)
    return profile.null_audit(encoded)


@query
def distinct_values(spark, sf_dir):
    return profile.distinct_values(training_view(spark, sf_dir), "b05")


@query
def distinct_negatives(spark, sf_dir):
    return profile.distinct_negatives(training_view(spark, sf_dir), "c03")


@query
def correlation_matrix(spark, sf_dir):
    return rounded(profile.correlation_matrix(training_view(spark, sf_dir), [*NUMERIC, "label"]), "corr")


@query
def boxplot_stats(spark, sf_dir):
    stats = profile.boxplot_stats(training_view(spark, sf_dir), NUMERIC)
    return rounded(stats, "q1", "median", "q3", "whisker_low", "whisker_high")


@query
def melt_numeric(spark, sf_dir):
    return profile.melt(training_view(spark, sf_dir), ["label"], NUMERIC)


# -- cleaning and encoding ------------------------------------------------------------------------------------------


@query
def impute_blank(spark, sf_dir):
    return filled(spark, sf_dir).select(KEY, *CATEGORICAL)


@query
def impute_rare(spark, sf_dir):
    return folded(spark, sf_dir).select(KEY, *CATEGORICAL)


@query
def log_transform(spark, sf_dir):
    rows = cleaning.log_transform(training_view(spark, sf_dir).select(KEY, *NUMERIC), NUMERIC)
    return rounded(rows, *NUMERIC)


@query
def toy_features(spark, sf_dir):
    return rounded(toy(spark, sf_dir).select(KEY, "c01_t", *TOY_FEATURES), "c01_t", "c01_ts")


@query
def string_index(spark, sf_dir):
    rows = folded(spark, sf_dir)
    return encoding.index_table(rows, CATEGORICAL, encoding.string_indexer(CATEGORICAL).fit(rows))


def _one_hot(spark, sf_dir, drop_last):
    rows = folded(spark, sf_dir).select(CATEGORICAL)
    encode, columns = encoding.fit_one_hot(rows, CATEGORICAL, drop_last)
    vectors = encoding.assembler(columns).transform(encode.transform(rows))
    names = spark.createDataFrame(list(enumerate(encoding.vector_names(vectors))), "slot int, name string")
    return encoding.slot_sums(vectors, encoding.FEATURES).join(names, "slot").select(
        "slot", "name", F.col("total").cast("bigint").alias("n_rows")
    )


@query
def one_hot(spark, sf_dir):
    return _one_hot(spark, sf_dir, drop_last=False)


@query
def one_hot_drop_last(spark, sf_dir):
    return _one_hot(spark, sf_dir, drop_last=True)


@query
def assemble_features(spark, sf_dir):
    rows = cleaning.log_transform(folded(spark, sf_dir), NUMERIC)
    encode, columns = encoding.fit_one_hot(rows, CATEGORICAL)
    vectors = encoding.assembler(columns + NUMERIC).transform(encode.transform(rows))
    vectors = vectors.select(KEY, vector_to_array("features").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x)
    return vectors.select(KEY, F.size("v").alias("n_slots"), round6(total).alias("total"))


@query
def standardize(spark, sf_dir):
    rows = encoding.assembler(NUMERIC).transform(stored_view(spark, sf_dir).select(KEY, *NUMERIC))
    scaled = encoding.scaler().fit(rows).transform(rows).select(KEY, vector_to_array(encoding.SELECTED).alias("z"))
    return scaled.select(KEY, *[round6(F.col("z")[i]).alias(c) for i, c in enumerate(NUMERIC)])


@query
def features_onehot(spark, sf_dir):
    return _scaler_table(spark, onehot(spark, sf_dir))


@query
def features_mean(spark, sf_dir):
    return _scaler_table(spark, means(spark, sf_dir))


def _scaler_table(spark, prepared: flows.Prepared) -> DataFrame:
    """What the standardiser learned from the training part, per vector slot."""
    fitted = prepared.features.model.stages[-1]
    rows = [
        (i, n, float(m), float(s))
        for i, (n, m, s) in enumerate(zip(prepared.features.names, fitted.mean.toArray(), fitted.std.toArray(), strict=True))
    ]
    return rounded(spark.createDataFrame(rows, "slot int, name string, mean double, stddev double"), "mean", "stddev")


@query
def target_means(spark, sf_dir):
    rows = encoding.target_means(training_view(spark, sf_dir), CATEGORICAL)
    return rounded(rows, "mean")


def _encoded(spark, sf_dir, part, fold=True, **options):
    rows, _, encoder = flows.encode_means(stored_view(spark, sf_dir, [KEY, "label", *CATEGORICAL]), KEY, fold=fold, **options)
    columns = [c + encoding.MEAN_SUFFIX for c in encoder.columns]
    rows = rows if part is None else rows.where(F.col(flows.PART) == part)
    return rounded(rows.select(KEY, "label", *columns), *columns)


@query
def target_mean_encode(spark, sf_dir):
    return _encoded(spark, sf_dir, "Train")


@query
def target_mean_encode_test(spark, sf_dir):
    return _encoded(spark, sf_dir, "Test")


@query
def target_mean_encode_raw(spark, sf_dir):
    return _encoded(spark, sf_dir, None, fold=False)


@query
def target_mean_encode_shuffled(spark, sf_dir):
    """The raw encoding with a low broadcast limit, so that long category tables go through the skew-safe shuffle."""
    return _encoded(spark, sf_dir, None, fold=False, broadcast_rows=SMALL_BROADCAST)


def unseen_third(rows: DataFrame) -> DataFrame:
    """Rows of which a third have one value of b08 that no training row has, and another third of b07."""
    third = hash_bucket(KEY, 3, salt="u|")
    return rows.withColumns({"b08": F.when(third == 0, UNSEEN).otherwise(F.col("b08")), "b07": F.when(third == 1, UNSEEN).otherwise(F.col("b07"))})


@query
def target_mean_encode_unseen(spark, sf_dir):
    """Raw means of the training part on rows whose most frequent value is not in it, through the shuffle."""
    rows = sampling.assign_split(stored_view(spark, sf_dir, [KEY, "label", *CATEGORICAL]), KEY, column=flows.PART)
    encoder = encoding.fit_target_means(rows.where(F.col(flows.PART) == "Train"), CATEGORICAL)
    columns = [c + encoding.MEAN_SUFFIX for c in CATEGORICAL]
    return rounded(encoder.apply(unseen_third(rows).select(KEY, *CATEGORICAL), broadcast_rows=SMALL_BROADCAST).select(KEY, *columns), *columns)


@query
def string_index_long(spark, sf_dir):
    """The index of all categories as they are, no list of them on the driver."""
    return encoding.long_index(raw_counts(spark, sf_dir)).select("feature", "value", "n", "slot")


@query
def one_hot_long(spark, sf_dir):
    """Rows in each slot of sparse vectors of two unfolded columns. The joins of the view run once, and both vectors are summed in one pass."""
    columns = ["b07", "b08"]
    view = tables.stage(training_view(spark, sf_dir).select(KEY, "label", *columns), "training-view")
    counts = tables.stage(encoding.target_means(view, columns).drop("mean"), "category-counts")
    index = tables.stage(encoding.long_index(counts), "long-index")
    rows, vectors = encoding.one_hot_long(view.select(KEY, *columns), columns, index, broadcast_rows=SMALL_BROADCAST)
    column = F.create_map(*[F.lit(x) for c, v in zip(columns, vectors) for x in (v, c)])
    sums = encoding.sparse_slot_sums(rows, vectors).select(column[F.col("vector")].alias("feature"), F.col("slot").cast("bigint").alias("slot"), "total")
    # A slot without an entry, such as that of NULL, is in the index alone.
    totals = index.drop("n").join(sums, ["feature", "slot"], "left")
    return totals.select("feature", "slot", "value", F.coalesce(F.col("total").cast("bigint"), F.lit(0)).alias("n_rows"))


@query
def target_mean_encode_loo(spark, sf_dir):
    """Training rows with the mean of the other rows of their category; the mean of all rows where there is no other."""
    rows = sampling.assign_split(stored_view(spark, sf_dir), KEY, column=flows.PART).where(F.col(flows.PART) == "Train")
    encoder = encoding.fit_target_means(rows, CATEGORICAL, fill=encoding.GLOBAL_MEAN)
    columns = [c + encoding.MEAN_SUFFIX for c in CATEGORICAL]
    return rounded(encoder.apply_leave_one_out(rows).select(KEY, "label", *columns), *columns)


@query
def chi_square_table(spark, sf_dir):
    table = encoding.chi_square_table(folded_counts(spark, sf_dir))
    return rounded(table, "statistic")


@query
def chi_square_select(spark, sf_dir):
    return encoding.select_by_chi_square(encoding.chi_square_table(folded_counts(spark, sf_dir)), top=4)


@query
def chi_square_slots(spark, sf_dir):
    return rounded(flows.slot_table(stored_view(spark, sf_dir), KEY), "statistic")


@query
def chi_square_select_slots(spark, sf_dir):
    """The 50 slots of the one-hot features that the label depends on most."""
    return encoding.select_slots(flows.slot_table(stored_view(spark, sf_dir), KEY), top=50)


@query
def slice_features(spark, sf_dir):
    prepared = onehot(spark, sf_dir)
    tree = models.train("decision_tree", prepared.train)
    sliced = encoding.slicer(explain.split_slots(tree, prepared.train)).transform(prepared.rows)
    return sliced.select(KEY, "data", vector_to_array("sliced_features").alias("sliced_features"))


# -- gradient descent and fixed scorers -----------------------------------------------------------------------------


@query
def gd_loss(spark, sf_dir):
    return rounded(descent.loss(toy(spark, sf_dir), TOY_WEIGHTS, TOY_FEATURES), "loss")


@query
def gd_step(spark, sf_dir):
    return rounded(descent.step(toy(spark, sf_dir), [0.0, 0.0, 0.0], TOY_FEATURES), "weight")


@query
def gd_trace(spark, sf_dir):
    rows = toy(spark, sf_dir)
    _, trace = descent.descend(rows, TOY_FEATURES, steps=TRACE_STEPS)
    return rounded(descent.trace_table(rows, trace), "loss", "w0", "w1", "w2")


@query
def gd_trace_vectors(spark, sf_dir):
    """The trace of ``gd_trace`` by sums of weighted vectors."""
    rows = encoding.assembler(TOY_FEATURES).transform(toy(spark, sf_dir))
    _, trace = descent.descend_vectors(rows, encoding.FEATURES, len(TOY_FEATURES), steps=TRACE_STEPS)
    return rounded(descent.trace_table(rows, trace), "loss", "w0", "w1", "w2")


@query
def descent_onehot(spark, sf_dir):
    """Own descent, all steps, on the sparse one-hot vectors, next to a logistic regression without penalty."""
    prepared = onehot(spark, sf_dir)
    weights, _ = descent.descend_vectors(prepared.train, encoding.SELECTED, prepared.features.size, centre=True)
    model = models.train("logistic", prepared.train, maxIter=100)
    own = descent.vector_score(prepared.rows, weights, encoding.SELECTED)
    return evaluate.prediction_agreement(own, models.score_batch(model, prepared.rows), KEY)


@query
def logistic_score(spark, sf_dir):
    return scored(spark, sf_dir).select(KEY, "probability", "prediction")


@query
def descent_against_logistic(spark, sf_dir):
    """Own gradient descent, all steps, next to an unregularised logistic regression on the same rows."""
    rows = tables.stage(toy(spark, sf_dir), "toy")
    weights, _ = descent.descend(rows, TOY_FEATURES)
    vectors = encoding.assembler(TOY_FEATURES).transform(rows)
    model = models.train("logistic", vectors, features="features", maxIter=100)
    own = descent.logistic_score(rows, weights, TOY_FEATURES)
    return evaluate.prediction_agreement(own, models.score_batch(model, vectors), KEY)


# -- evaluation -----------------------------------------------------------------------------------------------------


@query
def log_loss(spark, sf_dir):
    return rounded(evaluate.log_loss(scored(spark, sf_dir), ["data"]), "log_loss")


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion_matrix(scored(spark, sf_dir), ["data"])


@query
def confusion_table(spark, sf_dir):
    return evaluate.confusion_table(evaluate.confusion_matrix(scored(spark, sf_dir)))


@query
def f1_metrics(spark, sf_dir):
    table = evaluate.f1_metrics(evaluate.confusion_matrix(scored(spark, sf_dir), ["data"]), ["data"])
    return rounded(table, "accuracy", "precision", "recall", "f1")


@query
def auc_roc(spark, sf_dir):
    return rounded(evaluate.auc_roc(scored(spark, sf_dir), ["data"]), "auc")


@query
def roc_curve(spark, sf_dir):
    return rounded(evaluate.roc_curve(scored(spark, sf_dir)), "FPR", "TPR")


@query
def f_by_threshold(spark, sf_dir):
    return rounded(evaluate.f_by_threshold(scored(spark, sf_dir)), "F-Measure")


@query
def best_threshold(spark, sf_dir):
    train = scored(spark, sf_dir).where("data = 'Train'")
    return rounded(evaluate.best_threshold(evaluate.f_by_threshold(train)), "f_measure")


@query
def threshold_effect(spark, sf_dir):
    rows = scored(spark, sf_dir)
    best = evaluate.best_threshold(evaluate.f_by_threshold(rows.where("data = 'Train'"))).first()["threshold"]
    table = evaluate.threshold_effect(rows, [DEFAULT_THRESHOLD, best], ["data"])
    return rounded(table, "accuracy", "precision", "recall", "f1")


@query
def evaluation_report(spark, sf_dir):
    return evaluate.evaluation_report(scored(spark, sf_dir), "A")


@query
def model_comparison(spark, sf_dir):
    return evaluate.model_comparison(list(reports(spark, sf_dir).values()))


@query
def prediction_agreement(spark, sf_dir):
    a, b = scored(spark, sf_dir, SCORER_A), scored(spark, sf_dir, SCORER_B)
    return rounded(evaluate.prediction_agreement(a, b, KEY), "corr", "max_abs_diff")


# -- training -------------------------------------------------------------------------------------------------------


@query
def train_logistic(spark, sf_dir):
    return flows.train_and_report("logistic", onehot(spark, sf_dir), "LR", **models.FULL_LOGISTIC)[1]


@query
def train_logistic_mean(spark, sf_dir):
    return flows.train_and_report("logistic", means(spark, sf_dir), "LR+BM", **models.FULL_LOGISTIC)[1]


@query
def train_decision_tree(spark, sf_dir):
    return flows.train_and_report("decision_tree", onehot(spark, sf_dir), "DT")[1]


@query
def train_gbt(spark, sf_dir):
    return flows.train_and_report("gbt", means(spark, sf_dir), "GBT+BM")[1]


@query
def train_random_forest(spark, sf_dir):
    return flows.train_and_report("random_forest", means(spark, sf_dir), "RF")[1]


@query
def train_linear_svc(spark, sf_dir):
    return flows.train_and_report("linear_svc", onehot(spark, sf_dir), "SVM")[1]


@query
def train_comparison(spark, sf_dir):
    """One-hot, and the four variants of logistic model and boosted trees on target means, folded and raw."""
    view = stored_view(spark, sf_dir)
    folded_means, raw_means = flows.prepare_means(view, KEY), flows.prepare_means(view, KEY, fold=False)
    runs = [
        ("logistic", flows.prepare_onehot(view, KEY), "LR"),
        ("logistic", folded_means, "LR+BM"),
        ("logistic", raw_means, "LR+BM Raw"),
        ("gbt", folded_means, "GBT+BM"),
        ("gbt", raw_means, "GBT+BM Raw"),
    ]
    return evaluate.model_comparison([flows.train_and_report(k, p, n)[1] for k, p, n in runs])


@query
def train_gbt_onehot(spark, sf_dir):
    """The published run with the best result: one-hot and numeric features, 50 boosting steps."""
    return flows.train_and_report("gbt", onehot(spark, sf_dir), "GBT", **models.FULL_GBT)[1]


@query
def train_selected(spark, sf_dir):
    """A logistic model on the 50 one-hot slots chosen by chi-square."""
    return flows.train_and_report("logistic", flows.prepare_selected(stored_view(spark, sf_dir), KEY), "LR+Chi2")[1]


@query
def train_sliced(spark, sf_dir):
    """Tree and logistic model on the vector slots that a first tree uses."""
    prepared = onehot(spark, sf_dir)
    tree = models.train("decision_tree", prepared.train)
    narrow = flows.sliced(prepared, explain.split_slots(tree, prepared.train))
    return evaluate.model_comparison(
        [
            flows.report(tree, prepared, "DT"),
            flows.train_and_report("decision_tree", narrow, "DT+S")[1],
            flows.train_and_report("logistic", narrow, "LR+S")[1],
        ]
    )


def stored_chain(spark, chain: flows.ScoringChain) -> flows.ScoringChain:
    """The chain as it comes back from its folder."""
    path = tables.stage_path(spark, "scoring-chain")
    chain.save(path)
    return flows.ScoringChain.load(spark, path)


@query
def score_batch(spark, sf_dir):
    """All rows, scored raw by a stored and loaded preparation and model."""
    view = stored_view(spark, sf_dir)
    prepared = flows.prepare_means(view, KEY)
    chain = stored_chain(spark, flows.ScoringChain(prepared, models.train("logistic", prepared.train)))
    rows = sampling.assign_split(view, KEY, column=flows.PART)
    scores = chain.score(rows, [KEY, flows.PART, "label"])
    return scores.select(KEY, flows.PART, "label", round6(vector_to_array("probability")[1]).alias("probability"), "prediction")


@query
def score_batch_weights(spark, sf_dir):
    """The same with fixed weights on the standardised means and numbers."""
    view = stored_view(spark, sf_dir)
    chain = stored_chain(spark, flows.ScoringChain(flows.prepare_means(view, KEY), weights=CHAIN_WEIGHTS))
    rows = sampling.assign_split(view, KEY, column=flows.PART)
    return rounded(chain.score(rows, [KEY, flows.PART, "label"]), "probability").select(KEY, flows.PART, "label", "probability")


@query
def report_runs(spark, sf_dir):
    """Reports of two scorers added to one folder as runs, the first one twice."""
    path = tables.stage_path(spark, "reports")
    made = reports(spark, sf_dir)
    for name in ("A", "B", "A"):
        tables.append_run(made[name], path, f"run-{name}")
    return tables.read_runs(spark, path, made["A"].schema)


@query
def score_new_rows(spark, sf_dir):
    """A preparation fitted on the training part, stored, loaded and applied to all rows: every standardised feature."""
    path = tables.stage_path(spark, "preparation")
    view = stored_view(spark, sf_dir)
    flows.prepare_means(view, KEY).save(path)
    loaded = flows.Prepared.load(spark, path)
    rows = sampling.assign_split(view, KEY, column=flows.PART)
    ready = loaded.apply(rows, [KEY, flows.PART]).withColumn("z", vector_to_array(encoding.SELECTED))
    return ready.select(KEY, flows.PART, *[round6(F.col("z")[i]).alias(f"z_{n}") for i, n in enumerate(loaded.features.names)])


@query
def feature_importance(spark, sf_dir):
    prepared = onehot(spark, sf_dir)
    tree = models.train("decision_tree", prepared.train)
    return explain.feature_importance(spark, tree, prepared.features.names)


@query
def feature_importance_top(spark, sf_dir):
    return explain.top_features(feature_importance(spark, sf_dir))


@query
def coefficients(spark, sf_dir):
    prepared = onehot(spark, sf_dir)
    model = models.train("logistic", prepared.train)
    return explain.coefficients(spark, model, prepared.features.names)


@query
def training_history(spark, sf_dir):
    prepared = means(spark, sf_dir)
    return explain.training_history(spark, models.train("logistic", prepared.train))


def _tree_search(spark, sf_dir):
    prepared = means(spark, sf_dir)
    prepared.rows = sampling.assign_fold(prepared.rows, KEY)
    found, best, report = flows.grid_search("decision_tree", prepared, "DT+CV", fold_col="fold")
    return prepared, found, best, report


@query
def cross_validate(spark, sf_dir):
    return _tree_search(spark, sf_dir)[3]


@query
def cross_validate_sliced(spark, sf_dir):
    """The tree grid on the vector slots that a first tree uses."""
    prepared = onehot(spark, sf_dir)
    tree = models.train("decision_tree", prepared.train)
    narrow = flows.sliced(prepared, explain.split_slots(tree, prepared.train))
    narrow.rows = sampling.assign_fold(narrow.rows, KEY)
    return flows.grid_search("decision_tree", narrow, "DT+S+CV", grid="decision_tree_sliced", fold_col="fold")[2]


@query
def cross_validate_gbt(spark, sf_dir):
    prepared = means(spark, sf_dir)
    prepared.rows = sampling.assign_fold(prepared.rows, KEY)
    return flows.grid_search("gbt", prepared, "GBT+CV", fold_col="fold")[2]


@query
def cross_validate_logistic(spark, sf_dir):
    prepared = means(spark, sf_dir)
    prepared.rows = sampling.assign_fold(prepared.rows, KEY)
    return flows.grid_search("logistic", prepared, "LR+CV", fold_col="fold")[2]


@query
def cv_results(spark, sf_dir):
    prepared, found, _, _ = _tree_search(spark, sf_dir)
    return tuning.cv_results(found, tuning.GRIDS["decision_tree"])
