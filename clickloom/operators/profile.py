"""Profiles of categorical and numeric columns. Nothing but finished, small reports leaves the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import is_missing
from clickloom.operators.ordered import bucketed, exact_quantiles
from clickloom.schema import LABEL
from clickloom.sources.tables import stage

# Count limits of the categorical profile.
COUNT_LIMITS = (10, 100, 1000)


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def melt(df: DataFrame, ids: list[str], columns: list[str], variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long: one row per input row and column."""
    return df.select(*ids, *columns).unpivot(ids, columns, variable, value)


def category_frequency(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count of every category of every column in one scan: ``feature, value, n``.

    Counting starts on the map side, so a category with a third of all rows costs one shuffled row per task.
    """
    return melt(df, [], columns, "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_negatives(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0).select(column).distinct()


def categorical_profile(counts: DataFrame) -> DataFrame:
    """Per feature: categories ('' is one), blank rows, categories seen once, and below each limit (cumulative)."""
    below = [F.count_if(F.col("n") < limit).alias(f"n_count_lt_{limit}") for limit in COUNT_LIMITS]
    return counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_unique"),
        F.sum(F.when(F.col("value") == "", F.col("n")).otherwise(0)).alias("n_empty"),
        F.count_if(F.col("n") == 1).alias("n_count_eq_1"),
        *below,
    )


def folding_profile(raw_counts: DataFrame, folded_counts: DataFrame, rare_token: str) -> DataFrame:
    """Per feature: categories before and after folding and the kept ones, whose number the folding rule bounds."""
    before = raw_counts.groupBy("feature").agg(F.count(F.lit(1)).alias("n_before"))
    kept = F.sort_array(F.collect_list(F.when(F.col("value") != rare_token, F.col("value"))))
    after = folded_counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_after"), F.array_join(kept, ",").alias("kept")
    )
    return before.join(after, "feature")


def rotate(one_row: DataFrame, rows: list[Column]) -> DataFrame:
    """A one-row aggregate turned into one row per struct of ``rows``."""
    return one_row.select(F.inline(F.array(*rows)))


def numeric_describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample standard deviation, min and max of each column, in one pass without a shuffle of rows."""
    measures = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[f(c).alias(f"{c}:{m}") for c in columns for m, f in measures.items()])
    return rotate(
        wide,
        [
            F.struct(F.lit(c).alias("feature"), *[F.col(f"`{c}:{m}`").alias(m) for m in measures])
            for c in columns
        ],
    )


def null_audit(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL or NaN values per column, in one pass."""
    columns = columns or df.columns
    wide = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns])
    return rotate(wide, [F.struct(F.lit(c).alias("feature"), F.col(c).alias("n_missing")) for c in columns])


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlations of all column pairs, ``feature_a, feature_b, corr``, both directions, in one pass over the rows.

    A pair takes the rows that have both values; a column without spread has a NULL correlation.
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}:{b}") for a, b in pairs])
    at = {**{(b, a): f"{a}:{b}" for a, b in pairs}, **{(a, b): f"{a}:{b}" for a, b in pairs}}
    return rotate(
        wide,
        [
            F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{at[a, b]}`").alias("corr"))
            for a in columns
            for b in columns
        ],
    )


def boxplot_stats(df: DataFrame, columns: list[str], label: str = LABEL, whisker: float = 1.5) -> DataFrame:
    """Exact quartiles, whiskers and outlier count of each column per label.

    Rows are first reduced to counts per distinct value; quartiles are then found by slices of the value range, so no
    task sorts a whole column.
    """
    keys = ["feature", label]
    counts = (
        melt(df, [label], columns, "feature", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counts = stage(counts, "value-counts")
    quartiles = exact_quantiles(bucketed(counts, "value"), keys, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    # One row of quartiles per column and label.
    return (
        counts.join(F.broadcast(quartiles), keys)
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.first("q1").alias("q1"),
            F.first("median").alias("median"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
        )
    )


# -- profiles that merge --------------------------------------------------------------------------------------------
#
# The state of one part of the rows, such as a day's file, is one row of numbers and sketches. States are stored and merged without
# reading the rows again. Counts, sums and extremes are exact. Estimates of distinct values have a relative standard error of about
# 1.04 / sqrt(2 ** DISTINCT_BITS), 1.6 %; quantiles lie within about QUANTILE_ERROR of their rank; counts of frequent values miss less
# than 1 / TOP_TRACKED of the rows in total.

DISTINCT_BITS = 12
QUANTILE_K = 400
QUANTILE_ERROR = 0.01
TOP_TRACKED = 10_000


def profile_state(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """The state of the rows of ``df``: one row, to be stored with those of other parts (all with the same columns)."""
    parts = [F.count(F.lit(1)).alias("n")]
    for c in numeric:
        x = F.col(c).cast("double")
        parts += [F.count(c).alias(f"{c}:n"), F.sum(x).alias(f"{c}:sum"), F.sum(x * x).alias(f"{c}:squares"), F.min(x).alias(f"{c}:min"), F.max(x).alias(f"{c}:max")]
        parts.append(F.kll_sketch_agg_double(x, F.lit(QUANTILE_K)).alias(f"{c}:quantiles"))
    for c in categorical:
        parts += [F.count(c).alias(f"{c}:n"), F.count_if(F.col(c) == "").alias(f"{c}:blank"), F.hll_sketch_agg(c, DISTINCT_BITS).alias(f"{c}:distinct")]
        parts.append(F.expr(f"approx_top_k_accumulate(`{c}`, {TOP_TRACKED})").alias(f"{c}:top"))
    return df.agg(*parts)


def merge_states(states: DataFrame) -> DataFrame:
    """The state of all parts together, one row."""
    how = {"min": F.min, "max": F.max, "quantiles": F.kll_merge_agg_double, "distinct": F.hll_union_agg}
    how["top"] = lambda c: F.expr(f"approx_top_k_combine({c}, {TOP_TRACKED})")
    return states.agg(*[how.get(c.partition(":")[2], F.sum)(f"`{c}`").alias(c) for c in states.columns])


def numeric_from_state(state: DataFrame, numeric: list[str]) -> DataFrame:
    """``feature, n, n_missing, mean, stddev, min, max, q1, median, q3`` of a merged state."""
    rows = []
    for c in numeric:
        at = lambda m, c=c: F.col(f"`{c}:{m}`")
        spread = at("squares") - at("sum") * at("sum") / at("n")
        rows.append(
            F.struct(
                F.lit(c).alias("feature"), at("n").alias("n"), (F.col("n") - at("n")).alias("n_missing"), F.try_divide(at("sum"), at("n")).alias("mean"),
                F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), at("n") - 1)).alias("stddev"), at("min").alias("min"), at("max").alias("max"),
                *[F.when(at("n") > 0, F.kll_sketch_get_quantile_double(at("quantiles"), F.lit(p))).alias(q) for q, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))],
            )
        )
    return rotate(state, rows)


def categorical_from_state(state: DataFrame, categorical: list[str], top: int = 5) -> DataFrame:
    """``feature, n, n_missing, n_blank, n_unique`` (an estimate) and ``top``, the most frequent values with their counts."""
    rows = []
    for c in categorical:
        at = lambda m, c=c: F.col(f"`{c}:{m}`")
        rows.append(
            F.struct(
                F.lit(c).alias("feature"), at("n").alias("n"), (F.col("n") - at("n")).alias("n_missing"), at("blank").alias("n_blank"),
                F.hll_sketch_estimate(at("distinct")).alias("n_unique"), F.expr(f"approx_top_k_estimate(`{c}:top`, {top})").alias("top"),
            )
        )
    return rotate(state, rows)
