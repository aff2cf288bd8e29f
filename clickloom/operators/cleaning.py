"""Blank fill, rare-category folding and log transform. Applying any of them is a narrow map."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import signed_log
from clickloom.operators.encoding import target_means
from clickloom.operators.lookup import attach
from clickloom.schema import LABEL

# Tokens for blank categories, and for rare or unseen ones.
BLANK_TOKENS = {
    "empty_1": ["b03", "b12", "b16", "b21", "b24"],
    "empty_2": ["b19", "b20", "b25", "b26"],
}
OTHER_BLANK_TOKEN = "empty_0"
RARE_TOKEN = "less_than_1pc"
MIN_FRACTION = 0.01

# Longest list of kept categories per column that goes into the plan as literals.
MAX_LITERALS = 1000
# Name of the note, on a table of counts, of the smallest fraction of the rows for which it is exact.
EXACT_FROM = "exact_from"
# Largest heavy-hitter sketch Spark allows, in items.
MAX_TRACKED = 1_000_000


def blank_token(column: str, tokens: Mapping[str, list[str]] = BLANK_TOKENS) -> str:
    return next((token for token, columns in tokens.items() if column in columns), OTHER_BLANK_TOKEN)


def fill_blank(column: str, tokens: Mapping[str, list[str]] = BLANK_TOKENS) -> Column:
    value = F.col(column)
    return F.when(value != "", value).otherwise(blank_token(column, tokens))


def impute_blank(
    df: DataFrame, columns: list[str], tokens: Mapping[str, list[str]] = BLANK_TOKENS
) -> DataFrame:
    """Blank and NULL become the token of the column's group."""
    return df.withColumns({c: fill_blank(c, tokens) for c in columns})


def log_transform(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: signed_log(c) for c in columns})


# -- folding --------------------------------------------------------------------------------------------------------
#
# Everything below works on a stored table of category counts (``feature, value, n``, maybe ``n_positive``), so that one
# scan of the rows serves folding, indexing and target means alike. Each row of the data counts once per feature.


def frequent_counts(
    df: DataFrame,
    columns: list[str],
    label: str = LABEL,
    min_fraction: float = MIN_FRACTION,
    token: str = RARE_TOKEN,
) -> DataFrame:
    """Counts that are exact for every category with at least ``min_fraction`` of the rows; the rest is summed under
    the rare token. Serves folding by that fraction, or a larger one, as a full count would.

    A full count shuffles almost one row per input row and long-tailed column. Here a first scan keeps a heavy-hitter
    sketch per column, whose error is under a tenth of the fraction, so no such category is missed; a second scan counts
    the few candidates exactly. Sketches are merged in two levels, so that no task takes one from every input split.
    """
    tracked = math.ceil(30 / min_fraction)
    if tracked > MAX_TRACKED:
        return target_means(df, columns, label).drop("mean")
    k = math.ceil(1.5 / min_fraction)
    groups = math.ceil(math.sqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    sketches = df.groupBy((F.spark_partition_id() % groups).alias("_group")).agg(
        *[F.expr(f"approx_top_k_accumulate(`{c}`, {tracked})").alias(c) for c in columns]
    )
    merged = sketches.agg(*[F.expr(f"approx_top_k_combine(`{c}`, {tracked})").alias(c) for c in columns])
    found = merged.select(*[F.expr(f"approx_top_k_estimate(`{c}`, {k})").alias(c) for c in columns]).first()
    candidates = {c: [r["item"] for r in found[c] or [] if r["item"] is not None] for c in columns}
    marked = {c: F.when(F.col(c).isin(v), F.col(c)).otherwise(token) for c, v in candidates.items()}
    counts = target_means(df.select(label, *[e.alias(c) for c, e in marked.items()]), columns, label).drop("mean")
    return counts.withColumn("n", F.col("n").alias("n", metadata={EXACT_FROM: min_fraction}))


def fill_counts(counts: DataFrame, columns: list[str], tokens: Mapping[str, list[str]] = BLANK_TOKENS) -> DataFrame:
    """The counts that blank-filled rows would give."""
    by_feature = F.lit(OTHER_BLANK_TOKEN)
    for token in tokens:
        by_feature = F.when(
            F.col("feature").isin([c for c in columns if blank_token(c, tokens) == token]), F.lit(token)
        ).otherwise(by_feature)
    return _sum_counts(counts, F.when(F.col("value") != "", F.col("value")).otherwise(by_feature))


def fold_counts(counts: DataFrame, threshold: float, token: str = RARE_TOKEN) -> DataFrame:
    """The counts that folded rows would give."""
    return _sum_counts(counts, F.when(F.col("n") >= threshold, F.col("value")).otherwise(token))


def _sum_counts(counts: DataFrame, value: Column) -> DataFrame:
    numbers = [c for c in counts.columns if c in ("n", "n_positive")]
    return counts.groupBy("feature", value.alias("value")).agg(*[F.sum(c).alias(c) for c in numbers])


def count_threshold(
    counts: DataFrame, min_fraction: float | None = MIN_FRACTION, min_count: int | None = None
) -> float:
    """Smallest count of a kept category. An explicit ``min_count`` replaces the fraction of all rows."""
    if min_count is not None:
        return float(min_count)
    total = counts.groupBy("feature").agg(F.sum("n").alias("total")).agg(F.max("total")).first()[0]
    return min_fraction * (total or 0)


def kept_categories(counts: DataFrame, threshold: float) -> DataFrame:
    return counts.where(F.col("n") >= threshold)


@dataclass
class RareFolding:
    """Kept categories per column; everything else becomes the rare token.

    ``kept`` has the columns with a short list, ``large`` the number of kept categories of the others, which stay in
    ``table``.
    """

    kept: dict[str, list[str]]
    large: dict[str, int]
    table: DataFrame
    threshold: float
    token: str = RARE_TOKEN

    def apply(self, df: DataFrame) -> DataFrame:
        df = df.withColumns(
            {c: F.when(F.col(c).isin(v), F.col(c)).otherwise(self.token) for c, v in self.kept.items()}
        )
        for c, rows in self.large.items():
            known = self.table.where(F.col("feature") == c).withColumn("_known", F.lit(True))
            df = attach(df, c, known, {"_known": "_known"}, rows)
            df = df.withColumn(c, F.when(F.col("_known"), F.col(c)).otherwise(self.token)).drop("_known")
        return df


def fit_folding(
    counts: DataFrame,
    columns: list[str],
    min_fraction: float | None = MIN_FRACTION,
    min_count: int | None = None,
    max_literals: int = MAX_LITERALS,
) -> RareFolding:
    """Learn the kept categories from the stored counts of blank-filled rows.

    By fraction, a column keeps at most ``1 / min_fraction`` categories, so the lists are short and ``apply`` needs no
    join. By count the lists may be long; a column with more than ``max_literals`` is looked up by a join instead.
    """
    threshold = count_threshold(counts, min_fraction, min_count)
    exact_from = counts.schema["n"].metadata.get(EXACT_FROM)
    if exact_from is not None and threshold < count_threshold(counts, exact_from) * (1 - 1e-9):
        raise ValueError(f"these counts are exact from a fraction of {exact_from} of the rows only; count again for a lower threshold")
    table = kept_categories(counts, threshold).where(F.col("value") != RARE_TOKEN)
    sizes = {r["feature"]: r["rows"] for r in table.groupBy("feature").agg(F.count(F.lit(1)).alias("rows")).collect()}
    large = {c: sizes[c] for c in columns if sizes.get(c, 0) > max_literals}
    kept: dict[str, list[str]] = {c: [] for c in columns if c not in large}
    for row in table.where(F.col("feature").isin(list(kept))).collect():
        kept[row["feature"]].append(row["value"])
    return RareFolding({c: sorted(v) for c, v in kept.items()}, large, table, threshold)
