"""Samples, splits and folds. The hash forms give the same rows on any partitioning and on any re-run of a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import hash_bucket, hash_fraction
from clickloom.schema import LABEL

# The published seeds, row total and sample size of the click log.
SAMPLE_SEED = 8888
SPLIT_SEED = 2018
FULL_ROWS = 34095179 + 11745438
SAMPLE_ROWS = 100000
TRAIN_SHARE = 0.7
SPLIT_SALT = "p|"


def sample_fraction(df: DataFrame, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Seeded Bernoulli sample. The rows taken depend on the partitioning of ``df``; ``sample_hash`` does not."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_hash(df: DataFrame, key: str, fraction: float, salt: str = "s|") -> DataFrame:
    """Bernoulli sample decided by the row's key: a narrow filter, no shuffle."""
    return df.where(hash_fraction(key, salt) < fraction)


def sample_n(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """``n`` random rows: each task keeps its own n smallest hashes, so n rows per task reach the merge."""
    order = F.md5(F.concat(F.col(key), F.lit(f"|{seed}")))
    return df.orderBy(order, key).limit(n)


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def top_k(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The k largest rows, compared column by column."""
    return df.orderBy(*[F.desc(c) for c in columns]).limit(k)


def random_split(
    df: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Seeded split with Spark's own generator. Both parts re-read ``df``, so it should be a stored table."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test


def assign_split(df: DataFrame, key: str, train_share: float = TRAIN_SHARE, column: str = "data") -> DataFrame:
    """Adds 'Train' or 'Test' by key hash, for any share from 0 to 1; 'Test' for a NULL key."""
    return df.withColumn(column, F.when(hash_fraction(key, SPLIT_SALT) < train_share, "Train").otherwise("Test"))


def assign_fold(df: DataFrame, key: str, folds: int = 3, column: str = "fold") -> DataFrame:
    return df.withColumn(column, hash_bucket(key, folds, salt="f|"))


def count_parts(df: DataFrame, part: str, label: str = LABEL) -> DataFrame:
    """Rows and positives of each part, in one pass."""
    return df.groupBy(part).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
    )
