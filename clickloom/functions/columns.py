"""Column expressions shared by the operators. All of them stay inside the JVM; there is no Python UDF."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_bucket(key: Column | str, buckets: int, salt: str = "") -> Column:
    """Bucket ``0..buckets-1`` from the first 16 bits of md5; the same on any partitioning and in any SQL engine."""
    text = F.concat(F.lit(salt), _col(key)) if salt else _col(key)
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int") % buckets


def hash_fraction(key: Column | str, salt: str = "") -> Column:
    """Uniform number in [0, 1) from the first 32 bits of md5."""
    text = F.concat(F.lit(salt), _col(key)) if salt else _col(key)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)


def signed_log(x: Column | str) -> Column:
    """log1p for values from zero up; negative values pass through; NULL stays NULL."""
    x = _col(x)
    return F.when(x < 0, x).otherwise(F.log1p(x))


def z_score(x: Column | str, mean: float, stddev: float) -> Column:
    """Standard score; 0.0 for a constant column, as StandardScaler gives."""
    if not stddev:
        return F.when(_col(x).isNotNull(), F.lit(0.0))
    return (_col(x) - F.lit(mean)) / F.lit(stddev)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def dot(weights: Mapping[str, float], bias: float = 0.0) -> Column:
    """bias + sum(weight * column), added from left to right."""
    return reduce(lambda acc, item: acc + F.lit(float(item[1])) * F.col(item[0]), weights.items(), F.lit(float(bias)))


def vector_dot(vector: Column | str, weights: list[float], bias: float = 0.0) -> Column:
    """bias + the product of a vector column, sparse or dense, with the weights; only a sparse vector's own entries are visited."""
    parts, start = F.unwrap_udt(_col(vector)), F.lit(float(bias))
    table = F.from_json(F.lit(json.dumps([float(w) for w in weights])), "array<double>")  # folded to one literal, however long
    sparse = F.zip_with(parts["indices"], parts["values"], lambda i, v: F.get(table, i) * v)
    dense = F.zip_with(parts["values"], table, lambda v, w: v * w)
    return F.aggregate(F.when(parts["indices"].isNull(), dense).otherwise(sparse), start, lambda total, x: total + x)


def round6(x: Column | str) -> Column:
    return F.round(x, 6)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type can hold NaN (isnan on a string raises in ANSI mode)."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        missing = missing | F.isnan(name)
    return missing


def positive_probability(df: DataFrame, name: str = "probability") -> Column:
    """Probability of label 1, from a model's probability vector or from a plain numeric column."""
    if isinstance(df.schema[name].dataType, VectorUDT):
        return vector_to_array(F.col(name))[1]
    return F.col(name).cast("double")
