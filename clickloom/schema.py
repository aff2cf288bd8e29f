"""Column layout of the click log, and column roles found from types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL = "label"

# Number of numeric and categorical fields of the click log, in file order after the label.
NUMERIC_FIELDS = 13
CATEGORICAL_FIELDS = 26


def numeric_names(n: int = NUMERIC_FIELDS) -> list[str]:
    return [f"c{i:02d}" for i in range(1, n + 1)]


def categorical_names(n: int = CATEGORICAL_FIELDS) -> list[str]:
    return [f"b{i:02d}" for i in range(1, n + 1)]


def click_log_schema(numeric: int = NUMERIC_FIELDS, categorical: int = CATEGORICAL_FIELDS) -> T.StructType:
    fields = [T.StructField(LABEL, T.LongType())]
    fields += [T.StructField(c, T.DoubleType()) for c in numeric_names(numeric)]
    fields += [T.StructField(c, T.StringType()) for c in categorical_names(categorical)]
    return T.StructType(fields)


def categorical_columns(df: DataFrame, exclude: tuple[str, ...] = ("rk",)) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]


def role_of(field: T.StructField, key: str | None = "rk") -> str:
    if field.name == key:
        return "key"
    if isinstance(field.dataType, T.StringType):
        return "categorical"
    if isinstance(field.dataType, T.DoubleType):
        return "numeric"
    return "label" if field.name == LABEL else "other"


def column_roles(df: DataFrame, key: str | None = "rk") -> DataFrame:
    """Schema report: one row per column with its type, role and number of non-null values (one pass)."""
    counts = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in df.schema])
    rows: list[Column] = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.lit(role_of(f, key)).alias("role"),
            F.col(f.name).alias("n_values"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*rows)))
