"""Tab-separated click log without header: label, numeric fields, categorical fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.schema import CATEGORICAL_FIELDS, LABEL, NUMERIC_FIELDS, categorical_names, numeric_names


def _integer(text: Column, what: str, strict: bool) -> Column:
    parsed = text.try_cast("bigint")
    if not strict:
        return parsed
    message = F.concat(F.lit(f"not an integer in {what}: "), F.coalesce(text, F.lit("<missing>")))
    return F.coalesce(parsed, F.raise_error(message).cast("bigint"))


def parse_click_log(
    lines: DataFrame,
    numeric: int = NUMERIC_FIELDS,
    categorical: int = CATEGORICAL_FIELDS,
    strict: bool = True,
) -> DataFrame:
    """Typed rows from a ``value`` text column. A blank numeric is 0.0, a blank category stays ''.

    Strict mode raises on a line with another number of fields, and on a missing or malformed label or number. Lenient mode
    gives NULL there, in all fields of a line of the wrong length, which :func:`count_rejects` reports.
    """
    expected = 1 + numeric + categorical
    p = F.split("value", "\t", -1)
    whole = F.size(p) == expected
    message = F.concat(F.lit(f"{expected} fields expected, line has "), F.size(p).cast("string"))
    other = F.raise_error(message).cast("array<string>") if strict else F.lit(None).cast("array<string>")
    fields = lines.select(F.when(whole, p).otherwise(other).alias("p"))
    columns = [_integer(F.get("p", F.lit(0)), LABEL, strict).alias(LABEL)]
    for i, name in enumerate(numeric_names(numeric), start=1):
        text = F.get("p", F.lit(i))
        number = F.when(text == "", F.lit(0.0)).otherwise(_integer(text, name, strict).cast("double"))
        columns.append(number.alias(name))
    for i, name in enumerate(categorical_names(categorical), start=1 + numeric):
        columns.append(F.get("p", F.lit(i)).alias(name))
    return fields.select(*columns)


def read_click_log(spark: SparkSession, path: str, **layout) -> DataFrame:
    return parse_click_log(spark.read.text(path), **layout)


def count_rejects(parsed: DataFrame) -> DataFrame:
    """Rows of a leniently parsed log that hold at least one unreadable label, number or category."""
    bad = F.lit(False)
    for name in parsed.columns:
        bad = bad | F.col(name).isNull()
    return parsed.agg(F.count_if(bad).alias("n_rejected"), F.count(F.lit(1)).alias("n_rows"))


def write_click_log(df: DataFrame, path: str) -> None:
    """The inverse of the reader, for whole-number numerics: zero and NULL numbers, and NULL categories, are written as blank.

    Raises on what the format cannot hold: a fraction, a missing label, and a tab or line break inside a category.
    """
    fields = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if f.name == LABEL:
            text = F.coalesce(c.cast("string"), F.raise_error(F.lit("missing label")).cast("string"))
        elif f.dataType.simpleString() in ("double", "float"):
            whole = F.when(c == F.floor(c), c.cast("bigint").cast("string"))
            fraction = F.raise_error(F.concat(F.lit(f"not a whole number in {f.name}: "), c.cast("string"))).cast("string")
            text = F.when(c.isNull() | (c == 0), "").otherwise(F.coalesce(whole, fraction))
        else:
            text = F.coalesce(c.cast("string"), F.lit(""))
            broken = F.raise_error(F.lit(f"tab or line break in {f.name}")).cast("string")
            text = F.when(text.rlike("[\\t\\r\\n]"), broken).otherwise(text)
        fields.insert(0, text) if f.name == LABEL else fields.append(text)
    df.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
