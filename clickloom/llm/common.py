"""Shared pieces: the input contract of every operator, staged tables, bounded labelled samples, skew-safe lookups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.sources.tables import stage

#: White space that separates words: space and the five ASCII control characters from tab to carriage return.
SPACE = r"\x20\x09-\x0D"

#: A key with more rows than this may be spread over several tasks by ``salted_lookup``. It changes the plan only.
HOT_ROWS = 2000
#: ``salted_lookup`` raises that limit with the number of rows, so that at most so many keys are hot and broadcast.
MOST_HOT = 5000


def documents_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone: other columns, whatever their names, cannot clash. A NULL text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def words_of(text: Column) -> Column:
    """The maximal runs of characters that are not white space, in order."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != "")


def bounded_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hash of their key: the same on any partitioning."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit("sample")), key).limit(bound)


def salted_lookup(rows: DataFrame, table: DataFrame, keys: list[str], count: str, spread_by: list[str]) -> DataFrame:
    """Left join of ``rows`` to ``table`` (one row a key), where a key with many rows is dealt to several tasks.

    ``table`` is a stored one and has ``count``, its key's number of rows; keys are not NULL. A key is hot if it has more than
    ``HOT_ROWS`` rows and more than one in ``MOST_HOT`` of all rows; so at most ``MOST_HOT`` keys are, and their list is
    broadcast. Only their entries are repeated, once for each share of rows, which adds at most ``MOST_HOT`` entries.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    limit = max(HOT_ROWS, math.ceil(total / MOST_HOT))
    salts = F.when(F.col(count) > limit, F.ceil(F.col(count) / limit)).otherwise(1).cast("int")
    hot = table.where(F.col(count) > limit).select(*keys, salts.alias("_salts"))
    known = rows.join(F.broadcast(hot), keys, "left")
    salted = known.withColumn("_salt", F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread_by), F.col("_salts"))).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop(count)
    return salted.drop("_salts").join(copies, [*keys, "_salt"], "left").drop("_salt")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the cluster's shared folder and read back: lineage is cut and survives the loss of executors."""
    return stage(df, name)
