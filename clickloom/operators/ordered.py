"""Exact order statistics without a global sort in one task.

Input is always a table of counts per distinct value. The value range is cut into slices of about equal size. A window
runs inside each slice; a second, small window runs over one total per slice, and gives each slice its starting point.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.sources.tables import stage

MAX_SLICES = 1000


def slice_number(df: DataFrame) -> int:
    return max(2, min(MAX_SLICES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def bucketed(counts: DataFrame, value: str, slices: int | None = None) -> DataFrame:
    """Adds ``slice``, rising with ``value``. The cut points are fetched once, so every branch of a plan agrees on them.

    The number of cut points is bounded by ``MAX_SLICES`` and does not grow with the data.
    """
    slices = slices or slice_number(counts)
    points = counts.approxQuantile(value, [i / slices for i in range(1, slices)], 0.25 / slices)
    splits = [float("-inf"), *sorted(set(points)), float("inf")]
    if len(splits) < 3:
        return counts.withColumn("slice", F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=value, outputCol="slice").transform(counts)


def slice_starts(counts: DataFrame, keys: list[str], totals: list[str], descending: bool = False) -> DataFrame:
    """Per key and slice: the sums of ``totals`` in the slice, over all earlier slices as ``<total>_before``, and over all
    slices as ``<total>_all``. At most one row per key and slice goes through these windows."""
    per_slice = counts.groupBy(*keys, "slice").agg(*[F.sum(t).alias(t) for t in totals])
    order = F.desc("slice") if descending else F.asc("slice")
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    return per_slice.select(
        *keys,
        "slice",
        *totals,
        *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"{t}_before") for t in totals],
        *[F.sum(t).over(whole).alias(f"{t}_all") for t in totals],
    )


def with_running_totals(
    counts: DataFrame, keys: list[str], value: str, totals: list[str], descending: bool = False
) -> DataFrame:
    """Adds ``<total>_upto`` (this value included) and ``<total>_all`` to a sliced table of counts."""
    order = F.desc(value) if descending else F.asc(value)
    within = Window.partitionBy(*keys, "slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    starts = slice_starts(counts, keys, totals, descending)
    rows = counts.withColumns({f"{t}_within": F.sum(t).over(within) for t in totals})
    # One row per key and slice.
    joined = rows.join(F.broadcast(starts.drop(*totals)), [*keys, "slice"])
    return joined.select(
        *counts.columns,
        *[(F.col(f"{t}_before") + F.col(f"{t}_within")).alias(f"{t}_upto") for t in totals],
        *[F.col(f"{t}_all") for t in totals],
    )


def exact_quantiles(counts: DataFrame, keys: list[str], value: str, points: Mapping[str, float]) -> DataFrame:
    """Quantiles with linear interpolation, one row per key. ``counts`` has the value, its count ``n`` and ``slice``."""
    ranked = with_running_totals(counts, keys, value, ["n"])
    last = F.col("n_all") - 1

    def at(rank: Column) -> Column:
        covers = (F.col("n_upto") > rank) & (F.col("n_upto") - F.col("n") <= rank)
        return F.max(F.when(covers, F.col(value)))

    parts = [F.max("n_all").alias("n_all")]
    for name, p in points.items():
        parts += [at(F.floor(F.lit(p) * last)).alias(f"{name}_lo"), at(F.ceil(F.lit(p) * last)).alias(f"{name}_hi")]
    found = ranked.groupBy(*keys).agg(*parts)
    columns = []
    for name, p in points.items():
        position = F.lit(p) * (F.col("n_all") - 1)
        weight = position - F.floor(position)
        columns.append(
            (F.col(f"{name}_lo") + weight * (F.col(f"{name}_hi") - F.col(f"{name}_lo"))).alias(name)
        )
    return found.select(*keys, *columns)


def numbered_within(df: DataFrame, group: str, order: list[Column], output: str = "number") -> DataFrame:
    """``df`` with the place of each row in its group, from 0. ``df`` is a stored table, and the order has no ties.

    The rows are sorted across all tasks. A row's place in its task comes from the numbering of rows there, and what lies before
    it in other tasks from one count for each task and group, so a group of any size is never in one task. For few groups.
    """
    by = [F.col(group), *order]
    placed = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    placed = stage(placed.withColumn("_part", F.shiftrightunsigned("_at", 33)), "ordered-rows")
    counts = placed.groupBy(group, "_part").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_part", "_from", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(starts), [group, "_part"])
    return joined.select(*df.columns, (F.col("_at") - F.col("_from") + F.col("_before")).alias(output))
