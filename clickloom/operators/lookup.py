"""Left lookup of a per-category table, by broadcast when its counted size allows it, else by a skew-safe shuffle."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.sources.tables import stage

# Largest category table sent to every executor, in rows of one category and one number.
BROADCAST_ROWS = 100_000
# Categories with at least this share of all rows are looked up by broadcast even when the table is large.
HOT_SHARE = 0.001
# Tables up to this many rows become a literal map inside a projection, and need no join.
LITERAL_ROWS = 200
# Start of the key of rows that need no match. It is part of the key and not a second one, since a second key that is
# constant on one side is no longer used for partitioning after optimisation.
SPREAD_PREFIX = "\u0001"
# Bits of a value filter for each value, probes for each question, and the largest filter (8 MB). A filter that is too small only
# lets more values through to the join.
FILTER_BITS = 16
FILTER_PROBES = 5
MAX_FILTER_BITS = 1 << 26


# -- value filters --------------------------------------------------------------------------------------------------


def _probes(columns: list[Column], bits: int) -> list[Column]:
    """Bit numbers below ``bits``, a power of two, by double hashing of the two halves of one hash."""
    h = F.xxhash64(*columns)
    low, high = h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32).bitwiseOR(1)
    return [(low + F.lit(i) * high).bitwiseAND(bits - 1) for i in range(FILTER_PROBES)]


def value_filter(values: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """A Bloom filter of the values as one stored row: ``bits``, its size, and ``words``, 64 bits each.

    Every task sets the bits of its own values; equal words are merged by a distributed aggregate.
    """
    bits = 64
    while bits < min(MAX_FILTER_BITS, FILTER_BITS * rows):
        bits *= 2
    one = values.select(F.explode(F.array(*_probes([F.col(c) for c in columns], bits))).alias("bit"))
    bit = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    found = one.select(F.shiftright("bit", 6).alias("word"), bit.alias("set"))
    empty = values.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("set"))
    words = found.unionByName(empty).groupBy("word").agg(F.bit_or("set").alias("set"))
    row = words.agg(F.sort_array(F.collect_list(F.struct("word", "set"))).alias("w"))  # at most MAX_FILTER_BITS / 64 words
    return stage(row.select(F.lit(bits).alias("bits"), F.col("w.set").alias("words")), "value-filter")


def may_hold(known: DataFrame, columns: list[Column]) -> Column:
    """False only for values that are not in the filter. Part of a projection: the filter reaches the tasks as a scalar subquery."""
    bits = known.first()["bits"]
    words = known.select("words").scalar()
    asked = [F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(63).cast("int")) == 1 for p in _probes(columns, bits)]
    return reduce(lambda a, b: a & b, asked)


# -- lookups --------------------------------------------------------------------------------------------------------


def attach(
    df: DataFrame,
    column: str,
    table: DataFrame,
    outputs: Mapping[str, str],
    table_rows: int,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Adds ``outputs`` (table column -> new column) of the ``table`` row whose ``value`` equals ``column``; else NULL.

    ``table`` has ``value``, ``n`` (rows of that category) and the output columns, ``table_rows`` is its counted size in rows of
    at most 100 bytes, so that long categories count as several.
    Above ``broadcast_rows`` the table is split. Hot categories, at most ``1 / hot_share`` of them, are broadcast, so
    the shuffle join only sees categories that are each a small share of the rows. Rows already served by the hot part, rows with
    a NULL category, and rows whose category is not in a filter of the table's values get a hash of the row as key, which spreads
    them over all tasks. So a value that is frequent in ``df`` and absent from the table is not one key either.
    """
    if table_rows <= min(LITERAL_ROWS, broadcast_rows):
        rows = table.where(F.col("value").isNotNull()).select("value", *outputs).collect()
        if not rows:
            return df.withColumns({t: F.lit(None).cast(table.schema[s].dataType) for s, t in outputs.items()})
        literal = {s: F.create_map(*[F.lit(x) for r in rows for x in (r["value"], r[s])]) for s in outputs}
        return df.withColumns({t: F.try_element_at(literal[s], F.col(column)) for s, t in outputs.items()})
    if table_rows <= broadcast_rows:
        side = table.select(F.col("value").alias("_value"), *[F.col(s).alias(t) for s, t in outputs.items()])
        return df.join(F.broadcast(side), F.col(column) == F.col("_value"), "left").drop("_value")

    columns = df.columns
    total = table.agg(F.sum("n")).first()[0]
    is_hot = F.col("n") >= hot_share * total
    hot = table.where(is_hot).select(
        F.col("value").alias("_hot"), *[F.col(s).alias(f"_hot_{t}") for s, t in outputs.items()]
    )
    cold = table.where(~is_hot).select(
        F.col("value").alias("_cold"), *[F.col(s).alias(f"_cold_{t}") for s, t in outputs.items()]
    )
    rows = df.join(F.broadcast(hot), F.col(column) == F.col("_hot"), "left")
    maybe = may_hold(value_filter(cold, ["_cold"], table_rows), [F.col(column)])
    rows = rows.withColumn("_served", F.col("_hot").isNotNull() | F.col(column).isNull() | ~maybe)
    spread = F.concat(F.lit(SPREAD_PREFIX), F.xxhash64(*columns).cast("string"))
    rows = rows.withColumn("_key", F.when(F.col("_served"), spread).otherwise(F.col(column)))
    matched = rows.join(cold.hint("merge"), F.col("_key") == F.col("_cold"), "left")
    # A served row never takes a value from the cold part, whatever its spread key may equal.
    return matched.select(
        *columns, *[F.when(F.col("_served"), F.col(f"_hot_{t}")).otherwise(F.col(f"_cold_{t}")).alias(t) for t in outputs.values()]
    )


def attach_many(
    df: DataFrame,
    columns: list[str],
    table: DataFrame,
    output: str,
    suffix: str,
    table_rows: int,
    hot_share: float = HOT_SHARE,
    drop: bool = False,
) -> DataFrame:
    """Adds ``<column><suffix>`` for all ``columns`` together: the ``output`` of the ``table`` row with that ``feature`` and ``value``,
    else NULL. The rows are shuffled once, whatever the number of columns.

    Rows get a number and are stored with it. Their values become pairs of row and value; those of hot categories (as in
    :func:`attach`, for each column) are looked up by broadcast, those that a filter does not know are dropped, and only the rest go
    through a shuffle join. One aggregate by row number then brings each row and its answers together.

    ``table`` has ``feature, value, n`` and ``output``, which is never NULL; ``table_rows`` is its counted size. With ``drop`` the
    ``columns`` themselves are left out of the result, and of the last shuffle.
    """
    totals = table.groupBy("feature").agg(F.sum("n").alias("_total"))  # one row for each column of the data
    number = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    sized = table.where(F.col("feature").isin(columns)).join(F.broadcast(totals), "feature")
    is_hot = F.col("n") >= hot_share * F.col("_total")
    entry = [F.try_element_at(number, F.col("feature")).alias("_f"), F.col("value").alias("_v"), F.col(output).alias("_x")]
    hot, cold = sized.where(is_hot).select(*entry), sized.where(~is_hot).select(*entry)

    numbered = stage(df.withColumn("_row", F.monotonically_increasing_id()), "numbered-rows")
    asked = F.array(*[F.struct(F.lit(i).alias("_f"), F.col(c).alias("_v")) for i, c in enumerate(columns)])
    pairs = numbered.select("_row", F.inline(asked)).where("_v is not null").join(F.broadcast(hot), ["_f", "_v"], "left")
    maybe = may_hold(value_filter(cold, ["_f", "_v"], table_rows), [F.col("_f"), F.col("_v")])
    late = pairs.where(F.col("_x").isNull() & maybe).drop("_x").join(cold.hint("merge"), ["_f", "_v"])
    kept = df.drop(*columns) if drop else df
    answers = pairs.where("_x is not null").unionByName(late).select("_row", F.lit(None).cast(kept.schema).alias("_p"), "_f", "_x")
    whole = numbered.select("_row", F.struct(*kept.columns).alias("_p"), F.lit(None).cast("int").alias("_f"), F.lit(None).cast(table.schema[output].dataType).alias("_x"))
    found = [F.max(F.when(F.col("_f") == i, F.col("_x"))).alias(c + suffix) for i, c in enumerate(columns)]
    return whole.unionByName(answers).groupBy("_row").agg(F.first("_p", ignorenulls=True).alias("_p"), *found).select("_p.*", *[c + suffix for c in columns])
