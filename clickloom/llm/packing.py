"""Packing into optimal length buckets.

Documents are cut into pieces of at most ``max_length`` tokens, every token in one piece. Dynamic programming over the
histogram of all piece lengths chooses the bucket boundaries with the least padding. Inside a bucket, batches of a fixed
number of pieces, padded to the boundary, fill the token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import staged

#: A run of letters and digits, or one other character that is not white space.
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"
#: Pieces of a bucket are ranked in slices of about this many. It changes the plan, and which pieces share a batch.
SLICE_ROWS = 20000


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """At most ``buckets`` upper lengths, ascending, with the least total padding; the last is the greatest length.

    A piece goes to the first bucket whose boundary is not below its length. Ties take the smaller boundary.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return []
    counts = np.r_[0, np.cumsum([histogram[int(x)] for x in lengths])].astype(np.float64)
    m = len(lengths)
    # cost[j]: least padded size of the first j lengths. With one bucket all are padded to the j-th.
    cost = np.r_[0.0, lengths * counts[1:]]
    cuts = [np.zeros(m + 1, dtype=np.int64)]
    for _ in range(min(buckets, m) - 1):
        following, cut = cost.copy(), np.zeros(m + 1, dtype=np.int64)
        for j in range(1, m + 1):
            options = cost[:j] + lengths[j - 1] * (counts[j] - counts[:j])
            cut[j] = int(np.argmin(options))
            following[j] = options[cut[j]]
        cost = following
        cuts.append(cut)
    out, j = [], m
    for cut in reversed(cuts):
        if j:
            out.append(int(lengths[j - 1]))
            j = int(cut[j])
    return out[::-1]


def pieces(docs: DataFrame, id_col: str, length: Column, max_length: int) -> DataFrame:
    """``doc_id``, ``piece`` number from 0, ``start`` and ``length`` in tokens. A document without tokens has one empty piece."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    last = F.greatest(F.ceil(F.col("n") / max_length).cast("int") - 1, F.lit(0))
    rows = staged(rows, "lengths").select("doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * max_length
    return rows.select("doc_id", "piece", start.alias("start"), F.least(F.lit(max_length), F.col("n") - start).alias("length"))


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: Column | None = None,
    max_length: int = 2048,
    buckets: int = 12,
    batch_tokens: int = 65536,
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``bucket`` (its boundary), ``batch`` and ``slot``: a row for each piece.

    ``length`` is a column with the tokens of a row, counted by the caller's tokenizer; without it, tokens are counted by
    ``TOKEN``. A batch of a bucket has ``batch_tokens // boundary`` pieces (one at least); only each bucket's last batch may
    have fewer. NULL or empty texts and NULL lengths have one piece of no tokens. Repeated rows are packed each. An empty
    table gives no rows. Other columns are left out.
    """
    if max_length < 1 or buckets < 1 or batch_tokens < max_length:
        raise ValueError("max_length and buckets are at least 1, and a batch holds at least one piece")
    counted = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(TOKEN)) if length is None else length
    rows = pieces(docs, id_col, counted, max_length)
    histogram = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most max_length + 1 rows
    bounds = boundaries(histogram, buckets)
    bucket, slices, capacity = F.lit(max_length), F.lit(1), F.lit(1)
    for low, b in zip([-1, *bounds], bounds):
        n = sum(c for x, c in histogram.items() if low < x <= b)
        inside = (F.col("length") > low) & (F.col("length") <= b)
        bucket = F.when(inside, b).otherwise(bucket)
        slices = F.when(inside, -(-n // SLICE_ROWS)).otherwise(slices)
        capacity = F.when(F.col("bucket") == b, max(1, batch_tokens // max(1, b))).otherwise(capacity)
    rows = rows.withColumn("bucket", bucket.cast("int")).withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "length"), slices).cast("int"))
    counts = rows.groupBy("bucket", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("bucket", "slice").orderBy("doc_id", "piece", "start", "length")) - 1)
    place = F.col("offset") + F.col("rank")
    return (
        ranked.join(offsets, ["bucket", "slice"])
        .withColumn("capacity", capacity)
        .select("doc_id", "piece", "start", "length", "bucket", F.floor(place / F.col("capacity")).alias("batch"), (place % F.col("capacity")).cast("int").alias("slot"))
    )
