"""Ranks and prefix sums along linked lists that lie over many tasks.

Each round deals the elements to blocks of bounded size, neighbours in number together, and every task shortens the stretches of
the lists inside its block to one element each. What is left is a list again, far shorter, for the next round. At the end every
element adds what is before its stretch, round by round backwards. Should a round hardly shorten the lists, since most links lead
to other blocks, the next one takes out elements by chance: one whose coin is 1, after one whose coin is 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import staged

#: Elements of a block, which one task holds. It changes the plan only.
BLOCK = 65_536
#: Beyond so many blocks they get larger instead, so that the driver's list of them stays short.
MOST_BLOCKS = 50_000
#: A round that leaves more than this share of the elements is followed by one by chance.
SHORTENED = 0.75


def shorten(ids: np.ndarray, following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the elements of one block, ids rising: the index of the first element of its stretch, the sums of the weights before
    it in the stretch, and the index of the stretch's last element (for its first). Pointers double until they stand still.

    ``following`` is -1 at the end of a list.
    """
    n = len(ids)
    at = np.searchsorted(ids, following)
    at[at == n] = 0
    inside = (following >= 0) & (ids[at] == following)
    head, before = np.arange(n), np.zeros_like(weights)
    head[at[inside]] = np.flatnonzero(inside)
    before[at[inside]] = weights[inside]
    while True:
        further = head[head]
        if np.array_equal(further, head):
            break
        before = before + before[head]
        head = further
    tail = np.zeros(n, dtype=np.int64)
    tail[head[~inside]] = np.flatnonzero(~inside)
    return head, before, tail


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with ``block``: consecutive stretches of ids, together at most ``size`` elements."""
    counted = rows.groupBy(F.floor(F.col("id") / size).alias("_of")).count().orderBy("_of").collect()
    table, block, held = [], 0, 0
    for r in counted:
        if held and held + r["count"] > size:
            block, held = block + 1, 0
        table.append((r["_of"], block))
        held += r["count"]
    # At most MOST_BLOCKS rows, as ids are numbers from 0 without large gaps.
    known = rows.sparkSession.createDataFrame(table, "_of bigint, block int")
    return rows.join(F.broadcast(known), F.floor(F.col("id") / size) == F.col("_of")).drop("_of")


def _within(rows: DataFrame, sums: list[str], size: int) -> DataFrame:
    """One round by blocks: ``id``, ``head`` (first of its stretch), sums before it in the stretch; heads also have the next
    element after the stretch, as ``next``, and the stretch's sums as ``<c>_all``."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        following = table.column("next").fill_null(-1).to_numpy()[order]
        weights = np.stack([table.column(c).to_numpy()[order] for c in sums], axis=1)
        head, before, tail = shorten(ids, following, weights)
        is_head = head == np.arange(len(ids))
        whole = before[tail] + weights[tail]
        columns = [pa.array(ids), pa.array(ids[head]), *[pa.array(before[:, k]) for k in range(len(sums))]]
        columns.append(pa.array(following[tail], mask=~is_head | (following[tail] < 0)))
        columns += [pa.array(whole[:, k], mask=~is_head) for k in range(len(sums))]
        return pa.Table.from_arrays(columns, names=["id", "head", *sums, "next", *[f"{c}_all" for c in sums]])

    longs = [*sums, "next", *[f"{c}_all" for c in sums]]
    return _blocks(rows, size).groupBy("block").applyInArrow(run, "id bigint, head bigint, " + ", ".join(f"{c} bigint" for c in longs))


def _by_chance(rows: DataFrame, sums: list[str], turn: int) -> DataFrame:
    """One round by coins, with the same columns: about a quarter of the elements go into the one before them."""
    coin = F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2))
    one = rows.withColumn("coin", coin)
    taken = one.where("coin = 1").select(F.col("id").alias("t_id"), F.col("next").alias("t_next"), *[F.col(c).alias(f"t_{c}") for c in sums])
    taking = one.where("coin = 0").select(F.col("next").alias("b_next"), F.col("id").alias("b_id"), *[F.col(c).alias(f"b_{c}") for c in sums])
    both = one.join(taken, (F.col("coin") == 0) & (F.col("next") == F.col("t_id")), "left")
    both = both.join(taking.where("b_next is not null"), (F.col("coin") == 1) & (F.col("id") == F.col("b_next")), "left")
    gone, grown = F.col("b_id").isNotNull(), F.col("t_id").isNotNull()
    return both.select(
        "id",
        F.coalesce("b_id", "id").alias("head"),
        *[F.coalesce(f"b_{c}", F.lit(0)).alias(c) for c in sums],
        F.when(~gone, F.when(grown, F.col("t_next")).otherwise(F.col("next"))).alias("next"),
        *[F.when(~gone, F.col(c) + F.coalesce(f"t_{c}", F.lit(0))).alias(f"{c}_all") for c in sums],
    )


def list_rank(links: DataFrame, weights: list[str], block: int = BLOCK) -> DataFrame:
    """From elements ``id`` (numbers from 0, each once), ``next`` (NULL at a list's end) and whole-number weights:
    ``id``, ``position`` in its list from 0, and for each weight its sum over the elements before.

    Every id is the next of at most one element. There may be several lists; a cycle is an error that the caller must exclude.
    The links are stored first. No rows: none.
    """
    sums = ["position", *weights]
    rows = staged(links.select("id", "next", F.lit(1).cast("bigint").alias("position"), *[F.col(w).cast("bigint").alias(w) for w in weights]), "links")
    count = rows.count()
    size = max(block, math.ceil(count / MOST_BLOCKS))
    rounds, chance = [], False
    while True:
        made = staged(_by_chance(rows, sums, len(rounds)) if chance else _within(rows, sums, size), "list-round")
        rounds.append(made)
        rows = made.where("head = id").select("id", "next", *[F.col(f"{c}_all").alias(c) for c in sums])
        left, open_ends = rows.agg(F.count(F.lit(1)), F.count("next")).first()
        if not open_ends:
            break
        chance, count = not chance and left > SHORTENED * count, left
    found = rows.select("id", *[F.lit(0).cast("bigint").alias(c) for c in sums])
    for made in reversed(rounds):
        heads = found.select(F.col("id").alias("head"), *[F.col(c).alias(f"h_{c}") for c in sums])
        found = made.join(heads, "head").select("id", *[(F.col(c) + F.col(f"h_{c}")).alias(c) for c in sums])
    return found
