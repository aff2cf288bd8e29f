"""The trie of all prefixes of conversations, its subtree sums found by the Euler-tour technique.

A node is a distinct sequence of turns. Nodes come from one aggregate over a running 128-bit hash of each conversation's turns.
Every node has an arc that enters it and one that leaves it; together they form one list, a walk around the whole trie. The list
is ranked across tasks (``list_ranking``), and a subtree's sum is the difference of the prefix sums at the node's two arcs, however
deep or wide the trie is. Nothing is done level by level, and neither a conversation, nor the children of a node, nor the
conversations that end in one are ever gathered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE, salted_lookup, staged
from clickloom.llm.list_ranking import BLOCK, list_rank
from clickloom.llm.scan import LANE, scan

KEY = ["depth", "hi", "lo"]
LANES = ("a", "b", "c", "d")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


@dataclass
class Trie:
    """``nodes``: one row a node, with ``depth, hi, lo`` as its key. ``ends``: the node in which each conversation ends."""

    nodes: DataFrame
    ends: DataFrame


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id``, ``position`` from 0, ``digest`` of role and text, ``words`` of the text, for each turn. The texts stay where they are.

    Turns go by number, NULL first; those of one number by their digest, so repeated rows are turns of their own. A NULL role or
    text is empty. Rows without a conversation are left out. Other columns are left out, whatever their names.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    narrow = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.regexp_count(text, F.lit(f"[^{SPACE}]+")).cast("bigint").alias("words"),
    )
    ranked = scan(staged(narrow, "turns"), ["conv_id"], ["turn", "digest"], name="ranked-turns")
    return ranked.select("conv_id", F.col("rank").alias("position"), "digest", "words")


def members_of(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``length``, its number of turns."""
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))


def _prefixes(turns: DataFrame) -> DataFrame:
    """For each turn the key of the prefix that ends with it, and of the one before. A key's lanes are sums, modulo 2^32, of
    hashes of position and turn, so that they can be summed across tasks."""
    x, y = (F.xxhash64(F.lit(k), "digest", "position") for k in (1, 2))
    lanes = [F.shiftrightunsigned(x, 32), x.bitwiseAND(LANE), F.shiftrightunsigned(y, 32), y.bitwiseAND(LANE)]
    rows = turns.select("conv_id", "position", "words", *[v.alias(k) for v, k in zip(lanes, LANES)])
    summed = scan(staged(rows, "turn-lanes"), ["conv_id"], ["position"], LANES, name="prefixes")
    before = [F.col(f"{k}_before") for k in LANES]
    after = [(F.col(f"{k}_before") + F.col(k)) % (LANE + 1) for k in LANES]
    pack = lambda high, low: F.shiftleft(high, 32).bitwiseOR(low)
    return summed.select(
        "conv_id", (F.col("position") + 1).alias("depth"), "words",
        pack(*after[:2]).alias("hi"), pack(*after[2:]).alias("lo"), pack(*before[:2]).alias("p_hi"), pack(*before[2:]).alias("p_lo"),
    )


def build(turns: DataFrame, members: DataFrame, block: int = BLOCK) -> Trie:
    """The trie of ``turns`` (``conv_id, position, digest, words``; positions from 0 without gaps) and ``members``
    (``conv_id, length``, one row a conversation, those without turns included).

    A node has ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (NULL for the root), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over its subtree, the words that members after the first need not repeat), and the positions
    ``enter`` and ``leave`` of its arcs in the tour. No members: no nodes, not even a root.
    """
    prefixes = staged(_prefixes(turns), "keyed-prefixes")
    zero = F.lit(0).cast("bigint")
    made = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"), F.max("p_hi").alias("p_hi"), F.max("p_lo").alias("p_lo")
    )
    none = F.lit(None).cast("bigint")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), "conv_id", "n_convs", zero.alias("words"), none.alias("p_hi"), none.alias("p_lo"))
    # A node is known by its smallest member and its depth, so this order is one without ties, and paths lie together.
    nodes = scan(staged(made.unionByName(root), "trie-nodes"), [], ["conv_id", "depth"], name="numbered-nodes").withColumnRenamed("rank", "node")

    up = [(F.col("depth") - 1).alias("depth"), F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo")]
    kids = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"), F.min("node").alias("first"))
    nodes = staged(nodes.join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes-with-children")
    parents = nodes.where("n_children > 0").select(
        F.col("depth").alias("p_depth"), F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    children = nodes.where("depth > 0").withColumn("p_depth", F.col("depth") - 1).withColumnRenamed("n_children", "own_children")
    known = salted_lookup(children, parents, ["p_depth", "p_hi", "p_lo"], "n_children", ["node"]).withColumnRenamed("own_children", "n_children")
    known = staged(known.withColumn("turned", -F.col("node")), "nodes-with-parents")
    # In falling order the node before is the next sibling.
    siblings = scan(known, ["parent"], ["turned"], lag="node", name="siblings").withColumnRenamed("node_before", "sibling")
    tops = nodes.where("depth = 0").select("*", none.alias("parent"), none.alias("sibling"))
    facts = ["node", "first", "parent", "sibling", "n_children", "n_convs", "words"]
    both = siblings.select(*facts).unionByName(tops.select(*facts))

    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    after = F.when(F.col("sibling").isNotNull(), F.col("sibling") * 2).otherwise(F.col("parent") * 2 + 1)
    arcs = both.select(
        F.inline(
            F.array(
                F.struct(
                    enter.alias("id"), F.coalesce(F.col("first") * 2, leave).alias("next"),
                    (F.col("n_children") == 0).cast("bigint").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
                ),
                F.struct(leave.alias("id"), after.alias("next"), zero.alias("leaves"), zero.alias("saved")),
            )
        )
    )
    ranked = list_rank(arcs, ["leaves", "saved"], block)
    # Weights are not negative, so of a node's two arcs the one that leaves it has the larger sums.
    tour = ranked.groupBy(F.floor(F.col("id") / 2).alias("node")).agg(
        F.min("position").alias("enter"), F.max("position").alias("leave"),
        (F.max("leaves") - F.min("leaves")).alias("n_leaves"), (F.max("saved") - F.min("saved")).alias("saved_tokens"),
    )
    parent_of = known.select("node", "parent_conv_id")
    out = nodes.drop("first", "p_hi", "p_lo").join(tour, "node").join(parent_of, "node", "left")
    ends = prefixes.groupBy("conv_id").agg(F.max(F.struct(*KEY)).alias("k")).select("conv_id", "k.*")
    turnless = members.where("length = 0").select("conv_id", *[zero.alias(k) for k in KEY])
    return Trie(out, ends.unionByName(turnless))


def prefix_trie(conversations: DataFrame, block: int = BLOCK, **columns: str) -> Trie:
    """The trie of the conversations as they are; see ``turns_of`` for their order, ``build`` for the columns."""
    turns = turns_of(conversations, **columns)
    return build(turns, members_of(turns), block)


def ends_digest(ends: DataFrame) -> DataFrame:
    """For each node in which conversations end: ``ends_sha256`` of their ids, rising, as decimal numbers joined by commas.

    Sorted ids are packed into texts by the tasks that sort them, and one task hashes a node's texts as they stream by, so a node
    with a third of all conversations costs one task neither their rows nor memory for them.
    """
    by = [*KEY, "conv_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            depth, hi, lo, conv = (batch.column(c).to_numpy() for c in by)
            new = np.flatnonzero((depth[1:] != depth[:-1]) | (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])) + 1
            begin, end = np.r_[0, new], np.r_[new, n]
            texts = [",".join(map(str, conv[b:e].tolist())) for b, e in zip(begin, end)]
            yield pa.RecordBatch.from_arrays([pa.array(depth[begin]), pa.array(hi[begin]), pa.array(lo[begin]), pa.array(conv[begin]), pa.array(texts)], names=[*by, "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(3)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([r[3] for r in out], pa.string())], names=[*KEY, "ends_sha256"])

        for batch in batches:
            for depth, hi, lo, ids in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"])):
                if (depth, hi, lo) == now:
                    state.update(b",")
                else:
                    if now:
                        out.append((*now, state.hexdigest()))
                    now, state = (depth, hi, lo), hashlib.sha256()
                state.update(ids.encode())
            if len(out) > 10_000:
                yield flush()
                out.clear()
        if now:
            out.append((*now, state.hexdigest()))
        yield flush()

    keys = "depth bigint, hi bigint, lo bigint"
    rows = staged(ends.select(*by), "trie-ends")
    packed = rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(pack, f"{keys}, conv_id bigint, ids string")
    return packed.repartition(*KEY).sortWithinPartitions(*by).mapInArrow(digest, f"{keys}, ends_sha256 string")


def rebuilt(turns: DataFrame, family: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations with shared beginnings: conversation c takes its first h turns from conversation c - c % ``family`` (all if
    it has fewer, none if it is absent) and goes on with its own turns after its first h; h is crc32 of c's decimals modulo ``most``.

    From ``turns_of``: the rebuilt turns and their ``members_of``, conversations left without turns included.
    """
    turns = turns.select("conv_id", "position", "digest", "words")
    shared = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    counts = staged(members_of(turns), "conversation-lengths")
    base = counts.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    convs = counts.withColumn("h", shared).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    # At most ``family`` conversations have the same base.
    convs = convs.join(base, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_length", F.lit(0))))
    convs = staged(convs.select("conv_id", "base", "length", "h", "taken"), "rebuilt-conversations")
    own = salted_lookup(turns.where(F.col("position") >= shared), convs.select("conv_id", "h", "taken", "length"), ["conv_id"], "length", ["position"])
    own = own.select("conv_id", (F.col("position") - F.col("h") + F.col("taken")).alias("position"), "digest", "words")
    first = turns.where(F.col("position") < most - 1).withColumnRenamed("conv_id", "base")
    start = convs.select("conv_id", "base", "taken").join(first, "base").where(F.col("position") < F.col("taken"))
    members = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("length") - F.col("h"), F.lit(0))).alias("length"))
    return own.unionByName(start.select(*own.columns)), members
