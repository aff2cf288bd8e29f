"""Trees and boosted trees of several settings at once, grown level by level over binned rows. The results are Spark ML models.

Rows are binned once, by the candidate splits that Spark ML takes, and kept as blocks of bytes. A level of all trees is one job: each task adds up the
labels of its rows by node and bin in numpy, the sums are merged by node, and the best split of a node is chosen where its sums meet. Only splits reach the driver.
"""

from __future__ import annotations

import json
import pickle
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier, GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.vectors import entries, vector_parts
from clickloom.sources.tables import stage_path, staging, write_parquet

# Tasks get the functions below with their closures, as workers need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1 << 16
# Nodes whose sums go to one place together, and tasks for each core that hold sums of their own.
CHUNK_NODES = 128
TASKS_A_CORE = 4
# Slots with another bin than that of 0.0 in more of the sampled rows are kept as a column, the others as entries of their rows; up to the
# number of bins below, all are columns.
DENSE_SHARE = 0.25
DENSE_BINS = 64 << 20
# Trees after which margins are made from the rows again, so that a lost executor does not need all former ones.
REBASE = 10
SAMPLE_ROWS = 10_000  # fixed value of Spark ML: fewest rows that candidate splits are taken from
EPSILON = float(np.finfo(float).eps)
NODE = (
    "id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,leftChild:int,rightChild:int,"
    "split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>"
)


# -- candidate splits and bins --------------------------------------------------------------------------------------


@dataclass
class Layout:
    """The candidate splits of each slot, and the place of its bins in a row of sums."""

    splits: list[np.ndarray]
    dense: np.ndarray

    def __post_init__(self):
        self.first = np.concatenate([[0], np.cumsum([len(s) + 1 for s in self.splits])]).astype(np.int64)
        self.cells = int(self.first[-1])
        self.zero = np.array([np.searchsorted(s, 0.0) for s in self.splits], dtype=np.uint8)
        self.column = np.full(len(self.splits), -1)
        self.column[self.dense] = np.arange(len(self.dense))
        self.slot_of = np.repeat(np.arange(len(self.splits)), np.diff(self.first))
        self.bin_of = (np.arange(self.cells) - self.first[self.slot_of]).astype(np.uint8)


def _candidates(values: np.ndarray, n: float, most: int) -> np.ndarray:
    """Spark ML's split points of one slot from its sampled non-zero values, where the sample stands for ``n`` rows: midpoints of neighbouring values,
    all of them or ``most`` at even strides."""
    found, counts = np.unique(values, return_counts=True)
    weights = dict(zip(found.tolist(), counts.astype(float).tolist()))
    if not weights:
        return np.array([])
    if n - len(values) > EPSILON * len(values) * 100:
        weights[0.0] = weights.get(0.0, 0.0) + n - len(values)
    ordered = sorted(weights.items())
    if len(ordered) - 1 <= most:
        return np.array([(a + b) / 2.0 for (a, _), (b, _) in zip(ordered, ordered[1:])])
    points, stride, passed = [], n / (most + 1), ordered[0][1]
    target = stride
    for (a, _), (b, weight) in zip(ordered, ordered[1:]):
        before, passed = passed, passed + weight
        if abs(before - target) < abs(passed - target):
            points.append((a + b) / 2.0)
            target += stride
    return np.array(points)


def _sample(rows: DataFrame, share: float, seed: int) -> list:
    """The rows that Spark ML's trees take their candidate splits from."""
    if share >= 1:
        return rows.collect()  # 10,000 rows, or the square of the number of bins
    spark = rows.sparkSession
    number = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    sampled = rows._jdf.toJavaRDD().sample(False, share, number)
    return DataFrame(spark._jsparkSession.createDataFrame(sampled, rows._jdf.schema()), spark).collect()


def _entries(slots: pa.Array, values: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`entries` of vectors that a tree can be fitted on."""
    if values.null_count:
        raise ValueError("vectors must not be NULL")
    row, at, x = entries(slots, values)
    if not np.isfinite(x).all():
        raise ValueError("vector values must not be NaN or infinite")
    return row, at, x


def _block(y: np.ndarray, row: np.ndarray, slot: np.ndarray, x: np.ndarray, layout: Layout) -> tuple:
    """Bins of the columns, the number of entries of each row, the cells of these entries, and the labels."""
    n, place = len(y), layout.column[slot]
    columns = np.zeros((len(layout.dense), n))
    columns[place[place >= 0], row[place >= 0]] = x[place >= 0]
    bins = np.empty(columns.shape, dtype=np.uint8)
    for d, s in enumerate(layout.dense):
        bins[d] = np.searchsorted(layout.splits[s], columns[d])
    row, slot, x = row[place < 0], slot[place < 0], x[place < 0]
    sparse = np.flatnonzero(layout.column < 0)
    points = np.full((len(layout.splits), max([len(layout.splits[s]) for s in sparse], default=0)), np.inf)
    for s in sparse:
        points[s, : len(layout.splits[s])] = layout.splits[s]
    at = np.zeros(len(row), dtype=np.int64)
    for k in range(points.shape[1]):
        at += x > points[slot, k]
    kept = at != layout.zero[slot]
    cells = (layout.first[slot[kept]] + at[kept]).astype(np.uint16 if layout.cells < 1 << 16 else np.uint32)
    return bins, np.bincount(row[kept], minlength=n).astype(np.uint16 if len(layout.splits) < 1 << 16 else np.uint32), cells, y.astype(np.int8)


@dataclass
class Binned:
    """Rows as blocks, kept until :meth:`drop`."""

    blocks: RDD
    layout: Layout

    def drop(self) -> None:
        self.blocks.unpersist()


def fits_here(estimator) -> bool:
    """Whether the estimator is one that is grown here: a binary tree or boosted trees without weights, samples of rows or slots, or limits of a node."""
    plain = {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    given = {p.name: v for p, v in estimator.extractParamMap().items()}
    return (
        isinstance(estimator, DecisionTreeClassifier | GBTClassifier)
        and not given.keys() & {"weightCol", "validationIndicatorCol", "thresholds"}
        and all(given.get(n, v) == v for n, v in plain.items())
        and 2 <= given["maxBins"] <= 256
        and given["maxDepth"] >= 1
    )


def bin_rows(df: DataFrame, features: str, label: str, max_bins: int, seed: int, boosted: bool = False) -> Binned | None:
    """The rows binned by Spark ML's candidate splits for ``max_bins`` and ``seed``. None if a slot is marked as a category, or if the labels
    are not 0 and 1, both there.

    None also for few rows of mostly sparse slots that are to be ``boosted``: a one-hot slot and its opposite split alike, and the last digit of
    their sums decides. Spark ML's choice stays where its sums are those of a few tasks; of many rows they follow the order of its tasks.
    """
    marks = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if marks.keys() & {"nominal", "binary"}:
        return None
    rows = df.select(F.col(label).cast("double").alias("y"), F.col(features).alias("x"))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") == 1).alias("ones"), F.count_if(F.col("y") == 0).alias("zeros")).first()
    n = found["n"]
    if not found["ones"] or not found["zeros"] or found["ones"] + found["zeros"] < n:
        return None
    most = min(max_bins, n)
    wanted = max(most * most, SAMPLE_ROWS)
    sampled = [r["x"] for r in _sample(rows, wanted / n if wanted < n else 1.0, seed)]
    values: list[list[float]] = [[] for _ in range(sampled[0].size)]
    for vector in sampled:
        dense = vector.toArray()
        for s in np.flatnonzero(dense):
            values[s].append(dense[s])
    stands_for = (wanted / n if wanted < n else 1.0) * n
    splits = [_candidates(np.array(v), stands_for, most - 1) for v in values]
    away = [sum(np.searchsorted(s, v) != np.searchsorted(s, 0.0)) for s, v in zip(splits, values)]
    dense = np.array(away) > len(sampled) * DENSE_SHARE
    if n * len(splits) <= DENSE_BINS:
        if boosted and 2 * dense.sum() < len(splits):
            return None
        dense[:] = True
    layout = Layout(splits, np.flatnonzero(dense))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def packed() -> pa.RecordBatch:
            starts = np.cumsum([0] + [len(h[0]) for h in held])
            row = np.concatenate([h[1] + start for h, start in zip(held, starts)])
            y, slot, x = (np.concatenate([h[i] for h in held]) for i in (0, 2, 3))
            return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_block(y, row, slot, x, layout), 5)], pa.binary())], names=["b"])

        for batch in batches:
            y, i, x = batch.columns
            held.append((y.to_numpy(zero_copy_only=False), *_entries(i, x)))
            count += len(y)
            if count >= BLOCK_ROWS:
                yield packed()
                held, count = [], 0
        if held:
            yield packed()

    made = rows.select("y", *vector_parts("x")).mapInArrow(blocks, "b binary")
    return Binned(made.rdd.map(lambda r: pickle.loads(r["b"])).persist(StorageLevel.MEMORY_AND_DISK), layout)


# -- one tree -------------------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as lists; ``left`` is 0 for a leaf. ``sums`` of a node are those of its labels: count, sum and sum of squares, or rows of label 0 and 1."""

    impurity: str
    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [255])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    sums: list[np.ndarray | None] = field(default_factory=lambda: [None])
    depth: int = 0

    def add(self, sums: np.ndarray) -> int:
        for values, value in ((self.feature, 0), (self.bin, 255), (self.left, 0), (self.right, 0), (self.gain, -1.0), (self.sums, sums)):
            values.append(value)
        return len(self.left) - 1

    def predictions(self) -> np.ndarray:
        return _predicted(np.array(self.sums).T, self.impurity)

    def steps(self) -> tuple:
        """What tasks need to walk down the tree: a leaf's step ends where it is."""
        own = np.arange(len(self.left))
        left, right = np.array(self.left), np.array(self.right)
        children = np.stack([np.where(left == 0, own, left), np.where(left == 0, own, right)], axis=1).ravel()
        return self.depth, np.array(self.feature), np.array(self.bin), children


def _impurity(sums: np.ndarray, kind: str) -> np.ndarray:
    """Spark ML's impurity of nodes; the first axis of ``sums`` holds their numbers."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if kind == "variance":
            count, total, squares = sums
            return np.where(count == 0, 0.0, (squares - (total * total) / count) / count)
        count = sums[0] + sums[1]
        shares = sums / count
        if kind == "gini":
            found = 1.0 - shares[0] * shares[0] - shares[1] * shares[1]
        else:
            found = np.zeros(count.shape)
            for c, share in zip(sums, shares):
                found = found - np.where(c == 0, 0.0, share * (np.log(share) / np.log(2.0)))
        return np.where(count == 0, 0.0, found)


def _predicted(sums: np.ndarray, kind: str) -> np.ndarray:
    return sums[1] / sums[0] if kind == "variance" else (sums[1] > sums[0]).astype(float)


def _count(sums: np.ndarray, kind: str) -> np.ndarray:
    return sums[0] if kind == "variance" else sums[0] + sums[1]


def _walk(block: tuple, entry_row: np.ndarray, steps: tuple, layout: Layout) -> np.ndarray:
    """The node of each row of a block."""
    depth, feature, split, children = steps
    bins, _, cells, y = block[:4]
    n = len(y)
    node, rows, flat = np.zeros(n, dtype=np.int64), np.arange(n), bins.ravel()
    for _ in range(depth):
        slot = feature[node]
        column = layout.column[slot]
        if len(layout.dense) == len(layout.splits):
            found = flat[column * n + rows]
        else:
            found = layout.zero[slot]
            on = np.flatnonzero(column >= 0)
            found[on] = flat[column[on] * n + on]
            hit = np.flatnonzero(layout.slot_of[cells] == slot[entry_row])
            found[entry_row[hit]] = layout.bin_of[cells[hit]]
        node = children[2 * node + (found > split[node])]
    return node


def _entry_row(block: tuple) -> np.ndarray:
    return np.repeat(np.arange(len(block[3])), block[1])


def _add_sums(out: np.ndarray, block: tuple, entry_row: np.ndarray, place: np.ndarray, weights: list, layout: Layout) -> None:
    """Adds a block's labels to ``out``: kind of sum, node, cell; the last node takes rows that are not looked at, the last cell the whole node."""
    bins, _, cells, _ = block[:4]
    nodes = out.shape[1]
    for d, s in enumerate(layout.dense):
        width = len(layout.splits[s]) + 1
        if width == 1:
            continue
        at = place * width + bins[d]
        for k, w in enumerate(weights):
            out[k, :, layout.first[s] : layout.first[s + 1]] += np.bincount(at, w, nodes * width).reshape(nodes, width)
    if len(cells):
        at = place[entry_row] * layout.cells + cells
        for k, w in enumerate(weights):
            out[k, :, :-1] += np.bincount(at, None if w is None else w[entry_row], nodes * layout.cells).reshape(nodes, -1)
    for k, w in enumerate(weights):
        out[k, :, -1] += np.bincount(place, w, nodes)


def _best(sums: np.ndarray, own: np.ndarray | None, kind: str, layout: Layout) -> tuple:
    """The best split of each node by Spark ML's rules: gain, slot, bin, and the sums of the node and of both sides. ``own`` are the nodes' sums, if known."""
    if kind != "variance":  # rows and rows of label 1, to rows of label 0 and 1
        sums = np.stack([sums[0] - sums[1], sums[1]])
    total, m = sums[:, :, -1], sums.shape[1]
    gain, slot, at = np.full(m, -np.inf), np.zeros(m, dtype=int), np.zeros(m, dtype=int)
    sides = np.zeros((2, len(sums), m))
    for s, points in enumerate(layout.splits):
        if not len(points):
            continue
        part = sums[:, :, layout.first[s] : layout.first[s + 1]]
        if layout.column[s] < 0:
            part = part.copy()
            part[:, :, layout.zero[s]] = total - part.sum(axis=2)
        upto = np.cumsum(part, axis=2)
        left = upto[:, :, :-1]
        right = upto[:, :, -1:] - left
        if own is None:
            own = left[:, :, 0] + right[:, :, 0]
        a, b = _count(left, kind), _count(right, kind)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = _impurity(own, kind)[:, None] - a / (a + b) * _impurity(left, kind) - b / (a + b) * _impurity(right, kind)
        found = np.where((a < 1) | (b < 1) | (found < 0.0), -np.inf, found)
        k = found.argmax(axis=1)
        rows = np.arange(m)
        better = np.flatnonzero(found[rows, k] > gain)
        gain[better], slot[better], at[better] = found[better, k[better]], s, k[better]
        sides[0][:, better], sides[1][:, better] = left[:, better, k[better]], right[:, better, k[better]]
    return gain, slot, at, total if own is None else own, sides


@dataclass
class _Lane:
    """A tree that grows next to others: its depth, its impurity, and the place of its margins, if it is boosted."""

    depth: int
    impurity: str
    margin: int | None = None


def _labels(block: tuple, lane: _Lane) -> list:
    """The weights that are summed for each row: 1, the label, its square; or 1 and the label 0 or 1."""
    y = block[3].astype(float)
    if lane.margin is None:
        return [None, y]
    y = 2.0 * y - 1.0
    if block[4] is not None:
        with np.errstate(over="ignore"):
            y = 4.0 * y / (1.0 + np.exp(2.0 * y * block[4][lane.margin]))
    return [None, y, y * y]


def _grow(state: RDD, lanes: list[_Lane], layout: Layout) -> list[Tree]:
    """A tree for each lane, all grown together: one job a level."""
    trees = [Tree(lane.impurity) for lane in lanes]
    open_nodes: list[list[int]] = [[0] for _ in lanes]
    context = state.context
    few = min(state.getNumPartitions(), TASKS_A_CORE * context.defaultParallelism)
    while any(open_nodes):
        work = [(i, lane, trees[i].steps(), _places(trees[i], open_nodes[i])) for i, lane in enumerate(lanes) if open_nodes[i]]
        known = {i: np.array([trees[i].sums[k] for k in nodes]).T if trees[i].sums[0] is not None else None for i, nodes in enumerate(open_nodes) if nodes}

        def level(blocks, work=work):
            sums = {}
            for block in blocks:
                entry_row = _entry_row(block)
                for i, lane, steps, (places, count) in work:
                    weights = _labels(block, lane)
                    if i not in sums:
                        sums[i] = np.zeros((len(weights), count + 1, layout.cells + 1))
                    _add_sums(sums[i], block, entry_row, places[_walk(block, entry_row, steps, layout)], weights, layout)
            for i, found in sums.items():
                for k in range(0, found.shape[1] - 1, CHUNK_NODES):
                    yield (i, k), found[:, k : min(k + CHUNK_NODES, found.shape[1] - 1)]

        def chosen(pair, known=known):
            (i, k), found = pair
            own = known[i]
            return i, k, _best(found, None if own is None else own[:, k : k + CHUNK_NODES], lanes[i].impurity, layout)

        keys = sum(-(-len(nodes) // CHUNK_NODES) for nodes in open_nodes)
        found = state.coalesce(few).mapPartitions(level).reduceByKey(np.add, min(keys, context.defaultParallelism)).map(chosen).collect()
        nodes_before, open_nodes = open_nodes, [[] for _ in lanes]
        for i, start, best in sorted(found, key=lambda x: x[:2]):
            tree, lane = trees[i], lanes[i]
            closes = tree.depth + 1 == lane.depth
            bare = [np.abs(_impurity(side, lane.impurity)) < EPSILON for side in best[4]]
            for j, node in enumerate(nodes_before[i][start : start + CHUNK_NODES]):
                if tree.sums[node] is None:
                    tree.sums[node] = best[3][:, j]
                if not best[0][j] > 0:
                    continue
                tree.gain[node], tree.feature[node], tree.bin[node] = float(best[0][j]), int(best[1][j]), int(best[2][j])
                tree.left[node], tree.right[node] = tree.add(best[4][0][:, j]), tree.add(best[4][1][:, j])
                open_nodes[i] += [c for c, empty in ((tree.left[node], bare[0][j]), (tree.right[node], bare[1][j])) if not closes and not empty]
        for i, nodes in enumerate(nodes_before):
            trees[i].depth += bool(nodes)
    return trees


def _places(tree: Tree, nodes: list[int]) -> tuple[np.ndarray, int]:
    places = np.full(len(tree.left), len(nodes))
    places[nodes] = np.arange(len(nodes))
    return places, len(nodes)


def grow_trees(binned: Binned, settings: list[tuple[int, str]]) -> list[Tree]:
    """A classification tree for each ``(depth, impurity)``."""
    return _grow(binned.blocks.map(partial(_with_margins, [], None)), [_Lane(depth, impurity) for depth, impurity in settings], binned.layout)


# -- boosting -------------------------------------------------------------------------------------------------------


def _with_margins(rounds: list, layout: Layout | None, block: tuple) -> tuple:
    """The block with its rows' margins moved on by some rounds of trees: for each lane the weight, steps and predictions of its tree."""
    margins = block[4] if len(block) > 4 else None
    entry_row = _entry_row(block)
    for lanes in rounds:
        moved = [weight * predictions[_walk(block, entry_row, steps, layout)] for weight, steps, predictions in lanes]
        margins = np.array(moved) if margins is None else margins + np.array(moved)
    return (*block[:4], margins)


def boost(binned: Binned, depths: list[int], rounds: int, rate: float) -> list[list[Tree]]:
    """Boosted regression trees for each depth, with the logistic loss and steps of Spark ML's: the first tree in full, the others by ``rate``."""
    lanes = [_Lane(depth, "variance", i) for i, depth in enumerate(depths)]
    made, state = [], binned.blocks.map(partial(_with_margins, [], None))
    done: list[list[Tree]] = [[] for _ in depths]
    old = None
    for m in range(rounds):
        trees = _grow(state, lanes, binned.layout)
        for own, tree in zip(done, trees):
            own.append(tree)
        if old is not None:
            old.unpersist()
        if m + 1 == rounds:
            break
        made.append([(1.0 if m == 0 else rate, tree.steps(), tree.predictions()) for tree in trees])
        old = state if m else None
        if (m + 1) % REBASE == 0:
            state = binned.blocks.map(partial(_with_margins, list(made), binned.layout))
        else:
            state = state.map(partial(_with_margins, made[-1:], binned.layout))
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
    state.unpersist()
    if old is not None:
        old.unpersist()
    return done


# -- Spark ML models ------------------------------------------------------------------------------------------------


def _joined(tree: Tree) -> list[int]:
    """The left children, without those of nodes whose two leaves predict the same: Spark ML joins these."""
    predictions, left = tree.predictions(), list(tree.left)
    for k in range(len(left) - 1, -1, -1):  # children stand after their node
        if left[k] and not left[left[k]] and not left[tree.right[k]] and predictions[left[k]] == predictions[tree.right[k]]:
            left[k] = 0
    return left


def _nodes(tree: Tree, layout: Layout) -> list[tuple]:
    """The tree's nodes as Spark ML stores them, each before its children."""
    predictions, left = tree.predictions(), _joined(tree)
    sums = np.array(tree.sums)
    impurities = _impurity(sums.T, tree.impurity)
    counts = _count(sums.T, tree.impurity)
    rows: list[tuple] = []

    def add(k: int) -> int:
        at = len(rows)
        rows.append(())
        head = (at, float(predictions[k]), float(impurities[k]), sums[k].tolist(), int(counts[k]))
        if not left[k]:
            rows[at] = (*head, -1.0, -1, -1, (-1, [], -1))
        else:
            s = tree.feature[k]
            a, b = add(left[k]), add(tree.right[k])
            rows[at] = (*head, tree.gain[k], a, b, (s, [float(layout.splits[s][tree.bin[k]])], -1))
        return at

    add(0)
    return rows


def _metadata(kind: str, uid: str, given: dict, defaults: dict, **more) -> str:
    return json.dumps({"class": kind, "timestamp": int(time.time() * 1000), "sparkVersion": SparkSession.active().version, "uid": uid, "paramMap": given, "defaultParamMap": defaults, **more})


def _load(spark: SparkSession, reader, path: str, metadata: str, data: DataFrame, trees: DataFrame | None = None) -> Model:
    """A model from a folder in Spark ML's form. The loaded model holds all of it."""
    spark.createDataFrame([(metadata,)], "value string").write.text(f"{path}/metadata")
    write_parquet(data, f"{path}/data")
    if trees is not None:
        write_parquet(trees, f"{path}/treesMetadata")
    return reader.load(path)


def _params(estimator) -> tuple[dict, dict]:
    return tuple({p.name: v for p, v in values.items()} for values in (estimator._paramMap, estimator._defaultParamMap))


def tree_model(spark: SparkSession, estimator: DecisionTreeClassifier, tree: Tree, layout: Layout) -> Model:
    given, defaults = _params(estimator)
    with staging(spark) as made:
        made.append(path := stage_path(spark, "tree"))
        text = _metadata("org.apache.spark.ml.classification.DecisionTreeClassificationModel", estimator.uid, given, defaults, numFeatures=len(layout.splits), numClasses=2)
        return _load(spark, DecisionTreeClassificationModel, path, text, spark.createDataFrame(_nodes(tree, layout), NODE).coalesce(1))


def boosted_model(spark: SparkSession, estimator: GBTClassifier, trees: list[Tree], layout: Layout) -> Model:
    given, defaults = _params(estimator)
    shared = {n: v for n, v in (defaults | given).items() if n in ("featuresCol", "labelCol", "maxDepth", "maxBins", "seed")}
    size = len(layout.splits)
    with staging(spark) as made:
        made.append(path := stage_path(spark, "boosted-trees"))
        text = _metadata("org.apache.spark.ml.classification.GBTClassificationModel", estimator.uid, given, defaults, numFeatures=size, numTrees=len(trees))
        kind = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
        each = [(i, _metadata(kind, f"{estimator.uid}_{i}", shared, {}), 1.0 if i == 0 else estimator.getStepSize()) for i in range(len(trees))]
        nodes = [(i, node) for i, tree in enumerate(trees) for node in _nodes(tree, layout)]
        data = spark.createDataFrame(nodes, f"treeID int, nodeData struct<{NODE}>")
        return _load(spark, GBTClassificationModel, path, text, data.coalesce(1), spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1))


def leaf_counts(tree: Tree) -> dict[int, tuple[int, int]]:
    """Rows of label 0 and 1 in each leaf of a classification tree as its model has them, leaves numbered from left to right."""
    left, found, below = _joined(tree), {}, [0]
    while below:
        k = below.pop()
        if left[k]:
            below += [tree.right[k], left[k]]
        else:
            found[len(found)] = tuple(int(x) for x in tree.sums[k])
    return found


def fit_together(estimators: list, df: DataFrame) -> list[tuple[Model, Tree]] | None:
    """The models of estimators that are all trees, or all boosted trees, with their last trees. Those with the same bins grow together, and equal trees
    once: of depths that differ the caller asks for the deepest. None if one of them is not for :func:`fits_here`, or the rows not for :func:`bin_rows`."""
    if not all(fits_here(e) for e in estimators):
        return None
    groups: dict[tuple, list[int]] = {}
    for i, e in enumerate(estimators):
        groups.setdefault((e.getFeaturesCol(), e.getLabelCol(), e.getMaxBins(), e.getSeed(), e.getStepSize() if isinstance(e, GBTClassifier) else None), []).append(i)
    found: dict[int, tuple[Model, Tree]] = {}
    spark = df.sparkSession
    for (features, label, bins, seed, rate), members in groups.items():
        binned = bin_rows(df, features, label, bins, seed, rate is not None)
        if binned is None:
            return None
        try:
            if rate is None:
                kinds = sorted({(estimators[i].getMaxDepth(), estimators[i].getImpurity()) for i in members})
                grown = dict(zip(kinds, grow_trees(binned, kinds)))
                for i in members:
                    tree = grown[estimators[i].getMaxDepth(), estimators[i].getImpurity()]
                    found[i] = tree_model(spark, estimators[i], tree, binned.layout), tree
            else:
                depths = sorted({estimators[i].getMaxDepth() for i in members})
                boosted = dict(zip(depths, boost(binned, depths, max(estimators[i].getMaxIter() for i in members), rate)))
                for i in members:
                    trees = boosted[estimators[i].getMaxDepth()][: estimators[i].getMaxIter()]
                    found[i] = boosted_model(spark, estimators[i], trees, binned.layout), trees[-1]
        finally:
            binned.drop()
    return [found[i] for i in range(len(estimators))]
