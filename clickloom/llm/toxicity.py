"""Toxicity by cumulative-link ordinal regression on sparse text features.

One weight for each feature is shared by all ordered thresholds: P(grade > k) = sigmoid(w.x - t_k). Features are the words of
a text and the beginnings of its words, each counted once; only those most associated with toxic labels are kept. The result
is a probability for each grade and the expected severity.

Where labels only say toxic or not, ``grades_from`` makes grades: 0 for clean, 1 to 3 by thirds of how many of the selected
features a toxic document has, relative to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import bounded_sample, documents_of, staged

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (5, 7)
#: The regression is fitted on at most so many labelled documents, those with the smallest hash of their id.
FIT_ROWS = 12000
FIT_FEATURES = 1500
GRADES = 4


def features_of(word: str) -> list[int]:
    """Signed 64-bit hashes of a lower-cased word and of its beginnings."""
    parts = [f"w{word}", *(f"p{word[:n]}" for n in PREFIXES if len(word) > n)]
    return [xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) - (1 << 63) for p in parts]


def words_in(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


@dataclass(frozen=True)
class OrdinalModel:
    weights: dict[int, float]
    cuts: tuple[float, ...]

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) in column k."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - np.array(self.cuts), -60, 60)))


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, width: int, penalty: float = 1.0, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending cuts of the largest penalised likelihood. ``rows``: the feature numbers of each text.

    Gradient steps with per-coordinate scaling; cuts are kept in order as a first cut and positive gaps. Same data, same result.
    """
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.concatenate(rows) if rows else np.empty(0, np.int64)
    n_cuts = GRADES - 1
    w, first, gaps = np.zeros(width), 1.0, np.zeros(n_cuts - 1)
    parameters = np.r_[w, first, gaps]
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        w, cuts = parameters[:width], np.cumsum(np.r_[parameters[width], np.exp(parameters[width + 1 :])])
        score = np.bincount(at, w[feature], len(rows))
        above = np.c_[np.ones(len(rows)), 1 / (1 + np.exp(-np.clip(score[:, None] - cuts, -60, 60))), np.zeros(len(rows))]
        slope = above * (1 - above)
        k = np.arange(len(rows))
        chance = np.maximum(above[k, grades] - above[k, grades + 1], 1e-12)
        by_score = (slope[k, grades] - slope[k, grades + 1]) / chance
        by_cut = np.zeros(n_cuts)
        np.add.at(by_cut, np.minimum(grades, n_cuts) - 1, np.where(grades > 0, -slope[k, grades] / chance, 0))
        np.add.at(by_cut, np.minimum(grades, n_cuts - 1), np.where(grades < n_cuts, slope[k, grades + 1] / chance, 0))
        tail = np.cumsum(by_cut[::-1])[::-1]
        gradient = np.r_[np.bincount(feature, by_score[at], width) - penalty * w, tail[0], tail[1:] * np.exp(parameters[width + 1 :])]
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        parameters = parameters + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return parameters[:width], np.cumsum(np.r_[parameters[width], np.exp(parameters[width + 1 :])])


def grades_from(toxic: np.ndarray, hits: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Grade 0 for clean texts, 1 to 3 by thirds of the share of selected features among toxic ones."""
    share = hits / np.maximum(1, size) ** 0.5
    low, high = np.quantile(share[toxic == 1], [1 / 3, 2 / 3]) if (toxic == 1).any() else (0.0, 0.0)
    return np.where(toxic == 1, 1 + (share > low) + (share > high), 0).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = FIT_ROWS, n_features: int = FIT_FEATURES) -> OrdinalModel:
    """From labels (0 or 1, or grades up to 3) of a bounded sample. NULL labels are left out; of repeated ones the worst counts.

    Without two labels there are no weights, and every text has grade 0.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
    marked = staged(bounded_sample(marked, "_id", rows), "toxic-labels")
    texts = documents_of(docs, id_col, text_col).join(F.broadcast(marked), F.col("doc_id") == F.col("_id")).select("doc_id", "y", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({f for w in words_in(t) for f in features_of(w)}) for t in batch.column(2).to_pylist()]
            sizes = [len(words_in(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "y", "size", "f"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    # Rows are told apart by number: several may have one labelled id.
    sample = texts.mapInArrow(run, f"doc_id {kind}, y int, size int, f array<bigint>").withColumn("row", F.monotonically_increasing_id())
    sample = staged(sample, "toxic-sample")
    total = sample.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("y") > 0).alias("bad")).first()
    n, bad = total["n"], total["bad"]
    if not 0 < bad < n:
        return OrdinalModel({}, (30.0,) * (GRADES - 1))
    counts = sample.select(F.explode("f").alias("f"), (F.col("y") > 0).alias("bad")).groupBy("f").agg(F.count(F.lit(1)).alias("all"), F.count_if("bad").alias("b"))
    # Pearson's chi-square of presence and label, for features that toxic texts have more often.
    share = F.lit(bad / n)
    surplus = F.col("b") - F.col("all") * share
    chi = surplus * surplus / (F.col("all") * share * (1 - share) * (1 - F.col("all") / n) + 0.5)
    best = counts.where((F.col("b") >= 3) & (surplus > 0)).withColumn("chi", chi).orderBy(F.desc("chi"), "f").limit(n_features).where("chi > 6")
    best = staged(best, "toxic-features")
    numbers = {r["f"]: k for k, r in enumerate(best.orderBy(F.desc("chi"), "f").collect())}
    kept = sample.select("row", F.explode("f").alias("f")).join(F.broadcast(best.select("f")), "f")
    kept = kept.groupBy("row").agg(F.sort_array(F.collect_list("f")).alias("f"))
    table = sample.select("row", "doc_id", "y", "size").join(kept, "row", "left").orderBy("doc_id", "size", "f").collect()  # at most ``rows`` rows of ``n_features`` numbers
    found = [np.array([numbers[f] for f in r["f"] or []], dtype=np.int64) for r in table]
    y, size = np.array([r["y"] for r in table]), np.array([r["size"] for r in table])
    grades = np.minimum(y, GRADES - 1) if y.max() > 1 else grades_from(y, np.array([len(f) for f in found]), size)
    weights, cuts = fit_ordinal(found, grades, len(numbers))
    return OrdinalModel({f: float(weights[k]) for f, k in numbers.items() if abs(weights[k]) > 0.01}, tuple(cuts.tolist()))


def predict(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.45) -> DataFrame:
    """A row for each row: ``doc_id``, ``severity`` (expected grade), ``p_toxic`` (of a grade above 0), ``grade`` (the likeliest) and ``toxic``.

    NULL or empty texts have no feature, so the chance of a text without any. Repeated rows and rows without an id are scored
    each. Empty table: no rows. Other columns are left out.
    """
    rows = documents_of(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, ...]] = {}
        weights = model.weights
        for batch in batches:
            scores = []
            for text in batch.column(1).to_pylist():
                hit: set[int] = set()
                if len(cache) > 500_000:
                    cache.clear()
                for w in words_in(text):
                    found = cache.get(w)
                    if found is None:
                        found = cache[w] = tuple(f for f in features_of(w) if f in weights)
                    if found:
                        hit.update(found)
                scores.append(sum(weights[f] for f in sorted(hit)))
            above = model.above(np.array(scores, dtype=float))
            each = -np.diff(np.c_[np.ones(len(scores)), above, np.zeros(len(scores))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array((above[:, 0] >= threshold).astype(np.int32))],
                names=["doc_id", "severity", "p_toxic", "grade", "toxic"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, severity double, p_toxic double, grade int, toxic int")
