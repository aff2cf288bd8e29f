"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad, by its own features, those of its neighbours and the state of the line before. Forward-backward
gives each line's probability of good; their mean, weighted by line length, is mapped to the probability that the document's
label is good.

Labels are of documents, so the lines' states are learned in rounds: lines of good documents are good; lines of bad ones are
bad at first, and afterwards those that the last fit finds likelier bad, the worst one at least.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import bounded_sample, documents_of, staged

SYMBOLS = re.compile(r"[#*$%&|<>{}\\^~_=]")
#: The field is fitted on at most so many labelled documents, those with the smallest hash of their id.
FIT_DOCUMENTS = 4000
#: And on at most so many of their lines, where 200 characters count as one more line: documents are taken in the order of that
#: hash while the sum lasts, and those with more than ``FIT_LONGEST`` are left out of the fit. Scoring knows no such bound.
FIT_SIZE = 400_000
FIT_LONGEST = 4000
#: In fitting, longer documents count as several of at most so many lines. Scoring takes them whole.
FIT_LINES = 60
OWN = 16
WIDTH = 1 + 3 * OWN


def line_features(line: str, words: list[str], seen: bool) -> list[float]:
    """What a line looks like, as numbers between 0 and about 1."""
    n, chars = len(words), len(line)
    if not n:
        return [1.0] + [0.0] * (OWN - 1)
    letters = sum(map(str.isalpha, line))
    upper = sum(map(str.isupper, line))
    marks = len(SYMBOLS.findall(line))
    digits = sum(map(str.isdigit, line))
    size = sum(map(len, words)) / n
    share_upper, share_marks = upper / max(1, letters), marks / chars
    return [
        0.0,
        min(1.0, n / 40),
        float(n < 4),
        float(size < 3),
        float(size > 9),
        share_upper,
        float(share_upper > 0.5),
        min(1.0, 5 * share_marks),
        float(share_marks > 0.02),
        float(share_marks > 0.08),
        min(1.0, 4 * digits / chars),
        letters / chars,
        float(words[-1][-1] in ".!?:;…\"'”»)"),
        float(seen),
        1 - len(set(words)) / n,
        float(n > 8 and len(set(words)) < 0.5 * n),
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of features (own, line before, line after, constant) and a length for each line that has a word."""
    own, lengths, seen = [], [], set()
    for line in text.split("\n"):
        words = line.split()
        if words:
            key = hash(line)
            own.append(line_features(line, words, key in seen))
            lengths.append(len(line))
            seen.add(key)
    x = np.array(own, dtype=float).reshape(-1, OWN)
    none = np.zeros((1, OWN))
    return np.c_[np.ones(len(x)), x, np.r_[none, x[:-1]][: len(x)], np.r_[x[1:], none][: len(x)]], np.array(lengths, dtype=float)


@dataclass(frozen=True)
class LineField:
    """``weights`` of good against bad; ``moves[a, b]``: from state a to b, 0 bad and 1 good; ``slope``, ``shift``: to the label's probability."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def marginals(self, x: np.ndarray) -> np.ndarray:
        """P(good) of each line, by forward-backward over the whole document in constant memory a line."""
        gain = np.clip(x @ self.weights, -30, 30)
        up = np.exp(gain)  # of good; bad has 1
        (a, b), (c, d) = np.exp(self.moves).tolist()
        n = len(gain)
        forward, backward, gains = [0.0] * n, [0.5] * n, up.tolist()
        p = 0.5
        for t in range(n):
            bad, good = ((1 - p) * a + p * c, ((1 - p) * b + p * d) * gains[t]) if t else (1.0, gains[t])
            p = forward[t] = good / (bad + good)
        q = 0.5
        for t in range(n - 1, 0, -1):
            bad, good = (1 - q), q * gains[t]
            left, right = a * bad + b * good, c * bad + d * good
            q = backward[t - 1] = right / (left + right)
        f, r = np.array(forward), np.array(backward)
        return f * r / (f * r + (1 - f) * (1 - r))

    def share(self, x: np.ndarray, lengths: np.ndarray) -> float:
        """Length-weighted mean of the marginals; a text without a line has 0."""
        return float(self.marginals(x) @ lengths / lengths.sum()) if len(x) else 0.0

    def score(self, share: float) -> float:
        return 1 / (1 + np.exp(-np.clip(self.slope * share + self.shift, -40, 40)))


def _fit_field(xs: list[np.ndarray], ys: list[np.ndarray], steps: int = 150, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Penalised maximum likelihood of the states, by gradient steps with per-coordinate scaling; all chains at once, padded."""
    n, longest = len(xs), max(len(x) for x in xs)
    size = np.array([len(x) for x in xs])
    flat = np.concatenate(xs)
    row = np.repeat(np.arange(n), size)
    place = np.concatenate([np.arange(k) for k in size])
    y = np.concatenate(ys)
    inside = np.zeros((n, longest), bool)
    inside[row, place] = True
    inner = np.flatnonzero(place > 0)
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (y[inner - 1], y[inner]), 1)
    parameters = np.zeros(WIDTH + 4)
    mean, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, steps + 1):
        gain = np.zeros((n, longest))
        gain[row, place] = flat @ parameters[:WIDTH]
        m = np.exp(parameters[WIDTH:].reshape(2, 2))
        local = np.stack([np.ones((n, longest)), np.exp(np.clip(gain, -30, 30))], axis=2)
        f, b = np.zeros((longest, n, 2)), np.ones((longest, n, 2))
        f[0] = local[:, 0] / local[:, 0].sum(axis=1, keepdims=True)
        for t in range(1, longest):
            now = f[t - 1] @ m * local[:, t]
            f[t] = np.where(inside[:, t : t + 1], now / now.sum(axis=1, keepdims=True), f[t - 1])
        for t in range(longest - 1, 0, -1):
            now = (b[t] * local[:, t]) @ m.T
            b[t - 1] = np.where(inside[:, t : t + 1], now / now.sum(axis=1, keepdims=True), 1.0)
        marginal = f * b
        marginal /= marginal.sum(axis=2, keepdims=True)
        expected = np.zeros((2, 2))
        for t in range(1, longest):
            both = f[t - 1][:, :, None] * m[None] * (local[:, t] * b[t])[:, None, :]
            expected += (both / both.sum(axis=(1, 2), keepdims=True))[inside[:, t]].sum(axis=0)
        gradient = np.r_[flat.T @ (y - marginal[place, row, 1]), (pairs - expected).ravel()] - penalty * parameters
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        parameters = parameters + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return parameters[:WIDTH], parameters[WIDTH:].reshape(2, 2)


def _fit_map(shares: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic map from the share of good lines to the label, by Newton steps with a small penalty."""
    w, x = np.array([1.0, 0.0]), np.c_[shares, np.ones(len(shares))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-2])
        w = w + np.linalg.solve(hessian, x.T @ (labels - p) - 1e-2 * w)
    return float(w[0]), float(w[1])


def fit_documents(texts: list[str], labels: list[int], rounds: int = 3) -> LineField:
    """From texts and their labels (1 good). With one label alone every document has the share of that label as its score."""
    labels_of = np.array(labels, dtype=np.int64)
    if len(set(labels)) < 2:
        share = (labels_of.sum() + 1) / (len(labels) + 2)
        return LineField(np.zeros(WIDTH), np.zeros((2, 2)), 0.0, float(np.log(share / (1 - share))))
    made = [document_features(t) for t in texts]
    chains = [(i, x[k : k + FIT_LINES]) for i, (x, _) in enumerate(made) for k in range(0, len(x), FIT_LINES)]
    states = [np.full(len(x), labels_of[i]) for i, x in chains]
    xs = [x for _, x in chains]
    field = None
    for _ in range(rounds):
        field = LineField(*_fit_field(xs, states))
        for k, (i, x) in enumerate(chains):
            if labels_of[i] == 0:
                p = field.marginals(x)
                states[k] = (p > 0.5).astype(np.int64)
                states[k][p.argmin()] = 0
    shares = np.array([field.share(x, n) for x, n in made])
    return LineField(field.weights, field.moves, *_fit_map(shares, labels_of))


def held_out(doc_id: str) -> Column:
    """Rows kept from learning: crc32 of the id as text has remainder 2 by 4. A NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", documents: int = FIT_DOCUMENTS) -> LineField:
    """Fits on a bounded sample of the labelled rows that are not held out. NULL labels are left out; of repeated ones the least counts.

    Of rows with the same id, the text with the least hash counts. No labels: every document scores one half.
    """
    marked = labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    marked = marked.groupBy(F.col("doc_id").alias("_id")).agg(F.min(label_col).cast("int").alias("y"))
    marked = staged(bounded_sample(marked, "_id", documents), "quality-labels")
    texts = documents_of(docs, id_col, text_col).join(F.broadcast(marked), F.col("doc_id") == F.col("_id")).select("doc_id", "y", "text")
    texts = staged(texts.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")), "quality-texts")
    sizes = texts.select(F.col("doc_id").alias("_id"), (F.size(F.split("text", "\n")) + F.floor(F.length("text") / 200)).alias("n")).where(F.col("n") <= FIT_LONGEST)
    # At most ``documents`` pairs of id and size, without their texts.
    taken = sizes.withColumn("sum", F.sum("n").over(Window.orderBy(F.xxhash64("_id", F.lit("sample")), "_id"))).where(F.col("sum") <= FIT_SIZE)
    texts = texts.join(F.broadcast(taken), F.col("doc_id") == F.col("_id"), "left_semi")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((i, y, t) for b in batches for i, y, t in zip(*(c.to_pylist() for c in b.columns)))
        field = fit_documents([r[2] for r in rows], [r[1] for r in rows])
        flat = [*field.weights.tolist(), *field.moves.ravel().tolist(), field.slope, field.shift]
        yield pa.RecordBatch.from_arrays([pa.array([flat], pa.list_(pa.float64()))], names=["p"])

    # One task fits: its rows are the bounded sample, whatever the size of the corpus.
    fitted = staged(texts.repartition(1).mapInArrow(learn, "p array<double>"), "quality-field").first()
    p = np.array(fitted["p"] if fitted else [0.0] * (WIDTH + 6))
    return LineField(p[:WIDTH], p[WIDTH : WIDTH + 4].reshape(2, 2), float(p[-2]), float(p[-1]))


def predict(docs: DataFrame, field: LineField, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """A row for each row: ``doc_id``, ``held_out``, ``score`` (chance of label 1), ``predicted`` and ``good_share`` of the lines.

    NULL, empty and blank texts have no line and a share of 0. Repeated rows and rows without an id are scored each. Empty
    table: no rows. Only the text decides; other columns are left out.
    """
    rows = documents_of(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shares = [field.share(*document_features(t)) for t in batch.column(1).to_pylist()]
            scores = np.array([field.score(s) for s in shares], dtype=float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(shares, pa.float64())], names=["doc_id", "score", "predicted", "good_share"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, score double, predicted int, good_share double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "good_share")
