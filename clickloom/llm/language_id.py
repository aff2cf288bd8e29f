"""Language by prediction by partial matching: a context tree of bytes for each language, and exact code lengths under it.

Each language has counts of every byte after the 0 to ``ORDER`` bytes before it. The cost of a byte, in bits, comes from the longest
of these contexts that the language has seen: if the byte followed there, -log2 n / (t + q), with n its count, t the context's total
and q its number of different next bytes; if not, an escape of -log2 q / (t + q), and the cost in the context one byte shorter.
Below the empty context a byte costs 8 bits. Nothing is excluded after an escape, and the counts are frozen while texts are scored,
so a text's code length is the sum over its bytes, and the language with the shortest one is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import documents_of, staged
from clickloom.llm.line_quality import held_out

#: Longest context in bytes, 6 at most.
ORDER = 4
#: Bounds of the sample that the counts come from: so many stretches of labelled texts, over all languages, of so many characters.
FIT_PIECES = 1_200
PIECE = 2_048
#: Bytes that are scored at a time.
STRETCH = 1 << 18
UNKNOWN = "und"


def sequences(data: np.ndarray, order: int) -> np.ndarray:
    """For each byte after the first ``ORDER``: itself (the lowest byte) and the ``order`` bytes before it, as one number."""
    out = data[ORDER:].astype(np.uint64)
    for j in range(1, order + 1):
        out |= data[ORDER - j : len(data) - j].astype(np.uint64) << np.uint64(8 * j)
    return out


def padded(text: str) -> bytes:
    """The bytes of a text after ``ORDER`` line ends, the context of its first byte."""
    return b"\n" * ORDER + text.encode()


class Lookup:
    """Row numbers of known 64-bit keys: open addressing in one array, for many keys at once."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys, self.rows = np.zeros(1 << bits, dtype=np.uint64), np.full(1 << bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.rows[slot] < 0
            _, chosen = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[chosen]
            self.keys[slot[put]], self.rows[slot[put]] = keys[left[put]], left[put]
            rest = np.ones(len(left), dtype=bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + np.uint64(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 for unknown ones."""
        slot = self._slot(keys)
        out = self.rows[slot]
        other = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        slot = slot[other]
        while len(other):
            slot = (slot + np.uint64(1)) & self.mask
            row = self.rows[slot]
            end = (row < 0) | (self.keys[slot] == keys[other])
            out[other[end]] = row[end]
            other, slot = other[~end], slot[~end]
        return out


@dataclass
class Trees:
    """The context trees of all languages: for each order the bits of known sequences and of escapes from known contexts."""

    languages: list[str]
    known: list[Lookup]
    bits: list[np.ndarray]
    contexts: list[Lookup]
    escapes: list[np.ndarray]

    def code_lengths(self, texts: list[str]) -> np.ndarray:
        """Bits of each text in each language."""
        data = np.frombuffer(b"".join(padded(t) for t in texts) or b"\n" * ORDER, dtype=np.uint8)
        ends = np.cumsum([len(t.encode()) + ORDER for t in texts])
        out = np.zeros((len(texts), len(self.languages)))
        step = max(1024, STRETCH * 4 // max(4, len(self.languages)))
        for lo in range(ORDER, len(data), step):
            part = data[lo - ORDER : lo + step]
            at = np.arange(lo, lo - ORDER + len(part))
            of = np.searchsorted(ends, at, side="right")
            real = at - (ends - np.array([len(t.encode()) + ORDER for t in texts]))[of] >= ORDER if len(texts) else at < 0
            of, cost = of[real], self._costs(part, real)
            if len(of):
                starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                out[of[starts]] += np.add.reduceat(cost, starts, axis=0)
        return out

    def _costs(self, part: np.ndarray, real: np.ndarray) -> np.ndarray:
        whole = sequences(part, ORDER)[real]
        cost = np.zeros((len(whole), len(self.languages)))
        rest = np.arange(len(whole))
        for order in range(ORDER, -1, -1):
            keys = whole[rest] & np.uint64((1 << 8 * (order + 1)) - 1)
            row = self.known[order].find(keys)
            hit = row >= 0
            cost[rest[hit]] += self.bits[order][row[hit]]
            rest, keys = rest[~hit], keys[~hit]
            row = self.contexts[order].find(keys >> np.uint64(8))
            cost[rest[row >= 0]] += self.escapes[order][row[row >= 0]]
        cost[rest] += 8.0
        return cost


def trees_of(languages: list[str], order: np.ndarray, key: np.ndarray, language: np.ndarray, n: np.ndarray) -> Trees:
    """From counts ``n`` of each sequence of each order in each language. Every order has the sequences of the order above."""
    trees = Trees(languages, [], [], [], [])
    width = len(languages)
    shorter = None
    for k in range(ORDER + 1):
        mine = order == k
        keys, row = np.unique(key[mine], return_inverse=True)
        counts = np.zeros((len(keys), width))
        np.add.at(counts, (row, language[mine]), n[mine])
        contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
        total, different = np.zeros((len(contexts), width)), np.zeros((len(contexts), width))
        np.add.at(total, of, counts)
        np.add.at(different, of, counts > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(different / (total + different)), 0.0)
            direct = -np.log2(counts / (total + different)[of])
        below = 8.0 if shorter is None else shorter[1][np.searchsorted(shorter[0], keys & np.uint64((1 << 8 * k) - 1))]
        bits = np.where(counts > 0, direct, escape[of] + below)
        trees.known.append(Lookup(keys))
        trees.bits.append(bits)
        trees.contexts.append(Lookup(contexts))
        trees.escapes.append(escape)
        shorter = (keys, bits)
    return trees


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", pieces: int = FIT_PIECES) -> Trees:
    """Counts from a bounded sample of the rows that are not held out and have a language: at most ``pieces`` stretches of ``PIECE``
    characters in all (at least one for each language), drawn by hash from all stretches of all texts, as many for each language.

    NULL and empty texts have no stretch. No labelled text: no languages.
    """
    marked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    marked = marked.where(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out("doc_id"))
    n_pieces = F.ceil(F.length("text") / PIECE)
    numbers = marked.groupBy("lang").agg(F.sum(n_pieces).alias("n")).orderBy("lang").collect()
    languages = [r["lang"] for r in numbers]
    share = max(1, pieces // max(1, len(languages)))
    # A little more than the share by hash, and of these the smallest hashes: no language's stretches are all sorted.
    rate = {r["lang"]: min(1.0, (1.3 * share + 20) / r["n"]) for r in numbers}
    of = F.try_element_at(F.create_map(*[F.lit(x) for kv in rate.items() for x in kv]), F.col("lang")) if rate else F.lit(0.0)
    cut = marked.select("lang", "text", F.col("doc_id").cast("string").alias("_id"), F.explode(F.sequence(F.lit(0), n_pieces.cast("int") - 1)).alias("_k"))
    drawn = cut.withColumn("_draw", F.xxhash64("_id", "_k", F.lit("language")))
    drawn = drawn.where(F.pmod(F.col("_draw"), F.lit(1 << 30)) < of * float(1 << 30))
    drawn = drawn.select("lang", "_draw", F.expr(f"substring(text, _k * {PIECE} + 1, {PIECE})").alias("piece"))
    first = Window.partitionBy("lang").orderBy("_draw", "piece")
    sample = staged(drawn.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= share).select("lang", "piece"), "language-pieces")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in sorted(set(langs)):
                data = [np.frombuffer(padded(t), dtype=np.uint8) for x, t in zip(langs, texts) if x == lang]
                for order in range(ORDER + 1):
                    key, n = np.unique(np.concatenate([sequences(d, order) for d in data]), return_counts=True)
                    columns = [pa.array([lang] * len(key)), pa.array(np.full(len(key), order, dtype=np.int32)), pa.array(key.astype(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "order", "key", "n"])

    counted = sample.mapInArrow(count, "lang string, order int, key bigint, n bigint").groupBy("lang", "order", "key").agg(F.sum("n").alias("n"))
    table = staged(counted, "language-counts").toArrow()
    index = pc.index_in(table.column("lang"), pa.array(languages, pa.string())).to_numpy().astype(np.int64)
    column = lambda c: table.column(c).to_numpy()
    return trees_of(languages, column("order"), column("key").astype(np.uint64), index, column("n").astype(float))


def predict(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``bits``, the code length of the text in that language.

    The score is the language's chance if all were as likely before: 1 over the sum of 2^(its bits - bits of each). NULL texts and
    those without a letter, and all if no language was learned, are ``und`` with a score of 0. Of equal code lengths the first
    language by name counts. Whole texts are scored, in stretches. Repeated rows and rows without an id are scored each.
    """
    rows = documents_of(docs, id_col, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = pa.array([*known.languages, UNKNOWN], pa.string())
        for batch in batches:
            texts = batch.column(1)
            sizes = np.cumsum(pc.binary_length(texts).to_numpy()) // (1 << 20)
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                some = texts.slice(lo, hi - lo).to_pylist()
                best, score, least = np.full(len(some), len(known.languages)), np.zeros(len(some)), np.zeros(len(some))
                if known.languages:
                    bits = known.code_lengths(some)
                    letters = np.array([any(map(str.isalpha, t)) for t in some])
                    chosen, lowest = bits.argmin(axis=1), bits.min(axis=1)
                    chance = 1 / np.exp2(np.maximum(lowest[:, None] - bits, -1000)).sum(axis=1)
                    best, score, least = np.where(letters, chosen, best), np.where(letters, chance, 0.0), np.where(letters, lowest, 0.0)
                columns = [batch.column(0).slice(lo, hi - lo), names.take(pa.array(best)), pa.array(score), pa.array(least)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "bits"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "bits")
