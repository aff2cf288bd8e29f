"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names are typed placeholders, other words their lower-cased form. Windows
of template tokens of the documents are hash-joined with those of the benchmark; then the slots are checked: all places where
a benchmark item has the same number, unit or name must have one and the same value in its copy too, which may be another one.
So a question is found again with other names and numbers, but only if they are exchanged consistently. Each occurrence in a
document is checked by itself, so variants of a question that stand beside it do not hide it.

Items that have no such window, as they are shorter or have placeholders only, have nothing that a template could hold on to.
They are looked for with their real words and numbers: a shorter one as a whole text, a longer one by its windows.

A capitalised word counts as a name if its lower-cased form is no word of the benchmark. Whether a word or a window can occur
in the benchmark is asked of two bitmaps of a fixed size, made from all of it; the join then decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import documents_of, staged

# Words for numbers and units.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half third quarter dozen"
).split()
UNITS = (
    "mm cm dm km meter meters metre metres mile miles inch inches foot feet yard yards mg kg gram grams kilogram kilograms "
    "ounce ounces pound pounds ton tons ml liter liters litre litres gallon gallons second seconds minute minutes hour hours "
    "day days week weeks month months year years percent cent cents dollar dollars euro euros degree degrees mph kmh watt watts "
    "volt volts joule joules"
).split()
TOKEN = re.compile(r"[^\W_]+(?:[.,][0-9]+)*")
NUMBER, UNIT, NAME = 1, 2, 3
#: Bits of a bitmap, as a power of two: 8 MB, whatever the size of the benchmark.
MAP_BITS = 26
#: A benchmark with more windows than this is joined by a shuffle and not broadcast.
BROADCAST_WINDOWS = 500_000


def _word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 4  # never one of the placeholders


class Bitmap:
    """A set of 64-bit hashes, as bits: has every member and few others."""

    def __init__(self, rows: list[tuple[int, int]]) -> None:
        self.words = np.zeros(1 << (MAP_BITS - 6), dtype=np.uint64)
        for at, bits in rows:
            self.words[at] = np.uint64(bits & 0xFFFFFFFFFFFFFFFF)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        bit = hashes >> np.uint64(64 - MAP_BITS)
        return self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1) == 1


def _bitmap(hashes: DataFrame) -> Bitmap:
    """From a column ``h`` (signed). At most 2 ** (MAP_BITS - 6) rows come to the driver, however many hashes there are."""
    bit = F.shiftrightunsigned("h", 64 - MAP_BITS)
    rows = hashes.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(h, {64 - MAP_BITS}) & 63 as int)))").alias("bits"))
    return Bitmap([(r["at"], r["bits"]) for r in rows.collect()])


class Templates:
    """Template tokens and windows of texts. ``vocabulary``: bitmap of the lower-cased words of the benchmark."""

    MOST_CACHED = 500_000

    def __init__(self, vocabulary: Bitmap, size: int) -> None:
        self.vocabulary, self.size, self.cache = vocabulary, size, {}
        self.numbers, self.units = frozenset(NUMBER_WORDS), frozenset(UNITS)
        self.factors = np.array([pow(0x9E3779B97F4A7C15, size - k, 1 << 64) for k in range(size)], dtype=np.uint64)

    def learn(self, words: list[str]) -> None:
        """Token of each new word: a placeholder's number, the hash of the word, or 0 for a word that the benchmark does not have."""
        lows = [w.lower() for w in words]
        hashes = [_word_hash(x) for x in lows]
        known = self.vocabulary.has(np.array(hashes, dtype=np.uint64)).tolist()
        for word, low, h, has in zip(words, lows, hashes, known):
            if word[0].isdigit() or low in self.numbers:
                self.cache[word] = NUMBER
            elif low in self.units:
                self.cache[word] = UNIT
            else:
                self.cache[word] = h if has else NAME if word[0].isupper() else 0

    def tokens(self, text: str) -> tuple[list[str], np.ndarray]:
        words, cache = TOKEN.findall(text), self.cache
        if len(cache) > self.MOST_CACHED:
            cache.clear()
        new = [w for w in set(words) if w not in cache]
        if new:
            self.learn(new)
        return words, np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))

    def windows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the windows that have no unknown word and not only placeholders."""
        n = len(ids) - self.size + 1
        if n < 1:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        unknown, plain = np.r_[0, np.cumsum(ids == 0)], np.r_[0, np.cumsum(ids > NAME)]
        at = np.flatnonzero((unknown[self.size :] == unknown[:n]) & (plain[self.size :] > plain[:n]))
        h = np.zeros(len(at), np.uint64)
        for k in range(self.size):
            part = ids[at + k]
            h = (h + (part ^ part >> np.uint64(29)) * self.factors[k]) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(31)
        return at, h

    def plain(self, words: list[str], ids: np.ndarray) -> list[tuple[int, int]]:
        """Positions and hashes of what has no template: a whole text shorter than a window, or windows of placeholders only, with their real values."""
        if len(words) < self.size:
            return [(0, self.real_hash(words))] if words else []
        other = np.r_[0, np.cumsum((ids == 0) | (ids > NAME))]
        at = np.flatnonzero(other[self.size :] == other[: len(words) - self.size + 1])
        return [(p, self.real_hash(words[p : p + self.size])) for p in at.tolist()]

    @staticmethod
    def real_hash(words: list[str]) -> int:
        return xxhash.xxh64_intdigest("\n".join(words).lower().encode("utf-8", "surrogatepass"))

    def slots(self, words: list[str], ids: np.ndarray, at: int) -> list[str]:
        return [words[k].lower() for k in range(at, at + self.size) if ids[k] <= NAME]


WINDOW_SCHEMA = "part bigint, h bigint, at array<int>, slots array<string>"


def _windows(rows: DataFrame, templates: Templates, wanted: Bitmap | None) -> DataFrame:
    """``doc_id``, the hash ``part`` of the text, and the windows of each row that ``wanted`` may have. Repeats within a row come once, with all their positions.

    Without ``wanted`` the rows are items: those that have a window are found by these alone, the others by their real words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, hs, places, slots = [], [], [], [], []
            for name, text in zip(batch.column(0), batch.column(1).to_pylist()):
                words, tokens = templates.tokens(text)
                at, h = templates.windows(tokens)
                plain = templates.plain(words, tokens) if wanted is not None or not len(at) else []
                if wanted is not None:
                    keep = wanted.has(h)
                    at, h = at[keep], h[keep]
                    if plain:
                        has = wanted.has(np.array([x for _, x in plain], dtype=np.uint64)).tolist()
                        plain = [x for x, y in zip(plain, has) if y]
                seen: dict[tuple, list[int]] = {}
                for p, x in plain:
                    seen.setdefault((x - (1 << 64) if x >> 63 else x,), []).append(p)
                for p, x in zip(at.tolist(), h.view(np.int64).tolist()):
                    seen.setdefault((x, *templates.slots(words, tokens, p)), []).append(p)
                part = _word_hash(text) if seen else 0
                for (x, *s), where in seen.items():
                    ids.append(name)
                    parts.append(part)
                    hs.append(x)
                    places.append(where)
                    slots.append(s)
            kind = batch.schema.field(0).type
            columns = [pa.array([i.as_py() for i in ids], kind), pa.array(parts, pa.uint64()).cast(pa.int64(), safe=False), pa.array(hs, pa.int64())]
            columns += [pa.array(places, pa.list_(pa.int32())), pa.array(slots, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "h", "at", "slots"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {WINDOW_SCHEMA}")


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 5,
    similarity: float = 0.8,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_windows`` (of the item), ``n_found`` and ``coverage``: pairs with a coverage of at least ``similarity``.

    Windows are taken together that stand in one text at the same distance from their place in the item, or at nearly the same
    one (words may be put in or left out: within half of the item's windows), or anywhere in the document. In each such group a
    window is found if its slots agree with the group's value that is most frequent for the item's value (ties: the smallest);
    the group with the most windows counts. An item of fewer words than a window matches a text that has the same words, upper or
    lower case, and no others; an item of placeholders only is found by its windows with their real values. Empty or NULL texts
    cannot match. Rows with the same id count as one document, and so do rows without an id, which appear with a NULL id. Empty tables: no rows.
    """
    items = documents_of(benchmark, item_col, item_text_col)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A capitalised word is a word of the vocabulary only if it also occurs in lower case.
            found = {w for t in batch.column(1).to_pylist() for w in TOKEN.findall(t) if not w[0].isupper()}
            yield pa.RecordBatch.from_arrays([pa.array([_word_hash(w.lower()) for w in found], pa.uint64()).cast(pa.int64(), safe=False)], names=["h"])

    vocabulary = _bitmap(items.mapInArrow(words, "h bigint"))
    templates = Templates(vocabulary, window)
    known = _windows(items, templates, None).select(F.col("doc_id").alias("item_id"), "h", F.explode("at").alias("pos"), F.col("slots").alias("item_slots"))
    known = staged(known, "benchmark-windows")
    total = known.groupBy(F.col("item_id").alias("_item")).agg(F.count_distinct("pos").alias("n_windows"))
    n_known = known.count()
    wanted = _bitmap(known.select("h"))
    found = _windows(documents_of(docs, id_col, text_col), templates, wanted)
    side = known.join(total, F.col("item_id").eqNullSafe(F.col("_item"))).drop("_item")
    side = F.broadcast(side) if n_known <= BROADCAST_WINDOWS else side
    pairs = staged(found.join(side, "h").select("doc_id", "item_id", "part", "at", "pos", "slots", "item_slots", "n_windows"), "benchmark-matches")
    # Most pairs have too few windows in common, whatever their slots, and are not grouped.
    coverage = lambda n: F.col(n) / F.col("n_windows")
    able = pairs.groupBy("doc_id", "item_id", "n_windows").agg(F.count_distinct("pos").alias("n")).where(coverage("n") >= similarity)
    pairs = pairs.join(able.select(F.col("doc_id").alias("_doc"), F.col("item_id").alias("_item")), _same("doc_id", "item_id"), "left_semi")
    group = lambda kind, part, k: F.struct(F.lit(kind).alias("kind"), part.cast("bigint").alias("part"), k.cast("bigint").alias("k"))
    part, step = F.col("part"), F.greatest(F.lit(1), F.floor(F.col("n_windows") / 4))
    exact = F.transform("at", lambda p: group(1, part, p - F.col("pos")))
    close = [F.transform("at", lambda p: group(2, part, F.floor((p - F.col("pos")) / step) - back)) for back in (0, 1)]
    groups = F.array_distinct(F.concat(F.array(group(0, F.lit(0), F.lit(0))), exact, *close))
    pairs = pairs.select("doc_id", "item_id", "n_windows", "pos", "slots", "item_slots", F.explode(groups).alias("group"))
    able = pairs.groupBy("doc_id", "item_id", "group", "n_windows").agg(F.count_distinct("pos").alias("n")).where(coverage("n") >= similarity)
    able = able.select(F.col("doc_id").alias("_doc"), F.col("item_id").alias("_item"), F.col("group").alias("_group"))
    pairs = staged(pairs.join(able, _same("doc_id", "item_id", "group"), "left_semi"), "benchmark-groups")
    slots = pairs.select("doc_id", "item_id", "group", "pos", F.explode(F.arrays_zip("item_slots", "slots")).alias("s"))
    slots = slots.select("doc_id", "item_id", "group", "pos", F.col("s.item_slots").alias("a"), F.col("s.slots").alias("b"))
    votes = slots.groupBy("doc_id", "item_id", "group", "a", "b").agg(F.count_distinct("pos").alias("n"))
    chosen = votes.groupBy("doc_id", "item_id", "group", "a").agg(F.min(F.struct(-F.col("n"), F.col("b"))).alias("best"))
    chosen = chosen.groupBy("doc_id", "item_id", "group").agg(F.map_from_entries(F.collect_list(F.struct("a", F.col("best.b")))).alias("values"))
    checked = pairs.join(chosen.withColumnsRenamed({"doc_id": "_doc", "item_id": "_item", "group": "_group"}), _same("doc_id", "item_id", "group"), "left")
    agree = F.forall(F.arrays_zip("item_slots", "slots"), lambda s: F.coalesce(F.col("values")[s["item_slots"]] == s["slots"], F.lit(False)))
    counts = checked.where((F.size("slots") == 0) | agree).groupBy("doc_id", "item_id", "group", "n_windows").agg(F.count_distinct("pos").alias("n_found"))
    counts = counts.groupBy("doc_id", "item_id", "n_windows").agg(F.max("n_found").alias("n_found")).withColumn("coverage", coverage("n_found"))
    return counts.where(F.col("coverage") >= similarity).select("doc_id", "item_id", "n_windows", "n_found", "coverage")


def _same(*names: str) -> Column:
    """A join's condition: each of the columns is the one that has the first part of its name behind an underscore, or both are NULL."""
    return reduce(and_, [F.col(n).eqNullSafe(F.col(f"_{n.removesuffix('_id')}")) for n in names])
