"""SimHash near-duplicates by Golay-code fuzzy hashing.

A document's fingerprint takes each bit that is set in over half of its shingle hashes. To find all pairs of fingerprints
that differ in few bits without comparing all, the 64 bits are cut into segments of 23, 23 and 18 bits, and each segment is
read as a word of the perfect (23, 12) Golay code: it lies within 3 bits of exactly one code word, and within 4 bits of at
most 6. With at most 4 differing bits in all, the two segments with fewest differences have (0 or 1, 0 or 1) or (0, 2) of
them, so that one of these keys is the same on both sides:

* for a pair of segments, the nearest code word of one and a code word within 4 bits of the other: differing in one bit,
  a word is within 4 bits of the other word's nearest code word;
* a whole segment, and a code word within 4 bits of another one: words that differ in at most 2 bits share such a code word.

Equal fingerprints are one node from the start. Within a key's bucket, links are verified by their bits and only a spanning
forest of them is kept, so a bucket of g near copies gives fewer than g edges and not g * g / 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import documents_of, salted_lookup, staged
from clickloom.llm.components import components

# The generator polynomial of the Golay code, and the segments as (first bit, bits).
GOLAY = 0xC75
SEGMENTS = ((0, 23), (23, 23), (46, 18))
SEED = 42
#: Buckets up to this size compare all pairs of their fingerprints at once; larger ones grow a spanning forest.
SMALL_BUCKET = 6


def _remainder(words: np.ndarray) -> np.ndarray:
    """The syndrome: 23-bit words, as polynomials over two elements, modulo the generator."""
    words = words.astype(np.int64)
    for bit in range(22, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GOLAY << (bit - 11)), words)
    return words


def near_table(radius: int = 4) -> np.ndarray:
    """For each of the 2,048 syndromes, the error patterns of at most ``radius`` bits, fewest bits first; unused places are -1."""
    patterns = np.array([sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(23), r)], dtype=np.int64)
    syndromes = _remainder(patterns)
    table, used = np.full((2048, 6), -1, dtype=np.int64), [0] * 2048
    for p, s in zip(patterns.tolist(), syndromes.tolist()):
        table[s, used[s]] = p
        used[s] += 1
    return table


def golay_keys(fingerprints: np.ndarray, table: np.ndarray) -> np.ndarray:
    """One row of bucket keys for each fingerprint (unsigned 64-bit), -1 where it has fewer. A key is not negative."""
    near = []
    whole = []
    for first, bits in SEGMENTS:
        word = (fingerprints >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)
        errors = table[_remainder(word)]
        near.append(np.where(errors < 0, -1, (word[:, None] ^ errors) >> 11))
        whole.append(word)
    columns = []
    for kind, (a, b) in enumerate(((0, 1), (1, 2), (2, 0))):
        for i in range(6):
            for one, other in ((near[a][:, 0], near[b][:, i]), (near[a][:, i], near[b][:, 0])):
                columns.append(np.where((one < 0) | (other < 0), -1, kind << 40 | one << 12 | other))
            columns.append(np.where(near[b][:, i] < 0, -1, kind + 3 << 40 | whole[a] << 12 | near[b][:, i]))
    keys = np.stack(columns, axis=1)
    keys.sort(axis=1)
    keys[:, 1:][keys[:, 1:] == keys[:, :-1]] = -1
    return keys


def fingerprint(text: str, words: int = 4) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if it is in over half of the shingles' hashes. No word: 0."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = [e - 1 for e in accumulate(len(t) + 1 for t in tokens)]
    if len(tokens) <= words:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        starts = [0, *(e + 1 for e in ends[: len(tokens) - words])]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[s:e], SEED) for s, e in zip(starts, ends[words - 1 :])]
    values = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(values), 32768):
        counts += np.unpackbits(values[k : k + 32768].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(values), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, a row for each row. NULL or blank texts have 0."""
    docs = documents_of(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _forest(fps: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among distinct fingerprints. A dense group is reached in a few steps."""
    rest, edges = fps, []
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            close = _bits(rest ^ at) <= most
            found = rest[close]
            edges += [(int(at), int(x)) for x in found]
            todo += list(found)
            rest = rest[~close]
    return edges


def _bucket_links(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; the rows of a batch's last key wait for the next batch."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        bounds = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        sizes = np.diff(bounds)
        group = np.repeat(np.arange(len(sizes)), sizes)
        small = (sizes <= SMALL_BUCKET)[group]
        us, vs = [], []
        for step in range(1, SMALL_BUCKET):
            same = (group[step:] == group[:-step]) & small[step:]
            u, v = fps[step:][same], fps[:-step][same]
            linked = _bits(u ^ v) <= most
            us.append(u[linked])
            vs.append(v[linked])
        for g in np.flatnonzero(sizes > SMALL_BUCKET):
            edges = np.array(_forest(fps[bounds[g] : bounds[g + 1]], most), dtype=np.uint64).reshape(-1, 2)
            us.append(edges[:, 0])
            vs.append(edges[:, 1])
        u, v = np.concatenate(us).view(np.int64), np.concatenate(vs).view(np.int64)
        pairs = np.unique(np.stack([np.maximum(u, v), np.minimum(u, v)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        keys = np.concatenate([keys, batch.column(0).to_numpy()])
        fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut:
            yield links(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
    if len(keys):
        yield links(keys, fps)


def link_edges(distinct_fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """``u``, ``v``: edges whose components are those of all links of at most ``max_bits`` bits, from a column ``fp`` without repeats."""
    if not 0 <= max_bits <= 4:
        raise ValueError("the keys find all links only up to 4 bits")
    table = near_table()

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for k in range(0, len(fps), 20000):
                rows = golay_keys(fps[k : k + 20000].view(np.uint64), table)
                at, place = np.nonzero(rows >= 0)
                yield pa.RecordBatch.from_arrays([pa.array(rows[at, place]), pa.array(fps[k : k + 20000][at])], names=["key", "fp"])

    keyed = distinct_fps.select("fp").mapInArrow(keys, "key bigint, fp bigint").repartition("key").sortWithinPartitions("key", "fp")
    return keyed.mapInArrow(lambda batches: _bucket_links(batches, max_bits), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable by links, itself included.

    Every row keeps its row; repeated rows share a fingerprint and so a component. NULL or blank texts have fingerprint zero
    and link like any other. A NULL id has its fingerprint's component; a component of NULL ids alone is NULL. An empty
    table gives no rows. Other columns are left out.
    """
    prints = staged(fingerprints(docs, id_col, text_col, words), "simhash")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    roots = staged(components(link_edges(nodes, max_bits)).withColumnRenamed("node", "fp"), "simhash-roots")
    member = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    member = staged(member, "simhash-members")
    least = member.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("fps"))
    table = salted_lookup(member.select("fp", "n", "root"), staged(least, "simhash-components"), ["root"], "fps", ["fp"])
    out = salted_lookup(prints, staged(table.select("fp", "n", "component_id"), "simhash-table"), ["fp"], "n", ["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
