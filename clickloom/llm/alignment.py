"""Alignment of the tokens that two tokenizers make of the same bytes.

Where a token of each ends at the same byte, the text is cut into groups. Cuts are found by divide and conquer: a shared end near
the middle of an interval is located by bisection of the other side's ends, and both halves are cut further; an interval without
a shared end is a leaf, one group. All intervals of a level are searched together, for all texts of a batch.
Within a group the tokens whose bytes overlap are linked; how often two ids are linked in the whole corpus says how well they match.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import documents_of, staged

TOKENIZERS = "/opt/tokenizers"
#: Texts of about so many bytes are aligned at a time; a longer text alone. It bounds a task's memory and changes nothing else.
BATCH_BYTES = 1 << 20
#: At most so many id pairs, the most frequent ones, are broadcast (three numbers each); the others are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000
#: Fixed value: how byte-level vocabularies of this kind cut a text into words before they encode each.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of these characters alone, whose classes are the same in every Unicode version, and without very long words or gaps.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7E\xA1-\u024F]*")
LONG = re.compile(r"\S{1000}|\s{1000}")


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write visible Latin-1 characters as they are, and the other bytes, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def open_coder(path: str) -> tuple[Callable[[list[str]], list[list[int]]], list[bytes]]:
    """An encoder of texts, each with a space before it, to ids; and the bytes of each id. ``.model``: pieces; else byte-level."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=path)
        table = [
            bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
            for i in range(pieces.get_piece_size())
        ]
        return (lambda texts: pieces.encode(texts, num_threads=1)), table
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.encode_special_tokens = True
    byte_of = _byte_of_character()
    table = [b""] * model.get_vocab_size()
    for entry, i in model.get_vocab().items():
        table[i] = bytes(byte_of[c] for c in entry)
    fast = _by_rank(path, table)

    def encode(texts: list[str]) -> list[list[int]]:
        spaced = [" " + t for t in texts]
        plain = [fast is not None and bool(PLAIN.fullmatch(t)) and not LONG.search(t) for t in spaced]
        whole = iter(model.encode_batch_fast([t for t, p in zip(spaced, plain) if not p], add_special_tokens=False))
        return [fast.encode_ordinary(t) if p else next(whole).ids for t, p in zip(spaced, plain)]

    return encode, table


def _by_rank(path: str, table: list[bytes]):
    """The same vocabulary for a faster encoder, which merges the pair with the smallest id first. That is the order of the file's
    merges if the k-th one makes the id 256 + k; if it does not, or words are cut otherwise, there is no such encoder."""
    with open(path, encoding="utf-8") as f:
        stored = json.load(f)
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in stored["model"].get("merges", [])]
    vocab, cut = stored["model"]["vocab"], stored.get("pre_tokenizer") or {}
    in_order = all(vocab.get(x + y) == 256 + k for k, (x, y) in enumerate(merges))
    if stored["model"]["type"] != "BPE" or stored.get("normalizer") or not in_order or (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) != ("ByteLevel", False, True):
        return None
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks={table[i]: i for i in range(256 + len(merges))}, special_tokens={})


def _ranges(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, a_lo: np.ndarray, a_hi: np.ndarray) -> np.ndarray:
    """Tokens of A, rising, that end inside one of the intervals ``a_lo`` to ``a_hi`` (exclusive) where a token of B ends too.

    An interval's last end is no cut of it. Ends rise over all intervals. From each middle the search goes outwards in steps
    that double, so that a long leaf costs a few steps; the shared end nearest to the middle splits the interval.
    """
    found = []
    while True:
        open_ = a_hi - a_lo > 1
        a_lo, a_hi = a_lo[open_], a_hi[open_]
        if not len(a_lo):
            break
        middle, last = (a_lo + a_hi - 2) // 2, a_hi - 2
        cut = np.full(len(a_lo), -1)
        waiting, near, far = np.arange(len(a_lo)), 0, 1
        while len(waiting):
            lo, mid, hi = a_lo[waiting], middle[waiting], last[waiting]
            # Candidates at distances near..far-1 on either side, those on the left first.
            left, right = np.maximum(mid - far + 1, lo), np.minimum(mid + far, hi + 1)
            n_left = np.maximum(mid - near + 1 - left, 0)
            n_right = np.maximum(right - (mid + max(near, 1)), 0)
            k = np.concatenate([np.repeat(left, n_left) + _ranges(n_left), np.repeat(mid + max(near, 1), n_right) + _ranges(n_right)])
            of = np.concatenate([np.repeat(np.arange(len(waiting)), n_left), np.repeat(np.arange(len(waiting)), n_right)])
            b = np.searchsorted(ends_b, ends_a[k])
            hit = ends_b[b] == ends_a[k]
            k, of = k[hit], of[hit]
            order = np.argsort(-np.abs(k - mid[of]), kind="stable")
            cut[waiting[of[order]]] = k[order]  # the nearest is written last
            near, far = far, 4 * far
            waiting = waiting[(cut[waiting] < 0) & ((mid - near >= lo) | (mid + near <= hi))]
        split = cut >= 0
        cut = cut[split]
        found.append(cut)
        a_lo, a_hi = np.concatenate([a_lo[split], cut + 1]), np.concatenate([cut + 1, a_hi[split]])
    return np.sort(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


@lru_cache(maxsize=4)
def _lengths(path: str) -> np.ndarray:
    return np.array([len(x) for x in open_coder(path)[1]])


@lru_cache(maxsize=4)
def _written(n_a: int, n_b: int) -> np.ndarray:
    """Ids as they are written: of A inside and at the end of a group's part, then of B."""
    return np.array([f"{i}{s}" for n, s in ((n_a, ","), (n_a, "|"), (n_b, ","), (n_b, ";")) for i in range(n)], dtype=object)


def align_texts(texts: list[str | None], path_a: str, path_b: str) -> dict[str, list]:
    """For each text the number of tokens, groups and links, ``groups`` as ``a1,a2|b1;a3|b2``, and its different links: the code
    ``a * size of B + b`` and how often it occurs. A text that either tokenizer does not give back byte by byte has no tokens."""
    (encode_a, bytes_a), (encode_b, bytes_b) = open_coder(path_a), open_coder(path_b)
    size_a, size_b = len(bytes_a), len(bytes_b)
    some = [i for i, t in enumerate(texts) if t]
    ids_a, ids_b = encode_a([texts[i] for i in some]), encode_b([texts[i] for i in some])
    good = []
    for k, i in enumerate(some):
        whole = b" " + texts[i].encode()
        if b"".join(map(bytes_a.__getitem__, ids_a[k])) == whole and b"".join(map(bytes_b.__getitem__, ids_b[k])) == whole:
            good.append(k)
    out = {c: [0] * len(texts) for c in ("n_a", "n_b", "n_groups", "n_links")} | {"groups": [""] * len(texts), "pairs": [[]] * len(texts), "times": [[]] * len(texts)}
    if not good:
        return out
    n_a, n_b = (np.array([len(ids[k]) for k in good]) for ids in (ids_a, ids_b))
    a, b = (np.concatenate([np.array(ids[k], dtype=np.int64) for k in good]) for ids in (ids_a, ids_b))
    ends_a, ends_b = np.cumsum(_lengths(path_a)[a]), np.cumsum(_lengths(path_b)[b])
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    inner = shared_cuts(ends_a, ends_b, last_a - n_a, last_a)
    cut_a, cut_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    cut_a[inner], cut_a[last_a - 1] = True, True
    cut_b[np.searchsorted(ends_b, ends_a[cut_a])] = True
    group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
    first_b = np.r_[0, np.flatnonzero(cut_b)[:-1] + 1]  # of each group
    upto_a = np.flatnonzero(cut_a) + 1
    # Links: each A token with the B token at its end, each B token that ends inside an A token with that one.
    rest = np.flatnonzero(~cut_b)
    left = np.concatenate([np.arange(len(a)), np.searchsorted(ends_a, ends_b[rest])])
    right = np.concatenate([np.searchsorted(ends_b, ends_a), rest])
    of = np.searchsorted(last_a, left, side="right")
    codes, times = np.unique(of * (size_a * size_b) + a[left] * size_b + b[right], return_counts=True)
    code_of = codes // (size_a * size_b)
    parts = np.searchsorted(code_of, np.arange(len(good) + 1))
    codes = codes - code_of * (size_a * size_b)
    written = np.empty(len(a) + len(b), dtype=object)
    table = _written(size_a, size_b)
    written[np.arange(len(a)) + first_b[group_a]] = table[a + size_a * cut_a]
    written[np.arange(len(b)) + upto_a[group_b]] = table[2 * size_a + b + size_b * cut_b]
    stop = last_a + last_b
    groups = np.bincount(np.searchsorted(last_a, np.flatnonzero(cut_a), side="right"), minlength=len(good))
    links = np.bincount(of, minlength=len(good))
    for k, i in enumerate(some[g] for g in good):
        out["n_a"][i], out["n_b"][i], out["n_groups"][i], out["n_links"][i] = int(n_a[k]), int(n_b[k]), int(groups[k]), int(links[k])
        out["groups"][i] = "".join(written[stop[k] - n_a[k] - n_b[k] : stop[k]].tolist())[:-1]
        out["pairs"][i], out["times"][i] = codes[parts[k] : parts[k + 1]], times[parts[k] : parts[k + 1]]
    return out


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """A stored row for each row: ``row`` (a number of its own), ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups``,
    and its different links as ``pairs`` and ``times``; see ``align_texts``. With ``digest`` the SHA-256 of ``groups`` is kept in its place.

    NULL and empty texts have no tokens: zeros, and an empty ``groups``, which is not hashed. Repeated rows and rows without an
    id are aligned each. Other columns are left out. Both files must be found under their paths on every executor. A text is
    encoded whole, so the longest one bounds a task's memory from below.
    """
    rows = documents_of(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy()) // BATCH_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                made = align_texts(batch.column(1).slice(lo, hi - lo).to_pylist(), path_a, path_b)
                groups = made["groups"]
                if digest:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                offsets = pa.array(np.cumsum([0, *map(len, made["pairs"])]), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *made[c]]).astype(np.int64))) for c in ("pairs", "times")]
                counts = [pa.array(made[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *counts, pa.array(groups, pa.string()), *lists],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
    made = rows.mapInArrow(run, f"doc_id {kind}, {numbers}, groups string, pairs array<bigint>, times array<bigint>")
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "aligned")


def _links(aligned: DataFrame) -> DataFrame:
    return aligned.select("row", F.inline(F.arrays_zip("pairs", "times")))


def link_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """Stored, for each linked pair: ``pair``, ``a``, ``b``, ``count`` of its links in all texts, ``n_rows`` that have it, and ``best``,
    whether no pair with the same ``b`` has more (ties are all best)."""
    counts = _links(aligned).groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("count"), F.count(F.lit(1)).alias("n_rows"))
    counts = staged(counts.withColumn("b", F.col("pair") % size_b).withColumn("a", F.floor(F.col("pair") / size_b)), "link-totals")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # at most one row for each id of B
    return staged(counts.join(F.broadcast(most), "b").select("pair", "a", "b", "count", "n_rows", (F.col("count") == F.col("most")).alias("best")), "link-counts")


def weigh(aligned: DataFrame, counts: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``row``, ``n_best`` (links that are best for their B id) and ``count_sum`` (their counts summed), for rows with links.

    The most frequent pairs, at most ``broadcast_pairs``, are looked up where the rows are; the rest, each in few rows, by a join.
    """
    # Classes of pairs by the number of rows, each twice the one before: a row for each of at most 64.
    sizes = counts.groupBy(F.floor(F.log2("n_rows")).alias("c")).count().orderBy(F.desc("c")).collect()
    held, least = 0, None
    for r in sizes:
        if held + r["count"] > broadcast_pairs:
            break
        held, least = held + r["count"], r["c"]
    links = _links(aligned).withColumnRenamed("pairs", "pair")
    facts = counts.select("pair", "count", "best", F.floor(F.log2("n_rows")).alias("c"))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum")]
    common = facts.where(F.col("c") >= least).drop("c") if least is not None else facts.limit(0).drop("c")
    if held == counts.count():
        return links.join(F.broadcast(common), "pair").groupBy("row").agg(*sums)
    known = links.join(F.broadcast(common), "pair", "left")
    rare = facts.where(F.col("c") < least).drop("c") if least is not None else facts.drop("c")
    late = known.where("best is null").select("row", "pair", "times").join(rare, "pair")
    both = known.where("best is not null").groupBy("row").agg(*sums).unionByName(late.groupBy("row").agg(*sums))
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(docs: DataFrame, path_a: str = f"{TOKENIZERS}/byte_bpe_50k.json", path_b: str = f"{TOKENIZERS}/piece_bpe_32k.model", **options) -> DataFrame:
    """``align`` with the corpus counts: a row for each row, with ``n_best`` and ``count_sum``; zeros where there are no tokens."""
    aligned = align(docs, path_a, path_b, **options)
    weighed = weigh(aligned, link_counts(aligned, len(open_coder(path_b)[1])))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return aligned.join(weighed, "row", "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups")
