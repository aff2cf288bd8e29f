"""Removal of repeated 100-byte strings by a common-prefix-aware distributed merge sort of suffixes.

Not every suffix has to be sorted. In each window of 100 bytes one position, the anchor, is chosen by the window's own bytes:
the leftmost of its 16-byte strings with the least hash. Equal windows have the same anchor, so it is enough to sort the
suffixes that begin at anchors, each cut where its last window ends and with the bytes before it that its windows have
(about one suffix for 40 bytes of text). A window that occurs twice is found at both anchors, with nothing left out.

* Documents are dealt to buckets by a hash of id and text, once; that exchange is read again by each later step.
* The anchors' hashes of each bucket are counted over the corpus. An anchor that occurs once has no repeated window, so its
  suffix goes no further. One that occurs very often is hot.
* The suffixes left of a bucket are a run: sorted, with suffixes that are wholly the same within the run settled
  (all but the earliest are repeats), and the others cut by the hash of their first 16 bytes into parts.
* Each part of a run is sent front-coded: of a suffix only what differs from the one before it.
* A task merges the runs of a part with a loser tree that knows the common prefix of each suffix with the last one given out:
  the one with the longer prefix is the smaller, and only where they are the same are bytes compared, from there on.
* In the merged order, suffixes with a common prefix of length t stand together, so windows that begin o bytes before their
  anchor are equal if they are in one such group for t = 100 - o and have the same o bytes before.

Suffixes of one 16-byte string meet in one task, once for each run and each different surrounding, up to ``HOT_SUFFIXES``
occurrences. Beyond that their windows are settled one by one: each run sends the earliest place of each window under the
window's 128-bit hash, and windows are dealt to all parts, so one that is in every run has one entry a run.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import HOT_ROWS, MOST_HOT

WINDOW = 100
GRAM = 16
LEFT = WINDOW - GRAM
#: Bytes of text in a bucket, on average; a bucket of more than twice as much is sent as several runs.
RUN_BYTES = 12_000_000
#: An anchor string that occurs more often is hot: its windows go by their hashes. It changes the plan only.
HOT_SUFFIXES = 100_000
#: Longer documents are taken in pieces of this many window starts, and anchors are found in about as much text at a time.
PIECE = 2_000_000
#: Bytes of text for each part.
PART_BYTES = 8_000_000
#: At most so many tasks merge the parts; with more parts than that a task merges several, one after the other. It changes the plan only.
MOST_TASKS = 50_000
#: Merged suffixes that are settled together.
BLOCK = 40_000
NO_ID = -(1 << 63)


def anchors(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each window start in ``buffer`` its anchor, and for each position the hash of its 16 bytes."""
    n = len(buffer) - GRAM + 1
    raw = np.frombuffer(buffer, np.uint8)
    words = np.lib.stride_tricks.as_strided(raw, (len(buffer) - 7, 8), (1, 1)).copy().view("<u8").ravel()
    h = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h = (h ^ words[8 : 8 + n]) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x94D049BB133111EB)
    least = (h & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)
    span, size = WINDOW - GRAM + 1, 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    return (least & np.uint64((1 << 24) - 1)).astype(np.int64), h


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known and not looked at again."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differ.bit_length() + 7) // 8


#: From the anchor on, before the anchor, number of the document in the run, anchor's position, whether its anchor string is hot.
Suffix = tuple[bytes, bytes, int, int, bool]


class Run:
    """One sorted run of one part: written front-coded, read one suffix at a time."""

    @staticmethod
    def write(suffixes: list[Suffix], ids: np.ndarray, hashes: np.ndarray) -> bytes:
        docs, at = np.unique([s[2] for s in suffixes], return_inverse=True)
        shared, before = [], b""
        for s in suffixes:
            shared.append(common_prefix(before, s[0], 0))
            before = s[0]
        n = len(suffixes)
        parts = [
            np.array([n, len(docs)], "<u4"), ids[docs].astype("<i8"), hashes[docs].astype("<i8"), at.astype("<u4"), np.array([s[3] for s in suffixes], "<u4"),
            np.array(shared, np.uint8), np.array([len(s[0]) for s in suffixes], np.uint8), np.array([len(s[1]) for s in suffixes], np.uint8),
        ]
        body = b"".join(p.tobytes() for p in parts) + b"".join(s[0][k:] for s, k in zip(suffixes, shared)) + b"".join(s[1] for s in suffixes)
        return zstandard.ZstdCompressor(level=3).compress(body)

    def __init__(self, payload: bytes) -> None:
        self.body = zstandard.ZstdDecompressor().decompress(payload)
        at = 8
        n, docs = np.frombuffer(self.body, "<u4", 2).tolist()

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(self.body, kind, count, at)
            at += out.nbytes
            return out

        self.ids, self.hashes = take("<i8", docs), take("<i8", docs)
        self.doc, self.pos = take("<u4", n), take("<u4", n)
        self.shared, self.length, self.left = take("u1", n), take("u1", n), take("u1", n)
        self.rest_at, self.left_at = at, at + int(self.length.astype(np.int64).sum() - self.shared.astype(np.int64).sum())

    def __iter__(self) -> Iterator[tuple[int, bytes, bytes, int, int, int]]:
        """Common prefix with the suffix before, suffix, bytes before it, id, text hash, position."""
        body, r, q, now = self.body, self.rest_at, self.left_at, b""
        ids, hashes = self.ids[self.doc].tolist(), self.hashes[self.doc].tolist()
        for k, n, m, i, h, p in zip(self.shared.tolist(), self.length.tolist(), self.left.tolist(), ids, hashes, self.pos.tolist()):
            now = now[:k] + body[r : r + n - k]
            r += n - k
            yield k, now, body[q : q + m], i, h, p
            q += m


def merge(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """All entries of the runs in order; the first member becomes the common prefix with the entry given out before.

    A loser tree whose players carry that prefix length. Where two lengths differ, the longer is the smaller suffix, and the
    loser's length stays right for the next winner; where they are the same, bytes are compared from that length on.
    """
    k = len(runs)
    size = 1
    while size < k:
        size *= 2
    heads: list[tuple | None] = [next(r, None) for r in runs] + [None] * (size - k)
    lcp = [0 if h else -1 for h in heads]  # against the empty string, or out of the game
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        if lcp[a] != lcp[b]:
            return (a, b) if lcp[a] > lcp[b] else (b, a)
        if lcp[a] < 0:
            return a, b
        x, y = heads[a][1], heads[b][1]
        n = common_prefix(x, y, lcp[a])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            lcp[b] = n
            return a, b
        lcp[a] = n
        return b, a

    def start(node: int) -> int:
        if node >= size:
            return node - size
        winner, loser[node] = play(start(2 * node), start(2 * node + 1))
        return winner

    winner = start(1) if size > 1 else 0
    while heads[winner] is not None:
        head = heads[winner]
        yield (lcp[winner], *head[1:])
        heads[winner] = following = next(runs[winner], None)
        lcp[winner] = following[0] if following else -1
        node = (winner + size) >> 1
        while node:
            other = loser[node]
            a, b = lcp[winner], lcp[other]
            if a < b:
                winner, loser[node] = other, winner
            elif a == b:
                winner, loser[node] = play(winner, other)
            node >>= 1


def settle(block: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Repeats among merged suffixes: number in the block, and start and end of their windows in the document."""
    n = len(block)
    prefix = np.array([b[0] for b in block])
    right = np.array([len(b[1]) for b in block])
    left = np.array([len(b[2]) for b in block])
    at = np.array([b[5] for b in block], dtype=np.int64)
    ids, hashes = np.array([b[3] for b in block]), np.array([b[4] for b in block])
    order = np.lexsort((at, hashes, ids))
    bytes_before = np.frombuffer(b"".join(b[2].rjust(LEFT, b"\0") for b in block), np.uint8).reshape(n, LEFT)
    hashed = np.zeros(n, np.uint64)
    repeat = np.zeros((n, LEFT + 2), bool)
    for o in range(LEFT + 1):
        if o:
            hashed = (hashed ^ (bytes_before[:, LEFT - o].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
            hashed ^= hashed >> np.uint64(31)
        group = np.cumsum(prefix < WINDOW - o)
        rows = order[((left >= o) & (right >= WINDOW - o))[order]]
        if len(rows) < 2:
            continue
        key = hashed[rows] ^ group[rows].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        by_key = np.argsort(key, kind="stable")  # the earliest of a key comes first
        rows, key = rows[by_key], key[by_key]
        first = np.r_[True, key[1:] != key[:-1]]
        source = rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))]
        again = np.flatnonzero(~first)
        a, b = rows[again], source[again]
        same = (group[a] == group[b]) & (bytes_before[a, LEFT - o :] == bytes_before[b, LEFT - o :]).all(axis=1)
        other = (ids[a] != ids[b]) | (hashes[a] != hashes[b]) | (at[a] != at[b])  # a repeated row in two runs meets itself
        repeat[a[same & other], o] = True
        if not same.all():  # a hash that meets by chance: those few keys are compared by their bytes
            seen: dict[tuple[int, bytes], tuple] = {}
            for r in rows[np.isin(key, key[again[~same]])].tolist():
                place = (ids[r], hashes[r], at[r])
                source_of = seen.setdefault((int(group[r]), bytes_before[r, LEFT - o :].tobytes()), place)
                repeat[r, o] = source_of != place
    edge = np.diff(repeat.astype(np.int8), axis=1, prepend=0)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    return row, at[row] - (end - 1), at[row] - begin + WINDOW


SENT = "part int, payload binary"
COUNTED = "part int, bucket int, payload binary"
REPEATED = "bucket int, hot boolean, payload binary"
MARKS = "id bigint, text_hash bigint, begin int, stop int"
PLACE = np.dtype([("window", "<u8", 2), ("id", "<i8"), ("text_hash", "<i8"), ("at", "<i8")])


def _marks(ids: list, hashes: list, begins: list, stops: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(begins, pa.int32()), pa.array(stops, pa.int32())], names=["id", "text_hash", "begin", "stop"])


def _anchored(pieces: list[tuple[int, int, int, bytes]]) -> list[np.ndarray]:
    """Of each run of windows with the same anchor: number of the piece, first and last window start and anchor in it, hash of the anchor's 16 bytes."""
    buffer = b"".join(p[3] for p in pieces)
    if len(buffer) < WINDOW:
        return [np.empty(0, np.int64)] * 4 + [np.empty(0, np.uint64)]
    ends = np.cumsum([len(p[3]) for p in pieces])
    begins = np.r_[0, ends[:-1]]
    anchor, h = anchors(buffer)
    piece = np.repeat(np.arange(len(pieces)), ends - begins)[: len(anchor)]
    inside = np.flatnonzero(np.arange(len(anchor)) + WINDOW <= ends[piece])
    a, d = anchor[inside], piece[inside]
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])][: len(a)])
    low, high = inside[new], inside[np.r_[new[1:], len(inside)][: len(new)] - 1]
    a, d = a[new], d[new]
    return [d, low - begins[d], high - begins[d], a - begins[d], h[a]]


def _stretches(pieces: Iterable[tuple[int, int, int, bytes]]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """The pieces in lists of about ``PIECE`` bytes."""
    waiting, size = [], 0
    for p in pieces:
        waiting.append(p)
        size += len(p[3])
        if size >= PIECE:
            yield waiting
            waiting, size = [], 0
    if waiting:
        yield waiting


def _pieces(i: int, text_hash: int, text: bytes) -> Iterator[tuple[int, int, int, bytes]]:
    """Id, text hash, offset in the document and bytes; each window start is in one piece."""
    for offset in range(0, max(0, len(text) - WINDOW + 1), PIECE):
        yield i, text_hash, offset, text[offset : offset + PIECE + WINDOW - 1]


def _by_part(values: np.ndarray, n_parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Parts that have values, and the numbers of theirs."""
    part = (values % np.uint64(n_parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(part[order]) > 0][: len(order)])
    for rows in np.split(order, starts[1:]) if len(order) else ():
        yield int(part[rows[0]]), rows


def _merged(of: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks sorted by document and begin, those that touch as one: document, begin and stop."""
    if not len(of):
        return of, begin, stop
    _, number = np.unique(of, return_inverse=True)
    far = number.astype(np.int64) << 40  # documents apart, so that one running maximum serves all
    reach = np.maximum.accumulate(far + stop)
    starts = np.flatnonzero(np.r_[True, far[1:] + begin[1:] > reach[:-1]])
    return of[starts], begin[starts], np.r_[reach[starts[1:] - 1], reach[-1]] - far[starts]


def _windows(suffixes: list[Suffix], ids: np.ndarray, hashes: np.ndarray, again: list[tuple[int, int, int]]) -> np.ndarray:
    """Earliest place in the run of each window of hot suffixes, as ``PLACE``; the windows' other places are added to ``again``."""
    places = sorted((i, q - len(left) + o, xxhash.xxh3_128_digest(whole[o : o + WINDOW])) for right, left, i, q, _ in suffixes for whole in (left + right,) for o in range(len(whole) - WINDOW + 1))
    earliest: dict[bytes, tuple[int, int]] = {}
    for i, at, digest in places:
        if earliest.setdefault(digest, (i, at)) != (i, at):
            again.append((i, at, at + WINDOW))
    out = np.empty(len(earliest), PLACE)
    out["window"] = np.frombuffer(b"".join(earliest), "<u8").reshape(-1, 2)
    of = np.array([i for i, _ in earliest.values()], dtype=np.int64)
    out["id"], out["text_hash"], out["at"] = ids[of], hashes[of], [at for _, at in earliest.values()]
    return out


def settle_windows(places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Marks of all places of a window but the earliest. A place that is there twice is one."""
    window = places["window"]
    p = places[np.lexsort((places["at"], places["text_hash"], places["id"], window[:, 1], window[:, 0]))]
    first = np.r_[True, (p["window"][1:] != p["window"][:-1]).any(axis=1)][: len(p)]
    source = p[np.maximum.accumulate(np.where(first, np.arange(len(p)), 0))]
    p = p[(p["id"] != source["id"]) | (p["text_hash"] != source["text_hash"]) | (p["at"] != source["at"])]
    p = p[np.lexsort((p["at"], p["text_hash"], p["id"]))]
    document = np.cumsum(np.r_[True, (p["id"][1:] != p["id"][:-1]) | (p["text_hash"][1:] != p["text_hash"][:-1])][: len(p)])
    of, begin, stop = _merged(document, p["at"], p["at"] + WINDOW)
    some = p[np.searchsorted(document, of)]
    return some["id"], some["text_hash"], begin, stop


def make_runs(pieces: list[tuple[int, int, int, bytes]], n_parts: int, often: np.ndarray, hot: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Pieces as front-coded parts of those suffixes whose anchor's hash is in ``often`` (sorted); parts from ``n_parts`` on have
    windows of those whose hash is also in ``hot`` (sorted). Part -1 has repeats within the run.

    Anchors are found in a bounded stretch of text at a time, and suffixes are cut out for one part at a time.
    """
    ordered = sorted(pieces)
    pieces = [p for p, before in zip(ordered, [None, *ordered]) if before is None or p[:3] != before[:3]]  # a repeated row is one document
    ids, hashes = (np.array([p[k] for p in pieces], dtype=np.int64) for k in range(2))
    found, first = [], 0
    for stretch in _stretches(pieces):
        d, *rest = _anchored(stretch)
        wanted = _among(rest[-1], often)
        found.append([(d + first)[wanted], *(x[wanted] for x in rest)])
        first += len(stretch)
    d, low, high, at, h = (np.concatenate(x) for x in zip(*found))
    is_hot = _among(h, hot)
    again: list[tuple[int, int, int]] = []
    hot_kept: list[Suffix] = []
    for p, rows in _by_part(h, n_parts):
        suffixes = []
        for i, lo, hi, q, busy in zip(d[rows].tolist(), low[rows].tolist(), high[rows].tolist(), at[rows].tolist(), is_hot[rows].tolist()):
            text = pieces[i][3]
            suffixes.append((text[q : hi + WINDOW], text[lo:q], i, q + pieces[i][2], busy))
        suffixes.sort()  # of equal ones, the earliest comes first
        kept: list[Suffix] = []
        before: Suffix | None = None
        for s in suffixes:
            if before and s[0] == before[0] and s[1] == before[1]:
                again.append((s[2], s[3] - len(s[1]), s[3] + len(s[0])))
            else:
                (hot_kept if s[4] else kept).append(s)
                before = s
        if kept:
            yield p, Run.write(kept, ids, hashes)
    if hot_kept:
        places = _windows(hot_kept, ids, hashes, again)
        for p, rows in _by_part(places["window"][:, 0], n_parts):
            yield n_parts + p, zstandard.compress(places[rows].tobytes())
    if again:
        again.sort()
        of, begin, stop = _merged(*(np.array(x, dtype=np.int64) for x in zip(*again)))
        yield -1, np.stack([ids[of], hashes[of], begin, stop]).astype("<i8").tobytes()


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def dealt_by_part(sent: DataFrame, n_parts: int) -> DataFrame:
    """Each part has its own task, whatever the session's number of shuffle partitions; what is settled already goes anywhere."""
    task = F.when(F.col("part") >= 0, F.col("part").cast("bigint")).otherwise(F.xxhash64("payload"))
    n_tasks = min(n_parts, MOST_TASKS)
    return sent.repartitionById(n_tasks, F.pmod(task, F.lit(n_tasks)).cast("int")).sortWithinPartitions("part")


def occurring_often(texts: DataFrame, n_parts: int) -> DataFrame:
    """``REPEATED``: for each bucket, hashes of its anchors that occur more than once in the corpus, and those of hot ones."""

    def census(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[np.ndarray]] = {}
        waiting: dict[int, list] = {}
        size: dict[int, int] = {}

        def look(bucket: int) -> None:
            for stretch in _stretches(waiting.pop(bucket, [])):
                found.setdefault(bucket, []).append(_anchored(stretch)[4])
            size[bucket] = 0

        for batch in batches:
            for i, h, text, bucket in zip(*(batch[c].to_pylist() for c in ("id", "text_hash")), batch["text"], batch["bucket"].to_pylist()):
                for piece in _pieces(i, h, text.as_py()):
                    waiting.setdefault(bucket, []).append(piece)
                    size[bucket] = size.get(bucket, 0) + len(piece[3])
                    if size[bucket] >= PIECE:
                        look(bucket)
        for bucket in list(waiting):
            look(bucket)
        for bucket in list(found):
            value, times = np.unique(np.concatenate(found.pop(bucket)), return_counts=True)
            parts = [(p, zstandard.compress(value[rows].tobytes() + times[rows].astype("<u4").tobytes(), 1)) for p, rows in _by_part(value, n_parts)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in parts], pa.int32()), pa.array([bucket] * len(parts), pa.int32()), pa.array([x for _, x in parts], pa.binary())], names=["part", "bucket", "payload"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def part(messages: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            values, times, ends = [], [], []
            for _, payload in messages:
                body = zstandard.decompress(payload)
                n = len(body) // 12
                values.append(np.frombuffer(body, "<u8", n))
                times.append(np.frombuffer(body, "<u4", n, 8 * n))
                ends.append(n)
            value = np.concatenate(values)
            _, which = np.unique(value, return_inverse=True)
            total = np.bincount(which, np.concatenate(times))[which]
            buckets, hot, out = [], [], []
            at = 0
            for (bucket, _), n in zip(messages, ends):
                v, t = value[at : at + n], total[at : at + n]
                at += n
                for busy, some in ((False, v[t > 1]), (True, v[t > HOT_SUFFIXES])):
                    if len(some):
                        buckets.append(bucket)
                        hot.append(busy)
                        out.append(some.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(hot, pa.bool_()), pa.array(out, pa.binary())], names=["bucket", "hot", "payload"])

        now, messages = None, []
        for batch in batches:
            for p, bucket, payload in zip(batch["part"].to_pylist(), batch["bucket"].to_pylist(), batch["payload"]):
                if p != now and messages:
                    yield from part(messages)
                    messages = []
                now = p
                messages.append((bucket, payload.as_py()))
        if messages:
            yield from part(messages)

    return dealt_by_part(texts.mapInArrow(census, COUNTED), n_parts).mapInArrow(weigh, REPEATED)


def repeated(texts: DataFrame, n_parts: int, n_buckets: int) -> DataFrame:
    """``MARKS`` of bytes that are in a repeated window, from ``by_bucket``'s rows. They may overlap."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        flags = np.array(right["hot"].to_pylist(), bool)
        payloads = right["payload"].to_pylist()
        often, hot = (np.sort(np.frombuffer(b"".join(x for x, f in zip(payloads, flags) if f == wanted), "<u8")) for wanted in (False, True))
        parts: list[tuple[int, bytes]] = []
        waiting: list[tuple[int, int, int, bytes]] = []
        size = 0
        if len(often):
            for i, h, text in zip(left["id"].to_pylist(), left["text_hash"].to_pylist(), left["text"]):
                for piece in _pieces(i, h, text.as_py()):
                    if waiting and size + len(piece[3]) > 2 * RUN_BYTES:
                        parts += make_runs(waiting, n_parts, often, hot)
                        waiting, size = [], 0
                    waiting.append(piece)
                    size += len(piece[3])
            if waiting:
                parts += make_runs(waiting, n_parts, often, hot)
        return pa.table({"part": pa.array([p for p, _ in parts], pa.int32()), "payload": pa.array([x for _, x in parts], pa.binary())})

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(block: list[tuple]) -> pa.RecordBatch:
            row, begin, stop = settle(block)
            return _marks([block[r][3] for r in row.tolist()], [block[r][4] for r in row.tolist()], begin, stop)

        def part(number: int, payloads: list[bytes]) -> Iterator[pa.RecordBatch]:
            if number >= n_parts:
                yield _marks(*settle_windows(np.frombuffer(b"".join(map(zstandard.decompress, payloads)), PLACE)))
                return
            block: list[tuple] = []
            group: list[tuple] = []
            for entry in merge([iter(Run(p)) for p in payloads]):
                if entry[0] < GRAM:
                    if len(group) > 1:
                        block += group
                        if len(block) >= BLOCK:
                            yield settled(block)
                            block = []
                    group = []
                group.append(entry)
            if len(group) > 1:
                block += group
            if block:
                yield settled(block)

        now, payloads = None, []
        for batch in batches:
            for p, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                if p < 0:
                    rows = np.frombuffer(payload.as_py(), "<i8").reshape(4, -1)
                    yield _marks(*rows)
                    continue
                if p != now and payloads:
                    yield from part(now, payloads)
                    payloads = []
                now = p
                payloads.append(payload.as_py())
        if payloads:
            yield from part(now, payloads)

    often = occurring_often(texts, n_parts).repartition(min(n_buckets, MOST_TASKS), "bucket")
    sent = texts.groupBy("bucket").cogroup(often.groupBy("bucket")).applyInArrow(send, SENT)
    return dealt_by_part(sent, n_parts).mapInArrow(receive, MARKS)


def copied_rows(rows: DataFrame, n_rows: int) -> DataFrame:
    """``id``, ``text_hash`` and number of buckets (``salts``) of documents that are there as very many equal rows, at most ``MOST_HOT``."""
    limit = max(HOT_ROWS, math.ceil(n_rows / MOST_HOT))
    counts = rows.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") > limit).select("id", "text_hash", F.ceil(F.col("n") / limit).cast("int").alias("salts"))


def task_keys(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` partitions a whole number that Spark's hash puts there, so that every bucket has a task for itself.

    None beyond ``MOST_TASKS``, where each task has many buckets and their sizes even out.
    """
    if n > MOST_TASKS:
        return []
    numbers = spark.range(32 * n).select(F.col("id").cast("int").alias("key"))
    found = {r["task"]: r["key"] for r in numbers.groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("task")).agg(F.min("key").alias("key")).collect()}
    return [found.get(k, -1 - k) for k in range(n)]


def bucket_of(salt: str, n_buckets: int, keys: list[int]) -> Column:
    number = F.pmod(F.xxhash64("id", "text_hash", F.col(salt).cast("int")), F.lit(n_buckets)).cast("int")
    if keys:
        number = F.element_at(F.split(F.lit(",".join(map(str, keys))), ",").cast("array<int>"), number + 1)
    return number.alias("bucket")


def by_bucket(rows: DataFrame, copies: DataFrame, n_buckets: int, keys: list[int]) -> DataFrame:
    """Rows dealt by ``bucket``, which stands for a hash of id and text. Very many equal rows are dealt to several; each has the document then."""
    known = rows.withColumn("number", F.monotonically_increasing_id()).join(F.broadcast(copies), ["id", "text_hash"], "left")
    salted = known.withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod("number", "salts")).cast("int"))
    return salted.select("doc_id", "id", "text_hash", "text", bucket_of("salt", n_buckets, keys)).repartition(min(n_buckets, MOST_TASKS), "bucket")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary): texts are UTF-8 bytes.

    Every byte goes that is covered by a 100-byte string which also starts earlier, in a document with a smaller id or earlier
    in the same one; matches stay within documents and are judged on the input. Ids are whole numbers; rows without an id
    come first. Rows with the same id and text are one document, with one result; rows with the same id and different texts
    come in the order of their texts' hashes. NULL texts are empty. Empty table: no rows. Other columns are left out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    n_rows, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(shuffle, math.ceil((size or 0) / PART_BYTES))
    n_buckets = max(shuffle, math.ceil((size or 0) / RUN_BYTES))
    copies = copied_rows(rows, n_rows)
    keys = task_keys(docs.sparkSession, n_buckets)
    texts = by_bucket(rows, copies, n_buckets, keys)
    found = repeated(texts, n_parts, n_buckets).join(F.broadcast(copies), ["id", "text_hash"], "left")
    salts = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    marks = found.withColumn("salt", F.explode(salts)).select(bucket_of("salt", n_buckets, keys), "id", "text_hash", "begin", "stop").repartition(min(n_buckets, MOST_TASKS), "bucket")

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        i, h, begin, stop = (right[c].to_numpy() for c in ("id", "text_hash", "begin", "stop"))
        order = np.lexsort((begin, h, i))
        i, h, begin, stop = i[order], h[order], begin[order], stop[order]
        starts = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (h[1:] != h[:-1])][: len(i)])
        document = {(a, b): (s, e) for a, b, s, e in zip(i[starts].tolist(), h[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(i)])}
        size, removed, spans, kept = [], [], [], []
        for key, value in zip(zip(left["id"].to_pylist(), left["text_hash"].to_pylist()), left["text"]):
            whole = value.as_py()
            s, e = document.get(key, (0, 0))
            _, begins, stops = _merged(np.zeros(e - s), begin[s:e], stop[s:e])
            out, last = [], 0
            for b, t in zip(begins.tolist(), stops.tolist()):
                out.append(whole[last:b])
                last = t
            out.append(whole[last:])
            kept.append(b"".join(out))
            size.append(len(whole))
            removed.append(len(whole) - len(kept[-1]))
            spans.append(len(begins))
        return pa.table({"doc_id": left["doc_id"], **{c: pa.array(x, pa.int64()) for c, x in (("n_bytes", size), ("n_removed", removed), ("n_spans", spans))}, "kept": pa.array(kept, pa.binary())})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return texts.groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInArrow(cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
