"""Personal data by gradient boosting on candidate spans.

Generators with high recall propose overlapping spans: the plain patterns of each kind, and wider ones (obfuscated addresses,
numbers with other separators). Boosted trees score each candidate by its format and context. They learn from the candidates
themselves: plain matches that pass their check are right, and so are they when rewritten in place as only the wider generators
find them. Those that fail the check, and wider candidates that a check refutes, are wrong. Other wider candidates have no label.
For each kind a threshold is calibrated on held-out candidates, and selects what is added to the plain spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import documents_of, staged
from clickloom.operators.ordered import bucketed, with_running_totals

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
# The plain patterns. All matches of the last three lie inside a run of NUMERIC.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IPS = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARDS = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONES = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMERIC = re.compile(r"[0-9 ().+\-]{7,}")
# The wider generators.
WIDE_EMAIL = re.compile(r"[^\s@<>(),;:\"\[\]]{1,64}(?:@|[ ]?[\[(]at[\])][ ]?)[^\s@<>(),;:\"\[\]]{2,255}")
WIDE_NUMBER = re.compile(r"\(?[0-9][0-9 ().\-]{5,}[0-9]")
CONTEXT = tuple(re.compile(p, re.I) for p in (r"mail|contact|write", r"\bip\b|host|server|address", r"card|visa|pay|account|credit", r"phone|tel|call|fax|mobile"))
#: What stands before, or inside, a number of another kind.
OTHER_NUMBER = re.compile(r"(?:\bv|version|isbn|issn|\bdate|\border|\binvoice|serial|\bpages?|\bpp|\bno|#)[ .:#]*$", re.I)
DATE = re.compile(r"(?<![0-9])(?:(?:1[5-9]|20)[0-9]{2}[-./ ](?:0?[1-9]|1[0-2])[-./ ](?:0?[1-9]|[12][0-9]|3[01])|(?:0?[1-9]|[12][0-9]|3[01])[-./](?:0?[1-9]|[12][0-9]|3[01])[-./](?:1[5-9]|20)[0-9]{2}|(?:1[5-9]|20)[0-9]{2}[- ]+(?:1[5-9]|20)[0-9]{2})(?![0-9])")
N_FEATURES = 27


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; found from each @ outwards, so long texts cost their length."""
    end, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        start = at
        while m and start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _octet(digits: str) -> bool:
    """At most 255, whatever the number of zeros before; a number of thousands of digits is never parsed."""
    least = digits.lstrip("0")
    return len(least) <= 3 and int(least or "0") <= 255


def plain_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """``kind``, ``start``, ``end`` and whether the check of the kind passes, of all plain matches."""
    out = [(EMAIL, s, e, True) for s, e in emails(text)]
    for run in NUMERIC.finditer(text):
        a, b = run.span()
        for m in IPS.finditer(text, a, b):
            out.append((IP, *m.span(), all(_octet(p) for p in m[0].split("."))))
        for m in CARDS.finditer(text, a, b):
            d = _digits(m[0])
            out.append((CARD, *m.span(), 14 <= len(d) <= 19 and luhn(d)))
        for m in PHONES.finditer(text, a, b):
            out.append((PHONE, *m.span(), 10 <= len(_digits(m[0])) <= 15))
    return out


def wide_matches(text: str) -> Iterator[tuple[int, int, int]]:
    if "@" in text or "at)" in text or "at]" in text:
        for m in WIDE_EMAIL.finditer(text):
            yield EMAIL, *m.span()
    for run in NUMERIC.finditer(text):
        for m in WIDE_NUMBER.finditer(text, *run.span()):
            n = len(_digits(m[0]))
            if 4 <= n <= 12 and len(re.findall("[0-9]+", m[0])) == 4:
                yield IP, *m.span()
            if 13 <= n <= 19:
                yield CARD, *m.span()
            if 7 <= n <= 15:
                yield PHONE, *m.span()


def refuted(text: str, kind: int, start: int, end: int) -> bool:
    """Whether a wide candidate that meets no plain match cannot be one of its kind."""
    s, before = text[start:end], text[max(0, start - 20) : start]
    if kind == EMAIL:
        return not DOMAIN.search(s[re.search(r"@|at[\])]", s).end() :])
    if before[-1:].isalnum() or text[end : end + 1].isalnum() or OTHER_NUMBER.search(before) or DATE.search(s):
        return True
    d = _digits(s)
    if kind == IP:
        return not all(_octet(g) for g in re.findall("[0-9]+", s))
    return kind == CARD and not (14 <= len(d) <= 19 and luhn(d)) or kind == PHONE and not 10 <= len(d) <= 15


def rewritten(text: str, kind: int, start: int, end: int) -> tuple[str, int, int]:
    """The text with a plain match written in a way that only the wide generators find, and the place of it."""
    s = text[start:end]
    if kind == EMAIL:
        s = s.replace("@", (" [at] ", "(at)")[end % 2])
    elif kind == IP:
        s = s.replace(".", "-")
    else:
        d = _digits(s)
        if kind == CARD:
            s = ".".join(d[k : k + 4] for k in range(0, len(d), 4))
        else:
            d = d[-10:]
            s = (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}")[end % 3]
    return text[max(0, start - 40) : start] + s + text[end : end + 20], min(start, 40), min(start, 40) + len(s)


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of the span and what stands around it."""
    s, before, after = text[start : min(end, start + 300)], text[max(0, start - 40) : start], text[end : end + 20]
    d = _digits(s)
    groups = [len(g) for g in re.findall("[0-9]+", s)] or [0]
    letters = sum(c.isalpha() for c in s)
    octets = [int(g) for g in re.findall(r"[0-9]{1,9}", s)]
    out = [float(kind == k) for k in range(4)]
    out += [end - start, len(d), letters, len(s) - len(d) - letters, len(groups), max(groups), min(groups), groups[0], groups[-1]]
    out += [s.count(c) for c in ".- (+@"]
    out += [float(13 <= len(d) <= 19 and luhn(d)), float(len(octets) == 4 and max(octets) <= 255 and s.count(".") == 3), float(bool(DOMAIN.search(s)))]
    out += [float(bool(c.search(before))) for c in CONTEXT]
    out += [float(before[-1:].isalnum())]
    out += [float(after[:1].isalnum())]
    return [float(x) for x in out]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``kind``, ``start``, ``end`` (code points), ``base`` (a plain match that passes), ``near`` (overlaps
    such a match), ``right`` (the label: is, or nearly is, such a match of its kind; NULL if nothing tells), ``made`` (a plain match
    rewritten, to learn from and not to find) and ``features``. One narrow pass.
    """
    rows = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def of(text: str) -> Iterator[tuple]:
        plain = plain_matches(text)
        good = sorted((s, e, k) for k, s, e, ok in plain if ok)
        starts = np.array([g[0] for g in good] or [0])
        longest = max((e - s for s, e, _ in good), default=0)
        failed = {(k, s, e) for k, s, e, ok in plain if not ok}
        seen = set()
        for kind, start, end, base in [*plain, *((k, s, e, False) for k, s, e in wide_matches(text))]:
            if (kind, start, end) in seen:
                continue
            seen.add((kind, start, end))
            lo, hi = np.searchsorted(starts, start - longest), np.searchsorted(starts, end)
            met = [g for g in good[lo:hi] if g[0] < end and g[1] > start]
            right = any(k == kind and (min(e, end) - max(s, start)) >= 0.8 * (max(e, end) - min(s, start)) for s, e, k in met)
            label = base or right
            if not label and not met and (kind, start, end) not in failed and not refuted(text, kind, start, end):
                label = None
            yield kind, start, end, base, bool(met), label, False, features(text, kind, start, end)
        for start, end, kind in good:
            changed = rewritten(text, kind, start, end)
            yield kind, start, end, False, True, True, True, features(changed[0], kind, *changed[1:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for c in of(text):
                    at.append(i)
                    found.append(c)
            take = pa.array(at, pa.int64())
            columns = [batch.column(0).take(take), batch.column(1).take(take)]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.bool_(), pa.list_(pa.float64()))
            columns += [pa.array([c[k] for c in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "kind", "start", "end", "base", "near", "right", "made", "features"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, kind int, start int, end int, base boolean, near boolean, right boolean, made boolean, features array<double>")


def thresholds(held: DataFrame, precision: float) -> list[float]:
    """For each kind, the lowest score at which the candidates of that score or more in ``held`` (``kind, p, label``) are right in
    ``precision``; 2 (none) if there is no such score. They are counted by score, and running totals go slice by slice."""
    counts = staged(held.groupBy("kind", "p").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("hits")), "pii-scores")
    totals = with_running_totals(bucketed(counts, "p"), ["kind"], "p", ["n", "hits"], descending=True)
    lowest = totals.where(F.col("hits_upto") >= F.lit(precision) * F.col("n_upto")).groupBy("kind").agg(F.min("p").alias("p"))
    found = {r["kind"]: max(r["p"], 0.5) for r in lowest.collect()}  # one row a kind
    return [found.get(kind, 2.0) for kind in range(4)]


def score(found: DataFrame, precision: float = 0.98, seed: int = 5) -> tuple[DataFrame, list[float]]:
    """``found``, a stored table, with the boosted probability ``p``, and the calibrated thresholds. Of all candidates with a label three
    quarters, by a hash of their place, fit the trees, and one quarter calibrates. Without both labels nothing is scored (``p`` NULL) and nothing selected."""
    keyed = found.where("right is not null").withColumn("key", F.xxhash64("text_hash", "kind", "start", "end", "made"))
    labelled = keyed.select("key", "kind", F.col("right").cast("double").alias("label"), array_to_vector("features").alias("vector"))
    train = labelled.where("pmod(key, 4) <> 0")
    if train.select("label").distinct().count() < 2:
        return found.withColumn("p", F.lit(None).cast("double")), [2.0] * 4
    model = GBTClassifier(maxIter=15, maxDepth=4, stepSize=0.3, seed=seed, featuresCol="vector", labelCol="label").fit(train)

    def scored(df: DataFrame) -> DataFrame:
        return model.transform(df).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction", "vector")

    held = scored(labelled.where("pmod(key, 4) = 0"))
    return scored(found.withColumn("vector", array_to_vector("features"))), thresholds(held, precision)


RESULT = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, spans string"


def _select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by document and start. Base spans stay; of overlapping others the best stays."""

    def write(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

    def finish(base: set, others: list[tuple[int, int, int, float]]) -> tuple:
        chosen: list[tuple[int, int, int, float]] = []
        for x in others:
            if chosen and x[0] < chosen[-1][2]:
                if (x[3], x[2] - x[0]) > (chosen[-1][3], chosen[-1][2] - chosen[-1][0]):
                    chosen[-1] = x
            else:
                chosen.append(x)
        plain = sorted(base)
        counts = [sum(k == kind for _, k, _ in plain) for kind in range(4)]
        return (*counts, write(plain), write(sorted({*plain, *(x[:3] for x in chosen)})))

    now, base, others, keys, out = None, set(), [], [], []
    schema = None

    def batch_of() -> pa.RecordBatch:
        columns = [pa.array([k[j] for k in keys], schema.field(j).type) for j in range(2)]
        columns += [pa.array([o[j] for o in out], pa.int64() if j < 4 else pa.string()) for j in range(6)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_email", "n_ip", "n_card", "n_phone", "base_spans", "spans"])

    for batch in batches:
        schema = batch.schema
        for doc, h, kind, start, end, is_base, p in zip(*(c.to_pylist() for c in batch.columns)):
            if (doc, h) != now:
                if now:
                    keys.append(now)
                    out.append(finish(base, others))
                now, base, others = (doc, h), set(), []
            if is_base:
                base.add((start, kind, end))
            else:
                others.append((start, kind, end, p))
        if len(keys) > 5000:
            yield batch_of()
            keys, out = [], []
    if now:
        keys.append(now)
        out.append(finish(base, others))
    if keys:
        yield batch_of()


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", precision: float = 0.98) -> DataFrame:
    """A row for each row: ``doc_id``, the number of base spans of each kind, ``base_spans`` and ``spans`` as ``kind:start:end`` texts.

    NULL or empty texts have none. Rows are told apart by id and text, so repeated rows, rows with the same id and rows
    without an id get the spans of their own text. Empty table: no rows. Other columns are left out.
    """
    found = staged(candidates(docs, id_col, text_col), "pii-candidates")
    scored, limits = score(found, precision=precision)
    limit = F.element_at(F.array(*[F.lit(x) for x in limits]), F.col("kind") + 1)
    chosen = scored.where(F.col("base") | (~F.col("near") & ~F.col("made") & (F.col("p") >= limit)))
    chosen = chosen.select("doc_id", "text_hash", "kind", "start", "end", "base", F.coalesce("p", F.lit(0.0)).alias("p"))
    kind = found.schema["doc_id"].dataType.simpleString()
    spans = chosen.repartition("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "start", "end", "kind")
    spans = spans.mapInArrow(_select, f"doc_id {kind}, text_hash bigint, {RESULT}").withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    rows = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"))
    joined = rows.join(spans, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in KINDS]
    return joined.select("doc_id", *counts, *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_spans", "spans")])

