"""Secret scan: high-recall candidates, false positives removed by a random forest. DataFrame functions and Spark ML only.

Candidates are long runs of key-like characters and values after words such as ``password=``. The forest sees a candidate's
length, its transitions between digits, capitals and small letters, how much of it frequent corpus words cover, the path that
the document comes from and the words beside it. It is trained from labelled findings; ``labelled_by_evidence`` makes
such labels where no reviewed ones are at hand.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE, bounded_sample, documents_of, staged, words_of

KEY_WORDS = "password|passwd|pwd|secret|token|api_?key|access_?key|credential"
CHARS = "A-Za-z0-9_+/=.\\-"
#: A value after a key word, or a run of at least 16 key characters. Of the runs, those without a digit are dropped afterwards.
CANDIDATE = f"(?:(?i:{KEY_WORDS})[ ]?[=:][ ]?[\"']?[^{SPACE}\"']{{6,}}|(?<![{CHARS}])[{CHARS}]{{16,}})"
# Formats of well-known keys, for labels where no reviewed findings are given.
FORMATS = (
    r"^AKIA[A-Z0-9]{16}$",
    r"(?i)\btoken[ ]?[=:][ ]?[\"']?[0-9a-f]{32,}",
    r"(?i)\b(?:password|passwd|pwd)[ ]?[=:][ ]?[\"']?[0-9a-z]{12,}$",
    r"^gh[pousr]_[A-Za-z0-9]{36}$",
    r"^xox[abprs]-[A-Za-z0-9-]{10,}$",
    r"^sk_live_[A-Za-z0-9]{16,}$",
)
#: The key word and what stands between it and the value.
ASSIGNED = f"(?i:{KEY_WORDS})[A-Za-z0-9_]*[ ]?[=:][ ]?[\"']?"
# What a secret is not, by the value after any key word: numbers, dates, versions and addresses in digits; host names and mail
# domains; paths; words; stand-ins for a value.
REFUTED = (
    r"^[0-9][0-9.:/_+=\-]*$",
    r"^(?:[A-Za-z]+://)?[A-Za-z0-9_\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}(?:[/:].*)?[.]*$",
    r"^[.~]?/?(?:[A-Za-z0-9_.\-]*/){2,}[A-Za-z0-9_.\-]*$",
    r"^[A-Za-z]?[a-z]+(?:[_./=+\-]+[A-Za-z]?[a-z]+)*[0-9]{0,4}[.]*$",
    r"(?i)(?:example|placeholder|change.?me|your|redacted|dummy|sample|x{4,}|\*{4,}|<|\$\{)",
)
PASS_PHRASE = "(?i:password|passwd|pwd|secret)[ ]?[=:][ ]?[\"']?[A-Za-z]+(?:[-_.!#%&*+]+[A-Za-z]+){2,}"
#: Words before a run of hexadecimal digits that say that it is a checksum.
CHECKSUM_WORDS = r"(?i)(?:commit|revision|sha-?[0-9]*|md5|checksum|digest|hash)[^A-Za-z0-9]*$"
REDACTED = "[SECRET]"
WORD_BUCKETS = 24
PATH_BUCKETS = 8
DICTIONARY_WORDS = 2000
#: The forest is fitted on at most so many labelled findings, those with the smallest hash of their value and context.
FIT_ROWS = 20000


def _between(text: Column) -> Column:
    """The texts between candidates, one more than candidates."""
    return F.split(text, CANDIDATE, -1)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """``doc_id``, ``text_hash``, ``pos`` (number in the text), ``start``, ``end`` (code points), ``value``, ``before``, ``after``, ``path``.

    Rows with the same id and text count once. Texts without a candidate have no row.
    """
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), path.alias("path"))
    rows = rows.select("doc_id", "path", F.xxhash64("text").alias("text_hash"), _between(F.col("text")).alias("parts"), F.regexp_extract_all("text", F.lit(CANDIDATE), 0).alias("found"))
    parts = F.col("parts")
    cut = F.transform(
        "found",
        lambda v, i: F.struct(
            v.alias("value"),
            F.right(F.get(parts, i), F.lit(60)).alias("before"),
            F.left(F.get(parts, i + 1), F.lit(30)).alias("after"),
            F.length(F.get(parts, i)).alias("gap"),
        ),
    )
    rows = rows.where(F.size("found") > 0).select("doc_id", "path", "text_hash", F.posexplode(cut).alias("pos", "c"))
    rows = rows.select("doc_id", "path", "text_hash", "pos", "c.*").dropDuplicates(["doc_id", "text_hash", "pos"])
    to_here = Window.partitionBy("doc_id", "text_hash").orderBy("pos")
    end = F.sum(F.col("gap") + F.length("value")).over(to_here)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).drop("gap")
    return rows.where(F.col("value").rlike(f"[0-9]|{ASSIGNED}"))


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent lower-case words of at least four ASCII letters, from all documents; at most ``size``."""
    words = docs.select(F.explode(words_of(F.coalesce(F.col(text_col), F.lit("")))).alias("w")).where(F.col("w").rlike("^[a-z]{4,}$"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(size)
    return [r["w"] for r in top.collect()]


def features(found: DataFrame, known_words: list[str]) -> DataFrame:
    """Adds the double columns ``f_*`` and, of them, the vector ``features``."""
    v = F.col("value")
    n = F.length(v).cast("double")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    found = found.withColumn("_classes", classes)
    c = F.col("_classes")
    pieces = F.filter(F.split(F.lower(v), "[^a-z]+"), lambda p: F.length(p) >= 4)
    covered = F.aggregate(F.filter(pieces, lambda p: p.isin(known_words)) if known_words else F.array().cast("array<string>"), F.lit(0), lambda s, p: s + F.length(p))
    columns = {"length": n, "runs": F.length(F.regexp_replace(c, r"(.)\1+", "$1")) / n, "covered": covered / n}
    columns |= {"distinct": F.size(F.array_distinct(F.split(v, ""))) / n, "hex": F.length(F.regexp_replace(v, "[^0-9a-fA-F]", "")) / n}
    for name, kind in (("small", "a"), ("capital", "A"), ("digit", "0"), ("other", "-")):
        columns[f"share_{name}"] = (n - F.length(F.regexp_replace(c, f"{kind}+", ""))) / n
        for after, other in (("small", "a"), ("capital", "A"), ("digit", "0"), ("other", "-")):
            if after != name:
                columns[f"{name}_{after}"] = F.regexp_count(c, F.lit(f"{kind}(?={other})")) / n
    columns |= {"dots": F.regexp_count(v, F.lit("[.]")).cast("double"), "slashes": F.regexp_count(v, F.lit("/")).cast("double")}
    columns |= {"key_word": (F.concat_ws(" ", F.right(F.col("before"), F.lit(24)), v).rlike(f"(?i)(?:{KEY_WORDS})")).cast("double")}
    columns |= {"quoted": F.col("before").rlike("[\"']$").cast("double"), "assigned": F.concat("before", v).rlike("[=:]").cast("double")}
    for b in range(PATH_BUCKETS):
        columns[f"path_{b}"] = (F.pmod(F.xxhash64("path"), F.lit(PATH_BUCKETS)) == b).cast("double")
    words = F.concat(
        F.transform(F.slice(F.reverse(words_of(F.lower("before"))), 1, 2), lambda w: F.pmod(F.xxhash64(w, F.lit("before")), F.lit(WORD_BUCKETS))),
        F.transform(F.slice(words_of(F.lower("after")), 1, 1), lambda w: F.pmod(F.xxhash64(w, F.lit("after")), F.lit(WORD_BUCKETS))),
    )
    found = found.withColumn("_words", words)
    for b in range(WORD_BUCKETS):
        columns[f"word_{b}"] = F.array_contains("_words", F.lit(b).cast("bigint")).cast("double")
    found = found.select("*", *[F.coalesce(e, F.lit(0.0)).alias(f"f_{k}") for k, e in columns.items()]).drop("_words", "_classes")
    names = [f"f_{k}" for k in columns]
    return VectorAssembler(inputCols=names, outputCol="features").transform(found).drop(*names)


def labelled_by_evidence(found: DataFrame) -> DataFrame:
    """Adds ``label``. 1.0: a well-known key format; a password of three words or more; a value with letters and digits after a key word,
    or a long run of small letters, capitals and digits, that nothing refutes. 0.0: something refutes it (``REFUTED``; hexadecimal
    digits after a word such as commit). NULL: neither; these are not learned from, and the forest judges them by what it knows.
    """
    value, before, known = F.col("value"), F.col("before"), F.lit(False)
    in_context = F.concat(F.right(before, F.lit(12)), value)
    for f in FORMATS:
        known = known | value.rlike(f) | in_context.rlike(f)
    body = F.regexp_replace(value, f"^.*{ASSIGNED}", "")
    keyed = value.rlike(ASSIGNED) | before.rlike(f"{ASSIGNED}$")
    refuted = reduce(or_, [body.rlike(f) for f in REFUTED]) | (body.rlike("^[0-9a-fA-F]+$") & before.rlike(CHECKSUM_WORDS))
    varied = F.size(F.array_distinct(F.split(body, "")))
    mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
    likely = (keyed & mixed & (F.length(body) >= 10)) | (mixed & body.rlike("[a-z]") & body.rlike("[A-Z]") & (F.length(body) >= 20) & (varied >= 10))
    plain_word = keyed & ~body.rlike("[0-9]") & ~body.rlike(REFUTED[-1])
    phrase = plain_word & value.rlike(PASS_PHRASE)
    return found.withColumn("label", F.when(known | phrase | (likely & ~refuted), 1.0).when(refuted & ~plain_word, 0.0))


def fit(labelled: DataFrame, rows: int = FIT_ROWS, trees: int = 20, depth: int = 8, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest from ``features`` and ``label``, on a bounded sample of each label. None if one label is absent: nothing can be told apart."""
    keyed = labelled.select("features", "label", F.concat_ws("|", "value", "before", "after").alias("key"))
    sample = staged(bounded_sample(keyed.where("label = 1"), "key", rows // 2).unionByName(bounded_sample(keyed.where("label = 0"), "key", rows // 2)), "secret-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label")
    return forest.fit(sample.select("features", "label"))


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """The candidates with ``probability`` and ``is_secret``.

    ``labelled`` has the columns of ``candidates`` and ``label``; without it, evidence gives the labels. Without both labels all
    candidates stay, with a NULL probability.
    """
    known = dictionary(docs, text_col)
    found = staged(features(candidates(docs, id_col, text_col, path_col), known), "secret-candidates")
    model = fit((labelled_by_evidence(found) if labelled is None else features(labelled, known)).where("label is not null"))
    if model is None:
        return found.drop("features").withColumn("probability", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    scored = model.transform(found).withColumn("p", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction", "probability")
    return scored.withColumnRenamed("p", "probability").withColumn("is_secret", F.col("probability") >= threshold)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = None, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id``, ``n_candidates``, ``n_secrets``, ``positions`` (numbers of the secrets among all
    matches of ``CANDIDATE``, ascending) and ``spans`` (``start:end`` of the secrets in code points, comma-joined).

    NULL or empty texts have none. Each row has the findings of its own text, whether ids are repeated or missing. Empty table: no
    rows. Other columns are left out.
    """
    found = findings(docs, id_col, text_col, path_col, labelled, threshold)
    secret = F.col("is_secret")
    places = F.sort_array(F.collect_list(F.when(secret, F.struct("start", "end", "pos"))))
    # Findings are gathered for one text at most.
    by_text = found.groupBy(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(secret).alias("n_secrets"), places.alias("places"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"))
    rows = rows.join(by_text, (F.col("text_hash") == F.col("_hash")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    return rows.select(
        "doc_id",
        F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
        F.coalesce("n_secrets", F.lit(0)).alias("n_secrets"),
        F.coalesce(F.transform("places", lambda p: p["pos"]), F.array().cast("array<int>")).alias("positions"),
        F.coalesce(F.array_join(F.transform("places", lambda p: F.concat_ws(":", p["start"], p["end"])), ","), F.lit("")).alias("spans"),
    )


def redacted(text: Column, positions: Column) -> Column:
    """``text`` with the candidates at ``positions`` replaced by ``REDACTED``; a NULL text or no position: as it was."""
    parts = F.split(text, CANDIDATE, -1)
    shown = F.transform(F.regexp_extract_all(text, F.lit(CANDIDATE), 0), lambda v, i: F.when(F.array_contains(positions, i), REDACTED).otherwise(v))
    joined = F.array_join(F.zip_with(parts, shown, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    return F.when(F.size(positions) > 0, joined).otherwise(text)
