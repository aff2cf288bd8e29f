"""Quality rules combined by weak supervision. DataFrame functions only.

Every rule votes good, bad or abstains. Expectation-maximisation over the counts of the vote patterns estimates how often
each rule votes either way on good and on bad documents, without labels; a document is kept if its posterior probability
of being good reaches the threshold. The texts are read once; their measures are stored, counted by pattern and judged. All that reaches the driver is one
count for each vote pattern, at most 3 to the power of the number of rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import SPACE, documents_of, staged, words_of

# The characters counted as symbols, and frequent function words of the corpus languages.
SYMBOLS = "#*$%&|<>"
FUNCTION_WORDS = (
    "the of and to in is that it for was with as at by this from are be "
    "de la le les des et un une que qui en dans pour sur est au du "
    "el los las se del por con para su una lo al "
    "der die das und den von mit sich auf ist nicht ein eine dem zu im"
).split()


@dataclass(frozen=True)
class Rule:
    """Votes +1 (good) where ``good`` holds, -1 where ``bad`` holds, else 0. The conditions read the measured columns."""

    name: str
    good: str
    bad: str


# Shares are of the words, lines or letters of the text.
RULES = (
    Rule("length", "n_words between 50 and 200000", "n_words < 20"),
    Rule("word_length", "word_chars between 3 * n_words and 10 * n_words", "word_chars > 14 * n_words or word_chars < 2 * n_words"),
    Rule("symbols", "n_symbols * 100 <= n_words", "n_symbols * 10 > n_words"),
    Rule("repeated_lines", "n_dup_lines = 0 and n_lines > 1", "n_dup_lines * 10 > 3 * n_lines"),
    Rule("repeated_words", "n_repeat_words * 10 <= n_words", "n_repeat_words * 10 > 3 * n_words"),
    Rule("capitals", "n_upper * 100 <= 15 * n_letters", "n_upper * 100 > 30 * n_letters"),
    Rule("line_ends", "n_ended_lines * 10 >= 7 * n_lines", "n_ended_lines * 10 < 2 * n_lines"),
    Rule("function_words", "n_function_words * 100 >= 5 * n_words", "n_function_words * 200 < n_words and n_words >= 50"),
    Rule("letters", "n_letters * 10 >= 8 * word_chars", "n_letters * 10 < 6 * word_chars"),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended_lines", "n_upper", "n_letters", "n_function_words")


def _chars_of(text: Column, pattern: str) -> Column:
    """Code points of ``text`` in runs that match a one-character class."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{pattern}+", ""))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts in ``MEASURES`` of each row's whole text. One narrow pass, no shuffle.

    A NULL or blank text has all counts zero. Repeated rows are measured alike, and rows stay as many as they were.
    """
    text = F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    base = documents_of(docs, id_col, text_col).select(
        "doc_id",
        _chars_of(text, f"[{SYMBOLS}]").alias("n_symbols"),
        _chars_of(text, r"\p{Lu}").alias("n_upper"),
        _chars_of(text, r"\p{L}").alias("n_letters"),
        words_of(text).alias("_words"),
        lines.alias("_lines"),
    )
    n = F.size("_words")
    word = F.col("_words")
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(word[i], word[i + 1], word[i + 2])))
    words = F.col("_words")
    base = base.select(
        "doc_id",
        "n_symbols",
        "n_upper",
        "n_letters",
        n.alias("n_words"),
        F.length(F.array_join("_words", "")).alias("word_chars"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(FUNCTION_WORDS))).alias("n_function_words"),
        F.size("_lines").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        F.size(F.filter("_lines", lambda x: x.rlike(f"[.!?:;…\"'”»)][{SPACE}]*$"))).alias("n_ended_lines"),
        hashes.alias("_hashes"),
    )
    # Three-word windows as (hash, position), sorted, so that equal windows are neighbours. Few texts get that far.
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    pairs = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.withColumn("_windows", F.when(repeats, pairs)).drop("_hashes")
    w, last = F.col("_windows"), F.size("_windows") - 1
    again = F.filter(w, lambda x, k: ((k > 0) & (F.get(w, k - 1)["h"] == x["h"])) | ((k < last) & (F.get(w, k + 1)["h"] == x["h"])))
    base = base.withColumn("_again", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("_windows")
    a = F.col("_again")
    covered = F.aggregate(
        F.transform(a, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(a, k + 1) - i, F.lit(3)))), F.lit(0), lambda s, x: s + x
    )
    base = base.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))
    return base.select("doc_id", *[F.col(c).cast("long").alias(c) for c in MEASURES])


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The votes as text, one of ``+``, ``-`` and ``0`` for each rule."""
    return F.concat(*[F.when(F.expr(r.bad), "-").when(F.expr(r.good), "+").otherwise("0") for r in rules])


@dataclass(frozen=True)
class VoteModel:
    """``prior``: share of good documents. ``log_odds``: for each rule, what a ``-``, ``0`` or ``+`` adds to the log odds of good."""

    prior: float
    log_odds: tuple[dict[str, float], ...]
    accuracy: tuple[float, ...]

    def posterior(self, pattern: Column) -> Column:
        """Probability of good, from a column of vote patterns."""
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for k, table in enumerate(self.log_odds):
            vote = F.substring(pattern, k + 1, 1)
            total = total + F.when(vote == "-", table["-"]).when(vote == "+", table["+"]).otherwise(table["0"])
        return 1.0 / (1.0 + F.exp(-total))


# Where the estimate starts. A good document rarely breaks a rule; a bad one breaks some rules and passes the others.
START = {"good": {"+": 0.80, "-": 0.01, "0": 0.19}, "bad": {"+": 0.62, "-": 0.25, "0": 0.13}}


def estimate(patterns: dict[str, int], steps: int = 30, prior: float = 0.85, weight: float = 50.0) -> VoteModel:
    """Expectation-maximisation on the counts of vote patterns.

    ``weight`` pseudo-counts hold each rule's table near ``START``, so few documents, or none at all, give nearly the plain
    vote. The classes cannot swap names, as the start fixes which side of the votes is good. A vote never counts against its
    own direction: where the estimate says so it has no weight, and an abstention has none either.
    """
    n_rules = len(next(iter(patterns), "")) or len(RULES)
    tables = [{side: dict(START[side]) for side in START} for _ in range(n_rules)]
    share, total = prior, sum(patterns.values())
    for _ in range(steps):
        good = {}
        for p in patterns:
            odds = math.log(share / (1 - share)) + sum(math.log(tables[k]["good"][v] / tables[k]["bad"][v]) for k, v in enumerate(p))
            good[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        share = (sum(patterns[p] * good[p] for p in patterns) + weight * prior) / (total + weight)
        for k in range(n_rules):
            for side in START:
                sums = {v: weight * START[side][v] for v in "+-0"}
                for p, count in patterns.items():
                    sums[p[k]] += count * (good[p] if side == "good" else 1 - good[p])
                whole = sum(sums.values())
                tables[k][side] = {v: sums[v] / whole for v in sums}
    odds, right = [], []
    for t in tables:
        odds.append({"+": max(0.0, math.log(t["good"]["+"] / t["bad"]["+"])), "-": min(0.0, math.log(t["good"]["-"] / t["bad"]["-"])), "0": 0.0})
        hit, miss = share * t["good"]["+"] + (1 - share) * t["bad"]["-"], share * t["good"]["-"] + (1 - share) * t["bad"]["+"]
        right.append(hit / (hit + miss))
    return VoteModel(share, tuple(odds), tuple(right))


def fit(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """Counts each vote pattern over all rows (at most 3 ** rules groups) and estimates the rules' accuracies."""
    if len(rules) > 12:
        raise ValueError("more than 12 rules make more vote patterns than the driver should hold")
    counts = measured.groupBy(votes(rules).alias("pattern")).count().collect()
    return estimate({r["pattern"]: r["count"] for r in counts})


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated three-word windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, rules: tuple[Rule, ...] = RULES, model: VoteModel | None = None) -> DataFrame:
    """``doc_id``, the measures, ``pattern``, ``quality`` (posterior of good), ``base_failed`` and ``kept``, a row for each row.

    Empty table: no rows, and the model is the start of the estimate. NULL ids stay NULL. Other columns are left out.
    """
    measured = staged(measure(docs, id_col, text_col), "rule-measures")
    model = model or fit(measured, rules)
    judged = measured.withColumn("pattern", votes(rules)).withColumn("base_failed", base_failed())
    judged = judged.withColumn("quality", model.posterior(F.col("pattern")))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
