"""URL filter by empirical-Bayes host reputation, below explicit rules.

Labelled page outcomes (bad or not) are counted for each host. Beta-binomial priors shrink them from level to level: all pages
to public suffix, suffix to registered domain, domain to host. How strongly a level holds its children is estimated from how
much their rates differ (method of moments). A host is blocked if the lower bound of its bad rate's posterior is above a
threshold; an explicit rule, the longest that fits, goes before.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm import quality_rules
from clickloom.llm.common import salted_lookup, staged

# Second-level names under which a two-letter country suffix is registered one level deeper.
SECOND_LEVEL = ("co", "com", "org", "net", "ac", "gov", "edu")
#: Parts of a host, between dots and hyphens, that make weak bad outcomes where no page of the host has a reviewed label.
BAD_HOST_WORDS = ("spam", "casino", "gambling", "pills", "warez", "porn", "adult", "xxx", "phishing", "malware")
#: A host without labels counts at most so many of its pages as bad for its name.
WORD_OUTCOMES = 20
MOST_RULES = 1000


@dataclass(frozen=True)
class Rule:
    """``allow`` or block of a host and its subdomains where the path starts with ``path``."""

    allow: bool
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for NULL or without ``://``."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The registered domain: the last two labels, or three under a suffix such as co.uk. An address of digits is its own."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    deep = (n > 2) & (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, n - 2).isin(*SECOND_LEVEL)
    return F.when(host.rlike(r"^[0-9.:]*$"), host).when(deep, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def suffix_of(domain: Column) -> Column:
    """What follows the first label of a registered domain."""
    return F.when(domain.rlike(r"^[0-9.:]*$"), "").otherwise(F.regexp_extract(domain, r"^[^.]*\.(.*)$", 1))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as its text and its verdict; NULL if none does. Equally long ones: block goes first."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules are written into the plan")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), not r.allow, r.text)):
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit("allow" if r.allow else "block").alias("verdict"))).otherwise(out)
    return out


def _strength(groups: DataFrame) -> float:
    """Pseudo-count of a level's prior, from the rates ``bad / n`` of its groups: one over the intraclass correlation, less one.

    Between 1 and 1,000; the largest where fewer than two groups have outcomes or all outcomes are alike.
    """
    sums = groups.where("n > 0").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") * F.col("n")).alias("squares"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("rates")
    ).first()
    if (sums["k"] or 0) < 2 or sums["n"] <= sums["k"] or not 0 < sums["bad"] < sums["n"]:
        return 1000.0
    k, n, rate = sums["k"], float(sums["n"]), sums["bad"] / sums["n"]
    between = max(0.0, sums["rates"] - n * rate * rate) / (k - 1)
    within = max(1e-9, (sums["bad"] - sums["rates"]) / (n - k))
    size = (n - sums["squares"] / n) / (k - 1)
    correlation = (between - within) / (between + (size - 1) * within)
    return min(1000.0, max(1.0, 1 / correlation - 1)) if correlation > 0 else 1000.0


def reputation(hosts: DataFrame, z: float = 1.2816) -> DataFrame:
    """From ``host``, ``n`` and ``bad`` (labelled outcomes, one row a host): ``host``, ``rate`` (posterior mean), ``low`` and ``high``.

    The bounds are ``z`` standard deviations of the beta posterior from its mean. Hosts without outcomes have their domain's prior.
    """
    hosts = staged(hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain"))), "url-hosts")
    domains = staged(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "url-domains")
    suffixes = staged(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "url-suffixes")
    whole = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    rate, s0, s1, s2 = (whole["bad"] + 0.5) / (whole["n"] + 1), _strength(suffixes), _strength(domains), _strength(hosts)
    mean = lambda prior, strength: (F.col("bad") + strength * prior) / (F.col("n") + strength)
    by_suffix = suffixes.select("suffix", mean(F.lit(rate), s0).alias("prior"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", mean(F.col("prior"), s1).alias("prior"))
    out = hosts.join(by_domain, "domain").withColumn("rate", mean(F.col("prior"), s2))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + s2 + 1))
    return out.select("host", "rate", (F.col("rate") - z * deviation).alias("low"), (F.col("rate") + z * deviation).alias("high"))


def outcomes(pages: DataFrame, labels: DataFrame, page_col: str = "page_id", url_col: str = "url", label_col: str = "doc_id") -> DataFrame:
    """``host`` and ``bad`` (0 or 1) of labelled pages: bad if a reviewed label of the same id says low quality or toxic.

    A host without such labels, of which a whole part is one of ``BAD_HOST_WORDS``, has a bad outcome for each of its pages, at
    most ``WORD_OUTCOMES``. Labels that are NULL say nothing.
    """
    marked = labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull())
    wrong = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    marked = marked.groupBy(F.col(label_col).alias("_page")).agg(F.max(wrong.cast("int")).alias("bad"))
    urls = pages.select(F.col(page_col).alias("_page"), host_of(F.col(url_col)).alias("host"))
    by_label = staged(urls.join(marked, "_page").select("host", "bad"), "url-outcomes")
    named = urls.where(F.col("host").rlike(rf"(?:^|[.-])(?:{'|'.join(BAD_HOST_WORDS)})(?:[.-]|$)")).groupBy("host").count()
    named = named.join(by_label.select("host").distinct(), "host", "left_anti")
    weak = named.select("host", F.explode(F.array_repeat(F.lit(1), F.least("count", F.lit(WORD_OUTCOMES)).cast("int"))).alias("bad"))
    return by_label.unionByName(weak)


def text_of(html: Column) -> Column:
    """Text of a raw page: without scripts, styles, comments and tags; blocks and breaks end lines, a blank line never remains."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|article|section|nav|header|footer|title|body)\b[^>]*>", "\n")
    text = F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", ""), r"[ \t]*\n\s*", "\n")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def content_outcomes(pages: DataFrame, url_col: str = "url", html_col: str = "html", threshold: float = 0.5) -> DataFrame:
    """``host`` and ``bad`` (0 or 1), a row for each page: what can be said of a page where nobody reviewed it.

    A page is bad if the quality rules reject its text (a posterior below ``threshold``, estimated over all pages; being short
    alone is no fault of a page) or if a whole part of its host is one of ``BAD_HOST_WORDS``. NULL and empty pages have no text
    to judge and count by their host's name alone: bad, or no outcome.
    """
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(text_of(F.col(html_col)), F.lit("")).alias("text"))
    judged = quality_rules.judge(rows, "host", "text").select(F.col("doc_id").alias("host"), (F.col("quality") < threshold).alias("poor"), "n_words")
    named = F.col("host").rlike(rf"(?:^|[.-])(?:{'|'.join(BAD_HOST_WORDS)})(?:[.-]|$)")
    return judged.where(named | (F.col("n_words") > 0)).select("host", (named | F.col("poor")).cast("int").alias("bad"))


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: tuple[Rule, ...] = (),
    page_col: str = "page_id",
    url_col: str = "url",
    most_bad: float = 0.5,
    z: float = 1.2816,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``rate`` and ``low``: a row for each row.

    ``labelled`` has ``host`` and ``bad``. A NULL url, or one without ``://``, has an empty host and path, and the empty host has
    a reputation like any other. Without any outcomes the rate is one half, the bound is below it, and all is allowed. Repeated
    rows and NULL ids are judged each. Empty table: no rows. Other columns are left out.
    """
    rows = pages.select(F.col(page_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = staged(rows, "url-pages")
    counts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    seen = labelled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    hosts = staged(counts.join(seen, "host", "left").fillna(0, ["n", "bad"]), "url-counts")
    known = reputation(hosts.select("host", "n", "bad"), z).join(hosts.select("host", "n_pages"), "host")
    out = salted_lookup(rows, staged(known.select("host", "rate", "low", "n_pages"), "url-reputation"), ["host"], "n_pages", ["page_id", "path"])
    fits = rule_for(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("low") > most_bad, "block").otherwise("allow")
    return out.withColumn("_fits", fits).select("page_id", "host", "path", F.col("_fits.rule").alias("rule"), F.coalesce("_fits.verdict", by_method).alias("verdict"), "rate", "low")
