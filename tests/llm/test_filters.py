"""Quality rules, line quality, toxicity and URL filter against brute force or held-out labels."""

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import line_quality, quality_rules, queries, toxicity, url_filter
from clickloom.llm.queries import URL_RULES
from clickloom.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    many = Counter(windows)
    covered = {j for k, w in enumerate(windows) if many[w] > 1 for j in range(k, k + 3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_rule_measures_equal_brute_force(spark, messy):
    rows = read_table(spark, SF, "documents").select("doc_id", "text").union(messy.select("doc_id", "text").where("doc_id > 1 and doc_id <> 6").selectExpr("-doc_id", "text"))
    texts = {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in quality_rules.judge(rows).collect():
        want = measured(texts[r["doc_id"]])
        assert tuple(r[n] for n in names) == want, r["doc_id"]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_rules_drop_bad_documents_and_keep_clean_ones(spark):
    labels = read_table(spark, SF, "labels").select("doc_id", F.col("quality").alias("label"))
    got = quality_rules.judge(read_table(spark, SF, "documents")).join(labels, "doc_id").where("not base_failed").groupBy("label", "kept").count().collect()
    n = {(r["label"], r["kept"]): r["count"] for r in got}
    assert n.get((0, True), 0) <= 0.05 * n[0, False] and n.get((1, False), 0) <= 0.02 * n[1, True]


def test_estimate_trusts_rules_that_agree_and_not_noise():
    rng = np.random.default_rng(3)
    good = rng.random(4000) < 0.8
    right = np.where(good, "+", np.where(rng.random(4000) < 0.6, "-", "+"))
    also = np.where(good, np.where(rng.random(4000) < 0.03, "-", "+"), np.where(rng.random(4000) < 0.6, "-", "+"))
    third = np.where(good, "+", np.where(rng.random(4000) < 0.7, "-", "0"))
    noise = np.where(rng.random(4000) < 0.1, "-", "+")
    model = quality_rules.estimate(Counter(map("".join, zip(right, also, third, noise))))
    assert model.log_odds[3]["-"] > -1 > -2 > max(t["-"] for t in model.log_odds[:3])
    assert quality_rules.estimate({}).prior == pytest.approx(0.85)


def test_line_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    field = line_quality.LineField(rng.normal(size=line_quality.WIDTH), rng.normal(size=(2, 2)))
    x = rng.normal(size=(6, line_quality.WIDTH)) / 5
    total, good = 0.0, np.zeros(6)
    for states in itertools.product((0, 1), repeat=6):
        weight = np.exp(sum(s * (x[t] @ field.weights) for t, s in enumerate(states)) + sum(field.moves[a, b] for a, b in zip(states, states[1:])))
        total += weight
        good += weight * np.array(states)
    assert field.marginals(x) == pytest.approx(good / total)


def test_line_quality_on_held_out_documents(spark):
    rows = queries.op8_line_quality(spark, SF)
    for r in rows.limit(50).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and r["predicted"] == int(r["score"] >= 0.7)
    got = rows.where("held_out").join(read_table(spark, SF, "labels"), "doc_id").collect()
    good, bad = ([r["score"] for r in got if r["quality"] == y] for y in (1, 0))
    assert np.mean([[(g > b) + 0.5 * (g == b) for b in bad] for g in good]) > 0.97


def test_ordinal_regression_orders_grades():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 4, 1500)
    rows = [np.flatnonzero(rng.random(8) < (0.1 + 0.25 * g * np.r_[np.ones(4), np.zeros(4)])) for g in grades]
    weights, cuts = toxicity.fit_ordinal(rows, grades, 8)
    assert weights[:4].min() > 1 and abs(weights[4:]).max() < 0.6 and (np.diff(cuts) > 0).all()
    expected = toxicity.OrdinalModel({}, tuple(cuts)).above(np.array([weights[r].sum() for r in rows])).sum(axis=1)
    assert np.corrcoef(expected, grades)[0, 1] > 0.75


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = read_table(spark, sf, "documents"), read_table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.where("doc_id % 2 = 0"))
    other = labels.where("doc_id % 2 = 1").select("doc_id", F.col("toxic").alias("y"))
    got = toxicity.predict(docs.join(other, "doc_id", "left_semi"), model).join(other, "doc_id").collect()
    caught = [r["toxic"] for r in got if r["y"] == 1]
    wrong = [r["toxic"] for r in got if r["y"] == 0]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.015


def test_url_rules_equal_brute_force(spark):
    urls = [r["url"] for r in read_table(spark, SF, "pages").select("url").collect()]
    urls += ["http://WWW.Example.COM/en/x", "a://b://example.com/en/", "http://example.com", "http://x.net/es/?q#f", "http://badnet/es/", "http://com/", "plain", None, "http://h?x/y", "http://h#x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    none = spark.createDataFrame([], "host string, bad int")

    def split(url):
        if not url or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]

    for r in url_filter.judge(pages, none, URL_RULES).collect():
        host, path = split(urls[r["page_id"]])
        fits = [x for x in URL_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best.text if best else None)
        assert r["verdict"] == ("block" if best and not best.allow else "allow")


def test_reputation_shrinks_to_the_level_above(spark):
    rows = [("a.bad.com", 200, 190), ("b.bad.com", 150, 140), ("new.bad.com", 0, 0), ("a.good.com", 300, 6), ("new.good.com", 0, 0), ("one.good.com", 1, 1), ("x.other.org", 80, 8)]
    got = {r["host"]: r for r in url_filter.reputation(spark.createDataFrame(rows, "host string, n bigint, bad bigint")).collect()}
    assert got["a.bad.com"]["low"] > 0.85 and got["new.bad.com"]["rate"] > 0.5 > got["new.good.com"]["rate"]
    assert got["new.good.com"]["rate"] < got["one.good.com"]["rate"] < 1 and all(r["low"] < r["rate"] < r["high"] for r in got.values())


def test_labels_go_before_words_in_hosts(spark):
    hosts = ["antispam.example"] * 50 + ["spam.example"] * 50 + ["spills.example"] * 50 + ["best-pills.test"] * 50
    pages = spark.createDataFrame([(i, f"http://{h}/{i}") for i, h in enumerate(hosts)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id bigint, quality int, toxic int")
    got = url_filter.outcomes(pages, labels).groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad")).collect()
    assert {tuple(r) for r in got} == {("antispam.example", 50, 0), ("spam.example", 50, 0), ("best-pills.test", url_filter.WORD_OUTCOMES, url_filter.WORD_OUTCOMES)}
    verdicts = {r["host"]: r["verdict"] for r in url_filter.judge(pages, url_filter.outcomes(pages, labels)).collect()}
    assert verdicts == {"antispam.example": "allow", "spam.example": "allow", "spills.example": "allow", "best-pills.test": "block"}


def test_toxicity_learns_each_row_of_a_repeated_id(spark):
    """Many rows with one labelled id stay as many rows, each with its own features."""
    clean, bad = "the river runs along the old wall ", "you worthless miserable fool be silent "
    rows = [(1, clean * (1 + i % 3)) for i in range(150)] + [(2, bad * (1 + i % 3)) for i in range(150)]
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id bigint, toxic int")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, labels)
    got = {(r["doc_id"], r["toxic"]) for r in toxicity.predict(docs, model).collect()}
    assert len(model.weights) > 0 and {bool(t) for d, t in got if d == 1} == {False} and {bool(t) for d, t in got if d == 2} == {True}


JUNK_PAGE = "<html><body><!-- a --><p>" + "BUY | NOW | $$$ | CLICK | ### | WIN | %% | FREE | " * 12 + "</p></body></html>"


def test_bad_hosts_are_blocked_by_what_their_pages_say(spark):
    """Planted hosts: one of junk pages, one with a few of them, one named for what it sells, a new one beside each, and a NULL page."""
    rows, n = [], 0
    for host, pages, junk in [("a.junk-farm.test", 60, 57), ("b.fine.example", 200, 6), ("www.best-pills.test", 40, 0), ("c.fine.example", 3, 1), ("xpills.example", 30, 0)]:
        for k in range(pages):
            text = "".join(f"<p>The wall number {n} stands by the river, and the people of town {k} walk there in the evening of every day.</p>" for n in range(k, k + 6))
            rows.append((n, f"https://{host}/{n}", JUNK_PAGE if k < junk else f"<html><style>p{{}}</style>{text}</html>"))
            n += 1
    rows += [(n, "https://empty.example/1", None), (None, None, None), (n + 1, "https://empty.example/2", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    outcomes = url_filter.content_outcomes(pages)
    counts = {r["host"]: (r["n"], r["bad"]) for r in outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad")).collect()}
    assert counts == {"a.junk-farm.test": (60, 57), "b.fine.example": (200, 6), "www.best-pills.test": (40, 40), "c.fine.example": (3, 1), "xpills.example": (30, 0)}
    verdicts = {r["host"]: r["verdict"] for r in url_filter.judge(pages, outcomes).collect()}
    assert {h for h, v in verdicts.items() if v == "block"} == {"a.junk-farm.test", "www.best-pills.test"}
    assert url_filter.content_outcomes(pages.limit(0)).count() == 0


def test_text_of_a_raw_page(spark):
    html = "<HTML><Title>One</title><script>a<b</SCRIPT ><p class='x'>two <b>three</b><br/>\n\n four<!-- <p>no --></p><style>p{}</style>"
    row = spark.createDataFrame([(html,), (None,)], "html string").select(url_filter.text_of(F.col("html")).alias("t")).collect()
    assert [x["t"] for x in row] == ["One\ntwo three\nfour", None]


def test_url_verdicts_equal_plain_python(spark):
    """The whole of op7 on sf0.01, from its own outcomes: three levels of shrinkage and the bound, written out plainly."""
    pages = read_table(spark, SF, "pages")
    outcomes = [(r["host"], r["bad"]) for r in url_filter.content_outcomes(pages).collect()]
    hosts = {url_filter_host(r["url"]) for r in pages.collect()}
    n, bad = Counter(h for h, _ in outcomes), Counter(h for h, b in outcomes if b)
    levels = [lambda h: "", lambda h: ".".join(h.split(".")[-2:]).split(".", 1)[-1], lambda h: ".".join(h.split(".")[-2:]), lambda h: h]
    sums = [{key(h): (sum(n[x] for x in hosts if key(x) == key(h)), sum(bad[x] for x in hosts if key(x) == key(h))) for h in hosts} for key in levels]

    def strength(groups):
        seen = [(a, b) for a, b in groups.values() if a]
        k, total, wrong = len(seen), sum(a for a, _ in seen), sum(b for _, b in seen)
        if k < 2 or total <= k or not 0 < wrong < total:
            return 1000.0
        rates, squares, mean = sum(b * b / a for a, b in seen), sum(a * a for a, _ in seen), wrong / total
        between, within = max(0.0, rates - total * mean * mean) / (k - 1), max(1e-9, (wrong - rates) / (total - k))
        size = (total - squares / total) / (k - 1)
        rho = (between - within) / (between + (size - 1) * within)
        return min(1000.0, max(1.0, 1 / rho - 1)) if rho > 0 else 1000.0

    powers = [strength(s) for s in sums[1:]]
    for r in url_filter.judge(pages, spark.createDataFrame(outcomes, "host string, bad int"), URL_RULES).collect():
        total, wrong = sums[0][""]
        rate = (wrong + 0.5) / (total + 1)
        for key, s, power in zip(levels[1:], sums[1:], powers):
            a, b = s[key(r["host"])]
            rate = (b + power * rate) / (a + power)
        low = rate - 1.2816 * (rate * (1 - rate) / (n[r["host"]] + powers[2] + 1)) ** 0.5
        assert r["rate"] == pytest.approx(rate) and r["low"] == pytest.approx(low)
        if r["rule"] is None:
            assert r["verdict"] == ("block" if low > 0.5 else "allow")


def url_filter_host(url):
    return re.sub("[A-Z]", lambda m: m[0].lower(), re.match(r"[^/?#]*", url.split("://", 1)[1])[0])


def test_line_quality_fit_is_bounded_by_lines(spark):
    """Repeated ids count once, and a document of very many lines, or of one very long line, is left out of the fit and scored whole."""
    good = "\n".join(f"The river runs along the old wall, and town {k} lies beside it." for k in range(8))
    bad = "\n".join("| | ## $$ BUY NOW %% ** <<" for _ in range(8))
    rows = [(i, good if i % 2 else bad) for i in range(1, 60)] + [(1, good + "\nMore of the river.")] * 50
    rows += [(1001, "## $$\n" * 300_000), (1002, "word " * 400_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in [*range(1, 60), 1001, 1002]], "doc_id bigint, quality int, toxic int")
    field = line_quality.fit(docs, labels)
    plain = line_quality.fit(docs.where("doc_id < 1000"), labels)
    assert np.array_equal(field.weights, plain.weights) and np.array_equal(field.moves, plain.moves)
    got = {r["doc_id"]: r["score"] for r in line_quality.predict(docs, field).collect()}
    assert min(s for i, s in got.items() if i < 60 and i % 2) > 0.7 > 0.3 > max(s for i, s in got.items() if i < 60 and not i % 2)
    assert len(got) == 61
