"""Secrets, personal data, packing and the pipeline."""

import itertools
import random
import re
import string

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from clickloom.llm import packing, pii, quality_rules, secrets, simhash
from clickloom.sources.tables import read_table

SF = "/root/testdata/sf0.01"
KEYS = re.compile(r'AKIA[A-Z0-9]{16}|(?i:token = "[0-9a-f]{40}")|(?i:password=[0-9a-f]{18})')


def test_secrets_are_found_and_nothing_else(spark):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").collect()}
    for r in queries()["op1_secrets"](spark, SF).collect():
        spans = [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]
        want = [m[0] for m in KEYS.finditer(texts[r["doc_id"]])]
        got = [texts[r["doc_id"]][a:b] for a, b in spans]
        assert len(got) == r["n_secrets"] == len(want) and all(w.rstrip('"') in g + '"' for w, g in zip(want, got))


def test_forest_learns_from_labelled_findings(spark):
    rows = [(i, f"build sha{i % 7} abcdef{i:010d}deadbeef of the release") for i in range(60)] + [(100 + i, f"secret key QX{i:03d}ZZTOPAB{i * 7919:06d}KK leaked") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = secrets.candidates(docs)
    labelled = found.where("doc_id % 2 = 0").withColumn("label", (F.col("doc_id") >= 100).cast("double"))
    got = secrets.scan(docs, labelled=labelled).where("doc_id % 2 = 1").collect()
    assert all((r["n_secrets"] == 1) == (r["doc_id"] >= 100) for r in got)


def other_formats(i: int) -> str:
    """Keys in formats that ``FORMATS`` does not list."""
    rnd = random.Random(i)
    run = lambda n, pool=string.ascii_letters + string.digits: "".join(rnd.choice(pool) for _ in range(n))
    return [
        f"api_key={run(24)}", f"secret: S3cr3t!{run(9)}", f"aws_secret_access_key = {run(40, string.ascii_letters + string.digits + '+/')}", f"AIza{run(35)}",
        f"password=correct-horse-battery-{rnd.choice(['staple', 'candle', 'engine'])}", f"glpat-{run(20)}", f"client_secret='{run(30)}'", f"SG.{run(22)}.{run(43)}",
    ][i % 8]


def harmless(i: int) -> str:
    rnd = random.Random(i)
    return [
        f"call +44 20 7946 {rnd.randrange(1000, 9999)}", f"commit {rnd.randrange(16**40):040x}", f"see https://www.site{i}.example/guide/page{i}.html", f"on 2024-05-{10 + i % 20}T10:00:00",
        f"card {rnd.randrange(10**15, 10**16)}", f"/usr/lib/python3.{i % 9}/site-packages/module", f"version 1.{i}.0.20240101", f"mail person{i}@department{i % 7}.example.org",
    ][i % 8]


def test_secrets_of_unlisted_formats(spark):
    """Recall on formats outside the list and on passwords of words, and precision beside what only looks like keys."""
    rows = [(i, f"The old wall and {harmless(i)} there.") for i in range(400)] + [(1000 + i, f"The old wall and {other_formats(i)} there.") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["n_secrets"] for r in secrets.scan(docs).collect()}
    found, wrong = sum(got[1000 + i] > 0 for i in range(400)), sum(got[i] > 0 for i in range(400))
    missed = [other_formats(i) for i in range(400) if not got[1000 + i]]
    assert found >= 0.9 * 400, missed
    assert found / (found + wrong) >= 0.95


def test_rows_without_an_id_have_their_own_secrets(spark):
    key = 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"'
    rows = [(None, f"a {key}"), (None, "nothing here"), (6, "nothing here"), (6, f"in the end {key}"), (7, "mail person12345@site.example now")]
    got = [(r["doc_id"], r["n_secrets"], r["spans"]) for r in secrets.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    expected = [(None, 1, "2:51"), (None, 0, ""), (6, 0, ""), (6, 1, "11:60"), (7, 0, "")]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_numbers_of_thousands_of_digits(spark):
    rows = [(1, "0" * 5000 + ".1.1.1"), (2, "9" * 5000 + ".1.1.1"), (3, "1.2.3." + "0" * 4999 + "4"), (4, "7 " * 6000), (5, "1" * 9000 + ". " + "2" * 5000)]
    got = {r["doc_id"]: r["n_ip"] for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0}


def test_pieces_that_tie_in_id_and_number_pack_alike(spark):
    rows = [(None, "a " * n) for n in (5, 9, 7, 9, 6, 8)] * 30
    one, two = (sorted(map(tuple, packing.pack(spark.createDataFrame(r, "doc_id bigint, text string").repartition(k), buckets=1).collect()), key=str) for r, k in ((rows, 1), (rows[::-1], 7)))
    assert one == two


def test_redaction_replaces_only_the_named_candidates(spark):
    df = spark.createDataFrame([('a token = "24be64439e3e49cf46b2d7c90f" b 4785380592391139 c', [0]), ("x", []), (None, None)], "t string, p array<int>")
    got = [r[0] for r in df.select(secrets.redacted(F.col("t"), F.col("p"))).collect()]
    assert got == ['a [SECRET]" b 4785380592391139 c', "x", None]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0, "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def test_plain_matches_equal_the_patterns_on_random_texts():
    import random

    rng = random.Random(8)
    pieces = ["a@b.c", "@", ".", "1.2.3.4", "256.1.1.1", "0001.2.3.4.5.6.7.8", "+1 (23) 45-67 890", "4111111111111111", "4111 1111-1111 1111", " ", "-", "+", "(", "é", "7", "x.y", "_d@e.f", "--", "  ", "@@", "1", "%"]
    for _ in range(4000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 14)))
        got = sorted((s, k, e) for k, s, e, ok in pii.plain_matches(text) if ok)
        assert ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in got) == base_spans(text), text


def test_personal_data_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").collect()}
    for r in pii.find(read_table(spark, SF, "documents")).collect():
        want = base_spans(texts[r["doc_id"]])
        assert r["base_spans"] == want and set(want.split(",")) <= set(r["spans"].split(","))
        assert [r[f"n_{k}"] for k in pii.KINDS] == [want.count(f"{k}:") for k in pii.KINDS]


def test_wide_spans_are_added(spark):
    rows = []
    for i in range(400):
        n = f"{200 + i % 700}-{(i * 37) % 900 + 100}-{(i * 7919) % 10000:04d}"
        name = "".join("anbecolidu"[int(c)] for c in str(i * 7))
        rows.append((i, f"Please call +1-{n} today."))
        rows.append((2000 + i, f"You may write to {name}@{name[::-1]}s.org for more."))
        rows.append((1000 + i, f"Please call or write: the order {n} of version {i % 9}.{i}.300.{i % 11} costs {4000000000000000 + i * 7919 * 13}."))
    rows += [(5000, "Please call (212) 555-0123 today."), (5001, "You may write to ann [at] site.org for more."), (5002, "The order 212-555-0123 is late.")]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).where("doc_id >= 5000").collect()}
    assert got == {5000: "phone:12:26", 5001: "email:17:34", 5002: ""}


def test_trees_and_thresholds_take_all_candidates(spark, monkeypatch):
    docs = spark.range(10000).select(F.col("id").alias("doc_id"), F.format_string("Write to ann%d@site%d.org, or see 300.%d.1.1 there.", "id", F.col("id") % 97, "id").alias("text"))
    found = pii.staged(pii.candidates(docs), "pii-candidates")
    labelled = found.where("right is not null").count()
    assert labelled > 25000
    taken, fit, limits = [], pii.GBTClassifier.fit, pii.thresholds
    monkeypatch.setattr(pii.GBTClassifier, "fit", lambda self, df: taken.append(df.count()) or fit(self, df))
    monkeypatch.setattr(pii, "thresholds", lambda held, precision: taken.append(held.count()) or limits(held, precision))
    pii.score(found)
    assert sum(taken) == labelled and abs(taken[1] / labelled - 0.25) < 0.02


@pytest.mark.parametrize("seed", range(3))
def test_thresholds_equal_a_sorted_list(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(3), p := round(rng.random(), 2 + seed), float(rng.random() < 0.7 + 0.35 * p)) for _ in range(3000)]
    want = []
    for kind in range(4):
        mine = sorted((p, y) for k, p, y in rows if k == kind)
        good = [p for p, _ in mine if (above := [y for q, y in mine if q >= p]) and sum(above) >= 0.95 * len(above)]
        want.append(max(min(good), 0.5) if good else 2.0)
    assert pii.thresholds(spark.createDataFrame(rows, "kind int, p double, label double"), 0.95) == want


def test_boundaries_have_the_least_padding():
    histogram = {3: 5, 4: 1, 9: 7, 10: 2, 11: 9, 30: 1, 31: 4}
    for k in (1, 2, 3, 4, 7, 9):
        cost = lambda b: sum(n * (min(x for x in b if x >= length) - length) for length, n in histogram.items())
        options = (c for r in range(1, k + 1) for c in itertools.combinations(histogram, r) if 31 in c)
        got = packing.boundaries(histogram, k)
        assert got == sorted(got) and len(got) <= k and got[-1] == 31 and cost(got) == min(map(cost, options))
    assert packing.boundaries({}, 4) == []


def test_batches_keep_every_token_and_the_budget(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 40)
    docs = read_table(spark, SF, "documents")
    got = packing.pack(docs, max_length=256, buckets=5, batch_tokens=2048).collect()
    words = {r["doc_id"]: len(re.findall(r"[^\W_]+|[^\s\w]|_", r["text"])) for r in docs.collect()}
    total, batches = dict.fromkeys(words, 0), {}
    for r in got:
        total[r["doc_id"]] += r["length"]
        assert r["length"] <= r["bucket"] and r["start"] == 256 * r["piece"]
        batches.setdefault((r["bucket"], r["batch"]), []).append(r["slot"])
    assert total == words and len({r["bucket"] for r in got}) == 5
    for bucket in {b for b, _ in batches}:
        sizes = [len(batches[bucket, k]) for k in range(sum(b == bucket for b, _ in batches))]
        assert all(n == 2048 // bucket for n in sizes[:-1]) and 0 < sizes[-1] <= 2048 // bucket
    assert all(sorted(slots) == list(range(len(slots))) for slots in batches.values())


def test_pipeline_equals_its_parts_by_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in quality_rules.judge(docs).where("kept").collect()}
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs.where(F.col("doc_id").isin(sorted(kept)))).collect()}
    alone = {d for d in kept if groups[d] == d}
    items = [re.findall(r"[^\W_]+", r["text"].lower()) for r in read_table(spark, SF, "benchmark").collect()]
    grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in items]

    def clean(text):
        w = re.findall(r"[^\W_]+", text.lower())
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        return not any(g and len(own & g) >= 0.8 * len(g) for g in grams)

    left = {d for d in alone if clean(texts[d])}
    want = {d: len(re.findall(r"[^\W_]+|[^\s\w]|_", re.sub(r'(?i:token = "[0-9a-f]{40})|AKIA[A-Z0-9]{16}|(?i:password=[0-9a-f]{18})', "[SECRET]", texts[d]))) for d in left}
    got = {r["doc_id"]: r["n"] for r in corpus_pipeline.run(spark, SF).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert set(got) == left
    assert sum(got[d] != want[d] for d in left) == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_messy_and_empty_tables(spark, messy, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (messy, nothing):
        out = stage(spark, docs, SF)
        n = out.count()
        if name != "packing":
            assert out.columns == docs.columns and n <= docs.count()
        elif docs is nothing:
            assert n == 0
    if name == "simhash_near_dedup":
        assert stage(spark, messy, SF).where("doc_id = 1 or n_chars = 783").count() <= 1
    if name == "secret_scan":
        assert stage(spark, messy, SF).count() == messy.count()


def test_rows_are_named_alike_however_files_are_split(spark, tmp_path):
    text = F.concat_ws(" ", F.lit("word"), F.col("id"), F.lit("password=abcdef012345678901"))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"), F.create_map(F.lit("k"), "id").alias("more"))
    docs = docs.unionByName(docs.where("doc_id < 5"))
    docs.repartition(7).write.parquet(str(tmp_path / "d"))
    seen = []
    for size in ("1b", "128m"):
        spark.conf.set("spark.sql.files.openCostInBytes", size)
        rows = corpus_pipeline.numbered(spark.read.parquet(str(tmp_path / "d"))).select("_uid", "row.doc_id").collect()
        seen.append({(r["doc_id"], r["_uid"]) for r in rows})
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0] == seen[1] and len({u for _, u in seen[0]}) == 3000
    stored = spark.read.parquet(str(tmp_path / "d")).where("doc_id < 5")
    assert corpus_pipeline.near_duplicate_stage(spark, stored, SF).groupBy("doc_id").count().where("count > 1").isEmpty()
    assert corpus_pipeline.secret_stage(spark, stored, SF).count() == 10
