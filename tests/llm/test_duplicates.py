"""Repeated strings, SimHash groups and benchmark passages against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from clickloom.llm import decontamination, queries, repeats, simhash
from clickloom.llm.components import components
from clickloom.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def removed(rows):
    """Result of each (id, text), in order of ids: length, bytes removed, runs, hash of what is left."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        b = text.encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), len(b) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    return out


def answers(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_repeats_equal_brute_force_on_documents(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in read_table(spark, SF, "documents").collect()]
    assert answers(queries.op2_repeats(spark, SF)) == removed(rows)


@pytest.mark.parametrize("run, piece, block", [(2500, 700, 50), (100_000, 8_000_000, 10)])
def test_repeats_over_many_runs_and_pieces(spark, monkeypatch, run, piece, block):
    rng = random.Random(run)
    monkeypatch.setattr(repeats, "RUN_BYTES", run)
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "BLOCK", block)
    pool = ["".join(rng.choice("ab é\n") for _ in range(rng.randint(60, 400))) for _ in range(25)] + ["x" * 500, "ab" * 200, "q" * 99]
    rows = [(i, "".join(p[rng.randint(0, 30) :] for p in rng.choices(pool, k=rng.randint(0, 6)))) for i in range(120)]
    rows.append((500, rows[3][1] * 3))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    out = repeats.remove(df).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) kept_sha256")
    assert answers(out) == removed(rows)


def test_repeated_rows_are_one_document(spark, monkeypatch):
    monkeypatch.setattr(repeats, "RUN_BYTES", 900)
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(200))
    n = len(text)
    rows = [(1, text), (1, text), (2, text + text), (None, text[:150]), (None, text[:150])] * 3
    out = repeats.remove(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).distinct().collect()
    second = removed([(0, text[:150]), (1, text), (2, text + text)])[2][1]
    assert {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in out} == {(None, 150, 0), (1, n, 150), (2, 2 * n, second)}


@pytest.mark.parametrize("hot", [0, 3, 40])
def test_hot_strings_go_by_window(spark, monkeypatch, hot):
    """A line in every second document, each time with other words around it, and copied texts: the same result by window or by suffix."""
    monkeypatch.setattr(repeats, "HOT_SUFFIXES", hot)
    monkeypatch.setattr(repeats, "RUN_BYTES", 3000)
    rng = random.Random(hot)
    line = "this line is in every second text of the corpus, é and so on"
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9)))
    rows = []
    for i in range(150):
        around = [" ".join(word() for _ in range(rng.randint(0, 25))) for _ in range(2)]
        rows.append((i, f"{around[0]} {line}{line[:rng.randint(0, 60)]} {around[1]}" if i % 2 else around[0] * rng.randint(1, 3)))
    rows += [(200 + i, rows[2 * i + 1][1]) for i in range(40)] + [(300, line * 8), (301, "y" * 450)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    out = repeats.remove(df).selectExpr("doc_id", "n_bytes", "n_removed", "n_spans", "sha2(kept, 256) kept_sha256")
    assert answers(out) == removed(rows)


def test_many_equal_rows_are_dealt_to_several_buckets(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT_ROWS", 5)
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(200))
    rows = [(2, text)] * 60 + [(1, text[100:400]), (3, "z" * 130)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((r["doc_id"], r["n_removed"], r["n_spans"]) for r in repeats.remove(df).collect())
    want = removed([(1, text[100:400]), (2, text), (3, "z" * 130)])
    assert got == sorted((i, want[i][1], want[i][2]) for i, _ in rows)


@pytest.mark.parametrize("n", [1, 13, 72])
def test_each_bucket_has_its_own_task(spark, n):
    keys = repeats.task_keys(spark, n)
    rows = spark.createDataFrame([(i, i, 7 * i, b"x") for i in range(40 * n)], "doc_id bigint, id bigint, text_hash bigint, text binary")
    dealt = repeats.by_bucket(rows, repeats.copied_rows(rows, 40 * n), n, keys).selectExpr("bucket", "spark_partition_id() task").distinct().collect()
    assert sorted(r["bucket"] for r in dealt) == sorted(keys) and sorted(r["task"] for r in dealt) == list(range(n))


def test_texts_are_dealt_once(spark):
    """Census, runs and the last cut read one exchange of the texts."""
    out = repeats.remove(read_table(spark, SF, "documents"))
    out.write.format("noop").mode("overwrite").save()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 2


def test_merge_gives_sorted_suffixes_with_their_common_prefixes():
    rng = random.Random(2)
    for k in (1, 2, 5, 8):
        runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(rng.randint(0, 40))) for _ in range(k)]
        coded = [[(repeats.common_prefix(p, s, 0), s, b"", 0, 0, 0) for p, s in zip([b"", *r], r)] for r in runs]
        got = list(repeats.merge([iter(r) for r in coded]))
        assert [g[1] for g in got] == sorted(s for r in runs for s in r)
        for p, g in zip([b"", *(g[1] for g in got)], got):
            assert g[0] == repeats.common_prefix(p, g[1], 0)


def test_nearby_words_share_a_golay_key():
    table, rng = simhash.near_table(), np.random.default_rng(1)
    assert set((table >= 0).sum(axis=1)) == {1, 6}
    fps = rng.integers(0, 2**64, 4000, dtype=np.uint64)
    own = simhash.golay_keys(fps, table)
    for bits in range(5):
        other = fps.copy()
        for i in range(len(fps)):
            for b in rng.choice(64, bits, replace=False):
                other[i] ^= np.uint64(1) << np.uint64(b)
        for a, b in zip(own, simhash.golay_keys(other, table)):
            assert (set(a) & set(b)) - {-1}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_groups_equal_brute_force(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in read_table(spark, SF, "documents").collect()]
    extra = " ".join(f"word{i}" for i in range(300))
    rows += [(2000 + k, extra.replace(f"word{7 * k} ", f"other{k} ", 1)) for k in range(30)] + [(3000, ""), (3001, "A"), (3002, "a"), (3003, " ")]
    prints = {i: plain_fingerprint(t) for i, t in rows}
    ids = np.array(sorted(prints))
    fps = np.array([prints[i] for i in ids], dtype=np.uint64)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1 :][np.bitwise_count(fps[k + 1 :] ^ fps[k]) <= 4]:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{prints[i]:016x}", find(i)) for i in ids.tolist()}


def test_components_of_long_and_dense_graphs(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000 + a, 5000 + b) for a in range(15) for b in range(a)] + [(7, 7)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + k: 1000 for k in range(200)}, **{5000 + a: 5000 for a in range(15)}}


def test_benchmark_passages_equal_exact_containment(spark):
    grams, size = defaultdict(set), {}
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    for r in read_table(spark, SF, "benchmark").collect():
        w = words(r["text"])
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        size[r["item_id"]] = len(own)
        for g in own:
            grams[g].add(r["item_id"])
    want = set()
    for r in read_table(spark, SF, "documents").collect():
        w, found = words(r["text"] or ""), defaultdict(int)
        for g in {tuple(w[k : k + 5]) for k in range(len(w) - 4)}:
            for i in grams.get(g, ()):
                found[i] += 1
        want |= {(r["doc_id"], i) for i, n in found.items() if n >= 0.8 * size[i]}
    assert {(r["doc_id"], r["item_id"]) for r in queries.op5_decontamination(spark, SF).collect()} == want


QUESTION = "Janet has 16 ducks and sells 3 eggs every day for 2 dollars, so Janet earns money. How much does Janet earn in 7 days if she eats 3 eggs?"


@pytest.mark.parametrize(
    "text, held",
    [
        (QUESTION, True),
        (QUESTION.replace("Janet", "Oleg").replace("16", "21").replace("3 eggs", "5 eggs").replace("dollars", "euros"), True),
        (QUESTION.replace("Janet", "Oleg", 1).replace("3 eggs", "9 eggs", 1).replace("so Janet", "so Mira"), False),
        ("An entirely different text about 16 ducks and 3 eggs that nobody sells on any day for money.", False),
    ],
)
def test_reparameterised_questions(spark, text, held):
    items = spark.createDataFrame([(1, QUESTION)], "item_id bigint, text string")
    docs = spark.createDataFrame([(5, f"Some words before. {text} And more after that.")], "doc_id bigint, text string")
    assert (decontamination.matches(docs, items).count() == 1) == held


def variant(name, ducks, eggs, days):
    return QUESTION.replace("Janet", name).replace("16", ducks).replace("3 eggs", f"{eggs} eggs").replace("7 days", f"{days} days")


def test_question_beside_its_variants(spark):
    items = spark.createDataFrame([(1, QUESTION)], "item_id bigint, text string")
    others = [variant("Oleg", "21", "5", "9"), variant("Mira", "12", "2", "4"), variant("Abel", "40", "8", "6")]
    mixed = QUESTION.replace("Janet", "Oleg", 1).replace("3 eggs", "9 eggs", 1).replace("so Janet", "so Mira")
    rows = [
        (1, " ".join([QUESTION, *others[:2]])),
        (2, " ".join([others[0], QUESTION.replace("so Janet", "so every week Janet"), others[1]])),
        (3, " ".join(others)),
        (4, f"{mixed} {mixed}"),
        (5, QUESTION),
        (5, others[0]),
        (5, others[1]),
    ]
    found = decontamination.matches(spark.createDataFrame(rows, "doc_id bigint, text string"), items).collect()
    assert {r["doc_id"] for r in found} == {1, 2, 3, 5}
    assert all(r["coverage"] == 1.0 for r in found if r["doc_id"] != 2)


def test_items_without_a_template_window(spark):
    """Items of fewer than five words, and of numbers, units and names only, are found by their real words."""
    items = spark.createDataFrame([(1, "What is gravity?"), (2, "12, 15 and 9"), (3, "3 7 11 15 19 23 27"), (4, "Paris"), (5, "...")], "item_id bigint, text string")
    table = " ".join(str(k * 17 % 1009) for k in range(5000))
    rows = [
        (1, "what is  GRAVITY"), (2, "12, 15 and 9"), (3, "The sequence goes on as 3 7 11 15 19 23 27 and so on for ever."), (4, "paris."),
        (5, "12, 15 and 8"), (6, "What is gravity? Nobody in the town knows it."), (7, "3 7 11 15 19 24 28 here"), (8, "London"), (9, "..."), (10, None), (11, table), (11, table), (12, "4 8 12 16 20 24 28"),
    ]
    got = decontamination.matches(spark.createDataFrame(rows, "doc_id bigint, text string"), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, 1), (2, 2), (3, 3), (4, 4)}
    assert {r["item_id"]: (r["n_windows"], r["n_found"]) for r in got} == {1: (1, 1), 2: (1, 1), 3: (3, 3), 4: (1, 1)}


def test_reparameterised_items_by_the_hundred(spark):
    """Every third item is planted with other names and numbers, exchanged consistently; as many copies mix theirs and must not match."""
    rng = np.random.default_rng(11)
    verbs, things = "carries sells paints counts repairs borrows".split(), "apples lamps chairs ropes stones bottles".split()
    names = ["Anna", "Boris", "Clara", "Dmitri", "Elena", "Farid", "Greta", "Hugo"]

    def question(k, name, a, b, wrong=None):
        verb, thing, other = verbs[k % 6], things[k // 6 % 6], things[k // 36 % 6]
        end, last, rest = wrong or (name, a, b)
        return f"{name} {verb} {a} {thing} near the market of row{chr(97 + k % 26)} and {b} {other} on each visit. How many {thing} has {end} left when {last} {thing} and {rest} {other} are gone from place{chr(97 + k // 26)}?"

    items = [(k, question(k, names[k % 8], 10 + k, 400 + k)) for k in range(300)]
    vocabulary = " ".join([*verbs, *things])
    docs, want = [], set()
    for k in range(0, 300, 3):
        a, b = (int(x) for x in rng.choice(np.arange(1000, 9999), 2, replace=False))
        docs.append((k, f"Before it {vocabulary}. {question(k, names[(k + 3) % 8], a, b)} After it."))
        want.add((k, k))
        docs.append((1000 + k, f"Before it. {question(k, names[(k + 3) % 8], a, b, (names[(k + 5) % 8], a + 1, b + 1))} After it."))
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert len(want & got) >= 0.95 * len(want)
    assert not any(d >= 1000 for d, _ in got)


def test_parts_have_their_own_tasks(spark, monkeypatch):
    """Results do not depend on the number of parts or tasks, and parts are dealt by number, not by the session's shuffle partitions."""
    monkeypatch.setattr(repeats, "PART_BYTES", 20_000)
    docs = read_table(spark, SF, "documents").where("doc_id < 300")
    want = {(r["doc_id"], r["n_removed"], r["n_spans"]) for r in repeats.remove(docs).collect()}
    rows = docs.where("text is not null").selectExpr("doc_id", "doc_id as id", "xxhash64(text) as text_hash", "cast(text as binary) as text")
    sent = repeats.repeated(repeats.by_bucket(rows, repeats.copied_rows(rows, 300), 11, []), 97, 11)
    assert sent.rdd.getNumPartitions() == 97
    monkeypatch.setattr(repeats, "MOST_TASKS", 5)
    assert {(r["doc_id"], r["n_removed"], r["n_spans"]) for r in repeats.remove(docs).collect()} == want
    monkeypatch.setattr(repeats, "PART_BYTES", 8_000_000)
    assert {(r["doc_id"], r["n_removed"], r["n_spans"]) for r in repeats.remove(docs).collect()} == want
