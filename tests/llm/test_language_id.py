"""Context trees against a plain version, and languages of texts that were not learned from."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import language_id as li
from clickloom.llm import queries
from clickloom.sources.tables import read_table

SF = "/root/testdata/sf0.01"


def counts_of(texts: list[str]) -> list[dict[bytes, Counter]]:
    out: list[dict[bytes, Counter]] = [{} for _ in range(li.ORDER + 1)]
    for t in texts:
        data = b"\n" * li.ORDER + t.encode()
        for i in range(li.ORDER, len(data)):
            for k in range(li.ORDER + 1):
                out[k].setdefault(data[i - k : i], Counter())[data[i]] += 1
    return out


def bits(trees, text: str) -> float:
    """Byte by byte, from the definition."""
    data, total = b"\n" * li.ORDER + text.encode(), 0.0
    for i in range(li.ORDER, len(data)):
        for k in range(li.ORDER, -1, -1):
            seen = trees[k].get(data[i - k : i])
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if data[i] in seen:
                total -= math.log2(seen[data[i]] / whole)
                break
            total -= math.log2(len(seen) / whole)
        else:
            total += 8
    return total


def trees_from(samples: dict[str, list[str]]) -> li.Trees:
    rows = [
        (k, sum(b << 8 * (len(ctx) - j) for j, b in enumerate([*ctx, s])), lang, n)
        for lang, texts in enumerate(samples.values()) for k, seen in enumerate(counts_of(texts)) for ctx, nexts in seen.items() for s, n in nexts.items()
    ]
    order, key, lang, n = (np.array(c) for c in zip(*rows))
    return li.trees_of(list(samples), order, key.astype(np.uint64), lang, n.astype(float))


SAMPLES = {"aa": ["the old wall of the town", "there then\nthe"], "bb": ["la vieille ville été", ""], "cc": ["\x00\xff zz"]}


@pytest.mark.parametrize("stretch", [7, 1 << 18])
def test_code_lengths_are_exact(monkeypatch, stretch):
    monkeypatch.setattr(li, "STRETCH", stretch)
    trees = trees_from(SAMPLES)
    rnd = random.Random(2)
    texts = ["the wall", "", "été 🙂", "\x00", "qqqq", *["".join(rnd.choice("the olawn\nét\x00🙂") for _ in range(rnd.randrange(3000))) for _ in range(12)]]
    got = trees.code_lengths(texts)
    plain = [counts_of(t) for t in SAMPLES.values()]
    assert np.allclose(got, [[bits(p, t) for p in plain] for t in texts], rtol=1e-9)


def test_lookup():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(0, 1 << 60, 5000, dtype=np.uint64))
    table = li.Lookup(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rnd.integers(0, 1 << 60, 5000, dtype=np.uint64), keys)
    assert (table.find(others) == -1).all() and (li.Lookup(keys[:0]).find(others) == -1).all()


def test_fit_counts_the_whole_sample(spark):
    """Fewer stretches than the bound: the trees are those of all learned texts, cut every ``PIECE`` characters."""
    texts = [(i, ("el río " if i % 2 else "the river ") * (500 if i == 1 else 5) + str(i), "es" if i % 2 else "en") for i in range(30)]
    texts += [(100, None, "en"), (101, "", "en"), (102, "no language", None)]
    trees = li.fit(spark.createDataFrame(texts, "doc_id bigint, text string, lang string"))
    learned = {"en": [], "es": []}
    for i, t, lang in texts[:30]:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            learned[lang] += [t[k : k + li.PIECE] for k in range(0, len(t), li.PIECE)]
    asked = ["the río", "xyz", "el el the"]
    assert trees.languages == ["en", "es"]
    assert np.allclose(trees.code_lengths(asked), [[bits(counts_of(learned[x]), t) for x in ("en", "es")] for t in asked])


def test_sample_is_bounded(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "repeat('ab cd ', 600) as text", "if(id % 7 = 0, 'xx', 'yy') as lang")
    trees = li.fit(rows, pieces=20)
    assert trees.languages == ["xx", "yy"]
    # The root's escape tells how many bytes were counted: five different ones each.
    counted = 5 * (np.exp2(trees.escapes[0][0]) - 1)
    assert (counted <= 10 * li.PIECE).all() and (counted >= 10 * (3600 - li.PIECE)).all()


def test_query_on_held_out_documents(spark):
    rows = queries.op13_language_id(spark, SF).collect()
    true = {r["doc_id"]: r["lang"] for r in read_table(spark, SF, "documents").collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(true) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_messy(spark, messy, nothing):
    none = li.fit(messy)  # no row has a language
    assert {(r["lang_pred"], r["score"]) for r in li.predict(messy, none).collect()} == {("und", 0.0)}
    trees = li.fit(spark.createDataFrame([(i, t, x) for i, (x, t) in enumerate([("en", "the river runs there"), ("fr", "la rivière coule")] * 8)], "doc_id bigint, text string, lang string"))
    got = li.predict(messy, trees).collect()
    assert len(got) == messy.count() and {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 4)} == {"und"}
    assert {r["lang_pred"] for r in got if r["doc_id"] == 1} == {"en"} and li.predict(nothing, trees).count() == 0
    same = trees_from({"a": ["xyz"], "b": ["xyz"]})
    assert {(r["lang_pred"], r["score"]) for r in li.predict(messy, same).where("doc_id = 1").collect()} == {("a", 0.5)}
