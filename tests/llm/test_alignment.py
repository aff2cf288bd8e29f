"""Token alignment against plain Python, text by text."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest

from clickloom.llm import alignment as al
from clickloom.llm import queries

A, B = f"{al.TOKENIZERS}/byte_bpe_50k.json", f"{al.TOKENIZERS}/piece_bpe_32k.model"
NOTHING = (0, 0, 0, 0, "")


def plain(text: str | None):
    """(n_a, n_b, n_groups, n_links, groups) and the links, from the definition."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not text:
        return NOTHING, []
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=B)
    ids_a, ids_b = tok.encode(" " + text, add_special_tokens=False).ids, piece.encode(text)
    printable = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    chars = {chr(b): b for b in printable}
    for b in range(256):
        if b not in printable:
            chars[chr(256 + sum(x < b for x in range(256) if x not in printable))] = b
    entries = {i: e for e, i in json.load(open(A))["model"]["vocab"].items()}
    bytes_a = [bytes(chars[c] for c in entries[i]) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if len(p := piece.id_to_piece(i)) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for i in ids_b]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return NOTHING, []
    spans = []
    for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
        at, one = 0, []
        for i, p in zip(ids, parts):
            one.append((at, at + len(p), i))
            at += len(p)
        spans.append(one)
    cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    groups, lo, links = [], 0, []
    for cut in cuts:
        mine = [[s for s in side if lo <= s[0] and s[1] <= cut] for side in spans]
        groups.append("|".join(",".join(str(s[2]) for s in side) for side in mine))
        links += [(x[2], y[2]) for x in mine[0] for y in mine[1] if x[0] < y[1] and y[0] < x[1]]
        lo = cut
    return (len(ids_a), len(ids_b), len(groups), len(links), ";".join(groups)), links


TEXTS = [
    "The river runs along the old wall.", "Été à l'école, déjà vu 🙂🙂 çà et là", "x" * 150, "a▁b", None, "", " ", "  two  spaces\n\n\ttabs ", "<s> <|endoftext|> </s> <unk>",
    "\x00\x01 control", "数字 と 漢字", "1234567890 " * 40, "Straßenübergänge " * 30, "=" * 1000 + "-" * 77, "The river runs along the old wall.",
]


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_all_shared_ends(seed):
    rnd = np.random.default_rng(seed)
    size, share = int(rnd.integers(2, 4000)), rnd.choice([0.001, 0.02, 0.5, 0.95])
    ends = [np.union1d(np.flatnonzero(rnd.random(size) < share * rnd.random()), [size]) for _ in range(2)]
    if seed % 3 == 0:  # a shared stretch at one end alone
        ends = [np.union1d(e[e > size // 2] // 2 * 2 + k, np.r_[1 : 1 + size // 10, 2 * size]) for k, e in enumerate(ends)]
    got = al.shared_cuts(ends[0], ends[1], np.array([0]), np.array([len(ends[0])]))
    expected = [i for i, e in enumerate(ends[0][:-1]) if e in set(ends[1].tolist())]
    assert got.tolist() == expected


def test_texts_against_brute_force():
    rnd = random.Random(4)
    words = "the café 北京 <s> 12,5 €uro naïve x ' s'il 🙂 ==== \r\n".split(" ")
    texts = [*TEXTS, *["".join(rnd.choice(words) + rnd.choice([" ", "", "  "]) for _ in range(rnd.randrange(1, 60))) for _ in range(80)]]
    got = al.align_texts(texts, A, B)
    size_b = len(al.open_coder(B)[1])
    some = 0
    for i, t in enumerate(texts):
        expected, links = plain(t)
        assert tuple(got[c][i] for c in ("n_a", "n_b", "n_groups", "n_links", "groups")) == expected, t
        assert Counter({(int(p) // size_b, int(p) % size_b): int(n) for p, n in zip(got["pairs"][i], got["times"][i])}) == Counter(links)
        assert expected[3] == expected[0] + expected[1] - expected[2]
        some += expected[0] > 0
    assert some > 40


def test_fast_encoding_is_the_same():
    """On plain texts the encoder by rank, on others the whole one: always the ids of the file's own tokenizer."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    encode, table = al.open_coder(A)
    assert al._by_rank(A, table) is not None
    rnd, pool = random.Random(1), " \t\n\r'¡²¼ª×ǅŉsdtmlvre019aZ.,-_<|>é \x85\x1c\u00a0北🙂\u0301"
    texts = ["".join(rnd.choice(pool[: rnd.choice([20, 34, len(pool)])]) for _ in range(rnd.randrange(1, 60))) for _ in range(20000)]
    texts += [table[i].decode("utf-8", "ignore") for i in range(len(table))] + ["a" * 3000 + " " * 3000, "don't we'll  <|endoftext|>"]
    plain = sum(al.PLAIN.fullmatch(t) is not None for t in texts)
    assert 10000 < plain < len(texts)
    assert encode(texts) == [e.ids for e in tok.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def rows_of(texts):
    return [(i % 13 if i % 5 else None, t, "x", 1) for i, t in enumerate(texts)]


def expected_rows(texts):
    made = [plain(t) for t in texts]
    counts = Counter(x for _, links in made for x in links)
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    out = []
    for (row, (found, links)) in zip(rows_of(texts), made):
        sha = hashlib.sha256(found[4].encode()).hexdigest() if found[4] else ""
        out.append((row[0], *found[:4], sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, tmp_path):
    texts = TEXTS * 3
    spark.createDataFrame(rows_of(texts), "doc_id bigint, text string, row string, pairs int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_alignment(spark, str(tmp_path)).collect()
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=str) == expected_rows(texts)


@pytest.mark.parametrize("limit", [0, 20])
def test_pairs_beyond_the_broadcast_limit(spark, limit):
    """The same sums whether pairs are broadcast, joined, or some of each."""
    docs = spark.createDataFrame(rows_of(TEXTS * 2), "doc_id bigint, text string, row string, pairs int")
    aligned = al.align(docs, A, B)
    counts = al.link_counts(aligned, len(al.open_coder(B)[1]))
    assert counts.count() > limit
    key = lambda df: sorted(tuple(r) for r in df.select("row", "n_best", "count_sum").collect())
    assert key(al.weigh(aligned, counts, limit)) == key(al.weigh(aligned, counts))


def test_empty_and_messy(spark, messy, nothing):
    assert al.alignment(nothing).count() == 0
    got = al.alignment(messy).collect()
    assert len(got) == messy.count() and all(r["n_a"] == 0 and r["groups"] == "" for r in got if r["doc_id"] in (2, 3))
    twice = [tuple(r) for r in got if r["doc_id"] == 1]
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0][1] > 0
