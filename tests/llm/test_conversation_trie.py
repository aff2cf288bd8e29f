"""List ranking, the distributed scan, and the conversation trie against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.llm import conversation_trie as ct
from clickloom.llm import list_ranking, queries
from clickloom.llm.common import staged
from clickloom.llm.scan import scan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("near", [True, False])
def test_list_rank_over_many_blocks(spark, near):
    """Lists whose links stay near, and lists in random order, which only rounds by chance can shorten."""
    rnd = random.Random(5)
    order = list(range(900))
    if not near:
        rnd.shuffle(order)
    lists, rows, expected = [order[:1], order[1:400], order[400:]], [], {}
    for one in lists:
        total = 0
        for i, x in enumerate(one):
            rows.append((x, one[i + 1] if i + 1 < len(one) else None, x % 7))
            expected[x] = (i, total)
            total += x % 7
    rnd.shuffle(rows)
    got = list_ranking.list_rank(spark.createDataFrame(rows, "id bigint, next bigint, w int"), ["w"], block=64).collect()
    assert {r["id"]: (r["position"], r["w"]) for r in got} == expected and len(got) == 900


def test_list_rank_of_nothing(spark):
    assert list_ranking.list_rank(spark.createDataFrame([], "id bigint, next bigint, w int"), ["w"]).count() == 0


def test_shorten_keeps_to_its_block():
    head, before, tail = list_ranking.shorten(np.array([2, 3, 5, 9]), np.array([5, 40, 9, -1]), np.array([[1], [10], [100], [1000]]))
    assert head.tolist() == [0, 1, 0, 0] and before[:, 0].tolist() == [0, 0, 1, 101] and tail[0] == 3 and tail[1] == 1


def test_scan_of_groups_over_many_tasks(spark):
    rnd = random.Random(3)
    rows = [(g, i, rnd.randrange(1 << 32)) for g, n in (("a", 1), ("b", 3000), ("c", 2), ("d", 40)) for i in range(n)]
    expected, upto, last = {}, {}, {}
    for g, i, x in rows:
        expected[g, i] = (i, upto.get(g, 0) % (1 << 32), last.get(g))
        upto[g], last[g] = upto.get(g, 0) + x, x
    rnd.shuffle(rows)
    table = staged(spark.createDataFrame(rows, "g string, i int, x bigint").repartition(5), "t")
    got = scan(table.withColumn("y", F.col("x")), ["g"], ["i"], ("x",), lag="y").collect()
    assert {(r["g"], r["i"]): (r["rank"], r["x_before"], r["y_before"]) for r in got} == expected
    assert sorted(r["rank"] for r in scan(table, [], ["g", "i"]).collect()) == list(range(len(rows)))
    assert scan(table.limit(0), ["g"], ["i"], ("x",)).count() == 0


def tries(conversations: dict[int, list[tuple[str, str]]]) -> dict:
    nodes: dict[tuple, list[int]] = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(conversations[c]) == len(path))))
        parent = min(nodes[path[:-1]]) if path else None
        out[min(members), len(path)] = (parent, len(members), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x, key=lambda y: y[:2])] for c, x in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    return out


def result(df) -> dict:
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): tuple(r[c] for c in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


def conversations(n: int, seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    said = ["", "yes", "no  way", "tell me\nmore", "déjà vu 🙂"]
    rows = []
    for c in rnd.sample(range(n * 2), n):
        for t in range(rnd.choice([1, 1, 2, 3, 4, 6, 30])):
            rows.append((c, None if t == 0 and rnd.random() < 0.2 else t, rnd.choice(["user", "assistant", None]), rnd.choice([*said, None])))
    return rows


def test_trie_against_brute_force(spark, tmp_path, monkeypatch):
    rows = conversations(300, 1) + [(None, 1, "user", "lost")]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("depth", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(queries.op11_conversation_trie(spark, str(tmp_path))) == tries(rebuilt(rows))


def test_trie_in_small_blocks_and_its_tour(spark):
    rows = conversations(60, 2)
    own: dict[int, list] = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own.setdefault(c, []).append((role or "", text or ""))
    trie = ct.prefix_trie(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), block=32)
    digests = ct.ends_digest(trie.ends)
    got = trie.nodes.join(digests, ct.KEY, "left").fillna({"ends_sha256": ct.EMPTY_SHA256})
    assert result(got) == tries(own)
    spans = {(r["conv_id"], r["depth"]): (r["enter"], r["leave"]) for r in got.collect()}
    assert sorted(x for s in spans.values() for x in s) == list(range(2 * len(spans)))
    assert spans[min(own), 0] == (0, 2 * len(spans) - 1)


def test_one_conversation_with_most_rows_and_many_copies(spark):
    """A third of the rows in one conversation, and a third of all conversations alike; turns with the same number and repeated rows."""
    rows = [(7, i, "user", f"t{i % 5}") for i in range(2000)] + [(c, 0, "user", "hello there") for c in range(100, 900)]
    rows += [(1000, 1, "a", "same"), (1000, 1, "a", "same"), (1000, None, "b", "first")]
    trie = ct.prefix_trie(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), block=256)
    nodes = {(r["conv_id"], r["depth"]): r for r in trie.nodes.collect()}
    assert len(nodes) == 1 + 2000 + 1 + 3 and nodes[7, 0]["n_convs"] == 802 and nodes[7, 0]["n_leaves"] == 3
    assert nodes[7, 1]["parent_conv_id"] == 7 and nodes[100, 1]["saved_tokens"] == 2 * 799 and nodes[7, 0]["saved_tokens"] == 2 * 799
    digests = {r["depth"]: r["ends_sha256"] for r in ct.ends_digest(trie.ends).collect()}
    assert digests[1] == hashlib.sha256(",".join(map(str, range(100, 900))).encode()).hexdigest()


def test_empty_and_turnless(spark, tmp_path):
    schema = "conv_id bigint, turn bigint, role string, text string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert queries.op11_conversation_trie(spark, f"{tmp_path}/none").count() == 0
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 1)  # loses its only turn, has no base
    spark.createDataFrame([(alone, 0, "user", "x")], schema).write.parquet(f"{tmp_path}/one/conversations.parquet")
    sha = hashlib.sha256(str(alone).encode()).hexdigest()
    assert result(queries.op11_conversation_trie(spark, f"{tmp_path}/one")) == {(alone, 0): (None, 1, 0, 1, 0, sha)}
