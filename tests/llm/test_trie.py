"""The conversation prefix trie against brute force."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from genefeat.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, next string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def plain(rows, share):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = dict(convs)
    if share:
        for c in convs:
            h = zlib.crc32(str(c).encode()) % 9
            built[c] = convs.get(c - c % 5, [])[:h] + convs[c][h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out, leaves, saved, children = [], {}, {}, {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children.get(p, [])) + (p not in children)
        saved[p] = sum(saved[x] for x in children.get(p, [])) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    random.seed(seed)
    rows = []
    for c in random.sample(range(300), 90):
        for t in range(random.choice([1, 2, 3, 6, 12])):
            turn = None if random.random() < 0.05 else t // random.choice([1, 1, 2])
            rows.append((c, turn, random.choice(["user", "bot", None]), random.choice(["é", "b", "", None, "long text"])))
    return rows + rows[:9] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("share", [False, True])
def test_trie_is_brute_force(spark, share):
    rows = made(4 + share)
    got = trie.conversation_trie(table(spark, rows), share=share)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, share)


def test_long_chains_copies_and_a_hot_first_turn(spark):
    """One conversation of 700 turns that others leave at several depths, 1,200 copies, and a turn that most begin with."""
    long = [(0, t, "u", f"t{t % 7}") for t in range(700)]
    rows = long + [(c, t, "u", f"t{t % 7}") for c, n in ((1, 300), (2, 301), (3, 699)) for t in range(n)]
    rows += [(c, 0, "u", "same") for c in range(10, 1210)] + [(c, t, "u", ["same", f"own {c}"][t]) for c in range(2000, 2300) for t in range(2)]
    got = trie.conversation_trie(table(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, False)


def test_nothing_and_turnless(spark):
    assert trie.conversation_trie(table(spark, []), share=True).count() == 0
    # Conversation 5 - 5 % 5 is itself; 6 takes the turns of 5, which is not there.
    got = trie.conversation_trie(table(spark, [(6, 0, "u", "x")]), share=True).collect()
    h = zlib.crc32(b"6") % 9
    assert len(got) == 2 if h == 0 else [tuple(r)[:4] for r in got] == [(6, 0, None, 1)]


def test_contraction_of_a_path_a_star_and_a_caterpillar(spark):
    edges = {i: i - 1 for i in range(1, 40)} | {100 + i: 39 for i in range(25)} | {200 + i: i for i in range(0, 39, 3)}
    nodes = [0, *edges]
    kids = {n: sum(p == n for p in edges.values()) for n in nodes}
    depth = {0: 0}
    for n, p in sorted(edges.items(), key=lambda x: (x[0] >= 40, x[0])):
        depth[n] = depth[p] + 1
    rows = [((n, depth[n]), (edges[n], depth[edges[n]]) if n in edges else None, kids[n], int(kids[n] == 0), n + 1) for n in nodes]
    df = spark.createDataFrame(rows, "id struct<conv_id:bigint,depth:bigint>, parent struct<conv_id:bigint,depth:bigint>, n_children bigint, n_leaves bigint, saved_tokens bigint")
    got = {r.id.conv_id: (r.n_leaves, r.saved_tokens) for r in trie.subtree_totals(df).collect()}

    def total(n):
        own = [total(x) for x, p in edges.items() if p == n]
        return sum(x[0] for x in own) + (not own), sum(x[1] for x in own) + n + 1

    assert got == {n: total(n) for n in nodes}


def test_a_hot_key_is_joined_once(spark):
    big = spark.range(5000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("k"), "id")
    small = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    got = trie.hot_join(big, small, ["k"])
    assert got.count() == 5000 and got.filter("v <> 2 * k").count() == 0
