import hashlib
import random
import zlib

import pytest

from pagelathe.llm import prefix_trie, scan
from pagelathe.llm.queries import op11_prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, h1 string, section string, position string"
CLASH = ("x", None, "y", "z")


def by_hand(rows):
    """The trie of rebuilt conversations, one dictionary after another."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = {}
    for c, path in whole.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    children, out = {}, []
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def below(node):
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        leaves = 0 if node in children else 1
        for child in children.get(node, []):
            s, x = below(child)
            saved, leaves = saved + s, leaves + x
        return saved, leaves

    for node, convs in members.items():
        saved, leaves = below(node)
        ends = ",".join(str(c) for c in sorted(convs) if whole[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children.get(node, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows, n=3):
    table = spark.createDataFrame([(*r, *CLASH) for r in rows], SCHEMA).repartition(n)
    found = prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.ordered_turns(table)))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in found.select(names).collect()), key=repr)


def test_against_a_trie_of_dictionaries(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice("abc") * rng.randrange(3)) for c in range(0, 330) for t in range(rng.randrange(1, 12))]
    # A family without its head, a conversation of many blocks, and one that only repeats its start.
    rows += [(c, t, "user", "same") for c in (501, 502, 599, 702) for t in range(6)]
    rows += [(1000, t, "user", f"line {t}") for t in range(70)] + [(1001, t, "user", f"line {t}") for t in range(35)]
    assert trie(spark, rows) == by_hand(rows)


def test_nulls_ties_and_turnless(spark):
    rows = [
        (7, None, "user", "first"), (7, 0, None, "é𝄞"), (7, 0, None, None), (7, 0, "a", "b"), (7, 1, "user", ""), (7, 1, "user", ""),
        (None, 0, "user", "nobody"), (100, 0, "user", "héllo"), (101, 0, "user", "héllo"), (303, 5, None, None), (9, 3, "x", "y" * 30_000),
    ]
    assert trie(spark, rows, 5) == by_hand(rows)
    # Its only turn is left out and the head of its family is absent.
    c = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6)
    assert trie(spark, [(c, 0, "user", "gone")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_no_conversations(spark):
    assert trie(spark, []) == []


def test_a_key_over_many_ranges(spark):
    rows = spark.createDataFrame([(5, i, i * 7 - 300) for i in range(900)] + [(k, i, k) for k in range(40) for i in range(k % 4)], "k bigint, i bigint, v bigint")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = scan.scanned(rows, "k", [rows.i], {"total": ("v", 1), "hash": ("v", scan.FACTOR)}, "test").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    for k in {r.k for r in found}:
        total, hashed = 0, 0
        for n, r in enumerate(sorted((r for r in found if r.k == k), key=lambda r: r.i), 1):
            assert (r.position, r.total_before) == (n, total) and r.hash_before % 2**64 == hashed
            total, hashed = total + r.v, (hashed + r.v * pow(scan.FACTOR, n, 2**64)) % 2**64
            assert r.total == total and r.hash % 2**64 == hashed


def test_turns_of_nodes(spark):
    table = spark.createDataFrame([(0, 0, "user", "a"), (0, 1, "assistant", "b")], "conv_id bigint, turn bigint, role string, text string")
    turns = prefix_trie.ordered_turns(table)
    nodes = prefix_trie.prefix_trie(turns.selectExpr("conv_id", "0 AS section", "position", "turn_id", "chars"))
    assert [(r.depth, r.role, r.text) for r in prefix_trie.last_turns(nodes, turns).orderBy("depth").collect()] == [(0, None, None), (1, "user", "a"), (2, "assistant", "b")]


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query_on_the_given_table(spark, size):
    folder = f"/root/testdata/{size}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in op11_prefix_trie(spark, folder).collect()), key=repr) == by_hand(rows)
