"""Prefix trie: one partition and many against brute force, the query against SQL, edge rows."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from lakepipe.llm import prefix_trie
from lakepipe.llm.prefix_trie import Forest, common_turns, conversation_paths, trie_nodes, with_base
from lakepipe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def sha(ids):
    return hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def brute(convs):
    """Nodes of {conv: [(role, text)]}, straight from the definition."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    out = []
    for p, m in members.items():
        kids = {q[: len(p) + 1] for q in below[p] if len(q) > len(p)}
        leaves = sum(all(r == q for r in below[q]) for q in below[p])
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below[p] if q)
        up = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), up, len(m), len(kids), leaves, saved, sha([c for c in m if len(convs[c]) == len(p)])))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def table(spark, convs, extra=()):
    rows = [(c, k, r, t) for c, turns in convs.items() for k, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame([*rows, *extra], "conv_id long, turn long, role string, text string")


def corpus(n, seed, words=3, most=6):
    rng = random.Random(seed)
    return {c * 7 - 20: [(rng.choice(["u", "a"]), "x" * rng.randint(0, words)) for _ in range(rng.randint(1, most))] for c in range(n)}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = con.execute(ORACLES["op13_prefix_trie"]).fetchall()
    assert found(QUERIES["op13_prefix_trie"](spark, SF)) == sorted(want, key=str)
    assert len(want) > 300


@pytest.mark.parametrize("rows", [1, 3, 20, 1000])
def test_partitions_merge_to_the_same_trie(spark, monkeypatch, rows):
    convs = corpus(160, rows)
    convs |= {10_000 + k: [("u", "hot")] * 3 for k in range(60)}  # copies over several partitions
    convs |= {20_000 + k: [("u", "hot")] * 3 + [("a", "x" * (k % 4))] for k in range(40)}
    convs |= {30_000: [("u", "hot")] * 90, 30_001: [("u", "hot")] * 80 + [("a", "end")]}
    monkeypatch.setattr(prefix_trie, "_PART_ROWS", rows)
    assert found(trie_nodes(conversation_paths(table(spark, convs)))) == brute(convs)


@pytest.mark.parametrize("seed", range(6))
def test_forest_of_one_partition(seed):
    rng = random.Random(seed)
    convs = {c: [("u", rng.choice("ab") * 2) for _ in range(rng.randint(0, 5))] for c in range(40)}
    digest = {"aa": b"a" * 16, "bb": b"b" * 16}
    rows = sorted((b"".join(digest[t] for _, t in turns), c, [len(t) for _, t in turns]) for c, turns in convs.items())
    paths, ids, sizes = zip(*rows)
    got = [(r[8], r[3], r[7], *r[9:]) for r in Forest(list(ids), list(paths), list(sizes), -1, -1).rows(0)]
    assert sorted(got, key=str) == brute(convs)


def test_base_turns_replace_own(spark):
    convs = {c: t for c, t in corpus(60, 3).items()}
    convs |= {c: [("u", str(c)), ("a", "b"), ("u", "")] for c in (100, 101, 199, 205, -100, -101)}

    def rebuilt(c):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100
        return convs.get(c - base, [])[:h] + convs[c][h:]

    paths = conversation_paths(table(spark, convs))
    keep = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    got = trie_nodes(with_base(paths, F.col("conv") - F.col("conv") % 100, keep, 5))
    assert found(got) == brute({c: rebuilt(c) for c in convs})
    assert any(not rebuilt(c) for c in convs)  # some have no turn left


def test_edge_rows(spark):
    extra = [(1, None, None, None), (1, 5, "u", "é" * 50000), (None, 0, "u", "x"), (2, 0, "u", "x"), (2, 0, "u", "x"), (3, 0, "u", "x")]
    d = table(spark, {}, extra).withColumn("path", F.lit(1)).withColumn("conv", F.lit("x")).withColumn("t", F.lit(2.0))
    want = {1: [("", ""), ("u", "é" * 50000)], 2: [("u", "x"), ("u", "x")], 3: [("u", "x")]}
    assert found(trie_nodes(conversation_paths(d))) == brute(want)
    assert trie_nodes(conversation_paths(d.where("conv_id > 9"))).count() == 0
    # "a:b" and "a" + ":b" are different turns; role and text are not run together.
    assert trie_nodes(conversation_paths(table(spark, {1: [("a", "bc")], 2: [("ab", "c")]}))).count() == 3


def test_common_turns():
    a = bytes(range(256)) * 20
    assert common_turns(a, a) == 320 and common_turns(a, a[:160]) == 10 and common_turns(b"", a) == 0
    for at in (0, 17, 2000, 5119):
        b = bytearray(a)
        b[at] ^= 1
        assert common_turns(a, bytes(b)) == at // 16
