"""Prefix tries against nested loops over all conversations."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from martflow.llm import tries
from martflow.llm.queries import QUERIES
from martflow.llm.ranges import positions

COLUMNS = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]


def plain(sequences):
    """Nodes of ``{conv: [(role, text), ...]}``."""
    members = {}
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for p, own in members.items():
        below = [q for q in members if q[: len(p)] == p]
        leaves = [q for q in below if not any(r[:-1] == q and r != q for r in members if r)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(p))
        children = sum(1 for q in members if len(q) == len(p) + 1 and q[:-1] == p)
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(p), parent, len(own), children, len(leaves), saved, digest))
    return sorted(out, key=str)


def nodes(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def drawn(seed, count, longest):
    rng = random.Random(seed)
    say = lambda: (rng.choice(["user", "bot", ""]), rng.choice(["a", "bé", "", "ccc"]))
    out = {}
    for c in rng.sample(range(-50, 500), count):
        base = rng.choice(list(out.values())) if out and rng.random() < 0.7 else []
        cut = rng.randint(0, len(base))
        out[c] = (base[:cut] + [say() for _ in range(rng.randint(0, longest))])[:longest]
    return out


def table(spark, sequences):
    rows = [
        (c, t if t else None, r or None, x or None, "u", 9, b"n")
        for c, s in sequences.items()
        for t, (r, x) in enumerate(s)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(
        rows,
        "conv_id long, turn int, role string, text string, conv string, at int, name binary",
    ).repartition(3)


@pytest.mark.parametrize("longest", [1, 2, 3, 4, 7, 8, 17])
def test_random_conversations(spark, longest):
    sequences = {c: s for c, s in drawn(longest, 40, longest).items() if s}
    assert nodes(tries.conversation_trie(table(spark, sequences))) == plain(sequences)


def test_conversations_without_turns_belong_to_the_root(spark):
    sequences = {3: [("u", "x")], 5: []}
    turns = tries.numbered_turns(table(spark, sequences))
    convs = spark.createDataFrame([(3,), (5,)], "conv long")
    assert nodes(tries.prefix_trie(turns, convs)) == plain(sequences)
    assert nodes(tries.prefix_trie(turns.where("false"), convs.where("conv = 5"))) == plain({5: []})
    assert nodes(tries.prefix_trie(turns.where("false"), convs.where("false"))) == []


def test_one_long_conversation_and_many_equal_ones(spark):
    long = [("u", f"t{i}") for i in range(1500)]
    sequences = {0: long, 1: long[:700], 2: long[:700] + [("u", "z")]}
    sequences |= {c: [("u", "t0"), ("b", "same")] for c in range(10, 400)}
    out = {(r["conv_id"], r["depth"]): r for r in tries.conversation_trie(table(spark, sequences)).collect()}
    assert len(out) == 1 + 1500 + 1 + 1
    assert out[0, 0]["n_convs"] == 393 and out[0, 0]["n_leaves"] == 3
    assert out[0, 700]["n_convs"] == 3 and out[0, 701]["n_convs"] == 1
    ends = ",".join(map(str, range(10, 400)))
    assert out[10, 2]["ends_sha256"] == hashlib.sha256(ends.encode()).hexdigest()
    shared = sum(2 * len(f"t{i}") for i in range(1, 700)) + 392 * 2 + 389 * 4
    assert out[0, 0]["saved_tokens"] == shared


def test_ties_nulls_and_repeated_turns(spark):
    rows = [(1, None, "u", "first"), (1, 5, "u", "b"), (1, 5, "u", "b"), (1, 5, None, None), (None, 1, "u", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    out = sorted((r["at"], r["chars"]) for r in tries.numbered_turns(df).collect())
    assert [at for at, _ in out] == [0, 1, 2, 3] and out[0][1] == 5
    again = sorted((r["at"], r["chars"]) for r in tries.numbered_turns(df.repartition(4)).collect())
    assert out == again


def test_positions_over_many_ranges(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 5).cast("long").alias("g"), "id"
    )
    out = positions(rows.repartition(6), "g", ["id"]).collect()
    by_group = {}
    for r in out:
        by_group.setdefault(r["g"], []).append((r["at"], r["id"]))
    assert len(by_group[7]) == 2000
    for own in by_group.values():
        own.sort()
        assert [a for a, _ in own] == list(range(len(own)))
        assert [i for _, i in own] == sorted(i for _, i in own)


def test_digest(spark):
    folder = "/root/testdata/sf0.001"
    original = {}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").orderBy("turn").collect():
        original.setdefault(r["conv_id"], []).append((r["role"] or "", r["text"] or ""))
    rebuilt = {}
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = original.get(c - c % 100, [])[:h] + own[h:]
    out = QUERIES["op11_trie"](spark, folder)
    assert set(out.columns) == set(COLUMNS)
    assert nodes(out) == plain(rebuilt)
