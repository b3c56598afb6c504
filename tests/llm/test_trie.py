"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vitrine.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(held) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(convs[c]) == len(node))))
        out.append((min(held), len(node), min(members[node[:-1]]) if node else None, len(held), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(trie):
    return sorted(map(tuple, trie.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_trie_matches_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(pt, "ID_SPAN", 4)
    rng = random.Random(seed)
    rows = []
    for c in [*range(-7, 60), 10**12, 10**12 + 3]:
        turns = [(rng.choice(["user", "bot", None, ""]), rng.choice(["a", "b", "é文", None, ""])) for _ in range(rng.choice([0, 1, 2, 3, 8, 12, 17, 33]))]
        base = rng.choice([turns, [("user", "a")] * rng.randrange(9)])
        rows += [(c, i if rng.random() < 0.9 else None, *t) for i, t in enumerate(base)]
    rows += [(70 + i, t, "user", "copy") for i in range(25) for t in range(6)] + [(None, 1, "user", "x"), rows[0], rows[0], (3, 0, "user", "long " * 50_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit(1), "pos": F.lit(2), "name": F.lit("own")})
    convs = ordered(rows)
    assert found(pt.conversation_trie(df)) == brute(convs)
    assert found(pt.prefix_trie(*pt.crossed(pt.turn_rows(df)))) == brute(rebuilt(convs))


def test_turns_are_numbered_over_partitions(spark):
    rows = [(1, None, "user", f"{i % 50}") for i in range(3000)] + [(2, i, None, "x") for i in range(3000)] + [(3, 5, "r" * 40, str(i)) for i in range(500)]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows_of = pt.turn_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for c, turns in ordered(rows).items():
        mine = sorted((r["pos"], bytes(r["name"]), r["bytes"]) for r in rows_of if r["conv_id"] == c)
        assert mine == [(i, hashlib.sha256(str(len(r)).encode() + b":" + r + x).digest(), len(x)) for i, (r, x) in enumerate(turns)]


def test_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(pt.conversation_trie(df)) == [] and found(pt.prefix_trie(*pt.crossed(pt.turn_rows(df)))) == []
    alone = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA)
    assert found(pt.prefix_trie(*pt.crossed(pt.turn_rows(alone)))) == brute(rebuilt(ordered([(1, 0, "user", "x")])))
