"""Tries over conversations next to brute force, and odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlake.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def told(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def nodes_by_brute_force(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, told(role or "", text or ""), role or "", text or ""))
    given = {conv: [(t[3], t[4]) for t in sorted(turns)] for conv, turns in held.items()}
    rebuilt = {}
    for conv, turns in given.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = tuple(given.get(conv - conv % 100, [])[:h] + turns[h:])
    members, kids, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
    for prefix in members:
        if prefix:
            kids[prefix[:-1]] += 1
    for prefix, convs in members.items():
        for depth in range(len(prefix) + 1):
            saved[prefix[:depth]] += (len(convs) - 1) * len(prefix[-1][1]) if prefix else 0
            leaves[prefix[:depth]] += kids[prefix] == 0
    out = []
    for prefix, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(prefix))
        parent = min(members[prefix[:-1]]) if prefix else None
        out.append(
            (min(convs), len(prefix), parent, len(convs), kids[prefix], leaves[prefix], saved[prefix],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def nodes_of(df, shard):
    return sorted((tuple(r) for r in prefix_trie.prefix_nodes(df, shard).select(*COLUMNS).collect()), key=str)


def conversations(seed, count):
    """Few different turns, so that long prefixes are shared, and copies of whole conversations."""
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(count * 3), count):
        same = rng.random() < 0.3
        for turn in range(rng.randint(1, 9)):
            text = "x" * (turn + 1) if same else rng.choice(["a", "bb", "ñé", "\U0001f600 x"])
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard", [2, 5, 2048])
def test_nodes_equal_brute_force(spark, shard):
    rows = conversations(shard, 150)
    assert nodes_of(spark.createDataFrame(rows, TURNS), shard) == nodes_by_brute_force(rows)


def test_copies_over_many_shards_and_pieces(spark, monkeypatch):
    """A third of the conversations are one; their ids are hashed piece by piece."""
    monkeypatch.setattr(prefix_trie, "PIECE", 4)
    rows = [(c, t, "user", "same" * (t + 1)) for c in range(0, 90) for t in range(7)]
    rows += [(c, t, "user", f"{c % 7} {t}") for c in range(90, 270) for t in range(c % 9)]
    assert nodes_of(spark.createDataFrame(rows, TURNS), 3) == nodes_by_brute_force(rows)


def test_odd_conversations(spark):
    rows = [
        (None, 0, "user", "lost"), (1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "b"),
        (1, 0, "user", "a"), (2, 5, "", "y" * 200_000), (2, None, None, ""), (101, 0, "user", "alone"),
        (100, 0, "system", "base"), (100, 1, "user", "\x00"),
    ]
    clash = ["position", "seq", "n", "_chunk", "key", "at", "told", "length", "base", "head", "own", "_part", "_id"]
    df = spark.createDataFrame(rows, TURNS).withColumns({name: F.lit(i) for i, name in enumerate(clash)})
    assert nodes_of(df, 2) == nodes_by_brute_force(rows)
    assert nodes_of(df.limit(0), 2) == []


def test_double_array_keeps_every_sequence():
    rng = np.random.default_rng(3)
    seqs = sorted({tuple(rng.integers(0, 40, rng.integers(0, 12)).tolist()) for _ in range(400)})
    starts = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    trie = prefix_trie.DoubleArray(np.array([x for s in seqs for x in s], np.int64), starts)
    nodes = {s[:d] for s in seqs for d in range(1, len(s) + 1)}
    reached = {}
    for depth, (going, there) in enumerate(trie.walk(), 1):
        reached |= {seqs[i][:depth]: int(slot) for i, slot in zip(going, there)}
    assert set(reached) == nodes
    assert len(set(reached.values())) == len(nodes) == (trie.check != prefix_trie.FREE).sum() - 1
    # Holes are filled: the arrays hardly exceed the number of nodes.
    assert max(reached.values()) < 1.2 * len(nodes) + trie.n_ids
