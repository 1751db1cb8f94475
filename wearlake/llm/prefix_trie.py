"""Tries of conversation prefixes as double arrays.

Conversations are sequences of turns; equal sequences are counted and go on as one. The
distinct sequences are sorted over the whole table, so that a node, the set of sequences
with one prefix, is a run of neighbours. Shards are blocks of the sorted order: a task numbers
its turns densely, packs the trie into BASE and CHECK arrays and walks all its sequences
through them. A node that lies in one shard is finished there. The others lie on two paths
only, the prefixes that the shard's first sequence shares with the shard before and its last
with the one after; their counts are merged over all shards.

Prefixes are equal if the turns' role and text are, by 120 bits of their SHA-256. Defined
results: rows with a null conversation take no part; null roles and texts are empty; turns
without a number come first, turns of one number in the order of that hash, repeated rows are
turns of their own; an empty table has no nodes. A conversation is one row of its turns'
hashes (24 bytes a turn), and is not split. Other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.blocks import packer
from wearlake.llm.common import kept
from wearlake.operators.keyed import Chunked, positions

# Sequences of a shard, and conversations whose ids are hashed in one piece.
SHARD = 2048
PIECE = 4096
FREE, ROOT = -1, 0
SHARD_SCHEMA = (
    "shard long, key binary, parent_key binary, right boolean, depth long, conv_id long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, length long, end_conv long"
)


class DoubleArray:
    """A trie over sequences of dense ids: the child by ``x`` of slot ``s`` is ``base[s] + x``, if its ``check`` is ``s``."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        """``ids`` of all sequences one after the other; sequence i is ``starts[i]`` to ``starts[i + 1]``."""
        self.ids, self.starts, self.lengths = ids, starts[:-1], np.diff(starts)
        self.n_ids = int(ids.max()) + 1 if len(ids) else 1
        self.base = np.zeros(self.n_ids + 1, np.int64)
        self.check = np.full(self.n_ids + 1, FREE, np.int64)
        self.check[ROOT] = ROOT
        at = np.zeros(len(self.lengths), np.int64)
        for depth in range(int(self.lengths.max(initial=0))):
            going = np.flatnonzero(self.lengths > depth)
            moves = ids[self.starts[going] + depth]
            parents, children = np.divmod(np.unique(at[going] * self.n_ids + moves), self.n_ids)
            self._place(parents, children)
            at[going] = self.base[at[going]] + moves

    def _room(self, more: int) -> np.ndarray:
        """Free slots, with ``more`` new ones and a margin of all ids behind."""
        used = int(np.flatnonzero(self.check != FREE)[-1]) + 1
        size = used + more + self.n_ids
        if size > len(self.check):
            size = max(size, 2 * len(self.check))
            self.check = np.concatenate([self.check, np.full(size - len(self.check), FREE)])
            self.base = np.concatenate([self.base, np.zeros(size - len(self.base), np.int64)])
        return np.flatnonzero(self.check[: used + more] == FREE)

    def _place(self, parents: np.ndarray, children: np.ndarray) -> None:
        """Slots for the children of one level; both arrays are sorted by parent, then child."""
        first = np.flatnonzero(np.diff(parents, prepend=-1))
        count = np.diff(np.append(first, len(parents)))
        for i in np.flatnonzero(count > 1):
            wanted = children[first[i] : first[i] + count[i]]
            fits = self._room(1) - wanted[0]
            for child in wanted[1:]:
                fits = fits[self.check[fits + child] == FREE]
            parent = parents[first[i]]
            self.base[parent] = fits[0]
            self.check[fits[0] + wanted] = parent
        # A single child fits anywhere, so these fill the holes.
        single = first[count == 1]
        slots = self._room(len(single))[: len(single)]
        self.base[parents[single]] = slots - children[single]
        self.check[slots] = parents[single]

    def walk(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each depth from 1 the sequences that reach it and the slots they are in."""
        at = np.zeros(len(self.lengths), np.int64)
        for depth in range(int(self.lengths.max(initial=0))):
            going = np.flatnonzero(self.lengths > depth)
            there = self.base[at[going]] + self.ids[self.starts[going] + depth]
            if (self.check[there] != at[going]).any():
                raise AssertionError("a sequence is not in its trie")
            at[going] = there
            yield going, there


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Turns that two sequences share from the start; a turn is two numbers."""
    n = min(len(a), len(b)) // 2
    same = (a[: 2 * n].reshape(n, 2) == b[: 2 * n].reshape(n, 2)).all(1)
    return n if same.all() else int(np.argmin(same))


def _prefix_keys(seq: np.ndarray, upto: int) -> list[bytes]:
    """A hash of each prefix of 0 to ``upto`` turns."""
    state = hashlib.blake2b(digest_size=16)
    keys = [state.digest()]
    raw = seq.astype("<i8").tobytes()
    for depth in range(upto):
        state.update(raw[16 * depth : 16 * depth + 16])
        keys.append(state.digest())
    return keys


def shard_nodes(size: int):
    """Function for groups: the sorted sequences of a shard, with a neighbour to either side, to its nodes."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        shard = int(group["_chunk"].iloc[0])
        group = group.sort_values("position")
        place = group["position"].to_numpy() - shard * size
        own = group[(place >= 0) & (place < size)]
        names = [part.split()[0] for part in SHARD_SCHEMA.split(",")]
        if not len(own):
            return pd.DataFrame({name: [] for name in names})
        seqs = [np.asarray(s, np.int64) for s in own["seq"]]
        before = [np.asarray(s, np.int64) for s in group["seq"][place < 0]]
        after = [np.asarray(s, np.int64) for s in group["seq"][place >= size]]
        left = _shared(before[-1], seqs[0]) if before else 0
        right = _shared(seqs[-1], after[0]) if after else 0

        flat = np.concatenate([*seqs, np.zeros(0, np.int64)]).reshape(-1, 2)
        # Dense ids of the shard's turns.
        _, ids = np.unique(np.ascontiguousarray(flat).view("V16").ravel(), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum([len(s) // 2 for s in seqs])])
        trie = DoubleArray(ids.astype(np.int64), starts)
        texts = np.concatenate([*(np.asarray(x, np.int64) for x in own["lengths"]), np.zeros(0, np.int64)])
        convs, copies = own["conv_id"].to_numpy(), own["n"].to_numpy()

        slots = len(trie.check)
        n, depth, length, end = (np.zeros(slots, np.int64) for _ in range(4))
        owner, ended = np.full(slots, np.iinfo(np.int64).max), np.zeros(slots, bool)
        n[ROOT], owner[ROOT] = copies.sum(), convs.min()
        paths = {0: [ROOT], len(seqs) - 1: [ROOT]}
        last = np.zeros(len(seqs), np.int64)
        levels = [np.array([ROOT])]
        for d, (going, there) in enumerate(trie.walk(), 1):
            np.add.at(n, there, copies[going])
            np.minimum.at(owner, there, convs[going])
            depth[there], length[there] = d, texts[starts[going] + d - 1]
            last[going] = there
            levels.append(np.unique(there))
            for i in paths:
                if trie.lengths[i] >= d:
                    paths[i].append(int(there[np.searchsorted(going, i)]))
        end[last], ended[last] = convs, True

        key: dict[int, bytes] = {}
        for i, upto in ((0, left), (len(seqs) - 1, right)):
            key.update(zip(paths[i][: upto + 1], _prefix_keys(seqs[i], upto)))
        rightmost = set(paths[len(seqs) - 1][: right + 1])
        crossing = np.zeros(slots, bool)
        crossing[list(key)] = True

        used = np.concatenate(levels)
        parent = trie.check
        nodes = used[used != ROOT]
        children = np.bincount(parent[nodes], minlength=slots)
        inner = np.bincount(parent[nodes[~crossing[nodes]]], minlength=slots)
        leaves = ((children == 0) & (n > 0)).astype(np.int64)
        if after and right == trie.lengths[-1]:
            leaves[last[-1]] = 0
        saved = np.where(crossing, 0, (n - 1) * length)
        for level in reversed(levels[1:]):
            np.add.at(leaves, parent[level], leaves[level])
            np.add.at(saved, parent[level], saved[level])

        over = [int(parent[s]) for s in used]
        known = [s != ROOT and s not in key for s in used]
        return pd.DataFrame(
            {
                "shard": shard,
                "key": [key.get(int(s)) for s in used],
                "parent_key": [None if s == ROOT else key.get(p) for s, p in zip(used, over)],
                "right": [int(s) in rightmost for s in used],
                "depth": depth[used],
                "conv_id": owner[used],
                "parent_conv_id": pd.array([int(owner[p]) if k and p not in key else None for p, k in zip(over, known)], "Int64"),
                "n_convs": n[used],
                "n_children": np.where(crossing[used], inner[used], children[used]),
                "n_leaves": leaves[used],
                "saved_tokens": saved[used],
                "length": length[used],
                "end_conv": pd.array([int(e) if x else None for e, x in zip(end[used], ended[used])], "Int64"),
            }
        )[names]

    return run


def _merged(nodes: DataFrame) -> DataFrame:
    """The nodes of all shards; those that several shards share are put together."""
    parts = nodes.where("key IS NOT NULL")
    shared = kept(
        parts.groupBy("key", "parent_key", "depth", "length").agg(
            F.min("conv_id").alias("conv_id"),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
            F.max("end_conv").alias("end_conv"),
            F.min("shard").alias("first"),
        )
    )
    # What a shared node saves counts for the nodes above it once, in the first shard it is in,
    # where it lies on the path to the next shard.
    own = F.when(F.col("first") == F.col("shard"), (F.col("n_convs") - 1) * F.col("length")).otherwise(0)
    down = Window.partitionBy("shard").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = (
        parts.where("right")
        .select("shard", "key")
        .join(shared.select("key", "depth", "length", "n_convs", "first"), "key")
        .select("key", F.sum(own).over(down).alias("more"))
        .groupBy("key")
        .agg(F.sum("more").alias("more"))
    )
    kids = shared.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("kids"))
    owners = shared.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("owner"))
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_conv"]
    whole = (
        shared.join(below, "key", "left")
        .join(kids, "key", "left")
        .join(owners, "parent_key", "left")
        .withColumns(
            {
                "n_children": F.col("n_children") + F.coalesce("kids", F.lit(0)),
                "saved_tokens": F.col("saved_tokens") + F.coalesce("more", F.lit(0)),
                "parent_conv_id": F.col("owner"),
            }
        )
    )
    single = nodes.where("key IS NULL").join(owners, "parent_key", "left")
    single = single.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "owner"))
    return whole.select(*out).unionByName(single.select(*out))


def _id_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ids, sorted by sequence and id, to the SHA-256 of all ids of each sequence."""
    key, conv, state = None, None, None

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"end_conv": pa.array([conv], pa.int64()), "ends_sha256": [state.hexdigest()]})

    for batch in batches:
        for sa, sb, ids in zip(*(batch[name].to_pylist() for name in ("sa", "sb", "ids"))):
            text = ",".join(map(str, ids)).encode()
            if key == (sa, sb):
                state.update(b"," + text)
                continue
            if key is not None:
                yield told()
            key, conv, state = (sa, sb), ids[0], hashlib.sha256(text)
    if key is not None:
        yield told()


def _ends(seqs: DataFrame) -> DataFrame:
    """``end_conv`` (the smallest conversation) and ``ends_sha256`` of each distinct sequence."""
    ordered = seqs.select("sa", "sb", F.col("conv_id").alias("row")).repartitionByRange("sa", "sb", "row")
    pieces = ordered.sortWithinPartitions("sa", "sb", "row").mapInArrow(
        packer(["sa", "sb"], PIECE), "sa long, sb long, rows array<long>"
    )
    # A large group comes to its task in pieces, and is hashed as they pass.
    dealt = pieces.withColumnRenamed("rows", "ids").repartition("sa", "sb")
    return dealt.sortWithinPartitions("sa", "sb", F.col("ids")[0]).mapInArrow(
        _id_digests, "end_conv long, ends_sha256 string"
    )


def trie(seqs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie over ``seqs``.

    ``seqs`` has ``conv_id`` (unique), ``seq`` (two numbers for each turn, one after the
    other) and ``lengths`` (code points of each turn). A node has ``conv_id`` (its smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``.
    """
    keyed = seqs.select(
        "conv_id", "seq", "lengths", F.xxhash64("seq").alias("sa"), F.xxhash64(F.lit("second"), "seq").alias("sb")
    )
    distinct = keyed.groupBy("sa", "sb").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"),
        F.any_value("seq").alias("seq"), F.any_value("lengths").alias("lengths"),
    )
    placed = positions(distinct.drop("sa", "sb"), [], "seq")
    shards = Chunked(placed, [], "position", 1, 1, shard).rows
    nodes = kept(shards.groupBy("_chunk").applyInPandas(shard_nodes(shard), SHARD_SCHEMA))
    nothing = F.sha2(F.lit("").cast("binary"), 256)
    merged = _merged(nodes).join(_ends(keyed), "end_conv", "left")
    return merged.withColumn("ends_sha256", F.coalesce("ends_sha256", nothing)).drop("end_conv")


def turn_hashes(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``position`` in the conversation, ``ka`` and ``kb`` (a turn's hash) and ``length``."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    hashed = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", told.alias("told"), F.length(text).cast("long").alias("length")
    )
    half = [F.conv(F.substring("told", at, 15), 16, 10).cast("long") for at in (1, 16)]
    keyed = hashed.select("conv_id", half[0].alias("ka"), half[1].alias("kb"), "length", F.struct("turn", "told").alias("at"))
    return positions(keyed, ["conv_id"], "at").drop("at")


def rebuilt(conversations: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """Each conversation with the first turns of its block's first one in place of its own.

    The number of turns is the CRC-32 of the id modulo ``heads``; a block's first
    conversation is the id less its remainder by ``block``.
    """
    turns = kept(turn_hashes(conversations))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("position", "ka", "kb", "length")))
    first = turns.where(F.col("position") < heads - 1).groupBy(F.col("conv_id").alias("base")).agg(listed.alias("head"))
    own = turns.where(F.col("position") >= taken).groupBy("conv_id").agg(listed.alias("own"))
    convs = turns.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.col("conv_id") % block)
    none = F.array().cast(own.schema["own"].dataType)
    whole = F.concat(F.slice(F.coalesce("head", none), F.lit(1), taken), F.coalesce("own", none))
    joined = convs.join(first, "base", "left").join(own, "conv_id", "left").select("conv_id", whole.alias("t"))
    return joined.select(
        "conv_id",
        F.flatten(F.transform("t", lambda x: F.array(x["ka"], x["kb"]))).alias("seq"),
        F.transform("t", lambda x: x["length"]).alias("lengths"),
    )


def prefix_nodes(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """The trie over the rebuilt conversations."""
    return trie(kept(rebuilt(conversations)), shard)
