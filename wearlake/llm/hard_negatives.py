"""Hard negatives by exact integer products in a residue number system.

Components become integers. For several primes below 1024 the matrices of their residues
are multiplied in float32, where sums of 64 products of residues are exact; the signed
scores are put together again by Chinese remaindering. There are as many primes as the
largest possible score needs (Cauchy-Schwarz over the longest row).

Anchors meet all rows in blocks: both sides are dealt to blocks of bounded size by a hash of
their id, and a cell of the grid is one product. Cells keep the first few rows for each
anchor, in a first pass of the same label (positives), in a second one of the other labels
within the window of each positive's score; a window then ranks what the cells kept.

Defined results: rows with a null id, label, vector or component, or one that is not finite,
take no part. Of rows that repeat an id the one with the smallest label, then vector, counts.
Shorter vectors are filled up with zeros. Equal scores are ordered by id. An anchor without
positives, or a positive without negatives, has no rows, nor has an empty table. A score
beyond a long stops the job if it would be returned. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.llm.blocks import matrix, rows, usable
from wearlake.llm.common import kept

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these hundredths of its positive's.
LOWEST, HIGHEST = 30, 90

# Rows of a block, on average; a cell holds scores for all pairs of two blocks.
ROW_BLOCK, ANCHOR_BLOCK = 2048, 1024
# So many products of two residues, each up to 511, add up exactly in float32.
EXACT_TERMS = 64
LARGEST_PRIME = 1021


def _primes(product: int) -> list[int]:
    """Largest primes up to ``LARGEST_PRIME`` whose product exceeds ``product``."""
    found: list[int] = []
    total = 1
    for n in range(LARGEST_PRIME, 2, -1):
        if all(n % k for k in range(2, int(n**0.5) + 1)):
            found.append(n)
            total *= n
            if total > product:
                return found
    raise ValueError("components are too large for the residue number system")


def residues(whole: np.ndarray, prime: int) -> np.ndarray:
    """Residues between minus and plus half of ``prime``, in float32."""
    left = np.fmod(whole, prime)
    half = prime // 2
    left = np.where(left > half, left - prime, np.where(left < -half, left + prime, left))
    return left.astype(np.float32)


def multiplied(a: np.ndarray, b: np.ndarray, primes: list[int]) -> np.ndarray:
    """Exact ``a @ b.T`` of whole numbers: one product for each prime, then reconstruction.

    Longs where every value fits, Python numbers otherwise.
    """
    digits: list[np.ndarray] = []
    for i, prime in enumerate(primes):
        ra, rb = residues(a, prime), residues(b, prime)
        total = np.zeros((len(a), len(b)), np.int64)
        for at in range(0, a.shape[1], EXACT_TERMS):
            part = ra[:, at : at + EXACT_TERMS] @ rb[:, at : at + EXACT_TERMS].T
            total += part.astype(np.int64)
        digit = np.mod(total, prime)
        # Mixed radix: what the digits before stand for is taken off and divided out.
        for earlier, before in zip(digits, primes[:i]):
            digit = np.mod((digit - earlier) * pow(before, -1, prime), prime)
        digits.append(digit)
    modulus = 1
    for prime in primes:
        modulus *= prime
    kind = np.int64 if modulus < 2**62 else object
    value, radix = np.zeros((len(a), len(b)), kind), 1
    for digit, prime in zip(digits, primes):
        value = value + digit.astype(kind) * radix
        radix *= prime
    return np.where(value > modulus // 2, value - modulus, value)


def _block(cell: dict, side: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.StructArray]:
    """Ids, labels and whole components of one side of a cell, in the order of ids."""
    held = cell[side].values
    ids = held.field("id").to_numpy(zero_copy_only=False)
    order = np.argsort(ids, kind="stable")
    held = held.take(pa.array(order))
    labels = held.field("label").to_numpy(zero_copy_only=False)
    return ids[order], labels, np.floor(SCALE * matrix(held.field("v"), width)), held


def _positives(width: int, primes: list[int], wanted: int):
    """Function for tasks: cells to the first rows of each anchor's own label."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in rows(batches):
            anchors, labels, a, _ = _block(cell, "anchors", width)
            ids, others, b, _ = _block(cell, "others", width)
            scores = multiplied(a, b, primes)
            out: list[tuple] = []
            for i, anchor in enumerate(anchors):
                at = np.flatnonzero((others == labels[i]) & (ids != anchor))
                first = at[np.argsort(-scores[i, at], kind="stable")[:wanted]]
                out += [(int(anchor), int(ids[j]), int(scores[i, j])) for j in first]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], names=["anchor_id", "positive_id", "positive_score"]
                )

    return run


def _negatives(width: int, primes: list[int], wanted: int, lowest: int, highest: int):
    """Function for tasks: cells to the first rows in the window of each positive."""
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in rows(batches):
            anchors, labels, a, held = _block(cell, "anchors", width)
            ids, others, b, _ = _block(cell, "others", width)
            scores = multiplied(a, b, primes)
            out: list[tuple] = []
            for i, positives in enumerate(held.field("positives")):
                at = np.flatnonzero(others != labels[i])
                at = at[np.argsort(-scores[i, at], kind="stable")]
                falling = -scores[i, at]
                for positive in positives.as_py():
                    score = positive["positive_score"]
                    top, floor = highest * score // 100, -(-lowest * score // 100)
                    start = np.searchsorted(falling, -top, "left")
                    stop = np.searchsorted(falling, -floor, "right")
                    out += [
                        (int(anchors[i]), positive["positive_id"], int(ids[j]), score, int(scores[i, j]))
                        for j in at[start : min(stop, start + wanted)]
                    ]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    return run


def _blocked(side: DataFrame, name: str, n: int, opposite: str, copies: int) -> DataFrame:
    """Rows dealt to ``n`` blocks by a hash of their id, each block copied for every opposite one."""
    held = side.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias(name)).agg(
        F.collect_list(F.struct(*side.columns)).alias(f"{name}s")
    )
    return held.withColumn(opposite, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _cells(anchors: DataFrame, others: DataFrame, n_anchors: int, n_others: int) -> DataFrame:
    """One row for each pair of a block of anchors and a block of rows."""
    a, b = -(-n_anchors // ANCHOR_BLOCK), -(-n_others // ROW_BLOCK)
    left = _blocked(anchors, "anchor", a, "other", b)
    right = _blocked(others, "other", b, "anchor", a)
    return left.join(right.hint("merge"), ["anchor", "other"]).select("anchors", "others")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """Hard negatives of all anchors; ``vectors`` has ``vec_id``, ``embedding`` and ``label``.

    ``is_anchor`` is a condition on ``vec_id``. A negative has another label and a score
    between ``lowest`` and ``highest`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    sound = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    chosen = sound.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.struct(F.col("label").cast("long").alias("label"), F.col("embedding").alias("v"))).alias("best")
    )
    marked = kept(chosen.select("vec_id", "best.*", F.coalesce(is_anchor, F.lit(False)).alias("anchor")))
    size = F.transform("v", lambda x: F.abs(x.cast("double")) * SCALE + 1)
    length = F.aggregate(size, F.lit(0.0), lambda total, x: total + x * x)
    facts = marked.agg(
        F.count("*").alias("n"), F.count_if("anchor").alias("anchors"), F.max(F.size("v")).alias("width"), F.max(length).alias("length")
    ).first()
    pairs = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not facts.anchors:
        return pairs
    # No score is larger than the longest row's product with itself; rounding of the sum is allowed for.
    primes = _primes(2 * int(facts.length * 1.000001 + 1) + 1)
    width = max(facts.width, 1)
    others = marked.select(F.col("vec_id").alias("id"), "label", "v")
    anchors = marked.where("anchor").select(F.col("vec_id").alias("id"), "label", "v")

    first = _cells(anchors, others, facts.anchors, facts.n).mapInArrow(
        _positives(width, primes, positives), "anchor_id long, positive_id long, positive_score long"
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    best = first.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
    listed = best.groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")
    )
    asked = kept(anchors.join(listed, F.col("id") == F.col("anchor_id")).select("id", "label", "v", "positives"))
    second = _cells(asked, others, facts.anchors, facts.n).mapInArrow(
        _negatives(width, primes, negatives, lowest, highest),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
    )
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = second.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select(*pairs.columns)
