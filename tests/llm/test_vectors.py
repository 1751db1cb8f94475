"""Search and mining over vectors next to brute force, and odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wearlake.llm import hard_negatives, nearest

VECTORS = "vec_id long, embedding array<float>, label int"
CLASH = ["id", "v", "qa", "qb", "t", "bucket", "row", "key", "ids", "score", "anchor", "other", "place", "positives", "_place", "n"]


def clustered(seed, count, width=24):
    """Gaussian vectors of different lengths, a third of them near copies of one, some exact copies."""
    rng = np.random.default_rng(seed)
    made = rng.standard_normal((count, width)) * rng.uniform(0.2, 1, (count, 1))
    made[: count // 3] = made[0] + 0.02 * rng.standard_normal((count // 3, width))
    made[count // 3 : count // 3 + 40] = made[1]
    return made.astype(np.float32)


def table(spark, made, labels=10):
    rows = [(i, [float(x) for x in v], i * 7919 % labels) for i, v in enumerate(made)]
    return spark.createDataFrame(rows, VECTORS).withColumns({name: F.lit(i) for i, name in enumerate(CLASH)})


def odd_rows():
    nan, inf = float("nan"), float("inf")
    return [
        (0, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (1, None, 1), (2, [0.0, 0.0], 1), (3, [], 1), (4, [1.0, None], 1),
        (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [0.5, 0.5], 2), (7, [0.5, 0.5], 2), (8, [0.5, 0.5, 0.5], 2), (9, [-1.0, 3.0], 1),
        (10, [0.25], None), (100, [0.5, 0.1], 2), (11, [0.9, 0.1], 1),
    ]


# ---- nearest neighbours ---------------------------------------------------------------


def nearest_by_brute_force(rows, is_query, k):
    def product(a, b):
        return math.fsum(x * y for x, y in zip(a, b))

    sound = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            sound[i] = [float(x) for x in v]
    out = {}
    for q in filter(is_query, sound):
        found = sorted((-product(sound[q], v), i) for i, v in sound.items() if i != q)
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def listed(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        held = out.setdefault(r.query_id, [])
        held.append((r.vec_id, r.score))
        assert r.rank == len(held)
    return out


def test_recall_order_and_scores(spark):
    made = clustered(1, 3000)
    found = listed(nearest.nearest(table(spark, made), F.col("vec_id") % 20 == 0, k=20))
    exact = made.astype(float) @ made.astype(float).T
    caught = total = 0
    for q in range(0, 3000, 20):
        order = [i for i in np.lexsort((np.arange(3000), -exact[q])) if i != q][:20]
        got = [i for i, _ in found[q]]
        assert len(got) == len(set(got)) == 20 and q not in got
        assert all(abs(s - exact[q, i]) < 1e-9 for i, s in found[q])
        assert found[q] == sorted(found[q], key=lambda x: (-x[1], x[0]))
        # What is no worse than the twentieth counts, as equal scores differ in the last bits.
        caught += sum(s >= exact[q, order[-1]] - 1e-9 for _, s in found[q])
        total += 20
    assert caught / total >= 0.9


def test_small_table_is_exact(spark):
    made = clustered(2, 200)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(made)]
    want = nearest_by_brute_force(rows, lambda i: i % 10 == 0, 7)
    found = listed(nearest.nearest(table(spark, made), F.col("vec_id") % 10 == 0, k=7))
    assert {q: [round(s, 9) for _, s in v] for q, v in found.items()} == {q: [round(s, 9) for _, s in v] for q, v in want.items()}


def test_nearest_of_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, VECTORS)
    found = listed(nearest.nearest(df, F.col("vec_id") % 2 == 0, k=3))
    want = nearest_by_brute_force(rows, lambda i: i % 2 == 0, 3)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert listed(nearest.nearest(df.limit(0), F.col("vec_id") % 2 == 0)) == {}
    assert listed(nearest.nearest(df.where("vec_id = 0"), F.col("vec_id") % 2 == 0)) == {}


def test_success_estimate_holds():
    """The share of neighbours in the visited buckets is about what was asked for."""
    rng = np.random.default_rng(5)
    hashes = nearest.Hashes(32, 1.0, 6)
    asked = rng.standard_normal((300, 32))
    asked /= np.linalg.norm(asked, axis=1, keepdims=True)
    off = rng.standard_normal(asked.shape)
    off -= (off * asked).sum(1, keepdims=True) * asked
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cosine = 0.8
    near = cosine * asked + 0.6 * off
    codes = hashes.buckets(near * 0.999999)
    hit = [any(c in set(p.tolist()) for c, p in zip(code, hashes.probes(q, cosine, 0.9))) for q, code in zip(asked, codes)]
    assert 0.82 < np.mean(hit) < 0.99


# ---- hard negatives -------------------------------------------------------------------


def negatives_by_brute_force(rows, is_anchor):
    sound = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        kept = sound.get(i)
        sound[i] = min(kept, (label, v)) if kept else (label, v)
    whole = {i: (label, [math.floor(256 * float(x)) for x in v]) for i, (label, v) in sound.items()}
    out = []
    for a in filter(is_anchor, whole):
        scores = {i: sum(x * y for x, y in zip(whole[a][1], v)) for i, (_, v) in whole.items() if i != a}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if whole[i][0] == whole[a][0]][:5]:
            held = [i for i in order if whole[i][0] != whole[a][0] and 30 * scores[p] <= 100 * scores[i] <= 90 * scores[p]]
            out += [(a, p, n + 1, i, scores[p], scores[i]) for n, i in enumerate(held[:10])]
    return sorted(out)


def mined(df, is_anchor):
    found = hard_negatives.mine(df, is_anchor)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 64)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", 16)
    made = clustered(3, 700)
    rows = [(i, v.tolist(), i * 7919 % 10) for i, v in enumerate(made)]
    want = negatives_by_brute_force(rows, lambda i: i % 13 == 0)
    assert want and mined(table(spark, made), F.col("vec_id") % 13 == 0) == want


def test_negatives_of_odd_rows(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df, F.col("vec_id") % 2 == 0) == negatives_by_brute_force(rows, lambda i: i % 2 == 0)
    assert mined(df.limit(0), F.col("vec_id") % 2 == 0) == []
    assert mined(df, F.col("vec_id") < 0) == []


@pytest.mark.parametrize("size", [300, 2**26, 2**40])
def test_products_are_exact(size):
    rng = random.Random(size)
    a, b = ([[rng.randint(-size, size) for _ in range(130)] for _ in range(9)] for _ in range(2))
    primes = hard_negatives._primes(2 * 130 * size * size + 1)
    found = hard_negatives.multiplied(np.array(a, float), np.array(b, float), primes)
    assert found.tolist() == [[sum(x * y for x, y in zip(p, q)) for q in b] for p in a]
