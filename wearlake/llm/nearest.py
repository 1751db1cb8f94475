"""Nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors get one more component, so that all have the length of the longest one and the
largest inner product is the smallest distance. A table hashes a vector by the slots of a
few Gaussian projections. For a query whose wanted neighbours have cosine c, a neighbour's
projection is Gaussian around c times the query's own, so each bucket has a probability of
holding it; buckets are visited in falling order until the tables together reach
``recall``. There is no cap on probes, on buckets or on candidates: buckets are packed into
blocks of rows and of queries, and every pair of blocks of a bucket is scored exactly.

Fitted on a bounded sample of ``SAMPLE`` vectors (chosen by hash): each query's cosine (from
its best scores in the sample, which also bound from below what can be among its nearest)
and the number of projections, as many as the buckets can be visited with about
``PROBES`` probes of a query. Every vector is indexed. A small table is one bucket.

Exact copies of a vector are searched for once: of each distinct vector only the smallest
ids can be among the nearest. Defined results: vectors that are null, all zero, empty or hold
a component that is null or not finite, and rows with a null id, take no part; shorter
vectors are filled up with zeros; an id that repeats is listed once, with its best score,
and as a query counts with one of its vectors; equal scores are ordered by id; an empty
table has no rows. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlake.llm.blocks import matrix, packer, rows, usable
from wearlake.llm.common import kept

TABLES = 2
RECALL = 0.95
SAMPLE = 4096
# Components that the sample holds at most.
SAMPLE_COMPONENTS = 1 << 22
# Width of a slot, in lengths of the longest vector, and the slots to either side of zero.
WIDTH = 2.0
REACH = 4
SLOTS = 2 * REACH + 1
MOST_PROJECTIONS = 16
# Vectors of a bucket that are worth one more projection, and probes of a query in one table.
BUCKET = 256
PROBES = 24
ROW_BLOCK, QUERY_BLOCK = 1024, 256
# Queries whose best rows a task holds before it hands them on.
HELD_QUERIES = 20_000
# Multiple of the wanted neighbours by whose worst score in the sample rows are left out early.
SPARE = 4
# The share of a bucket order's probability that may be cut off before it is sorted.
LEFT_OUT = 0.002


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(x / math.sqrt(2)))


class Hashes:
    """Gaussian projections of ``tables`` tables, made from a seed."""

    def __init__(self, width: int, longest: float, projections: int, tables: int = TABLES):
        made = np.random.default_rng(12)
        self.longest, self.projections, self.tables = longest, projections, tables
        self.lines = made.standard_normal((tables, projections, width + 1))
        self.shift = made.uniform(0, WIDTH, (tables, projections))

    def _projected(self, lifted: np.ndarray) -> np.ndarray:
        """Rows x tables x projections, in lengths of the longest vector."""
        flat = lifted @ self.lines.reshape(-1, lifted.shape[1]).T
        return flat.reshape(len(lifted), self.tables, self.projections)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table."""
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1)))
        places = self._projected(np.column_stack([scaled, rest]))
        slots = np.clip(np.floor((places + self.shift) / WIDTH), -REACH, REACH).astype(np.int64) + REACH
        return slots @ (SLOTS ** np.arange(self.projections, dtype=np.int64))

    def probes(self, query: np.ndarray, cosine: float, recall: float) -> list[np.ndarray]:
        """Buckets of each table, likeliest first, until the tables together reach ``recall``."""
        scaled = query / np.linalg.norm(query)
        places = self._projected(np.append(scaled, 0.0)[None])[0]
        spread = math.sqrt(max(1 - cosine * cosine, 1e-12))
        inner = WIDTH * np.arange(-REACH + 1, REACH + 1)
        edges = (inner - self.shift[..., None] - cosine * places[..., None]) / spread
        below = _normal(edges)
        ends = np.zeros((*places.shape, 1))
        chances = np.diff(np.concatenate([ends, below, ends + 1], axis=-1))
        wanted = 1 - (1 - recall) ** (1 / self.tables)
        return [self._ordered(chance, wanted) for chance in chances]

    def _ordered(self, chances: np.ndarray, wanted: float) -> np.ndarray:
        """Codes of the likeliest combinations of slots whose chances add up to ``wanted``."""
        codes, odds = np.zeros(1, np.int64), np.ones(1)
        for j, chance in enumerate(chances):
            codes = (codes[:, None] + np.arange(SLOTS) * SLOTS**j).ravel()
            odds = np.outer(odds, chance).ravel()
            order = np.argsort(-odds, kind="stable")
            total = np.cumsum(odds[order])
            # Combinations that can no longer matter go, so that few are carried on.
            upto = np.searchsorted(total, total[-1] - LEFT_OUT / len(chances)) + 1
            codes, odds = codes[order[:upto]], odds[order[:upto]]
        return codes[: np.searchsorted(np.cumsum(odds), wanted) + 1]


def _cosines(queries: np.ndarray, sample: np.ndarray, n: int, k: int, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Each query's cosine of its k-th nearest, and a score that its nearest do not fall below."""
    scores = -np.sort(-(queries @ sample.T), axis=1)
    place = min(int(k * len(sample) / n) + 1, len(sample) - 1)
    cosine = scores[:, place] / (np.linalg.norm(queries, axis=1) * longest)
    # The sample's vectors are candidates themselves, so this many at least are no worse;
    # a few more than are wanted, as some of them are not visited.
    spare = SPARE * (k + 1)
    bound = scores[:, spare] if spare < len(sample) else np.full(len(queries), -np.inf)
    return np.clip(cosine, -1, 1), bound - 1e-9 * np.abs(bound)


def _fitted(sample: np.ndarray, n: int, longest: float, k: int, recall: float, tables: int) -> Hashes:
    """Hashes with as many projections as the sample's buckets can be visited with."""
    asked = sample[:: max(1, len(sample) // 64)][:64]
    cosines, _ = _cosines(asked, sample, n, k, longest)
    # Without a projection there is one bucket and the search is exact.
    best = Hashes(sample.shape[1], longest, 0, 1)
    if n <= max(BUCKET, SPARE * (k + 1)):
        return best
    for projections in range(1, MOST_PROJECTIONS + 1):
        made = Hashes(sample.shape[1], longest, projections, tables)
        filled = len(np.unique(made.buckets(sample)[:, 0]))
        visits = np.mean([len(p) for q, c in zip(asked, cosines) for p in made.probes(q, c, recall)])
        if visits > PROBES or n < BUCKET * filled:
            break
        best = made
    return best


def _packed(entries: DataFrame, side: str, size: int) -> DataFrame:
    """Entries of a bucket in blocks; a bucket of many is dealt to many tasks by its rows' keys."""
    ordered = entries.repartitionByRange("t", "bucket", "key").sortWithinPartitions("t", "bucket")
    kind = entries.schema["row"].dataType.simpleString()
    packed = ordered.select("t", "bucket", "row").mapInArrow(packer(["t", "bucket"], size), f"t int, bucket long, rows array<{kind}>")
    return packed.withColumnRenamed("rows", side)


def _scorer(width: int, k: int):
    """Function for tasks: pairs of blocks to the best rows that a task finds for each query in each table."""
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())

    def told(best: dict) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], [], []]
        for (_, qa, qb), (scores, ids) in best.items():
            for column, values in zip(columns, ([qa] * len(ids), [qb] * len(ids), ids.tolist(), scores.tolist())):
                column += values
        arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=["qa", "qb", "vec_id", "score"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
        for pair in rows(batches):
            points, queries = pair["points"].values, pair["queries"].values
            scores = matrix(queries.field("v"), width) @ matrix(points.field("v"), width).T
            ids = points.field("ids")
            count = ids.value_lengths().to_numpy(zero_copy_only=False)
            flat, ends = ids.flatten().to_numpy(zero_copy_only=False), np.cumsum(count)
            least = queries.field("least").to_numpy(zero_copy_only=False)
            keys = zip(*(queries.field(x).to_pylist() for x in ("qa", "qb")))
            for i, key in enumerate(keys):
                key = (pair["t"].as_py(), *key)
                held = best.get(key)
                # Of a table a row is in one bucket, so none is met twice.
                enough = least[i] if held is None or len(held[0]) < k else max(least[i], held[0][-1])
                at = np.flatnonzero(scores[i] >= enough)
                if not len(at):
                    continue
                # A row stands for all ids of its vector.
                found = np.concatenate([flat[ends[j] - count[j] : ends[j]] for j in at])
                worth = np.repeat(scores[i, at], count[at])
                if held is not None:
                    found, worth = np.concatenate([held[1], found]), np.concatenate([held[0], worth])
                order = np.lexsort((found, -worth))[:k]
                best[key] = worth[order], found[order]
            if len(best) > HELD_QUERIES:
                yield from told(best)
                best = {}
        if best:
            yield from told(best)

    return run


def _first_rows(rows_: DataFrame, keys: list[str], order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each key; most of a large group goes before the shuffle."""
    ranked = rows_.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_place") <= n).drop("_place")


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, recall: float = RECALL, tables: int = TABLES
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of each query's ``k`` nearest.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``.
    """
    spark: SparkSession = vectors.sparkSession
    vector = F.col("embedding")
    sound = vectors.where(
        F.col("vec_id").isNotNull() & usable(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )
    # Two hashes tell vectors apart.
    keyed = sound.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        vector.cast("array<double>").alias("v"),
        F.xxhash64(vector).alias("qa"),
        F.xxhash64(F.lit("second"), vector).alias("qb"),
    )
    once = keyed.groupBy("vec_id", "qa", "qb").agg(F.any_value("v").alias("v"))
    distinct = kept(
        _first_rows(once, ["qa", "qb"], ["vec_id"], k + 1)
        .groupBy("qa", "qb")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.any_value("v").alias("v"))
    )
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    facts = distinct.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.max(length).alias("longest")).first()
    if not facts.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width, n, longest = facts.width, facts.n, facts.longest * (1 + 1e-9)
    rows_wanted = max(min(SAMPLE, SAMPLE_COMPONENTS // width), 1)
    drawn = distinct.select("qa", "v").orderBy("qa").limit(rows_wanted).toArrow()["v"].combine_chunks()
    sample = matrix(drawn, width)
    hashes = _fitted(sample, n, longest, k, recall, tables)

    @F.pandas_udf("array<long>")
    def buckets(found: pd.Series) -> pd.Series:
        return pd.Series(list(hashes.buckets(matrix(pa.array(found, pa.list_(pa.float64())), width))))

    @F.pandas_udf("struct<probes:array<array<long>>,least:double>")
    def probed(found: pd.Series) -> pd.DataFrame:
        asked = matrix(pa.array(found, pa.list_(pa.float64())), width)
        cosines, least = _cosines(asked, sample, n, k, longest)
        listed = [[list(p) for p in hashes.probes(q, c, recall)] for q, c in zip(asked, cosines)]
        return pd.DataFrame({"probes": listed, "least": least})

    points = distinct.select("qa", F.posexplode(buckets("v")).alias("t", "bucket"), F.struct("ids", "v").alias("row"))
    index = _packed(points.withColumnRenamed("qa", "key"), "points", ROW_BLOCK)

    queries = kept(
        keyed.where(F.coalesce(is_query, F.lit(False)))
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min_by(F.struct("qa", "qb", "v"), F.struct("qa", "qb")).alias("q"))
        .select("query_id", "q.*")
    )
    asked = kept(queries.groupBy("qa", "qb").agg(F.any_value("v").alias("v")).withColumn("p", probed("v")))
    visits = asked.select(
        "qa", F.struct("qa", "qb", "v", F.col("p.least").alias("least")).alias("row"), F.posexplode("p.probes").alias("t", "all")
    ).select(F.col("qa").alias("key"), "row", "t", F.explode("all").alias("bucket"))
    asking = _packed(visits, "queries", QUERY_BLOCK)

    pairs = index.join(asking.hint("merge"), ["t", "bucket"]).select("t", "points", "queries")
    scored = pairs.mapInArrow(_scorer(width, k + 1), "qa long, qb long, vec_id long, score double")
    merged = scored.groupBy("qa", "qb", "vec_id").agg(F.max("score").alias("score"))
    best = (
        _first_rows(merged, ["qa", "qb"], [F.desc("score"), "vec_id"], k + 1)
        .groupBy("qa", "qb")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("found"))
    )
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    listed = queries.select("query_id", "qa", "qb").join(best, ["qa", "qb"])
    return listed.select("query_id", F.posexplode(others).alias("place", "r")).select(
        "query_id", (F.col("place") + 1).alias("rank"), "r.vec_id", (-F.col("r.far")).alias("score")
    )
