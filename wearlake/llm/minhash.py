"""Near-duplicate documents by MinHash, confirmed on whole shingle sets.

1. Each document gives the minima of many universal hashes over its shingles; rows of
   minima are banded into buckets. The number of bands follows from the threshold, so
   that a pair at the threshold is missed with a probability below ``MISS``.
2. Documents with equal sets are one class; only its least id goes on.
3. In every bucket all documents are compared with one centre (the least id), not with
   one another. Documents of a bucket that are still in different components are then
   compared with further centres, and at last with each other, so no link between
   components is lost and groups of copies give no pairs.
4. A pair is dropped early only if sizes rule it out or the minima agree far too seldom
   (``SIGMAS`` standard deviations); all others are compared on their whole sets.
5. Components of the confirmed links by alternating large-star and small-star.

Defined results: null and empty texts and texts of blanks have an empty set and are
linked with nothing. A row with a null id is kept and linked with nothing. Rows that
repeat an id are one document for linking. Other columns of the input do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearlake.llm.common import fresh, kept, small_batches
from wearlake.llm.components import components
from wearlake.llm.shingles import Shingler, split_mix

ROWS_PER_BAND = 5
MISS = 1e-5
SIGMAS = 6
# Further centres are tried, in turn, while comparing across components would make more
# pairs than this for each member of a bucket.
PAIRS_PER_MEMBER = 4
CENTRES = ("max_by(doc_id, component)",)
# Shingles whose frequency is known when rare ones are looked for, and those a task counts
# at a time. They set the order of looking, not what is found.
FREQUENT = 100_000
HELD_SHINGLES = 4_000_000

FEATURES = "doc_id long, n_shingles long, low long, high long, buckets array<long>, sketch binary"


def bands_for(percent: int) -> int:
    """Bands needed at a similarity of ``percent`` hundredths."""
    return math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** ROWS_PER_BAND)))


class Minima:
    """Minima of universal hashes ``a * x + b`` over a set, banded."""

    def __init__(self, bands: int):
        self.bands = bands
        self.a = split_mix(bands * ROWS_PER_BAND, seed=11) | np.uint64(1)
        self.b = split_mix(bands * ROWS_PER_BAND, seed=13)
        self.rows = split_mix(ROWS_PER_BAND, seed=17) | np.uint64(1)
        self.band = split_mix(bands, seed=19)

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, bytes]:
        least = np.full(len(self.a), np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, len(shingles), 1024):
            part = shingles[start : start + 1024]
            hashed = part[None, :] * self.a[:, None]
            hashed += self.b[:, None]
            np.minimum(least, hashed.min(axis=1), out=least)
        grid = least.reshape(self.bands, ROWS_PER_BAND)
        buckets = (grid * self.rows).sum(axis=1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        buckets = (buckets ^ (buckets >> np.uint64(31))) + self.band
        sketch = ((least * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(56)).astype(np.uint8)
        return buckets.view(np.int64), sketch.tobytes()


def features(docs: DataFrame, percent: int, size: int = 5) -> DataFrame:
    """Set size, two hashes of the whole set, buckets and a byte of each minimum."""
    small_batches(docs.sparkSession)
    bands = bands_for(percent)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, minima = Shingler(size), Minima(bands)
        empty = np.empty(0, np.int64)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                found = shingler(text)
                buckets, sketch = minima(found) if len(found) else (empty, b"")
                high = found * np.uint64(0x9FB21C651E98DF25)
                high ^= high >> np.uint64(29)
                low = found.sum(dtype=np.uint64).astype(np.int64)
                total = (high * found).sum(dtype=np.uint64).astype(np.int64)
                rows.append((None if pd.isna(doc_id) else int(doc_id), len(found), int(low), int(total), buckets, sketch))
            yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "low", "high", "buckets", "sketch"]).astype(
                {"doc_id": "Int64"}
            )

    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInPandas(made, FEATURES)


@F.pandas_udf(T.IntegerType())
def _agreeing(left: pd.Series, right: pd.Series) -> pd.Series:
    """Bytes at which two sketches agree."""
    return pd.Series(
        [int((np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)).sum()) for a, b in zip(left, right)],
        dtype="int32",
    )


def _likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and minima do not rule out."""
    minima = bands_for(percent) * ROWS_PER_BAND
    share = percent / 100
    least = minima * share - SIGMAS * math.sqrt(minima * share * (1 - share))
    left = sketches.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sketch").alias("sa"))
    right = sketches.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sketch").alias("sb"))
    sized = pairs.join(left, "a").join(right, "b").where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    return sized.where(_agreeing("sa", "sb") >= least).select("a", "b")


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs whose whole sets are similar enough."""

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(size)
        lru = lru_cache(maxsize=64)(lambda doc_id, text: shingler(text))
        for batch in batches:
            good = []
            for a, b, ta, tb in zip(batch["a"], batch["b"], batch["ta"], batch["tb"]):
                left, right = lru(a, ta), lru(b, tb)
                both = len(np.intersect1d(left, right, assume_unique=True))
                good.append(100 * both >= percent * (len(left) + len(right) - both))
            yield batch.loc[good, ["a", "b"]]

    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    # Merge joins at every size: texts move once for each side, however few pairs there are.
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    return both.select("a", "b", "ta", "tb").mapInPandas(similar, "a long, b long")


class _Search:
    """Links of one search, gathered round by round."""

    def __init__(self, docs: DataFrame, classes: DataFrame, percent: int, size: int):
        self.percent, self.size = percent, size
        self.sketches = classes.select("doc_id", "n_shingles", "sketch")
        # Most buckets hold one document; those are of no more use.
        every = classes.select("doc_id", F.explode("buckets").alias("bucket"))
        shared = every.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
        self.members = kept(every.join(kept(shared), "bucket", "left_semi"))
        texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        self.texts = kept(texts.join(self.members.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"))
        self.links: DataFrame | None = None
        self.asked: DataFrame | None = None

    def check(self, pairs: DataFrame) -> int:
        """Confirm those of the pairs not asked before; keep and count their links."""
        new = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.asked is not None:
            new = new.join(self.asked, ["a", "b"], "left_anti")
        new = kept(_likely(new, self.sketches, self.percent).distinct())
        found = kept(_confirmed(new, self.texts, self.percent, self.size))
        self.asked = new if self.asked is None else self.asked.unionByName(new)
        self.links = found if self.links is None else self.links.unionByName(found)
        return found.count()

    def unsettled(self) -> DataFrame:
        """Members of buckets that hold several components, with their component."""
        parts = components(self.links)
        placed = kept(
            self.members.join(parts, F.col("doc_id") == F.col("node"), "left").select(
                "bucket", "doc_id", F.coalesce("component", "doc_id").alias("component")
            )
        )
        split = kept(
            placed.groupBy("bucket")
            .agg(F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low <> high")
            .select("bucket")
        )
        return kept(placed.join(split, "bucket", "left_semi"))


def _around_centre(members: DataFrame, centre: str) -> DataFrame:
    """Each member paired with the centre of its bucket."""
    counted = members.groupBy("bucket").agg(F.expr(centre).alias("b"), F.count("*").alias("n"))
    # Written, so that Spark can split the members of a busy bucket in the join.
    centres = kept(counted.where("n > 1").select("bucket", "b"))
    return members.join(centres, "bucket").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b")


def _pairs_across(members: DataFrame) -> tuple[int, int]:
    """Pairs of bucket members in different components, and the number of members."""
    parts = members.groupBy("bucket", "component").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    buckets = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"))
    found = buckets.agg(
        F.sum((F.col("n") * F.col("n") - F.col("within")) / 2).alias("pairs"), F.sum("n").alias("members")
    ).first()
    return int(found["pairs"] or 0), int(found["members"] or 0)


def _frequent(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, in order of their hash, and their counts.

    They only order shingles, so counts below two in a task may be left out.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, held = Shingler(size), []

        def told() -> pd.DataFrame:
            found, n = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
            held.clear()
            return pd.DataFrame({"shingle": found[n > 1].view(np.int64), "n": n[n > 1]})

        total = 0
        for batch in batches:
            held += [shingler(text) for text in batch["text"]]
            total += sum(map(len, held[-len(batch) :]))
            if total > HELD_SHINGLES:
                yield told()
                total = 0
        yield told()

    counts = texts.mapInPandas(counted, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas().sort_values("shingle")
    return top["shingle"].to_numpy(np.int64), top["n"].to_numpy(np.int64)


def _rest(unsettled: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs of unsettled documents of different components that may still be linked.

    Two sets that are similar enough share one of their rarest shingles: of the larger
    set among those it can spare in any link, of the smaller one among those it can
    spare in a link to a set of its size or more. The places of the shared shingle bound
    how much the sets can have in common. So a busy group of documents gives few pairs,
    and none that could be linked is left out.
    """
    placed = kept(unsettled.select("doc_id", "component").distinct())
    chosen = kept(texts.join(placed.hint("merge"), "doc_id"))
    shared = chosen.sparkSession.sparkContext.broadcast(_frequent(chosen.select("text"), size))

    def rare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(size)
        frequent, times = shared.value
        for batch in batches:
            rows = []
            for doc_id, component, text in zip(batch["doc_id"], batch["component"], batch["text"]):
                own = shingler(text).view(np.int64)
                at = np.searchsorted(frequent, own)
                at[at == len(frequent)] = 0
                known = frequent[at] == own if len(frequent) else np.zeros(len(own), bool)
                often = np.where(known, times[at], 0) if len(frequent) else np.zeros(len(own))
                n = len(own)
                spare = n - -(-percent * n // 100) + 1
                first = own[np.lexsort((own, often))][:spare]
                rows.append(
                    pd.DataFrame({"shingle": first, "doc_id": doc_id, "component": component, "n": n, "at": range(len(first))})
                )
            yield pd.concat(rows)

    rows = kept(chosen.mapInPandas(rare, "shingle long, doc_id long, component long, n long, at long"))
    small = rows.where(f"at <= n - ceil({2 * percent} * n / {100 + percent})").withColumnsRenamed(
        {name: f"{name}_" for name in ("doc_id", "component", "n", "at")}
    )
    may = (
        "component <> component_ AND (n_ < n OR n_ = n AND doc_id_ < doc_id)"
        f" AND 100 * n_ >= {percent} * n AND {100 + percent} * least(n - at, n_ - at_) >= {percent} * (n + n_)"
    )
    found = small.join(rows.withColumnRenamed("shingle", "other"), (F.col("shingle") == F.col("other")) & F.expr(may))
    return found.select(F.col("doc_id").alias("a"), F.col("doc_id_").alias("b"))


def links(docs: DataFrame, classes: DataFrame, percent: int, size: int = 5) -> DataFrame:
    """Links between class representatives that give the same components as all links."""
    search = _Search(docs, classes, percent, size)
    search.check(_around_centre(search.members, "min(doc_id)"))
    unsettled = search.unsettled()
    for centre in CENTRES:
        pairs, members = _pairs_across(unsettled)
        if pairs <= PAIRS_PER_MEMBER * members or not search.check(_around_centre(unsettled, centre)):
            break
        unsettled = search.unsettled()
    search.check(_rest(unsettled, search.texts, percent, size))
    return search.links


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``. ``percent`` is the least similarity in
    hundredths. The least id of a component is kept.
    """
    found = kept(features(docs, percent, size))
    sets = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = sets.groupBy("n_shingles", "low", "high").agg(
        F.min_by(F.struct("doc_id", "buckets", "sketch"), "doc_id").alias("one")
    )
    first = kept(first)
    classes = first.select("n_shingles", "low", "high", "one.*")
    between = links(docs, classes, percent, size)
    copies = sets.join(
        first.select("n_shingles", "low", "high", F.col("one.doc_id").alias("a")), ["n_shingles", "low", "high"]
    ).select("a", F.col("doc_id").alias("b"))
    parts = components(between.unionByName(copies))
    joined = found.select("doc_id", "n_shingles").join(parts, F.col("doc_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """The rows of ``docs`` whose document stands for its component."""
    (id_,) = fresh(docs, "_gone")
    gone = near_duplicates(docs, percent, size).where("NOT kept").select(F.col("doc_id").alias(id_))
    return docs.join(gone.distinct(), docs["doc_id"].cast("long") == F.col(id_), "left_anti")
