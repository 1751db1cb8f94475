"""Exact removal of long repeated strings, by grouping runs of seed positions.

Wanted is every byte covered by a string of ``length`` bytes that also starts elsewhere.
Plain prefix doubling ranks every byte position; here only few of them are sorted. Every
window of ``length`` bytes names one position inside it: where its least seed (a string of
``SEED`` bytes, ordered by hash) starts. Equal windows name the same place in themselves,
and neighbouring windows mostly name the same one, so a *run* of windows is one row.

Round 0 ranks runs by their seed; runs with a unique seed are unique and go. Round 1 takes
pairs of that rank and the rank of the whole string that the run's windows cover, about
twice as long; runs that are equal in both are repeated as a whole. What is left are
runs at the ends of matches, where some windows are repeated and some are not: round 2
ranks their windows of the full length, within the runs of equal seed. A rank is the
class of equal strings; rows are sorted into classes by 64-bit hashes with different bases
for seed and string, so that 128 bits tell two strings apart.

A seed with many different strings around it (over ``GROUP`` of them) is not handed to one
task: its windows become rows and are counted by Spark.

Defined results: null text is empty; texts shorter than ``length`` stay whole. Rows that
repeat id and text repeat each other, so what is long enough in them is removed; a null id
is an id like any other. Overlapping repeats within one text count. Columns named like
results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.llm.common import fresh, kept, small_batches
from wearlake.llm.shingles import mixed, split_mix

LENGTH = 200
SEED = 40
GROUP = 4096
# Windows of a long text are looked at in stretches of this many.
STRETCH = 1 << 18
_PLACE = np.uint64((1 << 19) - 1)


class Hashes:
    """Position-free 64-bit polynomial hashes of substrings, for one base."""

    def __init__(self, which: int):
        numbers = split_mix(257, seed=101 + which)
        self.codes = numbers[:256]
        self.base = int(numbers[256]) & ~7 | 5
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        if len(self.powers) < n:
            size = 1 << int(n).bit_length()
            for name, factor in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                row = np.full(size, factor, np.uint64)
                row[0] = 1
                setattr(self, name, np.multiply.accumulate(row))

    def prefix(self, raw: np.ndarray) -> np.ndarray:
        self._reach(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.codes[raw] * self.powers[: len(raw)], out=sums[1:])
        return sums

    def of(self, prefix: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (prefix[start + size] - prefix[start]) * self.inverse[start]


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


class Runs:
    """Cuts a text into runs of windows with the same least seed."""

    def __init__(self, length: int, seed: int):
        self.length, self.seed = length, min(seed, length)
        self.width = self.length - self.seed + 1
        self.one, self.two = Hashes(1), Hashes(2)

    def _stretch(self, raw: np.ndarray) -> tuple[np.ndarray, ...]:
        prefix = self.one.prefix(raw)
        starts = np.arange(len(raw) - self.seed + 1)
        seeds = mixed(self.one.of(prefix, starts, self.seed))
        least = (seeds & ~_PLACE) | starts.astype(np.uint64)
        reach = 1
        while 2 * reach <= self.width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < self.width:
            rest = self.width - reach
            least = np.minimum(least[:-rest], least[rest:])
        named = (least & _PLACE).astype(np.int64)
        first = np.concatenate([[0], np.nonzero(np.diff(named))[0] + 1])
        count = np.diff(np.append(first, len(named)))
        covered = count + self.length - 1
        string = mixed(self.two.of(self.two.prefix(raw), first, covered) + covered.astype(np.uint64))
        return seeds[named[first]], string, first, count, named[first] - first

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Seed, string and place (first window, number of windows, seed's offset) of each run."""
        raw = _raw(text)
        windows = len(raw) - self.length + 1
        seeds, strings, places = [], [], []
        for start in range(0, max(0, windows), STRETCH):
            seed, string, first, count, offset = self._stretch(raw[start : start + STRETCH + self.length - 1])
            seeds.append(seed)
            strings.append(string)
            places.append(((first + start) << 32) | (count << 12) | offset)
        if not seeds:
            return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),)
        return np.concatenate(seeds), np.concatenate(strings), np.concatenate(places)


def _first(place):
    return place >> 32


def _count(place):
    return (place >> 12) & 0xFFFFF


def _offset(place):
    return place & 0xFFF


def _keyed(docs: DataFrame, doc: str, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc).alias("d"), F.hash(whole).alias("t"), whole.alias("text"))


def runs(keyed: DataFrame, length: int, seed: int) -> DataFrame:
    """``d``, ``t``, ``seed``, ``string`` and ``place`` of all runs of all texts."""

    @F.pandas_udf("seed array<long>, string array<long>, place array<long>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = Runs(length, seed)
        for batch in batches:
            rows = [[part.view(np.int64) for part in made(text)] for text in batch]
            yield pd.DataFrame(rows, columns=["seed", "string", "place"])

    long_enough = keyed.where(F.octet_length("text") >= length)
    each = long_enough.select("d", "t", cut("text").alias("r"))
    zipped = F.explode(F.arrays_zip("r.seed", "r.string", "r.place")).alias("z")
    return each.select("d", "t", zipped).select("d", "t", "z.seed", "z.string", "z.place")


class Windows:
    """Full-length windows of many short strings at once."""

    def __init__(self, length: int):
        self.length = length
        self.one, self.two = Hashes(3), Hashes(4)

    def __call__(self, strings: list[bytes], seeds: np.ndarray, counts: np.ndarray, offsets: np.ndarray):
        """For every window: its string's number, its number there, and two hashes.

        The hashes cover the seed and the window's place around it as well.
        """
        raw = np.frombuffer(b"".join(strings), np.uint8)
        begins = np.concatenate([[0], np.cumsum(counts + self.length - 1)])[:-1]
        owner = np.repeat(np.arange(len(strings)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = begins[owner] + within
        side = (offsets[owner] - within).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        one = self.one.of(self.one.prefix(raw), start, self.length)
        two = self.two.of(self.two.prefix(raw), start, self.length)
        return owner, within, mixed(mixed(one + side) + seeds[owner]), mixed(mixed(two + side) ^ seeds[owner])


def _strings(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The strings of ``wanted`` runs (``d``, ``t``, ``place``, and more), cut from the texts."""
    listed = wanted.groupBy("d", "t").agg(F.collect_list(F.struct("seed", "place", "n", "big")).alias("runs"))
    same = keyed["d"].eqNullSafe(listed["d"]) & (keyed["t"] == listed["t"])
    # Rows that repeat id and text give their strings once.
    both = keyed.join(listed, same).select(keyed["d"], keyed["t"], "text", "runs").where(
        F.octet_length("text") >= length
    )

    @F.pandas_udf("array<binary>")
    def cut(text: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for value, place in zip(text, places):
            raw = (value or "").encode("utf-8", "surrogatepass")
            out.append([raw[_first(p) : _first(p) + _count(p) + length - 1] for p in place.tolist()])
        return pd.Series(out, dtype=object)

    strings = both.select("d", "t", "runs", cut("text", F.col("runs.place")).alias("strings"))
    each = strings.select("d", "t", F.explode(F.arrays_zip("runs", "strings")).alias("z"))
    return each.select("d", "t", "z.runs.*", F.col("z.strings").alias("string"))


SPAN = "d long, t int, start long, end long"


def _settled(strings: DataFrame, length: int) -> DataFrame:
    """Spans of the windows that are repeated among strings around the same seed."""

    def settled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = Windows(length)

        def told(rows: pd.DataFrame) -> pd.DataFrame:
            place = rows["place"].to_numpy(np.int64)
            owner, within, one, two = windows(
                rows["string"].tolist(), rows["seed"].to_numpy(np.int64).view(np.uint64), _count(place), _offset(place)
            )
            order = np.argsort(one, kind="stable")
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            twice = np.zeros(len(owner), bool)
            twice[order[1:]] |= same
            twice[order[:-1]] |= same
            twice &= (rows["n"].to_numpy(np.int64) == 1)[owner]
            at = np.nonzero(twice)[0]
            if not len(at):
                return rows.iloc[:0].assign(start=0, end=0)[["d", "t", "start", "end"]]
            # Windows in a row are one span.
            cut = np.nonzero((np.diff(at) > 1) | (np.diff(owner[at]) > 0))[0]
            low, high = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)]
            own = owner[low]
            begin = _first(place)[own]
            out = rows.iloc[own][["d", "t"]].reset_index(drop=True)
            return out.assign(start=begin + within[low], end=begin + within[high] + length)

        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= 2 * GROUP:
                rows = pd.concat(held, ignore_index=True)
                seeds = rows["seed"].to_numpy()
                # The last seed may go on in the next batch.
                end = np.searchsorted(seeds, seeds[-1])
                if end:
                    yield told(rows.iloc[:end].reset_index(drop=True))
                held, size = [rows.iloc[end:]], len(rows) - end
        if size:
            yield told(pd.concat(held, ignore_index=True))

    dealt = strings.drop("big").repartition("seed").sortWithinPartitions("seed")
    return dealt.mapInPandas(settled, SPAN)


def _counted(strings: DataFrame, length: int) -> DataFrame:
    """The same for busy seeds: every window is a row, and Spark counts them."""

    @F.pandas_udf("one array<long>, two array<long>")
    def hashed(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        windows = Windows(length)
        for string, seed, place in batches:
            place = place.to_numpy(np.int64)
            _, _, one, two = windows(
                string.tolist(), seed.to_numpy(np.int64).view(np.uint64), _count(place), _offset(place)
            )
            ends = np.cumsum(_count(place))[:-1]
            yield pd.DataFrame(
                {"one": np.split(one.view(np.int64), ends), "two": np.split(two.view(np.int64), ends)}
            )

    each = strings.select("d", "t", "place", "n", hashed("string", "seed", "place").alias("h")).select(
        "d", "t", "place", "n", F.posexplode(F.arrays_zip("h.one", "h.two")).alias("at", "z")
    )
    rows = kept(each.select("d", "t", "place", "n", "at", "z.one", "z.two"))
    twice = kept(rows.groupBy("one", "two").agg(F.count("*").alias("c")).where("c > 1").select("one", "two"))
    start = F.shiftright("place", 32) + F.col("at")
    return rows.where("n = 1").join(twice, ["one", "two"], "left_semi").select(
        "d", "t", start.alias("start"), (start + length).alias("end")
    )


def repeated_spans(docs: DataFrame, doc: str, text: str, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``d``, ``t`` (id and text hash), ``start``, ``end``: spans of bytes to remove.

    Spans may overlap; together they cover just the bytes of repeated strings.
    """
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, doc, text)
    # Round 0: seeds. Unique ones are dropped.
    every = runs(keyed, length, seed)
    common = kept(every.groupBy("seed").agg(F.count("*").alias("c")).where("c > 1").select("seed"))
    shared = kept(every.join(common, "seed", "left_semi"))
    # Round 1: seed and string together.
    one = F.min(F.struct("d", "t", "place"))
    classes = kept(shared.groupBy("seed", "string").agg(F.count("*").alias("n"), one.alias("one")))
    whole = shared.join(classes.where("n > 1").select("seed", "string"), ["seed", "string"], "left_semi")
    first = F.shiftright("place", 32)
    count = F.shiftright("place", 12).bitwiseAND(F.lit(0xFFFFF))
    spans = whole.select("d", "t", first.alias("start"), (first + count + length - 1).alias("end"))
    # Round 2: windows, where a seed has a string of its own beside others.
    mixed_seeds = kept(
        classes.groupBy("seed")
        .agg(F.count("*").alias("c"), F.min("n").alias("least"))
        .where("c > 1 AND least = 1")
        .select("seed", (F.col("c") > F.lit(GROUP)).alias("big"))
    )
    around = classes.join(mixed_seeds, "seed").select("seed", "n", "big", "one.*")
    strings = kept(_strings(keyed, around, length))
    return spans.unionByName(_settled(strings.where("NOT big"), length)).unionByName(
        _counted(strings.where("big"), length)
    )


def without_repeats(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH, seed: int = SEED
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``spans`` (maximal removed runs) and ``kept_bytes``."""
    own, t, found = fresh(docs, "_d", "_t", "_found")
    spans = repeated_spans(docs, doc, text, length, seed)
    listed = spans.groupBy("d", "t").agg(F.collect_list(F.struct("start", "end")).alias(found)).select(
        F.col("d").alias(own), F.col("t").alias(t), found
    )
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    same = docs[doc].eqNullSafe(F.col(own)) & (F.hash(whole) == F.col(t))

    @F.pandas_udf("spans array<struct<start:long,end:long>>, kept_bytes binary")
    def cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for value, start, end in zip(texts, starts, ends):
            raw = (value or "").encode("utf-8", "surrogatepass")
            if start is None or not len(start):
                rows.append(([], raw))
                continue
            order = np.argsort(start, kind="stable")
            low, reach = np.asarray(start)[order], np.maximum.accumulate(np.asarray(end)[order])
            # Spans that touch are one removed run.
            apart = np.nonzero(low[1:] > reach[:-1])[0]
            lows, highs = low[np.append(0, apart + 1)].tolist(), reach[np.append(apart, len(reach) - 1)].tolist()
            parts = [raw[a:b] for a, b in zip([0, *highs], [*lows, len(raw)])]
            rows.append(([{"start": a, "end": b} for a, b in zip(lows, highs)], b"".join(parts)))
        return pd.DataFrame(rows, columns=["spans", "kept_bytes"])

    joined = docs.join(listed, same, "left").withColumn(
        found, cut(whole, F.col(found)["start"], F.col(found)["end"])
    )
    return joined.withColumns(
        {
            "n_bytes": F.octet_length(whole).cast("long"),
            "spans": F.col(found)["spans"],
            "kept_bytes": F.col(found)["kept_bytes"],
        }
    ).drop(own, t, found)
