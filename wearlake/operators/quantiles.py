"""Exact, linearly interpolated percentiles per series, by radix selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.operators.keyed import BROADCAST_SERIES, join_on, materialise

# Leading bits of a value's key that one pass looks at: sign, exponent and eight more, so
# that a bucket spans a 256th of its lower end.
BITS = 20
# So many rows in buckets that hold a wanted rank are counted value by value.
COUNTED_ROWS = 4_000_000

_LEAST_EXPONENT = -1022
_HALF = 52
_INFINITE = (1024 - _LEAST_EXPONENT + 1) << _HALF


def present(value: Column) -> Column:
    """The value as a double; null for ``NaN``, which no statistic counts."""
    x = value.cast("double")
    return F.when(~F.isnan(x), x)


def with_order_key(rows: DataFrame, x: str, out: str) -> DataFrame:
    """Adds a long in the order of the double ``x``, one for one: the bits of its magnitude, signed.

    ``-0.0`` and ``0.0`` have one key, null and ``NaN`` have none. All steps are exact: the
    exponent found by logarithm is put right where it is off by one. Each step is a column
    of its own, so that no expression is computed twice.
    """
    two = F.lit(2.0)
    sized = rows.withColumn("_size", F.abs(present(F.col(x))))
    guessed = sized.withColumn("_guess", F.greatest(F.floor(F.log2("_size")).cast("double"), F.lit(float(_LEAST_EXPONENT))))
    scaled = guessed.withColumn("_power", F.pow(two, "_guess"))
    off = F.when(F.col("_size") < F.col("_power"), -1.0).when(F.col("_size") >= F.col("_power") * 2, 1.0).otherwise(0.0)
    settled = scaled.withColumn("_exponent", F.greatest(F.col("_guess") + off, F.lit(float(_LEAST_EXPONENT))))
    whole = settled.withColumn("_mantissa", F.col("_size") / F.pow(two, "_exponent") * float(1 << _HALF))
    bits = (
        F.when(F.col("_size") == 0, F.lit(0))
        .when(F.col("_size") == float("inf"), F.lit(_INFINITE))
        .otherwise((F.col("_exponent") - _LEAST_EXPONENT).cast("long") * F.lit(1 << _HALF) + F.col("_mantissa").cast("long"))
    )
    found = whole.withColumn("_bits", bits)
    signed = F.when(F.col(x) < 0, -F.col("_bits")).otherwise(F.col("_bits"))
    return found.withColumn(out, signed).drop("_size", "_guess", "_power", "_exponent", "_mantissa", "_bits")


def key_value(key: Column) -> Column:
    """The double of an order key."""
    bits = F.abs(key)
    steps = F.greatest(F.shiftright(bits, _HALF) - 1, F.lit(0))
    mantissa = (bits - F.shiftleft(steps, _HALF)).cast("double") / F.lit(float(1 << _HALF))
    size = F.when(bits >= _INFINITE, F.lit(float("inf"))).otherwise(
        mantissa * F.pow(F.lit(2.0), (steps + _LEAST_EXPONENT).cast("double"))
    )
    return F.when(key < 0, -size).otherwise(size)


def _ranked(counts: DataFrame, keys: list[str], ranks: Column) -> DataFrame:
    """Counts by ``_key`` with the wanted ranks (``_i``, ``_rank``) that each of them holds.

    ``counts`` has ``_n`` rows for each ``_key`` and the number ``_below`` of rows before its
    first one. A series without values keeps one row, with null ``_total``.
    """
    upto = Window.partitionBy(*keys, "_in").orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_end", F.col("_below") + F.sum("_n").over(upto))
    held = F.filter(ranks, lambda r: (r["_rank"] >= F.col("_end") - F.col("_n")) & (r["_rank"] < F.col("_end")))
    return placed.withColumn("_ranks", held)


def _ranks(shares: Sequence[float], total: Column) -> Column:
    """Both data ranks around each share's place."""
    places = [(i, (total - 1) * F.lit(float(s))) for i, s in enumerate(shares)]
    return F.array(
        *(
            F.struct(F.lit(i).alias("_i"), turn(spot).cast("long").alias("_rank"), spot.alias("_spot"))
            for i, spot in places
            for turn in (F.floor, F.ceil)
        )
    )


def selected(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], shares: Sequence[float]
) -> tuple[DataFrame, DataFrame]:
    """All series and ``column`` s, and ``quantiles`` of those that have values."""
    keys = [*keys, "column"]
    values = F.array(
        *(F.struct(F.lit(name).alias("column"), F.col(name).cast("double").alias("_x")) for name in columns)
    )
    tall = with_order_key(rows.select(*keys[:-1], F.inline(values)), "_x", "_key").drop("_x")

    shift = 64 - BITS
    first = tall.groupBy(*keys, F.shiftright("_key", shift).alias("_key")).agg(F.count("_key").alias("_n"))
    whole = first.withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
    start = whole.withColumns({"_in": F.lit(0).cast("long"), "_below": F.lit(0).cast("long"), "_ranks": _ranks(shares, F.col("_total"))})
    # Buckets that hold a wanted rank; a column without values stays as one null bucket.
    every = materialise(_ranked(start, keys, F.col("_ranks")).where("size(_ranks) > 0 OR _total = 0"))
    asked = every.where("_total > 0")
    while True:
        facts = asked.agg(F.count("*").alias("buckets"), F.sum("_n").alias("rows")).first()
        small = facts.buckets <= BROADCAST_SERIES
        buckets = asked.select(*keys, F.col("_key").alias("_in"), (F.col("_end") - F.col("_n")).alias("_below"), "_ranks")
        inside = join_on(tall.withColumn("_in", F.shiftright("_key", shift)), buckets, [*keys, "_in"], small=small)
        finer = 0 if shift <= BITS or (facts.rows or 0) <= COUNTED_ROWS else shift - BITS
        counts = inside.groupBy(*keys, "_in", "_below", "_ranks", F.shiftright("_key", finer).alias("_key")).agg(
            F.count("*").alias("_n")
        )
        found = _ranked(counts, keys, F.col("_ranks")).where("size(_ranks) > 0")
        if finer == 0:
            break
        asked, shift = materialise(found), finer
    hits = found.select(*keys, key_value(F.col("_key")).alias("_value"), F.inline("_ranks"))
    answers = []
    for i in range(len(shares)):
        mine = F.col("_i") == i
        low, high, spot = F.min(F.when(mine, F.col("_value"))), F.max(F.when(mine, F.col("_value"))), F.max(F.when(mine, F.col("_spot")))
        answers.append(low + (high - low) * (spot - F.floor(spot)))
    return every.select(*keys).distinct(), hits.groupBy(*keys).agg(F.array(*answers).alias("quantiles"))


def column_percentiles(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str], shares: Sequence[float]
) -> DataFrame:
    """``quantiles`` for every series and ``column``, one value per share, by rank.

    Values become longs of the same order. All columns' values are counted by their leading
    bits in one scan; only the buckets that hold a wanted rank are looked into again, by
    their next bits, until few rows are left, which are counted value by value. So scans
    move counts of buckets, never the values themselves. A column without values has null.
    """
    every, found = selected(rows, keys, columns, shares)
    return join_on(every, found, [*keys, "column"], "left")


def percentiles(
    rows: DataFrame, keys: Sequence[str], column: str, shares: Sequence[float]
) -> DataFrame:
    """One row per series with an array ``quantiles``, one value per share."""
    return column_percentiles(rows, keys, [column], shares).drop("column")
