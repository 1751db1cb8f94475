"""Differences, rolling bands and quality flags in physical row order.

``position`` is the dense 0-based row number within the series: ``row_index`` of a
recording, or the result of :func:`wearlake.operators.keyed.positions`. ``NaN`` is a
missing value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.operators.keyed import BROADCAST_SERIES, CHUNK_ROWS, Chunked, join_on, stored, whole_part
from wearlake.operators.quantiles import present

# fixed values: rolling window, band width, artefact factor, flat-line threshold
ROLLING_WINDOW = 20
ARTEFACT_FACTOR = 2.0
FLAT_THRESHOLD = 0.001


def differences(
    rows: DataFrame, keys: Sequence[str], value: str, position: str, chunk: int = CHUNK_ROWS
) -> DataFrame:
    """Adds ``diff``: the value less the previous one, null on the first row and beside ``NaN``."""
    pieces = Chunked(rows, keys, position, 1, 0, chunk)
    x = present(F.col(value))
    step = x - F.lag(x, 1).over(pieces.window)
    return pieces.owned(pieces.rows.withColumn("diff", step))


def rolling_band(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    position: str,
    window: int = ROLLING_WINDOW,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Centred rolling mean and sample std, and the band of one std around the mean.

    Null unless the window holds ``window`` values that are not null. An even window
    reaches one row further back than ahead.

    Positions are cut into runs of ``window`` rows. A window is the end of one run and the
    beginning of the next. For every row the sums of its run up to the row, and from the row
    on, are kept: of the values less the run's first (last) one and of their squares. Two
    looks at these sums give a window's moments. So the work for a row does not depend on
    ``window``, and every number added lies in the window: a large offset or a step nearby
    costs no digits.
    """
    ahead = (window - 1) // 2
    back = window - 1 - ahead
    keys = list(keys)
    pieces = Chunked(rows, keys, position, back, ahead, chunk)
    # One distribution and two orders serve the runs and the windows.
    dealt = pieces.rows.withColumns({"_x": present(F.col(value)), "_run": whole_part(position, window)})
    dealt = dealt.repartition(*keys, "_chunk")
    run = Window.partitionBy(*keys, "_chunk", "_run")

    def summed(rows_: DataFrame, name: str, order: Column) -> DataFrame:
        """Adds ``name``: number, sum and sum of squares from one end of the run to each row."""
        upto = run.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        near = rows_.withColumn("_c", F.first("_x", ignorenulls=True).over(upto))
        d = F.col("_x") - F.col("_c")
        sums = near.withColumns({"_n": F.count("_x").over(upto), "_s": F.sum(d).over(upto), "_q": F.sum(d * d).over(upto)})
        parts = (F.col("_c").alias("c"), F.col("_n").alias("n"), F.col("_s").alias("s"), F.col("_q").alias("q"))
        return sums.withColumn(name, F.struct(*parts)).drop("_c", "_n", "_s", "_q")

    held = summed(summed(dealt, "_tail", F.desc(position)), "_head", F.asc(position))
    along = Window.partitionBy(*keys, "_chunk").orderBy("_run", position)
    seen = held.withColumns({"_a": F.lag("_tail", back).over(along), "_b": F.lead("_head", ahead).over(along)})

    def moments(part):
        n, total = F.col(f"{part}.n"), F.col(f"{part}.s")
        return n, F.col(f"{part}.c"), total / n, F.col(f"{part}.q") - total * total / n

    (n_a, c_a, beyond_a, off_a), (n_b, c_b, beyond_b, off_b) = moments("_a"), moments("_b")
    # The window is one whole run where it begins with one.
    one_run = F.pmod(F.col(position), F.lit(window)) == back % window
    # Differences of values keep what the means, beside a large offset, would round away.
    apart = (c_b - c_a) + (beyond_b - beyond_a)
    mean_a = c_a + beyond_a
    mean = F.when(one_run, mean_a).otherwise(mean_a + apart * n_b / window)
    off = F.when(one_run, off_a).otherwise(off_a + off_b + apart * apart * n_a * n_b / window)
    full = F.when(one_run, n_a == window).otherwise(n_a + n_b == window) & F.col("_b").isNotNull()
    spread = F.sqrt(F.greatest(off, F.lit(0.0)) / F.lit(float(window - 1)))
    banded = seen.withColumns({"rolling_mean": F.when(full, mean), "rolling_std": F.when(full, spread)})
    return (
        pieces.owned(banded)
        .drop("_x", "_run", "_head", "_tail", "_a", "_b")
        .withColumn("band_lo", F.col("rolling_mean") - F.col("rolling_std"))
        .withColumn("band_hi", F.col("rolling_mean") + F.col("rolling_std"))
    )


def high_variation(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    position: str,
    factor: float = ARTEFACT_FACTOR,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows whose step exceeds ``factor`` times the std of all steps: count and percent.

    The window is gone through once: equal steps are counted, and both the std and the
    rows above the threshold follow from these counts.
    """
    keys = list(keys)
    steps = differences(rows.select(*keys, value, position), keys, value, position, chunk)
    counts = stored(steps.groupBy(*keys, F.abs("diff").alias("_step")).agg(F.count(F.lit(1)).alias("_n")))
    size, step = F.col("_n").cast("double"), F.col("_step")
    known = F.when(step.isNotNull(), size)
    means = counts.groupBy(*keys).agg(
        F.sum("_n").alias("n_rows"), F.sum(known).alias("_steps"), (F.sum(step * size) / F.sum(known)).alias("_mean")
    )
    small = means.count() <= BROADCAST_SERIES
    off = (step - F.col("_mean")) * (step - F.col("_mean")) * size
    spread = F.sqrt(F.sum(off) / F.nullif(F.first("_steps") - 1, F.lit(0.0)))
    spreads = join_on(counts, means, keys, small=small).groupBy(*keys).agg(spread.alias("_std"), F.first("n_rows").alias("n_rows"))
    high = F.coalesce(step > F.lit(factor) * F.col("_std"), F.lit(False))
    return (
        join_on(counts, spreads, keys, small=small)
        .groupBy(*keys)
        .agg(F.sum(F.when(high, F.col("_n")).otherwise(0)).alias("n_high"), F.first("n_rows").alias("n_rows"))
        .withColumn("pct_high", F.col("n_high") / F.col("n_rows") * 100)
    )


def flat_points(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    position: str,
    threshold: float = FLAT_THRESHOLD,
    chunk: int = CHUNK_ROWS,
) -> DataFrame:
    """Adds ``flat``: the step into this row, the one before and the one after are tiny."""
    pieces = Chunked(rows, keys, position, 2, 1, chunk)
    x = present(F.col(value))
    near = [
        F.lag(x, 2).over(pieces.window),
        F.lag(x, 1).over(pieces.window),
        x,
        F.lead(x, 1).over(pieces.window),
    ]
    tiny = [F.abs(b - a) < F.lit(threshold) for a, b in zip(near, near[1:])]
    flat = F.coalesce(tiny[0] & tiny[1] & tiny[2], F.lit(False))
    return pieces.owned(pieces.rows.withColumn("flat", flat))


def flat_count(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    return flagged.groupBy(*keys).agg(F.count_if("flat").alias("n_flat"))
