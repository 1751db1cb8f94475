"""Statistics of a signal, per series. ``NaN`` is a missing value in all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.operators.keyed import CHUNK_ROWS, Chunked, attach, broadcastable, join_on
from wearlake.operators.quantiles import percentiles, present, selected

# fixed values: histogram bins, quartiles, reach of box-plot whiskers
HISTOGRAM_BINS = 30
QUARTILES = (0.25, 0.5, 0.75)
WHISKER_REACH = 1.5


def micros(moment):
    """Microseconds since the epoch of a timestamp with or without zone."""
    return F.unix_micros(moment.cast("timestamp"))


def signal_summary(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    local: str,
    order: str,
    n_columns: int | None = None,
) -> DataFrame:
    """Counts, time extent and moments of one signal, in one pass.

    ``n_columns`` is the number of columns of the recording, where ``rows`` is only part
    of it.
    """
    x = present(F.col(value))
    return (
        rows.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(local).alias("min_local"),
            F.max(local).alias("max_local"),
            F.min_by(local, order).alias("first_local"),
            F.max_by(local, order).alias("last_local"),
            F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
        .withColumn("n_columns", F.lit(len(rows.columns) if n_columns is None else n_columns))
        .withColumn(
            "duration_s", (micros(F.col("max_local")) - micros(F.col("min_local"))) / F.lit(1e6)
        )
        .withColumn(
            "extent_s", (micros(F.col("last_local")) - micros(F.col("first_local"))) / F.lit(1e6)
        )
        .withColumn("range", F.col("max") - F.col("min"))
    )


def sampling_rate(
    rows: DataFrame, keys: Sequence[str], local: str, position: str, chunk: int = CHUNK_ROWS
) -> DataFrame:
    """One over the commonest time step in seconds; the smallest such step on a tie.

    Steps are counted by value first, so the mode needs no per-series value table.
    """
    pieces = Chunked(rows.select(*keys, local, position), keys, position, 1, 0, chunk)
    here = micros(F.col(local))
    stepped = pieces.owned(
        pieces.rows.withColumn("_step", here - F.lag(here, 1).over(pieces.window))
    )
    counted = stepped.where(F.col("_step").isNotNull()).groupBy(*keys, "_step").count()
    return (
        counted.groupBy(*keys)
        .agg(F.min(F.struct(-F.col("count"), F.col("_step")))["_step"].alias("_mode"))
        .select(
            *keys,
            (F.col("_mode") / F.lit(1e6)).alias("step_s"),
            F.try_divide(F.lit(1.0), F.col("_mode") / F.lit(1e6)).alias("rate_hz"),
        )
    )


def distinct_values(rows: DataFrame, column: str, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values with the row each first appears in; null counts as a value."""
    return rows.groupBy(*keys, F.col(column).alias("value")).agg(
        F.min(order).alias("first_row")
    )


def distinct_values_of(
    rows: DataFrame, columns: Sequence[str], order: str, keys: Sequence[str] = ()
) -> DataFrame:
    """:func:`distinct_values` of several columns, as texts, in one scan.

    One aggregation over grouping sets, a set for each column.
    """
    keys = list(keys)
    texts = rows.select(*keys, order, *(F.col(c).cast("string").alias(f"_v{i}") for i, c in enumerate(columns)))
    made = [f"_v{i}" for i in range(len(columns))]
    found = texts.groupingSets([[*keys, one] for one in made], *keys, *made).agg(
        *(F.grouping(one).alias(f"_g{one}") for one in made), F.min(order).alias("first_row")
    )
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one, column in zip(made, columns):
        mine = F.col(f"_g{one}") == 0
        name, value = F.when(mine, column).otherwise(name), F.when(mine, F.col(one)).otherwise(value)
    return found.select(*keys, name.alias("column"), value.alias("value"), "first_row")


def describe_numeric(
    rows: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max of each column, as rows."""
    keys = list(keys)

    def moments(name):
        value = present(F.col(name))
        return F.struct(
            F.lit(name).alias("column"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    wide = rows.groupBy(*keys).agg(F.array(*(moments(name) for name in columns)).alias("_all"))
    _, quantiles = selected(rows, keys, columns, QUARTILES)
    tall = join_on(wide.select(*keys, F.inline("_all")), quantiles, [*keys, "column"], "left")
    return tall.select(
        *keys, "column", "count", "mean", "std", "min",
        *(F.get("quantiles", F.lit(i)).alias(f"q{int(s * 100)}") for i, s in enumerate(QUARTILES)),
        "max",
    )


def histogram(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    spread: str,
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Equal-width bins between each series' extremes; the last bin is closed.

    A constant signal gets a range of half a unit to either side. Empty bins are kept.
    """
    keys = list(keys)
    rows = rows.where(present(F.col(value)).isNotNull())
    flat = F.col("_lo") == F.col("_hi")
    limits = (
        rows
        .groupBy(*keys)
        .agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
        .select(
            *keys,
            F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("lo"),
            F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("hi"),
        )
    )
    samples = rows.select(*keys, value, spread)
    x = F.col(value).cast("double")
    width = (F.col("hi") - F.col("lo")) / bins
    # The quotient may be off by one at an edge; the edges themselves decide.
    near = F.least(F.width_bucket(x, "lo", "hi", F.lit(bins)), F.lit(bins)) - 1
    guess = F.col("_near")
    bin_of = (
        F.when(x < F.col("lo") + width * guess, guess - 1)
        .when((x >= F.col("lo") + width * (guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    filled = (
        attach(samples, limits, keys, [spread], broadcastable(rows, keys))
        .withColumn("_near", near)
        .select(*keys, "lo", "hi", bin_of.alias("bin"), F.lit(1).alias("_n"))
    )
    empty = limits.select(
        *keys, "lo", "hi",
        F.explode(F.expr(f"sequence(0L, {bins - 1}L)")).alias("bin"),
        F.lit(0).alias("_n"),
    )
    return (
        filled.unionByName(empty)
        .groupBy(*keys, "lo", "hi", "bin")
        .agg(F.sum("_n").alias("n"))
        .select(
            *keys,
            F.col("bin").cast("int").alias("bin"),
            (F.col("lo") + width * F.col("bin")).alias("bin_lo"),
            F.when(F.col("bin") == bins - 1, F.col("hi"))
            .otherwise(F.col("lo") + width * (F.col("bin") + 1))
            .alias("bin_hi"),
            "n",
        )
    )


def _with_fences(
    rows: DataFrame, keys: Sequence[str], value: str, spread: str
) -> DataFrame:
    """Samples with the quartiles and the whisker fences of their series."""
    q = [F.get("quantiles", F.lit(i)) for i in range(3)]
    reach = WHISKER_REACH * (q[2] - q[0])
    fences = percentiles(rows, keys, value, QUARTILES).select(
        *keys,
        q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - reach).alias("_lower"), (q[2] + reach).alias("_upper"),
    )
    samples = rows.select(*keys, value, spread).where(present(F.col(value)).isNotNull())
    return attach(samples, fences, keys, [spread], broadcastable(rows, keys))


def box_stats(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    spread: str,
) -> DataFrame:
    """Quartiles, whiskers at the last datum within reach, number of outliers.

    A whisker never ends inside the box: with no datum beyond the quartile it stops
    there.
    """
    fenced = _with_fences(rows, keys, value, spread)
    x = F.col(value)
    inside = x.between(F.col("_lower"), F.col("_upper"))
    lowest = F.min(F.when(inside, x))
    highest = F.max(F.when(inside, x))
    return (
        fenced.groupBy(*keys, "q1", "median", "q3")
        .agg(
            lowest.alias("_lowest"),
            highest.alias("_highest"),
            F.count_if(~inside).alias("n_outliers"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            *keys, "q1", "median", "q3",
            F.least("_lowest", "q1").alias("whisker_lo"),
            F.greatest("_highest", "q3").alias("whisker_hi"),
            "n_outliers", "n",
        )
    )


def box_outliers(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    spread: str,
) -> DataFrame:
    """The samples beyond the whiskers."""
    fenced = _with_fences(rows, keys, value, spread)
    inside = F.col(value).between(F.col("_lower"), F.col("_upper"))
    return fenced.where(~inside).select(*keys, spread, value)
