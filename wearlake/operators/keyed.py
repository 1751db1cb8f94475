"""Work per series without ever putting a whole series into one task.

A single series may hold a large share of all rows. So nothing here partitions rows
by the series key alone: rows are cut into bounded chunks of their row order, and
only per-chunk or per-series totals meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearlake.session import scratch_dir, scratch_path

CHUNK_ROWS = 1_000_000

# A per-series table is broadcast only if its series were counted and fit into this
# many bytes at the allowance per row.
BROADCAST_BYTES = 64 << 20
BROADCAST_ROW_BYTES = 256
BROADCAST_SERIES = BROADCAST_BYTES // BROADCAST_ROW_BYTES

# Rows of a series that one task may join when its scalars are not broadcast.
SERIES_ROWS = 1_000_000


def materialise(df: DataFrame) -> DataFrame:
    """Freeze ``df`` in the shared scratch folder; later jobs read that copy."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    For rows that several passes need: each pass then reads only its own columns.
    ``compression`` names a codec, else it is the session's.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcastable(
    source: DataFrame, keys: Sequence[str], limit: int = BROADCAST_SERIES
) -> bool:
    """Count the series of ``source`` and tell if one row for each may be broadcast.

    One aggregation over the key columns only, combined before the shuffle.
    """
    return source.select(*keys).distinct().count() <= limit


def join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    small: bool = False,
) -> DataFrame:
    """Join on equal keys where null equals null, so that no series gets lost.

    ``small`` is the caller's word that the right side was measured and may be
    broadcast; otherwise Spark decides.
    """
    renamed = right.withColumnsRenamed({key: f"_on_{key}" for key in keys})
    matches = [F.col(key).eqNullSafe(F.col(f"_on_{key}")) for key in keys]
    condition = reduce(lambda a, b: a & b, matches)
    side = F.broadcast(renamed) if small else renamed
    return left.join(side, condition, how).drop(*(f"_on_{key}" for key in keys))


def salts(rows: DataFrame, keys: Sequence[str], series_rows: int | None = None) -> DataFrame:
    """The series that are too large for one task, with ``_salts``: into how many parts they go.

    Exact counts of the key, combined before the shuffle. A series goes into parts of about
    ``series_rows`` rows; were there more such series than may be broadcast, the bound rises
    with the total, so that the list never has more than ``BROADCAST_SERIES`` rows.
    """
    sizes = materialise(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size")))
    total = sizes.agg(F.sum("_size")).first()[0] or 0
    part = max(series_rows or SERIES_ROWS, total // BROADCAST_SERIES)
    return sizes.where(F.col("_size") > part).select(*keys, F.ceil(F.col("_size") / part).cast("int").alias("_salts"))


def attach(
    rows: DataFrame,
    per_series: DataFrame,
    keys: Sequence[str],
    spread: Sequence[str],
    small: bool,
    series_rows: int | None = None,
) -> DataFrame:
    """Left-join one row per series onto its samples.

    With ``small`` (see :func:`broadcastable`) the samples stay where they are. If there are
    too many series for that, both sides meet on the key. A series of more rows than a task
    should join (see :func:`salts`) is dealt to parts by a hash of the sample's ``spread``
    columns, and only its scalars are copied, once for each part.
    """
    keys = list(keys)
    if small:
        return join_on(rows, per_series, keys, "left", small=True)
    heavy = salts(rows, keys, series_rows)
    parts = F.coalesce("_salts", F.lit(1))
    salted = join_on(rows, heavy, keys, "left", small=True).withColumn("_salt", F.pmod(F.xxhash64(*spread), parts)).drop("_salts")
    copies = join_on(per_series, heavy, keys, "left", small=True).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1).cast("array<bigint>"))
    ).drop("_salts")
    return join_on(salted, copies, [*keys, "_salt"], "left").drop("_salt")


def positions(
    rows: DataFrame, keys: Sequence[str], order: str, out: str = "position"
) -> DataFrame:
    """Add each row's 0-based rank in its series by the column ``order``.

    ``order`` must be unique within a series; gaps of any size do not matter. Rows are
    range-partitioned by series and order once and numbered where they land; the written
    copy fixes the partitions. A row's rank is its place in its partition plus the rows
    of its series in earlier partitions; only these totals are brought together.
    """
    keys = list(keys)
    ordered = stored(
        rows.repartitionByRange(*keys, order)
        .sortWithinPartitions(*keys, order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    )
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = materialise(
        ordered.groupBy(*keys, "_part")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            *keys, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
        )
    )
    return (
        join_on(ordered, totals, [*keys, "_part"], small=totals.count() <= BROADCAST_SERIES)
        .withColumn(out, F.col("_start") + F.col("_id") - F.col("_first"))
        .drop("_part", "_id", "_first", "_start")
    )


def whole_part(column: str, size: int, shift: int = 0) -> Column:
    """Integer quotient of ``column + shift`` by ``size``."""
    return F.expr(f"(`{column}` + {shift}L) div {size}L")


class Chunked:
    """Rows cut into chunks of their position, with neighbours' rows as a halo.

    Each row goes to the chunk that owns it and to those neighbours whose window
    frames reach it: ``before`` rows back and ``after`` rows ahead. A window over
    :attr:`window` then sees the same frame as one over the whole series;
    :meth:`owned` drops the copies again.
    """

    def __init__(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        position: str,
        before: int,
        after: int,
        chunk: int = CHUNK_ROWS,
    ):
        first = F.greatest(whole_part(position, chunk, -after), F.lit(0))
        last = whole_part(position, chunk, before)
        self._home = whole_part(position, chunk)
        self.rows = rows.withColumn("_chunk", F.explode(F.sequence(first, last)))
        self.window = Window.partitionBy(*keys, "_chunk").orderBy(position)

    def owned(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("_chunk") == self._home).drop("_chunk")


