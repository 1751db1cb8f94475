"""One row per recording: lengths, worn days, bounds, zone, row totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import fields

# fixed value: a day counts as worn above this share of its samples
WORN_SHARE = 0.9


def _partials(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Totals per recording, local date and zone; the null date is one of them.

    Only fixed-width values are aggregated over the samples, so this stays a hash
    aggregation; the zone text is a grouping key because a text cannot be.
    """
    return rows.groupBy(*keys, F.to_date("timestamp_local").alias("_day"), "timezone").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("device_worn") == 1).alias("_worn"),
        F.max("day_of_study").alias("_last_day"),
        F.max("day_absent").alias("_absent"),
        F.min(order).alias("_first"),
        F.max(order).alias("_last"),
        F.min_by("timestamp_utc", order).alias("_first_utc"),
        F.max_by("timestamp_utc", order).alias("_last_utc"),
    )


def _worn_days():
    worn_enough = F.col("_worn") / F.col("_rows") > WORN_SHARE
    return F.count_if(F.col("_day").isNotNull() & worn_enough).cast("int")


def series_summary(rows: DataFrame, keys: Sequence[str], order: str = "row_index") -> DataFrame:
    """All per-recording scalars in one pass over the samples.

    Bounds and zone come from the first and last row in physical order, even if null
    there. A recording without a ``day_of_study`` column (``day_absent``) has length
    0; one with only nulls has a null length.
    """
    daily = (
        _partials(rows, keys, order)
        .groupBy(*keys, "_day")
        .agg(
            F.sum("_rows").alias("_rows"),
            F.sum("_worn").alias("_worn"),
            F.max("_last_day").alias("_last_day"),
            F.max("_absent").alias("_absent"),
            F.min("_first").alias("_first"),
            F.max("_last").alias("_last"),
            F.min_by("_first_utc", "_first").alias("_first_utc"),
            F.max_by("_last_utc", "_last").alias("_last_utc"),
            F.min_by("timezone", "_first").alias("_zone"),
        )
    )
    length = F.when(F.max("_absent"), F.lit(0)).otherwise(F.max("_last_day") + 1).cast("int")
    return daily.groupBy(*keys).agg(
        length.alias("length_per"),
        length.alias("max_devdays"),
        _worn_days().alias("actual_devdays"),
        F.min_by("_first_utc", "_first").alias("first_utc"),
        F.max_by("_last_utc", "_last").alias("last_utc"),
        F.min_by("_zone", "_first").alias("zone"),
        F.sum("_rows").alias("n_rows"),
    )


def device_wear_days(
    rows: DataFrame, keys: Sequence[str], local: str = "timestamp_local", worn: str = "device_worn"
) -> DataFrame:
    """Number of local dates on which the device was worn."""
    daily = rows.groupBy(*keys, F.to_date(local).alias("_day")).agg(
        F.count(F.lit(1)).alias("_rows"), F.count_if(F.col(worn) == 1).alias("_worn")
    )
    return daily.groupBy(*keys).agg(_worn_days().alias("actual_devdays"))


def series_length(rows: DataFrame, keys: Sequence[str], day: str = "day_of_study") -> DataFrame:
    """Last study day plus one."""
    return rows.groupBy(*keys).agg((F.max(day) + 1).cast("int").alias("length_per"))


def first_value(rows: DataFrame, keys: Sequence[str], column: str, order: str) -> DataFrame:
    """Value in the first physical row of each series, null included.

    Values are grouped first, so that a text column needs no sort of the samples.
    """
    seen = rows.groupBy(*keys, column).agg(F.min(order).alias("_first"))
    return seen.groupBy(*keys).agg(F.min_by(column, "_first").alias(column))


def collection_bounds(
    rows: DataFrame, keys: Sequence[str], moment: str = "timestamp_utc", order: str = "row_index"
) -> DataFrame:
    """Date and time texts of the first and the last physical row."""
    ends = rows.groupBy(*keys).agg(
        F.min_by(moment, order).alias("_first"), F.max_by(moment, order).alias("_last")
    )
    return ends.select(*keys, *bound_texts(F.col("_first"), F.col("_last")))


def bound_texts(first, last) -> list:
    return [
        fields.date_text(first).alias("dc_start_date"),
        fields.time_text(first).alias("dc_start_time"),
        fields.date_text(last).alias("dc_end_date"),
        fields.time_text(last).alias("dc_end_time"),
    ]


def run_report(
    rows: DataFrame, keys: Sequence[str], failed: DataFrame | None = None
) -> DataFrame:
    """Rows per recording and, with null keys, for the whole run.

    ``failed`` has the keys of recordings that gave no output; they show no rows.
    """
    done = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "*", F.lit(1).cast("long").alias("n_files"), F.lit(0).cast("long").alias("n_failures")
    )
    if failed is not None:
        none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        done = done.unionByName(
            failed.select(*keys).distinct().select(
                *keys, none.alias("n_rows"), none.alias("n_files"), one.alias("n_failures")
            )
        )
    total = done.agg(
        *(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("n_rows", "n_files", "n_failures"))
    )
    return done.unionByName(total, allowMissingColumns=True)
