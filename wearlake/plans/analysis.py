"""Signal analysis of recordings: all statistics of a signal in one report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.functions.fields import parse_moment
from wearlake.operators import rolling, signal_stats
from wearlake.operators.keyed import join_on, positions
from wearlake.plans.study import Study
from wearlake.schema import SENSORS, SERIES, SIGNALS
from wearlake.sources import recordings, tables


def signal_report(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    local: str,
    order: str,
    n_columns: int | None = None,
    flat_threshold: float = rolling.FLAT_THRESHOLD,
) -> DataFrame:
    """One row per series: extent, moments, rate, quartiles, outliers, artefacts, flat points.

    Rows are numbered and written once; every part reads only its own columns of that.
    """
    keys = list(keys)
    columns = len(rows.columns) if n_columns is None else n_columns
    placed = positions(rows.select(*keys, value, local, order), keys, order)
    flagged = rolling.flat_points(placed, keys, value, "position", flat_threshold)
    parts = [
        signal_stats.signal_summary(placed, keys, value, local, "position", columns),
        signal_stats.sampling_rate(placed, keys, local, "position"),
        signal_stats.box_stats(placed, keys, value, "position").drop("n"),
        rolling.high_variation(placed, keys, value, "position").drop("n_rows"),
        rolling.flat_count(flagged, keys),
    ]
    return reduce(lambda left, right: join_on(left, right, keys, "left"), parts)


def analyse_file(spark: SparkSession, path: str, value: str, local: str) -> DataFrame:
    """The report of one Parquet or CSV recording."""
    found = tables.read_any(spark, path)
    moment = F.col(local)
    if found.schema[local].dataType.simpleString() == "string":
        moment = parse_moment(moment)
    rows = found.select(
        F.lit(path).alias("path"),
        F.col(value).try_cast("double").alias(value),
        moment.alias(local),
        "row_index",
    )
    return signal_report(rows, ["path"], value, local, "row_index", len(found.columns) - 1)


def analyse_study(spark: SparkSession, study: Study) -> DataFrame:
    """The report of every sensor of every usable recording of a study."""
    reports = []
    for signal in SIGNALS:
        sources = [source for source, _ in SENSORS[signal]]
        rows = recordings.scan(spark, study.recordings, signal)
        tall = rows.select(*SERIES, "row_index", "timestamp_local", *sources).unpivot(
            [*SERIES, "row_index", "timestamp_local"], sources, "sensor", "value"
        )
        columns = len(recordings.wanted_columns(signal))
        reports.append(
            signal_report(tall, [*SERIES, "sensor"], "value", "timestamp_local", "row_index", columns)
        )
    return reduce(DataFrame.unionByName, reports)
