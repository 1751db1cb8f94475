"""Side tables (subject metadata, visits) and files of either kind."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlake.operators.keyed import join_on, stored
from wearlake.schema import METADATA_SCHEMA, VISIT_COLUMNS
from wearlake.sources import sinks
from wearlake.sources.csv_records import read_csv


def with_csv_rows(raw: DataFrame, out: str = "row_index", keys: Sequence[str] = ()) -> DataFrame:
    """Number the rows of each CSV file from 0 in file order.

    With ``keys``, columns that folder names give, the numbers run on through all files of a
    series, in the order of the files' paths.

    Rows of one split keep their order, so their running id less the split's smallest
    gives the place in the split; the row counts of the splits before are added. Rows,
    splits and ids come from one written copy: a second scan could cut files otherwise.
    """
    keys = list(keys)
    at = stored(
        raw.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_id"),
        )
    )
    before = Window.partitionBy(*(keys or ["_file"])).orderBy("_file", "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = (
        at.groupBy(*keys, "_file", "_block")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            "_file", "_block", "_first",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    return (
        join_on(at, splits, ["_file", "_block"])
        .withColumn(out, F.col("_start") + F.col("_id") - F.col("_first"))
        .drop("_file", "_block", "_id", "_first", "_start")
    )


def _whole(text: Column) -> Column:
    """A whole number, also one written like ``12.0``."""
    number = F.trim(text).try_cast("double")
    return F.coalesce(
        F.trim(text).try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint"))
    )


def _day(text: Column) -> Column:
    """A date as ``2020-01-28``, with or without a time, or month first."""
    plain = F.trim(text)
    return F.coalesce(
        plain.try_cast("date"),
        *(F.try_to_date(plain, shape) for shape in ("M/d/yyyy", "M-d-yyyy", "yyyy/M/d", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")),
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Subject metadata with ``row_index``, its order in the file.

    Columns are found by name, whatever their order; others are dropped.
    """
    fields = [part.split() for part in METADATA_SCHEMA.split(", ")]
    raw = spark.read.options(**sinks.CSV).csv(path)
    # fmt: off
    typed = raw.select(
        *(_whole(F.col(n)).cast(t.lower()).alias(n) if t == "BIGINT" else F.col(n) for n, t in fields),
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ).alias("row_index"),
    )
    # fmt: on
    return typed


def read_visits(spark: SparkSession, path: str) -> DataFrame:
    """Visits: subject code, interview date, age in months."""
    raw = spark.read.options(**sinks.CSV).csv(path)
    code, date, age = VISIT_COLUMNS
    return raw.select(
        F.col(code),
        _day(F.col(date)).alias(date),
        F.trim(F.col(age)).try_cast("double").try_cast("int").alias(age),
    )


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet or CSV file by its extension, with ``row_index``; fields of a CSV are texts."""
    kind = os.path.splitext(path)[1].lower()
    if kind == ".parquet":
        rows = sinks.whole_moments(spark.read.parquet(path).select("*", "_metadata.row_index"), path)
        return rows
    if kind == ".csv":
        return read_csv(spark, path)
    raise ValueError(f"unsupported file type '{kind}': only .parquet and .csv")
