"""Scan of the sensor recordings of a whole study as one DataFrame per signal."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.functions import names
from wearlake.operators.keyed import BROADCAST_SERIES, attach, broadcastable, materialise
from wearlake.schema import RECORDING_TYPES, SENSORS, SERIES
from wearlake.session import prepare
from wearlake.sources import files as tree

# Arrow type of a Parquet column -> type to read it with. Nanosecond timestamps
# cannot be read as such; they arrive as longs.
_READ_TYPES = {
    "int8": "int", "int16": "int", "int32": "int", "int64": "bigint",
    "uint8": "int", "uint16": "int", "uint32": "bigint",
    "float": "float", "double": "double", "bool": "boolean",
    "string": "string", "large_string": "string", "date32[day]": "date",
}


def _read_type(arrow_type: str) -> str | None:
    """Read type of a column, or None if it has nothing to read."""
    if arrow_type == "null":
        return None
    if arrow_type.startswith("timestamp[ns"):
        return "bigint"
    if arrow_type == "timestamp[int96]":
        return "timestamp"
    if arrow_type.startswith("timestamp["):
        return "timestamp" if "tz=" in arrow_type else "timestamp_ntz"
    if arrow_type.startswith("dictionary<values=string"):
        return "string"
    decimal = re.fullmatch(r"decimal\d+\((\d+), (-?\d+)\)", arrow_type)
    if decimal:
        return f"decimal({decimal[1]},{decimal[2]})"
    # Types no recording has (lists, times, ...) are treated like a column of nulls.
    return _READ_TYPES.get(arrow_type)


def _canonical(name: str, arrow_type: str | None, wanted: str):
    """Column expression that brings a file's column to its canonical type."""
    if arrow_type is None or _read_type(arrow_type) is None:
        return F.lit(None).cast(wanted).alias(name)
    column = F.col(name)
    if arrow_type.startswith("timestamp[ns"):
        # Whole microseconds; the last three digits are cut (downwards, in integers).
        column = F.timestamp_micros(F.expr(f"(`{name}` - pmod(`{name}`, 1000)) div 1000"))
    if arrow_type in ("float", "double"):
        column = F.when(~F.isnan(column), column)
    return column.cast(wanted).alias(name)


def wanted_columns(signal: str) -> dict[str, str]:
    """Canonical column types of one signal's recordings."""
    return {**RECORDING_TYPES, **{source: "double" for source, _ in SENSORS[signal]}}


def scan(
    spark: SparkSession, checked: DataFrame, signal: str, first_rows: int = -1
) -> DataFrame:
    """All recordings of one signal, with canonical columns and physical row order.

    ``first_rows`` keeps that many rows of each file, before anything is derived; -1
    keeps all. The limit is a filter on the row index, so it reaches the scan. What the
    file name says is worked out once per file and joined on, not once per row.
    """
    prepare(spark)
    wanted = wanted_columns(signal)
    parts = []
    relevant = F.filter("columns", lambda c: c["name"].isin(list(wanted)))
    usable = materialise(checked.where((F.col("signal") == signal) & F.col("readable")))
    file = F.col("file_name")
    named = usable.select(
        "file_name",
        names.participant(file).alias("participant_id"),
        names.recording_part(file, 2).alias("signal"),
        names.recording_part(file, 3).alias("side"),
        names.subject_number(file).alias("subject_id"),
        names.padded_subject(file).alias("src_subject_id"),
        names.wrist_position(file).alias("device_position"),
    ).distinct()
    small = usable.count() <= BROADCAST_SERIES
    for layout, paths in tree.paths_by_layout(usable, F.sort_array(relevant)):
        found = dict(layout)
        readable = {n: _read_type(t) for n, t in found.items() if _read_type(t) is not None}
        schema = ", ".join(f"`{n}` {t}" for n, t in readable.items()) or "_none string"
        raw = spark.read.schema(schema).parquet(*paths)
        raw = raw.withColumn("row_index", F.col("_metadata.row_index")).withColumn(
            "file_name", F.col("_metadata.file_name")
        )
        if first_rows >= 0:
            raw = raw.where(F.col("row_index") < first_rows)
        rows = raw.select(
            "file_name",
            "row_index",
            F.lit("day_of_study" not in found).alias("day_absent"),
            *(_canonical(n, found.get(n), t) for n, t in wanted.items()),
        )
        parts.append(attach(rows, named, ["file_name"], ["row_index"], small).drop("file_name"))
    if not parts:
        return spark.createDataFrame([], _empty_schema(wanted))
    return reduce(DataFrame.unionByName, parts)


def _empty_schema(wanted: dict[str, str]) -> str:
    fixed = (
        "participant_id string, signal string, side string, subject_id bigint, "
        "src_subject_id string, device_position int"
    )
    typed = "".join(f", `{n}` {t}" for n, t in wanted.items())
    return "row_index bigint, day_absent boolean" + typed + ", " + fixed


def unread_columns(checked: DataFrame) -> DataFrame:
    """Columns of recordings that are there but cannot be read, by their stored type."""
    entries = checked.where("readable").select(
        "path", "signal", F.explode("columns").alias("_column")
    ).select("path", "signal", "_column.name", "_column.type")
    known = [*_READ_TYPES, "null"]
    plain = F.col("type").isin(known) | F.col("type").rlike(r"^(timestamp\[|decimal\d+\(|dictionary<values=string)")
    return entries.where(~plain)


def head(rows: DataFrame, n: int, order: str = "row_index") -> DataFrame:
    """First ``n`` rows of every series."""
    return rows.where(F.col(order) < n)


def row_slice(rows: DataFrame, start: int, n: int, order: str = "row_index") -> DataFrame:
    """Rows ``start`` up to but not including ``start + n``; none if out of range."""
    if start < 0 or n <= 0:
        return rows.where(F.lit(False))
    return rows.where((F.col(order) >= start) & (F.col(order) < start + n))


def tail(
    rows: DataFrame, n: int, keys: Sequence[str] = SERIES, order: str = "row_index"
) -> DataFrame:
    """Last ``n`` rows of every series, by its dense 0-based row number."""
    keys = list(keys)
    sizes = rows.groupBy(*keys).agg((F.max(order) + 1).alias("_rows"))
    sized = attach(rows, sizes, keys, [order], broadcastable(rows, keys))
    return sized.where(F.col(order) >= F.col("_rows") - n).drop("_rows")


def as_records(rows: DataFrame, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Each row as (row, column, value) entries, values as text."""
    shown = [f for f in rows.schema if f.name not in (order, *keys)]
    texts = rows.select(*keys, order, *(F.col(f.name).cast("string") for f in shown))
    return texts.unpivot([*keys, order], [f.name for f in shown], "column", "value")


def schema_listing(rows: DataFrame) -> DataFrame:
    """Column names, types and order of a DataFrame, with its row count."""
    fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(rows.schema)]
    entries = F.array(
        *(
            F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("column"), F.lit(t).alias("type"))
            for i, n, t in fields
        )
    )
    return (
        rows.agg(F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.lit(len(fields)).alias("n_columns"), F.inline(entries))
    )


def listing_of(spark: SparkSession, base: str) -> DataFrame:
    """Recordings under ``base`` with footer facts, ready for :func:`scan`."""
    return tree.recordings(tree.with_footers(tree.list_files(spark, base), base))
