"""CSV output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.schema import SERIES
from wearlake.session import prepare
from wearlake.sources import files as tree

# How CSV is written and read here: quotes doubled, blanks kept, microseconds.
CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
_WRITTEN = {
    **CSV,
    "emptyValue": "",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def write_csv(
    rows: DataFrame,
    path: str,
    keys: Sequence[str] = SERIES,
    order: str = "row_index",
    file_rows: int | None = None,
) -> None:
    """CSV with header, blanks for nulls, one directory per series.

    The directory names carry the key, so the key columns are not repeated in the
    data. Rows are written where they are: no shuffle, no single-file bottleneck. A
    column ``order`` gives the row order within each file and is not written itself;
    the writer sorts by the key anyway, so this is no further sort.

    With ``file_rows`` the files are planned: ``order`` must be the row number from 0, and
    the n-th ``file_rows`` rows of a series are its n-th file, whichever task they came
    from. A series has as few files as its rows need, however many tasks held them; its
    files are still written by many tasks.
    """
    if file_rows is not None:
        plan = F.expr(f"`{order}` div {int(file_rows)}L")
        rows = rows.withColumn("_file", plan).repartition(*keys, "_file")
        rows = rows.sortWithinPartitions(*keys, "_file", order).drop("_file", order)
    elif order in rows.columns:
        rows = rows.sortWithinPartitions(*keys, order).drop(order)
    writer = rows.write.mode("overwrite").partitionBy(*keys).options(**_WRITTEN)
    if file_rows is not None:
        # A task that holds several files of a series begins a new one after each.
        writer = writer.option("maxRecordsPerFile", int(file_rows))
    writer.csv(path)


def whole_moments(rows: DataFrame, source: str) -> DataFrame:
    """Nanosecond columns of a Parquet ``source``, read as longs, as moments in microseconds.

    Footers tell which columns these are.
    """
    spark = rows.sparkSession
    paths = [(None, None, path, 1) for path in spark.read.format("binaryFile").load(source).select("path").toPandas()["path"]]
    listed = spark.createDataFrame(paths, tree.FILE_SCHEMA)
    footers = tree.with_footers(listed, tree.filesystem_root(spark, source))
    kinds = footers.select(F.explode("columns").alias("c")).where(F.col("c.type").startswith("timestamp[ns"))
    names = {row[0] for row in kinds.select("c.name").distinct().collect()}
    return rows.select(
        *(
            F.timestamp_micros(F.expr(f"(`{name}` - pmod(`{name}`, 1000)) div 1000")).alias(name)
            if name in names
            else F.col(f"`{name}`")
            for name in rows.columns
        )
    )


def copy_parquet_to_csv(
    spark: SparkSession, source: str, target: str, first_rows: int
) -> None:
    """The first ``first_rows`` rows of each Parquet file, -1 for all, all columns, as CSV."""
    rows = prepare(spark).read.parquet(source)
    if first_rows >= 0:
        rows = rows.where(f"_metadata.row_index < {int(first_rows)}")
    whole_moments(rows, source).write.mode("overwrite").options(**_WRITTEN).csv(target)
