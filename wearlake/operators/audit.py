"""Health of Parquet files: footer facts against what a scan really yields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.session import prepare
from wearlake.sources.files import paths_by_layout, scanned_path


def audit(spark: SparkSession, checked: DataFrame) -> DataFrame:
    """One row per file of the footer listing ``checked``, with a verdict.

    Readable files are then scanned with every column decoded; unreadable pages end a
    file early, so fewer scanned rows than the footer promises mean damage. Files with
    the same columns are scanned together.
    """
    prepare(spark)
    scanned = None
    for _, paths in paths_by_layout(checked.where("readable"), F.col("columns")):
        raw = spark.read.option("ignoreCorruptFiles", True).parquet(*paths)
        decoded = F.xxhash64(*(F.col(f"`{name}`") for name in raw.columns))
        counted = (
            raw.select(F.col("_metadata.file_path").alias("_uri"), decoded.alias("_hash"))
            .groupBy("_uri")
            .agg(F.count("_hash").alias("n_scanned"), F.bit_xor("_hash").alias("content_hash"))
        )
        scanned = counted if scanned is None else scanned.unionByName(counted)
    extension_ok = F.lower(F.col("file_name")).endswith(".parquet")
    report = checked.withColumn("extension_ok", extension_ok)
    if scanned is None:
        report = report.withColumn("n_scanned", F.lit(None).cast("bigint")).withColumn(
            "content_hash", F.lit(None).cast("bigint")
        )
    else:
        scanned = scanned.withColumn("path", scanned_path(F.col("_uri")))
        report = report.join(scanned.drop("_uri"), "path", "left")
    n_scanned = F.when(F.col("readable"), F.coalesce(F.col("n_scanned"), F.lit(0)))
    return (
        report.withColumn("n_scanned", n_scanned)
        .withColumn("ok", F.coalesce(F.col("readable") & (F.col("n_scanned") == F.col("n_rows")), F.lit(False)))
        .withColumn(
            "problem",
            F.when(F.col("length") == 0, "empty")
            .when(~F.col("readable"), "unreadable")
            .when(~F.col("ok"), "damaged"),
        )
    )


def column_listing(checked: DataFrame) -> DataFrame:
    """Columns of each readable file with their order and stored types."""
    return checked.where(F.col("readable")).select(
        "path", "n_rows", "n_columns", F.posexplode("columns").alias("ordinal", "_column")
    ).select("path", "n_rows", "n_columns", "ordinal", "_column.name", "_column.type")
