"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.session import scratch_dir

# The white space that parts words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

# Rows handed to a Python task at a time; a batch of long texts stays small.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python task holds of whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def kept(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage in a form that survives lost executors and lets each later pass
    read only its columns. The folder goes when the session ends.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/llm-{uuid.uuid4().hex}"
    java_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    java_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(java_path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK_RUN))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for work columns that clash with no column of ``df``."""
    taken = {column.lower() for column in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        found.append(name)
    return found
