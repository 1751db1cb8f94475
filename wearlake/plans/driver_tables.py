"""The given tables, seen as a wearable study.

``events`` plays the recordings (one series per user and event type, or per event
type), ``supplier`` the subject metadata and ``orders`` the visits. Everything is
derived from whole tables; nothing is left out.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.functions import fields
from wearlake.functions.months import completed_months
from wearlake.session import prepare, scratch_path
from wearlake.sources import files

SERIES = ("user_id", "event_type")
SIGNAL = ("event_type",)

# Zones dealt out to users in turn: whole and broken offsets, one beyond the allowed
# bounds, one without letters, one unknown, one empty.
ZONES = (
    "America/New_York", "America/St_Johns", "Pacific/Auckland", "Asia/Kolkata",
    "Nowhere/Unknown", "", "UTC", "America/Sao_Paulo",
)
AS_OF = datetime(2024, 1, 15, 12, 0, tzinfo=timezone.utc)

# Event types dealt out to signals; the last one is no recording.
SIGNAL_OF = {"click": "acc", "view": "eda", "purchase": "ibi", "signup": "temp", "error": "bvp"}

STUDY_START = "2024-01-01"
FIRST_BIRTH = "1970-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the columns a recording has; ``event_id`` is the row order."""
    events = table(spark, sf_dir, "events")
    zones = F.array(*(F.lit(zone) for zone in ZONES))
    k = F.regexp_extract("props", r'"k":\s*(\d+)', 1).cast("int")
    return events.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.col("user_id").cast("bigint").alias("subject_id"),
        fields.padded_number(F.col("user_id")).alias("src_subject_id"),
        F.pmod("event_id", F.lit(2)).cast("int").alias("device_position"),
        F.col("ts").cast("timestamp").alias("timestamp_utc"),
        (F.col("ts") - F.expr("INTERVAL 5 HOURS")).alias("timestamp_local"),
        F.element_at(zones, (F.pmod("user_id", F.lit(len(ZONES))) + 1).cast("int")).alias("timezone"),
        F.datediff("ts", F.lit(STUDY_START)).alias("day_of_study"),
        F.lit(False).alias("day_absent"),
        k.alias("k"),
        (k < 90).cast("int").alias("device_worn"),
        (k + 200).alias("interview_age"),
        F.concat(F.lit("watch "), "event_type").alias("mt_pilot_vib_device"),
        # sensor columns
        F.col("value").alias("x_g"),
        (-F.col("value")).alias("y_g"),
        k.cast("double").alias("z_g"),
        F.col("value").alias("eda"),
        F.col("value").alias("ibi"),
        F.col("value").alias("temp"),
    )


STUDY_PARTICIPANTS = 12


def study_tree(spark: SparkSession, sf_dir: str) -> str:
    """All events as a study's folder: a recording for each participant, signal and wrist side.

    Users are dealt to a fixed number of participants, so that recordings grow with the
    table. There are recordings of a signal that no study asks for, a file without a byte
    and a participant's folder without files.
    """
    base, parts = scratch_path(spark, "study"), scratch_path(spark, "parts")
    signal = F.create_map(*(F.lit(x) for pair in SIGNAL_OF.items() for x in pair))
    keys = ["participant", "signal", "side"]
    rows = recordings(spark, sf_dir).select(
        (F.pmod("user_id", F.lit(STUDY_PARTICIPANTS)) + 1).cast("int").alias("participant"),
        signal[F.col("event_type")].alias("signal"),
        F.when(F.col("device_position") == 0, "left").otherwise("right").alias("side"),
        "event_id", "timestamp_utc", "timestamp_local", "timezone", "day_of_study", "device_worn",
        "x_g", "y_g", "z_g", "eda", "ibi", "temp",
    )
    rows = rows.repartition(*keys).sortWithinPartitions(*keys, "event_id").drop("event_id")
    rows.write.partitionBy(*keys).parquet(parts)
    for row in rows.select(*keys).distinct().collect():
        folder = f"{parts}/participant={row.participant}/signal={row.signal}/side={row.side}"
        name = f"SP{row.participant}_e4_{row.signal}_{row.side}.parquet"
        files.place_part(spark, folder, f"{base}/SP{row.participant}/{name}")
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(f"{base}/SP{STUDY_PARTICIPANTS + 1}"))
    system.create(path(f"{base}/SP1/SP1_e4_eda_left_old.parquet")).close()
    return base


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per subject, so that the first one counts; some users have none."""
    suppliers = table(spark, sf_dir, "supplier")
    return suppliers.select(
        F.expr("s_suppkey div 2").cast("bigint").alias("src_subject_id"),
        F.col("s_name").alias("subjectkey"),
        F.when(F.pmod("s_nationkey", F.lit(2)) == 0, "F").otherwise("M").alias("sex"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as visits: ages reported from a known birth date, up to two months off.

    Pending urgent orders report no age.
    """
    orders = table(spark, sf_dir, "orders")
    silent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "P")
    age = completed_months(birth(), F.col("o_orderdate")) + F.pmod("o_orderkey", F.lit(3))
    return orders.select(
        "o_orderkey",
        fields.subject_code(F.col("o_custkey").cast("bigint")).alias("src_subject_id"),
        F.to_date("o_orderdate").alias("interview_date"),
        F.when(~silent, age).cast("int").alias("interview_age"),
    )


def birth(first: str = FIRST_BIRTH):
    """The date a customer is taken to be born."""
    days = F.pmod("o_custkey", F.lit(9000)).cast("int")
    return F.date_add(F.lit(first).cast("date"), days)


def folders(rows: DataFrame) -> DataFrame:
    """Recordings as files: a folder per user and day, a signal, a wrist side."""
    signal = F.create_map(*(F.lit(x) for pair in SIGNAL_OF.items() for x in pair))
    return rows.select(
        F.concat_ws("/", F.concat(F.lit("SP"), "user_id"), F.col("day_of_study").cast("string")).alias(
            "folder"
        ),
        signal[F.col("event_type")].alias("signal"),
        F.when(F.col("device_position") == 0, "left").otherwise("right").alias("side"),
    )


def file_paths(rows: DataFrame) -> DataFrame:
    """A file path per event, most named like a recording, some not."""
    signal = F.create_map(*(F.lit(x) for pair in SIGNAL_OF.items() for x in pair))
    side = F.when(F.col("device_position") == 0, "left").otherwise("right")
    usual = F.concat(
        F.lit("SP"), "src_subject_id", F.lit("_e4_"), signal[F.col("event_type")], F.lit("_"), side,
        F.lit(".parquet"),
    )
    short = F.concat(F.lit("SP"), "user_id", F.lit("_RIGHT.parquet"))
    name = F.when(F.col("k") < 80, usual).otherwise(short)
    folder = F.when(F.col("k") % 2 == 0, F.concat(F.lit("/study/SP"), "user_id")).otherwise("/study/raw")
    return rows.select("event_id", F.concat(folder, F.lit("/"), name).alias("path"))
