"""Conversion of recordings to the archive's columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlake.functions import fields
from wearlake.functions.months import age_in_months
from wearlake.functions.zones import zone_fields
from wearlake.operators.keyed import attach, broadcastable, materialise
from wearlake.operators.summary import bound_texts, series_summary
from wearlake.schema import COMMON_OUTPUT, SENSORS, SERIES, output_columns


def series_scalars(
    rows: DataFrame,
    subjects: DataFrame,
    births: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "row_index",
    as_of: datetime | None = None,
) -> DataFrame:
    """Everything that is constant within a recording, one row per recording.

    ``subjects`` has one row per ``subject_id`` (metadata), ``births`` one per subject
    code. These joins run on one row per recording, not on the samples.
    """
    keys = list(keys)
    summary = series_summary(rows, [*keys, "subject_id"], order)
    zone = zone_fields(F.col("zone"), as_of)
    return (
        summary.withColumn("_zone", zone)
        .withColumn("_code", fields.subject_code(F.col("subject_id")))
        .join(subjects, "subject_id", "left")
        .join(births.withColumnRenamed("src_subject_id", "_code"), "_code", "left")
        .select(
            *keys, "subjectkey", "sex", "birth_date",
            "length_per", "max_devdays", "actual_devdays",
            F.col("_zone.abbreviation").alias("site_time_zone"),
            F.col("_zone.utc_offset").alias("utc_offset"),
            *bound_texts(F.col("first_utc"), F.col("last_utc")),
        )
    )


def convert(
    rows: DataFrame,
    signal: str,
    subjects: DataFrame,
    births: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = "row_index",
    as_of: datetime | None = None,
    rounding: str = "floor",
    age: str = "derive",
    device: str = "rules",
    sensors: str = "by_signal",
    small: bool | None = None,
    keep_order: bool = False,
    series_rows: int | None = None,
    freeze: bool = False,
) -> DataFrame:
    """Archive columns of one signal, with the series key in front.

    ``age="passthrough"`` and ``device="passthrough"`` keep the columns the recording
    brings, as older layouts do (those have no ``watch_device_type``); the oldest one
    has the skin temperature alone for every signal, ``sensors="temp"``. Samples are not
    shuffled: the scalars are broadcast if ``small``, which is measured if not given.
    ``keep_order`` adds the row order column after the key. ``series_rows`` bounds the rows
    of a series that one task joins where scalars are not broadcast. ``freeze`` writes the
    scalars, one row for each recording, so that several passes need not work them out again.
    """
    keys = list(keys)
    if small is None:
        small = broadcastable(rows, keys)
    scalars = series_scalars(rows, subjects, births, keys, order, as_of)
    if freeze:
        scalars = materialise(scalars)
    local = F.col("timestamp_local")
    computed = {
        "interview_date": fields.date_text(local),
        "interview_age": age_in_months(F.col("birth_date"), local, rounding),
        "mt_pilot_vib_device": fields.device_type(F.col("subject_id")),
        "watch_device_type": fields.device_type(F.col("subject_id")),
        "tlfb_daynum": fields.study_day_number(F.col("day_of_study"), F.col("day_absent")),
        "day_code": fields.day_code(local),
        "device_timestamp": fields.device_timestamp(F.col("timestamp_utc")),
        **{out: F.col(source) for source, out in SENSORS[signal]},
    }
    columns = output_columns(signal)
    if sensors == "temp":
        columns = [*COMMON_OUTPUT, "skin_temp"]
        temp = F.col("temp") if "temp" in rows.columns else F.lit(None).cast("double")
        computed["skin_temp"] = temp
    if age == "passthrough":
        computed["interview_age"] = F.col("interview_age")
    if device == "passthrough":
        computed["mt_pilot_vib_device"] = F.col("mt_pilot_vib_device")
        columns.remove("watch_device_type")
    full = attach(rows, scalars, keys, [order], small, series_rows)
    return full.select(
        *keys,
        *([order] if keep_order else []),
        *(computed[name].alias(name) if name in computed else F.col(name) for name in columns),
    )
