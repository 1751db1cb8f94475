"""Scalar output fields as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wearlake.schema import DEVICE_RULES

# fixed values: the archive's text formats
DATE_FORMAT = "MM/dd/yyyy"
TIME_FORMAT = "HH:mm"
ISO_MOMENT = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d+)?)?\s*(Z|UTC|[+-]\d{2}(:?\d{2})?)?)?\s*$"
DEVICE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def date_text(moment: Column) -> Column:
    return F.date_format(moment, DATE_FORMAT)


def time_text(moment: Column) -> Column:
    return F.date_format(moment, TIME_FORMAT)


def device_timestamp(moment: Column) -> Column:
    """Instant with six fraction digits."""
    return F.date_format(moment, DEVICE_TIME_FORMAT)


def day_code(local: Column) -> Column:
    """1 on Friday and Saturday, 0 on other days, null without a date."""
    weekday = F.weekday(local)
    return F.when(weekday.isNotNull(), weekday.isin(4, 5).cast("int"))


def device_type(subject_id: Column, rules=DEVICE_RULES) -> Column:
    """Device name by subject number; empty text outside every rule."""
    name = F.lit("")
    for first, last, device in reversed(rules):
        name = F.when(subject_id.between(first, last), F.lit(device)).otherwise(name)
    return F.when(subject_id.isNotNull(), name)


def study_day_number(day_of_study: Column, day_absent: Column) -> Column:
    """1-based study day; 1 on every row where the recording has no such column."""
    return F.when(day_absent, F.lit(1)).otherwise(day_of_study + 1).cast("int")


def parse_moment(text: Column) -> Column:
    """ISO-8601 text with any number of fraction digits; null if it is none.

    A date is needed: a bare time, which Spark would place on the current day, is none.
    """
    return F.when(text.rlike(ISO_MOMENT), text.try_cast("timestamp"))


def padded_number(number: Column) -> Column:
    """Number as text of at least three digits; longer ones stay whole."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(3)), F.lit("0"))


def subject_code(subject_id: Column) -> Column:
    """Subject number as visits spell it: at least three digits, then ``--1``."""
    return F.concat(padded_number(subject_id), F.lit("--1"))
