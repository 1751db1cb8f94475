"""Scalar expressions against Python's own date and zone libraries."""

import random
import zoneinfo
from datetime import date, datetime, timedelta, timezone

import pytest
import pytz
from dateutil.relativedelta import relativedelta
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wearlake.functions import fields, names
from wearlake.functions.months import age_in_months, chronological_months, completed_months
from wearlake.functions.zones import zone_fields


def months_apart(born, at):
    span = relativedelta(at, born)
    return span.years * 12 + span.months


def evaluated(spark, pairs, expression):
    df = spark.createDataFrame(pairs, "i int, born date, at date")
    return dict(df.select("i", expression(F.col("born"), F.col("at"))).collect())


def test_completed_months_on_random_and_edge_dates(spark):
    dice = random.Random(7)
    base = date(1960, 1, 1)
    dates = [base + timedelta(days=dice.randrange(26000)) for _ in range(6000)]
    edges = [
        date(y, m, d)
        for y in (1999, 2000, 2020, 2021)
        for m, d in ((1, 28), (1, 29), (1, 30), (1, 31), (2, 28), (3, 1), (3, 31), (4, 30), (12, 31))
    ] + [date(2000, 2, 29), date(2020, 2, 29)]
    pairs = list(zip(dates[::2], dates[1::2])) + [(a, b) for a in edges for b in edges]
    numbered = [(i, a, b) for i, (a, b) in enumerate(pairs)]
    found = evaluated(spark, numbered, completed_months)
    assert found == {i: months_apart(a, b) for i, a, b in numbered}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(date(1950, 1, 1), date(2030, 1, 1)), min_size=40, max_size=60))
def test_completed_months_property(spark, days):
    numbered = [(i, a, b) for i, (a, b) in enumerate((a, b) for a in days for b in days)]
    found = evaluated(spark, numbered, completed_months)
    assert found == {i: months_apart(a, b) for i, a, b in numbered}


def test_chronological_months_follow_the_sixteen_day_rule(spark):
    born = date(1995, 7, 30)
    cases = {date(2020, 1, 28): 294, date(2020, 3, 28): 296, date(2020, 3, 30): 296}
    numbered = [(i, born, at) for i, at in enumerate(cases)]
    found = evaluated(spark, numbered, chronological_months)
    assert list(found.values()) == list(cases.values())
    days = [(i, date(2020, 5, 10), date(2020, 5, 10) + timedelta(days=i)) for i in range(30)]
    found = evaluated(spark, days, chronological_months)
    assert [found[i] for i in (0, 15, 16, 29)] == [0, 0, 1, 1]


def test_ages_of_missing_dates_are_missing(spark):
    rows = [(0, None, date(2020, 1, 1)), (1, date(2020, 1, 1), None), (2, None, None)]
    for rule in ("floor", "chronological"):
        found = evaluated(spark, rows, lambda a, b: age_in_months(a, b, rule))  # noqa: B023
        assert set(found.values()) == {None}


def test_day_code_is_one_on_friday_and_saturday(spark):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(7)] + [None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    found = [r[0] for r in df.select(fields.day_code(F.col("d"))).collect()]
    assert found == [0, 0, 0, 0, 1, 1, 0, None]


def test_device_timestamp_keeps_six_digits(spark):
    moment = datetime(2020, 3, 1, 4, 5, 6, 700, tzinfo=timezone.utc)
    df = spark.createDataFrame([(moment,)], "t timestamp")
    row = df.select(fields.device_timestamp(F.col("t")), fields.time_text(F.col("t"))).first()
    assert tuple(row) == ("2020-03-01 04:05:06.000700", "04:05")


def test_device_type_by_subject_number(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 83, 84, 1234, None)], "n int")
    found = [r[0] for r in df.select(fields.device_type(F.col("n"))).collect()]
    assert found == ["", "Empatica E4", "Empatica E4", "", "", None]


def test_subject_code_does_not_cut_long_numbers(spark):
    df = spark.createDataFrame([(n,) for n in (1, 12, 123, 1234)], "n int")
    found = [r[0] for r in df.select(fields.subject_code(F.col("n"))).collect()]
    assert found == ["001--1", "012--1", "123--1", "1234--1"]


NAMES = {
    "SP114_e4_ibi_left.parquet": ("SP114", "ibi_left", "114", 114, 0, True, "ibi", "left"),
    "/a/SP2/SP2_e4_acc_right.parquet": ("SP2", "acc_right", "002", 2, 1, True, "acc", "right"),
    "SP1234_e4_temp_left.parquet": ("SP1234", "temp_left", "1234", 1234, 0, True, "temp", "left"),
    "PS7_x_y_RIGHT_z.parquet": ("SP7", "y_RIGHT", "007", 7, 1, False, None, None),
    "SP5_e4.parquet": ("SP5", "unknown", "005", 5, None, False, None, None),
    "SPx_e4_eda_left.parquet": ("SPx", "eda_left", "00x", None, 0, False, None, None),
    "SP1_e4_bvp_left.parquet": ("SP1", "bvp_left", "001", 1, 0, False, None, None),
    "SP1_e4_eda_left.parquet.bak": ("SP1", "eda_left.bak", "001", 1, 0, False, None, None),
    "SP3_rightleft": ("SP3", "unknown", "003", 3, 0, False, None, None),
}


def test_names_are_taken_apart(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "path string")
    p = F.col("path")
    parts = df.select(
        p, names.participant(p), names.data_type(p), names.padded_subject(p), names.subject_number(p),
        names.wrist_position(p), names.is_recording(p), names.recording_part(p, 2),
        names.recording_part(p, 3),
    )
    assert {r[0]: tuple(r)[1:] for r in parts.collect()} == NAMES


def test_participant_in_path(spark):
    df = spark.createDataFrame([("/x/SP12/SP3",), ("/x/sp12",), ("",)], "path string")
    found = [r[0] for r in df.select(names.participant_in_path(F.col("path"))).collect()]
    assert found == ["SP12", "UNKNOWN", "UNKNOWN"]


@pytest.mark.parametrize("moment", [datetime(2024, 1, 15, 12), datetime(2024, 7, 15, 12)])
def test_zone_fields_of_every_zone(spark, moment):
    # MET became a link to another zone; which one is installed depends on the machine.
    zones = sorted((zoneinfo.available_timezones() & set(pytz.all_timezones)) - {"MET"})
    df = spark.createDataFrame([(z,) for z in zones], "zone string")
    found = {
        r.zone: (r.z.abbreviation, r.z.utc_offset)
        for r in df.select("zone", zone_fields(F.col("zone"), moment).alias("z")).collect()
    }
    for zone in zones:
        local = pytz.utc.localize(moment).astimezone(pytz.timezone(zone))
        hours = int(local.utcoffset().total_seconds() / 3600)
        expected = (local.strftime("%Z"), hours if -11 <= hours <= 12 else None)
        assert found[zone] == expected, zone


def test_zone_fields_of_odd_names(spark):
    odd = ["", None, "Nowhere", "america/new_york", "../etc/passwd"]
    df = spark.createDataFrame([(z,) for z in odd], "zone string")
    moment = datetime(2024, 1, 15, 12)
    found = [tuple(r.z) for r in df.select(zone_fields(F.col("zone"), moment).alias("z")).collect()]
    assert found == [(None, None), (None, None), ("Nowhere", None), ("EST", -5), ("../etc/passwd", None)]


def test_moments_are_parsed_or_null(spark):
    texts = ["2020-01-02 03:04:05", "2020-01-02T03:04:05.6Z", "2020-01-02 03:04:05.123456", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    micros = [r[0] for r in df.select(F.unix_micros(fields.parse_moment(F.col("t")))).collect()]
    base = 1577934245000000
    assert micros == [base, base + 600000, base + 123456, None, None]
