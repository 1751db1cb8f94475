"""Birth dates and their quality, selection of participants, metadata."""

import random
from datetime import date, timedelta

import pytest
from dateutil.relativedelta import relativedelta

from wearlake.operators import births, lookup
from wearlake.sources import selection, tables

VISITS = "src_subject_id string, interview_date date, interview_age int"


def test_birth_date_is_the_upper_median(spark):
    dice = random.Random(3)
    rows, wanted = [], {}
    for subject in range(60):
        visits = [
            (date(2015, 1, 1) + timedelta(days=dice.randrange(2000)), dice.choice([250, 251, 252, 300]))
            for _ in range(dice.randrange(1, 9))
        ]
        born = sorted(day - relativedelta(months=age) for day, age in visits)
        wanted[f"{subject:03d}--1"] = born[len(born) // 2]
        rows += [(f"{subject:03d}--1", day, age) for day, age in visits]
    found = births.birth_dates(spark.createDataFrame(rows, VISITS))
    assert {r.src_subject_id: r.birth_date for r in found.collect()} == wanted


def test_month_end_is_clipped_and_nulls_are_dropped(spark):
    rows = [
        ("001--1", date(2020, 3, 31), 1),
        ("002--1", date(2020, 3, 31), None),
        ("003--1", None, 12),
        ("003--1", date(2020, 1, 1), 12),
    ]
    found = births.birth_dates(spark.createDataFrame(rows, VISITS))
    assert {r.src_subject_id: r.birth_date for r in found.collect()} == {
        "001--1": date(2020, 2, 29),
        "003--1": date(2019, 1, 1),
    }


def test_quality_grades_and_verdict(spark):
    rows = [("001--1", date(2020, 1 + i, 15), 300 + i) for i in range(8)]
    rows += [("001--1", date(2020, 9, 15), 305), ("001--1", date(2020, 10, 15), 307)]
    rows += [("001--1", date(2020, 11, 15), None), ("002--1", date(2020, 1, 1), None)]
    seen = births.visit_deviations(spark.createDataFrame(rows, VISITS))
    grades = {r.interview_date: (r.calculated_age, r.deviation, r.grade) for r in seen.collect()}
    assert grades[date(2020, 3, 15)] == (302, 0, "ok")
    assert grades[date(2020, 9, 15)] == (308, 3, "bad")
    assert grades[date(2020, 10, 15)] == (309, 2, "warn")
    assert grades[date(2020, 11, 15)] == (310, None, None)
    verdict = {r.src_subject_id: r for r in births.birth_date_quality(seen).collect()}
    one = verdict["001--1"]
    assert (one.n_visits, one.n_unusable, one.n_within, one.max_deviation) == (10, 1, 8, 3)
    assert one.passed and one.acceptance_rate == 0.8 and one.avg_deviation == 0.5
    assert one.birth_date == date(1995, 1, 15)
    assert not verdict["002--1"].passed and verdict["002--1"].n_unusable == 1


def test_visit_report_is_in_order(spark):
    rows = [("002--1", date(2020, 5, 1), 3), ("001--1", date(2020, 5, 1), 3), ("001--1", date(2020, 1, 1), 3)]
    report = births.visit_report(births.visit_deviations(spark.createDataFrame(rows, VISITS)))
    kept = [(r.src_subject_id, r.interview_date.month) for r in report.collect()]
    assert kept == [("001--1", 1), ("001--1", 5), ("002--1", 5)]


def test_one_subject_with_most_visits(spark):
    """A hot subject: the counted estimates give the median of all its visits."""
    rows = [("001--1", date(2000, 1, 1) + timedelta(days=i % 97), 12) for i in range(5001)]
    found = births.birth_dates(spark.createDataFrame(rows, VISITS)).first()
    born = sorted(day - relativedelta(months=12) for _, day, _ in rows)
    assert found.birth_date == born[len(born) // 2]


def test_visits_file(spark, tmp_path):
    path = tmp_path / "visits.csv"
    path.write_text("x,src_subject_id,interview_age,interview_date\n,007--1,311.0,2019-06-17\n,2,,soon\n")
    found = [tuple(r) for r in tables.read_visits(spark, str(path)).collect()]
    assert found == [("007--1", date(2019, 6, 17), 311), ("2", None, None)]


def test_metadata_over_several_splits_keeps_file_order(spark, tmp_path):
    path = tmp_path / "metadata.csv"
    lines = [f"{i % 50},KEY{i:05d},{'FM'[i % 2]}" for i in range(2000)]
    path.write_text("src_subject_id,subjectkey,sex\n" + "\n".join(lines) + "\nx,BAD,F\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        raw = tables.read_metadata(spark, str(path))
        assert raw.rdd.getNumPartitions() > 5
        found = {r.subject_id: r.subjectkey for r in lookup.first_per_subject(raw, "row_index").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {i: f"KEY{i:05d}" for i in range(50)}


def test_selection_texts():
    parse = selection.parse_selection
    assert parse("all") is None and parse(" -1 ") is None and parse("ALL") is None
    assert parse("3") == [(3, 3)]
    assert parse("1, 3-5 ,7") == [(1, 1), (3, 5), (7, 7)]
    for bad in ("", "x", "1,,2", "1-2-3", "-2", "1;2", "3-"):
        with pytest.raises(ValueError):
            parse(bad)


def test_selection_counts_places_in_numeric_order(spark):
    people = spark.createDataFrame([(n,) for n in (100, 2, 10, 1, 3_000_000)], "subject_id int")

    def chosen(spec, by="ordinal"):
        found = selection.select_participants(people, spec, by).collect()
        return sorted((r.ordinal, r.subject_id) for r in found)

    everyone = [(1, 1), (2, 2), (3, 10), (4, 100), (5, 3_000_000)]
    assert chosen("all") == everyone
    assert chosen("2-3,2") == [(2, 2), (3, 10)]
    assert chosen("5,1") == [(1, 1), (5, 3_000_000)]
    assert chosen("10-200", "id") == [(3, 10), (4, 100)]
    assert chosen("7", "id") == []
    for bad in ("0", "6", "4-9", "3-2"):
        with pytest.raises(ValueError):
            chosen(bad)


def test_completeness_needs_every_signal(spark):
    rows = [("a", s, "left") for s in ("acc", "eda", "ibi", "temp")]
    rows += [("b", "acc", "right"), ("b", "eda", "left"), ("b", "ibi", "left"), ("b", "temp", "left")]
    found = spark.createDataFrame(rows, "folder string, signal string, side string")
    folders = spark.createDataFrame([("a",), ("b",), ("c",)], "folder string")
    either = {r.folder: r for r in selection.completeness(found, folders).collect()}
    left = {r.folder: r for r in selection.completeness(found, folders, required="left").collect()}
    assert either["a"].complete and either["b"].complete and not either["c"].complete
    assert left["a"].complete and left["b"].missing == ["acc"]
    assert either["c"].missing == ["acc", "eda", "ibi", "temp"] and either["c"].seen == []
