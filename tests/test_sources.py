"""Row access to Parquet and CSV files, layouts, contract and dictionary."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.operators import contract
from wearlake.operators.audit import audit, column_listing
from wearlake.schema import SIGNALS, output_columns, template_columns
from wearlake.sources import files, recordings, sinks, tables


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_rows_are_numbered_over_splits(spark, tmp_path, small_splits):
    for name, n in (("a", 900), ("b", 5)):
        pd.DataFrame({"v": range(n)}).to_csv(tmp_path / f"{name}.csv", index=False)
    raw = spark.read.option("header", True).csv(str(tmp_path))
    rows = tables.with_csv_rows(raw.withColumn("file", F.col("_metadata.file_name")))
    wrong = rows.where(F.col("v").cast("long") != F.col("row_index"))
    assert wrong.count() == 0 and rows.count() == 905
    last = recordings.tail(rows, 3, ["file"])
    assert sorted((r.file, int(r.v)) for r in last.collect()) == [
        ("a.csv", 897), ("a.csv", 898), ("a.csv", 899), ("b.csv", 2), ("b.csv", 3), ("b.csv", 4),
    ]


def test_csv_rows_run_on_through_the_files_of_a_series(spark, tmp_path, small_splits):
    n = {"hot": 3000, "cold": 40, None: 7}
    rows = spark.createDataFrame([(k, i) for k, size in n.items() for i in reversed(range(size))], "kind string, v long")
    ranges = rows.repartitionByRange(5, "kind", "v").sortWithinPartitions("kind", "v")
    sinks.write_csv(ranges, str(tmp_path / "out"), ["kind"], order="_none")
    raw = spark.read.schema("v long, kind string").options(**sinks.CSV).csv(str(tmp_path / "out"))
    read = tables.with_csv_rows(raw.withColumn("file", F.col("_metadata.file_name")), keys=["kind"])
    found = read.collect()
    assert len({r.file for r in found if r.kind == "hot"}) > 1
    assert sorted((str(r.kind), r.v, r.row_index) for r in found) == sorted(
        (str(k), i, i) for k, size in n.items() for i in range(size)
    )


def test_files_are_read_by_extension(spark, tmp_path):
    frame = pd.DataFrame({"v": range(50), "w": [f"t{i}" for i in range(50)]})
    frame.to_csv(tmp_path / "x.csv", index=False)
    frame.to_parquet(tmp_path / "x.PARQUET")
    for name in ("x.csv", "x.PARQUET"):
        rows = tables.read_any(spark, str(tmp_path / name))
        head = recordings.head(rows, 3).collect()
        assert sorted((int(r.v), r.w, r.row_index) for r in head) == [(i, f"t{i}", i) for i in range(3)]
        part = recordings.row_slice(rows, 48, 10).collect()
        assert sorted(int(r.v) for r in part) == [48, 49]
    with pytest.raises(ValueError):
        tables.read_any(spark, str(tmp_path / "x.json"))


@pytest.mark.parametrize("start, n", [(-1, 5), (50, 5), (0, 0)])
def test_slice_out_of_range_is_empty(spark, start, n):
    rows = spark.range(50).withColumnRenamed("id", "row_index")
    assert recordings.row_slice(rows, start, n).count() == 0


def test_records_are_shown_column_by_column(spark):
    df = spark.createDataFrame([(7, 1.5, None)], "row_index bigint, a double, b string")
    found = [tuple(r) for r in recordings.as_records(df, "row_index").collect()]
    assert sorted(found, key=str) == [(7, "a", "1.5"), (7, "b", None)]


def test_schema_listing(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, b string")
    found = [tuple(r) for r in recordings.schema_listing(df).collect()]
    assert found == [(2, 2, 0, "a", "int"), (2, 2, 1, "b", "string")]


def test_column_listing_of_files(spark, study):
    listed = recordings.listing_of(spark, study.base).where("signal = 'eda' and subject_id = 2")
    found = {r.name: r.type for r in column_listing(listed).collect()}
    assert found["timestamp_utc"] == "timestamp[ns, tz=UTC]" and found["eda"] == "double"


def test_bounded_copy(spark, tmp_path):
    pd.DataFrame({"v": range(3000), "w": None}).to_parquet(tmp_path / "x.parquet")
    sinks.copy_parquet_to_csv(spark, str(tmp_path / "x.parquet"), str(tmp_path / "out"), 2000)
    read = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted(int(r.v) for r in read.collect()) == list(range(2000))
    sinks.copy_parquet_to_csv(spark, str(tmp_path / "x.parquet"), str(tmp_path / "few"), 7)
    assert spark.read.option("header", True).csv(str(tmp_path / "few")).count() == 7


def test_single_level_listing(spark, study):
    found = files.single_level(spark, f"{study.base}/SP2", "%.parquet").collect()
    assert sorted(r.file_name for r in found) == [f"SP2_e4_{s}_left.parquet" for s in SIGNALS]


# ---- contract ---------------------------------------------------------------------


def test_layouts():
    assert len(template_columns("acc")) == 22 and len(template_columns("ibi")) == 20
    for signal in SIGNALS:
        found = contract.layout_differences(output_columns(signal), template_columns(signal))
        assert found == {"missing": [], "extra": ["device_position"]}


def test_conform_adds_typed_nulls_in_order(spark):
    df = spark.createDataFrame([("M", 5.0)], "sex string, extra double")
    found = contract.conform(df, ["interview_age", "sex", "eda_us", "interview_date"])
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("interview_age", "int"), ("sex", "string"), ("eda_us", "double"), ("interview_date", "date"),
    ]
    assert tuple(found.first()) == (None, "M", None, None)


def test_broken_rules_are_counted_with_a_sample(spark):
    schema = (
        "series string, row_index bigint, subjectkey string, sex string, interview_age string, "
        "interview_date string, utc_offset int, dc_start_time string, eda_us string"
    )
    good = ("NDAR1", "NR", "300", "01/31/2020", -11, "10:30", "0.5")
    data = [
        ("a", 0, *good),
        ("a", 1, "X1", "N", "1441", "2020-01-31", 13, "10:30:00", "much"),
        ("a", 2, "X2", "M;F", "old", "02/30/2020", 12, "9:00", "1e-3"),
        ("b", 0, *good),
        ("b", 1, None, None, None, None, None, None, None),
    ]
    found = contract.validate(spark.createDataFrame(data, schema), ["series"])
    bad = {
        (r.series, r.column, r.rule): (r.bad_rows, r.first_bad_row, r.sample)
        for r in found.collect() if r.bad_rows
    }
    assert bad == {
        ("a", "subjectkey", "prefix"): (2, 1, "X1"),
        ("a", "sex", "choice"): (2, 1, "N"),
        ("a", "interview_age", "type"): (1, 2, "old"),
        ("a", "interview_age", "range"): (1, 1, "1441"),
        ("a", "interview_date", "type"): (2, 1, "2020-01-31"),
        ("a", "utc_offset", "range"): (1, 1, "13"),
        ("a", "dc_start_time", "size"): (1, 1, "10:30:00"),
        ("a", "eda_us", "type"): (1, 1, "much"),
    }
    assert found.groupBy("series").count().where("count <> 10").count() == 0


def test_dictionary_file_with_required_column(spark, tmp_path):
    path = tmp_path / "dictionary.csv"
    path.write_text(
        '"ElementName","DataType","Size","Required","ElementDescription","ValueRange","Notes","Aliases"\n'
        '"sex","String","20","Required","Sex, ""at birth""","M;F","",""\n'
        '"score","Integer","","Recommended","","0 :: 10","",""\n'
    )
    elements = contract.read_dictionary(spark, str(path))
    assert elements == [
        contract.Element("sex", "String", 20, "M;F", True),
        contract.Element("score", "Integer", None, "0 :: 10", False),
    ]
    df = spark.createDataFrame(
        [("a", 0, None, 11), ("a", 1, "F", None)], "series string, row_index bigint, sex string, score int"
    )
    found = contract.validate(df, ["series"], dictionary=elements)
    bad = {(r.column, r.rule): r.bad_rows for r in found.collect() if r.bad_rows}
    assert bad == {("sex", "required"): 1, ("score", "range"): 1}


def test_names_with_signs_and_empty_files(spark, tmp_path):
    for name in ("a%20b c+d.parquet", "100%.parquet"):
        pd.DataFrame({"v": [1, 2]}).to_parquet(tmp_path / name)
    (tmp_path / "none.parquet").touch()
    base = str(tmp_path)
    found = audit(spark, files.with_footers(files.single_level(spark, base, "%.parquet"), base)).collect()
    assert {r.file_name: (r.ok, r.problem) for r in found} == {
        "a%20b c+d.parquet": (True, None),
        "100%.parquet": (True, None),
        "none.parquet": (False, "empty"),
    }


def test_row_numbers_survive_other_splits(spark, tmp_path):
    pd.DataFrame({"v": range(20_000)}).to_csv(tmp_path / "x.csv", index=False)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        read = tables.read_any(spark, str(tmp_path / "x.csv"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
        rows = read.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((int(r.v), r.row_index) for r in rows) == [(i, i) for i in range(20_000)]


def test_csv_keeps_texts(spark, tmp_path):
    texts = ["  pad ", 'q"uo', "a\nb", "back\\slash", "1,2"]
    frame = pd.DataFrame({"id": range(5), "text": texts, "when": pd.Timestamp("2024-01-02 03:04:05.123456")})
    frame["nanos"] = pd.to_datetime(frame["when"]).astype("datetime64[ns]")
    frame.to_parquet(tmp_path / "x.parquet", coerce_timestamps=None)
    sinks.copy_parquet_to_csv(spark, str(tmp_path / "x.parquet"), str(tmp_path / "out"), -1)
    part = next((tmp_path / "out").glob("part-*"))
    read = pd.read_csv(part)
    assert read["text"].tolist() == texts
    assert set(read["when"].str[:26]) == {"2024-01-02 03:04:05.123456"}
    assert set(read["nanos"].astype(str).str[:26]) == {"2024-01-02 03:04:05.123456"}


def test_side_tables_as_found(spark, tmp_path):
    (tmp_path / "m.csv").write_text("src_subject_id,subjectkey,sex\n1.0,K1,F\n 2,K2,M\nx,K3,F\n")
    (tmp_path / "v.csv").write_text(
        "src_subject_id,interview_date,interview_age\n007--1,06/17/2019,NaN\n007--1,2019-06-17,311.0\n007--1,?,12\n"
    )
    found = tables.read_metadata(spark, str(tmp_path / "m.csv")).collect()
    assert [(r.src_subject_id, r.subjectkey) for r in found] == [(1, "K1"), (2, "K2"), (None, "K3")]
    visits = tables.read_visits(spark, str(tmp_path / "v.csv")).collect()
    assert [(str(r.interview_date), r.interview_age) for r in visits] == [
        ("2019-06-17", None), ("2019-06-17", 311), ("None", 12),
    ]
