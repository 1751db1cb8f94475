"""The whole way from a study folder to CSV."""

import mini_study
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.plans import study as plan
from wearlake.plans.convert import convert
from wearlake.schema import SIGNALS, output_columns
from wearlake.sources import files, recordings, tables

# SP3 lost two recordings to damage; its two sound ones are converted all the same.
COMPLETE = ("SP1_", "SP2_", "SP3_e4_eda", "SP3_e4_temp", "SP84_", "SP1234_")


def rows_of(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def wanted(frames, signal, first_rows=-1, prefixes=COMPLETE):
    rows = []
    for stem, frame in frames.items():
        if stem.startswith(prefixes) and stem.split("_")[2] == signal:
            rows += mini_study.expected(stem, frame, first_rows)
    return sorted((tuple(sorted(r.items())) for r in rows), key=repr)


@pytest.fixture(scope="module")
def opened(spark, study):
    return plan.open_study(spark, study.base)


def converted(spark, study, opened, **options):
    return plan.convert_study(
        spark, opened, study.metadata, study.visits, as_of=mini_study.AS_OF, **options
    )


@pytest.mark.parametrize("signal", SIGNALS)
def test_converted_rows_equal_pandas(spark, study, opened, signal):
    rows = converted(spark, study, opened)[signal]
    key = ["participant_id", "signal", "side"]
    assert rows.columns == [*key, "row_index", *output_columns(signal)]
    assert rows_of(rows.drop("row_index")) == wanted(study.frames, signal)


@pytest.mark.parametrize("signal", ["eda", "temp"])
def test_salted_join_gives_the_same_rows(spark, study, opened, signal):
    subjects, births = plan.side_tables(spark, study.metadata, study.visits)
    rows = recordings.scan(spark, opened.recordings, signal)
    salted = convert(rows, signal, subjects, births, as_of=mini_study.AS_OF, small=False)
    assert rows_of(salted) == wanted(study.frames, signal)


def test_row_limit_comes_before_every_summary(spark, study, opened):
    rows = converted(spark, study, opened, row_limits={"acc": 7, "temp": 7})
    for signal, limit in (("acc", 7), ("temp", 7), ("ibi", -1)):
        assert rows_of(rows[signal].drop("row_index")) == wanted(study.frames, signal, limit)


@pytest.mark.parametrize("limits", [{"acc": 0}, {"acc": -5}, {"bvp": 3}])
def test_row_limit_must_make_sense(spark, study, opened, limits):
    with pytest.raises(ValueError):
        converted(spark, study, opened, row_limits=limits)


def test_without_side_tables_the_fields_stay_blank(spark, study, opened):
    rows = plan.convert_study(spark, opened, as_of=mini_study.AS_OF)["eda"]
    kept = rows.select("subjectkey", "sex", "interview_age").distinct().collect()
    assert [tuple(r) for r in kept] == [(None, None, None)]


def test_rounding_option_counts_sixteen_days(spark, study, opened):
    floor = converted(spark, study, opened)["eda"]
    chrono = converted(spark, study, opened, rounding="chronological")["eda"]
    key = ["participant_id", "side", "device_timestamp"]
    both = floor.select(*key, F.col("interview_age").alias("a")).join(
        chrono.select(*key, F.col("interview_age").alias("b")), key
    )
    added = both.where("a is not null").select(F.col("b") - F.col("a")).distinct()
    assert {r[0] for r in added.collect()} == {0, 1}


def test_older_layout_passes_columns_through(spark, study, opened):
    subjects, births = plan.side_tables(spark, study.metadata, study.visits)
    rows = recordings.scan(spark, opened.recordings, "eda")
    rows = rows.withColumn("interview_age", F.lit(321)).withColumn("mt_pilot_vib_device", F.lit("own"))
    options = {"age": "passthrough", "device": "passthrough", "small": True}
    older = convert(rows, "eda", subjects, births, **options)
    assert "watch_device_type" not in older.columns and older.columns[-1] == "eda_us"
    kept = older.select("interview_age", "mt_pilot_vib_device").distinct().collect()
    assert [tuple(r) for r in kept] == [(321, "own")]
    oldest = convert(rows, "eda", subjects, births, sensors="temp", **options)
    assert oldest.columns[-2:] == ["device_timestamp", "skin_temp"] and "eda_us" not in oldest.columns
    assert oldest.where("skin_temp is not null").count() == 0


def test_csv_holds_every_row(spark, study, opened, tmp_path):
    rows = converted(spark, study, opened)
    plan.write_study(rows, str(tmp_path))
    for signal in SIGNALS:
        assert rows[signal].count() > 0
        read = spark.read.option("header", True).csv(f"{tmp_path}/{signal}")
        names = [n for n in rows[signal].columns if n != "row_index"]
        texts = rows[signal].select(
            *(F.nullif(F.col(n).cast("string"), F.lit("")).alias(n) for n in names)
        )
        assert rows_of(read.select(*names)) == rows_of(texts)
    report = plan.study_report(spark, opened, str(tmp_path))
    for row in report.collect():
        stem = row["path"].rsplit("/", 1)[1].removesuffix(".parquet")
        exported = row["ok"] and row["complete"]
        assert row["n_written"] == (len(study.frames[stem]) if exported else 0), stem


def test_report_does_not_read_the_output(spark, study, opened, tmp_path):
    """Rows are counted as they are written; a total that is not as promised is counted again."""
    limits = {"acc": 7}
    rows = converted(spark, study, opened, row_limits=limits)
    rows["temp"] = rows["temp"].limit(0)
    written = plan.write_study(rows, str(tmp_path / "out"))
    assert written == {signal: rows[signal].count() for signal in SIGNALS} and written["temp"] == 0
    read = {r["path"]: r["n_written"] for r in plan.study_report(spark, opened, str(tmp_path / "out")).collect()}
    told = plan.study_report(spark, opened, str(tmp_path / "out"), written, limits)
    assert {r["path"]: r["n_written"] for r in told.collect()} == read
    # With nothing there to read, only the signal whose total is not as promised is lost.
    gone = plan.study_report(spark, opened, str(tmp_path / "none"), written | {"eda": 3}, limits)
    assert {r["path"]: r["n_written"] for r in gone.collect()} == {p: 0 if "_eda_" in p else n for p, n in read.items()}


@pytest.mark.parametrize("small", [True, False])
def test_planned_files(spark, study, opened, tmp_path, small):
    """A series has as few files as its rows need, whichever way its scalars were joined."""
    scanned = recordings.scan(spark, opened.recordings, "acc")
    subjects, births = plan.side_tables(spark, study.metadata, study.visits)
    rows = convert(
        scanned.repartition(7), "acc", subjects, births, as_of=mini_study.AS_OF, small=small, keep_order=True, series_rows=20
    )
    plan.write_study({"acc": rows}, str(tmp_path), file_rows=30)
    sizes = {(r.participant_id, r.side): r["count"] for r in scanned.groupBy("participant_id", "side").count().collect()}
    for (participant, side), n in sizes.items():
        folder = tmp_path / "acc" / f"participant_id={participant}" / "signal=acc" / f"side={side}"
        held = sorted(len(pd.read_csv(f)) for f in folder.glob("*.csv"))
        assert held == sorted([30] * (n // 30) + ([n % 30] if n % 30 else []))


def test_recording_as_spark_writes_it(spark, study, tmp_path):
    """Instants of 96 bits, and hidden files beside the recording."""
    whole = recordings.scan(spark, recordings.listing_of(spark, study.base).where(F.col("path").endswith("SP1_e4_eda_left.parquet")), "eda")
    columns = ["timestamp_utc", "timestamp_local", "timezone", "day_of_study", "device_worn", "eda"]
    whole.orderBy("row_index").select(*columns).coalesce(1).write.option("compression", "gzip").parquet(str(tmp_path / "part"))
    files.place_part(spark, str(tmp_path / "part"), str(tmp_path / "study" / "SP1" / "SP1_e4_eda_left.parquet"))
    (tmp_path / "study" / "SP1" / "_SUCCESS").write_text("")
    listed = recordings.listing_of(spark, str(tmp_path / "study"))
    assert [r.file_name for r in files.list_files(spark, str(tmp_path / "study")).collect()] == ["SP1_e4_eda_left.parquet"]
    again = recordings.scan(spark, listed, "eda")
    assert rows_of(again.select("row_index", *columns)) == rows_of(whole.select("row_index", *columns))


def test_csv_keeps_the_row_order(spark, study, opened, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        plan.write_study({"acc": converted(spark, study, opened)["acc"]}, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    left = tmp_path / "acc" / "participant_id=SP1" / "signal=acc" / "side=left"
    parts = sorted(left.glob("*.csv"))
    times = [pd.read_csv(p)["device_timestamp"].tolist() for p in parts]
    assert len(parts) > 1 and all(t == sorted(t) for t in times)
    frame = study.frames["SP1_e4_acc_left"]
    assert sorted(sum(times, [])) == frame["timestamp_utc"].dt.strftime("%Y-%m-%d %H:%M:%S.%f").tolist()


def test_of_files_with_one_name_the_placed_one_counts(spark, study, tmp_path):
    for folder, source in (("SP5", "SP1"), ("SP6", "SP2")):
        (tmp_path / folder).mkdir()
        for signal in SIGNALS:
            data = open(f"{study.base}/{source}/{source}_e4_{signal}_left.parquet", "rb").read()
            for name in ("SP5", "SP6"):
                (tmp_path / folder / f"{name}_e4_{signal}_left.parquet").write_bytes(data)
    found = plan.open_study(spark, str(tmp_path), check_data=False)
    kept = sorted((r.folder, r.file_name[:3]) for r in found.recordings.collect())
    assert kept == [("SP5", "SP5")] * 4 + [("SP6", "SP6")] * 4


def test_blank_text_is_written_as_nothing(spark, study, opened, tmp_path):
    plan.write_study({"eda": converted(spark, study, opened)["eda"]}, str(tmp_path))
    written = [p for p in tmp_path.rglob("*.csv") if "participant_id=SP84" in str(p)]
    text = "".join(p.read_text() for p in written)
    assert '""' not in text and ",," in text


def test_participants_are_found_by_folder(spark, study):
    listed = files.list_files(spark, study.base)
    found = files.participants(listed).collect()
    assert sorted((r.subject_id, r.folder) for r in found) == [
        (n, f"SP{n}") for n in (1, 2, 3, 7, 10, 84, 1234)
    ]


def test_incomplete_participants_are_reported_and_left_out(spark, study, opened):
    report = {r.folder: r for r in opened.completeness.collect()}
    assert report["SP10"].missing == ["ibi"] and not report["SP10"].complete
    assert report["SP7"].seen == [] and len(report["SP7"].missing) == 4
    assert report["SP1"].complete and report["SP84"].complete
    used = {r.folder for r in opened.recordings.select("folder").distinct().collect()}
    assert used == {"SP1", "SP2", "SP3", "SP84", "SP1234"}


def test_left_wrist_only(spark, study):
    left = plan.open_study(spark, study.base, required="left", check_data=False)
    report = {r.folder: r.complete for r in left.completeness.collect()}
    assert report["SP1"] and not report["SP84"]
    assert {r.side for r in left.recordings.select("side").distinct().collect()} == {"left"}


def test_selection_by_place_and_by_number(spark, study):
    def chosen(**options):
        found = plan.open_study(spark, study.base, check_data=False, **options)
        return sorted(r.subject_id for r in found.participants.collect())

    assert chosen(select="1-2,6") == [1, 2, 84]
    assert chosen(select="1-2,84", by="id") == [1, 2, 84]
    with pytest.raises(ValueError):
        chosen(select="8")


def test_damaged_and_empty_files_are_found(spark, study, opened):
    audit = {r.path.rsplit("/", 1)[1]: r for r in opened.audit.collect()}
    assert audit["SP3_e4_acc_left.parquet"].problem == "unreadable"
    assert audit["SP3_e4_ibi_left.parquet"].problem == "empty"
    good = audit["SP1_e4_eda_left.parquet"]
    assert good.ok and good.n_row_groups == 8 and good.n_rows == len(study.frames["SP1_e4_eda_left"])
    assert "SP1_e4_bvp_left.parquet" not in audit
    assert sum(not r.ok for r in audit.values()) == 2


def test_damaged_pages_are_found(spark, study, tmp_path):
    source = f"{study.base}/SP1/SP1_e4_eda_left.parquet"
    data = bytearray(open(source, "rb").read())
    data[200:2500] = b"\xff" * 2300  # pages only; the footer stays whole
    (tmp_path / "SP5").mkdir()
    (tmp_path / "SP5" / "SP5_e4_eda_left.parquet").write_bytes(bytes(data))
    (tmp_path / "SP5" / "SP5_e4_temp_left.parquet").write_bytes(open(source, "rb").read())
    from wearlake.operators.audit import audit

    listed = recordings.listing_of(spark, str(tmp_path))
    found = {r.signal: r for r in audit(spark, listed).collect()}
    assert found["eda"].readable and found["eda"].problem == "damaged"
    assert found["temp"].ok and found["temp"].n_scanned == found["temp"].n_rows


def test_misplaced_file_is_marked(spark, study, tmp_path):
    data = open(f"{study.base}/SP1/SP1_e4_eda_left.parquet", "rb").read()
    (tmp_path / "SP5").mkdir()
    (tmp_path / "SP5" / "SP6_e4_eda_left.parquet").write_bytes(data)
    (tmp_path / "SP5" / "SP5_e4_eda_left.parquet").write_bytes(data)
    listed = recordings.listing_of(spark, str(tmp_path))
    assert {r.subject_id: r.misplaced for r in listed.collect()} == {5: False, 6: True}


def test_missing_base_gives_an_empty_listing(spark, tmp_path):
    listed = recordings.listing_of(spark, str(tmp_path / "none"))
    assert listed.count() == 0


def test_splits_do_not_change_the_row_order(spark, study, opened):
    def bounds():
        rows = recordings.scan(spark, opened.recordings, "acc")
        return rows_of(rows.select("participant_id", "side", "row_index", "timestamp_utc", "x_g"))

    whole = bounds()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = recordings.scan(spark, opened.recordings, "acc")
        assert rows.rdd.getNumPartitions() > 20
        assert bounds() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_first_metadata_row_counts(spark, study):
    from wearlake.operators.lookup import first_per_subject

    found = first_per_subject(tables.read_metadata(spark, study.metadata), "row_index")
    assert {r.subject_id: (r.subjectkey, r.sex) for r in found.collect()} == mini_study.SUBJECTS


def report_of(spark, base):
    found = plan.open_study(spark, base)
    checked = {(r.file_name, r.ok, r.problem) for r in found.audit.collect()}
    return checked, {r.file_name for r in found.recordings.collect()}


def test_path_spellings_agree(spark, study):
    plain = report_of(spark, study.base)
    assert plain == report_of(spark, "file://" + study.base) == report_of(spark, "file:" + study.base + "/")
    assert any(ok for _, ok, _ in plain[0]) and plain[1]


def test_large_participant_number(spark, tmp_path):
    (tmp_path / "SP3000000000").mkdir()
    listed = files.list_files(spark, str(tmp_path))
    assert [r.subject_id for r in files.participants(listed).collect()] == [3_000_000_000]
