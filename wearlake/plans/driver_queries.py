"""Queries over the given tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlake.functions import fields, names
from wearlake.functions.months import chronological_months, completed_months
from wearlake.functions.zones import zone_fields
from wearlake.operators import births, contract, lookup, quantiles, rolling, signal_stats, summary
from wearlake.operators.audit import audit
from wearlake.operators.keyed import materialise, positions, stored
from wearlake.plans import analysis
from wearlake.plans import convert as conversion
from wearlake.plans import driver_tables as given
from wearlake.plans import study
from wearlake.schema import template_columns
from wearlake.session import scratch_path, settings
from wearlake.sources import files, recordings, selection, sinks, tables
from wearlake.sources.csv_records import read_csv

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SERIES = given.SERIES
SIGNAL = given.SIGNAL
FLAT = 5.0
SMALL_CHUNK = 1000
AUDIT_PARTS = 4
CSV_PARTS = 8
RANGE_ROWS = 20_000
# What a written table was sorted by is not kept until the driver happens to collect its garbage.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summing does not show."""
    doubles = {f.name for f in df.schema if f.dataType.simpleString() == "double"}
    return df.select(*(F.round(c, digits).alias(c) if c in doubles else F.col(c) for c in df.columns))


def in_order(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``columns`` (or the value) of events with their dense row number within each event type."""
    rows = given.recordings(spark, sf_dir).select(*SIGNAL, "event_id", *(columns or ("value",)))
    return positions(rows, SIGNAL, "event_id")


# ---- summaries ------------------------------------------------------------------


@query
def device_wear_days(spark, sf_dir):
    return summary.device_wear_days(given.recordings(spark, sf_dir), SERIES)


@query
def series_length(spark, sf_dir):
    return summary.series_length(given.recordings(spark, sf_dir), SERIES)


@query
def collection_bounds(spark, sf_dir):
    return summary.collection_bounds(given.recordings(spark, sf_dir), SERIES, order="event_id")


@query
def first_zone_value(spark, sf_dir):
    return summary.first_value(given.recordings(spark, sf_dir), SIGNAL, "timezone", "event_id")


@query
def series_summary(spark, sf_dir):
    rows = summary.series_summary(given.recordings(spark, sf_dir), SERIES, "event_id")
    return rows.select(
        *SERIES, "length_per", "max_devdays", "actual_devdays",
        F.col("first_utc").cast("timestamp_ntz").alias("first_utc"),
        F.col("last_utc").cast("timestamp_ntz").alias("last_utc"), "zone", "n_rows",
    )


@query
def run_report(spark, sf_dir):
    """Errors play the recordings that failed."""
    rows = given.recordings(spark, sf_dir)
    bad = F.col("event_type") == "error"
    return summary.run_report(rows.where(~bad), SERIES, rows.where(bad).select(*SERIES))


@query
def completeness(spark, sf_dir):
    found = given.folders(given.recordings(spark, sf_dir))
    report = selection.completeness(found, found.select("folder").distinct())
    return _joined_lists(report)


@query
def completeness_left(spark, sf_dir):
    found = given.folders(given.recordings(spark, sf_dir))
    report = selection.completeness(found, found.select("folder").distinct(), required="left")
    return _joined_lists(report)


def _joined_lists(report):
    return report.select(
        "folder",
        F.concat_ws(",", "seen").alias("seen"),
        F.concat_ws(",", "missing").alias("missing"),
        "complete",
    )


# ---- scalar expressions ---------------------------------------------------------


@query
def text_fields(spark, sf_dir):
    return given.recordings(spark, sf_dir).select(
        "event_id",
        fields.date_text(F.col("timestamp_local")).alias("interview_date"),
        fields.device_timestamp(F.col("timestamp_utc")).alias("device_timestamp"),
    )


@query
def day_code(spark, sf_dir):
    rows = given.recordings(spark, sf_dir)
    return rows.select("event_id", fields.day_code(F.col("timestamp_local")).alias("day_code"))


@query
def study_day_number(spark, sf_dir):
    number = fields.study_day_number(F.col("day_of_study"), F.col("day_absent"))
    return given.recordings(spark, sf_dir).select("event_id", number.alias("tlfb_daynum"))


@query
def parse_timestamps(spark, sf_dir):
    """Texts with no, three or six fraction digits, or broken ones, to microseconds."""
    rows = given.recordings(spark, sf_dir)
    whole = fields.device_timestamp(F.col("timestamp_utc"))
    text = (
        F.when(F.col("k") < 30, F.substring(whole, 1, 19))
        .when(F.col("k") < 60, F.concat(F.replace(F.substring(whole, 1, 23), F.lit(" "), F.lit("T")), F.lit("Z")))
        .when(F.col("k") < 95, whole)
        .otherwise(F.concat(F.lit("at "), whole))
    )
    return rows.select("event_id", F.unix_micros(fields.parse_moment(text)).alias("micros"))


@query
def parse_names(spark, sf_dir):
    paths = given.file_paths(given.recordings(spark, sf_dir))
    path = F.col("path")
    return paths.select(
        "event_id",
        names.participant(path).alias("participant_id"),
        names.data_type(path).alias("data_type"),
        names.padded_subject(path).alias("padded"),
        names.subject_number(path).alias("subject_id"),
        names.wrist_position(path).alias("device_position"),
        names.is_recording(path).alias("is_recording"),
        names.recording_part(path, 2).alias("signal"),
        names.recording_part(path, 3).alias("side"),
    )


@query
def path_participant(spark, sf_dir):
    paths = given.file_paths(given.recordings(spark, sf_dir))
    folder = F.regexp_extract("path", "^(.*)/", 1)
    return paths.select("event_id", names.participant_in_path(folder).alias("participant_id"))


@query
def completed_months_signed(spark, sf_dir):
    """Ages from an early birth date, and from one that often lies after the visit."""
    day = F.col("o_orderdate")
    return given.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        completed_months(given.birth(), day).alias("months"),
        completed_months(given.birth("1996-01-31"), day).alias("months_signed"),
    )


@query
def chronological_age(spark, sf_dir):
    age = chronological_months(given.birth(), F.col("o_orderdate"))
    return given.table(spark, sf_dir, "orders").select("o_orderkey", age.alias("months"))


# ---- subjects -------------------------------------------------------------------


@query
def birth_date(spark, sf_dir):
    return births.birth_dates(given.visits(spark, sf_dir))


@query
def birth_date_qc(spark, sf_dir):
    seen = births.visit_deviations(given.visits(spark, sf_dir))
    return rounded(births.birth_date_quality(seen))


@query
def visit_report(spark, sf_dir):
    return births.visit_report(births.visit_deviations(given.visits(spark, sf_dir)))


@query
def subject_metadata(spark, sf_dir):
    users = given.recordings(spark, sf_dir).select("subject_id", "src_subject_id").distinct()
    known = lookup.first_per_subject(given.metadata(spark, sf_dir), "row_index")
    return users.join(known, "subject_id", "left").withColumn(
        "device", fields.device_type(F.col("subject_id"))
    )


@query
def zone_dimension(spark, sf_dir):
    zones = summary.first_value(given.recordings(spark, sf_dir), SERIES, "timezone", "event_id")
    return zones.withColumn("_zone", zone_fields(F.col("timezone"), given.AS_OF)).select(
        *SERIES,
        "timezone",
        F.col("_zone.abbreviation").alias("site_time_zone"),
        F.col("_zone.utc_offset").alias("utc_offset"),
    )


def _participants(spark, sf_dir):
    return given.table(spark, sf_dir, "events").select(F.col("user_id").alias("subject_id")).distinct()


@query
def numbered_participants(spark, sf_dir):
    return selection.numbered(_participants(spark, sf_dir))


@query
def select_participants(spark, sf_dir):
    return selection.select_participants(_participants(spark, sf_dir), "1,3-5,12")


@query
def select_participants_by_id(spark, sf_dir):
    return selection.select_participants(_participants(spark, sf_dir), "0,3-5,12", by="id")


# ---- scans, limits, slices ------------------------------------------------------


@query
def head_limit_per_file(spark, sf_dir):
    """The row limit reaches the scan and comes before every derivation."""
    rows = given.table(spark, sf_dir, "events").select("*", "_metadata.row_index")
    kept = recordings.head(rows, 2000)
    return kept.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.max(F.datediff("ts", F.lit(given.STUDY_START))) + 1).cast("int").alias("length_per"),
    )


@query
def tail_rows(spark, sf_dir):
    last = recordings.tail(in_order(spark, sf_dir), 10, SIGNAL, "position")
    return last.select("event_type", "event_id", "value")


@query
def row_slice(spark, sf_dir):
    rows = given.table(spark, sf_dir, "events").select("*", "_metadata.row_index")
    return recordings.row_slice(rows, 25, 50).select("row_index", "event_id", "event_type", "value")


@query
def vertical_record(spark, sf_dir):
    events = given.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return recordings.as_records(events, "event_id")


@query
def schema_listing(spark, sf_dir):
    return recordings.schema_listing(given.table(spark, sf_dir, "events"))


@query
def file_audit(spark, sf_dir):
    return _audited(spark, sf_dir)


def _audited(spark, folder):
    listed = materialise(files.with_footers(files.single_level(spark, folder, "%.parquet"), folder))
    return audit(spark, listed).select("file_name", "n_rows", "n_scanned", "ok", "problem")


@query
def file_audit_damaged(spark, sf_dir):
    """Sound files with signs in their names, an empty one and some that are no Parquet.

    The orders fill them, dealt by their key.
    """
    folder = scratch_path(spark, "audit")
    part = F.pmod("o_orderkey", F.lit(AUDIT_PARTS)).cast("int").alias("part")
    rows = given.table(spark, sf_dir, "orders").select("*", part).repartition("part")
    rows.write.partitionBy("part").parquet(f"{folder}/good")
    rows.select("part", F.col("o_orderpriority").alias("value")).write.partitionBy("part").text(f"{folder}/text")
    for kind, name in (("good", "good 100%+"), ("text", "text")):
        for i in range(AUDIT_PARTS):
            files.place_part(spark, f"{folder}/{kind}/part={i}", f"{folder}/{name} {i}.parquet")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/empty.parquet")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path).close()
    return _audited(spark, folder)


@query
def csv_round_trip(spark, sf_dir):
    """Written as CSV by event type, then read back with types."""
    rows = given.table(spark, sf_dir, "events").select("event_type", "event_id", "user_id", "value", "ts")
    target = scratch_path(spark, "csv")
    sinks.write_csv(rows, target, ["event_type"])
    schema = "event_id BIGINT, user_id BIGINT, value DOUBLE, ts TIMESTAMP_NTZ, event_type STRING"
    read = spark.read.schema(schema).option("header", True)
    return read.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(target)


@query
def csv_planned_files(spark, sf_dir):
    """Events in files of 1000 rows of one event type each, and which rows each file holds."""
    target = scratch_path(spark, "csv")
    sinks.write_csv(in_order(spark, sf_dir, "value"), target, SIGNAL, order="position", file_rows=SMALL_CHUNK)
    read = spark.read.schema("event_id BIGINT, value DOUBLE, event_type STRING").options(**sinks.CSV).csv(target)
    held = read.groupBy("event_type", F.col("_metadata.file_path").alias("file")).agg(
        F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"), F.count(F.lit(1)).alias("n")
    )
    return held.drop("file")


@query
def csv_texts(spark, sf_dir):
    """Quotes, line feeds and outer blanks of texts survive."""
    rows = given.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    target = scratch_path(spark, "csv")
    sinks.write_csv(rows, target, ["lang"])
    read = spark.read.schema("doc_id BIGINT, text STRING, lang STRING").options(**sinks.CSV)
    return read.option("multiLine", True).csv(target)


@query
def csv_records(spark, sf_dir):
    """Texts with quotes, commas and line feeds, read in many splits of several files.

    The files hold ranges of ids in order, so a row's number in its file and the rows of the
    files before tell its place among all ids.
    """
    rows = given.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    target = scratch_path(spark, "csv")
    # A file is sorted by one task, so larger tables get more files.
    ranges = max(4, -(-rows.count() // RANGE_ROWS))
    sorted_ = rows.repartitionByRange(ranges, "doc_id").sortWithinPartitions("doc_id")
    with settings(spark, FREED):
        sorted_.write.options(**sinks.CSV).csv(target)
    read = read_csv(spark, target, split_bytes=1 << 18, file="file").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    files_ = read.groupBy("file").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    starts = files_.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return read.join(F.broadcast(starts), "file").select(
        "doc_id", "text", "lang", "source", (F.col("start") + F.col("row_index")).alias("place")
    )


@query
def read_by_extension(spark, sf_dir):
    """Every record of CSV and of Parquet files, found by their extension, as column and value."""
    target = scratch_path(spark, "any")
    rows = given.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows.write.options(**sinks.CSV).csv(f"{target}.csv")
    both = [
        recordings.as_records(tables.read_any(spark, path).select("doc_id", "text", "source"), "doc_id")
        .select(F.lit(kind).alias("kind"), F.col("doc_id").cast("bigint").alias("doc_id"), "column", "value")
        for kind, path in (("csv", f"{target}.csv"), ("parquet", f"{sf_dir}/documents.parquet"))
    ]
    return both[0].unionByName(both[1])


@query
def csv_rows(spark, sf_dir):
    """Rows 25 to 74 and the last ten of each event type, by row number through all its CSV files."""
    place = F.col("event_id").asc_nulls_last()
    rows = given.table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    # Many tasks write an event type, each a range of the row order; the names of files keep it.
    ranges = rows.repartitionByRange("event_type", place).sortWithinPartitions("event_type", place)
    target = scratch_path(spark, "csv")
    sinks.write_csv(ranges, target, ["event_type"], order="_none")
    raw = spark.read.schema("event_id BIGINT, value DOUBLE, event_type STRING").options(**sinks.CSV).csv(target)
    read = tables.with_csv_rows(raw, keys=["event_type"])
    middle = recordings.row_slice(read, 25, 50)
    last = recordings.tail(read, 10, ["event_type"])
    return middle.union(last).distinct().select("event_type", "row_index", "event_id", "value")


@query
def metadata_csv(spark, sf_dir):
    """Subject metadata from CSV files with numbers such as ``12.0``."""
    # Files are written by ranges of the row order and read by their names, so the order is kept.
    known = given.metadata(spark, sf_dir).repartitionByRange(CSV_PARTS, "row_index").sortWithinPartitions("row_index")
    number = F.when(F.col("row_index") % 2 == 0, F.concat("src_subject_id", F.lit(".0"))).otherwise(
        F.concat(F.lit(" "), F.col("src_subject_id").cast("string"))
    )
    target = scratch_path(spark, "csv")
    known.select(number.alias("src_subject_id"), "subjectkey", "sex").write.options(**sinks.CSV).csv(target)
    read = lookup.first_per_subject(tables.read_metadata(spark, target), "row_index")
    users = given.recordings(spark, sf_dir).select("subject_id").distinct()
    return users.join(read, "subject_id").select("subject_id", "subjectkey", "sex")


@query
def visits_csv(spark, sf_dir):
    """Birth dates from a CSV file with dates of three spellings and ages that are ``NaN``."""
    seen = given.visits(spark, sf_dir)
    day = F.col("interview_date")
    kind = F.pmod("o_orderkey", F.lit(3))
    spelled = (
        F.when(kind == 0, F.date_format(day, "MM/dd/yyyy"))
        .when(kind == 1, F.date_format(day, "M/d/yyyy"))
        .otherwise(day.cast("string"))
    )
    age = F.coalesce(F.concat(F.col("interview_age"), F.lit(".0")), F.lit("NaN"))
    target = scratch_path(spark, "csv")
    seen.select(
        "src_subject_id", spelled.alias("interview_date"), age.alias("interview_age")
    ).write.options(**sinks.CSV).csv(target)
    return births.birth_dates(tables.read_visits(spark, target))


@query
def parquet_to_csv_whole(spark, sf_dir):
    """The copy without a limit, with moments."""
    target = scratch_path(spark, "copy")
    sinks.copy_parquet_to_csv(spark, f"{sf_dir}/events.parquet", target, -1)
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    read = spark.read.schema(schema).options(**sinks.CSV)
    return read.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(target).drop("props")


@query
def parquet_to_csv(spark, sf_dir):
    """The bounded copy, read back."""
    target = scratch_path(spark, "copy")
    sinks.copy_parquet_to_csv(spark, f"{sf_dir}/customer.parquet", target, 1000)
    schema = (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    )
    return spark.read.schema(schema).option("header", True).csv(target)


# ---- conversion -----------------------------------------------------------------


def _convert(spark, sf_dir, signal, **options):
    rows = given.recordings(spark, sf_dir)
    subjects = lookup.first_per_subject(given.metadata(spark, sf_dir), "row_index")
    born = births.birth_dates(given.visits(spark, sf_dir))
    return conversion.convert(
        rows, signal, subjects, born, keys=SERIES, order="event_id", as_of=given.AS_OF, **options
    )


@query
def convert_acc(spark, sf_dir):
    return _convert(spark, sf_dir, "acc")


@query
def convert_eda(spark, sf_dir):
    return _convert(spark, sf_dir, "eda")


@query
def convert_ibi(spark, sf_dir):
    return _convert(spark, sf_dir, "ibi", rounding="chronological")


@query
def convert_temp(spark, sf_dir):
    return _convert(spark, sf_dir, "temp")


@query
def convert_older_layout(spark, sf_dir):
    """Age and device as recorded, skin temperature for every signal."""
    passed = {"age": "passthrough", "device": "passthrough", "sensors": "temp"}
    return _convert(spark, sf_dir, "acc", **passed)


@query
def convert_eda_salted(spark, sf_dir):
    """The way taken when there are too many series to broadcast; the larger ones are parted."""
    return _convert(spark, sf_dir, "eda", small=False, series_rows=15)


# ---- contract -------------------------------------------------------------------


@query
def conform_template(spark, sf_dir):
    return contract.conform(_convert(spark, sf_dir, "acc"), template_columns("eda"))


@query
def validate_dictionary(spark, sf_dir):
    """Two passes over the rows, the second over the few first bad ones; the scalars are kept."""
    converted = _convert(spark, sf_dir, "eda", keep_order=True, freeze=True)
    return contract.validate(converted, SIGNAL, "event_id")


# ---- signal statistics ----------------------------------------------------------


@query
def signal_summary(spark, sf_dir):
    rows = given.recordings(spark, sf_dir).select(*SERIES, "event_id", "timestamp_local", "value")
    columns = len(given.table(spark, sf_dir, "events").columns)
    return rounded(
        signal_stats.signal_summary(rows, SERIES, "value", "timestamp_local", "event_id", columns)
    )


@query
def sampling_rate(spark, sf_dir):
    """Steps between events of a type, in whole minutes so that steps recur."""
    rows = in_order(spark, sf_dir, "timestamp_local").withColumn("minute", F.date_trunc("minute", "timestamp_local"))
    return rounded(signal_stats.sampling_rate(rows, SIGNAL, "minute", "position"))


@query
def sampling_rate_chunked(spark, sf_dir):
    rows = in_order(spark, sf_dir, "timestamp_local").withColumn("minute", F.date_trunc("minute", "timestamp_local"))
    return rounded(signal_stats.sampling_rate(rows, SIGNAL, "minute", "position", SMALL_CHUNK))


@query
def distinct_values(spark, sf_dir):
    rows = given.recordings(spark, sf_dir)
    return signal_stats.distinct_values_of(rows, ("timezone", "day_of_study", "device_worn"), "event_id", SIGNAL)


@query
def describe_numeric(spark, sf_dir):
    rows = given.recordings(spark, sf_dir)
    return rounded(signal_stats.describe_numeric(rows, SIGNAL, ["value", "k", "day_of_study"]))


@query
def describe_numeric_ranked(spark, sf_dir):
    """The same over two columns."""
    rows = given.recordings(spark, sf_dir)
    return rounded(signal_stats.describe_numeric(rows, SIGNAL, ["value", "k"]))


def _with_nan(spark, sf_dir):
    """Events some of whose values are missing, as ``NaN`` or as null."""
    rows = given.recordings(spark, sf_dir)
    holed = F.when(F.col("k") % 10 == 0, F.lit(float("nan"))).when(F.col("k") % 10 == 1, None).otherwise(F.col("value"))
    return rows.select("event_id", *SIGNAL, "timestamp_local", holed.alias("value"))


@query
def describe_nan(spark, sf_dir):
    return rounded(signal_stats.describe_numeric(_with_nan(spark, sf_dir), SIGNAL, ["value"]))


@query
def histogram_nan(spark, sf_dir):
    return rounded(signal_stats.histogram(_with_nan(spark, sf_dir), SIGNAL, "value", "event_id"))


@query
def box_nan(spark, sf_dir):
    return rounded(signal_stats.box_stats(_with_nan(spark, sf_dir), SIGNAL, "value", "event_id"))


@query
def summary_nan(spark, sf_dir):
    return rounded(signal_stats.signal_summary(_with_nan(spark, sf_dir), SIGNAL, "value", "timestamp_local", "event_id"))


@query
def rolling_nan(spark, sf_dir):
    """Bands of a signal with holes and a large offset."""
    far = F.lit(1e7) + F.col("event_id") % 17
    rows = _with_nan(spark, sf_dir).select(
        "event_id", *SIGNAL, F.when(F.col("event_id") % 1000 < 700, F.col("value")).otherwise(far).alias("value")
    )
    return _banded(positions(rows, SIGNAL, "event_id"), SMALL_CHUNK, digits=5)


@query
def percentiles_lineitem(spark, sf_dir):
    """Percentiles of prices by rank: nearly every value is different."""
    rows = given.table(spark, sf_dir, "lineitem")
    found = quantiles.percentiles(rows, ["l_returnflag"], "l_extendedprice", (0.1, 0.5, 0.99))
    shares = {"p10": 0, "p50": 1, "p99": 2}
    return rounded(
        found.select("l_returnflag", *(F.get("quantiles", F.lit(i)).alias(n) for n, i in shares.items()))
    )


@query
def histogram30(spark, sf_dir):
    rows = given.recordings(spark, sf_dir)
    return rounded(signal_stats.histogram(rows, SIGNAL, "value", "event_id"))


@query
def histogram_edges(spark, sf_dir):
    """Discounts lie on edges of their bins."""
    rows = given.table(spark, sf_dir, "lineitem")
    return rounded(signal_stats.histogram(rows, ["l_returnflag"], "l_discount", "l_orderkey"))


@query
def box_stats(spark, sf_dir):
    return rounded(signal_stats.box_stats(given.recordings(spark, sf_dir), SIGNAL, "value", "event_id"))


@query
def box_outliers(spark, sf_dir):
    return signal_stats.box_outliers(given.recordings(spark, sf_dir), SIGNAL, "value", "event_id")


@query
def sparse_positions(spark, sf_dir):
    """Row numbers by an order with very large gaps."""
    rows = given.table(spark, sf_dir, "events").select("event_type", "event_id")
    wide = rows.withColumn("at", F.col("event_id") * 1_000_000_007)
    return positions(wide, ["event_type"], "at").select("event_type", "event_id", "position")


# ---- windows --------------------------------------------------------------------


@query
def differences(spark, sf_dir):
    rows = rolling.differences(in_order(spark, sf_dir), SIGNAL, "value", "position", SMALL_CHUNK)
    return rounded(rows.select("event_id", "diff"))


def _banded(rows, chunk, digits=6):
    banded = rolling.rolling_band(rows, SIGNAL, "value", "position", chunk=chunk)
    return rounded(banded.select("event_id", "rolling_mean", "rolling_std", "band_lo", "band_hi"), digits)


@query
def rolling_band(spark, sf_dir):
    return _banded(in_order(spark, sf_dir), rolling.CHUNK_ROWS)


@query
def rolling_band_chunked(spark, sf_dir):
    return _banded(in_order(spark, sf_dir), SMALL_CHUNK)


@query
def high_variation(spark, sf_dir):
    return rounded(rolling.high_variation(in_order(spark, sf_dir), SIGNAL, "value", "position"))


@query
def flat_points(spark, sf_dir):
    flagged = rolling.flat_points(in_order(spark, sf_dir), SIGNAL, "value", "position", FLAT, SMALL_CHUNK)
    return flagged.select("event_id", "flat")


@query
def flat_count(spark, sf_dir):
    flagged = rolling.flat_points(in_order(spark, sf_dir), SIGNAL, "value", "position", FLAT)
    return rolling.flat_count(flagged, SIGNAL)


# ---- a study from its folder ------------------------------------------------------


@query
def study_files(spark, sf_dir):
    """Every file of a study's folder with the rows its footer tells."""
    base = given.study_tree(spark, sf_dir)
    listed = files.with_footers(files.list_files(spark, base), base)
    return listed.select("folder", "file_name", "readable", "n_rows")


@query
def study_scan(spark, sf_dir):
    """The rows of all recordings of one signal, by their place in the file."""
    listed = recordings.listing_of(spark, given.study_tree(spark, sf_dir))
    rows = recordings.scan(spark, listed, "eda")
    return rows.select("participant_id", "subject_id", "side", "row_index", "eda", "device_worn")


@query
def study_report(spark, sf_dir):
    """Opened, converted with a limit for one signal, written, and reported without reading the output."""
    limits = {"acc": 100}
    opened = study.open_study(spark, given.study_tree(spark, sf_dir))
    target = scratch_path(spark, "archive")
    written = study.write_study(study.convert_study(spark, opened, row_limits=limits, as_of=given.AS_OF), target)
    report = study.study_report(spark, opened, target, written, limits)
    return report.select("participant_id", "signal", "side", "n_rows", "ok", "misplaced", "complete", "n_written")


# ---- a whole report -------------------------------------------------------------


@query
def signal_report(spark, sf_dir):
    """All statistics of each event type's signal."""
    minute = F.date_trunc("minute", "timestamp_local").cast("timestamp_ntz")
    rows = given.recordings(spark, sf_dir).withColumn("minute", minute)
    columns = len(given.table(spark, sf_dir, "events").columns)
    report = analysis.signal_report(
        rows, SIGNAL, "value", "minute", "event_id", columns, flat_threshold=FLAT
    )
    return rounded(report)
