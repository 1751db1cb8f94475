"""A whole study from its folder to CSV."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wearlake.operators.audit import audit
from wearlake.operators.births import birth_dates
from wearlake.operators.keyed import BROADCAST_SERIES, materialise
from wearlake.operators.lookup import first_per_subject
from wearlake.plans.convert import convert
from wearlake.schema import METADATA_SCHEMA, SERIES, SIGNALS
from wearlake.session import prepare
from wearlake.sources import files as tree
from wearlake.sources import recordings, selection, sinks, tables


@dataclass(frozen=True)
class Study:
    """What was found under a study's folder, frozen at the time of the listing."""

    participants: DataFrame
    completeness: DataFrame
    audit: DataFrame
    recordings: DataFrame


def open_study(
    spark: SparkSession,
    base: str,
    select: str = "all",
    by: str = "ordinal",
    required: str = "any_side",
    check_data: bool = True,
) -> Study:
    """List, check and select.

    Participants lacking a signal and damaged files are left out of ``recordings``
    and stay visible in the reports. ``check_data=False`` trusts the footers and
    saves the scan of all data.
    """
    prepare(spark)
    listed = materialise(tree.with_footers(tree.list_files(spark, base), base))
    chosen = materialise(selection.select_participants(tree.participants(listed), select, by))
    of_chosen = listed.join(chosen.select("folder"), "folder", "left_semi")
    found = tree.recordings(of_chosen)
    if required != "any_side":
        found = found.where(F.col("side") == required)
    report = selection.completeness(found, chosen, required=required)
    if check_data:
        checked = audit(spark, found)
    else:
        checked = found.withColumn("ok", F.coalesce("readable", F.lit(False)))
    checked = materialise(checked)
    complete = report.where("complete").select("folder")
    usable = checked.where("ok").join(complete, "folder", "left_semi")
    # Of files with the same name the one in its own participant's folder counts.
    preferred = usable.groupBy("file_name").agg(
        F.min(F.struct("misplaced", "path"))["path"].alias("path")
    )
    usable = materialise(usable.join(preferred.select("path"), "path", "left_semi"))
    return Study(chosen, report, checked, usable)


def side_tables(
    spark: SparkSession, metadata_path: str | None, visits_path: str | None
) -> tuple[DataFrame, DataFrame]:
    """Subjects and birth dates; a table that is not given has no rows."""
    if metadata_path is None:
        fields = METADATA_SCHEMA.replace("src_subject_id", "subject_id")
        subjects = spark.createDataFrame([], fields)
    else:
        subjects = first_per_subject(tables.read_metadata(spark, metadata_path), "row_index")
    if visits_path is None:
        births = spark.createDataFrame([], "src_subject_id string, birth_date date")
    else:
        births = birth_dates(tables.read_visits(spark, visits_path))
    return subjects, births


def convert_study(
    spark: SparkSession,
    study: Study,
    metadata_path: str | None = None,
    visits_path: str | None = None,
    row_limits: Mapping[str, int] | None = None,
    as_of: datetime | None = None,
    **options: str,
) -> dict[str, DataFrame]:
    """Converted rows of every signal, with their row order in the file.

    The file listing bounds the number of recordings, which settles the broadcast.
    """
    subjects, births = side_tables(spark, metadata_path, visits_path)
    small = study.recordings.count() <= BROADCAST_SERIES
    limits = dict(row_limits or {})
    for signal, limit in limits.items():
        if signal not in SIGNALS or not (limit == -1 or limit > 0):
            raise ValueError(f"row limit {signal}={limit}: -1 or a positive number")
    return {
        signal: convert(
            recordings.scan(spark, study.recordings, signal, limits.get(signal, -1)),
            signal,
            subjects,
            births,
            as_of=as_of,
            small=small,
            keep_order=True,
            **options,
        )
        for signal in SIGNALS
    }


def write_study(converted: Mapping[str, DataFrame], target: str, file_rows: int | None = None) -> dict[str, int]:
    """One CSV tree per signal below ``target``; the rows written of each signal.

    The rows are counted as they are written. ``file_rows`` plans the files, see ``write_csv``.
    """
    written = {}
    for signal, rows in converted.items():
        seen = Observation(f"written {signal}")
        counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        sinks.write_csv(counted, f"{target.rstrip('/')}/{signal}", SERIES, file_rows=file_rows)
        written[signal] = seen.get["n"]
    return written


def _read_again(spark: SparkSession, target: str, signal: str) -> DataFrame | None:
    """Rows of each recording in the output; a signal without any row has no files."""
    try:
        raw = spark.read.option("header", True).csv(f"{target.rstrip('/')}/{signal}")
    except Exception as problem:
        if "UNABLE_TO_INFER_SCHEMA" in str(problem) or "PATH_NOT_FOUND" in str(problem):
            return None
        raise
    if "participant_id" not in raw.columns:
        return None
    return raw.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n_written"))


def study_report(
    spark: SparkSession,
    study: Study,
    target: str,
    written: Mapping[str, int] | None = None,
    row_limits: Mapping[str, int] | None = None,
) -> DataFrame:
    """Every recording looked at, with the rows written for it and any problem.

    ``written`` is what :func:`write_study` returned, ``row_limits`` what was asked for.
    Where a signal's total is that of its recordings' footers, up to the limit, each
    recording was written as its footer says and the output is not read; where it is not,
    and without ``written``, rows are counted in the output. A recording without rows shows 0.
    """
    limits = dict(row_limits or {})
    limit = F.lit(None).cast("bigint")
    for signal, n in limits.items():
        limit = F.when(F.col("signal") == signal, F.nullif(F.lit(n), F.lit(-1))).otherwise(limit)
    expected = study.recordings.select(*SERIES, F.least("n_rows", limit).alias("n_written"))
    sums = {r.signal: r.n for r in expected.groupBy("signal").agg(F.sum("n_written").alias("n")).collect()}
    parts = []
    for signal in SIGNALS:
        if written is not None and written.get(signal) == sums.get(signal, 0):
            parts.append(expected.where(F.col("signal") == signal))
        elif (counted := _read_again(spark, target, signal)) is not None:
            parts.append(counted)
    complete = study.completeness.select("folder", "complete", "missing")
    report = study.audit.join(complete, "folder", "left")
    if parts:
        report = report.join(reduce(DataFrame.unionByName, parts), list(SERIES), "left")
    else:
        report = report.withColumn("n_written", F.lit(None).cast("bigint"))
    return report.select(
        "folder", *SERIES, "path", "length", "n_rows", "ok", "misplaced", "complete", "missing",
        F.coalesce("n_written", F.lit(0)).alias("n_written"),
    )
