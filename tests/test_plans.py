"""The plans have the shape that holds at scale."""

import re

import pytest
from pyspark.sql import functions as F

from wearlake.operators import contract, rolling, summary
from wearlake.operators.keyed import attach, positions, salts
from wearlake.plans import driver_queries, driver_tables
from wearlake.sources import recordings

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def branch_of_samples(plan):
    """Operators between the topmost join and the scan of its left side."""
    lines = plan.splitlines()
    start = next(i for i, line in enumerate(lines) if "Join" in line)
    depth = lines[start].index("Broadcast" if "Broadcast" in lines[start] else "Sort")
    kept = []
    for line in lines[start + 1 :]:
        if "BroadcastExchange" in line and line.index("BroadcastExchange") <= depth + 3:
            break
        kept.append(line)
    return "\n".join(kept)


@pytest.fixture(scope="module")
def rows(spark):
    return driver_tables.recordings(spark, SF)


@pytest.mark.parametrize("name", ["convert_acc", "convert_eda", "convert_temp"])
def test_conversion_does_not_shuffle_samples(spark, name):
    plan = plan_of(driver_queries.QUERIES[name](spark, SF))
    samples = branch_of_samples(plan)
    assert "FileScan parquet" in samples and "Exchange" not in samples
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_too_many_series_are_joined_with_a_salt(spark):
    plan = plan_of(driver_queries.QUERIES["convert_eda_salted"](spark, SF))
    assert "_salt" in plan


def test_only_large_series_are_parted(spark):
    """Scalars are copied once for each part of a large series and once for every other."""
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("key"), "id")
    listed = {r.key: r._salts for r in salts(rows, ["key"], 100).collect()}
    assert listed == {None: 34}
    scalars = rows.select("key", (F.col("key") * 2).alias("twice")).distinct()
    joined = attach(rows, scalars, ["key"], ["id"], small=False, series_rows=100)
    assert joined.count() == 10_000 and joined.where("NOT twice <=> key * 2").count() == 0
    assert set(joined.columns) == {"key", "id", "twice"}


def test_conversion_reads_only_needed_columns(spark):
    plan = plan_of(driver_queries.QUERIES["convert_eda"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", branch_of_samples(plan))[1]
    assert "props" not in schema


def test_row_limit_reaches_the_scan(spark, study):
    listed = recordings.listing_of(spark, study.base)
    plan = plan_of(recordings.scan(spark, listed, "eda", 7).select("eda"))
    samples = branch_of_samples(plan)
    assert "LessThan(_tmp_metadata_row_index,7)" in samples and "Exchange" not in samples
    assert "regexp" not in samples


def test_samples_are_hash_aggregated(rows):
    for df in (
        summary.series_summary(rows, driver_tables.SERIES, "event_id"),
        summary.collection_bounds(rows, driver_tables.SERIES, order="event_id"),
        summary.device_wear_days(rows, driver_tables.SERIES),
    ):
        lines = plan_of(df).splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
        below = [line for line in lines[:scan] if "Aggregate" in line][-1]
        assert "HashAggregate" in below and "partial" in below


def test_dictionary_check_is_hash_aggregated(rows):
    findings = contract.validate(rows.withColumnRenamed("value", "eda_us"), ["event_type"], "event_id")
    assert "SortAggregate" not in plan_of(findings)


def test_windows_never_take_a_whole_series(rows):
    ordered = positions(rows, driver_tables.SIGNAL, "event_id")
    for df in (
        rolling.rolling_band(ordered, driver_tables.SIGNAL, "value", "position"),
        rolling.flat_points(ordered, driver_tables.SIGNAL, "value", "position"),
        rolling.differences(ordered, driver_tables.SIGNAL, "value", "position"),
    ):
        specs = re.findall(r"windowspecdefinition\(([^)]*)", plan_of(df))
        assert specs
        for spec in specs:
            per_rows = "_chunk" in spec or "_cut" in spec
            assert per_rows, spec
