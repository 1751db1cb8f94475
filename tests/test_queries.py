"""Every registered query next to its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracles  # noqa: E402

from wearlake.plans.driver_oracles import ORACLES, TABLES  # noqa: E402
from wearlake.plans.driver_queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, lake, name):
    df = QUERIES[name](spark, SF)
    ours = check_oracles.table_of(df.columns, df.collect())
    result = lake.execute(ORACLES[name])
    theirs = check_oracles.table_of([d[0] for d in result.description], result.fetchall())
    assert ours == theirs


def test_csv_rows_are_numbered_through_a_whole_event_type(spark, tmp_path):
    # One event type of many rows, out of order, in several files.
    n = {"hot": 4000, "cold": 300, "few": 12}
    rows = [(i, kind, i / 4) for kind, size in n.items() for i in range(size)]
    events = spark.createDataFrame(rows, "event_id long, event_type string, value double")
    events.repartition(7, "value").write.parquet(f"{tmp_path}/events.parquet")
    df = QUERIES["csv_rows"](spark, str(tmp_path))
    assert df.columns == ["event_type", "row_index", "event_id", "value"]
    expected = [r for r in rows if 25 <= r[0] < 75 or r[0] >= n[r[1]] - 10]
    found = [(r.row_index, r.event_id, r.event_type, r.value) for r in df.collect()]
    assert sorted(found) == sorted((i, i, kind, value) for i, kind, value in expected)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    theirs = connection.execute(ORACLES["csv_rows"]).fetchall()
    assert sorted((r, i, kind, value) for kind, r, i, value in theirs) == sorted(found)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
