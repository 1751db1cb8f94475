"""CSV with line feeds in quoted fields, cut at any place, next to pandas."""

import os
import random

import pandas as pd
import pytest

from wearlake.plans import driver_queries
from wearlake.session import scratch_dir, settings
from wearlake.sources import csv_records, tables


def field(rng):
    kind = rng.random()
    if kind < 0.2:
        return ""
    if kind < 0.3:
        return '5" disk' + rng.choice(["", ' "x"', '"'])
    text = "".join(rng.choice('ab ,"\n\r;ñ') for _ in range(rng.randint(1, 12)))
    return '"' + text.replace('"', '""') + '"'


def written(path, seed, mark="", tail=""):
    rng = random.Random(seed)
    ends = ["\n", "\r\n", "\n\n", "\n \t\n"]
    lines = [f"{i},{field(rng)},{field(rng)}{rng.choice(ends)}" for i in range(80)]
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(mark + 'id,"na""me","two\nlines"\r\n' + "".join(lines) + tail)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("split", [None, 300, 9])
def test_records_equal_pandas(spark, tmp_path, seed, split):
    path = str(tmp_path / "some.csv")
    written(path, seed, *(("\ufeff", '80,"tail\nwithout a field"') if seed == 2 else ("", "")))
    want = pd.read_csv(path, dtype=str, keep_default_na=False)
    got = csv_records.read_csv(spark, path, split).toPandas().sort_values("row_index")
    assert list(got.columns) == [*want.columns, "row_index"]
    assert got["row_index"].tolist() == list(range(len(want)))
    # A short last record lacks fields; an empty field is null.
    assert got[list(want.columns)].fillna("").values.tolist() == want.fillna("").values.tolist()


def test_a_text_over_many_splits(spark, tmp_path):
    """Most splits lie inside one quoted field and hold quotes of their own."""
    path = str(tmp_path / "long.csv")
    inner = "\n".join(f'line {i}, said "{i}"' for i in range(400))
    pd.DataFrame({"id": ["1", "2"], "text": [inner, "short"]}).to_csv(path, index=False)
    rows = csv_records.read_csv(spark, path, 100).orderBy("row_index").collect()
    assert [(r.id, r.text) for r in rows] == [("1", inner), ("2", "short")]


def bytes_in(folder):
    return sum(os.path.getsize(os.path.join(at, name)) for at, _, names in os.walk(folder) for name in names)


def large(path):
    """Rows of texts that hardly compress, with line feeds and quotes."""
    rng = random.Random(5)
    texts = [f'said "{rng.randbytes(600).hex()}",\n\n{rng.randbytes(300).hex()}\r\n{i}' for i in range(1200)]
    pd.DataFrame({"id": range(len(texts)), "text": texts}).to_csv(path, index=False)
    return list(enumerate(texts))


@pytest.mark.parametrize("split", [None, 5_000])
def test_records_are_written_once(spark, tmp_path, split):
    path = str(tmp_path / "large.csv")
    rows, before = large(path), bytes_in(scratch_dir(spark))
    # Many tasks, of one split or of several.
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "50000"}):
        read = csv_records.read_csv(spark, path, split)
        assert bytes_in(scratch_dir(spark)) - before < os.path.getsize(path)
        assert sorted((r.row_index, r.text) for r in read.collect()) == rows


def test_splits_that_change_between_the_passes_are_refused(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "large.csv")
    large(path)
    step = csv_records._stepped
    monkeypatch.setattr(csv_records, "_stepped", lambda lines: step(lines.where("block = 0")))
    with pytest.raises(Exception, match="cut otherwise"):
        csv_records.read_csv(spark, path, 50_000)


def test_query_over_more_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(driver_queries, "RANGE_ROWS", 10)
    rows = [(None if i % 40 == 7 else i * 7 % 90, f'a "b",\n{i}', "en", "s") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(driver_queries.QUERIES["csv_records"](spark, str(tmp_path)).collect(), key=lambda r: r.place)
    assert [r.place for r in found] == list(range(100))
    ids = sorted((row[0] for row in rows), key=lambda x: (x is not None, x))
    assert [r.doc_id for r in found] == ids
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted((str(row[0]), row[1]) for row in rows)


def test_files_are_numbered_each_for_itself(spark, tmp_path):
    for n in range(3):
        pd.DataFrame({"a": [f"{n}\n{i}" for i in range(5)]}).to_csv(tmp_path / f"{n}.csv", index=False)
    rows = csv_records.read_csv(spark, str(tmp_path), 12, file="file").collect()
    assert sorted((r.file[-5], r.row_index, r.a) for r in rows) == [
        (str(n), i, f"{n}\n{i}") for n in range(3) for i in range(5)
    ]
    (tmp_path / "other.csv").write_text("b\n1\n")
    with pytest.raises(ValueError, match="different headers"):
        csv_records.read_csv(spark, str(tmp_path))


def test_odd_files(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    assert csv_records.read_csv(spark, str(tmp_path / "empty.csv")).collect() == []
    (tmp_path / "head.csv").write_text("a,b")
    found = csv_records.read_csv(spark, str(tmp_path / "head.csv"))
    assert found.columns == ["a", "b", "row_index"] and found.collect() == []
    (tmp_path / "names.csv").write_text("a,,a\n1,2,3,4\n5\n")
    rows = csv_records.read_csv(spark, str(tmp_path / "names.csv")).orderBy("row_index").collect()
    assert rows[0].asDict() == {"a": "1", "column_1": "2", "a.1": "3", "row_index": 0}
    assert tuple(rows[1]) == ("5", None, None, 1)


def test_read_any_reads_what_was_written(spark, tmp_path):
    path = str(tmp_path / "said.csv")
    (tmp_path / "said.csv").write_text('id,text\n1,"he said ""hi"", ok"\n2,"two\nlines"\n3,plain\n')
    rows = tables.read_any(spark, path).orderBy("row_index").collect()
    assert [(r.row_index, r.id, r.text) for r in rows] == [
        (0, "1", 'he said "hi", ok'), (1, "2", "two\nlines"), (2, "3", "plain")
    ]


def test_read_any_writes_each_file_once(spark, tmp_path):
    rows = [large(str(tmp_path / f"{n}.csv")) for n in range(2)]
    folder = tmp_path / "both.csv"
    folder.mkdir()
    for n in range(2):
        (tmp_path / f"{n}.csv").rename(folder / f"{n}.csv")
    before = bytes_in(scratch_dir(spark))
    read = tables.read_any(spark, str(folder))
    assert bytes_in(scratch_dir(spark)) - before < bytes_in(str(folder))
    assert sorted((r.row_index, r.text) for r in read.collect()) == sorted(rows[0] + rows[1])
