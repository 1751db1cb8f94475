"""The pipeline and the guard around the subpackage."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from test_operators import DOCS, WORDS, made, near_by_brute_force

import corpus_pipeline
from wearlake.llm.oracles import ORACLES
from wearlake.llm.queries import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


def test_names():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(ORACLES) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("stage", range(5))
def test_stage_on_odd_rows(spark, stage):
    good = made([f"{w}{i}" for w in WORDS for i in range(40)] + ["the", "of"] * 60, 1, 200)
    rows = [(1, None, "en"), (2, "", "en"), (3, good, "en"), (3, good, "en"), (None, good, "en"), (4, good, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"n_chars": F.length("text").cast("long"), "kept": F.lit("x")})
    run = corpus_pipeline.STAGES[stage][1]
    out = run(spark, docs, SF)
    if stage < 4:
        assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} >= {3}
    assert run(spark, docs.limit(0), SF).collect() == []


def test_pipeline_keeps_one_of_each_and_drops_the_rest(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    left = [(r.doc_id, r.text) for r in out]
    given = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len({i for i, _ in left}) == len(left) and {i for i, _ in left} < given
    # After the near-duplicate stage no two documents are linked any more.
    assert all(group == i for i, (_, group) in near_by_brute_force(left, 80).items())
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(item in text for _, text in left for item in items)
    assert all(bytes(r.decoded) == r.text.encode() for r in out)


def test_entry_without_the_subpackage(tmp_path):
    """Without the folders the other queries are still there."""
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[:2] == ['wearlake', 'llm'] or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "import __spark_entry__ as entry\n"
        "names = set(entry.queries())\n"
        "assert names == set(entry.oracle_sql()) and 'device_wear_days' in names and 'pipeline' not in names\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
