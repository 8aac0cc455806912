from __future__ import annotations

import re

import corpus_pipeline as pipeline
import __spark_entry__ as entry
import pytest
from check import compare, sql_tables
from sftframe.llm import decontam, pieces, pii, quality
from sftframe.llm.queries import ORACLE, QUERIES

from .test_decontam import expected as contamination
from .test_jaccard import expected as duplicates

SF = "/root/testdata/sf0.001"


def test_run_against_brute_force(spark):
    """The stages again, each by a plain loop; the classifier's scores are taken from its own query."""
    docs, labels, items = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels", "benchmark"))
    good = {r["doc_id"] for r in quality.digest(docs, labels).collect() if r["predicted"]}
    left = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good]
    left = [row for row, (name, _, least) in zip(left, duplicates(left)) if name == least]
    listed = [tuple(r) for r in items.collect()]
    left = [(i, t) for i, t in left if not contamination(t, listed)[-1]]
    wanted = {i: pii.redact(t or "", pii.find(t or "")) for i, t in left}
    result = pipeline.run(spark, SF)
    assert result.columns == [*docs.columns, "pieces", "scores"]
    rows = result.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == wanted and len(rows) == len(wanted)
    back = {r["doc_id"]: r["back"] for r in pieces.decode(result, out="back").collect()}
    assert back == wanted


def test_stages():
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "encoding"]
    assert entry.queries()["pipeline"] is pipeline.run


def test_every_stage_takes_odd_rows(spark, docs, no_docs):
    for rows in (docs, no_docs):
        for _, stage in pipeline.STAGES[:-1]:
            assert stage(spark, rows, SF).columns == docs.columns
        assert pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, name):
    assert compare(spark, sql_tables(SF), SF, name) is None


def test_names():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and decontam.WINDOW == 13
