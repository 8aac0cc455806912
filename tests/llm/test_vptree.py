from functools import reduce
from operator import add

import numpy as np
import pytest

from sftframe.llm import vptree as N


def brute(rows, asked, k):
    """Every row with a query's id asks; the ranks of an id run over the pairs of all of them."""
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    result = []
    for q in asked:
        asking = [v for i, v in usable if i == q]
        near = sorted((float(np.sqrt(reduce(add, ((a - b) * (a - b) for a, b in zip(own, v))))), i) for own in asking for i, v in usable if i != q and len(v) == len(own))
        result += [(q, rank, i, d) for rank, (d, i) in enumerate(near[:k], 1)]
    return result


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=6).astype(np.float32).astype(float).tolist()) for i in range(900)]
    rows += [(1000 + i, [0.5] * 6) for i in range(400)]
    rows += [(2000, None), (2001, [0.0] * 6), (2002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (2005, []), (2006, [1.0, 2.0]), (2007, [1.0, 3.0]), (None, [1.0] * 6), (3, rows[3][1])]
    return rows, spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").repartition(3)


def test_factor_one_is_exact(vectors, monkeypatch):
    rows, table = vectors
    found = sorted(tuple(r) for r in N.nearest(table, table.where("vec_id % 100 = 0 or vec_id > 2000 or vec_id = 3"), k=10).collect())
    asked = [*range(0, 900, 100), 3, *range(1000, 1400, 100), *range(2000, 2008)]
    assert found == sorted(brute(rows, asked, 10))


def test_a_smaller_factor_keeps_most(vectors):
    rows, table = vectors
    queries = table.where("vec_id % 20 = 0 and vec_id < 900")
    exact = {(r["query_id"], r["vec_id"]) for r in N.nearest(table, queries, k=10).collect()}
    near = {(r["query_id"], r["vec_id"]) for r in N.nearest(table, queries, k=10, factor=0.7, block=7).collect()}
    assert len(exact & near) / len(exact) >= 0.9


def test_few_candidates_and_empty_tables(spark, vectors):
    _, table = vectors
    assert [tuple(r)[:3] for r in N.nearest(table.where("vec_id in (2006, 2007)"), table.where("vec_id = 2006")).collect()] == [(2006, 1, 2007)]
    assert N.nearest(table.where("false"), table).collect() == [] and N.nearest(table, table.where("false")).collect() == []
    with pytest.raises(ValueError):
        N.nearest(table, table, factor=0)


def test_unequal_rows_of_one_query_id_all_ask(spark, vectors):
    rows, table = vectors
    more = [(100, rows[7][1]), (100, rows[8][1]), (100, rows[8][1])]
    both = table.unionByName(spark.createDataFrame(more, "vec_id BIGINT, embedding ARRAY<DOUBLE>"))
    found = sorted(tuple(r) for r in N.nearest(both, both.where("vec_id = 100"), k=7, block=2).collect())
    assert found == brute([*rows, *more], [100], 7)


def test_clashing_column_names(vectors):
    rows, table = vectors
    named = table.withColumnsRenamed({"vec_id": "vector", "embedding": "block"})
    found = N.nearest(named, named.where("vector = 100"), k=3, vec_id="vector", vector="block").collect()
    assert sorted(tuple(r) for r in found) == brute(rows, [100], 3)
