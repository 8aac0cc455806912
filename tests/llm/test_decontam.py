import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sftframe.llm import decontam as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]+", lambda m: m[0].lower(), (text or "").encode()))


def expected(text, items):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        w = words(item)
        for a in range(max(len(w) - 12, 1 if w else 0)):
            window = w[a : a + 13]
            for at in range(len(own) - len(window) + 1):
                if own[at : at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    found.add("" if name is None else str(name))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(own), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(own)


@pytest.fixture(scope="module")
def items(spark, texts):
    long = texts[2].split()
    rows = [(10, " ".join(long[3:40])), (9, " ".join(long[10:20])), (2, texts[5]), (2, texts[5]), (None, "Naïve  梦"), (4, None), (5, "..."), (6, "never seen words " * 8), (7, "a")]
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING")


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_matches_brute_force(docs, items, block, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    listed = [tuple(r) for r in items.collect()]
    wanted = sorted(((r["doc_id"], *expected(r["text"], listed)) for r in docs.collect()), key=str)
    found = D.marked(docs.select("doc_id", "text"), items, block_bytes=block)
    rows = found.select("doc_id", "n_words", D.n_hit(), D.F.size("items").cast("long"), D.F.sha2(D.F.concat_ws(",", D.F.array_sort("items")), 256), D.contaminated()).collect()
    assert sorted((tuple(r) for r in rows), key=str) == wanted
    assert any(w[-1] for w in wanted) and not all(w[-1] for w in wanted)


def test_clean_rows_stay_as_they_are(docs, items):
    listed = [tuple(r) for r in items.collect()]
    kept = D.clean(docs, items)
    assert kept.columns == docs.columns
    wanted = [tuple(r) for r in docs.collect() if not expected(r["text"], listed)[-1]]
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted(wanted, key=str)


def test_cut_takes_the_spans_out(spark):
    item = " ".join(f"w{k}" for k in range(15))
    docs = spark.createDataFrame([(1, f"before {item}, after"), (2, "é nothing"), (3, None)], "doc_id BIGINT, text STRING")
    items = spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING")
    assert {r["doc_id"]: r["text"] for r in D.cut(docs, items).collect()} == {1: "before , after", 2: "é nothing", 3: None}


def test_no_items_and_no_documents(docs, no_docs, items):
    assert D.digest(no_docs, items).collect() == []
    assert all(not r["contaminated"] and r["n_hit"] == 0 for r in D.digest(docs, items.where("false")).collect())


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4), min_size=1, max_size=8))
def test_index_finds_every_occurrence(symbols, patterns):
    index = D.FMIndex(np.array(symbols))
    matrix = np.zeros((len(patterns), 4), np.int64)
    for k, p in enumerate(patterns):
        matrix[k, : len(p)] = p
    low, high = index.search(matrix, np.array([len(p) for p in patterns]))
    for a, b, p in zip(low, high, patterns):
        wanted = [i for i in range(len(symbols) - len(p) + 1) if symbols[i : i + len(p)] == p]
        assert sorted(index.locate(np.arange(a, b)).tolist() if b > a else []) == wanted
