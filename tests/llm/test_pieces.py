import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sftframe.llm import pieces as P
from sftframe.llm import textcore as X

HARD = ["", "a", " ", "  two  spaces ", "x▁y", "naïve café 梦𝒳\n\ttab", "the the the", "\x00\x01", "é" * 40]


@pytest.fixture(scope="module")
def vocabulary():
    return P.load()


def brute(text, n, v):
    """The n best of the whole lattice by lists of paths per character."""
    scores = {v.piece_bytes[k]: (int(k), float(s)) for _, ids, values in v.by_length.values() for k, s in zip(ids, values)}
    if not text:
        return [0.0]
    t = " " + text
    best = [[0.0]] + [[] for _ in t]
    for end in range(1, len(t) + 1):
        paths = []
        for begin in range(max(0, end - 24), end):
            hit = scores.get(t[begin:end].encode())
            if hit or end - begin == 1:
                paths += [p + (hit[1] if hit else v.unknown) for p in best[begin]]
        best[end] = sorted(paths, reverse=True)[:n]
    return best[-1]


def test_n_best_against_brute_force(vocabulary):
    rng = random.Random(3)
    texts = HARD + ["".join(rng.choice("abc eth ▁é\n") for _ in range(rng.randint(1, 30))) for _ in range(150)]
    buffer, starts = X.text_bytes(pa.array(texts))
    for text, found in zip(texts, P.segment(buffer, starts, vocabulary, 4)):
        assert [s for s, _ in found] == brute(text, 4, vocabulary), text
        assert len({tuple(i) for _, i in found}) == len(found)
        assert all(P.decode_ids(i, vocabulary).decode() == text for _, i in found)


def test_one_best_is_the_first_of_many(vocabulary):
    buffer, starts = X.text_bytes(pa.array(HARD))
    for one, many in zip(P.segment(buffer, starts, vocabulary, 1), P.segment(buffer, starts, vocabulary, 3)):
        assert one[0][0] == many[0][0] and np.array_equal(one[0][1], many[0][1])


def test_digest_and_round_trip(docs, texts):
    rows = P.digest(docs).collect()
    assert len(rows) == len(texts) + 2 and all(r["decoded"] for r in rows)
    assert all(r["nbest_scores"] == sorted(r["nbest_scores"], reverse=True) for r in rows)
    coded = P.encode_best(docs).select("doc_id", "text", "pieces")
    back = P.decode(coded, out="back").where(~F.col("text").eqNullSafe(F.col("back")))
    assert back.count() == 0
    every = P.encode(docs, n=2).select("text", F.col("segmentations")[0]["pieces"].alias("best"), "segmentations").collect()
    assert all((r["segmentations"] is None) == (r["text"] is None) for r in every)


def test_empty_table_and_clash(docs, no_docs):
    assert P.digest(no_docs).collect() == [] and P.encode(no_docs).collect() == []
    with pytest.raises(ValueError):
        P.encode(docs, out="TEXT")
