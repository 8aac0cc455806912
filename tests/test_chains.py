import random

import numpy as np
import pytest
from conftest import rows

from sftframe.operators import chains as C
from sftframe.operators import decoding as G
from sftframe.options import DecodeOptions

EOS = 9


def loop(ids, table, order, cap):
    """The same by a plain loop."""
    ids, made = list(ids or []), []
    while len(ids) >= order and len(made) < cap:
        following = table.get(tuple(ids[-order:]))
        if following is None or following == EOS:
            break
        ids.append(following)
        made.append(following)
    return made


@pytest.mark.parametrize("order", [1, 2, 3])
def test_against_a_loop(spark, order):
    draw = random.Random(order)
    sequences = [[draw.randrange(10) for _ in range(draw.randrange(12))] for _ in range(60)] + [[1, 2, 3] * 4]
    counts = {}
    for ids in sequences:
        for i in range(len(ids) - order):
            here = counts.setdefault(tuple(ids[i : i + order]), {})
            here[ids[i + order]] = here.get(ids[i + order], 0) + 1
    table = {context: min(after, key=lambda t: (-after[t], t)) for context, after in counts.items()}
    trained = C.next_tokens(spark.createDataFrame([(s,) for s in sequences], "input_ids ARRAY<INT>"), order)
    assert {tuple(c): n for c, n in rows(trained)} == table
    asked = [(i, s, "x") for i, s in enumerate(sequences)] + [(900, None, "x"), (901, [], None), (901, [], None), (902, [77] * 3, "y")]
    requests = spark.createDataFrame(asked, "request_id INT, ids ARRAY<INT>, start STRING")
    made = rows(C.generate(requests, trained, EOS, 20, order).select("request_id", "ids", "new_ids"))
    expected = [(i, ids, loop(ids, table, order, 20)) for i, ids, _ in asked]
    assert sorted(made, key=str) == sorted(expected, key=str)


def test_equal_to_the_decode_loop(spark):
    following = np.array([3, 9, 1, 4, 5, 3, 2, 7, 0, 9])

    def make_scorer():
        return lambda contexts: np.eye(10)[following[[ids[-1] for ids in contexts]]]

    requests = spark.createDataFrame([(i, [i % 10, (i * 7) % 10]) for i in range(40)], "request_id INT, ids ARRAY<INT>")
    table = spark.createDataFrame([([i], int(n)) for i, n in enumerate(following)], "context ARRAY<INT>, next INT")
    by_loop = G.generate(requests, make_scorer, EOS, DecodeOptions(max_new_tokens=15))
    by_query = C.generate(requests, table, EOS, 15).select(*by_loop.columns)
    assert sorted(rows(by_query)) == sorted(rows(by_loop))


def test_empty_and_bounds(spark):
    table = spark.createDataFrame([([1], 1), ([2], None)], "context ARRAY<INT>, next INT")
    requests = spark.createDataFrame([(1, [1]), (2, [2])], "request_id INT, ids ARRAY<INT>")
    assert sorted(rows(C.generate(requests, table, EOS, 3).select("request_id", "new_ids"))) == [(1, [1, 1, 1]), (2, [])]
    assert rows(C.generate(requests, table, EOS, 0).select("new_ids")) == [([],), ([],)]
    assert rows(C.generate(requests.limit(0), table, EOS, 3)) == []
    with pytest.raises(ValueError):
        C.generate(requests, table, EOS, 3, 0)
