from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sftframe.operators import subword as S


def one_by_one(words, merges, least=2):
    """Every pair is counted again after every single merge."""
    left = {tuple(f"{b:02X}" for b in w.encode()): n for w, n in words.items() if w}
    found, pieces = [], set()
    while len(found) < merges:
        counts = Counter()
        for word, n in left.items():
            for pair in zip(word, word[1:]):
                counts[pair] += n
        open_pairs = [(-n, *p) for p, n in counts.items() if n >= least and "".join(p) not in pieces]
        if not open_pairs:
            break
        n, a, b = min(open_pairs)
        found.append((len(found), a, b, a + b, -n))
        pieces.add(a + b)
        left = {_merged(word, a, b): n for word, n in left.items()}
    return found


def _merged(word, a, b):
    out, at = [], 0
    while at < len(word):
        if word[at : at + 2] == (a, b):
            out.append(a + b)
            at += 2
        else:
            out.append(word[at])
            at += 1
    return tuple(out)


WORDS = {" the": 90, " then": 40, " other": 35, "the": 20, " banana": 12, " bandana": 9, "aaaa": 7, "aaaaa": 5, " é": 11, " été": 6, "  ": 8, "x": 50, "\n": 4, "abab": 3, " rare": 1, "": 9}


def table(spark, words):
    return spark.createDataFrame(list(words.items()), "token STRING, n INT").repartition(3)


@pytest.mark.parametrize("merges", [0, 1, 7, 500])
def test_rounds_are_merges_one_by_one(spark, merges):
    found = [tuple(r) for r in S.train(table(spark, WORDS), merges).orderBy("rank").collect()]
    assert found == one_by_one(WORDS, merges)


def test_a_round_takes_several_merges(spark):
    words = {f"{chr(97 + k)}{chr(98 + k)}": 100 - k for k in range(0, 20, 2)}
    best = S.pair_counts(S.bracketed(table(spark, words))).orderBy("n", ascending=False).collect()
    assert len(S._settled(best, 99)) == 10 and len(S._settled(best, 4)) == 4
    assert [tuple(r) for r in S.train(table(spark, words), 9).orderBy("rank").collect()] == one_by_one(words, 9)


MERGES = one_by_one(WORDS, 40)


def by_rank(word):
    pieces = tuple(f"{b:02X}" for b in word.encode())
    for _, a, b, *_ in MERGES:
        pieces = _merged(pieces, a, b)
    return list(pieces)


@given(st.text(alphabet="the banaéx", max_size=30))
@settings(max_examples=200, deadline=None)
def test_heap_merges_by_rank(word):
    id_of = {f"{b:02X}": b for b in range(256)} | {p: 256 + r for r, _, _, p, _ in MERGES}
    merger = S.Merger({(id_of[a], id_of[b]): id_of[p] for _, a, b, p, _ in MERGES}, "<|endoftext|>", 999)
    assert merger.ids(word) == [id_of[p] for p in by_rank(word)]


def test_round_trip_and_edges(spark):
    merges = spark.createDataFrame(MERGES, S.MERGES)
    texts = ["the other banana", "", None, " été 梦 𝒳\n\n", "a<|endoftext|>b", "aaaaaaaaa" * 50]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "pieces INT, text STRING").repartition(2)
    encoded = S.encode(docs, {"text": "ids"}, merges)
    vocab = S.vocabulary(merges)
    assert {r["pieces"]: r["back"] for r in S.decode(encoded, {"ids": "back"}, vocab).collect()} == dict(enumerate(texts))
    ids = {r["pieces"]: r["ids"] for r in encoded.collect()}
    assert ids[1] == [] and ids[2] is None and ids[4][1] == 256 + len(MERGES) and len(ids[5]) < 450
    shown = {r["pieces"]: r["back"] for r in S.decode(encoded, {"ids": "back"}, vocab, skip_special=True).collect()}
    assert shown[4] == "ab" and vocab.count() == 256 + len(MERGES) + 2
    with pytest.raises(ValueError):
        S.train(docs, -1)


def test_no_words(spark):
    assert S.train(table(spark, {"": 3}), 5).collect() == [] and S.train(table(spark, WORDS).where("false"), 5).collect() == []


def test_a_round_joins_nothing_and_shuffles_sums_twice(spark):
    plan = S.pair_counts(S.bracketed(table(spark, WORDS)))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2


def test_pending_merges_count_like_written_ones(spark):
    pending = [(97, 97, 256), (256, 256, 257), (97, 98, 258)]
    names = [*S.BYTES, "6161", "61616161", "6162"]
    words = S.bracketed(table(spark, {"a" * k: k for k in range(1, 12)} | {"abab": 3, "xaab": 2, "é": 1}))
    written = words.mapInArrow(S._merged_words(pending), S.WORDS)
    lists = {tuple(r["pieces"]): r["n"] for r in written.collect()}
    assert lists[(257, 257, 256, 97)] == 11 and lists[(258, 258)] == 3 and lists[(120, 256, 98)] == 2 and lists[(256, 97)] == 3
    left = sorted(map(tuple, S.pair_counts(words, pending, names).collect()))
    assert left == sorted(map(tuple, S.pair_counts(written, [], names).collect())) and len(left) > 4


def test_ids_are_made_once_for_several_decodings(spark):
    merges = spark.createDataFrame(MERGES, S.MERGES)
    docs = spark.createDataFrame([("the banana",), (None,)], "text STRING")
    encoded, vocab = S.encode(docs, {"text": "ids"}, merges), S.vocabulary(merges)
    both = S.decode(S.decode(encoded, {"ids": "shown"}, vocab), {"ids": "plain"}, vocab, skip_special=True).drop("ids")
    assert both._jdf.queryExecution().executedPlan().toString().count("pieces(regexp") == 1
    assert sorted(map(str, both.collect())) == sorted(map(str, docs.select("text", "text", "text").toDF("text", "shown", "plain").collect()))
