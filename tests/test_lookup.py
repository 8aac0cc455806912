import pytest
from conftest import rows

from sftframe.operators import prepare as P
from sftframe.operators import vocab as V
from sftframe.operators.lookup import BROADCAST_ROWS, is_small
from sftframe.sources import adapters


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame(
        [("a", 0, False), ("b", 1, False), ("[UNK]", 2, True), ("<|endoftext|>", 3, True), ("[PAD]", 4, True)],
        "token STRING, id INT, special BOOLEAN",
    )


@pytest.mark.parametrize("bound", [BROADCAST_ROWS, 0])
def test_encode_and_decode(spark, vocab, bound):
    df = spark.createDataFrame(
        [(1, ["a", "zz", "b", "a"]), (2, []), (3, ["<|endoftext|>"])], "k BIGINT, tokens ARRAY<STRING>"
    )
    encoded = P.encode(df, {"tokens": "ids"}, vocab, bound)
    assert sorted(rows(encoded.select("k", "ids"))) == [(1, [0, 2, 1, 0]), (2, []), (3, [3])]
    text = P.decode(encoded, {"ids": "text"}, vocab, bound=bound)
    plain = P.decode(text, {"ids": "plain"}, vocab, skip_special=True, bound=bound)
    assert sorted(rows(plain.select("k", "text", "plain"))) == [
        (1, "a[UNK]ba", "aba"),
        (2, "", ""),
        (3, "<|endoftext|>", ""),
    ]


def test_is_small(spark):
    assert is_small(spark.range(10), 10) and not is_small(spark.range(11), 10)


def test_vocabulary_ranks_by_count_then_token(spark):
    df = spark.createDataFrame([(["b", "a", "c", "b", "<|endoftext|>"],), (["c", "d"],)], "tokens ARRAY<STRING>")
    made = rows(V.build_vocab(df, "tokens", 3).orderBy("id"))
    assert made == [
        ("b", 0, 2, False),
        ("c", 1, 2, False),
        ("a", 2, 1, False),
        ("[UNK]", 3, 0, True),
        ("<|endoftext|>", 4, 0, True),
        ("[PAD]", 5, 0, True),
    ]
    ids = V.special_ids(V.build_vocab(df, "tokens", 3))
    assert (ids.unk_id, ids.eos_id, ids.pad_id, ids.vocab_size) == (3, 4, 5, 6)


def test_pad_is_added_only_when_missing(spark):
    table = spark.createDataFrame([("x", 50255), ("<|endoftext|>", 50256)], "token STRING, id INT")
    added, was_added = V.use_vocab(table, ["<|endoftext|>"])
    assert was_added and added.where("token = '[PAD]'").first()["id"] == 50257
    kept, was_added = V.use_vocab(added.select("token", "id"), ["<|endoftext|>"])
    assert not was_added and kept.count() == 3


def test_vocabulary_without_eos_is_refused(spark):
    with pytest.raises(ValueError, match="EOS"):
        V.special_ids(spark.createDataFrame([("[PAD]", 0)], "token STRING, id INT"))


def test_encode_text(spark, vocab):
    df = spark.createDataFrame([(1, "a"), (2, "ab")], "k BIGINT, t STRING")
    assert sorted(rows(P.encode_text(df, {"t": "ids"}, vocab).select("k", "ids"))) == [(1, [0]), (2, [2])]


def test_counting_splits_each_text_once(spark):
    texts = spark.createDataFrame([("a b a",), ("",)], "text STRING")
    plan = adapters.text_token_counts(texts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert sorted(rows(adapters.text_token_counts(texts))) == [(" a", 1), (" b", 1), ("a", 1)]


@pytest.mark.parametrize("bound", [BROADCAST_ROWS, 0])
def test_unknown_token_fails_without_an_unknown_id(spark, bound):
    vocab = spark.createDataFrame([("a", 0)], "token STRING, id INT")
    df = spark.createDataFrame([(1, ["a", "zz"])], "k BIGINT, tokens ARRAY<STRING>")
    with pytest.raises(Exception, match="lookup table lacks"):
        P.encode(df, {"tokens": "ids"}, vocab, bound).collect()


@pytest.mark.parametrize("bound", [BROADCAST_ROWS, 0])
def test_repeated_rows_stay_apart_and_repeated_keys_fail(spark, vocab, bound):
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["a"]), (1, ["a"])], "k BIGINT, tokens ARRAY<STRING>")
    made = sorted(rows(P.encode(df, {"tokens": "ids"}, vocab, bound).select("k", "ids")))
    assert made == [(1, [0]), (1, [0]), (1, [0, 1])]
    twice = vocab.unionByName(vocab.where("token = 'a'"))
    with pytest.raises(Exception, match="twice"):
        P.encode(df, {"tokens": "ids"}, twice, bound).collect()


@pytest.mark.parametrize("bound", [BROADCAST_ROWS, 0])
def test_unknown_ids_are_not_decoded(spark, vocab, bound):
    df = spark.createDataFrame([(1, [0, 55, 1])], "k BIGINT, ids ARRAY<INT>")
    with pytest.raises(Exception, match="lacks 55"):
        P.decode(df, {"ids": "text"}, vocab, bound=bound).collect()


def test_long_entries_are_not_small(spark):
    assert not is_small(spark.sql("select repeat('x', 1000) as token"), 10, most_bytes=900)
