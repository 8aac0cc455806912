import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.operators import compare as M
from sftframe.operators import decoding as G
from sftframe.options import DecodeOptions

NEG = float("-inf")


def dense(spark, *logits):
    return spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(logits)], "request_id BIGINT, logits ARRAY<DOUBLE>")


def test_top_k_keeps_ties(spark):
    df = dense(spark, [3, 2, 2, 1], [1, 5, 4, 4.5], [1, 2])
    made = [r[0] for r in rows(df.select(G.top_k(F.col("logits"), 2)))]
    assert made == [[3, 2, 2, NEG], [NEG, 5, NEG, 4.5], [1, 2]]
    long = df.select("request_id", F.posexplode("logits").alias("token_id", "logit"))
    assert G.long_top_k(long, ["request_id"], 2).count() == 7


def test_greedy_takes_the_lowest_id_of_equal_scores(spark):
    df = dense(spark, [1, 7, 7], [9, 9, 9], [0, 1, 2])
    assert [r[0] for r in rows(df.select(G.greedy(F.col("logits"))))] == [1, 0, 2]
    long = df.select("request_id", F.posexplode("logits").alias("token_id", "logit"))
    assert sorted(rows(G.long_greedy(long, ["request_id"]))) == [(0, 1), (1, 0), (2, 2)]
    assert rows(G.to_dense(long, ["request_id"]).orderBy("request_id")) == rows(df)


def test_crop_keeps_the_end(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],)], "ids ARRAY<INT>")
    assert df.select(G.crop(F.col("ids"), 3)).first()[0] == [3, 4, 5]


def test_repetition_penalty(spark):
    df = dense(spark, [2.2, -1.0, 3.0]).withColumn("history", F.array(F.lit(0), F.lit(1), F.lit(0)))
    made = df.select(G.repetition_penalty(F.col("logits"), F.col("history"), 1.1)).first()[0]
    assert made == pytest.approx([2.0, -1.1, 3.0])
    opts = DecodeOptions(repetition_penalty=2.0)
    assert df.select(G.next_token(F.col("logits"), opts, history=F.col("history"))).first()[0] == 2


def test_probabilities(spark):
    made = dense(spark, [2.0, 0.0, NEG]).select(G.probabilities(F.col("logits"), 2.0)).first()[0]
    assert made == pytest.approx([np.e / (np.e + 1), 1 / (np.e + 1), 0.0])


def test_draws_follow_the_softmax_and_repeat(spark):
    logits = F.array(*[F.lit(float(v)) for v in (1.0, 0.0, 2.0, -1.0)])
    opts = DecodeOptions(temperature=0.7, top_k=3)
    draws = spark.range(20000).select(G.next_token(logits, opts, F.col("id")).alias("t"))
    counts = dict(rows(draws.groupBy("t").count()))
    weights = np.exp(np.array([1.0, 0.0, 2.0]) / 0.7)
    assert set(counts) == {0, 1, 2}
    assert [counts[t] / 20000 for t in range(3)] == pytest.approx((weights / weights.sum()).tolist(), abs=0.015)
    again = spark.range(20000).repartition(3).select(G.next_token(logits, opts, F.col("id")).alias("t"))
    assert dict(rows(again.groupBy("t").count())) == counts


VOCAB, EOS = 6, 5


def counting_model(longest=100):
    """Scores that point to the next higher token; after 4 comes EOS."""
    size, eos = VOCAB, EOS

    def make():
        def scorer(contexts):
            assert max(len(ids) for ids in contexts) <= longest
            scores = np.zeros((len(contexts), size))
            for row, ids in zip(scores, contexts):
                row[min(ids[-1] + 1, eos)] = 1.0
            return scores

        return scorer

    return make


def requests(spark, *ids):
    return spark.createDataFrame(list(enumerate(ids)), "request_id BIGINT, ids ARRAY<INT>")


def test_generation_stops_at_eos_per_request(spark):
    df = requests(spark, [2], [0], [4], [9, 1])
    made = G.generate(df, counting_model(), EOS, DecodeOptions(max_new_tokens=100, request_batch=2))
    assert rows(made.orderBy("request_id").select("ids", "new_ids")) == [
        ([2], [3, 4]),
        ([0], [1, 2, 3, 4]),
        ([4], []),
        ([9, 1], [2, 3, 4]),
    ]


def test_generation_cap(spark):
    made = G.generate(requests(spark, [0]), counting_model(), EOS, DecodeOptions(max_new_tokens=2))
    assert made.first()["new_ids"] == [1, 2]


def test_cropping_loses_no_new_tokens(spark):
    df = requests(spark, [0, 0, 0, 0, 0])
    made = G.generate(df, counting_model(longest=3), EOS, DecodeOptions(context_size=3))
    assert made.first()["new_ids"] == [1, 2, 3, 4]


def test_generation_with_draws_repeats_for_any_partitioning(spark):
    def make():
        return lambda contexts: np.tile([1.0, 0.5, 0.0, 2.0, 1.0, -2.0], (len(contexts), 1))

    df = requests(spark, *[[i % 5] for i in range(40)])
    opts = DecodeOptions(temperature=1.0, top_k=4, max_new_tokens=6, request_batch=7)
    one = sorted(rows(G.generate(df.coalesce(1), make, EOS, opts).select("request_id", "new_ids")))
    many = sorted(rows(G.generate(df.repartition(5), make, EOS, opts).select("request_id", "new_ids")))
    assert one == many
    drawn = {t for _, ids in one for t in ids}
    assert drawn <= {0, 1, 3, 4} and len(drawn) > 2


def test_prompts_and_comparison(spark):
    prompts = M.prompts(M.default_prompts(spark))
    assert prompts.count() == 5 and prompts.agg(F.min("prompt_id")).first()[0] == 1

    tuned = M.respond(prompts, "tuned", lambda: lambda texts: texts.str.len().astype(str))
    base = M.respond(prompts, "base", lambda: lambda texts: texts.str.upper()).where("prompt_id > 1")
    made = M.compare(prompts, tuned, base).orderBy("prompt_id").collect()
    assert made[0]["base_response"] is None and made[0]["tuned_response"] == str(len(prompts.orderBy("prompt_id").first()["prompt"]))
    assert made[1]["base_response"].startswith("BELOW IS")
    alone = M.compare(prompts, tuned).collect()
    assert len(alone) == 5 and all(r["base_response"] is None for r in alone)


def test_response_is_cut_after_the_prompt(spark):
    vocab = spark.createDataFrame([("a", 0, False), ("b", 1, False), ("<eos>", 2, True)], "token STRING, id INT, special BOOLEAN")
    df = spark.createDataFrame([(1, 2, [0, 0, 1, 0, 2]), (2, 3, [0, 1, 1]), (3, 5, [0])], "k BIGINT, n_prompt INT, output_ids ARRAY<INT>")
    plain = rows(M.cut_response(df, vocab).orderBy("k").select("response"))
    whole = rows(M.cut_response(df, vocab, skip_special=False).orderBy("k").select("response"))
    assert plain == [("ba",), ("",), ("",)]
    assert whole == [("ba<eos>",), ("",), ("",)]


def test_generation_and_columns_draw_the_same_tokens(spark):
    scores = np.random.default_rng(1).normal(size=(1, 12))
    opts = DecodeOptions(top_k=6, temperature=0.9, max_new_tokens=1, seed=7)
    made = G.generate(requests(spark, [1], [1], [1]), lambda: lambda contexts: np.repeat(scores, len(contexts), 0), -1, opts)
    df = made.select("request_id", "new_ids", F.array(*[F.lit(float(s)) for s in scores[0]]).alias("logits"))
    drawn = df.select("new_ids", G.next_token(F.col("logits"), opts, F.col("request_id"), F.lit(0)).alias("token"))
    assert all(r["new_ids"] == [r["token"]] for r in drawn.collect())


def test_greedy_choice_copies_no_scores():
    import tracemalloc

    scores = np.zeros((64, 20_000), np.bool_)
    scores[np.arange(64), np.arange(64) * 7] = True
    scores[5, 19_000] = True
    for top_k in (None, 3):
        tracemalloc.start()
        chosen = G._choose(scores, [[1]] * 64, [(0, k, 0) for k in range(64)], DecodeOptions(top_k=top_k))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert chosen.tolist() == [k * 7 for k in range(64)] and peak < scores.nbytes / 10
