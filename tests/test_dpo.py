import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.functions.numeric import log_sum_exp, neg_log_sigmoid, softmax
from sftframe.operators import dpo as D
from sftframe.options import PreferenceOptions

PAIR = "pair_id BIGINT, batch BIGINT, chosen_logp DOUBLE, rejected_logp DOUBLE, ref_chosen_logp DOUBLE, ref_rejected_logp DOUBLE, chosen_length BIGINT, rejected_length BIGINT"


def test_loss_and_rewards_of_one_pair(spark):
    df = spark.createDataFrame([(1, 0, -10.0, -12.0, -11.0, -11.0, 5, 3)], PAIR)
    row = D.score(df, PreferenceOptions(beta=0.1, length_alpha=0.4), ["batch"]).pairs.first()
    assert row["loss_argument"] == pytest.approx(1.0)
    assert row["loss"] == pytest.approx(0.3133, abs=1e-4)
    assert row["chosen_reward"] == pytest.approx(0.1) and row["rejected_reward"] == pytest.approx(-0.1)
    assert row["reward_margin"] == pytest.approx(0.2) and row["accuracy"] == 1.0


def test_extreme_loss_arguments(spark):
    df = spark.createDataFrame([(-3000.0,), (0.0,), (3000.0,)], "x DOUBLE")
    made = [r[0] for r in rows(df.select(neg_log_sigmoid(F.col("x"))))]
    assert made == pytest.approx([3000.0, math.log(2), 0.0])


def test_equal_rewards_are_not_accurate(spark):
    df = spark.createDataFrame([(1, 0, -10.0, -10.0, -11.0, -11.0, 5, 5)], PAIR)
    assert D.score(df, PreferenceOptions(), ["batch"]).pairs.first()["accuracy"] == 0.0


def test_missing_lengths_are_refused(spark):
    df = spark.createDataFrame([(1, 0, -10.0, -10.0, -11.0, -11.0, 5, None)], PAIR)
    with pytest.raises(ValueError, match="lacks"):
        D.score(df.drop("rejected_length"), PreferenceOptions(), ["batch"])
    with pytest.raises(Exception, match="rejected_length is null"):
        D.score(df, PreferenceOptions(), ["batch"]).pairs.collect()


def test_length_desensitisation(spark):
    df = spark.createDataFrame(
        [(4, 2, [-1.0] * 4, [-2.0] * 2)],
        "chosen_length BIGINT, rejected_length BIGINT, chosen_logps ARRAY<DOUBLE>, rejected_logps ARRAY<DOUBLE>",
    )
    row = D.length_desensitised(df, 0.4).first()
    assert row["chosen_logp"] == pytest.approx(-2.8) and row["rejected_logp"] == pytest.approx(-4.0)


def test_policy_weight_is_at_most_one(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0, 2, 2), (-2.0, -1.0, 2, 1)],
        "chosen_weight_sum DOUBLE, rejected_weight_sum DOUBLE, chosen_length BIGINT, rejected_length BIGINT",
    )
    assert [r[0] for r in rows(df.select(D.policy_weight()))] == pytest.approx([1.0, math.exp(-2.0)])


def test_log_sum_exp_and_softmax(spark):
    values = [[1000.0, 1000.0], [-1000.0, 0.0, 1.5], [3.0]]
    df = spark.createDataFrame([(v,) for v in values], "v ARRAY<DOUBLE>")
    made = rows(df.select(log_sum_exp(F.col("v")), softmax(F.col("v"))))
    for (lse, shares), value in zip(made, values):
        x = np.array(value)
        assert lse == pytest.approx(x.max() + np.log(np.exp(x - x.max()).sum()))
        assert shares == pytest.approx((np.exp(x - x.max()) / np.exp(x - x.max()).sum()).tolist())


def scored_places(logits, ids, loss_mask, nll_zero=True):
    """Brute force over one padded sequence: scores of place i are about token i + 1; both wrap."""
    n = len(ids)
    labels, mask = np.roll(ids, -1), np.roll(loss_mask, -1).astype(bool)
    logp = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    taken = logp[np.arange(n), np.where(mask, labels, 0)] * mask
    realigned = np.roll(taken, 1)
    weight = ((realigned - np.log(np.exp(2 * logp).sum(axis=1))) * mask).sum()
    counted = mask[:-1] & (labels[:-1] != 0)
    return {
        "logp": realigned[1:].sum(),
        "length": int(mask.sum()),
        "nll_sum": -(taken[:-1] * counted).sum(),
        "nll_count": int(counted.sum()),
        "logit_sum": logits[mask].sum(),
        "weight_sum": weight if not mask[-1] else None,
        "labels": labels,
        "mask": mask,
    }


def test_sums_of_places_against_brute_force(spark):
    rng = np.random.default_rng(5)
    places, expected = [], {}
    for pair in range(6):
        for side in ("chosen", "rejected"):
            n, vocab = 7, 5
            ids = rng.integers(0, vocab, n)
            # The third pair was truncated from the front: its first token belongs to the completion.
            start = 0 if pair == 2 else int(rng.integers(1, 4))
            loss_mask = np.array([1 if start <= i < n - (pair % 2) else 0 for i in range(n)])
            logits = rng.normal(size=(n, vocab)) * 3
            want = scored_places(logits, ids, loss_mask)
            expected[pair, side] = want
            for i in range(n):
                row = (pair, side, i, int(want["mask"][i]), i == n - 1, int(want["labels"][i]), [float(v) for v in logits[i]])
                places.append(row)
    df = spark.createDataFrame(
        places,
        "pair_id BIGINT, side STRING, pos BIGINT, mask INT, is_last BOOLEAN, label_id INT, logits ARRAY<DOUBLE>",
    )
    scored = D.realigned(D.label_scores(df, weighting=True), ["pair_id"])
    by_side = {(r["pair_id"], r["side"]): r for r in D.sequence_sums(scored, ["pair_id"]).collect()}
    by_pair = {r["pair_id"]: r for r in D.pair_sums(scored, ["pair_id"]).collect()}
    for (pair, side), want in expected.items():
        for name in ("logp", "length", "nll_sum", "nll_count", "logit_sum"):
            assert by_side[pair, side][name] == pytest.approx(want[name]), (pair, side, name)
            assert by_pair[pair][f"{side}_{name}"] == pytest.approx(want[name])
        if want["weight_sum"] is not None:
            assert by_pair[pair][f"{side}_weight_sum"] == pytest.approx(want["weight_sum"])


def test_nll_may_count_label_zero(spark):
    df = spark.createDataFrame(
        [(1, "chosen", 0, 1, False, 0, -1.0), (1, "chosen", 1, 1, False, 3, -2.0), (1, "rejected", 0, 1, False, 3, -2.0)],
        "pair_id BIGINT, side STRING, pos BIGINT, mask INT, is_last BOOLEAN, label_id INT, logp DOUBLE",
    )
    skipped = D.pair_sums(df, ["pair_id"]).first()
    counted = D.pair_sums(df, ["pair_id"], PreferenceOptions(nll_mask="loss_mask")).first()
    assert (skipped["chosen_nll_sum"], skipped["chosen_nll_count"]) == (2.0, 1)
    assert (counted["chosen_nll_sum"], counted["chosen_nll_count"]) == (3.0, 2)


def test_long_scores_equal_dense_ones(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame(
        [(i, [float(v) for v in rng.normal(size=6)], int(rng.integers(6))) for i in range(20)],
        "place BIGINT, logits ARRAY<DOUBLE>, label_id INT",
    )
    dense = rows(D.label_scores(df).orderBy("place").select("logp", "logit_sum"))
    long = df.select("place", "label_id", F.posexplode("logits").alias("token_id", "logit"))
    summed = rows(D.long_label_scores(long, ["place"]).orderBy("place").select("logp", "logit_sum"))
    assert np.allclose(dense, summed)


def test_reference_scores_come_from_the_pair_or_a_table(spark):
    df = spark.createDataFrame([(1, 0, -10.0, -12.0, -11.0, -11.5, 5, 3)], PAIR)
    bare = df.drop("ref_chosen_logp", "ref_rejected_logp")
    table = df.select("pair_id", "ref_chosen_logp", "ref_rejected_logp")
    assert D.with_reference(df, None, ["pair_id"]) is df
    assert D.with_reference(bare, table, ["pair_id"]).first()["ref_rejected_logp"] == -11.5
    with pytest.raises(ValueError):
        D.with_reference(bare, None, ["pair_id"])


def test_extra_terms_and_their_order(spark):
    schema = PAIR + ", chosen_nll_sum DOUBLE, chosen_nll_count BIGINT, chosen_weight_sum DOUBLE, rejected_weight_sum DOUBLE, aux_loss DOUBLE"
    df = spark.createDataFrame(
        [(1, 0, -10.0, -12.0, -11.0, -11.0, 5, 3, 6.0, 3, -5.0, -3.0, 2.0), (2, 0, -9.0, -8.0, -9.0, -8.0, 1, 1, 2.0, 1, 0.0, 0.0, 4.0)],
        schema,
    )
    opts = PreferenceOptions(rpo_alpha=0.5, use_weighting=True, aux_loss_coef=0.1)
    scored = D.score(df, opts, ["batch"])
    base = [math.log1p(math.exp(-1.0)), math.log(2)]
    nll, weight = 8.0 / 4, [math.exp(-2.0), 1.0]
    expected = [(b + 0.5 * nll) * w + 0.1 * aux for b, w, aux in zip(base, weight, (2.0, 4.0))]
    assert [r[0] for r in rows(scored.pairs.orderBy("pair_id").select("loss"))] == pytest.approx(expected)
    metrics = scored.metrics.first()
    assert metrics["loss"] == pytest.approx(sum(expected) / 2) and metrics["nll_loss"] == nll and metrics["aux_loss"] == 3.0


def test_evaluation_metrics_have_a_prefix_and_user_metrics(spark):
    df = spark.createDataFrame([(1, 0, -10.0, -12.0, -11.0, -11.0, 5, 3)], PAIR)
    extra = {"longest": F.max("chosen_length")}
    metrics = D.score(df, PreferenceOptions(), ["batch"], extra_metrics=extra, evaluation=True).metrics
    assert {"eval_rewards_chosen", "eval_longest", "loss", "pairs"} <= set(metrics.columns)
    assert D.score(df, PreferenceOptions(), ["batch"], return_metrics=False).metrics is None


def test_ld_needs_token_scores(spark):
    df = spark.createDataFrame([(1, 0, -10.0, -12.0, -11.0, -11.0, 5, 3)], PAIR)
    with pytest.raises(ValueError, match="ld strategy"):
        D.score(df, PreferenceOptions(strategy="ld"), ["batch"])


def test_scores_wrap_around_and_one_sided_pairs_fail(spark):
    places = [(1, side, pos, 1, pos == 3, 2, -float(pos + 1)) for side in D.SIDES for pos in range(4)]
    df = spark.createDataFrame(places, "pair_id BIGINT, side STRING, pos BIGINT, mask INT, is_last BOOLEAN, label_id INT, logp DOUBLE")
    moved = rows(D.realigned(df, ["pair_id"]).where("side = 'chosen'").orderBy("pos").select("realigned_logp"))
    assert moved == [(-4.0,), (-1.0,), (-2.0,), (-3.0,)]
    assert D.pair_sums(df, ["pair_id"]).count() == 1
    with pytest.raises(Exception, match="lacks a side"):
        D.pair_sums(df.where("side = 'chosen'"), ["pair_id"]).collect()
