import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.functions import arrays as A
from sftframe.operators import preference as R
from sftframe.options import PreferenceOptions

PAD = 0


def pairs(spark, *triples):
    return spark.createDataFrame(
        [(p, 100 + p, *t) for p, t in enumerate(triples)],
        "p BIGINT, pair_id BIGINT, prompt_ids ARRAY<INT>, chosen_ids ARRAY<INT>, rejected_ids ARRAY<INT>",
    )


def of_side(df, side="chosen"):
    return df.where(F.col("side") == side).orderBy("p")


def test_batch_is_padded_left_and_right(spark):
    made = R.concat_inputs(pairs(spark, ([1, 2], [3, 4, 5], [6]), ([7], [8], [9, 10])), PAD, PreferenceOptions())
    assert rows(made.orderBy("p", "side").drop("batch", "pair_id")) == [
        (0, "chosen", [1, 2], [1, 1], [3, 4, 5], [1, 1, 1]),
        (0, "rejected", [1, 2], [1, 1], [6, 0, 0], [1, 0, 0]),
        (1, "chosen", [0, 7], [0, 1], [8, 0, 0], [1, 0, 0]),
        (1, "rejected", [0, 7], [0, 1], [9, 10, 0], [1, 1, 0]),
    ]


def test_sequences_start_at_the_left_and_share_a_width(spark):
    made = R.sequences(pairs(spark, ([1, 2], [3, 4], [6]), ([7], [8], [9, 10])), PAD, PreferenceOptions())
    made = made.orderBy("p", "side").select("input_ids", "attention_mask", "loss_mask")
    assert rows(made) == [
        ([1, 2, 3, 4], [1, 1, 1, 1], [0, 0, 1, 1]),
        ([1, 2, 6, 0], [1, 1, 1, 0], [0, 0, 1, 0]),
        ([7, 8, 0, 0], [1, 1, 0, 0], [0, 1, 0, 0]),
        ([7, 9, 10, 0], [1, 1, 1, 0], [0, 1, 1, 0]),
    ]


@pytest.mark.parametrize(
    "mode, ids, labels, mask, length",
    [
        ("keep_end", [4, 5, 6], [5, 6, 4], [1, 1, 1], 3),
        ("keep_start", [1, 2, 3], [2, 3, 1], [0, 1, 0], 1),
    ],
)
def test_truncation(spark, mode, ids, labels, mask, length):
    opts = PreferenceOptions(max_length=3, truncation_mode=mode)
    made = R.sequences(pairs(spark, ([1, 2], [3, 4, 5, 6], [3, 4, 5, 6])), PAD, opts)
    row = of_side(R.completion_lengths(R.next_token_labels(made))).first()
    assert (row["input_ids"], row["labels"], row["loss_mask"], row["completion_length"]) == (ids, labels, mask, length)


def test_only_long_rows_are_cut(spark):
    opts = PreferenceOptions(max_length=4, truncation_mode="keep_end")
    made = of_side(R.sequences(pairs(spark, ([1, 2], [3, 4, 5], [3]), ([7], [8], [9])), PAD, opts))
    assert rows(made.select("input_ids", "attention_mask")) == [([2, 3, 4, 5], [1, 1, 1, 1]), ([7, 8, 0, 0], [1, 1, 0, 0])]


def test_flush_of_masks_with_empty_rows(spark):
    df = spark.createDataFrame(
        [(0, [0, 1, 1, 0], [9, 1, 2, 9], [0, 0, 1, 0]), (0, [0, 0, 0, 0], [9, 9, 9, 9], [0, 0, 0, 0])],
        "batch BIGINT, attention_mask ARRAY<INT>, input_ids ARRAY<INT>, loss_mask ARRAY<INT>",
    )
    left = sorted(rows(R.flush_left(df).select("attention_mask", "input_ids")))
    right = sorted(rows(R.flush_right(df).select("attention_mask", "input_ids")))
    assert left == [([0, 0], [9, 9]), ([1, 1], [1, 2])]
    assert right == [([0, 0], [9, 9]), ([1, 1], [1, 2])]


@pytest.mark.parametrize("limit", [None, 1, 2, 4, 6, 50])
@pytest.mark.parametrize("mode", ["keep_start", "keep_end"])
def test_padding_first_gives_the_same_sequences(spark, limit, mode):
    table = pairs(spark, ([1, 2], [3, 4, 5], [3]), ([7], [8], [9, 10, 11, 12, 13]), ([], [1], [2, 2]), ([5] * 6, [4], [1]))
    opts = PreferenceOptions(max_length=limit, truncation_mode=mode, batch_size=2)
    columns = ["batch", "p", "side", "attention_mask", "input_ids", "loss_mask"]
    direct = sorted(rows(R.sequences(table, PAD, opts).select(columns)))
    assert direct == sorted(rows(R.sequences_from_padded(table, PAD, opts).select(columns)))


@pytest.mark.parametrize("options", [{"truncation_mode": "middle"}, {"strategy": "other"}, {"nll_mask": "x"}])
def test_unknown_options_are_refused(options):
    with pytest.raises(ValueError):
        PreferenceOptions(**options)


def test_logits_to_keep(spark):
    made = R.logits_to_keep(R.sequences(pairs(spark, ([1, 2], [3, 4], [6]), ([7], [8], [9])), PAD, PreferenceOptions()))
    assert {r["logits_to_keep"] for r in made.collect()} == {4}
    kept = R.keep_trailing(R.next_token_labels(made))
    assert of_side(kept).first()["labels"] == [2, 3, 4, 1]


def test_align_keeps_the_trailing_part(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [9, 9])], "a ARRAY<INT>, b ARRAY<INT>")
    assert df.select(R.align_to(F.col("a"), F.col("b"))).first()[0] == [3, 4]
    assert df.select(R.align_to(F.col("b"), F.col("a"))).first()[0] == [9, 9]


def test_pack_and_unpack(spark):
    made = R.sequences(pairs(spark, ([1, 2], [3, 4], [6]), ([7], [8], [9, 10])), PAD, PreferenceOptions())
    packed = R.pack(made)
    row = packed.first()
    assert row["sides"] == ["chosen", "chosen", "rejected", "rejected"]
    assert row["input_ids"] == [1, 2, 3, 4, 7, 8, 1, 2, 6, 7, 9, 10]
    assert row["position_ids"] == [0, 1, 2, 3, 0, 1, 0, 1, 2, 0, 1, 2]
    back = rows(R.unpack(packed).orderBy("p", "side").select("p", "side", "input_ids"))
    assert back == [(0, "chosen", [1, 2, 3, 4]), (0, "rejected", [1, 2, 6]), (1, "chosen", [7, 8]), (1, "rejected", [7, 9, 10])]


def test_encoder_decoder_labels(spark):
    made = R.concat_inputs(pairs(spark, ([1], [3, 4], [6])), PAD, PreferenceOptions())
    assert rows(R.encoder_decoder_labels(made).orderBy("side").select("labels")) == [([3, 4],), ([6, -100],)]


def test_one_shuffle_for_a_batch(spark):
    opts = PreferenceOptions(max_length=3)
    made = R.sequences(pairs(spark, ([1, 2], [3, 4, 5, 6], [3])), PAD, opts)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_rotation(spark):
    df = spark.createDataFrame([([1, 2, 3, 4],), ([],)], "x ARRAY<INT>")
    left = df.select(A.rotate_left(F.col("x"), F.least(F.lit(1), F.size("x"))))
    assert rows(left) == [([2, 3, 4, 1],), ([],)]
    assert rows(df.select(A.roll_back(F.col("x")))) == [([2, 3, 4, 1],), ([],)]
    assert rows(df.select(A.tail(F.col("x"), 9))) == [([1, 2, 3, 4],), ([],)]
