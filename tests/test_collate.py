import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.operators import collate as C
from sftframe.operators.vocab import Specials
from sftframe.options import SftOptions

SPECIALS = Specials(unk_id=97, eos_id=98, pad_id=99, ignore_id=-100, vocab_size=100, pad_is_added=True)


def collated(spark, ids, prompts=None, **options):
    prompts = prompts or [0] * len(ids)
    width = max(len(i) for i in ids)
    plan = spark.createDataFrame(
        [("train", 0, 0, 0, k, k, width) for k in range(len(ids))],
        "split STRING, epoch INT, rank INT, batch BIGINT, slot INT, pair_id BIGINT, width INT",
    )
    prepared = spark.createDataFrame(
        [(k, n, i) for k, (i, n) in enumerate(zip(ids, prompts))],
        "pair_id BIGINT, n_prompt INT, input_ids ARRAY<INT>",
    )
    made = C.collate(plan, prepared, SPECIALS, SftOptions(**options)).orderBy("slot")
    return made, rows(made.select("inputs", "labels"))


def test_one_pad_is_left_alone(spark):
    _, made = collated(spark, [[5, 6, 7], [5, 6]])
    assert made == [([5, 6, 7], [5, 6, 7]), ([5, 6, 99], [5, 6, 99])]


def test_one_pad_is_masked_on_request(spark):
    _, made = collated(spark, [[5, 6, 7], [5, 6]], min_pads_to_mask=1)
    assert made[1] == ([5, 6, 99], [5, 6, -100])


def test_two_pads_are_masked(spark):
    _, made = collated(spark, [[5, 6, 7, 8], [5, 6]])
    assert made[1] == ([5, 6, 99, 99], [5, 6, -100, -100])


def test_shift(spark):
    _, made = collated(spark, [[5, 6, 7, 8], [5, 6]], shift_labels=True)
    assert made == [([5, 6, 7], [6, 7, 8]), ([5, 6, 99], [6, -100, -100])]


def test_shift_with_one_pad(spark):
    _, made = collated(spark, [[5, 6, 7], [5, 6]], shift_labels=True)
    assert made == [([5, 6], [6, 7]), ([5, 6], [6, 99])]


@pytest.mark.parametrize(
    "options, labels",
    [
        ({}, [-100, -100, 7, 8]),
        ({"shift_labels": True}, [-100, -100, 8]),
        ({"shift_labels": True, "align_shifted_mask": True}, [-100, 7, 8]),
    ],
)
def test_instruction_mask(spark, options, labels):
    _, made = collated(spark, [[5, 6, 7, 8]], [2], mask_instruction=True, **options)
    assert made[0][1] == labels


def test_mask_longer_than_the_row(spark):
    _, made = collated(spark, [[5, 6]], [5], mask_instruction=True)
    assert made == [([5, 6], [-100, -100])]


def test_no_marker_no_mask(spark):
    _, made = collated(spark, [[5, 6, 7]], [0], mask_instruction=True)
    assert made == [([5, 6, 7], [5, 6, 7])]


def test_stack_keeps_the_order_of_the_batch(spark):
    made, _ = collated(spark, [[5, 6, 7], [8], [9, 1]])
    batch = C.stack(made.orderBy(F.desc("slot"))).first()
    assert batch["inputs"] == [[5, 6, 7], [8, 99, 99], [9, 1, 99]]
    assert batch["labels"] == [[5, 6, 7], [8, -100, -100], [9, 1, 99]]


def test_ignored_labels_are_shown_as_padding(spark):
    vocab = spark.createDataFrame([("a", 5, False), ("b", 6, False), ("[PAD]", 99, True)], "token STRING, id INT, special BOOLEAN")
    made, _ = collated(spark, [[5, 6, 5], [6]])
    shown = rows(C.readable(made, vocab, SPECIALS).orderBy("slot").select("input_text", "label_text"))
    assert shown == [("aba", "aba"), ("b[PAD][PAD]", "b[PAD][PAD]")]
