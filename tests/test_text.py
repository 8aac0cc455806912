import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.functions import text as X
from sftframe.operators import prepare as P
from sftframe.options import SftOptions


def pieces(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    return [r[0] for r in df.select(X.pre_tokens(F.col("t"))).collect()]


def test_templates_differ_by_one_space(spark):
    df = spark.createDataFrame([("Add.", "Done")], "i STRING, r STRING")
    made = df.select(
        *[X.format_full_text(F.col("i"), F.col("r"), v) for v in ("v1", "v2")], X.format_prompt(F.col("i"))
    ).first()
    system = "Below is an instruction that describes a task. Write a response that completes the request."
    body = "\n\n###Instruction:\nAdd.\n\n###Response:\n"
    assert made[0] == system + body + "Done<|endoftext|>"
    assert made[1] == system + " " + body + "Done<|endoftext|>"
    assert made[2] == system + body


@pytest.mark.parametrize("row, named", [((None, "x"), "instruction is null"), (("x", None), "response is null")])
def test_null_text_fails_the_job(spark, row, named):
    df = spark.createDataFrame([(1, *row)], "pair_id BIGINT, instruction STRING, response STRING")
    with pytest.raises(Exception, match=named):
        P.formatted(df, SftOptions()).collect()


def test_eos_stays_one_piece(spark):
    assert pieces(spark, "end.<|endoftext|>") == [["end", ".", "<|endoftext|>"]]


def test_pieces_put_together_are_the_text(spark):
    rng = random.Random(3)
    alphabet = "aéß中 \n\t.,!1234½<|>#:'\"-_€😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(300)]
    assert ["".join(p) for p in pieces(spark, *texts)] == texts


def test_instruction_part_ends_at_the_first_marker(spark):
    texts = ["no marker", "a###Response:\nb###Response:\nc", "###Response:\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in rows(df.select(X.instruction_part(F.col("t"))))] == ["", "a###Response:\n", "###Response:\n"]


def test_row_of_exactly_the_limit_is_dropped(spark):
    df = spark.createDataFrame([(3,), (4,), (5,)], "n_tokens INT")
    assert rows(P.within_context(df, 4)) == [(3,)]


def test_text_is_split_once_below_a_length_filter(spark):
    pairs = spark.createDataFrame([(1, "a", "b")], "pair_id BIGINT, instruction STRING, response STRING")
    kept = P.within_context(P.tokenised(pairs, SftOptions()), 100).select("pair_id", "n_tokens")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_eos_inside_a_text(spark):
    text = "a.<|endoftext|> <|endoftext|><|x|><|endoftext|>b"
    eos = "<|endoftext|>"
    assert pieces(spark, text) == [["a", ".", eos, " ", eos, "<|", "x", "|>", eos, "b"]]
