"""Responses of models to a table of prompts, side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftframe.functions import text as X
from sftframe.operators.prepare import decode
from sftframe.session import ship_package

# The instructions that a training run is checked with.
EVALUATION_INSTRUCTIONS = (
    "Research and summarize the common practices for caring of rabbits.",
    "Generate a list of 5 books that discuss the theme of resilience",
    "Identify the key characters of the novel 'The Hobbit'",
    "Write a function which reverses the order of words in a sentence.",
    "Generate a list of five advantages of using a certain product.",
)


def default_prompts(spark: SparkSession) -> DataFrame:
    """``prompt_id`` from 1, ``instruction``."""
    rows = list(enumerate(EVALUATION_INSTRUCTIONS, start=1))
    return spark.createDataFrame(rows, "prompt_id BIGINT, instruction STRING")


def prompts(instructions: DataFrame, template: str = "v1") -> DataFrame:
    """Add the formatted ``prompt`` to ``prompt_id, instruction``."""
    return instructions.withColumn("prompt", X.format_prompt(F.col("instruction"), template))


def respond(prompt_table: DataFrame, model: str, make_model: Callable[[], Callable[[pd.Series], pd.Series]]) -> DataFrame:
    """``prompt_id, model, response``: batch inference with any function from prompts to responses.

    ``make_model`` runs once per task, so a large model is loaded once and not per batch.
    """

    ship_package(prompt_table.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = make_model()
        for frame in frames:
            yield pd.DataFrame({"prompt_id": frame["prompt_id"], "model": model, "response": answer(frame["prompt"])})

    asked = prompt_table.select("prompt_id", "prompt")
    return asked.mapInPandas(run, f"prompt_id {dict(asked.dtypes)['prompt_id']}, model STRING, response STRING")


def cut_response(generated: DataFrame, vocab: DataFrame, skip_special: bool = True) -> DataFrame:
    """Add ``response``: the text of ``output_ids`` after the first ``n_prompt`` ids."""
    rest = F.slice("output_ids", F.col("n_prompt") + 1, F.greatest(F.size("output_ids") - F.col("n_prompt"), F.lit(0)))
    cut = generated.withColumn("_response_ids", rest)
    return decode(cut, {"_response_ids": "response"}, vocab, skip_special).drop("_response_ids")


def compare(prompt_table: DataFrame, tuned: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """``prompt_id, instruction, base_response, tuned_response``; without a base model its column is null."""
    responses = tuned.withColumn("model", F.lit("tuned"))
    if base is not None:
        responses = responses.unionByName(base.withColumn("model", F.lit("base")))
    per_prompt = responses.groupBy("prompt_id").agg(
        F.max(F.when(F.col("model") == "base", F.col("response"))).alias("base_response"),
        F.max(F.when(F.col("model") == "tuned", F.col("response"))).alias("tuned_response"),
    )
    return prompt_table.select("prompt_id", "instruction").join(per_prompt, "prompt_id", "left")

