"""Choice of the next token from rows of scores, and generation with a model of the user's."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.functions import arrays as A
from sftframe.functions.numeric import let, softmax
from sftframe.options import DecodeOptions
from sftframe.session import ship_package

# -- a row holds all scores of one step of one request: nothing is shuffled ----------------------------------------


def crop(ids: Column, context_size: int) -> Column:
    """The last ``context_size`` ids."""
    return A.tail(ids, context_size)


def repetition_penalty(logits: Column, history: Column, penalty: float) -> Column:
    """Make the scores of tokens that were already used less likely.  The work is the scores plus the history."""

    @F.arrow_udf("array<double>")
    def penalised(scores: pa.Array, used: pa.Array) -> pa.Array:
        starts = scores.offsets.to_numpy() - scores.offsets[0].as_py()
        flat = scores.flatten().to_numpy(zero_copy_only=False).copy()
        row = np.repeat(np.arange(len(used)), np.nan_to_num(used.value_lengths().to_numpy(zero_copy_only=False)).astype(int))
        token = used.flatten().to_numpy(zero_copy_only=False)
        known = (token >= 0) & (token < np.diff(starts)[row])
        at = np.unique(starts[row[known]] + token[known].astype(np.int64))
        flat[at] = np.where(flat[at] > 0, flat[at] / penalty, flat[at] * penalty)
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat), mask=scores.is_null() if scores.null_count else None)

    return penalised(logits.cast("array<double>"), history.cast("array<bigint>"))


def top_k(logits: Column, k: int) -> Column:
    """Scores below the k-th largest become minus infinity; ties with it stay."""

    def limited(x: Column) -> Column:
        kth = F.get(F.sort_array(x, asc=False), F.least(F.lit(k), F.size(x)) - 1)
        return let(kth, lambda low: F.transform(x, lambda v: F.when(v < low, F.lit(float("-inf"))).otherwise(v)))

    return let(logits, limited)


def probabilities(logits: Column, temperature: float) -> Column:
    return softmax(F.transform(logits, lambda v: v / temperature))


def greedy(logits: Column) -> Column:
    """The token with the largest score; of equal ones the lowest id."""
    return let(logits, lambda x: (F.array_position(x, F.array_max(x)) - 1).cast("int"))


def uniform(seed: Column, *parts: Column) -> Column:
    """Repeatable number in (0, 1) from 52 bits of a hash."""
    digits = F.substring(F.md5(F.concat_ws("|", seed, *[p.cast("string") for p in parts])), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)


def sample(logits: Column, temperature: float, seed: int, *request: Column) -> Column:
    """Draw one token: the largest of ``logit / T + g`` with Gumbel noise ``g`` follows the softmax of ``logit / T``."""

    def noisy(v: Column, token: Column) -> Column:
        drawn = v / temperature - F.log(-F.log(uniform(F.lit(str(seed)), *request, token)))
        return F.when(v == float("-inf"), v).otherwise(drawn)

    return greedy(F.transform(logits, noisy))


def next_token(logits: Column, opts: DecodeOptions, *request: Column, history: Column | None = None) -> Column:
    """All rules in the order in which a generation step applies them."""
    if opts.repetition_penalty != 1.0 and history is not None:
        logits = repetition_penalty(logits, history, opts.repetition_penalty)
    if opts.top_k is not None:
        logits = top_k(logits, opts.top_k)
    if opts.temperature > 0:
        return sample(logits, opts.temperature, opts.seed, *request)
    return greedy(logits)


# -- long tables: a row per token -----------------------------------------------------------------------------------


def to_dense(scores: DataFrame, step: list[str], logit: str = "logit") -> DataFrame:
    """``step, logits`` from ``step, token_id, logit``; a group is the vocabulary of one step."""
    entries = F.array_sort(F.collect_list(F.struct("token_id", logit)))
    return scores.groupBy(*step).agg(entries.alias("_entries")).select(
        *step, F.col(f"_entries.{logit}").alias("logits")
    )


def long_top_k(scores: DataFrame, step: list[str], k: int) -> DataFrame:
    """Rows whose score is among the ``k`` largest of the step, ties included."""
    place = F.rank().over(Window.partitionBy(*step).orderBy(F.desc("logit")))
    return scores.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def long_greedy(scores: DataFrame, step: list[str]) -> DataFrame:
    """``step, token_id`` of the largest score; map-side aggregation, one row per step and task is shuffled."""
    best = F.max_by("token_id", F.struct("logit", -F.col("token_id")))
    return scores.groupBy(*step).agg(best.alias("token_id"))


def long_repetition_penalty(scores: DataFrame, history: DataFrame, step: list[str], penalty: float) -> DataFrame:
    """The penalty for scores as rows; ``history`` lists ``step, token_id`` of the tokens used before."""
    used = history.select(*step, "token_id").distinct().withColumn("_used", F.lit(True))
    logit = F.col("logit")
    lowered = F.when(logit > 0, logit / penalty).otherwise(logit * penalty)
    return (
        scores.join(used, [*step, "token_id"], "left")
        .withColumn("logit", F.when(F.col("_used"), lowered).otherwise(logit))
        .drop("_used")
    )


# -- generation -----------------------------------------------------------------------------------------------------

Scorer = Callable[[list[list[int]]], np.ndarray]


def _uniform(*parts: object) -> float:
    """The number that ``uniform`` gives for the same parts."""
    digits = hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13]
    return (int(digits, 16) + 0.5) / 2**52


def _choose(scores: np.ndarray, used: list[list[int]], draws: list[tuple], opts: DecodeOptions) -> np.ndarray:
    if opts.repetition_penalty == 1.0 and opts.temperature <= 0:
        # The largest score is among the k largest, and the first of equal ones wins either way.
        return scores.argmax(axis=1)
    scores = scores.astype(np.float64, copy=True)
    if opts.repetition_penalty != 1.0:
        for row, ids in zip(scores, used):
            seen = np.unique(ids)
            row[seen] = np.where(row[seen] > 0, row[seen] / opts.repetition_penalty, row[seen] * opts.repetition_penalty)
    if opts.top_k is not None and opts.top_k < scores.shape[1]:
        kth = np.partition(scores, -opts.top_k, axis=1)[:, -opts.top_k]
        scores[scores < kth[:, None]] = -np.inf
    if opts.temperature > 0:
        scores /= opts.temperature
        for row, draw in zip(scores, draws):
            open_ = np.flatnonzero(np.isfinite(row))
            row[open_] -= np.log(-np.log([_uniform(*draw, token) for token in open_]))
    return scores.argmax(axis=1)


def _continue(
    prompts: list[list[int]], requests: list, scorer: Scorer, eos_id: int, opts: DecodeOptions
) -> list[list[int]]:
    whole = [list(ids) for ids in prompts]
    active = list(range(len(prompts)))
    for step in range(opts.max_new_tokens):
        if not active:
            break
        used = [whole[i] for i in active]
        draws = [(opts.seed, requests[i], step) for i in active]
        chosen = _choose(np.asarray(scorer([ids[-opts.context_size :] for ids in used])), used, draws, opts)
        going = {i: int(token) for i, token in zip(active, chosen) if token != eos_id}
        for i, token in going.items():
            whole[i].append(token)
        active = list(going)
    return [ids[len(prompt) :] for ids, prompt in zip(whole, prompts)]


def generate(requests: DataFrame, make_scorer: Callable[[], Scorer], eos_id: int, opts: DecodeOptions) -> DataFrame:
    """Add ``new_ids``: the tokens that a model appends to ``ids`` of ``request_id`` until EOS or the cap.

    ``make_scorer`` runs once per task and returns the model: a function from contexts to an array of scores
    (context, token) of any number type; greedy choices do not copy it.  Every request stops on its own; EOS is not appended.  New tokens are kept apart from the
    prompt, so cropping the context loses none of them.  Requests stay in their partitions, and a draw depends only
    on the seed, the request and the step, so a task that runs again gives the same tokens.
    """
    ship_package(requests.sparkSession)
    schema = T.StructType([*requests.schema.fields, T.StructField("new_ids", T.ArrayType(T.IntegerType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for frame in frames:
            for start in range(0, len(frame), opts.request_batch):
                part = frame.iloc[start : start + opts.request_batch]
                prompts = [list(ids) for ids in part["ids"]]
                yield part.assign(new_ids=_continue(prompts, list(part["request_id"]), scorer, eos_id, opts))

    return requests.mapInPandas(run, schema)
