"""Inputs of the registered queries, from the tables of one folder.

Prepared tables are looked up once per session.
"""

from __future__ import annotations

import functools
import uuid
from dataclasses import asdict
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftframe.operators import prepare as P
from sftframe.operators import subword as B
from sftframe.operators import vocab as V
from sftframe.operators.preference import encode_pairs
from sftframe.options import PHASES, LogOptions, PreferenceOptions, SftOptions
from sftframe.plans import epochs, permuted
from sftframe.session import shared_folder
from sftframe.sources import adapters
from sftframe.sources.cache import reuse
from sftframe.sources.tables import instruction_table, read_table, spread

SFT = SftOptions(test_split=Decimal("0.2"), world_size=4, batch_size=8, num_epochs=3)
SINGLE = SftOptions(test_split=Decimal("0.2"), single_process=True, batch_size=8, num_epochs=3)
#: Limits of the queries whose feature is a limit.
CONTEXT, TOP_TOKENS = 256, 8192
#: Size of the subword vocabulary of the queries, beyond bytes and special tokens.
MERGES = 48
PREF = PreferenceOptions(batch_size=8)
PHASE_LOG = LogOptions(log_freq=5, checkp_freq=30, batch_size=8, max_length=256, world_size=4, batches=25, num_epochs=4)
LOG = LogOptions(log_freq=20, checkp_freq=30, batch_size=8, max_length=256, world_size=4, batches=25, num_epochs=4)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instruction_table(adapters.conversation_pairs(table(spark, sf_dir, "conversations")), SFT)


def _reused(spark, sf_dir, name, tables, build, options=None) -> DataFrame:
    paths = [f"{sf_dir}/{t}.parquet" for t in tables]
    return reuse(spark, name, paths, asdict(options) if options else {}, build)


@functools.cache
def kept_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs, written once: jobs that read them more than once do not repeat the join."""
    return _reused(spark, sf_dir, "pairs", ["conversations"], lambda: pairs(spark, sf_dir))


@functools.cache
def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reused(
        spark,
        sf_dir,
        "vocab",
        ["conversations"],
        lambda: V.build_vocab(P.tokenised(kept_pairs(spark, sf_dir), SFT), "tokens", SFT.vocab_size),
        SFT,
    )


@functools.cache
def merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merges trained on the pre-tokens of all formatted pairs; EOS is no word."""

    def build():
        words = V.token_counts(P.tokenised(kept_pairs(spark, sf_dir), SFT), "tokens")
        return B.train(words.where(F.col("token") != SFT.eos_token), MERGES)

    return _reused(spark, sf_dir, f"merges-{MERGES}", ["conversations"], build, SFT)


@functools.cache
def specials(spark: SparkSession, sf_dir: str) -> V.Specials:
    return V.special_ids(vocab(spark, sf_dir))


@functools.cache
def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reused(
        spark,
        sf_dir,
        "prepared",
        ["conversations"],
        lambda: P.prepare(kept_pairs(spark, sf_dir), vocab(spark, sf_dir), SFT),
        SFT,
    )


@functools.cache
def split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pair_id, n_tokens, split``: made once, as every plan reads it more than once."""
    rows = prepared(spark, sf_dir).select("pair_id", "n_tokens")
    return _reused(spark, sf_dir, "split", ["conversations"], lambda: epochs.assign_split(rows, SFT), SFT)


@functools.cache
def numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split rows with their numbers, made once for all epochs."""
    return _reused(spark, sf_dir, "numbered", ["conversations"], lambda: permuted.numbered(split_rows(spark, sf_dir)), SFT)


def plan(spark: SparkSession, sf_dir: str, opts: SftOptions = SFT) -> DataFrame:
    return epochs.epoch_plan(split_rows(spark, sf_dir), opts)


@functools.cache
def prefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``p, pair_id, prompt, chosen, rejected``."""
    return _reused(
        spark,
        sf_dir,
        "prefs",
        ["conversations"],
        lambda: adapters.preference_pairs(kept_pairs(spark, sf_dir), PREF.seed),
        PREF,
    )


def pref_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pairs(prefs(spark, sf_dir), vocab(spark, sf_dir), specials(spark, sf_dir))


@functools.cache
def unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token scores that stand in for a policy and a reference model."""

    every = documents(spark, sf_dir).select(F.coalesce("text", F.lit("")).alias("text"))
    responses = kept_pairs(spark, sf_dir).select(F.col("response").alias("text"))
    policy = _reused(
        spark, sf_dir, "policy-counts", ["conversations"], lambda: adapters.text_token_counts(responses)
    )
    reference = _reused(
        spark, sf_dir, "reference-counts", ["documents"], lambda: adapters.text_token_counts(every)
    )
    return _reused(
        spark,
        sf_dir,
        "unigrams",
        ["conversations", "documents"],
        lambda: adapters.unigram_scores(policy, reference),
    )


def scored_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with arrays of token log-probabilities, and the batch that a pair is in."""
    scored = adapters.score_pairs(prefs(spark, sf_dir), unigrams(spark, sf_dir))
    return scored.withColumn("batch", F.floor(F.col("p") / PREF.batch_size))


def logits(spark: SparkSession, sf_dir: str, scale: float = 10.0) -> DataFrame:
    return adapters.embedding_logits(table(spark, sf_dir, "embeddings"), scale)


@functools.cache
def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reused(
        spark, sf_dir, "steps", ["events"], lambda: adapters.event_steps(table(spark, sf_dir, "events"))
    )


def phase_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as steps of four phases each; the loss stands at the first phase of a step."""
    events = steps(spark, sf_dir).withColumn("_at", F.col("global_step") - 1)
    phase = F.element_at(F.array(*[F.lit(p) for p in PHASES]), (F.pmod("_at", F.lit(4)) + 1).cast("int"))
    return events.select(
        "run_id",
        (F.floor(F.col("_at") / 4) + 1).alias("global_step"),
        phase.alias("phase"),
        "elapsed_s",
        "ok",
        F.when(F.pmod("_at", F.lit(4)) == 0, F.col("loss")).alias("loss"),
    )


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
