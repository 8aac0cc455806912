"""Views of general tables (conversations, documents, embeddings, events) as inputs of the jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftframe.functions import text as X
from sftframe.functions.arrays import once
from sftframe.operators.lookup import lookup_arrays
from sftframe.operators.vocab import token_counts
from sftframe.plans.index import bucket_digits, hashed_positions, ranged_positions, seeded_key


def conversation_pairs(conversations: DataFrame) -> DataFrame:
    """``pair_id, instruction, response``: a user turn and the assistant turn that follows it.

    Turns of a conversation are numbered without gaps, so the reply is the row with the next number.  The join key
    (conversation, turn) is unique; a very long conversation spreads over all tasks.  A pair is named by the
    conversation and the turn, with a hyphen between them.
    """
    asked = conversations.where(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("reply_turn"), F.col("text").alias("instruction")
    )
    replies = conversations.where(F.col("role") == "assistant").select(
        "conv_id", F.col("turn").alias("reply_turn"), F.col("text").alias("response")
    )
    named = F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("reply_turn") - 1).cast("string"))
    return asked.join(replies, ["conv_id", "reply_turn"]).select(named.alias("pair_id"), "instruction", "response")


def document_pairs(documents: DataFrame) -> DataFrame:
    """``pair_id, instruction, response``: first line and the text after it; a text of one line has an empty response."""
    text = F.coalesce("text", F.lit(""))
    at = F.instr(text, F.lit("\n"))
    return documents.select(
        F.col("doc_id").alias("pair_id"),
        F.when(at > 0, F.substr(text, F.lit(1), at - 1)).otherwise(text).alias("instruction"),
        F.when(at > 0, F.substr(text, at + 1)).otherwise("").alias("response"),
    )


def preference_pairs(pairs: DataFrame, seed: int = 42) -> DataFrame:
    """``p, pair_id, prompt, chosen, rejected``: the rejected text is the response of the next pair in a seeded order.

    The last pair takes the first one's.  The order is made from ids alone; each text is shuffled once per side.
    """
    ids = pairs.select("pair_id")
    key = seeded_key(F.lit(seed), F.lit(0), F.col("pair_id"))
    placed = hashed_positions(ids, key, "pair_id", [], bucket_digits(ids.count()))
    after = placed.select(F.pmod(F.col("p") - 1, F.col("n")).alias("p"), F.col("pair_id").alias("_next_id"))
    neighbours = placed.select("p", "pair_id").join(after, "p")
    asked = pairs.select("pair_id", F.col("instruction").alias("prompt"), F.col("response").alias("chosen"))
    others = pairs.select(F.col("pair_id").alias("_next_id"), F.col("response").alias("rejected"))
    joined = neighbours.join(asked, "pair_id").join(others, "_next_id")
    return joined.select("p", "pair_id", "prompt", "chosen", "rejected")


def text_token_counts(texts: DataFrame) -> DataFrame:
    """``token, n`` of a ``text`` column."""
    return token_counts(texts.select(once(X.pre_tokens(F.col("text"))).alias("tokens")), "tokens")


def unigram_scores(policy_counts: DataFrame, reference_counts: DataFrame) -> DataFrame:
    """``token, policy, reference``: add-one unigram log-probabilities of every token that the policy has counted."""

    def mass(counts: DataFrame) -> int:
        row = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).first()
        return (row["tokens"] or 0) + row["types"]

    policy_mass, reference_mass = mass(policy_counts), mass(reference_counts)
    joined = policy_counts.join(reference_counts.withColumnRenamed("n", "n_ref"), "token", "left")
    return joined.select(
        "token",
        F.log((F.col("n") + 1) / policy_mass).alias("policy"),
        F.log((F.coalesce("n_ref", F.lit(0)) + 1) / reference_mass).alias("reference"),
    )


def score_pairs(prefs: DataFrame, scores: DataFrame) -> DataFrame:
    """``p, pair_id`` and four arrays of token log-probabilities: policy and reference for chosen and rejected."""
    cut = prefs.select(
        "p",
        "pair_id",
        X.pre_tokens(F.col("chosen")).alias("_chosen"),
        X.pre_tokens(F.col("rejected")).alias("_rejected"),
    )
    wanted = [
        ("_chosen", "policy", "chosen_logps", None),
        ("_rejected", "policy", "rejected_logps", None),
        ("_chosen", "reference", "ref_chosen_logps", None),
        ("_rejected", "reference", "ref_rejected_logps", None),
    ]
    return lookup_arrays(cut, scores, "token", wanted).drop("_chosen", "_rejected")


def embedding_logits(embeddings: DataFrame, scale: float = 10.0) -> DataFrame:
    """``request_id, logits, label_id``: the place in the vector is the token, ``scale * value`` its score."""
    return embeddings.select(
        F.col("vec_id").alias("request_id"),
        F.transform("embedding", lambda v: v.cast("double") * scale).alias("logits"),
        F.col("label").alias("label_id"),
    )


# Event kinds that stand for timed phases; an error event is a phase that failed.
EVENT_PHASES = {"view": "forward", "click": "backward", "purchase": "build_batch", "signup": "optimizer_step"}


def event_steps(events: DataFrame) -> DataFrame:
    """``run_id, global_step, phase, elapsed_s, ok, loss``: the events of a user in time order are the steps of a run."""
    narrow = events.select(F.col("user_id").alias("run_id"), "ts", "event_id", "event_type", "value")
    ordered = ranged_positions(narrow, "run_id", ["ts", "event_id"], "_at")
    phase = F.coalesce(*[F.when(F.col("event_type") == kind, name) for kind, name in EVENT_PHASES.items()])
    return ordered.select(
        "run_id",
        (F.col("_at") + 1).alias("global_step"),
        phase.alias("phase"),
        F.col("value").alias("elapsed_s"),
        (F.col("event_type") != "error").alias("ok"),
        F.col("value").alias("loss"),
    )
