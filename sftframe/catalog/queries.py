"""Registered queries: name -> function of (spark, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.catalog import inputs as I
from sftframe.functions import arrays as A
from sftframe.functions import text as X
from sftframe.operators import chains
from sftframe.operators import collate as C
from sftframe.operators import compare as M
from sftframe.operators import decoding as G
from sftframe.operators import dpo as D
from sftframe.operators import exact
from sftframe.operators import preference as R
from sftframe.operators import prepare as P
from sftframe.operators import streamed
from sftframe.operators import subword as B
from sftframe.operators import telemetry as H
from sftframe.operators import vocab as V
from sftframe.options import DecodeOptions, PreferenceOptions, SftOptions, resolve_max_length
from sftframe.plans import epochs, permuted
from sftframe.sources import adapters, datasets, shards
from sftframe.sources.tables import instruction_table, named_turn, preference_table, read_table
from sftframe.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(*names: str) -> list[Column]:
    """Doubles to four places, without negative zeros."""
    return [(F.round(name, 4) + F.lit(0.0)).alias(name) for name in names]


def texts(*names: str) -> list[Column]:
    return [A.as_text(F.col(name)).alias(name) for name in names]


# -- instruction rows -----------------------------------------------------------------------------------------------


@query
def sft_pairs(spark, sf_dir):
    return I.pairs(spark, sf_dir)


@query
def source_formats(spark, sf_dir):
    """The pairs, written in the other formats with the columns in another order, and read back by column name."""
    folder = I.new_folder(spark, "formats")
    pairs = I.kept_pairs(spark, sf_dir)
    read = []
    for fmt in ("csv", "json", "orc"):
        turned = pairs.select("response", "pair_id", "instruction").write
        writer = turned.option("header", True).option("escape", '"') if fmt == "csv" else turned
        writer.format(fmt).save(f"{folder}/{fmt}")
        table = instruction_table(read_table(spark, f"{folder}/{fmt}", fmt, pairs.schema, multi_line=True), I.SFT)
        read.append(table.select(F.lit(fmt).alias("format"), "*"))
    return read[0].unionByName(read[1]).unionByName(read[2])


@query
def sft_format(spark, sf_dir):
    pairs = I.pairs(spark, sf_dir)
    text = {v: X.format_full_text(F.col("instruction"), F.col("response"), v) for v in ("v1", "v2")}
    return pairs.select("pair_id", text["v1"].alias("text_v1"), text["v2"].alias("text_v2"))


@query
def sft_prompt(spark, sf_dir):
    instructions = I.pairs(spark, sf_dir).select(F.col("pair_id").alias("prompt_id"), "instruction")
    return M.prompts(instructions).select("prompt_id", "prompt")


@query
def token_stats(spark, sf_dir):
    tokens = P.tokenised(I.pairs(spark, sf_dir), I.SFT)
    return tokens.agg(
        F.count("*").alias("pairs"),
        F.sum("n_tokens").alias("tokens"),
        F.min("n_tokens").cast("bigint").alias("min_tokens"),
        F.max("n_tokens").cast("bigint").alias("max_tokens"),
        F.count(F.when(F.col("n_tokens") < I.CONTEXT, 1)).alias("within_context"),
    )


@query
def token_counts(spark, sf_dir):
    return V.token_counts(P.tokenised(I.pairs(spark, sf_dir), I.SFT), "tokens")


@query
def vocab_top(spark, sf_dir):
    return V.build_vocab(P.tokenised(I.kept_pairs(spark, sf_dir), I.SFT), "tokens", I.TOP_TOKENS)


@query
def vocab_all(spark, sf_dir):
    return I.vocab(spark, sf_dir)


@query
def vocab_specials(spark, sf_dir):
    return V.specials_table(I.vocab(spark, sf_dir))


@query
def vocab_user_table(spark, sf_dir):
    """A token list without a pad token gets one behind its last id; a list that has one is left alone."""
    own = I.vocab(spark, sf_dir).where(F.col("token") != "[PAD]").select("token", "id")
    added, is_added = V.use_vocab(own, ["<|endoftext|>", "[UNK]"])
    kept, is_added_again = V.use_vocab(added.select("token", "id"), ["<|endoftext|>", "[UNK]"])
    return kept.select("token", "id", F.lit(is_added).alias("pad_added"), F.lit(is_added_again).alias("pad_added_again"))


def _encoded(spark, sf_dir, **bound):
    tokens = P.tokenised(I.kept_pairs(spark, sf_dir), I.SFT).select("pair_id", "tokens")
    return P.encode(tokens, {"tokens": "ids"}, I.vocab(spark, sf_dir), **bound)


@query
def encode_ids(spark, sf_dir):
    return _encoded(spark, sf_dir).select("pair_id", F.size("ids").cast("bigint").alias("n_tokens"), *texts("ids"))


@query
def encode_ids_joined(spark, sf_dir):
    """The same for a vocabulary that is too large to broadcast."""
    joined = _encoded(spark, sf_dir, bound=0)
    return joined.select("pair_id", F.size("ids").cast("bigint").alias("n_tokens"), *texts("ids"))


@query
def decode_text(spark, sf_dir):
    vocab, ids = I.vocab(spark, sf_dir), I.prepared(spark, sf_dir).select("pair_id", "input_ids")
    shown = P.decode(ids, {"input_ids": "text"}, vocab)
    return P.decode(shown, {"input_ids": "plain_text"}, vocab, skip_special=True).drop("input_ids")


@query
def bpe_merges(spark, sf_dir):
    return I.merges(spark, sf_dir)


def _pieces(spark, sf_dir):
    pairs = P.formatted(I.kept_pairs(spark, sf_dir), I.SFT)
    return B.encode(pairs, {"full_text": "ids"}, I.merges(spark, sf_dir)).select("pair_id", "ids")


@query
def bpe_encode(spark, sf_dir):
    return _pieces(spark, sf_dir).select("pair_id", F.size("ids").cast("bigint").alias("n_pieces"), *texts("ids"))


@query
def bpe_decode(spark, sf_dir):
    vocab, ids = B.vocabulary(I.merges(spark, sf_dir)), _pieces(spark, sf_dir)
    shown = B.decode(ids, {"ids": "text"}, vocab)
    return B.decode(shown, {"ids": "plain_text"}, vocab, skip_special=True).drop("ids")


@query
def context_filter(spark, sf_dir):
    tokens = P.tokenised(I.pairs(spark, sf_dir), I.SFT)
    return P.within_context(tokens, I.CONTEXT).select("pair_id", F.col("n_tokens").cast("bigint").alias("n_tokens"))


@query
def context_filter_docs(spark, sf_dir):
    pairs = adapters.document_pairs(I.documents(spark, sf_dir))
    opts = SftOptions(max_length=resolve_max_length(1024, 2048, 1024))
    tokens = P.tokenised(pairs, opts)
    return P.within_context(tokens, opts.max_length).select("pair_id", F.col("n_tokens").cast("bigint").alias("n_tokens"))


@query
def prompt_length(spark, sf_dir):
    return I.prepared(spark, sf_dir).select("pair_id", "n_tokens", "n_prompt")


# -- split, epochs, shards ------------------------------------------------------------------------------------------


@query
def split(spark, sf_dir):
    return I.split_rows(spark, sf_dir).select("pair_id", "split")


@query
def split_sizes(spark, sf_dir):
    return epochs.split_sizes(I.split_rows(spark, sf_dir))


@query
def epoch_plan(spark, sf_dir):
    return I.plan(spark, sf_dir)


@query
def epoch_plan_single(spark, sf_dir):
    return I.plan(spark, sf_dir, I.SINGLE)


@query
def shard_report(spark, sf_dir):
    sizes = epochs.split_sizes(I.split_rows(spark, sf_dir))
    return epochs.shard_report(sizes, I.SFT)


@query
def batch_counts(spark, sf_dir):
    sizes = epochs.split_sizes(I.split_rows(spark, sf_dir))
    sharded = epochs.batch_counts(sizes, I.SFT).withColumnRenamed("batches", "batches_per_rank")
    single = epochs.batch_counts(sizes, I.SINGLE).select("split", F.col("batches").alias("batches_single"))
    return sharded.join(F.broadcast(single), "split")


@query
def resume_plan(spark, sf_dir):
    train = I.plan(spark, sf_dir).where(F.col("split") == "train")
    return epochs.resume_from(train, 1, 2).select("epoch", "rank", "batch", "slot", "pair_id")


# -- batches --------------------------------------------------------------------------------------------------------


def _collated(spark, sf_dir, **options):
    opts = replace(I.SFT, **options)
    return C.collate(I.plan(spark, sf_dir), I.prepared(spark, sf_dir), I.specials(spark, sf_dir), opts)


def _example_columns():
    return [*C.BATCH_KEY, "slot", "pair_id", *texts("inputs", "labels")]


@query
def collate_plain(spark, sf_dir):
    return _collated(spark, sf_dir).select(*_example_columns())


@query
def collate_shift(spark, sf_dir):
    return _collated(spark, sf_dir, shift_labels=True).select(*_example_columns())


@query
def collate_masked(spark, sf_dir):
    return _collated(spark, sf_dir, mask_instruction=True).select(*_example_columns())


@query
def collate_masked_shift(spark, sf_dir):
    return _collated(spark, sf_dir, mask_instruction=True, shift_labels=True).select(*_example_columns())


@query
def collate_batches(spark, sf_dir):
    opts = replace(I.SFT, mask_instruction=True)
    batches = C.stacked(I.plan(spark, sf_dir), I.prepared(spark, sf_dir), I.specials(spark, sf_dir), opts)

    def rows(name: str) -> Column:
        return F.array_join(F.transform(name, A.as_text), ";").alias(name)

    return batches.select(*C.BATCH_KEY, rows("inputs"), rows("labels"))


def _batch_summary(frame: pd.DataFrame) -> pd.DataFrame:
    """A collator of a user: sizes of a batch and the number of labels that count."""
    counted = sum(int((np.asarray(labels) != -100).sum()) for labels in frame["labels"])
    first = frame.iloc[0]
    return pd.DataFrame(
        {
            **{name: [first[name]] for name in C.BATCH_KEY},
            "rows": [len(frame)],
            "width": [len(first["inputs"])],
            "counted_labels": [counted],
        }
    )


@query
def collate_user_function(spark, sf_dir):
    schema = "split STRING, epoch INT, rank INT, batch BIGINT, rows BIGINT, width BIGINT, counted_labels BIGINT"
    return C.collate_with(_collated(spark, sf_dir, mask_instruction=True), _batch_summary, schema)


class _RunningSummary:
    """The same summary from rows that come one by one."""

    def __init__(self):
        self.rows = self.width = self.counted = 0

    @staticmethod
    def schema(examples):
        return T.StructType([T.StructField(name, T.LongType()) for name in ("rows", "width", "counted_labels")])

    def add(self, row):
        self.rows += 1
        self.width = max(self.width, len(row["inputs"]))
        self.counted += sum(label != -100 for label in row["labels"])
        return ()

    def finish(self):
        yield self.rows, self.width, self.counted


@query
def collate_user_stream(spark, sf_dir):
    """A collator of the user's that never holds a batch."""
    return streamed.collate_streamed(_collated(spark, sf_dir, mask_instruction=True), _RunningSummary)


@query
def sample_report(spark, sf_dir):
    opts = replace(I.SFT, mask_instruction=True)
    report = C.sample_report(
        I.plan(spark, sf_dir), I.prepared(spark, sf_dir), I.vocab(spark, sf_dir), I.specials(spark, sf_dir), opts
    )
    return report.select("rank", "pair_id", *texts("inputs", "labels"), "input_text", "label_text")


@query
def first_batch_text(spark, sf_dir):
    specials = I.specials(spark, sf_dir)
    batch = C.first_batch(I.plan(spark, sf_dir))
    examples = C.collate(batch, I.prepared(spark, sf_dir), specials, I.SFT)
    return C.readable(examples, I.vocab(spark, sf_dir), specials).select("rank", "slot", "pair_id", "input_text")


# -- preference sequences -------------------------------------------------------------------------------------------


@query
def pref_pairs(spark, sf_dir):
    return preference_table(I.prefs(spark, sf_dir))


@query
def pref_messages(spark, sf_dir):
    """The same pairs, read from lists of role/content messages."""

    def messages(answer: str) -> Column:
        turn = [F.struct(F.lit(r).alias("role"), F.col(c).alias("content")) for r, c in (("user", "prompt"), ("assistant", answer))]
        return F.array(*turn).alias(answer)

    listed = I.prefs(spark, sf_dir).select("pair_id", messages("chosen"), messages("rejected"))
    return preference_table(listed)


@query
def pref_turns(spark, sf_dir):
    """Lists of several turns, read with the roles."""

    def turn(role: str, text: str) -> Column:
        return F.struct(F.lit(role).alias("role"), F.col(text).alias("content"))

    before = (turn("user", "prompt"), turn("assistant", "chosen"), turn("user", "rejected"))
    listed = I.prefs(spark, sf_dir).select(
        "pair_id", *[F.array(*before, turn("assistant", side)).alias(f"_{side}") for side in ("chosen", "rejected")]
    )
    return preference_table(listed.withColumnsRenamed({"_chosen": "chosen", "_rejected": "rejected"}), turn=named_turn)


@query
def pref_split(spark, sf_dir):
    """A hosted table with a partition per split, of which one is read."""
    folder = I.new_folder(spark, "hosted")
    halves = F.when(F.col("p") % 3 == 0, "test").otherwise("train").alias("split")
    I.prefs(spark, sf_dir).select("*", halves).write.partitionBy("split").parquet(folder)
    return preference_table(read_table(spark, folder, split="test"))


def _hosted(spark, sf_dir):
    """The root of a dataset of preference pairs with two splits, the training split in two commits."""
    root = I.new_folder(spark, "datasets")
    prefs = I.prefs(spark, sf_dir)
    for split, part in (("train", F.col("p") % 3 == 1), ("test", F.col("p") % 3 == 0), ("train", F.col("p") % 3 == 2)):
        datasets.write_split(prefs.where(part), root, "own/preferences", split)
    return root


@query
def dataset_split(spark, sf_dir):
    """A dataset by name and split; three of its columns are read, and the filter is applied while reading."""
    named = datasets.load_split(spark, _hosted(spark, sf_dir), "own/preferences", schema="p BIGINT, pair_id STRING, chosen STRING")
    return named.where(F.col("p") >= 10)


@query
def dataset_stream(spark, sf_dir):
    """The commits of a split as a stream."""
    root = _hosted(spark, sf_dir)
    datasets.register(spark)
    arriving = spark.readStream.format(datasets.FORMAT).options(path=root, dataset="own/preferences")
    rows = arriving.schema("p BIGINT, pair_id STRING, chosen STRING").load()
    sink = rows.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}-state").format("parquet")
    sink.start(f"{root}-rows").awaitTermination()
    return spark.read.parquet(f"{root}-rows")


SEQUENCE_COLUMNS = ("input_ids", "attention_mask", "loss_mask", "labels")


def _labelled(spark, sf_dir, opts):
    made = R.sequences(I.pref_ids(spark, sf_dir), I.specials(spark, sf_dir).pad_id, opts)
    return R.completion_lengths(R.next_token_labels(made))


def _sequence_rows(df):
    return df.select("batch", "pair_id", "side", *texts(*SEQUENCE_COLUMNS), "completion_length")


@query
def pref_sequences(spark, sf_dir):
    return _sequence_rows(_labelled(spark, sf_dir, I.PREF))


@query
def pref_sequences_padded(spark, sf_dir):
    """The same from left-padded prompts and right-padded completions, truncated at the end."""
    opts = PreferenceOptions(batch_size=8, max_length=160, truncation_mode="keep_end")
    made = R.sequences_from_padded(I.pref_ids(spark, sf_dir), I.specials(spark, sf_dir).pad_id, opts)
    return _sequence_rows(R.completion_lengths(R.next_token_labels(made)))


@query
def pref_truncate_start(spark, sf_dir):
    opts = PreferenceOptions(batch_size=8, max_length=160, truncation_mode="keep_start")
    return _sequence_rows(_labelled(spark, sf_dir, opts))


@query
def pref_truncate_end(spark, sf_dir):
    opts = PreferenceOptions(batch_size=8, max_length=160, truncation_mode="keep_end")
    return _sequence_rows(_labelled(spark, sf_dir, opts))


@query
def pref_logits_to_keep(spark, sf_dir):
    made = R.logits_to_keep(R.sequences(I.pref_ids(spark, sf_dir), I.specials(spark, sf_dir).pad_id, I.PREF))
    kept = R.keep_trailing(R.next_token_labels(made))
    aligned = kept.withColumn("aligned_ids", R.align_to(F.col("input_ids"), F.col("labels")))
    return aligned.select("batch", "pair_id", "side", "logits_to_keep", *texts("labels", "loss_mask", "aligned_ids"))


def _packed(spark, sf_dir):
    return R.pack(R.sequences(I.pref_ids(spark, sf_dir), I.specials(spark, sf_dir).pad_id, I.PREF))


@query
def pref_packed(spark, sf_dir):
    return _packed(spark, sf_dir).select("batch", *texts("lengths", "input_ids", "loss_mask", "position_ids"))


@query
def pref_unpacked(spark, sf_dir):
    return R.unpack(_packed(spark, sf_dir)).select("batch", "p", "side", *texts("input_ids"))


@query
def pref_encoder_labels(spark, sf_dir):
    rows = R.concat_inputs(I.pref_ids(spark, sf_dir), I.specials(spark, sf_dir).pad_id, I.PREF)
    return R.encoder_decoder_labels(rows).select(
        "batch", "pair_id", "side", *texts("prompt_input_ids", "prompt_attention_mask", "labels")
    )


# -- losses and rewards ---------------------------------------------------------------------------------------------

PAIR_VALUES = ("chosen_logp", "rejected_logp", "chosen_reward", "rejected_reward", "reward_margin", "accuracy", "loss")


def _scored(spark, sf_dir, opts, **kwargs):
    return D.score(D.array_sums(I.scored_pairs(spark, sf_dir)), opts, ["batch"], **kwargs)


def _pair_rows(df):
    return df.select("pair_id", "chosen_length", "rejected_length", *rounded(*PAIR_VALUES))


@query
def dpo_regul(spark, sf_dir):
    return _pair_rows(_scored(spark, sf_dir, I.PREF).pairs)


@query
def dpo_ipo(spark, sf_dir):
    return _pair_rows(_scored(spark, sf_dir, PreferenceOptions(batch_size=8, length_normalised=True)).pairs)


@query
def dpo_ld(spark, sf_dir):
    return _pair_rows(_scored(spark, sf_dir, PreferenceOptions(batch_size=8, strategy="ld")).pairs)


def _token_rows(spark, sf_dir):
    """Token scores of the pairs with a row per token, as a scoring job would write them."""
    scored = I.scored_pairs(spark, sf_dir)
    rows = []
    for side in D.SIDES:
        zipped = F.arrays_zip(F.col(f"{side}_logps").alias("policy_logp"), F.col(f"ref_{side}_logps").alias("ref_logp"))
        listed = scored.select("pair_id", "batch", A.once(zipped).alias("tokens"))
        tokens = listed.select("pair_id", "batch", F.posexplode("tokens").alias("pos", "token"))
        rows.append(tokens.select("pair_id", "batch", F.lit(side).alias("side"), "pos", "token.policy_logp", "token.ref_logp"))
    return rows[0].unionByName(rows[1])


@query
def dpo_token_rows(spark, sf_dir):
    """Length desensitisation from a table with a row per token."""
    arrays = D.token_arrays(_token_rows(spark, sf_dir), ["pair_id", "batch"])
    opts = PreferenceOptions(batch_size=8, strategy="ld")
    return _pair_rows(D.score(D.array_sums(arrays), opts, ["batch"]).pairs)


@query
def dpo_user_loss(spark, sf_dir):
    """A hinge loss of a user in place of the default one."""
    scored = _scored(spark, sf_dir, I.PREF, loss_fn=lambda x: F.greatest(F.lit(0.0), 1.0 - x))
    return scored.pairs.select("pair_id", *rounded("loss"))


METRICS = ("rewards_chosen", "rewards_rejected", "rewards_accuracies", "rewards_margins", "logps_chosen", "logps_rejected")


@query
def dpo_metrics(spark, sf_dir):
    metrics = _scored(spark, sf_dir, I.PREF, extra_metrics={"longest_chosen": F.max("chosen_length")}).metrics
    return metrics.select("batch", "pairs", "longest_chosen", *rounded("loss", *METRICS))


@query
def dpo_eval_metrics(spark, sf_dir):
    scored = _scored(spark, sf_dir, I.PREF, return_metrics=False).pairs
    overall = D.overall_metrics(scored, evaluation=True)
    return overall.select("pairs", *rounded("loss", *[f"eval_{name}" for name in METRICS]))


def _exact_values():
    return {"loss": F.col("loss"), "rewards_chosen": F.col("chosen_reward"), "rewards_accuracies": F.col("accuracy"), "rewards_margins": F.col("reward_margin")}


@query
def dpo_metrics_exact(spark, sf_dir):
    """Means per batch and over all pairs (batch null) by sums that no division of the rows changes."""
    values = _exact_values()
    scored = _scored(spark, sf_dir, I.PREF, return_metrics=False).pairs
    per_batch = exact.parts(scored, ["batch"], values)
    overall = exact.merge(per_batch, []).withColumn("batch", F.lit(None).cast("bigint"))
    made = exact.sums(per_batch.unionByName(overall), ["batch"])
    return made.select("batch", "name", F.col("n").alias("pairs"), (F.round(F.col("total") / F.col("n"), 6) + F.lit(0.0)).alias("mean"))


@query
def run_loss_exact(spark, sf_dir):
    """Sum of the loss per run and log window, from accumulators of four parts of the steps, added up later."""
    steps = I.steps(spark, sf_dir).withColumn("window", H.log_window(I.LOG))
    keys = ["run_id", "window"]
    kept = [exact.parts(steps.where(F.pmod("global_step", F.lit(4)) == i), keys, {"loss": F.col("loss")}) for i in range(4)]
    folder = I.new_folder(spark, "loss-parts")
    for i, part in enumerate(kept):
        part.write.parquet(f"{folder}/part={i}")
    made = exact.sums(exact.merge(spark.read.parquet(folder).drop("part"), keys), keys)
    return made.select("run_id", "window", "n", (F.round("total", 6) + F.lit(0.0)).alias("loss"))


@query
def dpo_reference_join(spark, sf_dir):
    """Reference scores from a table of their own instead of the pair's columns."""
    sums = D.array_sums(I.scored_pairs(spark, sf_dir))
    policy = sums.drop("ref_chosen_logp", "ref_rejected_logp")
    joined = D.with_reference(policy, sums.select("pair_id", "ref_chosen_logp", "ref_rejected_logp"), ["pair_id"])
    scored = D.score(joined, I.PREF, ["batch"], return_metrics=False).pairs
    return scored.select("pair_id", *rounded("ref_chosen_logp", "ref_rejected_logp", "loss"))


@query
def label_logp(spark, sf_dir):
    scored = D.label_scores(I.logits(spark, sf_dir), weighting=True)
    return scored.select("request_id", *rounded("logp", "lse2", "logit_sum"), "logit_count")


def _long_logits(spark, sf_dir):
    dense = I.logits(spark, sf_dir).select("request_id", "label_id", A.once(F.col("logits")).alias("logits"))
    return dense.select("request_id", "label_id", F.posexplode("logits").alias("token_id", "logit"))


@query
def label_logp_long(spark, sf_dir):
    scored = D.long_label_scores(_long_logits(spark, sf_dir), ["request_id"])
    return scored.select("request_id", *rounded("logp", "logit_sum"), "logit_count")


def _places(spark, sf_dir, scale):
    """Ten score rows make a pair: five places of either side.  The masked ones differ by pair and side, and may
    include the first and the last place."""
    scored = D.label_scores(I.logits(spark, sf_dir, scale), weighting=True)
    row = F.col("request_id")
    pos = F.floor(F.pmod(row, F.lit(10)) / 2)
    pair, chosen = F.floor(row / 10), row % 2 == 0
    low = F.when(chosen, pair % 2).otherwise(1 - pair % 2)
    high = F.when(chosen, 4 - pair % 3).otherwise(3 + pair % 2)
    return scored.select(
        F.floor(row / 10).alias("pair_id"),
        F.when(row % 2 == 0, "chosen").otherwise("rejected").alias("side"),
        pos.alias("pos"),
        pos.between(low, high).cast("int").alias("mask"),
        (pos == 4).alias("is_last"),
        "label_id",
        "logp",
        "lse2",
        "logit_sum",
        "logit_count",
    )


def _logit_pairs(spark, sf_dir):
    """Pairs with policy sums from the scores, and reference sums from the same scores at a lower scale."""
    key = ["pair_id"]
    policy = D.pair_sums(D.realigned(_places(spark, sf_dir, 10.0), key), key)
    reference = D.pair_sums(_places(spark, sf_dir, 8.0), key).select(
        "pair_id", F.col("chosen_logp").alias("ref_chosen_logp"), F.col("rejected_logp").alias("ref_rejected_logp")
    )
    batch = F.floor(F.col("pair_id") / 8).alias("batch")
    return D.with_reference(policy, reference, key).select("*", batch)


@query
def sequence_logp(spark, sf_dir):
    sums = D.sequence_sums(_places(spark, sf_dir, 10.0), ["pair_id"])
    return sums.select("pair_id", "side", "length", "nll_count", *rounded("logp", "nll_sum"))


@query
def sequence_logp_encoder(spark, sf_dir):
    """Sums for an encoder-decoder model, whose last place counts for the negative log-likelihood."""
    sums = D.sequence_sums(_places(spark, sf_dir, 10.0), ["pair_id"], PreferenceOptions(encoder_decoder=True))
    return sums.select("pair_id", "side", "length", "nll_count", *rounded("logp", "nll_sum"))


@query
def dpo_rpo(spark, sf_dir):
    scored = D.score(_logit_pairs(spark, sf_dir), PreferenceOptions(rpo_alpha=0.5), ["batch"]).pairs
    return scored.select("pair_id", "chosen_length", *rounded("chosen_logp", "ref_chosen_logp", "nll_loss", "loss"))


@query
def dpo_weighted(spark, sf_dir):
    scored = D.score(_logit_pairs(spark, sf_dir), PreferenceOptions(use_weighting=True), ["batch"]).pairs
    return scored.select("pair_id", *rounded("policy_weight", "loss"))


@query
def dpo_aux(spark, sf_dir):
    pairs = _logit_pairs(spark, sf_dir).withColumn("aux_loss", F.col("chosen_logit_sum") / 100)
    scored = D.score(pairs, PreferenceOptions(aux_loss_coef=0.01), ["batch"]).pairs
    return scored.select("pair_id", *rounded("loss"))


@query
def dpo_logit_metrics(spark, sf_dir):
    scored = D.score(_logit_pairs(spark, sf_dir), PreferenceOptions(rpo_alpha=0.5), ["batch"])
    return scored.metrics.select("batch", "pairs", *rounded("loss", *METRICS, "logits_chosen", "logits_rejected", "nll_loss"))


# -- choice of the next token ---------------------------------------------------------------------------------------


@query
def topk_softmax(spark, sf_dir):
    kept = I.logits(spark, sf_dir).select("request_id", G.top_k(F.col("logits"), 5).alias("kept"))
    shares = kept.select("request_id", A.once(G.probabilities(F.col("kept"), 0.7)).alias("shares"))
    shares = shares.select("request_id", F.posexplode("shares").alias("token_id", "probability"))
    return shares.where(F.col("probability") > 0).select("request_id", "token_id", *rounded("probability"))


@query
def topk_long(spark, sf_dir):
    kept = G.long_top_k(_long_logits(spark, sf_dir), ["request_id"], 5)
    return kept.select("request_id", "token_id", *rounded("logit"))


@query
def greedy(spark, sf_dir):
    return I.logits(spark, sf_dir).select("request_id", G.next_token(F.col("logits"), DecodeOptions()).alias("token_id"))


@query
def greedy_long(spark, sf_dir):
    return G.long_greedy(_long_logits(spark, sf_dir), ["request_id"])


@query
def sampled(spark, sf_dir):
    opts = DecodeOptions(top_k=20, temperature=0.8)
    drawn = G.next_token(F.col("logits"), opts, F.col("request_id"))
    return I.logits(spark, sf_dir).select("request_id", drawn.alias("token_id"))


def _history():
    """Tokens used before, made from the row itself: the label, and two that follow from the row number."""
    row = F.col("request_id")
    return F.array("label_id", F.pmod(row, F.lit(64)).cast("int"), F.pmod(row * 7, F.lit(64)).cast("int"))


@query
def repetition(spark, sf_dir):
    penalised = A.once(G.repetition_penalty(F.col("logits"), _history(), 1.1)).alias("penalised")
    scores = I.logits(spark, sf_dir).select("request_id", penalised)
    scores = scores.select("request_id", F.posexplode("penalised").alias("token_id", "logit"))
    return scores.select("request_id", "token_id", *rounded("logit"))


@query
def repetition_long(spark, sf_dir):
    history = I.logits(spark, sf_dir).select("request_id", F.explode(_history()).alias("token_id"))
    scores = G.long_repetition_penalty(_long_logits(spark, sf_dir), history, ["request_id"], 1.1)
    return scores.select("request_id", "token_id", *rounded("logit"))


@query
def crop_context(spark, sf_dir):
    return I.prepared(spark, sf_dir).select("pair_id", A.as_text(G.crop(F.col("input_ids"), 100)).alias("ids"))


# -- responses ------------------------------------------------------------------------------------------------------


def _prompt_table(spark, sf_dir):
    return M.prompts(I.pairs(spark, sf_dir).select(F.col("pair_id").alias("prompt_id"), "instruction"))


def _echo():
    """Stub of a base model: repeats the instruction that the prompt holds."""

    def answer(prompts: pd.Series) -> pd.Series:
        return prompts.str.slice(len(X.SYSTEM_TEXT["v1"] + X.INSTRUCTION_MARKER), -len("\n\n" + X.RESPONSE_MARKER))

    return answer


def _recorded(spark, sf_dir):
    return I.pairs(spark, sf_dir).select(F.col("pair_id").alias("prompt_id"), "response")


@query
def compare_responses(spark, sf_dir):
    prompts = _prompt_table(spark, sf_dir)
    base = M.respond(prompts, "base", _echo).drop("model")
    return M.compare(prompts, _recorded(spark, sf_dir), base)


@query
def responses_tuned_only(spark, sf_dir):
    return M.compare(_prompt_table(spark, sf_dir), _recorded(spark, sf_dir))


@query
def response_cut(spark, sf_dir):
    """Responses cut out of whole sequences after the prompt's ids, without special tokens."""
    output = I.prepared(spark, sf_dir).select("pair_id", "n_prompt", F.col("input_ids").alias("output_ids"))
    return M.cut_response(output, I.vocab(spark, sf_dir)).select("pair_id", "response")


def _successors(prepared: DataFrame) -> DataFrame:
    """``prev, next``: the most frequent next id of every id; at most one row per vocabulary entry."""
    n = F.size("input_ids") - 1
    steps = F.arrays_zip(F.slice("input_ids", F.lit(1), n).alias("prev"), F.slice("input_ids", F.lit(2), n).alias("next"))
    counts = prepared.select(F.inline(steps)).groupBy("prev", "next").agg(F.count("*").alias("times"))
    return counts.groupBy("prev").agg(F.max_by("next", F.struct("times", -F.col("next"))).alias("next"))


def _generation_requests(spark, sf_dir):
    own = I.pairs(spark, sf_dir).select(F.col("pair_id").alias("prompt_id"), "instruction")
    fixed = M.default_prompts(spark).select(F.concat(F.lit("default-"), F.col("prompt_id").cast("string")).alias("prompt_id"), "instruction")
    asked = M.prompts(own.unionByName(fixed)).select(F.col("prompt_id").alias("request_id"), "prompt")
    return P.encode_text(asked, {"prompt": "ids"}, I.vocab(spark, sf_dir)).select("request_id", "ids")


def _responses(spark, sf_dir, made):
    whole = made.select("request_id", "new_ids", F.size("ids").alias("n_prompt"), F.concat("ids", "new_ids").alias("output_ids"))
    return M.cut_response(whole, I.vocab(spark, sf_dir)).select("request_id", *texts("new_ids"), "response")


@query
def generate_bigram(spark, sf_dir):
    """Greedy generation from the formatted prompts of all pairs and of the default instructions, cut to the response.

    The model is a table of successors with a row per vocabulary entry at most, so the option that bounds the
    vocabulary bounds what is broadcast.
    """
    specials = I.specials(spark, sf_dir)
    if specials.vocab_size > I.SFT.vocab_size + 3:
        raise ValueError("the vocabulary is larger than its option says")
    rows = _successors(I.prepared(spark, sf_dir)).toPandas()
    following = np.full(specials.vocab_size, specials.eos_id)
    following[rows["prev"]] = rows["next"]
    shared = spark.sparkContext.broadcast(following)

    def make_scorer():
        def scorer(contexts):
            scores = np.zeros((len(contexts), len(shared.value)), np.bool_)
            scores[np.arange(len(contexts)), shared.value[[ids[-1] for ids in contexts]]] = True
            return scores

        return scorer

    requests = _generation_requests(spark, sf_dir)
    return _responses(spark, sf_dir, G.generate(requests, make_scorer, specials.eos_id, DecodeOptions()))


@query
def generate_recursive(spark, sf_dir):
    """The same by a recursive query over a table of next tokens, without a model in Python."""
    following = chains.next_tokens(I.prepared(spark, sf_dir), 1)
    requests, eos_id = _generation_requests(spark, sf_dir), I.specials(spark, sf_dir).eos_id
    return _responses(spark, sf_dir, chains.generate(requests, following, eos_id, DecodeOptions().max_new_tokens))


# -- training logs --------------------------------------------------------------------------------------------------

WINDOW_VALUES = (
    "running_loss",
    "epoch_progress",
    "ms_forward",
    "ms_backward",
    "ms_build_batch",
    "ms_optimizer_step",
    "ms_per_step",
    "tokens_per_s",
)


def _window_rows(records):
    lr = F.round(F.col("lr") * 1e9, 4).alias("lr_e9")
    whole = ["run_id", "global_step", "epoch", "batches_remaining", "tokens_per_step"]
    return records.select(*whole, lr, *rounded(*WINDOW_VALUES))


@query
def run_steps(spark, sf_dir):
    return I.steps(spark, sf_dir)


@query
def run_windows(spark, sf_dir):
    return _window_rows(H.run_windows(I.steps(spark, sf_dir), I.LOG))


@query
def metric_sink(spark, sf_dir):
    """Log records are appended to the metric table of all runs and read back."""
    folder = I.new_folder(spark, "metrics")
    for _ in range(2):  # a retry replaces what it wrote before
        H.append_records(H.run_windows(I.steps(spark, sf_dir), I.LOG), folder, "all")
    return _window_rows(spark.read.parquet(folder).drop("batch"))


def _step_options(spark, sf_dir):
    sizes = epochs.split_sizes(I.split_rows(spark, sf_dir))
    batches = epochs.batch_counts(sizes, I.SFT).where(F.col("split") == "train").first()["batches"]
    return H.LogOptions(log_freq=4, checkp_freq=5, batches=batches, num_epochs=I.SFT.num_epochs, world_size=4, batch_size=8)


def _planned_batches(spark, sf_dir):
    opts = _step_options(spark, sf_dir)
    return epochs.batch_numbers(spark, opts.batches, opts.num_epochs)


@query
def lr_schedule(spark, sf_dir):
    plan = H.step_plan(_planned_batches(spark, sf_dir), _step_options(spark, sf_dir))
    return plan.select("epoch", "batch", "epoch_step", "global_step", F.round(F.col("lr") * 1e9, 4).alias("lr_e9"))


@query
def checkpoint_steps(spark, sf_dir):
    batches, opts = _planned_batches(spark, sf_dir), _step_options(spark, sf_dir)
    per_epoch = H.step_plan(batches, opts, "epoch").select("global_step", "logs", F.col("saves").alias("saves_epoch"))
    at_end = H.step_plan(batches, opts, "run").select("global_step", F.col("saves").alias("saves_run"))
    return per_epoch.join(at_end, "global_step")


@query
def run_record(spark, sf_dir):
    sizes = epochs.split_sizes(I.split_rows(spark, sf_dir))
    train_rows = sizes.where(F.col("split") == "train").first()["rows"]
    opts = _step_options(spark, sf_dir)
    whole = epochs.batch_counts(sizes, I.SINGLE).where(F.col("split") == "train").first()["batches"]
    multi = H.run_record(spark, "sharded", opts, train_rows, False)
    single = H.run_record(spark, "single", replace(opts, batches=whole, world_size=1), train_rows, True, single_process=True)
    return multi.unionByName(single).select("run_id", "training_rows", "num_batches", "world_size", "resumed")


@query
def resume_state(spark, sf_dir):
    """Saved states of all runs are written, read back, and the furthest of each run is taken."""
    return _resumed(spark, I.steps(spark, sf_dir))


def _resumed(spark, steps):
    folder = I.new_folder(spark, "run-state")
    H.append_state(H.saved_states(steps, I.LOG), folder, "all")
    states = spark.read.schema(f"{H.STATE_SCHEMA}, batch STRING").parquet(folder).drop("batch")
    return H.latest_state(states).select("run_id", "epoch", "global_step", "epoch_step", *rounded("running_loss"))


@query
def resume_state_phases(spark, sf_dir):
    """The same for steps of four phases each."""
    return _resumed(spark, I.phase_steps(spark, sf_dir))


@query
def run_windows_phases(spark, sf_dir):
    return _window_rows(H.run_windows(I.phase_steps(spark, sf_dir), I.PHASE_LOG))


# -- streams --------------------------------------------------------------------------------------------------------


@query
def stream_prepare(spark, sf_dir, **bound):
    folder = I.new_folder(spark, "stream-prepare")
    schema = I.table(spark, sf_dir, "documents").schema
    arriving = adapters.document_pairs(jobs.read_stream(spark, f"{sf_dir}/documents.parquet", schema))
    run = jobs.prepare_stream(arriving, I.vocab(spark, sf_dir), I.SFT, f"{folder}/rows", f"{folder}/checkpoint", **bound)
    run.awaitTermination()
    return spark.read.parquet(f"{folder}/rows").select("pair_id", "n_tokens", "n_prompt", *texts("input_ids"))


@query
def stream_prepare_joined(spark, sf_dir):
    """The same for a vocabulary that is too large to broadcast."""
    return stream_prepare(spark, sf_dir, bound=0)


@query
def stream_windows(spark, sf_dir):
    folder = I.new_folder(spark, "stream-windows")
    return _streamed_windows(spark, I.steps(spark, sf_dir), folder, I.LOG)


def _streamed_windows(spark, steps, folder, opts):
    source = steps.inputFiles()[0].rsplit("/", 1)[0]
    arriving = jobs.read_stream(spark, source, steps.schema, files_per_batch=4)
    jobs.window_stream(arriving, opts, f"{folder}/parts", f"{folder}/checkpoint").awaitTermination()
    return _window_rows(jobs.read_windows(spark, opts, f"{folder}/parts"))


@query
def stream_windows_phases(spark, sf_dir):
    """Steps of four phases in files that arrive in no order of steps, so that phases of a step come late."""
    folder = I.new_folder(spark, "stream-phases")
    I.phase_steps(spark, sf_dir).repartition(8, "phase", "run_id").write.parquet(f"{folder}/source")
    return _streamed_windows(spark, spark.read.parquet(f"{folder}/source"), folder, I.PHASE_LOG)


@query
def stream_windows_live(spark, sf_dir):
    """Each record once, from files in no order of steps, with a restart and rows that come twice."""
    folder = I.new_folder(spark, "stream-live")
    steps = I.phase_steps(spark, sf_dir)
    for part in (F.col("phase") != "forward", (F.col("phase") == "forward") | (F.col("global_step") == 3)):
        steps.where(part).repartition(4, "phase", "run_id").write.mode("append").parquet(f"{folder}/source")
        arriving = jobs.read_stream(spark, f"{folder}/source", steps.schema, files="*.parquet", files_per_batch=4)
        jobs.live_window_stream(arriving, I.PHASE_LOG, f"{folder}/records", f"{folder}/checkpoint", rows_per_step=4).awaitTermination()
    return _window_rows(spark.read.parquet(f"{folder}/records"))


@query
def epoch_order(spark, sf_dir):
    """An epoch order by arithmetic alone, over rows that were numbered once."""
    return permuted.epoch_order(I.numbered(spark, sf_dir), I.SFT)


@query
def rank_slots(spark, sf_dir):
    """What one rank reads from its second batch of the last epoch on, from the split sizes alone."""
    rows = I.numbered(spark, sf_dir)
    mine = permuted.row_numbers(spark, permuted.split_counts(rows), I.SFT, "train", I.SFT.num_epochs - 1, 1, first_batch=1)
    return mine.join(rows.where(F.col("split") == "train"), "i").select("batch", "slot", "pair_id")


@query
def shard_resume(spark, sf_dir):
    """Training batches written for loaders, and read back from step 2 of epoch 1 on."""
    folder = I.new_folder(spark, "shards")
    ids = I.prepared(spark, sf_dir).select("pair_id", "input_ids")
    batches = I.plan(spark, sf_dir).where(F.col("split") == "train").select("epoch", "rank", "batch", "slot", "pair_id").join(ids, "pair_id")
    shards.write_shards(batches, folder)
    return shards.read_shards(spark, folder, batches.schema, 1, 2).select("epoch", "rank", "batch", "slot", "pair_id", *texts("input_ids"))
