"""Preference sequences: chosen and rejected rows of a batch, joined, flushed, truncated, labelled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftframe.functions import arrays as A
from sftframe.operators.prepare import encode_text
from sftframe.operators.vocab import Specials
from sftframe.options import IGNORE_ID, PreferenceOptions

SEQUENCE = ("attention_mask", "input_ids", "loss_mask")


def encode_pairs(prefs: DataFrame, vocab: DataFrame, specials: Specials) -> DataFrame:
    """``p, pair_id, prompt_ids, chosen_ids, rejected_ids``; both completions end with EOS."""
    columns = {"prompt": "prompt_ids", "chosen": "chosen_ids", "rejected": "rejected_ids"}
    encoded = encode_text(prefs, columns, vocab)
    eos = F.array(F.lit(specials.eos_id))
    return encoded.select(
        "p",
        "pair_id",
        "prompt_ids",
        F.concat("chosen_ids", eos).alias("chosen_ids"),
        F.concat("rejected_ids", eos).alias("rejected_ids"),
    )


def _mask(ids: Column, bit: int) -> Column:
    return F.array_repeat(F.lit(bit), F.size(ids))


def concat_inputs(pairs: DataFrame, pad_id: int, opts: PreferenceOptions) -> DataFrame:
    """Two rows per pair (``side``), padded to the batch: prompts on the left, completions on the right.

    A batch is ``batch_size`` pairs in order of ``p``.  One shuffle on the batch serves this and every later
    per-batch width.
    """
    batch = Window.partitionBy("batch")
    longest = F.greatest(F.size("chosen_ids"), F.size("rejected_ids"))
    sized = (
        pairs.withColumn("batch", F.floor(F.col("p") / opts.batch_size))
        .withColumn("_prompt_width", F.max(F.size("prompt_ids")).over(batch))
        .withColumn("_completion_width", F.max(longest).over(batch))
    )
    sides = F.explode(
        F.array(
            F.struct(F.lit("chosen").alias("side"), F.col("chosen_ids").alias("ids")),
            F.struct(F.lit("rejected").alias("side"), F.col("rejected_ids").alias("ids")),
        )
    ).alias("_row")
    rows = sized.select("batch", "p", "pair_id", "prompt_ids", "_prompt_width", "_completion_width", sides)
    prompt, ids = F.col("prompt_ids"), F.col("_row.ids")
    prompt_width, completion_width = F.col("_prompt_width"), F.col("_completion_width")
    return rows.select(
        "batch",
        "p",
        "pair_id",
        "_row.side",
        A.pad_left(prompt, prompt_width, F.lit(pad_id)).alias("prompt_input_ids"),
        A.pad_left(_mask(prompt, 1), prompt_width, F.lit(0)).alias("prompt_attention_mask"),
        A.pad_right(ids, completion_width, F.lit(pad_id)).alias("completion_input_ids"),
        A.pad_right(_mask(ids, 1), completion_width, F.lit(0)).alias("completion_attention_mask"),
    )


def join_sequences(rows: DataFrame) -> DataFrame:
    """Prompt and completion as one sequence; the loss mask is 0 over the prompt."""
    return rows.select(
        "batch",
        "p",
        "pair_id",
        "side",
        F.concat("prompt_attention_mask", "completion_attention_mask").alias("attention_mask"),
        F.concat("prompt_input_ids", "completion_input_ids").alias("input_ids"),
        F.concat(_mask(F.col("prompt_input_ids"), 0), "completion_attention_mask").alias("loss_mask"),
    )


def _each(df: DataFrame, change) -> DataFrame:
    return df.withColumns({name: change(F.col(name)) for name in SEQUENCE})


def flush_left(df: DataFrame) -> DataFrame:
    """Move every sequence to the start of its row, then drop the columns that are empty in the whole batch."""
    batch = Window.partitionBy("batch")
    shifted = _each(
        df.withColumn("_shift", A.leading_zeros(F.col("attention_mask"))), lambda x: A.rotate_left(x, F.col("_shift"))
    )
    width = F.max(A.last_one(F.col("attention_mask"))).over(batch)
    return _each(shifted.withColumn("_width", width), lambda x: A.head(x, F.col("_width"))).drop("_shift", "_width")


def flush_right(df: DataFrame) -> DataFrame:
    """Move every sequence to the end of its row, then drop the columns that are empty in the whole batch."""
    batch = Window.partitionBy("batch")
    shifted = _each(
        df.withColumn("_shift", A.trailing_zeros(F.col("attention_mask"))), lambda x: A.rotate_right(x, F.col("_shift"))
    )
    width = F.max(A.last_one(F.reverse("attention_mask"))).over(batch)
    return _each(shifted.withColumn("_width", width), lambda x: A.tail(x, F.col("_width"))).drop("_shift", "_width")


def truncated(df: DataFrame, opts: PreferenceOptions) -> DataFrame:
    """Flushed sequences of at most ``max_length``; rows that fit are left whole."""
    if opts.max_length is None:
        return flush_left(df)
    if opts.truncation_mode == "keep_start":
        return _each(flush_left(df), lambda x: A.head(x, opts.max_length))
    return flush_left(_each(flush_right(df), lambda x: A.tail(x, opts.max_length)))


def next_token_labels(df: DataFrame) -> DataFrame:
    """``labels``: the next id of each place; ``loss_mask`` moves along.  Both wrap around at the row's end."""
    return df.withColumn("labels", A.roll_back(F.col("input_ids"))).withColumn(
        "loss_mask", A.roll_back(F.col("loss_mask"))
    )


def completion_lengths(df: DataFrame) -> DataFrame:
    return df.withColumn("completion_length", A.ones(F.col("loss_mask")))


def sequences_from_padded(pairs: DataFrame, pad_id: int, opts: PreferenceOptions) -> DataFrame:
    """``sequences`` by way of the padded prompts and completions of ``concat_inputs``."""
    return truncated(join_sequences(concat_inputs(pairs, pad_id, opts)), opts)


def sequences(pairs: DataFrame, pad_id: int, opts: PreferenceOptions) -> DataFrame:
    """``batch, p, pair_id, side, attention_mask, input_ids, loss_mask`` ready for a decoder-only model.

    Flushing undoes the padding of prompts and completions, so they are joined without any: parts are trimmed to
    what can remain, moved to their batch in one shuffle, and padded once to the final width.
    """

    def cut(values: Column) -> Column:
        if opts.max_length is None:
            return values
        return A.head(values, opts.max_length) if opts.truncation_mode == "keep_start" else A.tail(values, opts.max_length)

    prompt, chosen, rejected = F.col("prompt_ids"), F.col("chosen_ids"), F.col("rejected_ids")
    longest = F.size(prompt) + F.greatest(F.size(chosen), F.size(rejected))
    if opts.max_length is not None:
        longest = F.least(longest, F.lit(opts.max_length))
    trimmed = pairs.withColumns({name: cut(F.col(name)) for name in ("prompt_ids", "chosen_ids", "rejected_ids")})
    batched = trimmed.withColumn("batch", F.floor(F.col("p") / opts.batch_size)).withColumn(
        "_width", F.max(longest).over(Window.partitionBy("batch"))
    )

    def side(name: str, ids: Column) -> Column:
        loss_mask = F.concat(_mask(prompt, 0), _mask(ids, 1))
        return F.struct(F.lit(name).alias("side"), cut(F.concat(prompt, ids)).alias("ids"), cut(loss_mask).alias("mask"))

    sides = F.explode(F.array(side("chosen", chosen), side("rejected", rejected))).alias("_row")
    ids, width, zero = F.col("_row.ids"), F.col("_width"), F.lit(0)
    return batched.select("batch", "p", "pair_id", "_width", sides).select(
        "batch",
        "p",
        "pair_id",
        "_row.side",
        A.pad_right(_mask(ids, 1), width, zero).alias("attention_mask"),
        A.pad_right(ids, width, F.lit(pad_id)).alias("input_ids"),
        A.pad_right(F.col("_row.mask"), width, zero).alias("loss_mask"),
    )


def logits_to_keep(df: DataFrame) -> DataFrame:
    """Add how many trailing places of the batch need scores; to be called before the labels are made."""
    first = F.array_position("loss_mask", F.lit(1)).cast("int")
    at = F.min(F.when(first > 0, first - 1)).over(Window.partitionBy("batch"))
    return df.withColumn("logits_to_keep", F.size("loss_mask") - at + 1)


def align_to(values: Column, shorter: Column) -> Column:
    """The trailing part of ``values`` that is as long as ``shorter``."""
    return A.tail(values, F.size(shorter))


def keep_trailing(df: DataFrame) -> DataFrame:
    """Labels and loss mask of the places that ``logits_to_keep`` names."""
    kept = F.col("logits_to_keep")
    return df.withColumn("labels", A.tail(F.col("labels"), kept)).withColumn(
        "loss_mask", A.tail(F.col("loss_mask"), kept)
    )


def pack(df: DataFrame) -> DataFrame:
    """One row per batch without padding: chosen sequences first, laid end to end, places restart at 0 for each."""

    def present(values: Column) -> Column:
        pairs = F.arrays_zip(values.alias("value"), F.col("attention_mask").alias("kept"))
        return F.transform(F.filter(pairs, lambda x: x["kept"] == 1), lambda x: x["value"])

    rows = F.array_sort(
        F.collect_list(
            F.struct(
                "side",
                "p",
                present(F.col("input_ids")).alias("input_ids"),
                present(F.col("loss_mask")).alias("loss_mask"),
                A.ones(F.col("attention_mask")).cast("int").alias("length"),
            )
        )
    )
    places = F.transform(
        "_rows.length", lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    )
    return (
        df.groupBy("batch")
        .agg(rows.alias("_rows"))
        .select(
            "batch",
            F.col("_rows.side").alias("sides"),
            F.col("_rows.p").alias("ps"),
            F.col("_rows.length").alias("lengths"),
            F.flatten("_rows.input_ids").alias("input_ids"),
            F.flatten("_rows.loss_mask").alias("loss_mask"),
            F.flatten(places).alias("position_ids"),
        )
    )


def unpack(packed: DataFrame, values: str = "input_ids") -> DataFrame:
    """Back from a packed batch to one row per sequence."""
    ends = F.transform(F.sequence(F.lit(1), F.size("lengths")), lambda k: A.ones(F.slice("lengths", F.lit(1), k)))
    parts = F.arrays_zip(F.col("sides"), F.col("ps"), F.col("lengths"), ends.alias("ends"))
    return packed.select("batch", F.inline(parts), F.col(values).alias("_values")).select(
        "batch",
        F.col("sides").alias("side"),
        F.col("ps").alias("p"),
        F.slice("_values", (F.col("ends") - F.col("lengths") + 1).cast("int"), F.col("lengths")).alias(values),
    )


def encoder_decoder_labels(rows: DataFrame, label_pad_id: int = IGNORE_ID) -> DataFrame:
    """Labels of an encoder-decoder model: completion ids, padding replaced by the ignored label."""
    labels = F.zip_with(
        "completion_input_ids",
        "completion_attention_mask",
        lambda x, kept: F.when(kept == 0, F.lit(label_pad_id)).otherwise(x),
    )
    return rows.withColumn("labels", labels)
