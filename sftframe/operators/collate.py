"""Batches of inputs and labels: pad to the batch, shift, mask."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftframe.functions.arrays import head, pad_right
from sftframe.functions.numeric import let
from sftframe.operators.prepare import decode
from sftframe.operators.vocab import Specials
from sftframe.options import SftOptions
from sftframe.session import ship_package

BATCH_KEY = ["split", "epoch", "rank", "batch"]


def padded(ids: Column, width: Column, pad_id: int) -> Column:
    return pad_right(ids, width, F.lit(pad_id))


def input_side(ids: Column, opts: SftOptions) -> Column:
    """The padded ids; with shifted labels all but the last."""
    return head(ids, F.size(ids) - 1) if opts.shift_labels else ids


def label_side(ids: Column, n_prompt: Column, pad_id: int, opts: SftOptions) -> Column:
    """The padded ids (shifted: all but the first), with the instruction and the padding masked.

    A single pad label stays as it is.  With shifted labels the mask still covers ``n_prompt`` labels, hence also
    the first response token, unless ``align_shifted_mask`` is set.
    """
    ignored, pad = F.lit(opts.ignore_id), F.lit(pad_id)

    def without_instruction(labels: Column) -> Column:
        covered = n_prompt - 1 if opts.shift_labels and opts.align_shifted_mask else n_prompt
        covered = F.least(F.greatest(covered, F.lit(0)), F.size(labels))
        return F.concat(F.array_repeat(ignored, covered), F.slice(labels, covered + 1, F.size(labels) - covered))

    def without_padding(labels: Column) -> Column:
        enough = F.size(F.filter(labels, lambda x: x == pad)) >= opts.min_pads_to_mask
        masked = F.transform(labels, lambda x: F.when(x == pad, ignored).otherwise(x))
        return F.when(enough, masked).otherwise(labels)

    labels = F.slice(ids, F.lit(2), F.size(ids) - 1) if opts.shift_labels else ids
    if opts.mask_instruction:
        labels = let(labels, without_instruction)
    return let(labels, without_padding)


def collate(plan: DataFrame, prepared: DataFrame, specials: Specials, opts: SftOptions) -> DataFrame:
    """One row per example of the plan: ``inputs`` and ``labels`` of the width of its batch.

    The widths are already in the narrow plan, so this is one join on the row id.
    """
    ids = F.col("_padded")
    return (
        plan.join(prepared.select("pair_id", "n_prompt", "input_ids"), "pair_id")
        .withColumn("_padded", padded(F.col("input_ids"), F.col("width"), specials.pad_id))
        .select(
            *BATCH_KEY,
            "slot",
            "pair_id",
            input_side(ids, opts).alias("inputs"),
            label_side(ids, F.col("n_prompt"), specials.pad_id, opts).alias("labels"),
        )
    )


def stack(examples: DataFrame) -> DataFrame:
    """One row per batch: matrices of inputs and labels, rows in batch order.  A group is one batch."""
    rows = F.array_sort(F.collect_list(F.struct("slot", "inputs", "labels")))
    return (
        examples.groupBy(*reversed(BATCH_KEY))
        .agg(rows.alias("_rows"))
        .select(*BATCH_KEY, F.col("_rows.inputs").alias("inputs"), F.col("_rows.labels").alias("labels"))
    )


def stacked(plan: DataFrame, prepared: DataFrame, specials: Specials, opts: SftOptions) -> DataFrame:
    """The same as ``stack(collate(...))``; the ids move to their batch as they are, and are padded there."""
    row = F.struct("slot", "n_prompt", "input_ids")
    grouped = (
        plan.join(prepared.select("pair_id", "n_prompt", "input_ids"), "pair_id")
        .groupBy(*reversed(BATCH_KEY))
        .agg(F.array_sort(F.collect_list(row)).alias("_rows"), F.max("width").alias("_width"))
    )

    def rows(side: Callable[[Column, Column], Column]) -> Column:
        return F.transform("_rows", lambda r: side(padded(r["input_ids"], F.col("_width"), specials.pad_id), r["n_prompt"]))

    return grouped.select(
        *BATCH_KEY,
        rows(lambda ids, _: input_side(ids, opts)).alias("inputs"),
        rows(lambda ids, n_prompt: label_side(ids, n_prompt, specials.pad_id, opts)).alias("labels"),
    )


def collate_with(examples: DataFrame, collator: Callable, schema: str) -> DataFrame:
    """Hand each batch to a collator of the user's: a function from a pandas frame to a pandas frame."""
    ship_package(examples.sparkSession)
    return examples.groupBy(*BATCH_KEY).applyInPandas(collator, schema)


def readable(examples: DataFrame, vocab: DataFrame, specials: Specials) -> DataFrame:
    """Add ``input_text`` and ``label_text``; ignored labels are shown as padding."""
    shown = F.transform("labels", lambda x: F.when(x == specials.ignore_id, specials.pad_id).otherwise(x))
    return decode(
        examples.withColumn("_shown", shown),
        {"inputs": "input_text", "_shown": "label_text"},
        vocab,
    ).drop("_shown")


def first_batch(plan: DataFrame) -> DataFrame:
    """Plan rows of every rank's first training batch."""
    return plan.where((F.col("split") == "train") & (F.col("epoch") == 0) & (F.col("batch") == 0))


def sample_report(
    plan: DataFrame, prepared: DataFrame, vocab: DataFrame, specials: Specials, opts: SftOptions
) -> DataFrame:
    """The first example of every rank's first training batch, as ids and as text.

    One row per rank is picked from the plan before any token array is read; that side is broadcast.
    """
    picked = F.broadcast(first_batch(plan).where(F.col("slot") == 0))
    return readable(collate(picked, prepared, specials, opts), vocab, specials)
