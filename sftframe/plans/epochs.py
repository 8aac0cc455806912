"""Which row is trained on when: split, shuffle per epoch, shards of ranks, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftframe.options import SftOptions
from sftframe.plans.index import among_first, bucket_digits, hashed_positions, seeded_key


def assign_split(rows: DataFrame, opts: SftOptions) -> DataFrame:
    """Add ``split``: the first ``ceil(test_split * N)`` rows of one seeded order are test rows, for every rank.

    The rows are read a few times for their ids, and none is shuffled.
    """
    key = seeded_key(F.lit(opts.seed), F.lit("split"), F.col("pair_id"))
    is_test = among_first(rows, key, "pair_id", opts.test_split)
    return rows.withColumn("split", F.when(is_test, "test").otherwise("train"))


def split_sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("rows"))


def epoch_plan(rows: DataFrame, opts: SftOptions, digits: int | None = None) -> DataFrame:
    """``split, epoch, pair_id, n_tokens, p, rank, batch, slot, width``, from ``pair_id, n_tokens, split``.

    Every epoch has its own seeded order.  Place ``p`` goes to rank ``p % world_size``; the tail below one full
    round of ranks is dropped.  A single-process run drops the short last training batch instead.  ``width`` is
    the longest row of the batch.  Token arrays are not carried through the shuffle.  ``rows`` is read more than
    once, so it should be a written table.
    """
    digits = digits or bucket_digits(rows.count())
    epochs = F.explode(F.sequence(F.lit(0), F.lit(opts.num_epochs - 1))).alias("epoch")
    expanded = rows.select("split", epochs, "pair_id", "n_tokens")
    key = seeded_key(F.lit(opts.seed), F.col("epoch"), F.col("split"), F.col("pair_id"))
    placed = hashed_positions(expanded, key, "pair_id", ["split", "epoch"], digits, n_groups=2 * opts.num_epochs)
    world, size = F.lit(opts.world_size), F.lit(opts.batch_size)
    in_rank = F.floor(F.col("p") / world)
    batched = (
        placed.where(_is_used(opts))
        .withColumn("rank", F.pmod("p", world).cast("int"))
        .withColumn("batch", F.floor(in_rank / size))
        .withColumn("slot", F.pmod(in_rank, size).cast("int"))
    )
    # The batch number comes first, as it settles most comparisons of the sort.
    batch = Window.partitionBy("batch", "rank", "epoch", "split")
    return batched.select(
        "split", "epoch", "pair_id", "n_tokens", "p", "rank", "batch", "slot", F.max("n_tokens").over(batch).alias("width")
    )


def _is_used(opts: SftOptions) -> Column:
    def full(step: int) -> Column:
        return F.col("p") < F.floor(F.col("n") / step) * step

    if opts.single_process:
        return (F.col("split") == "test") | full(opts.batch_size)
    return full(opts.world_size)


def shard_report(sizes: DataFrame, opts: SftOptions) -> DataFrame:
    """Rows that each rank handles in an epoch, next to the rows of the split, straight from the split sizes."""
    ranks = F.explode(F.sequence(F.lit(0), F.lit(opts.world_size - 1))).alias("rank")
    handled = F.floor(F.col("rows") / opts.world_size)
    if opts.single_process:
        handled = F.when(F.col("split") == "train", F.floor(F.col("rows") / opts.batch_size) * opts.batch_size).otherwise(F.col("rows"))
    return sizes.select("split", ranks, handled.alias("handled"), "rows").where("handled > 0")


def batch_numbers(spark: SparkSession, batches: int, num_epochs: int) -> DataFrame:
    """``epoch, batch`` of every step of a run."""
    step = F.col("id")
    return spark.range(batches * num_epochs).select(F.floor(step / batches).cast("int").alias("epoch"), F.pmod(step, F.lit(batches)).alias("batch"))


def batch_counts(sizes: DataFrame, opts: SftOptions) -> DataFrame:
    """Batches per epoch and rank, straight from the split sizes."""
    rows, size = F.col("rows"), opts.batch_size
    if opts.single_process:
        count = F.when(F.col("split") == "train", F.floor(rows / size)).otherwise(F.ceil(rows / size))
    else:
        count = F.ceil(F.floor(rows / opts.world_size) / size)
    return sizes.select("split", "rows", count.alias("batches"))


def resume_from(plan: DataFrame, epoch: int | Column, epoch_step: int | Column) -> DataFrame:
    """The part of the plan that is still to do: later epochs, and later batches of the current one."""
    epoch = epoch if isinstance(epoch, Column) else F.lit(epoch)
    epoch_step = epoch_step if isinstance(epoch_step, Column) else F.lit(epoch_step)
    return plan.where((F.col("epoch") > epoch) | ((F.col("epoch") == epoch) & (F.col("batch") >= epoch_step)))
