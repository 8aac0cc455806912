"""Summaries of training logs, the step plan of a run, and its saved state."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftframe.options import PHASES, LogOptions

STATE_SCHEMA = "run_id STRING, epoch INT, global_step BIGINT, epoch_step INT, running_loss DOUBLE"
WINDOW_KEY = ["run_id", "window"]


# -- log windows ----------------------------------------------------------------------------------------------------


def log_window(opts: LogOptions) -> Column:
    """Number of the log window of a step: timers and loss start anew after every ``log_freq`` steps."""
    return F.floor((F.col("global_step") - 1) / opts.log_freq)


def window_parts(steps: DataFrame, opts: LogOptions) -> DataFrame:
    """Sums and counts per run and window that can be added up over any division of the steps.

    Failed phases are not timed.  The key includes the window, so a long run spreads over many tasks.  ``steps``
    lists the steps that are there, at most ``log_freq``.
    """
    sums = []
    for phase in PHASES:
        timed = F.col("ok") & (F.col("phase") == phase)
        sums.append(F.coalesce(F.sum(F.when(timed, F.col("elapsed_s"))), F.lit(0.0)).alias(f"{phase}_s"))
        sums.append(F.count(F.when(timed, F.col("elapsed_s"))).alias(f"{phase}_n"))
    return steps.groupBy("run_id", log_window(opts).alias("window")).agg(
        F.max("global_step").alias("last_step"), F.collect_set("global_step").alias("steps"), F.coalesce(F.sum("loss"), F.lit(0.0)).alias("loss_sum"), *sums
    )


def merge_parts(parts: DataFrame) -> DataFrame:
    added = [F.sum(name).alias(name) for name in parts.columns if name not in (*WINDOW_KEY, "last_step", "steps")]
    steps = F.array_distinct(F.flatten(F.collect_list("steps"))).alias("steps")
    return parts.groupBy(*WINDOW_KEY).agg(F.max("last_step").alias("last_step"), steps, *added)


def log_records(parts: DataFrame, opts: LogOptions) -> DataFrame:
    """One record per full window; a window is not logged as long as one of its steps is missing.

    ``ms_per_step`` adds up the phase averages and is null when a phase was not timed.  ``tokens_per_step`` is
    nominal.  ``batches_remaining`` counts from the zero-based number of the last step, hence is one higher than
    the batches that are left.
    """
    step = F.col("last_step")
    average = {p: 1000 * F.col(f"{p}_s") / F.nullif(F.col(f"{p}_n"), F.lit(0)) for p in PHASES}
    ms = sum(average.values(), F.lit(0.0))
    tokens = opts.world_size * opts.batch_size * opts.max_length
    epoch_step = F.pmod(step - 1, F.lit(opts.batches)) + 1
    return parts.where(F.size("steps") == opts.log_freq).select(
        "run_id",
        step.alias("global_step"),
        learning_rate(step, opts).alias("lr"),
        (F.col("loss_sum") / opts.log_freq).alias("running_loss"),
        F.floor((step - 1) / opts.batches).cast("int").alias("epoch"),
        (epoch_step / opts.batches).alias("epoch_progress"),
        (opts.batches - epoch_step + 1).alias("batches_remaining"),
        *[value.alias(f"ms_{phase}") for phase, value in average.items()],
        ms.alias("ms_per_step"),
        F.lit(tokens).cast("bigint").alias("tokens_per_step"),
        (1000 * (tokens / ms)).alias("tokens_per_s"),
    )


def run_windows(steps: DataFrame, opts: LogOptions) -> DataFrame:
    return log_records(window_parts(steps, opts), opts)


# -- step plan ------------------------------------------------------------------------------------------------------


def learning_rate(step: Column, opts: LogOptions) -> Column:
    """Cosine from ``lr`` to a tenth of it over all batches of all epochs, after ``step`` steps."""
    low = 0.1 * opts.lr
    return low + (opts.lr - low) * (1 + F.cos(F.pi() * step / (opts.batches * opts.num_epochs))) / 2


def step_plan(batches: DataFrame, opts: LogOptions, end_of: str = "epoch") -> DataFrame:
    """Counters, learning rate and checkpoint flag of every step, from ``epoch, batch``.

    ``end_of`` says when a run saves besides every ``checkp_freq`` steps: at the end of each epoch, of the run, or
    ``none``.
    """
    step, epoch_step = F.col("global_step"), F.col("epoch_step")
    saves = _saves(step, epoch_step, opts, end_of)
    return (
        batches.select("epoch", "batch")
        .withColumn("epoch_step", (F.col("batch") + 1).cast("int"))
        .withColumn("global_step", (F.col("epoch") * opts.batches + F.col("batch") + 1).cast("bigint"))
        .withColumn("lr", learning_rate(step, opts))
        .withColumn("logs", F.pmod(step, F.lit(opts.log_freq)) == 0)
        .withColumn("saves", saves)
    )


# -- sinks ----------------------------------------------------------------------------------------------------------


def append_records(records: DataFrame, folder: str, batch: str, by_run: bool = False) -> None:
    """Add log records to the metric table of all runs as the part ``batch``; the same part again replaces it.

    A folder per run suits few and long runs only.  Read the table without its ``batch`` column.
    """
    writer = records.write.mode("overwrite")
    (writer.partitionBy("run_id") if by_run else writer).parquet(f"{folder}/batch={batch}")


def run_record(
    spark: SparkSession,
    run_id: str,
    opts: LogOptions,
    train_rows: int,
    resumed: bool,
    single_process: bool = False,
    options: object = None,
) -> DataFrame:
    """One row: options and sizes of a run; ``options`` is any further options object, kept as JSON.

    A single process (world size 1) counts whole batches only; several processes count rows, and batches of all ranks.
    """
    if single_process and opts.world_size != 1:
        raise ValueError("a single process has world_size 1")
    size = opts.batches * opts.batch_size if single_process else train_rows
    row = (run_id, opts.lr, opts.weight_decay, opts.batch_size, opts.max_length, opts.num_epochs, size)
    return spark.createDataFrame(
        [(*row, opts.batches * opts.world_size, opts.world_size, resumed, json.dumps(options and asdict(options), default=str))],
        "run_id STRING, lr DOUBLE, weight_decay DOUBLE, batch_size INT, max_length INT, num_epochs INT,"
        " training_rows BIGINT, num_batches BIGINT, world_size INT, resumed BOOLEAN, options STRING",
    )


def _saves(step: Column, epoch_step: Column, opts: LogOptions, end_of: str) -> Column:
    if end_of not in ("epoch", "run", "none"):
        raise ValueError(f"end_of must be 'epoch', 'run' or 'none', not {end_of!r}")
    saves = F.pmod(step, F.lit(opts.checkp_freq)) == 0
    if end_of == "epoch":
        return saves | (epoch_step == opts.batches)
    return saves | (step == opts.batches * opts.num_epochs) if end_of == "run" else saves


def saved_states(steps: DataFrame, opts: LogOptions, end_of: str = "epoch") -> DataFrame:
    """The states (``STATE_SCHEMA``) that a run saves: every ``checkp_freq`` steps, and at the end of each epoch or
    of the run.

    The running loss adds up the steps since the last log record, which comes before the save.  A step may have
    several rows, one per phase; their losses are added.
    """
    steps = steps.groupBy("run_id", "global_step").agg(F.sum("loss").alias("loss"))
    step = F.col("global_step")
    since = Window.partitionBy("run_id", log_window(opts)).orderBy("global_step")
    loss = F.when(F.pmod(step, F.lit(opts.log_freq)) == 0, 0.0).otherwise(F.sum("loss").over(since))
    epoch_step = F.pmod(step - 1, F.lit(opts.batches)) + 1
    return (
        steps.select(
            F.col("run_id").cast("string").alias("run_id"),
            F.floor((step - 1) / opts.batches).cast("int").alias("epoch"),
            "global_step",
            epoch_step.cast("int").alias("epoch_step"),
            loss.alias("running_loss"),
        )
        .where(_saves(step, F.col("epoch_step"), opts, end_of))
    )


def append_state(states: DataFrame, folder: str, batch: str) -> None:
    """Add saved states (``STATE_SCHEMA``) of runs as the part ``batch``; the same part again replaces it."""
    states.write.mode("overwrite").parquet(f"{folder}/batch={batch}")


def latest_state(states: DataFrame) -> DataFrame:
    """The state to resume from: the furthest step of every run."""
    state = F.struct("epoch", "global_step", "epoch_step", "running_loss")
    return states.groupBy("run_id").agg(F.max_by(state, "global_step").alias("_state")).select("run_id", "_state.*")
