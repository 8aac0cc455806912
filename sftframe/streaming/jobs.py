"""The batch jobs over arriving files."""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sftframe.operators.lookup import BROADCAST_ROWS
from sftframe.operators.prepare import prepare
from sftframe.operators.telemetry import log_records, log_window, merge_parts, window_parts
from sftframe.options import PHASES, LogOptions, SftOptions
from sftframe.session import ship_package


def read_stream(
    spark: SparkSession, folder: str, schema, files: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files of a folder, or one file, as a stream; ``files`` is a glob on their names."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A plain path of a stream must be a folder; a pattern, here one that fits the last name alone, may be a file, too.
    above, _, last = folder.rstrip("/").rpartition("/")
    return reader.parquet(f"{above}/{{{last}}}" if above else folder)


def prepare_stream(
    pairs: DataFrame, vocab: DataFrame, opts: SftOptions, out: str, checkpoint: str, bound: int = BROADCAST_ROWS
) -> StreamingQuery:
    """Format, encode and filter arriving pairs, a micro-batch at a time, whatever the size of the vocabulary.

    There is no state.  A micro-batch that runs again overwrites its own folder ``micro_batch=<number>``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        prepare(batch, vocab, opts, bound).write.mode("overwrite").parquet(f"{out}/micro_batch={batch_id}")

    return (
        pairs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def window_stream(steps: DataFrame, opts: LogOptions, parts: str, checkpoint: str) -> StreamingQuery:
    """Write the window sums of every micro-batch; ``read_windows`` adds them up.

    Sums of a window are kept in the output and not in stream state, which would grow with every run and could not
    be dropped without losing late steps.  A micro-batch that runs again overwrites its own folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        window_parts(batch, opts).write.mode("overwrite").parquet(f"{parts}/micro_batch={batch_id}")

    return (
        steps.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_windows(spark: SparkSession, opts: LogOptions, parts: str) -> DataFrame:
    """Log records of the windows of which all steps are there by now."""
    return log_records(merge_parts(spark.read.parquet(parts).drop("micro_batch")), opts)


# -- windows emitted once -------------------------------------------------------------------------------------------

_PART = ", ".join(["run_id {}", "window LONG", "last_step LONG", "steps ARRAY<LONG>", "loss_sum DOUBLE", *(f"{p}_s DOUBLE, {p}_n LONG" for p in PHASES)])


def _window_part(key: tuple, rows: list) -> dict:
    """The sums of a full window from its ``(step, phase, seconds, ok, loss)`` rows, the same in any order of arrival."""
    part = {"run_id": key[0], "window": key[1], "last_step": max(r[0] for r in rows), "steps": sorted({r[0] for r in rows})}
    part["loss_sum"] = math.fsum(r[4] for r in rows if r[4] is not None)
    for phase in PHASES:
        timed = [r[2] for r in rows if r[1] == phase and r[3] and r[2] is not None]
        part |= {f"{phase}_s": math.fsum(timed), f"{phase}_n": len(timed)}
    return part


def _number(value) -> float | None:
    """A number of a JSON row, where what is not finite is a word; NaN is null."""
    number = None if value is None else float(value)
    return None if number != number else number


def live_windows(steps: DataFrame, opts: LogOptions, rows_per_step: int = 1, keep_ms: int = 24 * 3_600_000) -> DataFrame:
    """Log records of a stream of steps, each the moment the last row of its window has come.

    State is kept by run and window: the rows so far, at most ``log_freq * rows_per_step``, and once the record is out
    only a mark.  A step and phase that has come before, or comes after the record, is refused, so rows that are
    delivered twice change nothing.  What has heard nothing for ``keep_ms`` is dropped: the mark of a window that is
    out, or a window that will not be complete any more.
    """
    ship_package(steps.sparkSession)
    whole = opts.log_freq * rows_per_step

    def arrived(key: tuple, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        done, text = state.get if state.exists else (False, "[]")
        rows = {(r[0], r[1]): r for r in json.loads(text)}
        for frame in frames:
            for row in frame["_row"]:
                step, phase, seconds, ok, loss = json.loads(row).values()
                rows.setdefault((step, phase), [step, phase, _number(seconds), bool(ok), _number(loss)])
        full = not done and len(rows) == whole
        if full:
            yield pd.DataFrame([_window_part(key, sorted(rows.values(), key=lambda r: (r[0], str(r[1]))))])
        done = done or full
        state.update((done, "[]" if done else json.dumps(list(rows.values()))))
        state.setTimeoutDuration(keep_ms)

    kind = steps.schema["run_id"].dataType.simpleString()
    # A group costs its worker some time for each column, so what is no key goes there as one.
    row = F.struct(F.col("global_step").cast("bigint"), "phase", F.col("elapsed_s").cast("double"), "ok", F.col("loss").cast("double"))
    packed = steps.select("run_id", log_window(opts).alias("window"), F.to_json(row, {"ignoreNullFields": "false"}).alias("_row"))
    keyed = packed.groupBy("run_id", "window")
    parts = keyed.applyInPandasWithState(arrived, _PART.format(kind), "done BOOLEAN, rows STRING", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return log_records(parts, opts)


def live_window_stream(steps: DataFrame, opts: LogOptions, out: str, checkpoint: str, rows_per_step: int = 1) -> StreamingQuery:
    """Append the records of ``live_windows`` to ``out``; the sink's own log makes a repeated micro-batch harmless."""
    conf, name = steps.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    # With timers on the clock a run over what is there would go on with empty micro-batches for ever.
    conf.set(name, "false")
    try:
        records = live_windows(steps, opts, rows_per_step)
        return records.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet")
    finally:
        conf.set(name, before)
