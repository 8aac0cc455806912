import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.operators import telemetry as H
from sftframe.options import PHASES, LogOptions

STEPS = "run_id BIGINT, global_step BIGINT, phase STRING, elapsed_s DOUBLE, ok BOOLEAN, loss DOUBLE"


def steps(spark, losses, seconds=1.0):
    """Four phases per step; the loss stands in the row of one of them."""
    made = [
        (1, k, phase, seconds, True, loss if phase == "forward" else None)
        for k, loss in enumerate(losses, start=1)
        for phase in PHASES
    ]
    return spark.createDataFrame(made, STEPS)


def test_partial_window_is_not_logged(spark):
    opts = LogOptions(log_freq=2, batches=10, batch_size=2, max_length=8, world_size=3)
    made = H.run_windows(steps(spark, [1.0, 3.0, 5.0]), opts).collect()
    assert len(made) == 1
    row = made[0]
    assert row["running_loss"] == 2.0 and row["global_step"] == 2 and row["epoch_progress"] == 0.2
    assert row["ms_forward"] == 1000.0 and row["ms_per_step"] == 4000.0
    assert row["tokens_per_step"] == 48 and row["tokens_per_s"] == 12.0
    assert row["batches_remaining"] == 9


def test_windows_span_the_end_of_an_epoch(spark):
    opts = LogOptions(log_freq=4, batches=3)
    row = H.run_windows(steps(spark, [1.0, 2.0, 3.0, 4.0]), opts).first()
    assert row["running_loss"] == 2.5 and row["epoch"] == 1 and row["epoch_progress"] == pytest.approx(1 / 3)


def test_failed_phase_is_not_timed(spark):
    df = spark.createDataFrame(
        [(1, 1, "forward", 1.0, True, 0.0), (1, 2, "forward", 3.0, True, 0.0), (1, 2, "forward", 9.0, False, 0.0)], STEPS
    )
    row = H.run_windows(df, LogOptions(log_freq=2)).first()
    assert row["ms_forward"] == 2000.0
    assert row["ms_backward"] is None and row["ms_per_step"] is None and row["tokens_per_s"] is None


def test_merged_parts_are_the_whole(spark):
    opts = LogOptions(log_freq=2, batches=4)
    df = steps(spark, [1.0, 2.0, 3.0, 4.0])
    parts = H.window_parts(df.where("global_step % 2 = 0"), opts).unionByName(
        H.window_parts(df.where("global_step % 2 = 1"), opts)
    )
    assert sorted(rows(H.log_records(H.merge_parts(parts), opts))) == sorted(rows(H.run_windows(df, opts)))


@pytest.mark.parametrize("step, rate", [(0, 1e-5), (50, 5.5e-6), (100, 1e-6)])
def test_cosine(spark, step, rate):
    opts = LogOptions(lr=1e-5, batches=10, num_epochs=10)
    assert spark.range(1).select(H.learning_rate(F.lit(step), opts)).first()[0] == pytest.approx(rate)


def test_step_plan(spark):
    opts = LogOptions(log_freq=2, checkp_freq=4, batches=3, num_epochs=2)
    batches = spark.createDataFrame([(e, b) for e in range(2) for b in range(3)], "epoch INT, batch BIGINT")

    def plan(end_of):
        return rows(H.step_plan(batches, opts, end_of).orderBy("global_step").select("global_step", "epoch_step", "logs", "saves"))

    assert [r[:3] for r in plan("epoch")] == [
        (1, 1, False), (2, 2, True), (3, 3, False), (4, 1, True), (5, 2, False), (6, 3, True),
    ]
    assert [r[0] for r in plan("epoch") if r[3]] == [3, 4, 6]
    assert [r[0] for r in plan("run") if r[3]] == [4, 6]
    assert [r[0] for r in plan("none") if r[3]] == [4]
    with pytest.raises(ValueError):
        H.step_plan(batches, opts, "day")


def test_saved_states_and_resume(spark, tmp_path):
    opts = LogOptions(log_freq=4, checkp_freq=3, batches=5)
    losses = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    states = H.saved_states(steps(spark, losses), opts, "none")
    for _ in range(2):
        H.append_state(states, str(tmp_path / "states"), "first")
    kept = spark.read.schema(f"{H.STATE_SCHEMA}, batch STRING").parquet(str(tmp_path / "states")).drop("batch")
    assert sorted(rows(kept)) == [("1", 0, 3, 3, 6.0), ("1", 1, 6, 1, 11.0)]
    at_ends = H.saved_states(steps(spark, losses), opts)
    assert sorted(r["global_step"] for r in at_ends.collect()) == [3, 5, 6]
    assert rows(H.latest_state(kept)) == [("1", 1, 6, 1, 11.0)]


def test_record_sinks(spark, tmp_path):
    opts = LogOptions(log_freq=2, batches=10)
    for batch in ("a", "a", "b"):
        H.append_records(H.run_windows(steps(spark, [1.0, 3.0]), opts), str(tmp_path / "metrics"), batch)
    assert spark.read.parquet(str(tmp_path / "metrics")).count() == 2


def test_run_record(spark):
    opts = LogOptions(batches=7, batch_size=4, world_size=3)
    row = H.run_record(spark, "a", opts, 85, False, options=opts).first()
    assert row[6:10] == (85, 21, 3, False) and json.loads(row["options"])["world_size"] == 3
    with pytest.raises(ValueError):
        H.run_record(spark, "a", opts, 85, True, single_process=True)
    alone = LogOptions(batches=7, batch_size=4)
    assert H.run_record(spark, "a", alone, 85, True, single_process=True).first()[6:10] == (28, 7, 1, True)
