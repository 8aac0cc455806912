import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.operators import telemetry as H
from sftframe.operators import prepare as P
from sftframe.operators import vocab as V
from sftframe.operators.lookup import BROADCAST_ROWS
from sftframe.options import LogOptions, SftOptions
from sftframe.streaming import jobs

STEPS = "run_id BIGINT, global_step BIGINT, phase STRING, elapsed_s DOUBLE, ok BOOLEAN, loss DOUBLE"
OPTS = LogOptions(log_freq=3, batches=4)


@pytest.mark.parametrize("bound", [BROADCAST_ROWS, 0])
def test_prepared_stream_is_the_prepared_batch(spark, tmp_path, bound):
    opts = SftOptions(max_length=30)
    pairs = spark.range(20).selectExpr("id as pair_id", "repeat('word ', cast(id as int)) as instruction", "'yes' as response")
    vocab = V.build_vocab(P.tokenised(pairs, opts), "tokens", 50).persist()
    pairs.repartition(4).write.parquet(str(tmp_path / "in"))
    arriving = jobs.read_stream(spark, str(tmp_path / "in"), pairs.schema, files_per_batch=1)
    run = jobs.prepare_stream(arriving, vocab, opts, str(tmp_path / "out"), str(tmp_path / "checkpoint"), bound)
    run.awaitTermination()
    batch = P.prepare(pairs, vocab, opts)
    assert sorted(rows(spark.read.parquet(str(tmp_path / "out")).drop("micro_batch"))) == sorted(rows(batch))
    assert 0 < batch.count() < 20


def drain(spark, tmp_path):
    arriving = jobs.read_stream(spark, str(tmp_path / "in"), STEPS, files="*.parquet", files_per_batch=1)
    jobs.window_stream(arriving, OPTS, str(tmp_path / "parts"), str(tmp_path / "checkpoint")).awaitTermination()
    return sorted(rows(jobs.read_windows(spark, OPTS, str(tmp_path / "parts"))))


def test_windows_over_late_and_split_steps(spark, tmp_path):
    made = [
        (run, step, phase, 0.5 * step, phase != "backward" or step % 2 == 0, float(step))
        for run in (1, 2)
        for step in range(1, 11)
        for phase in ("forward", "backward")
    ]
    steps = spark.createDataFrame(made, STEPS)
    late = (F.col("global_step") == 2) & (F.col("run_id") == 1)
    steps.where(~late).repartition(3).write.parquet(str(tmp_path / "in"))
    first = drain(spark, tmp_path)
    assert len(first) == 5 and (1, 3) not in [r[:2] for r in first]
    steps.where(late).write.mode("append").parquet(str(tmp_path / "in"))
    assert drain(spark, tmp_path) == sorted(rows(H.run_windows(steps, OPTS)))


def live(spark, tmp_path, rows_per_step=2):
    arriving = jobs.read_stream(spark, str(tmp_path / "in"), STEPS, files="*.parquet", files_per_batch=1)
    run = jobs.live_window_stream(arriving, OPTS, str(tmp_path / "records"), str(tmp_path / "checkpoint"), rows_per_step)
    run.awaitTermination()
    return sorted(rows(spark.read.parquet(str(tmp_path / "records")))), run


def test_live_windows_come_once_and_whole(spark, tmp_path):
    made = [
        (run, step, phase, 0.1 * step, phase != "backward" or step % 2 == 0, float(step) if phase == "forward" else None)
        for run in (1, 2)
        for step in range(1, 11)
        for phase in ("forward", "backward")
    ]
    steps = spark.createDataFrame(made, STEPS)
    late = (F.col("global_step") == 2) & (F.col("run_id") == 1) & (F.col("phase") == "backward")
    # Files in no order of steps, and one of them twice.
    steps.where(~late).repartition(3, "phase", "global_step").write.parquet(str(tmp_path / "in"))
    steps.where("global_step % 4 = 0").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    first, _ = live(spark, tmp_path)
    assert len(first) == 5 and (1, 3) not in [r[:2] for r in first]
    # A restart goes on with the state; rows of windows that are out change nothing.
    steps.where(late | (F.col("global_step") == 5)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    second, run = live(spark, tmp_path)
    wanted = sorted(rows(H.run_windows(steps, OPTS)))
    assert [r[:2] for r in second] == [r[:2] for r in wanted] and len(second) == 6
    assert all(a == pytest.approx(b) for a, b in zip(second, wanted))
    kept = run.lastProgress["stateOperators"][0]
    assert kept["numRowsTotal"] == 8


def test_a_window_part_is_the_same_in_any_order():
    made = [[k, "forward", 0.1 * k, True, 1.0 / (k + 1)] for k in range(50)]
    parts = [jobs._window_part((1, 0), r) for r in (made, made[::-1], made[25:] + made[:25])]
    assert parts[0] == parts[1] == parts[2]


@pytest.mark.parametrize("parts", [0, 3])
def test_a_table_arrives_from_one_file_or_a_folder(spark, tmp_path, parts):
    docs = spark.createDataFrame([(k, "first line\nand the rest " * k) for k in range(12)], "doc_id BIGINT, text STRING")
    spark.createDataFrame([("a",)], "other STRING").write.parquet(str(tmp_path / "in/labels.parquet"))
    folder = tmp_path / "in/documents.parquet"
    if parts:
        docs.repartition(parts).write.parquet(str(folder))
    else:
        docs.toPandas().to_parquet(folder)
    seen = jobs.read_stream(spark, str(folder), docs.schema)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    seen.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    assert sorted(rows(spark.read.parquet(out))) == sorted(rows(docs))


def test_live_windows_hand_over_one_column_and_keep_odd_numbers(spark, tmp_path):
    made = [(1, k, "forward", x, True, y) for k, x, y in ((1, 0.1 + 0.2, 0.1), (2, None, float("inf")), (3, 1e-17, 0.2))]
    steps = spark.createDataFrame(made, STEPS)
    steps.coalesce(1).write.parquet(str(tmp_path / "in"))
    arriving = jobs.read_stream(spark, str(tmp_path / "in"), STEPS)
    plan = jobs.live_windows(arriving, OPTS)._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("FlatMapGroupsInPandasWithState") :].splitlines()
    handed = next(line for line in below[1:] if "_row#" in line)
    assert "Project [run_id#" in handed and handed.count(" AS ") == 2
    records, _ = live(spark, tmp_path, rows_per_step=1)
    assert str(records) == str(sorted(rows(H.run_windows(steps, OPTS)))) and len(records) == 1
