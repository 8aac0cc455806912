import hashlib
import math
from decimal import Decimal

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.options import SftOptions, resolve_max_length
from sftframe.plans import epochs, index
from sftframe.plans.index import among_first, bucket_digits, hashed_positions, ranged_positions, seeded_key


def split_table(spark, n, split="train"):
    return spark.range(n).select(F.col("id").alias("pair_id"), (F.col("id") % 7 + 1).cast("int").alias("n_tokens"), F.lit(split).alias("split"))


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_hashed_positions_are_the_global_order(spark, digits):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), "id")
    placed = hashed_positions(df, seeded_key(F.lit(1), F.col("id")), "id", ["g"], digits)
    key = {i: hashlib.md5(f"1|{i}".encode()).hexdigest()[:16] for i in range(500)}
    expected = set()
    for g in range(3):
        members = sorted((i for i in range(500) if i % 3 == g), key=lambda i: (key[i], i))
        expected |= {(g, i, p, len(members)) for p, i in enumerate(members)}
    assert set(rows(placed.select("g", "id", "p", "n"))) == expected


def test_positions_do_not_need_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(index, "BROADCAST_ROWS", 0)
    df = spark.range(200).select((F.col("id") % 3).alias("g"), "id")
    key = seeded_key(F.lit(1), F.col("id"))
    joined = hashed_positions(df, key, "id", ["g"], 2)
    monkeypatch.undo()
    assert sorted(rows(joined)) == sorted(rows(hashed_positions(df, key, "id", ["g"], 2)))


def test_ranged_positions_with_a_hot_group_and_equal_times(spark):
    frame = pd.DataFrame({"id": range(3000)})
    frame["run"] = [1 if i % 2 else i % 40 for i in frame["id"]]
    frame["ts"] = (frame["id"] * 37) % 11
    placed = ranged_positions(spark.createDataFrame(frame).repartition(5), "run", ["ts", "id"], "p").toPandas()
    frame = frame.sort_values(["run", "ts", "id"])
    frame["p"] = frame.groupby("run").cumcount()
    merged = placed.merge(frame, on=["id", "run", "ts"])
    assert len(placed) == 3000 and (merged["p_x"] == merged["p_y"]).all()


@pytest.mark.parametrize("share", ["0.1", "0.333", "0.999"])
def test_first_rows_are_those_of_the_sorted_table(spark, share, monkeypatch):
    monkeypatch.setattr(index, "_SELECT_ROWS", 1)
    df = spark.range(3000)
    key = seeded_key(F.lit(9), F.col("id"))
    order = sorted(range(3000), key=lambda i: (hashlib.md5(f"9|{i}".encode()).hexdigest()[:16], i))
    wanted = order[: math.ceil(Decimal(share) * 3000)]
    assert {r[0] for r in rows(df.where(among_first(df, key, "id", Decimal(share))))} == set(wanted)


def test_split_shuffles_no_rows(spark):
    made = epochs.assign_split(split_table(spark, 50).drop("split"), SftOptions())
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()


def test_digits_grow_with_the_rows():
    assert bucket_digits(10) == 1
    assert bucket_digits(10**6) == 3
    assert bucket_digits(10**12) == 4


@pytest.mark.parametrize("fraction, test_rows", [("0", 0), ("0.2", 47), ("0.001", 1), ("1", 233)])
def test_split_rounds_the_test_side_up(spark, fraction, test_rows):
    df = spark.range(233).select(F.col("id").alias("pair_id"))
    made = dict(rows(epochs.split_sizes(epochs.assign_split(df, SftOptions(test_split=Decimal(fraction))))))
    assert made.get("test", 0) == test_rows and made.get("train", 0) == 233 - test_rows


@pytest.mark.parametrize("single, fraction", [(False, "1.01"), (False, "-0.1"), (True, "0")])
def test_split_bounds(single, fraction):
    with pytest.raises(ValueError, match="test_split"):
        SftOptions(test_split=Decimal(fraction), single_process=single)


def test_ten_rows_on_four_ranks(spark):
    opts = SftOptions(world_size=4, batch_size=3, num_epochs=1)
    plan = epochs.epoch_plan(split_table(spark, 10), opts).toPandas()
    assert plan.groupby("rank").size().tolist() == [2, 2, 2, 2]
    assert plan["batch"].unique().tolist() == [0]


def test_ten_rows_in_one_process(spark):
    opts = SftOptions(single_process=True, batch_size=3, num_epochs=1)
    train = epochs.epoch_plan(split_table(spark, 10), opts).toPandas()
    test = epochs.epoch_plan(split_table(spark, 10, "test"), opts).toPandas()
    assert train.groupby("batch").size().tolist() == [3, 3, 3]
    assert test.groupby("batch").size().tolist() == [3, 3, 3, 1]
    sizes = spark.createDataFrame([("train", 10), ("test", 10)], "split STRING, rows BIGINT")
    assert dict(rows(epochs.batch_counts(sizes, opts).select("split", "batches"))) == {"train": 3, "test": 4}


def test_plan_properties(spark):
    opts = SftOptions(world_size=3, batch_size=4, num_epochs=3)
    plan = epochs.epoch_plan(split_table(spark, 101), opts).toPandas()
    for _, epoch in plan.groupby("epoch"):
        assert len(epoch) == 99 and epoch["pair_id"].is_unique
        assert sorted(epoch["p"]) == list(range(99))
    batches = plan.groupby(["epoch", "rank", "batch"])
    assert (batches["width"].nunique() == 1).all()
    assert (batches["n_tokens"].max() == batches["width"].max()).all()
    first, second = (plan[plan.epoch == e].sort_values("p")["pair_id"].tolist() for e in (0, 1))
    assert first != second


def test_plan_does_not_depend_on_the_partitions(spark):
    opts = SftOptions(world_size=2, batch_size=4, num_epochs=2)
    table = split_table(spark, 60)
    one = sorted(rows(epochs.epoch_plan(table.coalesce(1), opts)))
    many = sorted(rows(epochs.epoch_plan(table.repartition(7), opts, digits=2)))
    assert one == many


def test_resume(spark):
    plan = spark.createDataFrame([(e, b) for e in range(3) for b in range(4)], "epoch INT, batch BIGINT")
    assert sorted(rows(epochs.resume_from(plan, 1, 2))) == [(1, 2), (1, 3), (2, 0), (2, 1), (2, 2), (2, 3)]


def test_context_limit():
    assert resolve_max_length(1024, 512, 2048) == 512
    assert resolve_max_length(None, 4096, 2048, single_process=True) == 2048
    assert resolve_max_length(4096, 512, 2048, single_process=True) == 2048
    with pytest.raises(ValueError):
        resolve_max_length(None, 1, 1)
