from dataclasses import replace
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.options import SftOptions
from sftframe.plans import permuted as M

OPTS = SftOptions(test_split=Decimal("0.2"), world_size=3, batch_size=4, num_epochs=3, seed=7)


def plain(i, n, keys):
    """The same walk in whole numbers of Python."""
    a, b = M.halves(n)
    while True:
        left, right = divmod(i, b)
        for on_left, x, y, z in keys:
            if on_left:
                left = (left + ((right + x) * y + z) % M.PRIME) % a
            else:
                right = (right + ((left + x) * y + z) % M.PRIME) % b
        i = left * b + right
        if i < n:
            return i


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 10, 97, 100, 101, 1000, 2503])
def test_bijection_and_inverse(spark, n):
    a, b = M.halves(n)
    assert n <= a * b < n + a
    keys = M.key_table(spark, {"train": n}, replace(OPTS, num_epochs=1))
    placed = M.numbers(M.places(spark.range(n).withColumnRenamed("id", "i").crossJoin(keys)), out="back").collect()
    assert sorted(r["p"] for r in placed) == list(range(n)) and all(r["back"] == r["i"] for r in placed)
    own = M.round_keys(OPTS.seed, 0, "train")
    assert all(r["p"] == plain(r["i"], n, own) for r in placed)


def test_order_looks_shuffled_and_differs_by_epoch(spark):
    keys = M.key_table(spark, {"train": 4000}, OPTS)
    placed = M.places(spark.range(4000).withColumnRenamed("id", "i").crossJoin(keys))
    assert abs(placed.where("epoch = 0").agg(F.corr("i", "p")).first()[0]) < 0.1
    both = placed.where("epoch = 0").select("i", F.col("p").alias("q")).join(placed.where("epoch = 1"), "i")
    assert abs(both.agg(F.corr("q", "p")).first()[0]) < 0.1
    steps = placed.where("epoch = 0").orderBy("i").select("p").collect()
    assert len({(y["p"] - x["p"]) % 4000 for x, y in zip(steps, steps[1:])}) > 1000


def test_epochs_need_no_shuffle_and_ranks_read_what_they_own(spark, tmp_path):
    made = spark.range(103).selectExpr("id as pair_id", "10 as n_tokens", "if(id % 5 = 0, 'test', 'train') as split").repartition(4)
    M.numbered(made).write.parquet(str(tmp_path / "numbered"))
    table = spark.read.parquet(str(tmp_path / "numbered"))
    order = M.epoch_order(table, OPTS)
    plan = order._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    found = order.where("split = 'train'").collect()
    assert len(found) == 3 * (82 // 3 * 3)
    mine = M.row_numbers(spark, M.split_counts(table), OPTS, "train", 2, 1, first_batch=3).join(table.where("split = 'train'"), "i")
    wanted = sorted((r["batch"], r["slot"], r["pair_id"]) for r in found if r["epoch"] == 2 and r["rank"] == 1 and r["batch"] >= 3)
    assert sorted(rows(mine.select("batch", "slot", "pair_id"))) == wanted and wanted


def test_single_process_and_no_rows(spark):
    made = spark.range(23).selectExpr("id as pair_id", "10 as n_tokens", "if(id < 3, 'test', 'train') as split")
    opts = replace(OPTS, single_process=True, world_size=1)
    found = M.epoch_order(M.numbered(made), opts).groupBy("split", "epoch").count().collect()
    assert {(r["split"], r["count"]) for r in found} == {("test", 3), ("train", 20)}
    assert M.epoch_order(M.numbered(made.where("false")), opts).collect() == []
    assert M.row_numbers(spark, {}, opts, "train", 0, 0).collect() == []
