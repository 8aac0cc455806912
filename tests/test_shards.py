from pathlib import Path

import pytest
from conftest import rows

from sftframe.plans import epochs
from sftframe.sources import shards as S

SCHEMA = "epoch INT, rank INT, batch BIGINT, slot INT, pair_id BIGINT, input_ids ARRAY<INT>"


@pytest.fixture(scope="module")
def made(spark):
    every = [(e, r, b, s, 1000 * e + 100 * r + 10 * b + s, [e, r, b, s] * (s + 1)) for e in range(3) for r in range(2) for b in range(5) for s in range(4) if (b, s) != (4, 3)]
    return spark.createDataFrame(every, SCHEMA).repartition(5)


@pytest.mark.parametrize("per_file", [512, 2, 1])
def test_resumed_reads_are_the_rest_of_the_plan(spark, made, tmp_path, per_file):
    folder = str(tmp_path / "shards")
    S.write_shards(made, folder, per_file)
    index = S.shard_index(spark, folder)
    assert index.count() == 30 and index.select("file").distinct().count() == 6 * -(-5 // per_file)
    for epoch, step in ((0, 0), (1, 2), (2, 4), (3, 0)):
        wanted = sorted(rows(epochs.resume_from(made, epoch, step)), key=str)
        assert sorted(rows(S.read_shards(spark, folder, made.schema, epoch, step)), key=str) == wanted


def test_a_rank_reads_its_own_batches_in_order_and_no_more_bytes(spark, made, tmp_path):
    folder = str(tmp_path / "shards")
    S.write_shards(made, folder, 2)
    # What a lost task has left behind is not in the index.
    (Path(folder) / "data" / "epoch0-rank1-0-lost.arrows").write_bytes(b"half a file")
    reader = S.RankReader(folder, 1)
    found = [(e, b, t.column("pair_id").to_pylist()) for e, b, t in reader.batches(1, 3)]
    assert [f[:2] for f in found] == [(1, 3), (1, 4), *((2, b) for b in range(5))]
    assert found[0][2] == [1130, 1131, 1132, 1133] and found[1][2] == [1140, 1141, 1142]
    lengths = {(r["epoch"], r["batch"]): r["length"] for r in S.shard_index(spark, folder).where("rank = 1").collect()}
    assert reader.bytes_read == sum(n for place, n in lengths.items() if place >= (1, 3))
    first = S.RankReader(folder, 1)
    next(first.batches(1, 3))
    assert first.bytes_read == lengths[(1, 3)]


def test_no_rows_and_missing_columns(spark, made, tmp_path):
    folder = str(tmp_path / "none")
    S.write_shards(made.where("false"), folder)
    assert S.read_shards(spark, folder, made.schema).collect() == [] and list(S.RankReader(folder, 0).batches()) == []
    with pytest.raises(ValueError):
        S.write_shards(made.drop("slot"), str(tmp_path / "x"))
