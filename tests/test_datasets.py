import threading

import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql.datasource import EqualTo, GreaterThan

from sftframe.sources import datasets as N

SCHEMA = "id BIGINT, text STRING, score DOUBLE"


def made(spark, low, high, parts=2):
    return spark.range(low, high, 1, parts).selectExpr("id", "concat('t', id) as text", "id / 4 as score")


def test_splits_columns_and_filters(spark, tmp_path):
    root = str(tmp_path)
    assert N.write_split(made(spark, 0, 100), root, "me/set") == 1
    assert N.write_split(made(spark, 100, 110), root, "me/set", "test") == 1
    whole = N.load_split(spark, root, "me/set")
    assert whole.schema.simpleString() == "struct<id:bigint,text:string,score:double>"
    assert sorted(rows(whole)) == [(i, f"t{i}", i / 4) for i in range(100)]
    narrow = N.load_split(spark, root, "me/set", "test", "text STRING, id BIGINT")
    assert sorted(rows(narrow.where("id >= 105 and text <> 't107'"))) == [(f"t{i}", i) for i in (105, 106, 108, 109)]
    assert rows(whole.where("score = 2.5").select("id")) == [(10,)]
    assert sorted(rows(whole.where("id in (3, 5, 700)").select("id"))) == [(3,), (5,)]


def test_filters_are_pushed_and_rule_row_groups_out(spark, tmp_path):
    N.write_split(made(spark, 0, 1000, 1).sortWithinPartitions("id"), str(tmp_path), "s")
    reader = N._Reader(str(tmp_path), N.split_files(str(tmp_path), "s"), made(spark, 0, 1).schema, 1 << 20)
    left = list(reader.pushFilters([GreaterThan(("id",), 990), EqualTo(("score",), 248.0)]))
    assert left == [EqualTo(("score",), 248.0)]
    batches = [b for part in reader.partitions() for b in reader.read(part)]
    assert sum(len(b) for b in batches) == 9


def test_files_of_others_nulls_and_missing_columns(spark, tmp_path):
    folder = f"{tmp_path}/hub/set/train"
    spark.createDataFrame([(1, None, None), (None, "b", 2.0)], SCHEMA).write.parquet(f"{folder}/a")
    spark.createDataFrame([(3, "c")], "id BIGINT, text STRING").write.parquet(f"{folder}/b")
    read = N.load_split(spark, str(tmp_path), "hub/set", schema=SCHEMA)
    assert sorted(rows(read), key=str) == [(1, None, None), (3, "c", None), (None, "b", 2.0)]
    assert rows(read.where("text = 'c'")) == [(3, "c", None)]
    assert rows(read.where("id is not null and text is null").select("id")) == [(1,)]


def test_unknown_names(spark, tmp_path):
    N.write_split(made(spark, 0, 3), str(tmp_path), "s")
    with pytest.raises(Exception, match="no files of s/dev; there are"):
        N.load_split(spark, str(tmp_path), "s", "dev").collect()
    with pytest.raises(Exception, match="no version 7"):
        N.load_split(spark, str(tmp_path), "s", version=7).collect()
    with pytest.raises(ValueError, match="no name"):
        N.write_split(made(spark, 0, 3), str(tmp_path), "../s")


def test_empty_split(spark, tmp_path):
    N.write_split(made(spark, 0, 0), str(tmp_path), "s")
    assert rows(N.load_split(spark, str(tmp_path), "s", schema=SCHEMA)) == []


@pytest.mark.parametrize("most", [1, 700, 5000, 1 << 30])
def test_every_row_group_is_read_once(spark, tmp_path, most):
    N.write_split(made(spark, 0, 3000, 3).sortWithinPartitions("id"), str(tmp_path), "s")
    path, _ = N.split_files(str(tmp_path), "s")[0]
    pq.write_table(pq.read_table(path), path, row_group_size=100)
    (tmp_path / f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}.crc").unlink(missing_ok=True)
    reader = N._Reader(str(tmp_path), [(p, (tmp_path / p).stat().st_size) for p, _ in N.split_files(str(tmp_path), "s")], made(spark, 0, 1).schema, max(most, 64))
    ids = [i for part in reader.partitions() for batch in reader.read(part) for i in batch.column(0).to_pylist()]
    assert sorted(ids) == list(range(3000))


def test_readers_are_pinned_and_replacing_names_its_version(spark, tmp_path):
    root = str(tmp_path)
    N.write_split(made(spark, 0, 5), root, "s")
    pinned = N.load_split(spark, root, "s", version=1)
    assert N.write_split(made(spark, 5, 7), root, "s") == 2
    assert pinned.count() == 5 and N.load_split(spark, root, "s").count() == 7
    assert N.write_split(made(spark, 90, 91), root, "s", expected=2, replace=True) == 3
    assert rows(N.load_split(spark, root, "s").select("id")) == [(90,)]
    assert N.load_split(spark, root, "s", version=2).count() == 7 and pinned.count() == 5
    with pytest.raises(N.Conflict):
        N.write_split(made(spark, 0, 1), root, "s", expected=2)
    with pytest.raises(ValueError, match="version"):
        N.write_split(made(spark, 0, 1), root, "s", replace=True)
    assert N.version(spark, root, "s") == 3


def test_of_writers_at_once_one_wins_and_appends_all_stay(spark, tmp_path):
    root, wins, lost = str(tmp_path), [], []

    def prepare(i):
        try:
            wins.append((N.write_split(made(spark, 10 * i, 10 * i + 3, 1), root, "s", expected=0), i))
        except N.Conflict:
            lost.append(i)

    def both(run, n):
        threads = [threading.Thread(target=run, args=(i,)) for i in range(n)]
        [t.start() for t in threads]
        [t.join() for t in threads]

    both(prepare, 4)
    assert len(wins) == 1 and len(lost) == 3 and wins[0][0] == 1
    assert sorted(r[0] for r in rows(N.load_split(spark, root, "s"))) == [10 * wins[0][1] + k for k in range(3)]
    both(lambda i: N.write_split(made(spark, 1000 + i, 1001 + i, 1), root, "s"), 4)
    assert N.load_split(spark, root, "s").count() == 7 and N.version(spark, root, "s") == 5


def test_stream_takes_each_commit_once(spark, tmp_path):
    root = str(tmp_path)
    N.register(spark)

    def run():
        arriving = spark.readStream.format(N.FORMAT).options(path=root, dataset="s").schema(SCHEMA).load()
        sink = arriving.writeStream.option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
        sink.format("parquet").start(f"{root}/out").awaitTermination()
        return sorted(r[0] for r in rows(spark.read.parquet(f"{root}/out").select("id")))

    N.write_split(made(spark, 0, 4), root, "s")
    assert run() == [0, 1, 2, 3]
    N.write_split(made(spark, 4, 6), root, "s")
    N.write_split(made(spark, 6, 7), root, "s")
    assert run() == list(range(7))


def test_the_plan_shows_columns_and_filters(spark, tmp_path, capsys):
    N.write_split(made(spark, 0, 10), str(tmp_path), "s")
    N.load_split(spark, str(tmp_path), "s", schema="id BIGINT, text STRING").where("id > 5").explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)]" in plan and "struct<id:bigint,text:string>" in plan
    assert "Filter (" not in plan


def test_planning_processes_need_no_package(spark, tmp_path):
    """What is registered is unpickled by a process that cannot import this package."""
    import base64
    import subprocess
    import sys

    from pyspark import cloudpickle

    kept = {}

    class Recorder:
        class dataSource:
            register = staticmethod(lambda source: kept.update(code=cloudpickle.dumps(source)))

        conf = spark.conf

    N.register(Recorder)
    code = base64.b64encode(kept["code"]).decode()
    script = f"import base64; from pyspark import cloudpickle as c; print(c.loads(base64.b64decode('{code}')).name()); import sys; assert 'sftframe' not in sys.modules"
    assert subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.strip() == N.FORMAT
