"""Batches on disk for loaders: files per rank, an index of where each batch lies, and readers that seek.

A file holds the batches of one rank and epoch one after the other (``batches_per_file`` at most), each an Arrow IPC
stream of its own, so a reader needs its bytes only.  The index has a row per batch: file, offset, length.  It is
written last, as a table, and is the list of what counts: a task that is lost and runs again writes a file of another
name, and files that the index does not name are left over.  The index is stored by rank, so a loader reads its own
part, and a run that resumes at ``(epoch, epoch_step)`` opens no byte of what it has seen.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftframe.plans.epochs import resume_from
from sftframe.session import ship_package
from sftframe.sources.tables import require_columns

BATCHES_PER_FILE = 512
#: Bytes of shards that a task of ``read_shards`` is given.
TASK_BYTES = 32 << 20
KEY = ["epoch", "rank", "batch"]
_INDEX = "epoch INT, rank INT, batch BIGINT, file STRING, offset BIGINT, length BIGINT, rows INT"


def _message(rows: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write(rows)
    return sink.getvalue().to_pybytes()


def _whole_batches(frames) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows sorted by key, put together to one table per key; at most one batch is held beside the frame."""
    at, held = None, []
    for frame in frames:
        if not frame.num_rows:
            continue
        keys = np.stack([frame.column(frame.schema.get_field_index(k)).to_numpy().astype(np.int64) for k in KEY])
        first = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1])
        for begin, end in zip(first.tolist(), [*first[1:].tolist(), frame.num_rows]):
            key = tuple(keys[:, begin].tolist())
            if key != at and held:
                yield at, pa.Table.from_batches(held).combine_chunks()
                held = []
            at = key
            held.append(frame.slice(begin, end - begin))
    if held:
        yield at, pa.Table.from_batches(held).combine_chunks()


def _writer(folder: str, per_file: int):
    def run(frames):
        store, root = pafs.FileSystem.from_uri(folder)
        current, name, out, at, rows = None, "", None, 0, []
        for (epoch, rank, batch), table in _whole_batches(frames):
            group = (epoch, rank, batch // per_file)
            if group != current:
                if out is not None:
                    out.close()
                current, at, name = group, 0, f"epoch{epoch}-rank{rank}-{group[2]}-{uuid.uuid4().hex}.arrows"
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            data = _message(table)
            out.write(data)
            rows.append((epoch, rank, batch, name, at, len(data), table.num_rows))
            at += len(data)
        if out is not None:
            out.close()
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            names = [*KEY, "file", "offset", "length", "rows"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def write_shards(rows: DataFrame, folder: str, batches_per_file: int = BATCHES_PER_FILE) -> None:
    """Write rows with ``epoch, rank, batch, slot`` and any other columns below ``folder``, which must be new.

    A task writes the files of its groups; a group is one file's batches of one rank.
    """
    require_columns(rows, [*KEY, "slot"], "the batches")
    spark = rows.sparkSession
    ship_package(spark)
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(f"{root}/data", recursive=True)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = F.floor(F.col("batch") / batches_per_file)
    dealt = rows.repartition(parts, "epoch", "rank", group).sortWithinPartitions(*KEY, "slot")
    index = dealt.mapInArrow(_writer(f"{folder}/data", batches_per_file), _INDEX)
    index.write.partitionBy("rank").parquet(f"{folder}/index")


def shard_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


class RankReader:
    """The batches of one rank in the order of training, from any place on; for a loader process, without Spark."""

    def __init__(self, folder: str, rank: int):
        self.store, self.root = pafs.FileSystem.from_uri(folder)
        path = f"{self.root}/index/rank={rank}"
        known = self.store.get_file_info(path).type != pafs.FileType.NotFound
        rows = pq.read_table(path, filesystem=self.store, partitioning=None).to_pylist() if known else []
        self.places = sorted(rows, key=lambda r: (r["epoch"], r["batch"]))
        self.bytes_read = 0

    def batches(self, epoch: int = 0, epoch_step: int = 0) -> Iterator[tuple[int, int, pa.Table]]:
        """``(epoch, batch, rows)`` from step ``epoch_step`` of an epoch on; files are opened as they are needed."""
        name, source = None, None
        for place in self.places:
            if (place["epoch"], place["batch"]) < (epoch, epoch_step):
                continue
            if place["file"] != name:
                if source is not None:
                    source.close()
                name, source = place["file"], self.store.open_input_file(f"{self.root}/data/{place['file']}")
            self.bytes_read += place["length"]
            yield place["epoch"], place["batch"], pa.ipc.open_stream(source.read_at(place["length"], place["offset"])).read_all()
        if source is not None:
            source.close()


def read_shards(spark: SparkSession, folder: str, schema, epoch: int = 0, epoch_step: int = 0) -> DataFrame:
    """All ranks' rows from a place of the run on; only the bytes of those batches are read.

    Batches are dealt out by stretches of files, as many as their bytes ask for.
    """
    ship_package(spark)
    places = resume_from(shard_index(spark, folder), epoch, epoch_step).withColumn("stretch", F.floor(F.col("offset") / TASK_BYTES))
    size = places.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    dealt = places.select("file", "offset", "length", "stretch").repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset")

    def run(frames):
        store, root = pafs.FileSystem.from_uri(f"{folder}/data")
        name, source = None, None
        for frame in frames:
            for file, offset, length in zip(*(frame.column(k).to_pylist() for k in range(3))):
                if file != name:
                    name, source = file, store.open_input_file(f"{root}/{file}")
                yield from pa.ipc.open_stream(source.read_at(length, offset))

    return dealt.mapInArrow(run, schema)
