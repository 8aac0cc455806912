"""Datasets by name and split: ``spark.read.format("sftdata").option("path", root).option("dataset", "owner/set").load()``.

A split is the folder ``root/owner/set/split``.  Files put there by others (``*.parquet``, at any depth) are read as
they are.  Splits written here have numbered commits, each of which lists the files that it adds; a commit is there
whole or not at all, and of two writers of one number one wins.  That rests on a rename that refuses an
existing name in one step, as HDFS has it; local folders check and then rename, and object stores give no such promise.
Files of a writer that lost stay below ``parts`` and are in no version.  Readers are pinned to a version, so what is
committed later does not disturb them, and a stream takes the commits one after the other.

Options: ``path`` (root), ``dataset``, ``split`` (default ``train``), ``version`` (default the latest) and
``maxSplitBytes``.  A schema given to the reader names the columns to read; filters on whole numbers, texts, dates
and booleans are applied while reading when ``spark.sql.python.filterPushdown.enabled`` is set.  The reader lists
files and reads them with Arrow's file systems; for others, ``split_files`` gives the paths to ``spark.read.parquet``.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as S
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

FORMAT = "sftdata"
COMMITS, PARTS = "commits", "parts"
#: Bytes of files that one task reads.
SPLIT_BYTES = 128 << 20
#: Types whose comparisons mean the same in Arrow and in Spark.
EXACT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType, T.DateType)
COMPARED = {
    S.EqualTo: lambda f, v: f == v,
    S.GreaterThan: lambda f, v: f > v,
    S.GreaterThanOrEqual: lambda f, v: f >= v,
    S.LessThan: lambda f, v: f < v,
    S.LessThanOrEqual: lambda f, v: f <= v,
    S.In: lambda f, v: f.isin(list(v)),
}


class Conflict(RuntimeError):
    """The split has another version than the writer expected."""


# -- writing --------------------------------------------------------------------------------------------------------


def _hadoop(spark: SparkSession, text: str):
    """The path and the file system it is on, local or remote."""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def folder_of(root: str, dataset: str, split: str) -> str:
    if not dataset or not split or ".." in f"{dataset}/{split}".split("/"):
        raise ValueError(f"no name of a dataset and split: {dataset!r}, {split!r}")
    return f"{root.rstrip('/')}/{dataset}/{split}"


def _commit_names(spark: SparkSession, folder: str) -> list[str]:
    pattern, files = _hadoop(spark, f"{folder}/{COMMITS}/*.json")
    return sorted(found.getPath().getName() for found in files.globStatus(pattern) or [])


def version(spark: SparkSession, root: str, dataset: str, split: str = "train") -> int:
    """Number of the last commit; 0 for a split without commits."""
    names = _commit_names(spark, folder_of(root, dataset, split))
    return int(names[-1].removesuffix(".json")) if names else 0


def _create(spark: SparkSession, folder: str, number: int, record: dict) -> bool:
    """Put a commit in its place, unless one is there."""
    draft, files = _hadoop(spark, f"{folder}/{PARTS}/.{uuid.uuid4().hex}")
    target, _ = _hadoop(spark, f"{folder}/{COMMITS}/{number:010d}.json")
    files.mkdirs(target.getParent())
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsparkSession.sessionState().newHadoopConf()
    )
    gateway = spark.sparkContext._gateway
    plain = gateway.new_array(gateway.jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, target, plain)
    except Exception:
        files.delete(draft, False)
        if files.exists(target):
            return False
        raise
    return True


def write_split(
    df: DataFrame, root: str, dataset: str, split: str = "train", expected: int | None = None, replace: bool = False
) -> int:
    """Write rows and commit them; the number of the commit.

    Without ``expected`` the rows are added after what other writers have committed meanwhile.  With it, the commit
    is made only on top of that version, else ``Conflict`` is raised and nothing changes; ``replace`` puts the rows in
    the place of all earlier ones and needs it.  So of several processes that prepare a split from version 0, one wins.
    """
    if replace and expected is None:
        raise ValueError("to replace rows, name the version that they replace")
    spark, folder = df.sparkSession, folder_of(root, dataset, split)
    if expected is not None and version(spark, root, dataset, split) != expected:
        raise Conflict(f"{dataset}/{split} is not at version {expected}")
    part = f"{PARTS}/{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{part}")
    pattern, files = _hadoop(spark, f"{folder}/{part}/*.parquet")
    listed = [[f"{part}/{found.getPath().getName()}", found.getLen()] for found in files.globStatus(pattern)]
    record = {"files": sorted(listed), "replace": replace}
    number = (version(spark, root, dataset, split) if expected is None else expected) + 1
    while not _create(spark, folder, number, record):
        if expected is not None:
            raise Conflict(f"{dataset}/{split} is not at version {expected}")
        number += 1
    return number


# -- what a version holds, read without Spark as data sources are ----------------------------------------------------


def _located(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def _listed(files: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    return files.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=True))


def _is_data(folder: str, path: str) -> bool:
    return path.endswith(".parquet") and not any(step[0] in "._" for step in path[len(folder) :].strip("/").split("/"))


def commits(files: pafs.FileSystem, folder: str, after: int = 0, last: int | None = None) -> Iterator[tuple[int, dict]]:
    """The commits after one number, up to another, in order."""
    found = files.get_file_info(pafs.FileSelector(f"{folder}/{COMMITS}", allow_not_found=True))
    numbers = sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json") and f.base_name[0] != ".")
    for number in numbers:
        if number > after and (last is None or number <= last):
            with files.open_input_stream(f"{folder}/{COMMITS}/{number:010d}.json") as stream:
                yield number, json.loads(stream.read())


def split_files(path: str, dataset: str, split: str = "train", version: int | None = None) -> list[tuple[str, int]]:
    """Files of a split and their bytes, as of a version or as they lie there."""
    files, folder = _located(folder_of(path, dataset, split))
    listed: list[tuple[str, int]] = []
    number = 0
    for number, record in commits(files, folder, last=version):
        own = [(f"{folder}/{name}", size) for name, size in record["files"]]
        listed = own if record["replace"] else listed + own
    if version is not None and number != version:
        raise ValueError(f"{dataset}/{split} has no version {version}")
    if not number:
        listed = sorted((f.path, f.size) for f in _listed(files, folder) if _is_data(folder, f.path))
        if not listed:
            near = sorted(f.base_name for f in files.get_file_info(pafs.FileSelector(folder.rsplit("/", 1)[0], allow_not_found=True)))
            raise FileNotFoundError(f"no files of {dataset}/{split}; there are {near}")
    return listed


# -- reading --------------------------------------------------------------------------------------------------------


@dataclass
class Stretch(S.InputPartition):
    """Byte ranges of files; a row group belongs to the range that its first byte is in."""

    ranges: list[tuple[str, int, int]] = field(default_factory=list)


def stretches(listed: list[tuple[str, int]], most: int) -> list[Stretch]:
    """Ranges of at most ``most`` bytes; small files are put together and large ones are cut.  No footer is read."""
    made, room = [Stretch()], most
    for path, size in listed:
        at = 0
        while at < size:
            if not room:
                made.append(Stretch())
                room = most
            end = min(size, at + room)
            made[-1].ranges.append((path, at, end))
            room -= end - at
            at = end
    return [one for one in made if one.ranges]


def _first_byte(group: pq.RowGroupMetaData) -> int:
    columns = (group.column(i) for i in range(group.num_columns))
    return min(min(c.data_page_offset, c.dictionary_page_offset or c.data_page_offset) for c in columns)


def read_stretch(root: str, part: Stretch, schema: pa.Schema, wanted: pc.Expression | None) -> Iterator[pa.RecordBatch]:
    """Rows of the row groups that start in the stretch, a batch at a time; statistics rule row groups out."""
    files, _ = _located(root)
    parquet = pads.ParquetFileFormat()
    for path, start, end in part.ranges:
        with files.open_input_file(path) as stream:
            meta = pq.ParquetFile(stream).metadata
        mine = [i for i in range(meta.num_row_groups) if meta.row_group(i).num_columns and start <= _first_byte(meta.row_group(i)) < end]
        if mine:
            fragment = parquet.make_fragment(path, files, row_groups=mine)
            have = fragment.physical_schema
            names = [name for name in schema.names if name in have.names]
            asked = wanted if wanted is None or set(names) == set(schema.names) else None
            for batch in fragment.to_batches(columns=names, filter=asked, batch_size=8192):
                absent = {n: pa.nulls(len(batch), schema.field(n).type) for n in schema.names if n not in names}
                arrays = [absent[n] if n in absent else batch.column(n).cast(schema.field(n).type) for n in schema.names]
                made = pa.RecordBatch.from_arrays(arrays, schema=schema)
                yield made if asked is wanted else made.filter(wanted)


class _Reader(S.DataSourceReader):
    def __init__(self, root: str, listed: list[tuple[str, int]], schema: T.StructType, most: int):
        self.root, self.listed, self.schema, self.most = root, listed, schema, most
        self.filters: list[tuple] = []

    def pushFilters(self, filters):
        for one in filters:
            name = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
            exact = name in self.schema.names and isinstance(self.schema[name].dataType, EXACT_TYPES)
            if exact and type(one) in (*COMPARED, S.IsNotNull):
                self.filters.append((type(one), name, getattr(one, "value", None)))
            else:
                yield one

    def wanted(self) -> pc.Expression | None:
        made = None
        for kind, name, value in self.filters:
            column = pc.field(name)
            one = column.is_valid() if kind is S.IsNotNull else column.is_valid() & COMPARED[kind](column, value)
            made = one if made is None else made & one
        return made

    def partitions(self):
        return stretches(self.listed, self.most) or [Stretch()]

    def read(self, partition):
        yield from read_stretch(self.root, partition, to_arrow_schema(self.schema), self.wanted())


class _StreamReader(S.DataSourceStreamReader):
    """A micro-batch is the commits between two versions.  A commit that replaces rows ends the stream with an error."""

    def __init__(self, root: str, folder: str, schema: T.StructType, most: int):
        self.root, self.folder, self.schema, self.most = root, folder, schema, most

    def initialOffset(self):
        return {"version": 0}

    def latestOffset(self):
        files, folder = _located(self.folder)
        found = files.get_file_info(pafs.FileSelector(f"{folder}/{COMMITS}", allow_not_found=True))
        return {"version": max((int(f.base_name[:10]) for f in found if f.base_name.endswith(".json") and f.base_name[0] != "."), default=0)}

    def partitions(self, start, end):
        files, folder = _located(self.folder)
        listed = []
        for number, record in commits(files, folder, start["version"], end["version"]):
            if record["replace"] and number > 1:
                raise ValueError(f"commit {number} replaces rows that the stream has given out")
            listed += [(f"{folder}/{name}", size) for name, size in record["files"]]
        return stretches(listed, self.most) or [Stretch()]

    def read(self, partition):
        yield from read_stretch(self.root, partition, to_arrow_schema(self.schema), None)


class NamedDatasets(S.DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def _asked(self) -> tuple[str, str, str]:
        absent = [name for name in ("path", "dataset") if not self.options.get(name)]
        if absent:
            raise ValueError(f"the options {absent} are missing")
        return self.options["path"], self.options["dataset"], self.options.get("split", "train")

    def _files(self) -> list[tuple[str, int]]:
        pinned = self.options.get("version")
        return split_files(*self._asked(), int(pinned) if pinned else None)

    def _most(self) -> int:
        return int(self.options.get("maxSplitBytes", SPLIT_BYTES))

    def schema(self):
        files, _ = _located(self._asked()[0])
        with files.open_input_file(self._files()[-1][0]) as stream:
            return from_arrow_schema(pq.read_schema(stream).remove_metadata())

    def reader(self, schema):
        return _Reader(self._asked()[0], self._files(), schema, self._most())

    def streamReader(self, schema):
        return _StreamReader(self._asked()[0], folder_of(*self._asked()), schema, self._most())


def register(spark: SparkSession) -> None:
    """Make ``format("sftdata")`` known to the session, with filters applied while reading.

    The code goes along by value: the process that plans a stream knows nothing of shipped packages.
    """
    own = sys.modules[__name__]
    cloudpickle.register_pickle_by_value(own)
    try:
        spark.dataSource.register(NamedDatasets)
    finally:
        cloudpickle.unregister_pickle_by_value(own)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def load_split(
    spark: SparkSession, root: str, dataset: str, split: str = "train", schema: T.StructType | str | None = None, **options: object
) -> DataFrame:
    """Rows of a dataset by name and split; ``schema`` names the columns to read."""
    register(spark)
    reader = spark.read.format(FORMAT).options(path=root, dataset=dataset, split=split, **options)
    return (reader if schema is None else reader.schema(schema)).load()
