"""Vectorised words, hashes and packed arrays over Arrow batches: shared small helpers of the text operators.

A null text counts as an empty one.  A batch is worked through in chunks of whole rows of about ``CHUNK_BYTES``;
one longer text is a chunk of its own, so memory follows the longest text and never the table.
"""

from __future__ import annotations

import ctypes
import sys
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftframe.session import shared_folder, ship_package

CHUNK_BYTES = 1 << 20
#: Bits of a bitmap for each of its numbers, of one bitmap at most (16 MB), and of one of its rows.
MARK_BITS, MOST_MARK_BITS, ROW_BITS = 32, 1 << 27, 1 << 15
#: Rows of a narrow table up to which it is broadcast as it is.
FEW_ROWS = 1 << 14

_LIBC = ctypes.CDLL("libc.so.6") if sys.platform == "linux" else None
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the folder that all executors share and read it again: cuts lineage, survives lost tasks."""
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_blocks(df: DataFrame, block: str, name: str) -> str:
    """Write a table by the values of ``block`` and return its folder; tasks read it block by block."""
    path = f"{shared_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(block).parquet(path)
    return path


def read_block(folder: str, block: str, number: int) -> pa.Table | None:
    """A block of ``stored_blocks``, read by a task; None if it has no rows."""
    store, root = pafs.FileSystem.from_uri(folder)
    path = f"{root}/{block}={number}"
    if store.get_file_info(path).type == pafs.FileType.NotFound:
        return None
    return pq.read_table(path, filesystem=store, partitioning=None)


def hinted(df: DataFrame) -> DataFrame:
    """A stored narrow table, to be broadcast if it has few rows: many small files look larger to Spark than they are."""
    return F.broadcast(df) if df.count() <= FEW_ROWS else df


def marker(numbers: DataFrame, seed: int):
    """A function that adds to a table whether its ``key`` may be one of ``numbers``; it is never false for one that is.

    ``numbers`` is a stored column of distinct numbers.  They are bits of a bitmap, one broadcast row per ``ROW_BITS``.
    Where there are so many that the bitmap fills up, more keys are in doubt, which callers settle by a join.  Up to
    ``FEW_ROWS`` numbers are broadcast themselves.
    """
    (column,) = numbers.columns
    count = numbers.count()
    if count <= FEW_ROWS:

        def exact(df: DataFrame, key: str, name: str) -> DataFrame:
            few = F.broadcast(numbers.select(F.col(column).alias("_number")))
            return df.join(few, F.col(key) == F.col("_number"), "left").select(*df.columns, F.col("_number").isNotNull().alias(name))

        return exact
    bits = min(MOST_MARK_BITS, 1 << max(ROW_BITS.bit_length() - 1, (MARK_BITS * count).bit_length()))

    def place(key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(bits))

    at = place(column)
    rows = numbers.select(F.floor(at / ROW_BITS).alias("_part"), (at % ROW_BITS).alias("bit")).repartition("_part")
    rows = stored(rows.groupBy("_part").agg(F.bitmap_construct_agg("bit").alias("_bitmap")), "marks")

    def mark(df: DataFrame, key: str, name: str) -> DataFrame:
        at = place(key)
        bit = at % ROW_BITS
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found = df.join(F.broadcast(rows), F.floor(at / ROW_BITS) == F.col("_part"), "left")
        return found.select(*df.columns, F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False)).alias(name))

    return mark


def without(df: DataFrame, key: str, dropped: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``kept`` and not in ``dropped``; both have one column of that name and share no key.

    Wide rows stay where they are: keys that are not in the bitmap of ``dropped`` are kept, and of the others those go
    that are not in the bitmap of the kept keys among them.  Only what both leave in doubt, a few hundredths, is joined.
    """
    gone = marker(dropped, 1)
    doubtful = stored(gone(kept, key, "_gone").where("_gone").select(key), "doubtful")
    spared = marker(doubtful, 2)
    marked = gone(df, key, "_gone")
    asked = spared(marked.where("_gone").select(*df.columns), key, "_spared").where("_spared").select(*df.columns)
    return marked.where(~F.col("_gone")).select(*df.columns).unionAll(asked.join(doubtful, key, "left_semi").select(*df.columns))


def volume(texts: DataFrame, column: str) -> int:
    """Bytes of a text column, one pass in the JVM: what numbers of slices and of tasks are made from."""
    return texts.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def task_count(spark: SparkSession, size: int, per_task: int) -> int:
    """Tasks for ``size`` bytes, so that a task's share stays the same however much there is."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-size // per_task))


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after their task."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def remainder(doc_id: Column | str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % divisor


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective finaliser over 64 bits."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


class _Powers:
    """Powers of the multiplier and of its inverse, grown as longer chunks come."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < size:
            size = max(size, CHUNK_BYTES + (CHUNK_BYTES >> 1))
            for name, factor in (("up", _MULTIPLIER), ("down", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


#: Word bytes by the two rules of the contracts: all but white space, and letters, digits and bytes beyond ASCII.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts (one more entry for the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not wide and not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        raise TypeError(f"not text: {column.type}")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    starts = starts.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def chunks(buffer: np.ndarray, starts: np.ndarray, limit: int = CHUNK_BYTES):
    """``(first row, row after the last, bytes, starts)`` of pieces of whole rows of up to ``limit`` bytes."""
    rows, first = len(starts) - 1, 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, "right")) - 1)
        yield first, last, buffer[starts[first] : starts[last]], starts[first : last + 1] - starts[first]
        first = last


def spans(mask: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``mask`` that do not cross rows: their starts, their ends, and the first run of each row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    before = np.empty_like(mask)
    before[0] = False
    before[1:] = mask[:-1]
    inner = starts[(starts > 0) & (starts < len(mask))]
    before[inner] = False
    after = np.empty_like(mask)
    after[-1] = False
    after[:-1] = mask[1:]
    after[inner - 1] = False
    begin = np.flatnonzero(mask & ~before)
    return begin, np.flatnonzero(mask & ~after) + 1, np.searchsorted(begin, starts)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    up, _ = _Powers.upto(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    terms = _BYTE_VALUES[data]
    terms *= up[: len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, wherever it lies, from ``prefix_hashes``."""
    _, down = _Powers.upto(len(sums))
    values = sums[end] - sums[begin]
    values *= down[begin]
    values += (end - begin).astype(np.uint64) * _MULTIPLIER
    return mix(values)


def words(data: np.ndarray, starts: np.ndarray, rule: np.ndarray, lower: bool = True):
    """``(begin, end, hash, first word of each row)`` of the words of a chunk."""
    if lower:
        data = lower_table()[data]
    begin, end, rows = spans(rule[data], starts)
    return begin, end, span_hashes(prefix_hashes(data), begin, end), rows


def shingle_hashes(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` successive words within each row, sorted and distinct per row, and where rows start.

    A row of fewer words has its whole sequence as one shingle, a row without words has none.
    """
    n_words = np.diff(rows)
    n_all = np.where(n_words == 0, 0, np.maximum(n_words - size + 1, 1))
    owner = np.repeat(np.arange(len(n_words)), n_all)
    first = np.cumsum(n_all) - n_all
    at = np.arange(int(n_all.sum())) - first[owner] + rows[:-1][owner]
    limit = rows[1:][owner]
    values = np.zeros(len(at), np.uint64)
    for step in range(size):
        values *= _MULTIPLIER
        inside = at + step < limit
        values += np.where(inside, hashes[np.minimum(at + step, max(len(hashes) - 1, 0))], np.uint64(0)) if len(at) else 0
    values = mix(values + np.uint64(size))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    kept = np.ones(len(values), bool)
    kept[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[kept], np.searchsorted(owner[kept], np.arange(len(n_words) + 1))


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of a number array, byte planes apart; ``unpack`` needs the type and the length."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, dtype, size: int) -> np.ndarray:
    dtype = np.dtype(dtype)
    raw = pa.decompress(data, decompressed_size=size * dtype.itemsize, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(dtype.itemsize, size).T
    return np.ascontiguousarray(planes).view(dtype).reshape(size)


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
