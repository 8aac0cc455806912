"""Removal of repeated passages by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the table.  Matches never
cross texts and are judged on the input.

Every string of ``LENGTH`` bytes, a window, has an anchor: the place in it whose ``GRAM`` bytes have the smallest
hash (the first of ties).  Equal windows have equal anchors at equal offsets, so they can be brought together by
content.  Neighbouring windows of one anchor form a block; all windows of a block share its core.  Blocks are kept
as numbers only.  Where a core occurs twice or more, each distinct block is cut out of one text once, with its
number of places, and the blocks are dealt out by core.  A shard builds one suffix array over its blocks: windows
are equal if their suffixes stand together with common prefixes of ``LENGTH`` or more.

A short passage with different text around it gives a core that very many distinct blocks share.  Where they have
more than ``SHARD_BYTES``, the blocks are cut into parts of one window each, whose core is the window itself: they
are dealt out and counted by a 128-bit digest of the window, and no task sees all blocks of the core.

Copies of whole texts are counted by digest and stand for one text; every window of a text with a copy is
repeated.  A hot passage is thus one block with a count, whatever its number of places.

Null and empty texts, and texts below ``LENGTH`` bytes, keep everything.  Ids may be null or repeated; every row of
the input gives one row.  Rows with equal texts are repeats of each other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.llm import textcore as X
from sftframe.llm.suffix import permuted_lcp, suffix_array

LENGTH = 400
GRAM = 48
BLOCKS = 2
SHARD_BYTES = 2 << 20


def _slide(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` successive values."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[: len(values) - (width - size)], values[width - size :])
    return values


def blocks_of(data: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Blocks of a chunk of texts: core hash, hash of all bytes, first window in its row, number of windows, row."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    reach = length - gram + 1
    width = -(-reach // BLOCKS)
    sums = X.prefix_hashes(data)
    place = np.arange(len(data) - gram + 1)
    keys = X.span_hashes(sums, place, place + gram)
    keys &= np.uint64(0xFFFFFFFF00000000)
    keys |= place.astype(np.uint64)
    anchor = (_slide(keys, reach) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = np.arange(len(anchor))
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[: len(anchor)]
    inside = window + length <= starts[1:][owner]
    window, anchor, owner = window[inside], anchor[inside], owner[inside]
    part = (anchor - window) // width
    change = np.ones(len(window), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(window)))
    low, anchor, part = window[first], anchor[first], part[first]
    nearest = part * width
    farthest = np.minimum(nearest + width, reach) - 1
    core = X.span_hashes(sums, anchor - nearest, anchor - farthest + length)
    core = X.mix(core + part.astype(np.uint64))
    whole = X.span_hashes(sums, low, low + count - 1 + length)
    return core, whole, low - starts[owner[first]], count, owner[first]


_NUMBERS = (("cores", pa.int64()), ("wholes", pa.int64()), ("lows", pa.int32()), ("counts", pa.int32()))


def _lists(parts: list[tuple], rows: int) -> list[pa.Array]:
    owners = np.concatenate([p[4] for p in parts]) if parts else np.zeros(0, np.int64)
    offsets = np.searchsorted(owners, np.arange(rows + 1)).astype(np.int32)
    lists = []
    for k, (_, kind) in enumerate(_NUMBERS):
        values = np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64)
        values = values.view(np.int64) if values.dtype == np.uint64 else values
        lists.append(pa.ListArray.from_arrays(offsets, pa.array(values, kind)))
    return lists


def _index(length: int, gram: int):
    def run(batches):
        for batch in batches:
            buffer, starts = X.text_bytes(batch.column(batch.num_columns - 1))
            parts = []
            for first, _, data, at in X.chunks(buffer, starts):
                *numbers, owner = blocks_of(data, at, length, gram)
                parts.append((*numbers, owner + first))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *_lists(parts, batch.num_rows)],
                [*batch.schema.names[:-1], *(name for name, _ in _NUMBERS)],
            )

    return run


def _cut(length: int):
    """Cut the wanted blocks out of their texts."""
    schema = pa.schema([("core", pa.int64()), ("whole", pa.int64()), ("places", pa.int64()), ("piece", pa.binary())])

    def run(batches):
        for batch in batches:
            buffer, starts = X.text_bytes(batch.column(0))
            wanted = batch.column(1)
            owner = np.repeat(starts[:-1], wanted.value_lengths().to_numpy(zero_copy_only=False))
            flat = wanted.flatten()
            core, whole, places, low, count = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(5))
            for at in range(0, len(core), 4096):
                part = slice(at, at + 4096)
                begin = owner[part] + low[part]
                pieces = [buffer[a:b].tobytes() for a, b in zip(begin, begin + count[part] - 1 + length)]
                yield pa.record_batch([core[part], whole[part], places[part], pa.array(pieces, pa.binary())], schema=schema)

    return run


def repeated_windows(pieces: list[bytes], places: np.ndarray, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every piece the ranges of window starts that occur twice or more among all places of all pieces.

    One suffix array over the pieces, with a separator after each; a piece that has several places counts so often.
    """
    sizes = np.array([len(p) for p in pieces])
    joined = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    last = np.cumsum(sizes + 1) - 1
    heads = last - sizes
    real = np.ones(len(joined), bool)
    real[last] = False
    present = np.zeros(256, bool)
    present[joined[real]] = True
    dense = np.cumsum(present) + 1
    symbols = dense[joined].astype(np.uint8 if dense[-1] < 256 else np.uint16)
    symbols[last] = 1
    order = suffix_array(symbols)
    common = permuted_lcp(symbols, order, heads, 3 * length)
    owner = np.repeat(np.arange(len(pieces)), sizes + 1)
    window = np.arange(len(joined)) + length <= last[owner]
    group = np.cumsum(common[order] < length) - 1
    times = np.bincount(group, np.where(window[order], places[owner[order]], 0))
    repeated = np.zeros(len(joined) + 1, bool)
    repeated[order] = window[order] & (times[group] >= 2)
    begin, end, rows = X.spans(repeated[:-1], np.append(heads, len(joined)))
    return [(begin[a:b] - heads[k], end[a:b] - heads[k]) for k, (a, b) in enumerate(zip(rows[:-1], rows[1:]))]


def _match(length: int):
    schema = pa.schema([("core", pa.int64()), ("whole", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])

    def shard(rows):
        pieces = [r[3] for r in rows]
        found = repeated_windows(pieces, np.array([r[2] for r in rows]), length)
        kept = [(r[0], r[1], a.tolist(), b.tolist()) for r, (a, b) in zip(rows, found) if len(a)]
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept), schema)], schema=schema)

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= SHARD_BYTES and row[0] != rows[-1][0]:
                    yield from shard(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield from shard(rows)

    return run


def _windows(length: int):
    """Every window of the pieces by its digest."""
    schema = pa.schema([("core", pa.int64()), ("whole", pa.int64()), ("places", pa.int64()), ("at", pa.int32()), ("window", pa.binary())])

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                buffer, starts = X.text_bytes(part.column(3))
                data = buffer.tobytes()
                count = np.diff(starts) - length + 1
                at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                begin = np.repeat(starts[:-1], count) + at
                windows = [hashlib.blake2b(data[a : a + length], digest_size=16).digest() for a in begin.tolist()]
                numbers = [np.repeat(part.column(k).to_numpy(), count) for k in range(3)]
                yield pa.record_batch([*numbers, at.astype(np.int32), pa.array(windows, pa.binary())], schema=schema)

    return run


def _runs(batches):
    """Ranges of the repeated windows of each piece."""
    schema = pa.schema([("core", pa.int64()), ("whole", pa.int64()), ("begins", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])
    for batch in batches:
        begins, ends = [], []
        for places in batch.column(2).to_pylist():
            at = np.unique(places)
            cuts = np.flatnonzero(np.diff(at) > 1)
            begins.append(at[np.append(0, cuts + 1)].tolist())
            ends.append((at[np.append(cuts, len(at) - 1)] + 1).tolist())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(begins, schema.field(2).type), pa.array(ends, schema.field(3).type)], schema=schema)


def _by_window(cut: DataFrame, length: int) -> DataFrame:
    """What ``_match`` finds, with a shuffle by window in place of one by core."""
    windows = cut.mapInArrow(_windows(length), "core long, whole long, places long, at int, window binary")
    windows = X.stored(windows, "dedup-windows")
    # Stored, so that the join can split a window that very many blocks have.
    repeated = X.stored(windows.groupBy("window").agg(F.sum("places").alias("n")).where("n > 1").select("window"), "dedup-repeated")
    found = windows.join(repeated, "window").groupBy("core", "whole").agg(F.collect_list("at").alias("at"))
    return found.mapInArrow(_runs, "core long, whole long, begins array<int>, ends array<int>")


def merged(begins, ends) -> list[tuple[int, int]]:
    """Ranges joined where they overlap or touch."""
    result: list[tuple[int, int]] = []
    for a, b in sorted(zip(begins, ends)):
        if result and a <= result[-1][1]:
            result[-1] = (result[-1][0], max(result[-1][1], b))
        else:
            result.append((a, b))
    return result


def _remove(batches):
    names = ["rid", "spans", "kept"]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans, kept = [], []
        buffer, starts = X.text_bytes(batch.column(1))
        for row, ranges in enumerate(batch.column(2).to_pylist()):
            text = buffer[starts[row] : starts[row + 1]].tobytes()
            found = merged([r["start"] for r in ranges], [r["end"] for r in ranges])
            at, parts = 0, []
            for a, b in found:
                parts.append(text[at:a])
                at = b
            kept.append(b"".join([*parts, text[at:]]))
            spans.append([{"start": a, "end": b} for a, b in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind), pa.array(kept, pa.binary())], names)


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row of ``docs``: id, ``n_bytes``, digests, and for rows that lose bytes the removed byte ``spans`` and what is ``kept``.

    ``copied`` is true where an equal text exists elsewhere; such a text of ``length`` bytes or more goes as a whole.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), body.alias("body")).select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        F.md5("body").alias("digest"),
        F.sha2("body", 256).alias("sha"),
        F.octet_length("body").cast("long").alias("n_bytes"),
        "body",
    )
    fields = [*plain.schema.fields[:-1], *(T.StructField(n, T.ArrayType(T.LongType() if k == pa.int64() else T.IntegerType())) for n, k in _NUMBERS)]
    index = X.stored(plain.mapInArrow(_index(length, gram), T.StructType(fields)), "dedup-index")
    texts = index.groupBy("digest").agg(F.min("rid").alias("rid"), F.count("*").alias("copies"))

    blocks = (
        index.select("rid", "doc_id", "digest", F.arrays_zip(*(n for n, _ in _NUMBERS)).alias("b"))
        .join(texts.select("rid", "copies"), "rid")
        .select("rid", "copies", F.explode("b").alias("b"))
        .select("rid", "copies", *(F.col(f"b.{n}").alias(n[:-1]) for n, _ in _NUMBERS))
    )
    place = F.xxhash64("rid", "low")
    cores = X.stored(blocks.groupBy("core").agg(F.min(place).alias("a"), F.max(place).alias("z")).where("a <> z").select("core"), "dedup-cores")
    blocks = X.stored(blocks.join(cores, "core"), "dedup-blocks")

    pieces = blocks.groupBy("core", "whole", "count").agg(
        F.min(F.struct("rid", "low")).alias("at"), F.count("*").alias("places")
    )
    pieces = X.stored(pieces, "dedup-pieces")
    wide = pieces.groupBy("core").agg(F.sum(F.col("count") - 1 + length).alias("n")).where(F.col("n") > SHARD_BYTES)
    wide = X.stored(wide.select("core"), "dedup-wide")
    keys = index.select("rid", "doc_id", "digest").join(blocks.select("rid").distinct(), "rid")
    named = docs.select(F.col(f"`{doc_id}`").alias("_id"), body.alias("body")).withColumn("_digest", F.md5("body"))
    chosen = X.stored(
        named.join(keys, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_digest") == F.col("digest"))).select("rid", "body"),
        "dedup-texts",
    )

    def cut(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("at.rid").agg(
            F.collect_list(F.struct("core", "whole", "places", F.col("at.low").alias("low"), "count")).alias("wanted")
        )
        return chosen.join(wanted, "rid").select("body", "wanted").mapInArrow(
            _cut(length), "core long, whole long, places long, piece binary"
        )

    # A wide core has SHARD_BYTES or more of distinct blocks, so there are few.
    found = (
        cut(pieces.join(F.broadcast(wide), "core", "left_anti")).repartition("core")
        .sortWithinPartitions("core", "whole")
        .mapInArrow(_match(length), "core long, whole long, begins array<int>, ends array<int>")
    )
    if not wide.isEmpty():
        found = found.unionAll(_by_window(cut(pieces.join(F.broadcast(wide), "core", "left_semi")), length))
    spans = (
        blocks.where("copies = 1")
        .select("core", "whole", "rid", "low")
        .join(found, ["core", "whole"])
        .select("rid", "low", F.explode(F.arrays_zip("begins", "ends")).alias("r"))
        .groupBy("rid")
        .agg(F.collect_list(F.struct((F.col("low") + F.col("r.begins")).alias("start"), (F.col("low") + F.col("r.ends") - 1 + length).alias("end"))).alias("ranges"))
    )
    removed = chosen.join(spans, "rid").select("rid", "body", "ranges").mapInArrow(
        _remove, "rid long, spans array<struct<start:int,end:int>>, kept binary"
    )
    copied = texts.where("copies > 1").select("digest", F.lit(True).alias("copied"))
    rows = index.select("rid", "doc_id", "digest", "sha", "n_bytes").join(copied, "digest", "left")
    return rows.join(removed, "rid", "left").withColumn("copied", F.coalesce("copied", F.lit(False)))


def digest(docs: DataFrame) -> DataFrame:
    """Per row the sizes, the number of removed runs and the digest of what is left."""
    rows = repeated_spans(docs)
    whole = F.col("copied") & (F.col("n_bytes") >= LENGTH)
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce(lost, F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce(F.size("spans"), F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce(F.sha2("kept", 256), F.col("sha"))).alias("kept_sha256"),
    )
