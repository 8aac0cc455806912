"""Benchmark decontamination with an FM-index per shard of documents.

Words of benchmark items form windows of ``WINDOW`` successive words; an item of fewer words is one window.  A
document word inside any occurrence of a window is hit.  A shard (a chunk of documents) is turned into a string of
word numbers: words that no item has become separators, and runs of known words too short for any window go.  That
loses no occurrence.  The FM-index of the string is a wavelet matrix over its Burrows-Wheeler transform with sampled
suffix places; all windows are searched backwards together, and occurrences are located by walking to a sample.

Distinct pairs of a window and an item are made in Spark and written to the shared folder in blocks, one for each
``BLOCK_BYTES`` of items' text; a task takes a group of shards through the blocks one after the other, and a word is
hit if a window of any block hits it.  The driver sees neither items nor windows.  Null texts and texts without words hit nothing and
are hit by nothing.  Repeated item rows count once; an item without id marks words and is listed as an empty string.
Columns of the documents pass through unchanged; names that clash with the new ones raise ``ValueError``.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.llm import textcore as X
from sftframe.llm.suffix import suffix_array

WINDOW = 13
BLOCK_BYTES = 2 << 20
#: Shards that a task takes through the blocks together.
GROUP = 8
SAMPLE = 8
SHARD_BYTES = 1 << 20


class WaveletMatrix:
    """Ranks of symbols in a string: one bit vector with counts for each bit of a symbol, highest bit first."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for shift in range(bits - 1, -1, -1):
            bit = (symbols >> shift) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = len(symbols) - int(ones[-1])
            self.levels.append((shift, ones, zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        begin = np.zeros(len(end), np.int64)
        for shift, ones, zeros in self.levels:
            bit = ((symbol >> shift) & 1).astype(bool)
            begin = np.where(bit, zeros + ones[begin], begin - ones[begin])
            end = np.where(bit, zeros + ones[end], end - ones[end])
        return end - begin


class FMIndex:
    """Backward search and location in a string of symbols of 1 or more."""

    def __init__(self, symbols: np.ndarray, sample: int = SAMPLE):
        n = len(symbols)
        order = np.concatenate([[n], suffix_array(symbols)])
        self.last = np.where(order > 0, symbols[order - 1] if n else 0, 0)
        self.bits = int(self.last.max()).bit_length() or 1
        self.ranks = WaveletMatrix(self.last, self.bits)
        counts = np.bincount(self.last, minlength=1 << self.bits)
        self.smaller = np.cumsum(counts) - counts
        self.marked = order % sample == 0
        self.marks = np.cumsum(self.marked) - 1
        self.samples = order[self.marked]
        self.rows = n + 1

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        return self.smaller[symbol] + self.ranks.rank(symbol, row)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of rows that start with each pattern (a row of the matrix, filled up to its length)."""
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.rows, np.int64)
        live = np.arange(len(lengths))
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = live[(lengths[live] >= back) & (low[live] < high[live])]
            symbol = patterns[live, lengths[live] - back]
            unknown = symbol >= len(self.smaller)
            high[live[unknown]] = low[live[unknown]]
            live, symbol = live[~unknown], symbol[~unknown]
            low[live], high[live] = self.step(symbol, low[live]), self.step(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of the suffixes in the given rows, by steps back to a sampled one."""
        rows, walked = rows.copy(), np.zeros(len(rows), np.int64)
        live = np.flatnonzero(~self.marked[rows])
        while len(live):
            rows[live] = self.step(self.last[rows[live]], rows[live])
            walked[live] += 1
            live = live[~self.marked[rows[live]]]
        return self.samples[self.marks[rows]] + walked


@dataclass(frozen=True)
class Windows:
    """Distinct windows of a block of items: word numbers per window, and the items that have each."""

    vocabulary: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    items: tuple[tuple[str, ...], ...]


def _pairs(size: int):
    """Windows of items as the bytes of their word hashes, with the item's id."""

    def run(batches):
        for batch in batches:
            buffer, starts = X.text_bytes(batch.column(1))
            _, _, hashes, rows = X.words(buffer, starts, X.ALPHANUMERIC)
            data, windows, owners = hashes.tobytes(), [], []
            for k in range(len(rows) - 1):
                first, last = int(rows[k]), int(rows[k + 1])
                for at in range(first, max(last - size + 1, first + 1) if last > first else first):
                    windows.append(data[8 * at : 8 * min(at + size, last)])
                    owners.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), batch.column(0).take(pa.array(owners, pa.int64()))], ["words", "item"])

    return run


def stored_windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> tuple[str, int]:
    """The folder of the windows' blocks, and how many there are."""
    plain = items.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    blocks = max(1, -(-X.volume(plain, "text") // block_bytes))
    pairs = plain.mapInArrow(_pairs(size), "words binary, item string").distinct().withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    return X.stored_blocks(pairs.repartition(blocks, "block").sortWithinPartitions("block", "words", "item"), "block", "decontam-windows"), blocks


def windows_of(pairs: pa.Table | None) -> Windows:
    """The distinct windows of a block's sorted pairs."""
    words = pairs.column("words").to_pylist() if pairs is not None else []
    items = pairs.column("item").to_pylist() if pairs is not None else []
    found: dict[bytes, list[str]] = {}
    for window, item in zip(words, items):
        found.setdefault(window, []).append(item)
    lengths = np.array([len(w) // 8 for w in found], np.int64)
    vocabulary, numbers = np.unique(np.frombuffer(b"".join(found), np.uint64), return_inverse=True)
    patterns = np.zeros((len(found), int(lengths.max(initial=0))), np.int64)
    patterns[np.arange(patterns.shape[1]) < lengths[:, None]] = numbers + 2
    return Windows(vocabulary, patterns, lengths, tuple(map(tuple, found.values())))


@functools.lru_cache(1)
def _block(folder: str, number: int) -> Windows:
    return windows_of(X.read_block(folder, "block", number))


def hits_of(hashes: np.ndarray, rows: np.ndarray, windows: Windows):
    """Whether each word of a chunk (hashes, first word per row) is hit, and the (row, window) pairs found."""
    none = np.zeros(len(hashes), bool), np.zeros((0, 2), np.int64)
    if not len(hashes) or not len(windows.lengths):
        return none
    at = np.minimum(np.searchsorted(windows.vocabulary, hashes), len(windows.vocabulary) - 1)
    known = windows.vocabulary[at] == hashes
    run_begin, run_end, _ = X.spans(known, rows)
    long_enough = run_end - run_begin >= windows.lengths.min()
    run_begin, run_end = run_begin[long_enough], run_end[long_enough]
    if not len(run_begin):
        return none
    sizes = run_end - run_begin
    first = np.cumsum(sizes + 1) - sizes - 1
    word = np.full(int(sizes.sum()) + len(sizes), -1, np.int64)
    inside = np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    word[inside] = np.repeat(run_begin - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    symbols = np.where(word >= 0, at[word] + 2, 1)
    index = FMIndex(symbols)
    low, high = index.search(windows.patterns, windows.lengths)
    times = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(times)), times)
    suffix_rows = np.repeat(low - np.cumsum(times) + times, times) + np.arange(len(which))
    place = word[index.locate(suffix_rows)]
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + windows.lengths[which], -1)
    hit = np.cumsum(change[:-1]) > 0
    owner = np.searchsorted(rows, place, "right") - 1
    return hit, np.unique(np.stack([owner, which], 1), axis=0)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("first", pa.int32())])


def _marker(folder: str, blocks: int, at_text: int):
    def group_rows(chunks):
        """``chunks`` are ``(columns, bytes, starts)``; their words meet the blocks one after the other."""
        worded = [X.words(data, at, X.ALPHANUMERIC) for _, data, at in chunks]
        hits = [np.zeros(len(hashes), bool) for _, _, hashes, _ in worded]
        items: list[list[set]] = [[set() for _ in range(len(rows) - 1)] for *_, rows in worded]
        for number in range(blocks):
            windows = _block(folder, number)
            for k, (_, _, hashes, rows) in enumerate(worded):
                hit, pairs = hits_of(hashes, rows, windows)
                hits[k] |= hit
                for row, window in pairs.tolist():
                    items[k][row].update(windows.items[window])
        for (columns, _, at), (begin, end, _, rows), hit, own in zip(chunks, worded, hits, items):
            a, b, owner = X.spans(hit, rows)
            row = np.repeat(np.arange(len(rows) - 1), np.diff(owner))
            fields = (begin[a] - at[row], end[b - 1] - at[row], b - a, a - rows[row])
            spans = pa.StructArray.from_arrays([pa.array(f, pa.int32()) for f in fields], fields=list(_SPAN))
            lists = pa.ListArray.from_arrays(pa.array(owner, pa.int32()), spans)
            yield [*columns, pa.array(np.diff(rows)), lists, pa.array([sorted(i) for i in own], pa.list_(pa.string()))]

    def run(batches):
        for batch in batches:
            buffer, starts = X.text_bytes(batch.column(at_text))
            names, group = [*batch.schema.names, "n_words", "spans", "items"], []
            for first, last, data, at in X.chunks(buffer, starts, SHARD_BYTES):
                group.append(([c.slice(first, last - first) for c in batch.columns], data, at))
                if len(group) == GROUP:
                    yield from (pa.RecordBatch.from_arrays(c, names) for c in group_rows(group))
                    group = []
            if group:
                yield from (pa.RecordBatch.from_arrays(c, names) for c in group_rows(group))
        X.give_back()

    return run


def marked(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add ``n_words``, the hit ``spans`` (bytes ``start`` to ``end``, number of ``words``, ``first`` word) and the ``items`` found."""
    new = {"n_words": "long", "spans": "array<struct<start:int,end:int,words:int,first:int>>", "items": "array<string>"}
    clash = set(new) & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    folder, blocks = stored_windows(items, item_id, item_text, window, block_bytes)
    added = T.StructType.fromDDL(", ".join(f"{n} {k}" for n, k in new.items()))
    schema = T.StructType([*docs.schema.fields, *added.fields])
    return docs.mapInArrow(_marker(folder, blocks, docs.columns.index(text)), schema)


def n_hit():
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])


def contaminated():
    """At least one word in twenty is hit."""
    return (n_hit() > 0) & (20 * n_hit() >= F.col("n_words"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = marked(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("row"), "text")
    kept = marked(rows, items).where(~contaminated())
    return kept.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))


def cut(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the hit spans taken out of the text."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        result = []
        for plain, ranges in zip(texts.to_pylist(), spans.to_pylist()):
            data, parts, at = (plain or "").encode(), [], 0
            for r in ranges:
                parts.append(data[at : r["start"]])
                at = r["end"]
            result.append(plain and b"".join([*parts, data[at:]]).decode())
        return pa.array(result, pa.string())

    return marked(rows, items).withColumn("text", without("text", "spans")).select("row.*", F.col("text").alias("_text")).withColumn(text, F.col("_text")).drop("_text")
