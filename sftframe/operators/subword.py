"""Subword vocabulary: byte pairs merged by count, and text encoded by the merges.

A piece is a run of bytes, written as upper-case hex digits.  A word (a pre-token with the number of its occurrences)
starts as the ids of its bytes.  Training merges, again and again, the pair of neighbouring pieces with
the highest count (ties: smaller left, then smaller right piece) whose bytes are not a piece yet.  Ids 0 to 255 are the
bytes, then come merges by rank, then EOS and PAD.

One merge a job would be slow, so a round takes as many merges as come out the same when they are made one by one: the
next best pair may follow if it shares no piece with the ones before, so its count stays, and if its count is above
what any pair that those bring about can have, which counts of three pieces in a row tell.  The driver sees the
``CANDIDATES`` best pairs of a round; words and counts stay distributed, and only distinct words are ever looked at.

Encoding keeps a word's pieces as a linked list and its pairs in a heap by rank, so it takes n log n steps for n
bytes.  Merges and pieces go to the tasks as a broadcast of at most ``MOST_MERGES`` entries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftframe.functions.arrays import once
from sftframe.functions.text import pre_tokens
from sftframe.operators.lookup import lookup_arrays
from sftframe.options import EOS_TOKEN, PAD_TOKEN
from sftframe.session import cut_lineage, ship_package
from sftframe.sources.tables import require_columns

CANDIDATES = 256
MOST_MERGES = 200_000
#: Merges after which the words are written anew.
WRITE_EVERY = 64
#: Words whose ids a task keeps.
MOST_WORDS = 200_000
MERGES = "rank INT, left STRING, right STRING, piece STRING, n BIGINT"
WORDS = "pieces ARRAY<INT>, n BIGINT"
BYTES = [f"{b:02X}" for b in range(256)]
#: Bits that hold the id of a piece: three ids fit a key.
_BITS = 18
#: Sums that a task holds before it adds up equal ones.
MOST_HELD = 1_000_000


def bracketed(words: DataFrame) -> DataFrame:
    """``pieces, n``: the bytes of each distinct token as ids, from ``token, n``."""
    require_columns(words, ["token", "n"], "the words")
    some = words.where(F.length("token") > 0)
    return _in_arrow(some.select("token", F.col("n").cast("bigint").alias("n")), _byte_lists, WORDS)


def _in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def _byte_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = pc.cast(batch["token"], pa.large_binary())
        offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
        flat = np.frombuffer(data.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(data) else np.zeros(0, np.uint8)
        lists = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pa.array(flat.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([lists, batch["n"]], names=["pieces", "n"])


def _marked(batch: pa.RecordBatch, merges: list[tuple[int, int, int]]) -> np.ndarray:
    """The words of a batch one behind the other, each followed by -1, after merges ``(left, right, new id)`` in turn."""
    lists = batch["pieces"]
    flat = lists.flatten().to_numpy().astype(np.int64)
    flat = np.insert(flat, np.cumsum(pc.list_value_length(lists).to_numpy()), -1)
    for left, right, new in merges:
        at = np.flatnonzero((flat[:-1] == left) & (flat[1:] == right))
        if len(at):
            # Of pairs that overlap, as in a run of one piece, every second one is merged, from the left.
            first = np.concatenate([[True], np.diff(at) > 1])
            order = np.arange(len(at))
            at = at[(order - np.maximum.accumulate(np.where(first, order, 0))) % 2 == 0]
            flat[at] = new
            flat = np.delete(flat, at + 1)
    return flat


def _merged_words(merges: list[tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = _marked(batch, merges)
            ends = np.flatnonzero(flat < 0) - np.arange(len(batch))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat[flat >= 0].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([lists, batch["n"]], names=["pieces", "n"])

    return run


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts[order], starts)


def _grams(merges: list[tuple[int, int, int]]):
    """Counts of two and of three pieces in a row, added up in a task; ids take ``_BITS`` bits of a key, and a third one
    in front is one higher."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            flat = _marked(batch, merges)
            n = batch["n"].to_numpy()[np.minimum(np.cumsum(flat < 0), max(len(batch) - 1, 0))] if len(batch) else flat
            two = (flat[:-1] << _BITS) | flat[1:]
            pair = (flat[:-1] >= 0) & (flat[1:] >= 0)
            three = ((flat[:-2] + 1) << 2 * _BITS) | two[1:]
            triple = pair[:-1] & pair[1:]
            held.append(_summed(np.concatenate([two[pair], three[triple]]), np.concatenate([n[:-1][pair], n[:-2][triple]])))
            rows += len(held[-1][0])
            if rows > MOST_HELD:
                held = [_summed(*map(np.concatenate, zip(*held)))]
                rows = 0
        if held:
            keys, counts = _summed(*map(np.concatenate, zip(*held)))
            for at in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at : at + 100_000], pa.int64()) for x in (keys, counts)], names=["gram", "n"])

    return run


def pair_counts(words: DataFrame, merges: list[tuple[int, int, int]] = (), names: list[str] = BYTES) -> DataFrame:
    """``left, right, n, wider`` of ``pieces, n``: occurrences of neighbouring pieces, and the most that a pair of theirs
    with one more neighbour has.

    ``merges`` that the words still lack are made on the way; ``names`` has the pieces by id.
    """
    # A word of one piece has no pair and never will.
    several = words.where(F.size("pieces") > 1)
    counts = _in_arrow(several, _grams(list(merges)), "gram BIGINT, n BIGINT").groupBy("gram").agg(F.sum("n").alias("n"))
    mask, third = F.lit((1 << 2 * _BITS) - 1), F.shiftright("gram", 2 * _BITS)
    none = F.lit(None).cast("bigint")
    before = F.shiftleft(third - 1, _BITS).bitwiseOR(F.shiftright(F.col("gram").bitwiseAND(mask), _BITS))
    own = F.struct(F.col("gram").alias("pair"), F.col("n").alias("n"), none.alias("m"))
    inner = [F.struct(pair.alias("pair"), none.alias("n"), F.col("n").alias("m")) for pair in (F.col("gram").bitwiseAND(mask), before)]
    sides = counts.select(F.inline(F.when(third > 0, F.array(*inner)).otherwise(F.array(own))))
    pairs = sides.groupBy("pair").agg(F.sum("n").alias("n"), F.coalesce(F.max("m"), F.lit(0)).alias("wider"))
    shown = F.split(F.lit(",".join(names)), ",")
    left, right = F.shiftright("pair", _BITS).cast("int"), F.col("pair").bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
    return pairs.select(F.get(shown, left).alias("left"), F.get(shown, right).alias("right"), "n", "wider")


def _settled(best: list, room: int) -> list:
    """The leading pairs that would be merged in this order one by one as well."""
    taken, pieces, limit = [], set(), 0
    for row in best:
        own = {row["left"], row["right"], row["left"] + row["right"]}
        if taken and row["left"] + row["right"] in {t["left"] + t["right"] for t in taken}:
            continue
        if len(taken) == room or own & pieces or row["n"] <= limit:
            break
        taken.append(row)
        pieces |= own
        limit = max(limit, row["wider"])
    return taken


def train(words: DataFrame, merges: int, least: int = 2) -> DataFrame:
    """``rank, left, right, piece, n`` of up to ``merges`` merges over ``token, n``; pairs below ``least`` stay apart."""
    if not 0 <= merges <= MOST_MERGES:
        raise ValueError(f"merges must be between 0 and {MOST_MERGES}")
    spark = words.sparkSession
    found: list[tuple] = []
    names = list(BYTES)
    id_of = {name: k for k, name in enumerate(names)}
    pending: list[tuple[int, int, int]] = []
    left = cut_lineage(bracketed(words.groupBy("token").agg(F.sum("n").alias("n"))))
    while len(found) < merges:
        pairs = pair_counts(left, pending, names).where(F.col("n") >= least)
        if found:
            pairs = pairs.where(~F.concat("left", "right").isin([f[3] for f in found]))
        best = pairs.orderBy(F.desc("n"), "left", "right").limit(CANDIDATES).collect()
        taken = _settled(best, merges - len(found))
        if not taken:
            break
        for row in taken:
            piece = row["left"] + row["right"]
            pending.append((id_of[row["left"]], id_of[row["right"]], len(names)))
            found.append((len(found), row["left"], row["right"], piece, row["n"]))
            id_of[piece] = len(names)
            names.append(piece)
        # Merging again what a few rounds have merged is cheaper than to write the words each time.
        if len(pending) >= WRITE_EVERY:
            left, pending = cut_lineage(_in_arrow(left, _merged_words(pending), WORDS).where(F.size("pieces") > 1)), []
    return spark.createDataFrame(found, MERGES)


def vocabulary(merges: DataFrame, eos: str = EOS_TOKEN, pad: str = PAD_TOKEN) -> DataFrame:
    """``id, piece, special``: bytes, merged pieces and the two special tokens, all as hex digits."""
    spark = merges.sparkSession
    bytes_ = spark.range(256).select(F.col("id").cast("int").alias("id"), F.lpad(F.hex("id"), 2, "0").alias("piece"), F.lit(False).alias("special"))
    merged = merges.select((F.col("rank") + 256).alias("id"), "piece", F.lit(False).alias("special"))
    names = F.posexplode(F.array(F.lit(eos), F.lit(pad))).alias("at", "token")
    added = merges.agg(F.count("*").cast("int").alias("size")).select("size", names)
    special = added.select((F.col("size") + 256 + F.col("at")).alias("id"), F.hex(F.encode("token", "UTF-8")).alias("piece"), F.lit(True).alias("special"))
    return bytes_.unionByName(merged).unionByName(special)


@dataclass(frozen=True)
class Merger:
    """Ids of merged pairs of ids; a smaller id was merged earlier, so it is the rank, too."""

    pairs: dict[tuple[int, int], int]
    eos: str
    eos_id: int

    def ids(self, word: str) -> list[int]:
        if word == self.eos:
            return [self.eos_id]
        pieces = list(word.encode())
        after = list(range(1, len(pieces) + 1))
        before = list(range(-1, len(pieces) - 1))
        heap = [(new, k) for k, pair in enumerate(zip(pieces, pieces[1:])) if (new := self.pairs.get(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            new, at = heapq.heappop(heap)
            right = after[at]
            # A pair that an earlier merge has changed is out of date.
            if pieces[at] < 0 or right == len(pieces) or self.pairs.get((pieces[at], pieces[right])) != new:
                continue
            pieces[at], pieces[right] = new, -1
            after[at] = after[right]
            if after[at] < len(pieces):
                before[after[at]] = at
                if (wider := self.pairs.get((new, pieces[after[at]]))) is not None:
                    heapq.heappush(heap, (wider, at))
            if before[at] >= 0 and (wider := self.pairs.get((pieces[before[at]], new))) is not None:
                heapq.heappush(heap, (wider, before[at]))
        return [p for p in pieces if p >= 0]


def merger(merges: DataFrame, eos: str = EOS_TOKEN) -> Merger:
    """The merges as ids; the driver reads at most ``MOST_MERGES`` rows."""
    rows = sorted(merges.select("rank", "left", "right", "piece").limit(MOST_MERGES + 1).collect())
    if len(rows) > MOST_MERGES:
        raise ValueError(f"more than {MOST_MERGES} merges")
    id_of = {f"{b:02X}": b for b in range(256)} | {r["piece"]: 256 + r["rank"] for r in rows}
    return Merger({(id_of[r["left"]], id_of[r["right"]]): 256 + r["rank"] for r in rows}, eos, 256 + len(rows))


def encode(df: DataFrame, columns: dict[str, str], merges: DataFrame, eos: str = EOS_TOKEN) -> DataFrame:
    """Add arrays of piece ids for text columns; a null text has null ids.  EOS is one piece of its own."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(merger(merges, eos))
    seen: dict[str, np.ndarray] = {}

    @F.arrow_udf("array<int>")
    def pieces(words: pa.Array) -> pa.Array:
        if len(seen) > MOST_WORDS:
            seen.clear()
        ids, sizes = [], np.zeros(len(words), np.int64)
        flat = words.flatten().to_pylist()
        for word in set(flat).difference(seen):
            seen[word] = np.array(shared.value.ids(word), np.int32)
        ids = [seen[word] for word in flat]
        per_word = np.concatenate([[0], np.cumsum([len(i) for i in ids], dtype=np.int64)])
        sizes = np.concatenate([[0], np.cumsum(np.nan_to_num(words.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64))])
        offsets = pa.array(per_word[sizes].astype(np.int32), mask=np.append(words.is_null().to_numpy(zero_copy_only=False), False))
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*ids, np.zeros(0, np.int32)]), pa.int32()))

    made = df
    for k, text in enumerate(columns):
        # A column of its own, so that a function on the ids does not have them made again for each of its uses.
        made = made.select("*", once(pieces(pre_tokens(F.col(text), eos))).alias(f"_ids_{k}"))
    return made.withColumns({ids: F.col(f"_ids_{k}") for k, ids in enumerate(columns.values())}).drop(*[f"_ids_{k}" for k in range(len(columns))])


def decode(df: DataFrame, columns: dict[str, str], vocab: DataFrame, skip_special: bool = False) -> DataFrame:
    """Add text columns for arrays of piece ids; a null array has a null text.  An id that the vocabulary lacks fails the job."""
    shown = vocab.select("id", F.when(F.lit(skip_special) & F.col("special"), "").otherwise(F.col("piece")).alias("piece"))
    hexed = {ids: f"_hex_{text}" for ids, text in columns.items()}
    found = lookup_arrays(df, shown, "id", [(ids, "piece", name, None) for ids, name in hexed.items()])
    joined = {text: F.decode(F.unhex(F.array_join(hexed[ids], "")), "UTF-8") for ids, text in columns.items()}
    whole = {text: F.when(F.col(ids).isNotNull(), joined[text]) for ids, text in columns.items()}
    return found.withColumns(whole).drop(*hexed.values())
