"""Which tokens of two tokenizers cover the same bytes, and how often each pair of ids meets in the whole corpus.

Both tokenizers work on a text with a space in front: A is a byte-level BPE (``tokenizers``), B a BPE with byte
fallback (``sentencepiece``, which adds that space itself).  Byte offsets where tokens of both end cut a document into
groups.  The ends of a chunk of documents are one rising list per tokenizer; the shorter list searches the longer one
by galloping: from the place of the head of its block in doubling steps, then by halving, heads of blocks first.  Where it finds itself, a
group ends; the tokens of the longer list that a token overlaps lie between the ranks of its two ends.

Tokens never cross the words that both tokenizers cut a text into first, so each distinct word is encoded once per
task (up to ``MOST_WORDS`` are kept).  Texts with signs on which the word rules of Unicode versions could differ are
encoded whole.

Counts over the corpus: a task puts its documents together to units of ``UNIT_LINKS`` links and sends each unit's
distinct id pairs, with the number of documents that link them.  They are summed per pair; units get the sums of their
pairs back.  Rows between tasks follow the distinct pairs of units, not the links; an A id has at most as many pairs as
B has ids.

Null, empty and unalignable texts (whose tokens' bytes are not the text) have no tokens.  Ids may be null, repeated
and of any type; each row is a document.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import math
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftframe.llm import textcore as X

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
UNIT_LINKS = 2_000_000
MOST_WORDS = 400_000
TASK_BYTES = 24 << 20
BLOCK = 8

#: The word rule of the byte-level BPE.
WORDS_A = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Spaces and what follows them: no piece of B has a space after another sign.
WORDS_B = re.compile(r" *[^ ]+| +")
#: Texts of these signs alone are cut by ``WORDS_A``; their classes are the same in all versions of Unicode in use.
_SETTLED = re.compile("[\t\n\r\x20-\x7e\xa0-ɏͰ-ͷ΄-ϿЀ-ԯ‐-‧‰-⁞€　-。ぁ-ゖァ-ヺ一-龥가-힣！-～]*")

_UNIT = "unit long, a array<int>, b array<int>, docs array<int>, n_entries long, entries binary, times binary, info binary"
_UNIT_SCHEMA = pa.schema(
    [("unit", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("docs", pa.list_(pa.int32())), ("n_entries", pa.int64()), ("entries", pa.binary()), ("times", pa.binary()), ("info", pa.binary())]
)


class _Words:
    """Ids of words seen so far, one flat array with offsets; a word whose tokens' bytes are not its own is marked."""

    def __init__(self, encode, content: list[bytes]):
        self.encode, self.content = encode, content
        self.sizes = np.array([len(c) for c in content])
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.ends, self.good = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, bool)

    def add(self, words: list[str]) -> None:
        lists = self.encode(words)
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(count.sum()))
        known = len(self.number)
        first = int(self.ends[known - 1]) if known else 0
        ends = first + np.cumsum(count)
        self.ids = _with_room(self.ids, int(ends[-1]))
        self.ids[first : ends[-1]] = flat
        self.ends, self.good = _with_room(self.ends, known + len(words)), _with_room(self.good, known + len(words))
        self.ends[known : known + len(words)] = ends
        plain = [w.encode() for w in words]
        bytes_of = np.concatenate([[0], np.cumsum(self.sizes[flat])])[np.concatenate([[0], ends - first])]
        right = np.diff(bytes_of) == np.fromiter(map(len, plain), np.int64, len(plain))
        if not right.all() or b"".join(map(self.content.__getitem__, flat.tolist())) != b"".join(plain):
            right = np.array([b"".join(map(self.content.__getitem__, ids)) == w for ids, w in zip(lists, plain)])
        self.good[known : known + len(words)] = right
        self.number.update(zip(words, range(known, known + len(words))))

    def numbers(self, words: list[str]) -> np.ndarray:
        """Numbers of words; new ones are encoded in one batch."""
        new = list(set(words).difference(self.number))
        if new:
            self.add(new)
        return np.array(list(map(self.number.__getitem__, words)), np.int64)

    def tokens(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words one after the other, and how many each word has."""
        begin = np.where(numbers > 0, self.ends[numbers - 1], 0)
        count = self.ends[numbers] - begin
        first = np.cumsum(count) - count
        return self.ids[np.repeat(begin - first, count) + np.arange(int(count.sum()))], count


def _with_room(values: np.ndarray, size: int) -> np.ndarray:
    return values if size <= len(values) else np.concatenate([values, np.zeros(max(size, 2 * len(values)) - len(values), values.dtype)])


def _byte_of_sign() -> dict[str, int]:
    """The sign for each byte in a byte-level vocabulary: printable ones stand for themselves, the others follow 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Tokenizers:
    """Both tokenizers from the bytes of their files."""

    def __init__(self, file_a: bytes, file_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(file_a.decode())
        self.a.encode_special_tokens = True
        byte_of = _byte_of_sign()
        shown = {i: p for p, i in json.loads(file_a)["model"]["vocab"].items()}
        content_a = [bytes(byte_of[c] for c in shown[i]) if i in shown and all(c in byte_of for c in shown[i]) else b"" for i in range(max(shown) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        size = self.b.get_piece_size()
        content_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.b.id_to_piece(list(range(size))))
        ]
        lone = self.b.piece_to_id("▁")

        def encode_a(words):
            return [e.ids for e in self.a.encode_batch(words, add_special_tokens=False)]

        def encode_b(words):
            found = self.b.encode([w[1:] for w in words], num_threads=1)
            # The space that stands in front is the word itself here.
            return [ids if len(w) > 1 else [lone] for w, ids in zip(words, found)]

        self.words = _Words(encode_a, content_a), _Words(encode_b, content_b)


@functools.lru_cache(1)
def _tokenizers(file_a: bytes, file_b: bytes) -> Tokenizers:
    return Tokenizers(file_a, file_b)


def _ranks(values: np.ndarray, among: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many of ``among`` are below each value; at least ``low`` are."""
    low, high, size = low.copy(), np.empty(len(values), np.int64), len(among)
    left, step = np.arange(len(values)), 1
    while len(left):
        probe = np.minimum(low[left] + step, size)
        reached = (probe == size) | (among[np.minimum(probe, size - 1)] >= values[left])
        high[left[reached]] = probe[reached]
        low[left[~reached]] = probe[~reached] + 1
        left, step = left[~reached], 2 * step
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        below = among[middle] < values[left]
        low[left[below]] = middle[below] + 1
        high[left[~below]] = middle[~below]
        left = left[low[left] < high[left]]
    return low


def gallop(short: np.ndarray, long: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """For two strictly rising lists: the rank of each element of the shorter in the longer, and whether it is there."""
    if not len(short) or not len(long):
        return np.zeros(len(short), np.int64), np.zeros(len(short), bool)
    low = np.zeros(1, np.int64)
    # Heads of blocks of blocks first; every element then starts from the place of the head of its own block.
    for stride in (block**k for k in reversed(range(math.ceil(math.log(len(short), block)) if len(short) > 1 else 1))):
        heads = short[::stride]
        low = _ranks(heads, long, np.repeat(low, block)[: len(heads)])
    rank = low
    return rank, (rank < len(long)) & (long[np.minimum(rank, len(long) - 1)] == short)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray):
    """``(A numbers, B numbers)`` of all overlapping tokens, and for both sides whether a token's end is common."""
    swap = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    rank, common = gallop(short, long)
    # A token begins where the one before ends, so it overlaps from the first end beyond that to the first at its own end.
    begin = np.concatenate([[0], rank[:-1] + common[:-1]]) if len(rank) else rank
    count = rank - begin + 1
    driver = np.repeat(np.arange(len(short)), count)
    other = np.arange(len(driver)) + np.repeat(begin - (np.cumsum(count) - count), count)
    there = np.zeros(len(long), bool)
    there[rank[common]] = True
    return (other, driver, there, common) if swap else (driver, other, common, there)


_DIGITS = 7


@functools.cache
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    shown = [str(k).encode() for k in range(size)]
    signs = np.frombuffer(b"".join(s.ljust(_DIGITS) for s in shown), np.uint8).reshape(size, _DIGITS)
    return signs, np.array([len(s) for s in shown])


def _written(ids_a, ids_b, ends_group_a, ends_group_b, docs_a, docs_b, size: int):
    """``a1,a2|b1;...`` of all groups of a chunk as bytes (one sign more at each document's end), and documents' ends."""
    group_a = np.cumsum(ends_group_a) - ends_group_a
    group_b = np.cumsum(ends_group_b) - ends_group_b
    groups = int(ends_group_a.sum())
    sizes_a, sizes_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    place_a = np.arange(len(ids_a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]
    place_b = np.arange(len(ids_b)) + np.cumsum(sizes_a)[group_b]
    ids, signs = np.empty(len(ids_a) + len(ids_b), np.int64), np.empty(len(ids_a) + len(ids_b), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    signs[place_a], signs[place_b] = np.where(ends_group_a, ord("|"), ord(",")), np.where(ends_group_b, ord(";"), ord(","))
    digits, lengths = _decimals(size)
    length = lengths[ids]
    end = np.cumsum(length + 1)
    first = end - length - 1
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    for place in range(int(length.max(initial=0))):
        some = np.flatnonzero(length > place)
        out[first[some] + place] = digits[ids[some], place]
    out[end - 1] = signs
    return out.tobytes(), np.concatenate([[0], end])[np.cumsum(docs_a) + np.cumsum(docs_b)]


def _chunk(texts: list[str | None], both: Tokenizers):
    """Documents of a chunk: sizes, groups, links, hashes; and the id pairs that each links, with how often."""
    bodies = [" " + t if t else "" for t in texts]
    words_a, words_b = both.words
    for words in both.words:
        if len(words.number) > MOST_WORDS:
            words.clear()
    rows_a = [[] if not t else WORDS_A.findall(t) if _SETTLED.fullmatch(t) else [t] for t in bodies]
    rows_b = [WORDS_B.findall(t) for t in bodies]
    found = []
    for words, rows in ((words_a, rows_a), (words_b, rows_b)):
        count = np.array([len(r) for r in rows])
        numbers = words.numbers([w for r in rows for w in r])
        bad = np.bincount(np.repeat(np.arange(len(rows)), count), ~words.good[numbers], minlength=len(rows)) > 0
        found.append((numbers, count, bad))
    good = ~(found[0][2] | found[1][2])
    sides = []
    for words, (numbers, count, _) in zip(both.words, found):
        row = np.repeat(np.arange(len(texts)), count)
        kept = good[row]
        ids, per_word = words.tokens(numbers[kept])
        per_doc = np.bincount(row[kept], per_word, minlength=len(texts)).astype(np.int64)
        sides.append((ids, np.cumsum(words.sizes[ids]), per_doc))
    (ids_a, ends_a, docs_a), (ids_b, ends_b, docs_b) = sides
    at_a, at_b, common_a, common_b = overlaps(ends_a, ends_b)
    doc_of_a = np.repeat(np.arange(len(texts)), docs_a)
    n_groups = np.bincount(doc_of_a[common_a], minlength=len(texts))
    doc = doc_of_a[at_a]
    n_links = np.bincount(doc, minlength=len(texts))
    text, cuts = _written(ids_a, ids_b, common_a, common_b, docs_a, docs_b, max(len(words_a.sizes), len(words_b.sizes)))
    starts = np.concatenate([[0], cuts[:-1]])
    shas = [hashlib.sha256(text[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(starts.tolist(), cuts.tolist())]
    pairs, which = np.unique((ids_a[at_a].astype(np.int64) << 32) | ids_b[at_b], return_inverse=True)
    entries, times = np.unique(doc * np.int64(max(len(pairs), 1)) + which, return_counts=True)
    entry_doc, entry = np.divmod(entries, max(len(pairs), 1))
    per_doc = np.bincount(entry_doc, minlength=len(texts))
    return [docs_a, docs_b, n_groups, n_links, per_doc], shas, pairs, entry, times


_SIZES = ("n_a", "n_b", "n_groups", "n_links", "entries")


def _units(files, unit_links: int):
    def emit(unit, ids, chunks):
        pairs, at = np.unique(np.concatenate([c[2] for c in chunks]), return_inverse=True)
        first = np.cumsum([0, *(len(c[2]) for c in chunks)])
        entries = np.concatenate([at[f : f + len(c[2])][c[3]] for f, c in zip(first, chunks)])
        times = np.concatenate([c[4] for c in chunks])
        docs = np.bincount(entries, minlength=len(pairs))
        info = pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids), *(pa.array(np.concatenate([c[0][k] for c in chunks])) for k in range(5)), pa.array([s for c in chunks for s in c[1]], pa.string())],
            names=["doc_id", *_SIZES, "groups_sha256"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, info.schema) as out:
            out.write_batch(info)
        row = (unit, (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), docs.astype(np.int32), len(entries), X.pack(entries.astype(np.uint32)), X.pack(times.astype(np.uint32)), sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _UNIT_SCHEMA)], schema=_UNIT_SCHEMA)

    def run(batches):
        both = _tokenizers(*files.value)
        unit, ids, chunks, links = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            _, starts = X.text_bytes(batch.column(1))
            for first, last, _, _ in X.chunks(np.zeros(0, np.uint8), starts):
                ids.append(batch.column(0).slice(first, last - first))
                chunks.append(_chunk(batch.column(1).slice(first, last - first).to_pylist(), both))
                links += int(chunks[-1][0][3].sum())
                if links >= unit_links:
                    yield emit(unit, ids, chunks)
                    unit, ids, chunks, links = unit + 1, [], [], 0
        if chunks:
            yield emit(unit, ids, chunks)
        X.give_back()

    return run


def _finish(batches):
    """Per unit: sum over each document's links what the corpus says about their pairs."""
    for batch in batches:
        for row in batch.to_pylist():
            info = pa.ipc.open_stream(row["info"]).read_next_batch()
            entries, times = (X.unpack(row[c], np.uint32, row["n_entries"]).astype(np.int64) for c in ("entries", "times"))
            count, best = np.array(row["counts"] or [], np.int64), np.array(row["best"] or [], bool)
            doc = np.repeat(np.arange(info.num_rows), info.column("entries").to_numpy())
            # Exact sums of whole numbers: by pieces of rows, never as doubles.
            first = np.concatenate([[0], np.cumsum(info.column("entries").to_numpy())])
            sums = np.concatenate([[0], np.cumsum(times * count[entries])])
            n_best = np.bincount(doc[best[entries]], times[best[entries]], minlength=info.num_rows).astype(np.int64)
            columns = {n: info.column(n) for n in info.schema.names if n != "entries"}
            columns |= {"n_best": pa.array(n_best), "count_sum": pa.array(sums[first[1:]] - sums[first[:-1]])}
            names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)
    X.give_back()


def units(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path_a: str = TOKENIZER_A, path_b: str = TOKENIZER_B, unit_links: int = UNIT_LINKS) -> DataFrame:
    """The aligned documents in units, stored: each unit's distinct id pairs, and what its documents link."""
    contents = []
    for path in (path_a, path_b):
        with open(path, "rb") as file:
            contents.append(file.read())
    files = docs.sparkSession.sparkContext.broadcast(tuple(contents))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return X.stored(rows.mapInArrow(_units(files, unit_links), _UNIT), "align-units")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, n, best``: in how many documents the two ids are linked, and whether that is the most for A's id."""
    pairs = aligned.select(F.explode(F.arrays_zip("a", "b", "docs")).alias("p")).select("p.*")
    counts = pairs.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    return X.stored(counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a"))), "align-counts")


def digest(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document its tokens, groups and links, and how common its links are in all documents."""
    aligned = units(docs, doc_id, **options)
    counts = pair_counts(aligned)
    asked = aligned.select("unit", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select("unit", "at", "p.a", "p.b")
    found = asked.join(counts, ["a", "b"]).groupBy("unit").agg(F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("found"))
    answers = found.select("unit", F.col("found.n").alias("counts"), F.col("found.best").alias("best"))
    rows = aligned.select("unit", "n_entries", "entries", "times", "info").join(answers, "unit", "left")
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    return rows.mapInArrow(_finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
