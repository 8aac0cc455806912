"""SentencePiece encoding and decoding with the N best segmentations of every text.

A text gets one space in front and is cut into units: a run of spaces with what follows up to the next one.  No piece
of a vocabulary may reach over such a cut, so a text's segmentations are those of its units put together.  The
lattice of a unit has an edge for every piece that matches; a character that no piece matches has an unknown edge,
written as its bytes.  Distinct units of a chunk go through the forward Viterbi pass together.

The forward scores are an exact heuristic for a backward A-star search: a partial path from the end has the
priority of its own score plus the best forward score of where it stands, so complete paths come out in order.  In
a text only the ``N - 1`` unit occurrences that lose least by their second-best path can differ among the N best;
the search runs on those and their alternatives are combined.

A null text stays null, an empty one has no pieces and one segmentation.  Of equal scores the segmentation wins
whose later differences come first.  Decoding gives back the text byte for byte, whatever characters it has.
The model is a fixed vocabulary file; its pieces are broadcast, its path is a parameter.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.llm import textcore as X

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BEST = 4
UNKNOWN_PENALTY = 10.0
_SPACE = "▁"
_SPACE_BYTE = np.uint8(0x20)


@dataclass(frozen=True)
class Vocabulary:
    """Bytes of every id, matching tables by length of piece, byte ids, and the score of an unknown character."""

    piece_bytes: tuple[bytes, ...]
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    longest: np.ndarray
    byte_ids: np.ndarray
    unknown: float

    @functools.cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p in self.piece_bytes])
        return np.frombuffer(b"".join(self.piece_bytes), np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def load(path: str = MODEL) -> Vocabulary:
    """Read the pieces and scores of a model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts, byte_ids, entries = [], np.full(256, -1, np.int64), []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            value = int(piece[1:-1], 16)
            byte_ids[value] = k
            texts.append(bytes([value]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            texts.append(b"")
        else:
            if " " in piece or _SPACE in piece.lstrip(_SPACE):
                raise ValueError(f"piece {piece!r} reaches over the start of a word")
            texts.append(piece.replace(_SPACE, " ").encode())
            entries.append((k, texts[-1], model.get_score(k)))
    if (byte_ids < 0).any():
        raise ValueError("the model has no piece for every byte")
    by_length, longest = {}, np.zeros(1 << 16, np.uint8)
    for length in sorted({len(t) for _, t, _ in entries}):
        own = [(k, t, s) for k, t, s in entries if len(t) == length]
        joined = np.frombuffer(b"".join(t for _, t, _ in own), np.uint8)
        begin = np.arange(len(own)) * length
        keys = X.span_hashes(X.prefix_hashes(joined), begin, begin + length)
        order = np.argsort(keys)
        by_length[length] = (keys[order], np.array([k for k, _, _ in own])[order], np.array([s for _, _, s in own], np.float64)[order])
        if length > 1:
            np.maximum.at(longest, joined[begin].astype(np.int64) * 256 + joined[begin + 1], np.uint8(min(length, 255)))
    return Vocabulary(tuple(texts), by_length, longest, byte_ids, min((s for _, t, s in entries if t.strip()), default=0.0) - UNKNOWN_PENALTY)


class Lattices:
    """Lattices of many units laid one after the other: nodes are byte places, a unit of n bytes has n + 1."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary):
        self.units = len(starts) - 1
        sizes = np.diff(starts)
        unit_end = np.repeat(starts[1:], sizes)
        #: A node's number is its byte place plus the number of units before it.
        shift = np.repeat(np.arange(self.units), sizes)
        self.first = starts[:-1] + np.arange(self.units)
        self.last = starts[1:] + np.arange(self.units)
        sums = X.prefix_hashes(data)
        place = np.arange(len(data))
        follower = np.append(data[1:], np.uint8(0)).astype(np.int64)
        reach = vocabulary.longest[data.astype(np.int64) * 256 + follower]
        unit_begin = np.repeat(starts[:-1], sizes)
        begins, ends, ids, scores, offsets = [], [], [], [], []
        whole = np.where(data < 0x80, 1, np.where(data >= 0xF0, 4, np.where(data >= 0xE0, 3, 2)))
        head = (data & 0xC0) != 0x80
        whole = np.minimum(whole, unit_end - place)
        single = np.zeros(len(data), bool)
        live = place
        for length, (keys, numbers, values) in vocabulary.by_length.items():
            live = place if length <= 1 else live[reach[live] >= length] if length > 2 else place[reach >= length]
            fits = live[live + length <= unit_end[live]]
            wanted = X.span_hashes(sums, fits, fits + length)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            found = keys[at] == wanted
            fits, at = fits[found], at[found]
            begins.append(fits + shift[fits])
            ends.append(fits + shift[fits] + length)
            offsets.append(fits + length - unit_begin[fits])
            ids.append(numbers[at])
            scores.append(values[at])
            single[fits[whole[fits] == length]] = True
        # Stray continuation bytes, which valid text has none of, are unknown characters of their own.
        after_head = np.zeros(len(data), bool)
        for step in (1, 2, 3):
            covered = place[head & (whole > step)] + step
            after_head[covered] = True
        lone = np.flatnonzero(~single & (head | ~after_head))
        begins.append(lone + shift[lone])
        size = np.where(head[lone], whole[lone], 1)
        ends.append(lone + shift[lone] + size)
        offsets.append(lone + size - unit_begin[lone])
        ids.append(-1 - lone)
        scores.append(np.full(len(lone), vocabulary.unknown))
        begin, end, number, score, offset = (np.concatenate(x) for x in (begins, ends, ids, scores, offsets))
        order = np.lexsort((begin, end, offset))
        self.begin, self.end, self.id, self.score = begin[order], end[order], number[order], score[order]
        self._forward(offset[order])

    def _forward(self, offset: np.ndarray) -> None:
        """Best scores from the start of each unit, the best edge into each node, and the loss of the second best."""
        nodes = int(self.last[-1]) + 1 if self.units else 0
        self.best = np.full(nodes, -np.inf)
        self.best[self.first] = 0.0
        self.edge = np.full(nodes, -1, np.int64)
        self.second = np.full(nodes, np.inf)
        self.loss = np.zeros(len(self.begin))
        cuts = np.flatnonzero(np.diff(offset, prepend=-1)) if len(offset) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(offset))):
            value = self.best[self.begin[a:b]] + self.score[a:b]
            end = self.end[a:b]
            group = np.flatnonzero(np.diff(end, prepend=-1))
            node = end[group]
            top = np.maximum.reduceat(value, group)
            self.best[node] = top
            with np.errstate(invalid="ignore"):
                loss = np.repeat(top, np.diff(np.append(group, b - a))) - value
            loss[np.isnan(loss)] = np.inf
            self.loss[a:b] = loss
            # The first edge without loss is the longest one, as edges into a node are sorted by where they begin.
            zero = np.flatnonzero(loss == 0)
            owner = np.searchsorted(group, zero, "right") - 1
            keep = np.ones(len(zero), bool)
            keep[1:] = owner[1:] != owner[:-1]
            self.edge[node[owner[keep]]] = a + zero[keep]
            loss = loss.copy()
            loss[zero[keep]] = np.inf
            self.second[node] = np.minimum.reduceat(loss, group)
        self.into_order = np.argsort(self.end, kind="stable")
        self.into = np.searchsorted(self.end[self.into_order], np.arange(nodes + 1))

    def best_paths(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges of the best path of every unit, where each unit's begin, and the loss of its second-best path."""
        edges, owners, steps = [], [], []
        unit, node = np.arange(self.units), self.last.copy()
        loss = np.full(self.units, np.inf)
        step = 0
        while len(unit):
            live = node > self.first[unit]
            unit, node = unit[live], node[live]
            if not len(unit):
                break
            edge = self.edge[node]
            loss[unit] = np.minimum(loss[unit], self.second[node])
            edges.append(edge)
            owners.append(unit)
            steps.append(np.full(len(unit), -step))
            node = self.begin[edge]
            step += 1
        if not edges:
            return np.zeros(0, np.int64), np.zeros(self.units + 1, np.int64), loss
        edge, owner, back = (np.concatenate(x) for x in (edges, owners, steps))
        order = np.lexsort((back, owner))
        return edge[order], np.searchsorted(owner[order], np.arange(self.units + 1)), loss

    def search(self, unit: int, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best paths of a unit as ``(loss, edges)``, by A-star from its end with the forward scores."""
        first, heap, serial, found = int(self.first[unit]), [(0.0, 0, int(self.last[unit]), None)], 0, []
        while heap and len(found) < n:
            # What a path has lost so far is the best score less its priority (own score plus forward score).
            loss, _, node, path = heapq.heappop(heap)
            if node == first:
                edges = []
                while path is not None:
                    edges.append(path[0])
                    path = path[1]
                found.append((loss, tuple(edges)))
                continue
            for edge in self.into_order[self.into[node] : self.into[node + 1]].tolist():
                more = self.loss[edge]
                if more < np.inf:
                    serial += 1
                    heapq.heappush(heap, (loss + more, serial, int(self.begin[edge]), (edge, path)))
        return found


def _gather(flat: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries ``which`` of a list of lists, one after the other, and where each begins."""
    sizes = offsets[which + 1] - offsets[which]
    first = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(offsets[which] - first[:-1], sizes) + np.arange(first[-1])
    return flat[at], first


def _edge_ids(lattice: Lattices, edges: np.ndarray, data: np.ndarray, vocabulary: Vocabulary) -> list[int]:
    ids = []
    for edge in edges:
        number = int(lattice.id[edge])
        if number >= 0:
            ids.append(number)
        else:
            place, size = -1 - number, int(lattice.end[edge] - lattice.begin[edge])
            ids += vocabulary.byte_ids[data[place : place + size]].tolist()
    return ids


def segment(data: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary, n: int):
    """For each text of a chunk its n best segmentations: a list of ``(score, ids as an array)``, best first."""
    rows = len(starts) - 1
    filled = np.flatnonzero(np.diff(starts))
    data = np.insert(data, starts[filled], _SPACE_BYTE)
    starts = starts + np.searchsorted(filled, np.arange(rows + 1))
    space = data == _SPACE_BYTE
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[starts[:-1][filled]] = True
    begin = np.flatnonzero(begins)
    end = np.append(begin[1:], len(data))
    row_units = np.searchsorted(begin, starts)
    keys, sample, unit = np.unique(X.span_hashes(X.prefix_hashes(data), begin, end), return_index=True, return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum((end - begin)[sample])])
    at = np.repeat(begin[sample] - bounds[:-1], np.diff(bounds)) + np.arange(bounds[-1])
    text = data[at]
    lattice = Lattices(text, bounds, vocabulary)
    edges, edge_first, loss = lattice.best_paths()
    score = lattice.best[lattice.last] if lattice.units else np.zeros(0)

    number = lattice.id[edges]
    sizes = np.where(number >= 0, 1, lattice.end[edges] - lattice.begin[edges])
    id_first = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.empty(id_first[-1], np.int32)
    known = number >= 0
    ids[id_first[:-1][known]] = number[known]
    lone = np.flatnonzero(~known)
    within = np.arange(int(sizes[lone].sum())) - np.repeat(np.cumsum(sizes[lone]) - sizes[lone], sizes[lone])
    ids[np.repeat(id_first[:-1][lone], sizes[lone]) + within] = vocabulary.byte_ids[text[np.repeat(-1 - number[lone], sizes[lone]) + within]]
    unit_first = id_first[edge_first]

    @functools.cache
    def alternatives(which: int):
        return [(lost, np.array(_edge_ids(lattice, path, text, vocabulary), np.int32)) for lost, path in lattice.search(which, n)]

    for row in range(rows):
        own = unit[row_units[row] : row_units[row + 1]]
        if not len(own):
            yield [(0.0, np.zeros(0, np.int32))]
            continue
        best, first = _gather(ids, unit_first, own)
        total = float(score[own].sum())
        lost = loss[own]
        if n == 1:
            yield [(total, best)]
            continue
        open_units = np.argsort(lost, kind="stable")[: n - 1] if len(lost) > n - 1 else np.arange(len(lost))
        choices: list[tuple[float, tuple]] = [(0.0, ())]
        for place in sorted(open_units.tolist()):
            if lost[place] < np.inf:
                options = alternatives(int(own[place]))
                choices = sorted(
                    ((a + b, (*c, (place, k)) if k else c) for a, c in choices for k, (b, _) in enumerate(options)), key=lambda x: (x[0], x[1])
                )[:n]
        result = []
        for extra, changes in choices:
            parts, at = [], 0
            for place, k in changes:
                parts += [best[at : first[place]], alternatives(int(own[place]))[k][1]]
                at = first[place + 1]
            result.append((total - extra, np.concatenate([*parts, best[at:]]) if changes else best))
        yield result


def decode_ids(ids: np.ndarray, vocabulary: Vocabulary) -> bytes:
    """The text of a sequence of ids, without the space in front."""
    flat, offsets = vocabulary.flat
    return _gather(flat, offsets, ids.astype(np.int64))[0].tobytes()[1:]


def _vocabulary(docs: DataFrame, path: str):
    return docs.sparkSession.sparkContext.broadcast(load(path))


def encode(docs: DataFrame, text: str = "text", out: str = "segmentations", n: int = BEST, path: str = MODEL) -> DataFrame:
    """Add the n best segmentations as ``array<struct<score, pieces>>``, best first."""
    if out.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"the input has a column {out} already")
    shared = _vocabulary(docs, path)
    kind = pa.struct([("score", pa.float64()), ("pieces", pa.list_(pa.int32()))])

    @F.arrow_udf("array<struct<score:double,pieces:array<int>>>")
    def run(texts: pa.Array) -> pa.Array:
        buffer, starts = X.text_bytes(texts)
        scores, pieces, per_row = [], [], []
        for _, _, data, at in X.chunks(buffer, starts):
            for found in segment(data, at, shared.value, n):
                per_row.append(len(found))
                scores += [s for s, _ in found]
                pieces += [p for _, p in found]
        lists = pa.ListArray.from_arrays(
            np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int32), pa.array(np.concatenate([*pieces, np.zeros(0, np.int32)]), pa.int32())
        )
        flat = pa.StructArray.from_arrays([pa.array(scores, pa.float64()), lists], fields=list(kind))
        offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
        missing = texts.is_null()
        if missing.true_count:
            return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(missing.to_numpy(zero_copy_only=False), False)), flat)
        return pa.ListArray.from_arrays(offsets, flat)

    return docs.withColumn(out, run(F.col(f"`{text}`").cast("string")))


#: Text that ``encode_best`` has lattices of at a time, besides other columns and what stages before it left behind.
ENCODE_BYTES = 1 << 18


def encode_best(docs: DataFrame, text: str = "text", n: int = BEST, path: str = MODEL) -> DataFrame:
    """Add the ``pieces`` of the best segmentation and the ``scores`` of the n best; null texts have neither."""
    clash = {"pieces", "scores"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    shared = _vocabulary(docs, path)
    rows = docs if docs.schema[text].dataType == T.StringType() else docs.withColumn(text, F.col(f"`{text}`").cast("string"))
    at_text = rows.columns.index(text)
    lists = [T.StructField("pieces", T.ArrayType(T.IntegerType())), T.StructField("scores", T.ArrayType(T.DoubleType()))]

    def listed(values: list[np.ndarray], kind: pa.DataType, missing: np.ndarray) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
        flat = pa.array(np.concatenate(values) if values else np.zeros(0), kind)
        return pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(missing, False)), flat)

    def run(batches):
        for batch in batches:
            buffer, starts = X.text_bytes(batch.column(at_text))
            missing = batch.column(at_text).is_null().to_numpy(zero_copy_only=False)
            # A chunk of texts goes out before the next one is begun.
            for first, last, data, at in X.chunks(buffer, starts, ENCODE_BYTES):
                pieces, scores = [], []
                for found in segment(data, at, shared.value, n):
                    pieces.append(found[0][1])
                    scores.append(np.array([s for s, _ in found]))
                own = missing[first:last]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(first, last - first) for c in batch.columns), listed(pieces, pa.int32(), own), listed(scores, pa.float64(), own)],
                    [*batch.schema.names, "pieces", "scores"],
                )
            X.give_back()

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *lists]))


def decode(rows: DataFrame, pieces: str = "pieces", out: str = "text", path: str = MODEL) -> DataFrame:
    """Add the text of an array of ids; a null array gives a null text."""
    shared = _vocabulary(rows, path)

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        ids = (x.as_py() for x in lists)
        return pa.array([None if x is None else decode_ids(np.array(x, np.int32), shared.value).decode() for x in ids], pa.string())

    return rows.withColumn(out, run(pieces))


_DIGEST = "doc_id {}, n_bytes long, n_pieces long, score double, nbest_scores array<double>, nbest_pieces array<long>, ids_sha256 string, decoded boolean"


#: Text whose distinct words ``digest`` solves together; it has no other columns to hold.
DIGEST_BYTES = 2 << 20


def digest(docs: DataFrame, n: int = BEST, path: str = MODEL) -> DataFrame:
    """Per document: size, pieces and score of the best segmentation, scores and sizes of the n best, the SHA-256 of
    their ids (32-bit little-endian, -1 after each), and whether each of them decodes to the text."""
    shared = _vocabulary(docs, path)

    def run(batches):
        for batch in batches:
            buffer, starts = X.text_bytes(batch.column(1))
            columns = [[] for _ in range(7)]
            for _, _, data, at in X.chunks(buffer, starts, DIGEST_BYTES):
                for row, found in enumerate(segment(data, at, shared.value, n)):
                    text = data[at[row] : at[row + 1]].tobytes()
                    sha = hashlib.sha256()
                    for _, ids in found:
                        sha.update(ids.astype("<i4").tobytes())
                        sha.update(b"\xff\xff\xff\xff")
                    values = (
                        len(text), len(found[0][1]), found[0][0], [s for s, _ in found], [len(i) for _, i in found],
                        sha.hexdigest(), all(decode_ids(i, shared.value) == text for _, i in found),
                    )
                    for column, value in zip(columns, values):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.string(), pa.bool_())
            names = ["doc_id", "n_bytes", "n_pieces", "score", "nbest_scores", "nbest_pieces", "ids_sha256", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)
        X.give_back()

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _DIGEST.format(rows.schema[0].dataType.simpleString()))
