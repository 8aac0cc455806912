"""Language-model scores from log-frequency Bloom filters of quantised bigram and trigram counts.

Learning: training texts give counts of words (with one end after each text), of neighbouring words and of three in a
row.  They are summed by ranges of the n-gram's hash; each range turns its sums into a filter and forgets them.  An
n-gram of count ``c`` is entered with every level from 1 to ``1 + floor(log2 c)``.  The filters are stored: a table of
parts of bounded size, all that is known about n-grams when texts are scored.  Word counts stay exact.

Scoring: the distinct n-grams of a unit of texts go to the parts of their ranges, where each is probed level by level
until one is missing, and the levels come back.  Filters of a corpus have no bound that would let every worker hold
them all, so probes travel to the parts and not the parts to all workers.

The number of ranges, and with it every filter, follows from the bytes of the texts alone, so scores do not depend on
settings or on how the table is divided.  A filter has ``BITS_PER_ENTRY`` bits an entry at every size; a probe of a
level that is not there passes with a chance of a quarter of a percent.  N-grams are known by as many bits of their
hash as make a chance meeting with one of the corpus' own rarer than one in four thousand.

``log10 p(w | u, v)`` mixes the trigram share, the bigram share and the add-one share of the word, by weights that grow
with the count of what comes before; a text's score sums over its words and its end, the first words following ends.
A filter answer is bounded by the counts of its parts.

Null texts count as empty: they have one token, the end.  Rows are scored one by one, so repeated rows repeat;
a null id is in training.  Without training rows every count is 0.  ``docs`` is read several times and must give the
same rows in the same order, as a stored table does; a table that does not fails the job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftframe.llm import textcore as X

UNIT = 800_000
#: Bytes of text whose n-grams a range holds, and that a task is given (about one unit of texts).
RANGE_BYTES, TASK_BYTES = 8 << 20, 6 << 20
BITS_PER_ENTRY = 16
PROBES = 4
#: No count has a higher level.
MOST_LEVELS = 63
#: Bits of a hash beyond those that number all tokens.
SPARE_BITS = 12
MIX = 0.5
HALF = 20.0

_UNIT_BITS = 16
_END = X.mix(np.array([0x123456789], np.uint64))[0]
_ASKED = pa.schema([("slice", pa.int64()), ("unit", pa.int64()), ("kind", pa.string()), ("n", pa.int64()), ("tokens", pa.binary()), ("counts", pa.binary()), ("info", pa.binary())])
_SQL = "slice long, unit long, kind string, n long, tokens binary, counts binary, info binary"
#: Filters before what is probed in them.
_FILTERS, _PROBED = ("a2", "a3"), ("b2", "b3")


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ASKED)], schema=_ASKED)


def key_bits(size: int) -> int:
    """Bits of an n-gram's hash that are kept for ``size`` bytes of text."""
    return min(64, max(24, size.bit_length() - 2 + SPARE_BITS))


def grams(tokens: np.ndarray, firsts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each token with the one before and with the two before; before a text's first token stand ends."""
    one, two = np.full(len(tokens), _END), np.full(len(tokens), _END)
    one[1:], two[2:] = tokens[:-1], tokens[:-2]
    one[firsts] = _END
    two[firsts] = _END
    second = firsts + 1
    two[second[second < len(tokens)]] = _END
    factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    pairs = X.mix(one * factor + tokens)
    return pairs >> shift, X.mix(X.mix(two * factor + one) * factor + tokens) >> shift


def _cuts(keys: np.ndarray, slices: int, bits: int) -> np.ndarray:
    bounds = [(k << bits) // slices for k in range(1, slices)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(bounds, np.uint64)), [len(keys)]])


def _units(batches, size: int):
    """Token hashes of texts (an end after each), first token per text, ids and training marks, in units."""
    number = TaskContext.get().partitionId() << _UNIT_BITS
    tokens, sizes, marks, total = [], [], [], 0
    for batch in batches:
        buffer, starts = X.text_bytes(batch.column(batch.num_columns - 1))
        for first, last, data, at in X.chunks(buffer, starts):
            _, _, hashes, rows = X.words(data, at, X.NOT_SPACE)
            hashes[hashes == _END] ^= np.uint64(1)
            tokens.append(np.insert(hashes, rows[1:], _END))
            sizes.append(np.diff(rows) + 1)
            marks.append([batch.column(k).slice(first, last - first) for k in range(batch.num_columns - 1)])
            total += len(tokens[-1])
            if total >= size:
                yield number, np.concatenate(tokens), np.concatenate(sizes), marks
                number += 1
                tokens, sizes, marks, total = [], [], [], 0
    if sizes:
        yield number, np.concatenate(tokens), np.concatenate(sizes), marks


def _teach(slices: int, bits: int, size: int):
    """Per unit and range: all distinct words with their training counts, and the n-grams of its training texts."""

    def run(batches):
        for unit, tokens, sizes, marks in _units(batches, size):
            train = np.concatenate([m[0].to_numpy(zero_copy_only=False) for m in marks]).astype(bool)
            taught = np.repeat(train, sizes)
            words, at = np.unique(tokens, return_inverse=True)
            lists = [("word", words, np.bincount(at[taught], minlength=len(words)), 64)]
            for kind, keys in zip(_FILTERS, grams(tokens, np.cumsum(sizes) - sizes, bits)):
                lists.append((kind, *np.unique(keys[taught], return_counts=True), bits))
            rows = [(-1, unit, "check", _checksum(tokens), None, None, None)]
            for kind, keys, n, width in lists:
                cuts = _cuts(keys, slices, width)
                for k in np.flatnonzero(np.diff(cuts)):
                    part = slice(cuts[k], cuts[k + 1])
                    rows.append((int(k), unit, kind, int(cuts[k + 1] - cuts[k]), X.pack(np.diff(keys[part], prepend=np.uint64(0))), X.pack(n[part].astype(np.uint32)), None))
            yield _batch(rows)
        X.give_back()

    return run


def _checksum(tokens: np.ndarray) -> int:
    """A number that another order of the tokens would not give."""
    places = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    return int(X.mix(tokens + places).sum(dtype=np.uint64).view(np.int64))


def levels(counts: np.ndarray) -> np.ndarray:
    """The quantised logarithm of counts of 1 or more."""
    return np.frexp(counts.astype(np.float64))[1]


def value_of(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that share a level; level 0 is count 0."""
    return np.where(level > 0, (3 * 2.0 ** (level - 1) - 1) / 2, 0.0)


def _probes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step of the bit places of keys at a level."""
    first = X.mix(keys + np.uint64(level * 0xD6E8FEB86659FD93 % (1 << 64)))
    return first, X.mix(first ^ np.uint64(0xA5A5A5A5A5A5A5A5)) | np.uint64(1)


def filter_of(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Filter bytes with every key entered at all levels of its count."""
    level = levels(counts)
    size = int(max(64, BITS_PER_ENTRY * level.sum())) // 8
    bits = np.zeros(8 * size, np.uint8)
    for at in range(1, int(level.max(initial=0)) + 1):
        first, step = _probes(keys[level >= at], at)
        for k in range(PROBES):
            bits[((first + np.uint64(k) * step) % np.uint64(8 * size)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def quantised(keys: np.ndarray, filter_bytes: np.ndarray) -> np.ndarray:
    """Level of each key by membership probes; 0 if it has never been entered."""
    result, size = np.zeros(len(keys), np.uint8), np.uint64(8 * len(filter_bytes))
    live, level = np.arange(len(keys) if len(filter_bytes) else 0), 0
    while len(live) and level < MOST_LEVELS:
        level += 1
        first, step = _probes(keys[live], level)
        for k in range(PROBES):
            place = (first + np.uint64(k) * step) % size
            hit = (filter_bytes[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
            live, first, step = live[hit], first[hit], step[hit]
        result[live] = level
    return result


def _sum(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([r["keys"] for r in rows])
    counts = np.concatenate([X.unpack(r["counts"], np.uint32, r["n"]) for r in rows]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    change = np.ones(len(keys), bool)
    change[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(change)
    return keys[first], np.add.reduceat(counts, first)


def _learned(batches):
    """Per range and kind: total counts and the counts of each unit's words, or the filter of the n-grams."""

    def group_rows(asked):
        k, kind = asked[0]["slice"], asked[0]["kind"]
        if kind == "check":
            yield from ((k, r["unit"], kind, r["n"], None, None, None) for r in asked)
            return
        for r in asked:
            r["keys"] = np.cumsum(X.unpack(r["tokens"], np.uint64, r["n"]), dtype=np.uint64)
            r["tokens"] = None
        keys, counts = _sum(asked)
        if kind != "word":
            yield (k, 0, kind, len(keys), filter_of(keys, counts).tobytes(), None, None)
            return
        yield (k, 0, "total", int(counts.sum()), None, None, str(int((counts > 0).sum())).encode())
        for r in asked:
            yield (k, r["unit"], "answer", r["n"], None, X.pack(counts[np.searchsorted(keys, r["keys"])]), None)

    asked: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if asked and (row["slice"], row["kind"]) != (asked[0]["slice"], asked[0]["kind"]):
                yield _batch(list(group_rows(asked)))
                asked = []
            asked.append(row)
    if asked:
        yield _batch(list(group_rows(asked)))
    X.give_back()


def _probe(slices: int, bits: int, size: int):
    """Per unit and range: the distinct n-grams to be probed."""

    def run(batches):
        for unit, tokens, sizes, _ in _units(batches, size):
            rows = []
            for kind, keys in zip(_PROBED, grams(tokens, np.cumsum(sizes) - sizes, bits)):
                keys = np.unique(keys)
                cuts = _cuts(keys, slices, bits)
                for k in np.flatnonzero(np.diff(cuts)):
                    part = slice(cuts[k], cuts[k + 1])
                    rows.append((int(k), unit, kind, int(cuts[k + 1] - cuts[k]), X.pack(np.diff(keys[part], prepend=np.uint64(0))), None, None))
            yield _batch(rows)
        X.give_back()

    return run


def _probed(batches):
    """Each row of n-grams against the filter of its range, which comes first; one row at a time."""
    filters, at = {}, None
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if row["slice"] != at:
                filters, at = {}, row["slice"]
            if row["kind"] in _FILTERS:
                filters[row["kind"][1]] = np.frombuffer(row["tokens"], np.uint8)
                continue
            keys = np.cumsum(X.unpack(row["tokens"], np.uint64, row["n"]), dtype=np.uint64)
            found = quantised(keys, filters.get(row["kind"][1], np.zeros(0, np.uint8)))
            rows.append((at, row["unit"], f"level{row['kind'][1]}", row["n"], None, X.pack(found), None))
        if rows:
            yield _batch(rows)
    X.give_back()


def log_share(word, before, pair, pair_before, triple, tokens: int, distinct: int) -> np.ndarray:
    """log10 of the mixed probability of words, from exact counts of the word and the one before, and the dequantised
    counts of both together, of the two before, and of all three."""
    alone = (word + 1.0) / (tokens + distinct + 1.0)
    pair = np.minimum(pair, np.minimum(word, before))
    weight = MIX * before / (before + HALF)
    mixed = weight * pair / np.maximum(before, 1) + (1 - weight) * alone
    triple = np.minimum(triple, np.minimum(pair, pair_before))
    weight = MIX * pair_before / (pair_before + HALF)
    return np.log10(weight * triple / np.maximum(pair_before, 1) + (1 - weight) * mixed)


def _sequences(size: int):
    """Per unit: its distinct words by falling frequency, its tokens as numbers of them, and the other columns."""

    def run(batches):
        for unit, tokens, sizes, marks in _units(batches, size):
            words, at = np.unique(tokens, return_inverse=True)
            order = np.argsort(-np.bincount(at), kind="stable")
            number = np.empty(len(words), np.uint32)
            number[order] = np.arange(len(words))
            columns = [pa.concat_arrays([m[k] for m in marks]) for k in range(len(marks[0]))]
            names = [str(k) for k in range(len(columns))]
            table = pa.RecordBatch.from_arrays([*columns, pa.array(sizes.astype(np.int64))], names=[*names, "sizes"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_batch(table)
            yield _batch(
                [
                    (-2, unit, "words", len(words), words[order].tobytes(), None, None),
                    (-3, unit, "text", len(tokens), X.pack(number[at]), None, sink.getvalue().to_pybytes()),
                ]
            )

    return run


def _answers(rows: list[dict], kind: str, dtype, size: int) -> np.ndarray:
    """A unit's answers of a kind, in the order of its sorted distinct keys."""
    answers = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["slice"])
    if sum(r["n"] for r in answers) != size:
        raise RuntimeError("the documents were read in another order than before; store them first")
    return np.concatenate([X.unpack(r["counts"], dtype, r["n"]) for r in answers])


def _scorer(all_tokens: int, distinct: int, bits: int):
    def unit_rows(rows):
        words, text = (next(r for r in rows if r["kind"] == kind) for kind in ("words", "text"))
        keys = np.frombuffer(words["tokens"], np.uint64)
        counts = np.empty(len(keys), np.float64)
        counts[np.argsort(keys)] = _answers(rows, "answer", np.int64, len(keys))
        table = pa.ipc.open_stream(text["info"]).read_next_batch()
        at = X.unpack(text["tokens"], np.uint32, text["n"]).astype(np.int64)
        tokens, own = keys[at], counts[at]
        if [r["n"] for r in rows if r["kind"] == "check"] != [_checksum(tokens)]:
            raise RuntimeError("the documents were read in another order than before; store them first")
        sizes = table.column("sizes").to_numpy()
        first = np.cumsum(sizes) - sizes
        before = np.empty_like(own)
        before[1:] = own[:-1]
        before[first] = counts[np.flatnonzero(keys == _END)[0]]
        found = []
        for order, keyed in zip("23", grams(tokens, first, bits)):
            distinct_keys, which = np.unique(keyed, return_inverse=True)
            found.append(value_of(_answers(rows, f"level{order}", np.uint8, len(distinct_keys)).astype(np.int64))[which])
        pair, triple = found
        pair[(own == 0) | (before == 0)] = 0
        # Before a text's first word stand two ends, which are as frequent as ends are.
        pair_before = np.empty_like(pair)
        pair_before[1:] = pair[:-1]
        pair_before[first] = before[first]
        total = float(all_tokens + distinct + 1)
        base = np.add.reduceat(np.log10((own + 1) / total), first)
        score = np.add.reduceat(log_share(own, before, pair, pair_before, np.where(pair > 0, triple, 0), all_tokens, distinct), first)
        n_known = np.add.reduceat((own > 0).astype(np.int64), first)
        size = table.num_rows
        columns = [*table.columns, pa.array(n_known), pa.array(np.full(size, all_tokens, np.int64)), pa.array(base), pa.array(score), pa.array(score / sizes)]
        names = ["held_out", "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "mean_score"]
        columns[0] = pc.invert(columns[0])
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["unit"] != rows[0]["unit"]:
                    yield unit_rows(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield unit_rows(rows)
        X.give_back()

    return run


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``held_out`` (not in training), ``doc_id``, token counts, ``base_score``, the model's ``score`` and
    ``mean_score``, which is the score per token."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    plain = docs.select(F.coalesce(train, F.lit(True)).alias("train"), F.col(f"`{doc_id}`").alias("doc_id"), body.alias("body"))
    size = X.volume(plain, "body")
    tasks, slices, bits = X.task_count(docs.sparkSession, size, TASK_BYTES), max(1, -(-size // RANGE_BYTES)), key_bits(size)

    taught = plain.mapInArrow(_teach(slices, bits, UNIT), _SQL)
    # Kinds of a range are summed apart.
    learned = X.stored(taught.repartition(tasks, "slice", "kind").sortWithinPartitions("slice", "kind").mapInArrow(_learned, _SQL), "lm-learned")
    totals = learned.where("kind = 'total'").agg(F.sum("n").alias("n"), F.sum(F.col("info").cast("string").cast("long")).alias("v")).first()
    filters = learned.where(F.col("kind").isin(*_FILTERS))
    asked = plain.mapInArrow(_probe(slices, bits, UNIT), _SQL).unionAll(filters)
    found = X.stored(asked.repartition(tasks, "slice").sortWithinPartitions("slice", "kind").mapInArrow(_probed, _SQL), "lm-levels")

    answers = learned.where(F.col("kind").isin("answer", "check")).unionAll(found)
    units = plain.mapInArrow(_sequences(UNIT), _SQL).unionAll(answers)
    id_type = docs.select(F.col(f"`{doc_id}`")).schema.fields[0].dataType.simpleString()
    return (
        units.repartition(tasks, "unit")
        .sortWithinPartitions("unit", "slice")
        .mapInArrow(
            _scorer(totals["n"] or 0, totals["v"] or 0, bits),
            f"held_out boolean, doc_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double, mean_score double",
        )
    )


def digest(docs: DataFrame, divisor: int = 7, held: int = 2) -> DataFrame:
    """Learn from the rows that are not held out, score all."""
    scored = score(docs, X.remainder("doc_id", divisor) != held)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "mean_score")
