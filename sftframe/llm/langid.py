"""Language identification by error-correcting output codes over byte n-grams.

Every language has a codeword.  Each bit is predicted by a binary classifier that is linear in the n-gram counts:
its weights are log odds of an n-gram under the languages with the bit set and under the others.  The counts come
from all training rows by one aggregation, so the model does not depend on partitioning.  Decoding adds up, over
the bits, a logistic loss weighted by how well the bit separates its languages, and takes the nearest codeword; a
row whose two nearest codewords are close is flagged as ambiguous.

A null text or one without a letter is ``und`` with score 0.  Without any training row every text is ``und``.
Repeated rows give repeated results.  Ties go to the language that sorts first.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.llm import textcore as X

ORDERS = (2, 4)
BUCKETS = 1 << 15
AMBIGUOUS = 0.2
_COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords (rows of +1 and -1), bit weights per bucket, and the weight of each bit."""

    languages: tuple[str, ...]
    codes: np.ndarray
    weights: np.ndarray
    bit_weight: np.ndarray
    scale: np.ndarray


def codewords(n: int) -> np.ndarray:
    """All splits of few languages in two; for many, seeded random codes of which no two rows are equal."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:
        columns = [
            (1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if any(x < 0 for x in rest)
        ]
        return np.array(columns, np.float64).T
    width, rng = 8 * math.ceil(math.log2(n)), np.random.default_rng(9)
    while True:
        code = rng.choice((-1.0, 1.0), (n, width))
        code = code[:, np.abs(code.sum(0)) < n]
        if len(np.unique(code, axis=0)) == n:
            return code


def _buckets(data: np.ndarray, order: int) -> np.ndarray:
    value = data[: max(len(data) - order + 1, 0)].astype(np.uint32)
    for step in range(1, order):
        value <<= np.uint32(8)
        value |= data[step : len(data) - order + 1 + step]
    value *= np.uint32(2654435761)
    value ^= value >> np.uint32(15)
    value *= np.uint32(2246822519)
    return (value >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32)


def _grams(column: pa.Array):
    """Per chunk of rows: first row, and for each order the buckets and each row's range among them."""
    buffer, starts = X.text_bytes(column)
    lower = X.lower_table()
    for first, last, data, at in X.chunks(buffer, starts):
        data = lower[data]
        parts = []
        for order in ORDERS:
            buckets = _buckets(data, order)
            begin = np.minimum(at[:-1], len(buckets))
            parts.append((buckets, begin, np.maximum(np.minimum(at[1:] - order + 1, len(buckets)), begin)))
        yield first, last, parts


def _count(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for first, last, parts in _grams(batch.column(1)):
            of = langs[first:last]
            for lang in sorted(set(of)):
                total = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for buckets, begin, end in parts:
                    marks = np.zeros(len(buckets) + 1, np.int8)
                    np.add.at(marks, begin[of == lang], 1)
                    np.add.at(marks, end[of == lang], -1)
                    inside = np.cumsum(marks[:-1], dtype=np.int8).view(bool)
                    total += np.bincount(buckets[inside], minlength=BUCKETS)
    for lang, total in sums.items():
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array([lang] * len(found)), found.astype(np.int32), total[found]], schema=_COUNTS)


def _padded(text: str) -> Column:
    return F.concat(F.lit(" "), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(" "))


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows of ``train`` with a language; what the driver reads is ``languages * BUCKETS`` counts."""
    rows = train.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    counted = rows.select(F.col(f"`{lang}`").alias("lang"), _padded(text).alias("text")).mapInArrow(
        _count, "lang string, bucket int, n bigint"
    )
    counts = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = np.array(counts["lang"].to_pylist(), object)
    languages = tuple(sorted(set(names)))
    sums = np.zeros((len(languages), BUCKETS))
    sums[np.searchsorted(languages, names) if len(names) else [], counts["bucket"].to_numpy()] = counts["n"].to_numpy()
    return model_of(languages, sums)


def model_of(languages: tuple[str, ...], sums: np.ndarray) -> LanguageModel:
    share = (sums + 0.5) / (sums + 0.5).sum(1, keepdims=True) if len(languages) else sums
    codes = codewords(len(languages))
    bits = codes.shape[1] if codes.size else 0
    weights, scale = np.zeros((bits, BUCKETS)), np.ones(bits)
    for b in range(bits):
        plus, minus = share[codes[:, b] > 0].mean(0), share[codes[:, b] < 0].mean(0)
        weights[b] = np.log(plus / minus)
        margins = codes[:, b] * (share @ weights[b])
        scale[b] = max(margins.mean(), 1e-9)
    return LanguageModel(languages, codes.reshape(len(languages), bits), weights.astype(np.float32), scale / max(scale.sum(), 1e-9), scale)


def decode(model: LanguageModel, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest codeword, its probability among all codewords, and whether the second is close."""
    if not model.codes.shape[1]:
        n = len(margins)
        return np.zeros(n, np.int64), np.ones(n), np.zeros(n, bool)
    margin = np.clip(4 * margins / model.scale, -30, 30)
    loss = np.stack([(np.log1p(np.exp(-margin * code)) * model.bit_weight).sum(1) for code in model.codes], 1)
    near = np.exp(-3 * (loss - loss.min(1, keepdims=True)))
    near /= near.sum(1, keepdims=True)
    best = near.argmax(1)
    ranked = np.sort(near, 1)
    return best, near.max(1), ranked[:, -1] - ranked[:, -2] < AMBIGUOUS


def margins(model: LanguageModel, column: pa.Array) -> np.ndarray:
    """Mean log odds of each bit over the n-grams of each row."""
    result = np.zeros((len(column), len(model.weights)))
    for first, last, parts in _grams(column):
        n = np.zeros(last - first)
        for buckets, begin, end in parts:
            n += end - begin
            full = np.flatnonzero(end > begin)
            if not len(full):
                continue
            edges = np.stack([begin[full], end[full]], 1).ravel()
            for b, weight in enumerate(model.weights):
                values = np.append(weight[buckets], np.float32(0))
                result[first + full, b] += np.add.reduceat(values, edges, dtype=np.float64)[::2]
        result[first:last] /= np.maximum(n, 1)[:, None]
    return result


def has_letter(column: pa.Array) -> np.ndarray:
    """Whether each text has a sign of one of Unicode's letter categories; digits and fractions are none."""
    buffer, starts = X.text_bytes(column)
    lower = X.lower_table()[buffer]
    letter = (lower >= 97) & (lower <= 122)
    sums = np.concatenate([[0], np.cumsum(letter)])
    found = sums[starts[1:]] > sums[starts[:-1]]
    for row in np.flatnonzero(~found):
        found[row] = any(sign.isalpha() for sign in column[int(row)].as_py() or "")
    return found


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``; the model is ``bits * BUCKETS`` floats."""
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    clash = {f.name for f in new} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def score(batches):
        known = shared.value
        for batch in batches:
            column = batch.column(len(batch.columns) - 1)
            plain = batch.column(at)
            best, near, unsure = decode(known, margins(known, column))
            lettered = has_letter(plain) if known.languages else np.zeros(batch.num_rows, bool)
            names = np.array([*known.languages, "und"], object)[np.where(lettered, best, len(known.languages))]
            columns = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(np.where(lettered, near, 0.0)), pa.array(unsure & lettered)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *(f.name for f in new)])

    schema = T.StructType([*docs.schema.fields, *new])
    return docs.withColumn("_padded", _padded(text)).mapInArrow(score, schema)


def digest(docs: DataFrame, divisor: int = 4, held: int = 2) -> DataFrame:
    """Learn from the rows that are not held out, predict all."""
    held_out = F.coalesce(X.remainder("doc_id", divisor) == held, F.lit(False))
    rows = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = fit(rows.where(~F.col("held_out")))
    return identify(rows.drop("lang"), model).drop("text")
