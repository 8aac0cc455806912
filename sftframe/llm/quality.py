"""Quality of texts by a generalised additive model with pairwise interactions.

Every text gets numeric features.  Cyclic boosting goes round the features, and each step adds a shallow tree over
the bins of one feature (then of one pair of features) to that feature's lookup table.  Scoring is one addition per
table.  The tables are fitted on the driver from at most ``SAMPLE`` labelled rows, those with the smallest hash
of their id, as features only; every row is scored.

A null text counts as empty and gets a score like any other.  Rows without a label are scored and not learnt from;
of several labels of one id the largest counts.  Without labelled rows every score is 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.llm import textcore as X

SAMPLE = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIRS = 10
PAIR_ROUNDS = 60
RATE = 0.1
RIDGE = 2.0
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "stops", "marks", "symbols", "pipes", "beyond_ascii",
    "lines", "line_repeats", "distinct", "distinct_3", "word_repeats", "marked_words", "short_words", "space",
)


def _class(members: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(members.encode())] = 1
    return table


_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _class("abcdefghijklmnopqrstuvwxyz")
_DIGITS = _class("0123456789")
_STOPS = _class(".,;:")
_MARKS = _class("!?")
_SYMBOLS = _class("#$%&*+/<=>@[\\]^_`{}~")
_PIPES = _class("|")
_SPACE = _class(" \t\n\r\x0b\x0c")
_BEYOND = np.concatenate([np.zeros(128, np.uint8), np.ones(128, np.uint8)])
_NOT_BREAK = ~_class("\n").astype(bool)


def features_of(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    buffer, starts = X.text_bytes(column)
    result = np.zeros((len(column), len(FEATURES)))
    for first, last, data, at in X.chunks(buffer, starts):
        n, rows = np.diff(at).astype(np.float64), last - first
        begin, end, hashes, word_at = X.words(data, at, X.NOT_SPACE)
        n_words = np.diff(word_at).astype(np.float64)

        def share(table):
            sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
            return (sums[at[1:]] - sums[at[:-1]]).astype(np.float64)

        def per_word(flags):
            sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            return (sums[word_at[1:]] - sums[word_at[:-1]]) / np.maximum(n_words, 1)

        upper, lower = share(_UPPER), share(_LOWER)
        same = np.zeros(len(hashes), bool)
        same[1:] = hashes[1:] == hashes[:-1]
        same[word_at[:-1][word_at[:-1] < len(hashes)]] = False
        final = data[end - 1] if len(end) else np.zeros(0, np.uint8)
        marked = (_SYMBOLS | _MARKS | _PIPES)[final] > 0
        _, _, line_hashes, line_at = X.words(data, at, _NOT_BREAK)
        n_lines = np.diff(line_at).astype(np.float64)
        distinct_lines = np.diff(X.shingle_hashes(line_hashes, line_at, 1)[1])
        distinct = np.diff(X.shingle_hashes(hashes, word_at, 1)[1])
        distinct_3 = np.diff(X.shingle_hashes(hashes, word_at, 3)[1])
        some = np.maximum(n, 1)
        result[first:last] = np.stack(
            [
                np.log1p(n),
                np.log1p(n_words),
                (n - share(_SPACE)) / np.maximum(n_words, 1),
                upper / np.maximum(upper + lower, 1),
                share(_DIGITS) / some,
                share(_STOPS) / some,
                share(_MARKS) / some,
                share(_SYMBOLS) / some,
                share(_PIPES) / some,
                share(_BEYOND) / some,
                n_lines / np.maximum(n_words, 1),
                (n_lines - distinct_lines) / np.maximum(n_lines, 1),
                distinct / np.maximum(n_words, 1),
                distinct_3 / np.maximum(n_words - 2, 1),
                per_word(same),
                per_word(marked),
                per_word(end - begin <= 3),
                share(_SPACE) / some,
            ],
            1,
        ).reshape(rows, len(FEATURES))
    return result


@dataclass(frozen=True)
class AdditiveModel:
    """Bin edges and lookup tables: one per feature and one per chosen pair."""

    base: float
    edges: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    pair_edges: tuple[np.ndarray, ...]
    pairs: tuple[tuple[int, int], ...]
    pair_tables: tuple[np.ndarray, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        logit = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            logit += table[np.searchsorted(edges, x[:, f], "right")]
        for (f, g), table in zip(self.pairs, self.pair_tables):
            logit += table[_bin(self.pair_edges[f], x[:, f]), _bin(self.pair_edges[g], x[:, g])]
        return 1 / (1 + np.exp(-logit))


def _bin(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.searchsorted(edges, values, "right")


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _gain(g, h):
    return g * g / (h + RIDGE)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree of up to three leaves over ordered bins, from sums of gradients and curvatures."""
    parts = [(0, len(g))]
    for _ in range(2):
        best = (1e-9, None, None)
        for k, (a, b) in enumerate(parts):
            left_g, left_h = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            if len(left_g):
                all_g, all_h = g[a:b].sum(), h[a:b].sum()
                gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
                at = int(gains.argmax())
                if gains[at] > best[0]:
                    best = (gains[at], k, a + at + 1)
        if best[1] is None:
            break
        a, b = parts[best[1]]
        parts[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    values = np.zeros(len(g))
    for a, b in parts:
        values[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return values


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four leaves: its gain and the leaf values per cell."""
    sum_g, sum_h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    corner = lambda s: (s[1:-1, 1:-1], s[1:-1, -1:] - s[1:-1, 1:-1], s[-1:, 1:-1] - s[1:-1, 1:-1], s[-1, -1] - s[1:-1, -1:] - s[-1:, 1:-1] + s[1:-1, 1:-1])
    gs, hs = corner(sum_g), corner(sum_h)
    values = np.zeros_like(g)
    if not gs[0].size:
        return 0.0, values
    gains = sum(_gain(a, b) for a, b in zip(gs, hs)) - _gain(g.sum(), h.sum())
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    leaves = [a[i, j] / (b[i, j] + RIDGE) for a, b in zip(gs, hs)]
    values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = leaves
    return float(gains[i, j]), values


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting: single features first, then the pairs that explain most of what is left."""
    n_features = x.shape[1]
    if not len(x):
        none = tuple(np.zeros(0) for _ in range(n_features))
        return AdditiveModel(0.0, none, tuple(np.zeros(1) for _ in range(n_features)), none, (), ())
    rate = np.clip(y.mean(), 0.5 / (len(y) + 1), 1 - 0.5 / (len(y) + 1))
    base = float(np.log(rate / (1 - rate)))
    edges = tuple(_edges(x[:, f], BINS) for f in range(n_features))
    bins = [_bin(e, x[:, f]) for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    logit = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n_features):
            g, h = slopes()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size))
            tables[f] += step
            logit += step[bins[f]]
    pair_edges = tuple(_edges(x[:, f], PAIR_BINS) for f in range(n_features))
    coarse = [_bin(e, x[:, f]) for f, e in enumerate(pair_edges)]

    def grid(f, g_of, values):
        shape = (len(pair_edges[f]) + 1, len(pair_edges[g_of]) + 1)
        return np.bincount(coarse[f] * shape[1] + coarse[g_of], values, shape[0] * shape[1]).reshape(shape)

    g, h = slopes()
    ranked = sorted(
        ((-_quadrants(grid(a, b, g), grid(a, b, h))[0], a, b) for a in range(n_features) for b in range(a + 1, n_features))
    )
    pairs = tuple((a, b) for _, a, b in ranked[:PAIRS])
    pair_tables = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            g, h = slopes()
            step = RATE * _quadrants(grid(a, b, g), grid(a, b, h))[1]
            pair_tables[k] += step
            logit += step[coarse[a], coarse[b]]
    return AdditiveModel(base, edges, tuple(tables), pair_edges, pairs, tuple(pair_tables))


def with_features(docs: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """Add the array of ``FEATURES`` of every text and drop the text."""

    def compute(batches):
        for batch in batches:
            values = features_of(batch.column(batch.num_columns - 1))
            lists = pa.ListArray.from_arrays(
                np.arange(0, values.size + 1, len(FEATURES), dtype=np.int32), pa.array(values.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [*batch.schema.names[:-1], out])

    kept = docs.drop(text)
    if out.lower() in (c.lower() for c in kept.columns):
        raise ValueError(f"the input has a column {out} already")
    schema = T.StructType([*kept.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))])
    return docs.select(*[F.col(f"`{c}`") for c in kept.columns], F.col(f"`{text}`").cast("string").alias("_text")).mapInArrow(compute, schema)


def train(features: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """Fit on the ``sample`` labelled rows whose ids have the smallest hash."""
    known = labels.where(F.col(label).isNotNull()).groupBy(doc_id).agg(F.max(label).alias("_label"))
    rows = (
        features.select(doc_id, "features")
        .join(known, doc_id)
        .orderBy(F.xxhash64(F.col(doc_id).cast("string")), F.col("features"))
        .limit(sample)
        .select("features", F.col("_label").cast("double").alias("label"))
        .toArrow()
    )
    flat = rows["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit(flat.reshape(-1, len(FEATURES)), rows["label"].to_numpy())


def scored(features: DataFrame, model: AdditiveModel) -> DataFrame:
    """Replace the features by a ``score`` between 0 and 1."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(lists: pa.Array) -> pa.Array:
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        return pa.array(shared.value.scores(flat.reshape(len(lists), len(FEATURES))))

    return features.withColumn("score", score("features")).drop("features")


def _features(docs: DataFrame, divisor: int, held: int, keep: tuple[str, ...] = ()) -> DataFrame:
    held_out = F.coalesce(X.remainder("doc_id", divisor) == held, F.lit(False))
    return with_features(docs.select("doc_id", *keep, held_out.alias("held_out"), "text"))


def digest(docs: DataFrame, labels: DataFrame, divisor: int = 5, held: int = 0) -> DataFrame:
    """Learn from labelled rows that are not held out, score all; the features are computed once and stored."""
    features = X.stored(_features(docs, divisor, held), "quality")
    model = train(features.where(~F.col("held_out")), labels)
    return scored(features, model).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their own columns."""
    held_out = F.coalesce(X.remainder("doc_id", 5) == 0, F.lit(False))
    features = with_features(docs.select("doc_id", held_out.alias("held_out"), "text"))
    model = train(features.where(~F.col("held_out")), labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scores = pa.array(shared.value.scores(features_of(texts)))
        X.give_back()
        return scores

    return docs.where(score(F.col("text").cast("string")) >= threshold)
