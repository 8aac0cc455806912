import math
import numpy as np
import pyarrow as pa
import pytest

from sftframe.llm import quality as Q


def test_fit_learns_main_effects_and_a_pair():
    rng = np.random.default_rng(4)
    x = rng.random((4000, len(Q.FEATURES)))
    y = ((x[:, 0] > 0.6) | ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5))).astype(float)
    model = Q.fit(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95
    assert (1, 2) in model.pairs


def test_features_of_odd_texts(texts):
    values = Q.features_of(pa.array(texts))
    assert values.shape == (len(texts), len(Q.FEATURES)) and np.isfinite(values).all()
    at = {name: k for k, name in enumerate(Q.FEATURES)}
    rows = Q.features_of(pa.array(["a a a b", "X!! Y!!\nX!! Y!!", None]))
    assert rows[0, at["distinct"]] == 0.5 and rows[0, at["word_repeats"]] == 0.5
    assert rows[1, at["upper"]] == 1.0 and rows[1, at["line_repeats"]] == 0.5 and rows[1, at["marked_words"]] == 1.0
    assert not rows[2].any()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = Q.digest(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) >= 0.9
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_labels_of_held_out_rows_and_ids_do_not_matter(spark):
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [sorted(tuple(r) for r in Q.digest(docs, x).collect()) for x in (labels, flipped)]
    assert scores[0] == scores[1]


def test_no_labels_and_no_rows(docs, no_docs, spark):
    labels = spark.createDataFrame([(1, None, 0)], "doc_id BIGINT, quality INT, toxic INT")
    assert {r["score"] for r in Q.digest(docs, labels).collect()} == {0.5}
    assert Q.digest(no_docs, labels).collect() == []
    assert Q.accepted(docs, labels).columns == docs.columns


def test_clash(docs):
    with pytest.raises(ValueError):
        Q.with_features(docs, out="Source")


def leaves_by_rows(bins, size, g, h):
    """A tree of up to three leaves: every cut of every leaf is tried by adding up its rows."""
    total = lambda inside: (sum(x for x, b in zip(g, bins) if b in inside), sum(x for x, b in zip(h, bins) if b in inside))
    gain = lambda inside: (lambda s: s[0] ** 2 / (s[1] + Q.RIDGE))(total(inside))
    leaves = [range(size)]
    for _ in range(2):
        cuts = [
            (gain(range(p.start, c)) + gain(range(c, p.stop)) - gain(p), -k, -c) for k, p in enumerate(leaves) for c in range(p.start + 1, p.stop)
        ]
        if not cuts or max(cuts)[0] <= 1e-9:
            break
        _, k, c = max(cuts)
        part = leaves[-k]
        leaves[-k : -k + 1] = [range(part.start, -c), range(-c, part.stop)]
    return [next(s[0] / (s[1] + Q.RIDGE) for p in leaves if b in p for s in [total(p)]) for b in range(size)]


def cells_by_rows(a, b, rows, cols, g, h):
    """The best cut of a grid in four: ``(gain, value of each cell)``."""
    best = (0.0, None)
    whole = sum(g) ** 2 / (sum(h) + Q.RIDGE)
    for i in range(1, rows):
        for j in range(1, cols):
            sums = {}
            for x, y, gg, hh in zip(a, b, g, h):
                s = sums.setdefault((x >= i, y >= j), [0.0, 0.0])
                s[0] += gg
                s[1] += hh
            gain = sum(s[0] ** 2 / (s[1] + Q.RIDGE) for s in sums.values()) - whole
            if best[1] is None or gain > best[0] + 1e-12:
                value = lambda x, y, i=i, j=j, sums=sums: (lambda s: s[0] / (s[1] + Q.RIDGE))(sums.get((x >= i, y >= j), [0.0, 0.0]))
                best = (gain, [[value(x, y) for y in range(cols)] for x in range(rows)])
    return best


def test_boosting_by_brute_force(monkeypatch):
    """Rounds as plain loops over rows give the tables and the scores."""
    for name, value in (("ROUNDS", 4), ("BINS", 6), ("PAIRS", 2), ("PAIR_BINS", 3), ("PAIR_ROUNDS", 3)):
        monkeypatch.setattr(Q, name, value)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(70, 3))
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.normal(size=70)) > 0).astype(float)
    model = Q.fit(x, y)
    cut = lambda column, bins: sorted(set(np.quantile(column, [k / bins for k in range(1, bins)]).tolist()))
    place = lambda edges, v: sum(e <= v for e in edges)
    edges, coarse = ([cut(x[:, f], n) for f in range(3)] for n in (6, 3))
    bins, cells = ([[place(e[f], v) for v in x[:, f]] for f in range(3)] for e in (edges, coarse))
    rate = sum(y) / len(y)
    logit = [math.log(rate / (1 - rate))] * len(y)

    def slopes():
        p = [1 / (1 + math.exp(-v)) for v in logit]
        return [a - b for a, b in zip(y, p)], [b * (1 - b) for b in p]

    tables = [[0.0] * (len(e) + 1) for e in edges]
    for _ in range(4):
        for f in range(3):
            step = leaves_by_rows(bins[f], len(tables[f]), *slopes())
            tables[f] = [t + Q.RATE * s for t, s in zip(tables[f], step)]
            logit = [v + Q.RATE * step[b] for v, b in zip(logit, bins[f])]
    size = [len(e) + 1 for e in coarse]
    ranked = sorted((-cells_by_rows(cells[a], cells[b], size[a], size[b], *slopes())[0], a, b) for a in range(3) for b in range(a + 1, 3))
    pairs = [(a, b) for _, a, b in ranked[:2]]
    grids = [[[0.0] * size[b] for _ in range(size[a])] for a, b in pairs]
    for _ in range(3):
        for k, (a, b) in enumerate(pairs):
            step = cells_by_rows(cells[a], cells[b], size[a], size[b], *slopes())[1]
            grids[k] = [[t + Q.RATE * s for t, s in zip(*both)] for both in zip(grids[k], step)]
            logit = [v + Q.RATE * step[p][q] for v, p, q in zip(logit, cells[a], cells[b])]
    assert model.pairs == tuple(pairs)
    for made, wanted in zip((*model.tables, *model.pair_tables), (*tables, *grids)):
        assert np.allclose(made, wanted, atol=1e-9)
    assert np.allclose(model.scores(x), [1 / (1 + math.exp(-v)) for v in logit], atol=1e-9)
