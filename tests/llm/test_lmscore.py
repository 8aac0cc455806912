import math
import re
import zlib
from collections import Counter

import numpy as np

from sftframe.llm import lmscore as L


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + [None]


def test_counts_and_base_against_brute_force(docs):
    rows = docs.select("doc_id", "text").collect()
    held = [r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows]
    counts = Counter(w for r, h in zip(rows, held) if not h for w in words(r["text"]))
    n, v = sum(counts.values()), len(counts)
    wanted = []
    for r, h in zip(rows, held):
        own = words(r["text"])
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        wanted.append((r["doc_id"], h, len(own), sum(w in counts for w in own), n, round(base, 7)))
    found = L.digest(docs).collect()
    assert sorted(((*r[:5], round(r["base_score"], 7)) for r in found), key=str) == sorted(wanted, key=str)
    assert all(r["score"] <= 0 for r in found)
    held_out = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in held_out) > sum(r["base_score"] for r in held_out)


def test_the_filter_never_answers_below_the_level_that_was_entered():
    rng = np.random.default_rng(2)
    keys = rng.integers(0, 2**64, 20000, dtype=np.uint64)
    counts = rng.geometric(0.2, 20000)
    made = L.filter_of(keys, counts)
    found = L.quantised(keys, made)
    assert (found >= L.levels(counts)).all() and (found == L.levels(counts)).mean() > 0.99
    others = rng.integers(0, 2**64, 20000, dtype=np.uint64)
    assert (L.quantised(others, made) > 0).mean() < 0.005 and not L.quantised(keys, np.zeros(0, np.uint8)).any()


def test_levels():
    assert L.levels(np.array([1, 2, 3, 4, 7, 8])).tolist() == [1, 2, 2, 3, 3, 4]
    assert L.value_of(np.array([0, 1, 2, 3])).tolist() == [0.0, 1.0, 2.5, 5.5]


def test_empty_table_and_no_training(docs, no_docs):
    assert L.digest(no_docs).collect() == []
    from pyspark.sql import functions as F

    rows = L.score(docs, F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["held_out"] for r in rows)


def brute(rows, held):
    """Scores of a dictionary of all n-grams with exact levels; ``rows`` are ``(id, text)``."""
    own = [words(t) for _, t in rows]
    grams = lambda t, k: list(zip(*([*[None] * j, *t] for j in reversed(range(k)))))
    # Before a text's first word stand ends.
    count = [Counter(g for t, h in zip(own, held) if not h for g in grams(t, k)) for k in (1, 2, 3)]
    n, v = sum(count[0].values()), len(count[0])
    level = lambda c: (3 * 2.0 ** (math.frexp(c)[1] - 1) - 1) / 2 if c else 0.0
    result = []
    for (name, _), t in zip(rows, own):
        total = 0.0
        for k, w in enumerate(t):
            u, before = (t[k - 1] if k else None), (t[k - 2] if k > 1 else None)
            one, word = float(count[0][(u,)]), float(count[0][(w,)])
            pair = level(count[1][(u, w)]) if one and word else 0.0
            both = (level(count[1][(before, u)]) if count[0][(before,)] and one else 0.0) if k else one
            triple = level(count[2][(before, u, w)]) if pair else 0.0
            total += float(L.log_share(*(np.array([x]) for x in (word, one, pair, both, triple)), n, v)[0])
        result.append((str(name), len(t), total))
    return result


def test_scores_against_a_dictionary(docs):
    from pyspark.sql import functions as F

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    wanted = brute(rows, [n is None or n % 2 for n, _ in rows])
    found = [(str(r["doc_id"]), r["n_tokens"], r["score"]) for r in L.score(docs, F.coalesce(F.col("doc_id") % 2 == 0, F.lit(False))).collect()]
    off = [abs(a[2] - b[2]) for a, b in zip(sorted(found), sorted(wanted))]
    assert len(found) == len(wanted) and [f[:2] for f in sorted(found)] == [w[:2] for w in sorted(wanted)]
    assert sum(off) < 0.002 * sum(abs(w[2]) for w in wanted)


def test_settings_and_divisions_leave_scores_alone(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "RANGE_BYTES", 5000)
    first = sorted((tuple(r) for r in L.digest(docs).collect()), key=str)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "23")
        monkeypatch.setattr(L, "UNIT", 900)
        monkeypatch.setattr(L, "TASK_BYTES", 3000)
        assert sorted((tuple(r) for r in L.digest(docs.repartition(7)).collect()), key=str) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_another_order_is_noticed():
    tokens = np.arange(1, 50, dtype=np.uint64)
    assert L._checksum(tokens) != L._checksum(tokens[::-1].copy())
