import base64
import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from sftframe.llm import sketch as S


def chained(words):
    value = 42
    for w in words:
        value = xxhash.xxh64_intdigest(w.encode(), value)
    return value >> 16


def shingle_hashes(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    return {chained(words[i : i + 5]) for i in range(max(len(words) - 4, 1 if words else 0))}


def least(hashes, k=S.K):
    return sorted(hashes)[:k]


def written(hashes):
    return base64.b64encode(b"".join(h.to_bytes(6, "big") for h in hashes)).decode()


def likeness(a, b, k=S.K):
    both = least(set(a) | set(b), k)
    return len(set(both) & set(a) & set(b)) / len(both) if both else 1.0


def signed_hash(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def expected(rows):
    """One row per document: its next one is found in a sorted list, each set of shingles is whole."""
    rows = [(n, t or "") for n, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, signed_hash(r[1])), reverse=True)
    result = []
    for (name, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        lost = len(text) // 3
        edited = text[: len(text) - lost] + after[:lost]
        own, new, other = (least(shingle_hashes(t)) for t in (text, edited, after))
        sha = hashlib.sha256(edited.encode()).hexdigest()
        result.append((name, len(text), sha, written(own), written(new), likeness(own, new), likeness(own, other)))
    return sorted(result, key=str)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def found(docs):
    return sorted((tuple(r) for r in S.digest(docs).select(*COLUMNS).collect()), key=str)


def test_matches_brute_force(docs):
    assert found(docs) == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("hot", [2, 5])
def test_hot_ids_and_cells_are_divided(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_ROWS", hot)
    monkeypatch.setattr(S, "CELL_ROWS", 3)
    rows = [(k % 7 if k % 3 else 5, f"text {k} of some words {k * k}") for k in range(60)]
    rows += [(None, f"none {k}") for k in range(9)] + [(10**15, "far away"), (-(2**62), "low"), (5, rows[0][1]), (5, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert found(docs) == expected(rows)


def test_one_row_and_none(spark, no_docs):
    one = [(4, "a b c d e f g")]
    assert found(spark.createDataFrame(one, "doc_id BIGINT, text STRING")) == expected(one)
    assert S.digest(no_docs).collect() == []


def test_parts_and_merging_change_nothing(spark, monkeypatch):
    texts = [" ".join(f"w{(k * j) % 997}" for j in range(900)) for k in range(1, 7)]
    rows = [(k, k % 2, t) for k, t in enumerate(texts)] + [(9, 1, None), (10, 1, "")]
    docs = spark.createDataFrame(rows, "id INT, kind INT, text STRING")
    whole = {r["id"]: r["sketch"] for r in S.fingerprints(docs).collect()}
    assert all(whole[k] == least(shingle_hashes(t)) for k, _, t in rows)
    monkeypatch.setattr(S, "PART", 100)
    assert {r["id"]: r["sketch"] for r in S.fingerprints(docs).collect()} == whole
    groups = {r["kind"]: r["sketch"] for r in S.merged(S.fingerprints(docs), "kind", "sketch").collect()}
    assert groups == {g: least(set().union(*(shingle_hashes(t) for _, kind, t in rows if kind == g))) for g in (0, 1)}


def test_estimates(spark):
    words = [f"v{k}" for k in range(6000)]
    rows = [(" ".join(words[:4000]), " ".join(words[1000:6000])), (" ".join(words[:90]), " ".join(words[30:90])), ("", ""), ("", "x")]
    pairs = spark.createDataFrame(rows, "a STRING, b STRING")
    both = S.fingerprints(S.fingerprints(pairs, "a", "sa"), "b", "sb")
    sa, sb = F.col("sa"), F.col("sb")
    large, small, empty, one = both.select(S.resemblance(sa, sb), S.containment(sb, sa), S.distinct_count(sa), S.from_text(S.as_text(sa)) == sa).collect()
    assert abs(large[0] - 0.5) < 0.15 and abs(large[1] - 0.6) < 0.15 and abs(large[2] / 3996 - 1) < 0.3
    assert tuple(small) == (56 / 86, 1.0, 86.0, True)
    assert tuple(empty) == (1.0, 1.0, 0.0, True) and one[0] == 0.0


def test_no_python_in_the_plan(docs):
    plan = S.digest(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
