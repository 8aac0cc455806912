import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from sftframe.llm import langid as G


def test_codewords_differ():
    for n in (2, 3, 4, 6, 7, 20):
        code = G.codewords(n)
        assert len(code) == n and len(np.unique(code, axis=0)) == n and set(code.ravel()) == {1.0, -1.0}
    code = G.codewords(4)
    assert code.shape[1] == 7 and min((code[a] != code[b]).sum() for a in range(4) for b in range(a)) == 4


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = G.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_texts(spark, docs):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (4, "the end", "en"), (5, "und das Ende", "de")] * 5
    rows += [(50, None, "en"), (51, "", "de"), (52, "123 .,;", None), (53, "梦", None), (54, "the dog and the end", None), (None, "der Hund", "de")]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in G.digest(table).collect()}
    assert found[50] == found[51] == found[52] == ("und", 0.0)
    assert found[54][0] == "en" and found[None][0] == "de" and found[53][0] in ("en", "de")
    assert {r["lang_pred"] for r in G.digest(docs).collect()} == {"en", "und"}
    assert {r["lang_pred"] for r in G.digest(table.where("lang is null")).collect()} == {"und"}


def test_empty_table_and_clash(no_docs, docs):
    assert G.digest(no_docs).collect() == []
    with pytest.raises(ValueError):
        G.identify(docs.withColumnRenamed("core", "score"), G.model_of((), np.zeros((0, G.BUCKETS))))


def test_margins_do_not_cross_rows():
    import pyarrow as pa

    model = G.model_of(("a", "b"), np.random.default_rng(0).random((2, G.BUCKETS)) * 100)
    alone = [G.margins(model, pa.array([t]))[0] for t in ("hello there", "x", "", "général")]
    assert np.allclose(G.margins(model, pa.array(["hello there", "x", "", "général"])), alone)


def test_digits_and_fractions_are_no_letters():
    assert G.has_letter(pa.array(["²½", "Ⅷ ٣", "123", "ª", "x²", "梦", None, ""])).tolist() == [False, False, False, True, True, True, False, False]


def bucket_of(gram: bytes) -> int:
    value = int.from_bytes(gram[-4:], "big") * 2654435761 % 2**32
    value = (value ^ value >> 15) * 2246822519 % 2**32
    return value >> 17


def gram_buckets(text):
    data = bytes(b + 32 if 65 <= b <= 90 else b for b in f" {text or ''} ".encode())
    return [bucket_of(data[k : k + n]) for n in (2, 4) for k in range(len(data) - n + 1)]


def by_dictionaries(rows):
    """``{id: (language, score)}``: n-grams counted one by one, each text decoded on its own."""
    counts = defaultdict(lambda: defaultdict(int))
    for name, text, lang in rows:
        if lang is not None and text is not None and not (name is not None and zlib.crc32(str(name).encode()) % 4 == 2):
            for b in gram_buckets(text):
                counts[lang][b] += 1
    langs = sorted(counts)
    total = {x: sum(counts[x].values()) + 0.5 * G.BUCKETS for x in langs}
    share = {x: [(counts[x].get(b, 0) + 0.5) / total[x] for b in range(G.BUCKETS)] for x in langs}
    codes = G.codewords(len(langs))
    weights, scale = [], []
    for k in range(codes.shape[1]):
        plus, minus = ([x for x, c in zip(langs, codes) if c[k] * sign > 0] for sign in (1, -1))
        mean = lambda group, b: sum(share[x][b] for x in group) / len(group)
        weights.append([math.log(mean(plus, b) / mean(minus, b)) for b in range(G.BUCKETS)])
        scale.append(sum(c[k] * sum(s * w for s, w in zip(share[x], weights[-1])) for x, c in zip(langs, codes)) / len(langs))
    found = {}
    for name, text, _ in rows:
        if not any(ch.isalpha() for ch in text or ""):
            found[name] = ("und", 0.0)
            continue
        own = gram_buckets(text)
        margin = [min(max(4 * sum(w[b] for b in own) / len(own) / s, -30), 30) for w, s in zip(weights, scale)]
        loss = [sum(s / sum(scale) * math.log1p(math.exp(-m * bit)) for s, m, bit in zip(scale, margin, code)) for code in codes]
        near = [math.exp(-3 * x) for x in loss]
        found[name] = (langs[near.index(max(near))], max(near) / sum(near))
    return found


def test_predictions_by_brute_force(spark):
    words = {"aa": "lorem ipsum dolor sit", "bb": "der hund und die katze", "cc": "le chat et la souris"}
    rows = [(k, " ".join(itertools.islice(itertools.cycle(words[x].split()), k % 5, k % 5 + 3 + k % 4)), x) for k, x in enumerate(("aa", "bb", "cc") * 12)]
    rows += [(100, "Le Hund dolor", None), (101, "", "aa"), (102, None, "bb"), (103, "½²", None), (104, "É zz", None), (None, "la katze", "cc")]
    table = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING").repartition(3)
    wanted = by_dictionaries(rows)
    for r in G.digest(table).collect():
        lang, score = wanted[r["doc_id"]]
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score, abs=1e-5)
