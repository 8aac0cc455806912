import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sftframe.llm import dedup
from sftframe.llm.suffix import permuted_lcp, suffix_array


def expected(texts, length=dedup.LENGTH):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    result = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        result.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return result


def test_matches_brute_force(spark, docs):
    rows = docs.select("doc_id", "text").collect()
    wanted = sorted(((r["doc_id"], *e) for r, e in zip(rows, expected([r["text"] for r in rows]))), key=str)
    assert sorted((tuple(r) for r in dedup.digest(docs).collect()), key=str) == wanted
    assert sum(w[2] for w in wanted) > 3000


def test_empty_table(no_docs):
    assert dedup.digest(no_docs).collect() == []


def test_a_run_of_one_byte_repeats_itself(spark):
    docs = spark.createDataFrame([(1, "z" * 401), (2, "z" * 399), (3, "y" * 400)], "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in dedup.digest(docs).collect()}
    assert found == {1: (401, 1), 2: (0, 0), 3: (0, 0)}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60), st.sampled_from([1, 700]))
def test_suffix_array_of_small_and_large_alphabets(symbols, scale):
    s = np.array(symbols, np.int64) * scale
    order = suffix_array(s).tolist()
    assert order == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    if scale == 1 and len(s):
        common = permuted_lcp(s.astype(np.uint8), np.array(order), np.array([0]), 1000)
        for a, b in zip(order, order[1:]):
            x, y = s[a:].tolist(), s[b:].tolist()
            assert common[b] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def test_anchors_do_not_depend_on_what_stands_around():
    rng = np.random.default_rng(1)
    shared = rng.integers(97, 123, 900, dtype=np.uint8)
    one = np.concatenate([rng.integers(97, 123, 50, dtype=np.uint8), shared])
    two = np.concatenate([shared, rng.integers(97, 123, 70, dtype=np.uint8)])
    blocks = [dict(zip(*(b := dedup.blocks_of(d, np.array([0, len(d)])))[:1], zip(*b[1:4]))) for d in (one, two)]
    assert len(set(blocks[0]) & set(blocks[1])) >= 2


def test_ranges_that_touch_are_one():
    assert dedup.merged([5, 0, 10], [10, 3, 12]) == [(0, 3), (5, 12)]


def test_no_shard_holds_all_blocks_of_a_core_that_many_texts_share(spark, monkeypatch):
    """Headers of 300, 405 and 520 bytes with different text around them, under a small ``SHARD_BYTES``."""
    rng = np.random.default_rng(7)
    letters = lambda n: bytes(rng.integers(97, 123, n, dtype=np.uint8)).decode()
    headers = [letters(300), letters(405), letters(520)]
    texts = [letters(150 + k) + headers[k % 3] + letters(400 - k) for k in range(60)]
    texts += [letters(200) + texts[5][100:700] + letters(50), texts[7]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING").repartition(3)
    match, most = dedup._match, 4000

    def guarded(length):
        run = match(length)

        def checked(batches):
            sizes = {}

            def seen():
                for batch in batches:
                    for core, piece in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                        sizes[core] = sizes.get(core, 0) + len(piece)
                        if sizes[core] > most:
                            raise RuntimeError("all blocks of a core came to one shard")
                    yield batch

            yield from run(seen())

        return checked

    monkeypatch.setattr(dedup, "SHARD_BYTES", most)
    monkeypatch.setattr(dedup, "_match", guarded)
    found = sorted(tuple(r) for r in dedup.digest(docs).collect())
    assert found == [(k, *e) for k, e in enumerate(expected(texts))]
    assert sum(1 for f in found if f[2]) > 30
