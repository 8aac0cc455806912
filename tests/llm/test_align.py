import hashlib
import json
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sftframe.llm import align as A

A_TOKENIZER = Tokenizer.from_file(A.TOKENIZER_A)
A_TOKENIZER.encode_special_tokens = True
B_TOKENIZER = sentencepiece.SentencePieceProcessor(model_file=A.TOKENIZER_B)


def token_bytes():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of, extra = {chr(b): b for b in shown}, 256
    for b in range(256):
        if b not in shown:
            byte_of[chr(extra)] = b
            extra += 1
    vocab = json.load(open(A.TOKENIZER_A))["model"]["vocab"]
    return {i: bytes(byte_of.get(c, 0) for c in p) for p, i in vocab.items()}


A_BYTES = token_bytes()


def b_bytes(i):
    piece = B_TOKENIZER.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B_TOKENIZER.is_byte(i) else piece.replace("▁", " ").encode()


def spans(ids, content):
    at, result = 0, []
    for i in ids:
        result.append((i, at, at + len(content(i))))
        at += len(content(i))
    return result


def expected(texts):
    """Every pair of tokens of a document is looked at."""
    docs = []
    for text in texts:
        a = b = []
        if text:
            a = spans(A_TOKENIZER.encode(" " + text, add_special_tokens=False).ids, A_BYTES.__getitem__)
            b = spans(B_TOKENIZER.encode(text), b_bytes)
            whole = (" " + text).encode()
            if b"".join(A_BYTES[i] for i, *_ in a) != whole or b"".join(b_bytes(i) for i, *_ in b) != whole:
                a = b = []
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        ends = sorted({e for *_, e in a} & {f for *_, f in b})
        groups, start = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (a, b)]
            groups.append("|".join(sides))
            start = end
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        docs.append((len(a), len(b), len(groups), links, sha))
    count = Counter(p for d in docs for p in set(d[3]))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return [(a, b, g, len(ls), sum(count[p] == most[p[0]] for p in ls), sum(count[p] for p in ls), sha) for a, b, g, ls, sha in docs]


ODD = ["<|endoftext|> <s> </s>", "▁x", "a▁b", " ", "  ", "a ", "  lead", "tab\tline\n\n  x", "\x1cx\x85y", "Ünïcödé 梦 𝒳 ¡", "don't we'll 's ''s", "123 4567 !?", "​ z", "a" * 300, "ⴰⵣⵓⵍ ᏣᎳᎩ"]


def test_matches_brute_force(spark, texts):
    every = [t if t is None else t[:700] for t in texts] + ODD + ODD[:3] + [None, ""]
    docs = spark.createDataFrame([(k, t, "clash") for k, t in enumerate(every)], "doc_id BIGINT, text STRING, unit STRING").repartition(3)
    rows = sorted(tuple(r) for r in A.digest(docs, unit_links=3000).collect())
    assert [r[1:] for r in rows] == expected(every)


def test_null_and_repeated_ids_and_no_rows(spark, no_docs):
    docs = spark.createDataFrame([(None, "some words"), ("x", "some words"), ("x", None)], "doc_id STRING, text STRING")
    rows = sorted((tuple(r) for r in A.digest(docs).collect()), key=str)
    assert [r[0] for r in rows] == [None, "x", "x"] or sorted(r[0] or "" for r in rows) == ["", "x", "x"]
    assert sorted(r[1] for r in rows) == [0, 2, 2] and A.digest(no_docs).collect() == []


def test_a_very_long_text_without_spaces(spark):
    text = "ab" * 200_000
    row = A.digest(spark.createDataFrame([(1, text)], "doc_id INT, text STRING")).first()
    assert row["n_a"] == len(A_TOKENIZER.encode(" " + text).ids) and row["n_b"] == len(B_TOKENIZER.encode(text))


@given(st.lists(st.integers(0, 500), unique=True, max_size=200), st.lists(st.integers(0, 500), unique=True, max_size=300), st.sampled_from([2, 3, 64]))
@settings(max_examples=60, deadline=None)
def test_galloping(x, y, block):
    x, y = np.array(sorted(x), np.int64), np.array(sorted(y), np.int64)
    rank, there = A.gallop(x, y, block)
    assert there.tolist() == np.isin(x, y).tolist() and (not len(y) or rank.tolist() == np.searchsorted(y, x).tolist())


@pytest.mark.parametrize("text", ["a  b   c d", "x", "   "])
def test_words_of_b_join_to_the_text(text):
    assert "".join(A.WORDS_B.findall(" " + text)) == " " + text
