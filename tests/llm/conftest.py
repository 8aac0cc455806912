import random

import pytest

ODD = ["", None, " ", "\n\t ", "one", "Straße ▁ naïve 梦 𝒳!", "a" * 3000, "x y " * 2000, "|" * 900]


def prose(rng, n, words=("the of and to in a is that it for on was").split()):
    letters = "abcdefghijklmnopqrstuvwxyz"
    made = [rng.choice(words) if rng.random() < 0.4 else "".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n)]
    return " ".join(made)


@pytest.fixture(scope="session")
def texts():
    """Texts with copies, near copies, shared passages and odd cases."""
    rng = random.Random(5)
    base = [prose(rng, rng.randint(20, 260)) for _ in range(30)]
    passage = prose(rng, 120)
    near = [" ".join(w if rng.random() > 0.02 else "changed" for w in base[0].split()) for _ in range(8)]
    shared = [prose(rng, 60) + " " + passage + " " + prose(rng, 60) for _ in range(6)]
    return base + base[:4] + [base[0]] * 6 + near + shared + ODD + ["one", "a" * 3000]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as documents with columns whose names the operators use themselves; one id is null, one repeats."""
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), "x", 1) for i, t in enumerate(texts)]
    rows += [(None, texts[1], "en", "src0", 1, "x", 1), (3, texts[3], "en", "src0", 1, "x", 1)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, core STRING, slice INT"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
