import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sftframe.llm import jaccard as J
from sftframe.llm import textcore as X
from sftframe.llm.graph import components
from pyspark.sql import functions as F

from .conftest import prose


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1 if w else 0)))


def expected(rows):
    """``(doc_id, number of shingles, smallest id of the component)`` of rows ``(doc_id, text)``."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for k, s in enumerate(sets):
        for other, common in Counter(o for x in s for o in having[x]).items():
            if 100 * common >= 75 * (len(s) + len(sets[other]) - common):
                parent[find(k)] = find(other)
        for x in s:
            having[x].append(k)
    least = {}
    for k, (name, _) in enumerate(rows):
        if name is not None:
            least[find(k)] = min(least.get(find(k), name), name)
    return [(name, len(sets[k]), least.get(find(k))) for k, (name, _) in enumerate(rows)]


def test_matches_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    wanted = expected(rows)
    found = [tuple(r) for r in J.digest(docs).collect()]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_chains_and_borders(spark):
    words = [f"w{k}" for k in range(400)]
    chain = [" ".join(words[k * 10 : k * 10 + 120]) for k in range(10)]
    border = [" ".join(["s"] + words[300:319]), " ".join(words[300:319] + ["e"]), "a b c", "A  B\tC", "a b"]
    rows = list(enumerate([*chain, *border]))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert sorted(tuple(r) for r in J.digest(docs).collect()) == sorted(expected(rows))


def test_a_common_passage_links_only_what_is_similar(spark):
    passage = " ".join(f"p{k}" for k in range(90))
    rows = [(k, f"{passage} " + " ".join(f"u{k}x{j}" for j in range(20 + k % 7))) for k in range(60)]
    rows += [(100 + k, rows[5][1] + f" tail{k}") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert sorted(tuple(r) for r in J.digest(docs).collect()) == sorted(expected(rows))


def test_one_of_each(docs, texts):
    kept = J.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    wanted = {n for n, s, c in expected([(r["doc_id"], r["text"]) for r in docs.collect()]) if n is not None and (n == c or s == 0)}
    assert {r["doc_id"] for r in rows if r["doc_id"] is not None} == wanted
    assert len([r for r in rows if r["doc_id"] == 3]) == 1


def test_empty_table(no_docs):
    assert J.digest(no_docs).collect() == [] and J.one_of_each(no_docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7)]
    found = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(path, "x BIGINT, y BIGINT")).collect()}
    assert found == {**{k: 0 for k in range(1, 41)}, **{100 + k: 100 for k in range(1, 30)}}
    assert components(spark.createDataFrame([], "x BIGINT, y BIGINT")).collect() == []


def test_one_of_each_with_repeated_and_null_ids(spark):
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    rows = [(1, a), (2, a + " more"), (2, b), (2, b), (5, c), (5, c + " more"), (None, a), (None, d), (None, d), (None, ""), (None, " "), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    found = [tuple(r) for r in J.one_of_each(docs).collect()]
    five = [t for n, t in found if n == 5]
    assert len(five) == 1 and five[0] in (c, c + " more")
    assert sorted((r for r in found if r[0] != 5), key=str) == sorted([(1, a), (2, b), (None, d), (None, ""), (None, " "), (9, "")], key=str)


def shuffled_bytes(df):
    """Bytes that the shuffles of ``df`` itself move when it is collected."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("dataSize").value() if name == "Exchange" else 0
        children = node.children()
        return own + sum(walk(children.apply(k)) for k in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_texts_that_stay_are_not_shuffled(spark):
    rng = random.Random(3)
    texts = [prose(rng, 120) for _ in range(300)]
    rows = [(k, t) for k, t in enumerate(texts + texts[:60] + [t + " more" for t in texts[60:90]])]
    docs = X.stored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4), "test-docs")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = J.one_of_each(docs)
        moved = shuffled_bytes(kept)
        assert sorted(r["doc_id"] for r in kept.collect()) == list(range(300))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert moved < sum(len(t) for _, t in rows) / 4


@pytest.mark.parametrize("most", [1 << 27, 1 << 15])
def test_without_is_exact_whatever_the_bitmap_leaves_in_doubt(spark, monkeypatch, most):
    monkeypatch.setattr(X, "MOST_MARK_BITS", most)
    rows = spark.range(60_000).select(F.col("id").alias("key"), F.concat(F.lit("row "), F.col("id")).alias("body"))
    rows = rows.unionAll(rows.where("key < 100"))
    numbers = X.stored(rows.select("key").distinct(), "test-numbers")
    dropped, kept = numbers.where("key % 3 = 0"), numbers.where("key % 3 <> 0")
    found = Counter(tuple(r) for r in X.without(rows, "key", dropped, kept).collect())
    assert found == Counter(tuple(r) for r in rows.where("key % 3 <> 0").collect())
    marked = X.marker(dropped, 1)(rows, "key", "mark")
    assert marked.where("key % 3 = 0 and not mark").isEmpty()
    doubt = marked.where("key % 3 <> 0 and mark").count()
    assert doubt < 0.1 * 40_000 if most > 1 << 20 else doubt > 0.1 * 40_000
    assert X.without(rows, "key", dropped.where("false"), numbers).count() == 60_100


def edited(rng, words, edits, tag):
    """The words with some replaced by words that no other text has."""
    words = list(words)
    for k, at in enumerate(rng.sample(range(4, len(words) - 4), edits)):
        words[at] = f"{tag}x{k}"
    return words


def test_pairs_of_a_group_that_is_not_near_enough_grow_no_faster_than_the_group(spark, monkeypatch):
    linked, made = J._linked, {}

    def counted(pairs, sets, percent):
        made[size] = made.get(size, 0) + pairs.count()
        return linked(pairs, sets, percent)

    monkeypatch.setattr(J, "_linked", counted)
    for size in (60, 120):
        rng = random.Random(size)
        base = [f"b{k}" for k in range(200)]
        rows = [(k, " ".join(edited(rng, base, 5, f"u{k}"))) for k in range(size)]
        # A few with one more edit of a text of the group, so that there are links among them.
        rows += [(1000 + k, " ".join(edited(rng, rows[7 * k][1].split(), 1, f"v{k}"))) for k in range(6)]
        docs = X.stored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3), "test-docs")
        wanted = expected(rows)
        assert len({c for _, _, c in wanted}) > size // 2
        assert sorted(tuple(r) for r in J.digest(docs).collect()) == sorted(wanted)
    assert made[120] < 3 * made[60] and made[120] < 120 * 119 / 2 / 4


def test_long_sets_with_bitmaps_of_different_lengths(spark):
    rng = random.Random(4)
    base = [f"b{k}" for k in range(760)]
    rows = []
    for k in range(40):
        words = edited(rng, base, rng.randint(8, 17), f"u{k}")
        cut = rng.choice([0, 0, 60, 110, 150])
        rows.append((k, " ".join(words[cut:] if k % 2 else words[: len(words) - cut])))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    wanted = expected(rows)
    assert 3 < len({c for _, _, c in wanted}) < 40
    assert sorted(tuple(r) for r in J.digest(docs).collect()) == sorted(wanted)


def test_bitmaps_differ_in_no_more_bits_than_sets_in_members(spark):
    rng = np.random.default_rng(2)
    rows = []
    for size in (1, 40, 160, 180, 690, 3000):
        for gone, new in ((0, 0), (size // 10, 0), (size // 5, size // 9), (size // 2, 0), (size // 2, 9 * size)):
            one = rng.integers(0, 2**63, size, dtype=np.uint64)
            two = np.concatenate([one[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)])
            rows.append((gone + new, size, len(J.parities(one)), len(J.parities(two)), J.parities(one).tolist(), J.parities(two).tolist()))
    df = spark.createDataFrame(rows, "differ long, size long, x int, y int, parity_x array<long>, parity_y array<long>")
    found = df.select("differ", "size", "x", "y", J._differing("parity_x", "parity_y").alias("bits")).collect()
    assert all(r["bits"] <= r["differ"] for r in found)
    # Close enough to tell from a link what is far from one.
    assert all(r["bits"] >= 0.7 * r["differ"] for r in found if r["size"] >= 160 and max(r["x"], r["y"]) <= 2 * min(r["x"], r["y"]))
    assert {max(r["x"], r["y"]) // min(r["x"], r["y"]) for r in found} > {1, 2}


def hardly_linked(size):
    """Near copies that are not near enough to link, and a few that link to one of them."""
    rng = random.Random(size)
    base = [f"b{k}" for k in range(200)]
    rows = [(k, " ".join(edited(rng, base, 5, f"u{k}"))) for k in range(size)]
    return rows + [(1000 + k, " ".join(edited(rng, rows[7 * k][1].split(), 1, f"v{k}"))) for k in range(6)]


@pytest.mark.parametrize("few", [X.FEW_ROWS, 0])
def test_a_group_that_is_not_near_enough_takes_one_round(spark, monkeypatch, few):
    joined, linked, calls = J.components, J._linked, []
    monkeypatch.setattr(J, "components", lambda edges: calls.append("components") or joined(edges))
    monkeypatch.setattr(J, "_linked", lambda *a: calls.append("linked") or linked(*a))
    monkeypatch.setattr(X, "FEW_ROWS", few)
    rows = hardly_linked(100)
    docs = X.stored(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3), "test-docs")
    assert sorted(tuple(r) for r in J.digest(docs).collect()) == sorted(expected(rows))
    # The star pairs of the first order, and what is left after a round that tells that it is little.
    assert calls.count("linked") == 2 and calls.count("components") <= 2


def test_components_of_repeated_edges_in_any_direction(spark):
    edges = [(5, 2), (2, 5), (5, 2), (9, 9), (7, 2), (11, 10), (10, 11)]
    found = components(spark.createDataFrame(edges, "x BIGINT, y BIGINT")).collect()
    assert sorted(tuple(r) for r in found) == [(5, 2), (7, 2), (11, 10)]
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    least = list(range(300))
    for _ in range(300):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    found = components(spark.createDataFrame(edges, "x BIGINT, y BIGINT").repartition(3)).collect()
    assert sorted(tuple(r) for r in found) == [(v, c) for v, c in enumerate(least) if c != v]
