import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from sftframe.llm import trie as T

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, n BIGINT"


def sequences(rows, rebuild=True):
    """Turns of each conversation in order; rows ``(conv_id, turn, role, text)`` without ties."""
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    if not rebuild:
        return own
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return made


def expected(rows, rebuild=True):
    """All prefixes of all conversations, each looked up on its own."""
    members, ended, kids = defaultdict(set), defaultdict(set), defaultdict(set)
    for c, turns in sequences(rows, rebuild).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ended[tuple(turns)].add(c)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        ((min(members[x]), len(x), min(members[x[:-1]]) if x else None, len(members[x]), len(kids[x]), leaves[x], saved[x], sha(ended[x])) for x in members), key=str
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made_rows(seed=3):
    rng, rows = random.Random(seed), []
    common = [("user" if k % 2 else "assistant", f"turn {k} " + "é" * (k % 5)) for k in range(40)]
    for c in [*range(0, 60), *range(100, 130), *range(250, 262), 305]:
        kind = rng.random()
        length = rng.choice([1, 2, 3, 5, 9, 14])
        if kind < 0.4:
            turns = common[:length]
        elif kind < 0.8:
            turns = common[: rng.randint(0, length)] + [("user", f"own {rng.randint(0, 3)}") for _ in range(rng.randint(1, 4))]
        else:
            turns = [("user", f"{c} {k}") for k in range(length)]
        rows += [(c, k if k else rng.choice([None, 0]), r, t, 1) for k, (r, t) in enumerate(turns)]
    return rows + [(None, 1, "user", "nobody", 1), (7000, 0, None, None, 1), (7001, 0, None, "", 1), (7002, 0, "", None, 1)]


@pytest.mark.parametrize(("segment", "limit"), [(64, 8192), (4, 8192), (64, 3), (3, 2), (1, 1)])
def test_matches_brute_force(spark, monkeypatch, segment, limit):
    monkeypatch.setattr(T, "SEGMENT", segment)
    rows = made_rows()
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(T.digest(table, limit)) == expected(rows)


def test_plain_conversations_and_copies(spark, monkeypatch):
    monkeypatch.setattr(T, "SEGMENT", 4)
    rows = [(c, k, "user", f"same {k}", 1) for c in range(40) for k in range(10)] + [(90, k, "user", f"same {k}", 1) for k in range(4)]
    turns = T.ordered_turns(spark.createDataFrame(rows, SCHEMA))
    assert found(T.nodes(T.own_paths(turns), 2, 5)) == expected(rows, rebuild=False)


def test_a_long_conversation_is_held_in_segments(spark):
    rows = [(5, k, "user", f"t{k % 50}", 1) for k in range(1000)] + [(6, k, "user", f"t{k % 50}", 1) for k in range(700)]
    assert found(T.digest(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_conversations_without_turns_left_and_no_rows(spark):
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(alone, 0, "user", "gone", 1)]
    assert found(T.digest(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    assert T.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ties_have_one_order(spark):
    rows = [(1, 0, "user", t, 1) for t in "xyxzx"]
    turns = [T.ordered_turns(spark.createDataFrame(r, SCHEMA)) for r in (rows, rows[::-1])]
    assert found(turns[0]) == found(turns[1])
