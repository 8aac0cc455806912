"""Prefix trie of conversations, built as burst tries over shards.

A conversation is the sequence of its turns; a node of the trie is a distinct sequence of first turns.  A turn is
known by two 64-bit hashes of role and text.

1. Conversations are cut into segments of ``SEGMENT`` turns, so none is held whole; a segment hangs under the hash
   of all turns before it.  Equal segments under one such head are one entry with a count, so copies cost nothing.
2. The entries under a head are a container.  A container of more than ``BURST`` entries is burst: its entries go to
   new containers by their next turn id, and its head becomes a head node of those.  A round bursts all oversized
   containers at once; there are at most as many rounds as a segment has turns.
3. What is left are containers of bounded size, dealt out over the tasks, sorted by their turns and swept into nodes:
   the turns that an entry shares with the one before stay open, the others are closed and counted.
4. Head nodes are put together from the containers below them.  What hangs below a segment's last turn (segments of
   longer conversations) is summed first and handed to the sweep: each container's sum goes to its smallest member,
   and adds up along that conversation from its end.

Conversations that end at a node are hashed as a list of ids in numeric order, read as a sorted stream; a list of one
id never leaves the JVM.  SHA-256 is sequential, so a list is one task's work, in constant memory.

Turns are ordered by ``turn``, null first, ties by their hashes; null role or text counts as empty.  Rows without a
``conv_id`` belong to no conversation.  Without conversations there are no nodes, not even a root.  Other columns do
not matter.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftframe.llm import textcore as X
from sftframe.plans.index import ranged_positions

SEGMENT = 64
BURST = 8192
TASK_BYTES = 16 << 20
#: Conversations are rebuilt on the first one of their hundred, by at most five turns of it.
GROUP, MOST_SHARED = 100, 6

_BOX = ["b1", "b2"]
_SWEPT = pa.schema(
    [(n, pa.int64()) for n in ("b1", "b2", "p1", "p2", "s", "level", "above", "conv", "parent", "depth", "n", "kids", "leaves", "saved", "size", "e1", "e2")]
)
_SWEPT_SQL = ", ".join(f"{f.name} long" for f in _SWEPT)


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``c, p, a, b, size``: conversation, place of the turn, its hashes, and the code points of its text; stored."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = conversations.select(
        F.col(f"`{conv_id}`").cast("bigint").alias("c"), F.col(f"`{turn}`").alias("turn"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(text, role, F.lit(1)).alias("b"), F.length(text).cast("bigint").alias("size"),
    ).where("c is not null")
    return X.stored(ranged_positions(rows, "c", ["turn", "a", "b"], "p").drop("turn"), "trie-turns")


def own_paths(turns: DataFrame) -> DataFrame:
    """``c, q, a, b, size, total``: conversations as they are."""
    total = turns.groupBy("c").agg((F.max("p") + 1).alias("total"))
    return turns.join(total, "c").withColumnRenamed("p", "q")


def rebuilt_paths(turns: DataFrame) -> DataFrame:
    """``c, q, a, b, size, total``: each conversation with its first turns replaced by those of its hundred's first.

    How many is the CRC-32 of the id modulo ``MOST_SHARED``.  A conversation left without turns has one row with a
    null ``q``.
    """
    c = F.col("c")
    lengths = turns.groupBy("c").agg((F.max("p") + 1).alias("n"))
    bases = lengths.where(c % GROUP == 0).select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    named = lengths.select("c", "n", (c - c % GROUP).alias("base"), (F.crc32(c.cast("string")) % MOST_SHARED).alias("h"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    total = (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")
    convs = named.join(bases, "base", "left").withColumn("taken", taken).select("c", "base", "h", "taken", total)
    convs = X.stored(convs, "trie-conversations")
    heads = turns.where((c % GROUP == 0) & (F.col("p") < MOST_SHARED - 1)).withColumnRenamed("c", "base")
    first = convs.join(heads, "base").where("p < taken").select("c", F.col("p").alias("q"), "a", "b", "size", "total")
    rest = turns.join(convs, "c").where("p >= h").select("c", (F.col("taken") + F.col("p") - F.col("h")).alias("q"), "a", "b", "size", "total")
    none = convs.where("total = 0").select("c", *(F.lit(None).cast("bigint").alias(n) for n in ("q", "a", "b", "size")), "total")
    return first.unionByName(rest).unionByName(none)


def _segments(paths: DataFrame) -> DataFrame:
    """``c, s, ids, sizes, ends, k1, k2, n1, n2``: segment ``s`` of a conversation under the key of what is before it;
    the second key includes the segment."""
    s = F.coalesce(F.floor(F.col("q") / SEGMENT), F.lit(0)).alias("s")
    turn = F.when(F.col("q").isNotNull(), F.struct("q", "a", "b", "size"))
    rows = paths.groupBy("c", "total", s).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    ids = F.flatten(F.transform("t", lambda x: F.array(x["a"], x["b"])))
    ends = F.col("s") == F.greatest(F.floor((F.col("total") - 1) / SEGMENT), F.lit(0))
    rows = rows.select("c", "total", "s", ids.alias("ids"), F.col("t.size").alias("sizes"), ends.alias("ends"))
    rows = rows.withColumns({"d1": F.xxhash64("s", "ids"), "d2": F.xxhash64(F.lit(1), "s", "ids")})
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    short = rows.where(F.col("total") <= SEGMENT).withColumns({k: F.lit(0).cast("bigint") for k in ("k1", "k2")})
    long = rows.where(F.col("total") > SEGMENT).withColumns({f"k{j}": F.coalesce(F.bit_xor(f"d{j}").over(before), F.lit(0)) for j in (1, 2)})
    both = short.unionByName(long).withColumns({f"n{j}": F.col(f"k{j}").bitwiseXOR(F.col(f"d{j}")) for j in (1, 2)})
    return X.stored(both.drop("d1", "d2", "total"), "trie-segments")


def _burst(entries: DataFrame, limit: int) -> tuple[DataFrame, list[DataFrame]]:
    """Entries in containers of at most ``limit`` (or at whose head all entries end), and the burst heads by level."""
    done, heads, level = [], [], 0
    left = entries.withColumns({"b1": F.xxhash64("s", "k1", "k2"), "b2": F.xxhash64("k2", "s", "k1"), "level": F.lit(0).cast("bigint")})
    left = left.withColumns({"p1": F.lit(None).cast("bigint"), "p2": F.lit(None).cast("bigint")})
    while True:
        large = X.stored(left.groupBy(*_BOX).agg(F.count("*").alias("m")).where(F.col("m") > limit).select(*_BOX), "trie-large")
        if large.isEmpty():
            return X.stored(_union([*done, left]), "trie-containers"), heads
        done.append(left.join(large, _BOX, "left_anti"))
        burst = left.join(large, _BOX, "left_semi")
        size = F.coalesce(F.get("sizes", F.lit(level - 1)), F.lit(0)) if level else F.lit(0).cast("bigint")
        heads.append(X.stored(burst.groupBy(*_BOX).agg(*(F.min(c).alias(c) for c in ("p1", "p2", "s", "level", "above")), F.min(size).alias("size")), "trie-heads"))
        done.append(burst.where(F.size("sizes") == level))
        deeper = burst.where(F.size("sizes") > level)
        a, b = (F.get("ids", F.lit(2 * level + k)) for k in (0, 1))
        deeper = deeper.withColumns(
            {"p1": F.col("b1"), "p2": F.col("b2"), "b1": F.xxhash64("b1", "b2", a, b), "b2": F.xxhash64("b2", b, "b1", a), "level": F.lit(level + 1).cast("bigint")}
        )
        left, level = X.stored(deeper, "trie-burst"), level + 1


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


class _Node:
    __slots__ = ("level", "size", "conv", "n", "kids", "leaves", "saved", "end", "below")

    def __init__(self, level: int, size: int):
        self.level, self.size = level, size
        self.conv, self.n, self.kids, self.leaves, self.saved, self.end, self.below = None, 0, 0, 0, 0, (None, None), []

    def meet(self, conv: int, n: int, leaves: int, saved: int) -> None:
        self.conv = conv if self.conv is None or conv < self.conv else self.conv
        self.n += n
        self.leaves += leaves
        self.saved += saved


def _sweep(segment: int):
    """Sorted containers in, nodes out: inner ones with their parent's conversation, and one row per container's head."""

    def run(batches):
        out: list[tuple] = []
        box, about, stack, last = None, None, [], []

        def close() -> None:
            """Count the deepest open node into its parent; its children know their parent's conversation now."""
            node, parent = stack.pop(), stack[-1]
            leaves, saved = (node.leaves if node.kids else 1), node.saved + (node.n - 1) * node.size
            parent.kids += 1
            parent.meet(node.conv, node.n, leaves, saved)
            parent.below.append((node.conv, about["s"] * segment + node.level, node.n, node.kids, leaves, saved, node.end))
            tell(node.below, node.conv)

        def tell(below: list[tuple], parent: int) -> None:
            for conv, depth, n, kids, leaves, saved, end in below:
                out.append((None, None, None, None, None, None, None, conv, parent, depth, n, kids, leaves, saved, None, *end))

        def finish() -> None:
            while len(stack) > 1:
                close()
            head = stack.pop()
            virtual = about["level"] == 0 and about["s"] > 0
            tell(head.below, about["above"] if virtual else head.conv)
            depth = about["s"] * segment + about["level"]
            out.append((*box, about["p1"], about["p2"], about["s"], about["level"], about["above"], head.conv, None, depth, head.n, head.kids, head.leaves, head.saved, head.size, *head.end))

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_SWEPT)

        for rows in batches:
            for row in rows.to_pylist():
                ids, sizes = row["ids"], row["sizes"]
                if (row["b1"], row["b2"]) != box:
                    if box is not None:
                        finish()
                    box, about, last = (row["b1"], row["b2"]), row, ids
                    level = row["level"]
                    stack, common = [_Node(level, sizes[level - 1] if level else 0)], level
                else:
                    common, most = about["level"], min(len(ids), len(last)) // 2
                    while common < most and ids[2 * common : 2 * common + 2] == last[2 * common : 2 * common + 2]:
                        common += 1
                    last = ids
                while stack[-1].level > common:
                    close()
                stack += [_Node(at + 1, sizes[at]) for at in range(common, len(sizes))]
                node = stack[-1]
                node.meet(row["conv"], row["n"], row["leaves"], row["saved"])
                node.kids += row["kids"]
                if row["ends"]:
                    node.end = (row["n1"], row["n2"])
                if len(out) >= 20_000:
                    yield batch()
                    out.clear()
        if box is not None:
            finish()
            yield batch()
        X.give_back()

    return run


def _counted(boxes: DataFrame, tasks: int, name: str) -> DataFrame:
    sent = boxes.select(*_BOX, "p1", "p2", "s", "level", "above", "ids", "sizes", "conv", "n", "ends", "n1", "n2", "kids", "leaves", "saved")
    dealt = sent.repartition(tasks, *_BOX).sortWithinPartitions(*_BOX, "ids")
    return X.stored(dealt.mapInArrow(_sweep(SEGMENT), _SWEPT_SQL), name)


def _full(leaves: str = "leaves", saved: str = "saved"):
    """What a node's subtree has, from what lies below it."""
    return F.when(F.col("kids") > 0, F.col(leaves)).otherwise(F.lit(1)), F.col(saved) + (F.col("n") - 1) * F.col("size")


def _heads(swept: DataFrame, burst: list[DataFrame]) -> list[DataFrame]:
    """Container heads by level: those of swept containers, and burst ones put together from the level below."""
    own = swept.where("b1 is not null").drop("parent")
    levels = [own.where(F.col("level") == k) for k in range(len(burst) + 1)]
    leaves, saved = _full()
    for k in reversed(range(len(burst))):
        below = levels[k + 1].groupBy(F.col("p1").alias("b1"), F.col("p2").alias("b2")).agg(
            F.min("conv").alias("conv"), F.sum("n").alias("n"), F.count("*").alias("kids"), F.sum(leaves).alias("leaves"), F.sum(saved).alias("saved")
        )
        parts = below.unionByName(levels[k].join(burst[k], _BOX, "left_semi").select(*below.columns, "e1", "e2"), allowMissingColumns=True)
        sums = parts.groupBy(*_BOX).agg(F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")), F.max("e1").alias("e1"), F.max("e2").alias("e2"))
        whole = burst[k].withColumn("depth", F.col("s") * SEGMENT + F.col("level")).join(sums, _BOX)
        levels[k] = X.stored(levels[k].join(burst[k], _BOX, "left_anti").unionByName(whole), "trie-level")
    return levels


def _below_segments(segments: DataFrame, boxes: DataFrame, burst: list[DataFrame], tasks: int) -> DataFrame:
    """``s, n1, n2, kids, leaves, saved``: what hangs below the last turn of a segment ``s`` that others follow."""
    deep = boxes.where("s > 0").withColumn("kids", F.when(F.col("runs_on"), 1).otherwise(0).cast("bigint"))
    swept = _counted(deep, tasks, "trie-swept-below")
    tops = _heads(swept, [h.where("s > 0") for h in burst])[0]
    keys = boxes.where("s > 0 and level = 0").select(*_BOX, "s", "k1", "k2").unionByName(
        segments.where("s > 0").select(F.xxhash64("s", "k1", "k2").alias("b1"), F.xxhash64("k2", "s", "k1").alias("b2"), "s", "k1", "k2")
    ).distinct()
    tops = X.stored(tops.select(*_BOX, "conv", "kids", "leaves", "saved").join(keys, _BOX), "trie-tops")
    along = segments.where("s > 0").select("c", "s", "k1", "k2").join(tops, ["s", "k1", "k2"])
    to_end = Window.partitionBy("c").orderBy(F.desc("s"))
    own = F.col("c") == F.col("conv")
    sums = along.select("s", "k1", "k2", "kids", *(F.sum(F.when(own, F.col(v)).otherwise(0)).over(to_end).alias(v) for v in ("leaves", "saved")))
    found = sums.groupBy("s", "k1", "k2").agg(F.max("kids").alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return X.stored(found.select((F.col("s") - 1).alias("s"), F.col("k1").alias("n1"), F.col("k2").alias("n2"), "kids", "leaves", "saved"), "trie-below")


def _hash_lists(batches):
    """Rows sorted by key and id in, one hash of the comma-joined ids per key out."""
    key, sha, out = None, None, []
    for batch in batches:
        for n1, n2, c in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (n1, n2) == key:
                sha.update(b",%d" % c)
                continue
            if sha is not None:
                out.append((*key, sha.hexdigest()))
            key, sha = (n1, n2), hashlib.sha256(b"%d" % c)
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["e1", "e2", "ends_sha256"])
            out = []
    if sha is not None:
        out.append((*key, sha.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["e1", "e2", "ends_sha256"])


def _end_lists(segments: DataFrame, tasks: int) -> DataFrame:
    """``e1, e2, ends_sha256`` of all sequences at which conversations end."""
    ended = segments.where("ends").select("n1", "n2", "c")
    counts = ended.groupBy("n1", "n2").agg(F.count("*").alias("m"), F.min("c").alias("c"))
    one = counts.where("m = 1").select(F.col("n1").alias("e1"), F.col("n2").alias("e2"), F.sha2(F.col("c").cast("string"), 256).alias("ends_sha256"))
    several = X.stored(counts.where("m > 1").select("n1", "n2"), "trie-ends")
    lists = ended.join(several, ["n1", "n2"], "left_semi").repartition(tasks, "n1", "n2").sortWithinPartitions("n1", "n2", "c")
    return one.unionByName(lists.mapInArrow(_hash_lists, "e1 long, e2 long, ends_sha256 string"))


def nodes(paths: DataFrame, tasks: int, limit: int = BURST) -> DataFrame:
    """Nodes of the trie over ``c, q, a, b, size, total`` (``own_paths`` or ``rebuilt_paths``)."""
    segments = _segments(paths)
    grouped = segments.groupBy("s", "k1", "k2", "ids", "sizes", "n1", "n2").agg(
        F.min("c").alias("conv"), F.count("*").alias("n"), F.max("ends").alias("ends"), F.max(~F.col("ends")).alias("runs_on")
    )
    none = {v: F.lit(0).cast("bigint") for v in ("kids", "leaves", "saved")}
    entries = X.stored(grouped.withColumns(none), "trie-entries")
    above = entries.where("runs_on").select((F.col("s") + 1).alias("s"), F.col("n1").alias("k1"), F.col("n2").alias("k2"), F.col("conv").alias("above"))
    boxes, burst = _burst(entries.join(above, ["s", "k1", "k2"], "left"), limit)
    if not entries.where("runs_on").isEmpty():
        below = _below_segments(segments, boxes, burst, tasks)
        ends = boxes.where("runs_on").drop("kids", "leaves", "saved").join(below, ["s", "n1", "n2"])
        boxes = boxes.where("not runs_on").unionByName(ends)
    swept = _counted(boxes, tasks, "trie-swept")
    levels = _heads(swept, burst)
    leaves, saved = _full()
    columns = ["conv", "depth", "parent", "n", "kids", "leaves", "saved", "e1", "e2"]
    found = swept.where("b1 is null").select(*columns)
    for k, level in enumerate(levels):
        own = level.withColumns({"leaves": leaves, "saved": saved})
        if k:
            over = F.when((F.col("s") > 0) & (F.col("level") == 0), F.col("above")).otherwise(F.col("conv"))
            parents = levels[k - 1].select(F.col("b1").alias("p1"), F.col("b2").alias("p2"), over.alias("parent"))
            own = own.join(parents, ["p1", "p2"])
        else:
            own = own.where("s = 0").withColumn("parent", F.lit(None).cast("bigint"))
        found = found.unionByName(own.select(*columns))
    lists = _end_lists(segments, tasks)
    sha = F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return found.join(lists, ["e1", "e2"], "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), sha.alias("ends_sha256"),
    )


def digest(conversations: DataFrame, limit: int = BURST) -> DataFrame:
    """All nodes of the trie over the rebuilt conversations."""
    tasks = X.task_count(conversations.sparkSession, X.volume(conversations, "text"), TASK_BYTES)
    return nodes(rebuilt_paths(ordered_turns(conversations)), tasks, limit)
