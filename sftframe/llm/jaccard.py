"""Jaccard join of documents on their word shingles, with prefix filters under several global orders.

A document's set has the distinct shingles of ``SIZE`` words (fewer words: the sequence as one; none: empty, linked
with nothing).  Two documents link when ``100 * common >= 75 * union``.

1. Shingles are counted over all documents.  They go out as numbers of ``BITS`` bits, packed by slice; a slice
   answers only for shingles that several documents have.
2. In the first order shingles are sorted by document frequency.  Linked documents share a shingle among their
   first ``n - ceil(0.75 n) + 1``.  A document whose prefix is full of shingles that no other has is out, so what
   goes on are documents that mostly consist of shared shingles.  The other orders sort by frequency with other
   ties, and by the magnitude of the frequency; linked documents share a prefix shingle under each of them.
3. Documents with equal sets are one class.  Of each prefix shingle of the first order, every class is paired with
   the smallest class that has it, so pairs grow with the postings, however long they are.  Pairs that pass the
   filters of all orders are verified by their exact common shingles, and linked ones form components.
4. What remains are shingles whose classes lie in several components.  Rounds pair those classes with a pivot of
   each such shingle, drawn anew; when few pairs across components are left, or a round links few of its pairs, all
   of them are made, each at the first shingle that both prefixes have and only between sizes that can link.  A round
   whose pairs tell that few are left goes on to all of them at once, without components in between.
   Bounds on sizes and on places in the prefix, the filters and the verification are the same.  Two classes of one
   component need no pair, so no link between components is lost.
5. Each class has a bitmap with the parities of its shared shingles.  Two bitmaps differ in at most as many bits as
   the sets differ in shingles, so a pair whose bitmaps differ in more than a link allows is dropped within the join
   of step 4, where pairs are more than ``DENSE`` times the rows (bitmaps are wide).  Near copies that are not near enough thus make no rows, however large their group; what is left are
   links and pairs close to the limit.

Sets and texts are wide: copies among them, and sets that no pair names, are told apart by bitmaps of row numbers
(``textcore.marker``), so that the others need not be shuffled.  Narrow tables of few rows are broadcast as they are.

Rounds end: a round pairs classes of different components only, and one after which there is another has linked at
least one pair, so the number of components falls with each; there are at most as many rounds as classes.  The
number of slices and of tasks follows the bytes of the texts (``TASK_BYTES``), so what a task holds does not grow.

Counts of common shingles use the 48-bit numbers; two shingles of a compared pair differ in them but for one chance
in 2^48.  Ids may be null or repeated: rows are told apart by a number of their own.  Names of other columns do not
matter.  ``component_id`` is the smallest id reachable; a row that reaches no id has null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftframe.llm import textcore as X
from sftframe.llm.graph import components

SIZE = 5
PERCENT = 75
BITS = 48
WORTHWHILE = 0.05
#: Bits of a bitmap for each shared shingle at least, and 64-bit words of the shortest bitmap; lengths are powers of two.
PARITY_BITS, PARITY_WORDS = 6, 16
#: Pairs for each row of an open shingle above which rows take their bitmaps along.
DENSE = 16
#: Shingles of a unit of documents at least, and for each slice, so that rows between tasks do not become tiny.
UNIT, UNIT_PER_SLICE = 1_000_000, 512
#: Bytes of text whose shingles a task counts, in ``SLICES_PER_TASK`` slices held one at a time.
TASK_BYTES = 16 << 20
SLICES_PER_TASK = 2
_ROW_BITS = 24
_UNIT_BITS = 12

_SENT = pa.schema([("slice", pa.int64()), ("unit", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary()), ("rows", pa.binary()), ("counts", pa.binary()), ("info", pa.binary())])
_SENT_SQL = "slice long, unit long, n long, tokens binary, rows binary, counts binary, info binary"
_FIRST_COLUMNS = "rid long, n_shingles long, one long, two long, own long, first array<long>, second array<long>, third array<long>, shared binary, n_shared long, parity array<long>"


def _units(size: int, percent: int, slices: int):
    """Pack the shingles of a task's documents by slice; a last row per unit (slice below 0) tells about its documents."""

    def emit(unit, tokens, owners, sizes, ids):
        tokens, owners = np.concatenate(tokens), np.concatenate(owners)
        order = np.argsort(tokens, kind="stable")
        tokens, owners = tokens[order], owners[order]
        bounds = (np.arange(slices + 1, dtype=object) << BITS) // slices
        cuts = np.searchsorted(tokens, np.array([int(b) for b in bounds[1:-1]], np.uint64))
        cuts = np.concatenate([[0], cuts, [len(tokens)]])
        for k in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[k], cuts[k + 1])
            yield (int(k), unit, int(cuts[k + 1] - cuts[k]), X.pack(np.diff(tokens[part], prepend=np.uint64(0))), X.pack(owners[part].astype(np.uint32)), None, None)
        info = np.stack([np.concatenate(x).view(np.int64) for x in (ids, *sizes)])
        yield (-1 - unit % slices, unit, info.shape[1], None, None, None, X.pack(info.ravel()))

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SENT)], schema=_SENT)

    full = max(UNIT, UNIT_PER_SLICE * slices)

    def run(batches):
        number = TaskContext.get().partitionId() << _UNIT_BITS
        tokens, owners, sizes, ids, n_rows, n_tokens = [], [], ([], [], []), [], 0, 0
        for batch in batches:
            buffer, starts = X.text_bytes(batch.column(1))
            names = batch.column(0).to_numpy(zero_copy_only=False)
            for first, last, data, at in X.chunks(buffer, starts):
                if n_tokens >= full or n_rows + last - first >= 1 << _ROW_BITS:
                    yield batch_of(list(emit(number, tokens, owners, sizes, ids)))
                    number += 1
                    tokens, owners, sizes, ids, n_rows, n_tokens = [], [], ([], [], []), [], 0, 0
                _, _, hashes, words = X.words(data, at, X.NOT_SPACE)
                values, rows = X.shingle_hashes(hashes, words, size)
                count = np.diff(rows)
                owner = np.repeat(np.arange(last - first), count)
                mixed = X.mix(values ^ np.uint64(0x5851F42D4C957F2D))
                total = lambda v: np.diff(np.concatenate([[np.uint64(0)], np.cumsum(v, dtype=np.uint64)])[rows])
                for kept, value in zip(sizes, (count.astype(np.int64), total(values), total(mixed))):
                    kept.append(value)
                tokens.append(values >> np.uint64(64 - BITS))
                owners.append(owner + n_rows)
                ids.append(names[first:last])
                n_rows += last - first
                n_tokens += len(values)
        if n_rows:
            yield batch_of(list(emit(number, tokens, owners, sizes, ids)))
        X.give_back()

    return run


def _count(batches):
    """Per slice: how many documents have each shingle; answer to each unit for those with two or more."""

    def answer(asked):
        if not asked:
            return
        tokens = [np.cumsum(X.unpack(r["tokens"], np.uint64, r["n"]), dtype=np.uint64) for r in asked]
        every = np.sort(np.concatenate(tokens), kind="stable")
        change = np.ones(len(every), bool)
        change[1:] = every[1:] != every[:-1]
        first = np.flatnonzero(change)
        times = np.diff(np.append(first, len(every)))
        common, times = every[first][times > 1], times[times > 1]
        del every, change
        if not len(common):
            return
        rows = []
        for r, own in zip(asked, tokens):
            at = np.minimum(np.searchsorted(common, own), len(common) - 1)
            kept = common[at] == own
            if kept.any():
                own, at = own[kept], at[kept]
                owners = X.unpack(r["rows"], np.uint32, r["n"])[kept]
                rows.append((r["slice"], r["unit"], len(own), X.pack(np.diff(own, prepend=np.uint64(0))), X.pack(owners), X.pack(times[at].astype(np.uint32)), None))
        for at in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 256]), _SENT)], schema=_SENT)

    asked: list[dict] = []
    for batch in batches:
        about = batch.filter(pc.less(batch.column(0), 0))
        if about.num_rows:
            yield about
        for row in batch.filter(pc.greater_equal(batch.column(0), 0)).to_pylist():
            if asked and row["slice"] != asked[0]["slice"]:
                yield from answer(asked)
                asked = []
            asked.append(row)
    yield from answer(asked)
    X.give_back()


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The smallest number of common shingles that a set can have with one that it links to."""
    return -(-percent * sizes // 100)


def parities(mixed: np.ndarray) -> np.ndarray:
    """Bitmap of a set of mixed numbers: a bit tells whether an odd number of them falls on it."""
    words = max(PARITY_WORDS, 1 << (-(-PARITY_BITS * len(mixed) // 64) - 1).bit_length())
    odd = np.bincount((mixed & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _prefixes(percent: int):
    """Per unit: put the answers together by document and cut the prefixes under the three orders."""
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 3 + [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
    names = ["rid", "n_shingles", "one", "two", "own", "first", "second", "third", "shared", "n_shared", "parity", "doc_id"]
    schema = pa.schema(list(zip(names, kinds)))

    def documents(rows):
        info = next(r for r in rows if r["slice"] < 0)
        n = info["n"]
        ids, sizes, ones, twos = X.unpack(info["info"], np.int64, 4 * n).reshape(4, n)
        parts = [r for r in rows if r["slice"] >= 0]
        join = lambda name, kind: np.concatenate([X.unpack(r[name], kind, r["n"]) for r in parts]) if parts else np.zeros(0, kind)
        tokens = np.concatenate([np.cumsum(X.unpack(r["tokens"], np.uint64, r["n"]), dtype=np.uint64) for r in parts]) if parts else np.zeros(0, np.uint64)
        owners, counts = join("rows", np.uint32).astype(np.int64), join("counts", np.uint32).astype(np.int64)
        order = np.lexsort((tokens, counts, owners))
        tokens, owners, counts = tokens[order].astype(np.int64), owners[order], counts[order]
        at = np.searchsorted(owners, np.arange(n + 1))
        own = sizes - np.diff(at)
        length = np.where(sizes > 0, sizes - needed(sizes, percent) + 1, 0) - own
        result = []
        for k in range(n):
            rid, a, b = (info["unit"] << _ROW_BITS) + k, at[k], at[k + 1]
            if length[k] <= 0 or a == b:
                result.append((rid, int(sizes[k]), int(ones[k]), int(twos[k]), int(own[k]), None, None, None, None, 0, None, int(ids[k])))
                continue
            mine, times, cut = tokens[a:b], counts[a:b], length[k]
            mixed = X.mix(mine.view(np.uint64))
            second = mine[np.lexsort((mixed, times))[:cut]]
            third = mine[np.lexsort((X.mix(mixed), np.frexp(times.astype(np.float64))[1]))[:cut]]
            result.append((rid, int(sizes[k]), int(ones[k]), int(twos[k]), int(own[k]), mine[:cut], np.sort(second), np.sort(third), X.pack(np.diff(np.sort(mine), prepend=0)), b - a, parities(mixed), int(ids[k])))
        for begin in range(0, n, 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*result[begin : begin + 2000]), kinds)], schema=schema)

    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["unit"] != rows[0]["unit"]:
                    yield from documents(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield from documents(rows)
        X.give_back()

    return run


def _verify(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def share(x, y):
        return bool(np.intersect1d(x, y, assume_unique=True).size)

    def run(batches):
        for batch in batches:
            left, right = [], []
            names = batch.schema.names
            columns = {n: batch.column(k) for k, n in enumerate(names)}
            for k in range(batch.num_rows):
                get = lambda n: columns[n][k]
                if not all(share(get(f"{o}_a").values.to_numpy(), get(f"{o}_b").values.to_numpy()) for o in ("second", "third")):
                    continue
                sets = [np.cumsum(X.unpack(get(f"shared_{s}").as_py(), np.int64, get(f"n_shared_{s}").as_py())) for s in "ab"]
                common = np.intersect1d(*sets, assume_unique=True).size
                union = get("n_shingles_a").as_py() + get("n_shingles_b").as_py() - common
                if 100 * common >= percent * union:
                    left.append(get("a").as_py())
                    right.append(get("b").as_py())
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], schema=schema)

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    # Sets that no pair names stay where they are.
    named = pairs.select(F.explode(F.array("a", "b")).alias("rid"))
    if 2 * pairs.count() <= X.FEW_ROWS:
        sets = sets.join(F.broadcast(named), "rid", "left_semi")
    else:
        named = X.stored(named.distinct(), "jaccard-asked")
        sets = X.marker(named, 3)(sets, "rid", "asked").where("asked")
    side = lambda s: sets.select(F.col("rid").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in ("n_shingles", "second", "third", "shared", "n_shared")))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").where(
        (100 * F.col("n_shingles_a") >= percent * F.col("n_shingles_b")) & (100 * F.col("n_shingles_b") >= percent * F.col("n_shingles_a"))
    )
    return both.mapInArrow(_verify(percent), "a long, b long")


def _possible(percent: int):
    """Whether the bounds on sizes and places let rows x and y of one token link at all."""
    after = F.least(F.col("n_shingles_x") - F.col("before_x"), F.col("n_shingles_y") - F.col("before_y"))
    # Before the token they share at most the shared shingles that either has there, then at most what either has left.
    common = after + F.least("at_x", "at_y")
    sizes = 100 * F.least("n_shingles_x", "n_shingles_y") >= percent * F.greatest("n_shingles_x", "n_shingles_y")
    return sizes & ((100 + percent) * common >= percent * (F.col("n_shingles_x") + F.col("n_shingles_y")))


def _differing(x: str, y: str):
    """Bits in which two bitmaps differ; the longer one is folded to the shorter one's length."""
    words = F.least(F.size(x), F.size(y))

    def folded(c):
        part = lambda k: F.slice(c, k * words + 1, words)
        once = F.zip_with(part(0), part(1), lambda a, b: a.bitwiseXOR(b))
        # Sets that link have at least ``percent`` of the other's shared shingles, so lengths differ by a factor of two
        # at most; for other lengths nothing is known.
        return F.when(F.size(c) == words, F.col(c)).when(F.size(c) == 2 * words, once)

    both = F.zip_with(folded(x), folded(y), lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    long = F.aggregate(both, F.lit(0), lambda n, b: n + b)
    short = sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(PARITY_WORDS)), F.lit(0))
    return F.when((F.size(x) == PARITY_WORDS) & (F.size(y) == PARITY_WORDS), short).otherwise(F.coalesce(long, F.lit(0)))


def _near(percent: int):
    """Whether the bitmaps let rows x and y link: they have at most half of what does not differ in common."""
    alike = F.col("n_shared_x") + F.col("n_shared_y") - _differing("parity_x", "parity_y")
    return (100 + percent) * alike >= 2 * percent * (F.col("n_shingles_x") + F.col("n_shingles_y"))


def _size_class(column: str, percent: int):
    """Sizes by powers of what two linked sets can differ by at most."""
    return F.floor(F.log(F.col(column).cast("double")) / float(np.log(100 / percent) * (1 + 1e-9)))


def _across(postings: DataFrame, sets: DataFrame, edges: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Components after the pairs across components that share a token have been tested, too.

    A round pairs the rows of each open token with a pivot of the token's own, so pairs grow with the postings; a
    row meets as many pivots as it has open tokens.  When few pairs are left (in all, or of those that pass the
    bitmaps as the share of a round's pairs tells), or a round has linked less than ``WORTHWHILE`` of its pairs, all that are
    left are tested at once.
    """
    number, progress = 0, True
    parity = sets.select("rid", "n_shared", "parity")
    label = components(edges)
    while True:
        labelled = postings.join(X.hinted(label), F.col("rid") == F.col("vertex"), "left").withColumn("c", F.coalesce("component", "rid"))
        labelled = X.stored(labelled.select("token", "rid", "n_shingles", "at", "before", "c"), "jaccard-labels")
        parts = labelled.groupBy("token", "c").agg(F.count("*").cast("double").alias("n"))
        open_tokens = parts.groupBy("token").agg(
            F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same")
        ).where("parts > 1")
        open_tokens = X.stored(open_tokens.select("token", "n", "same"), "jaccard-open")
        rows, pairs = open_tokens.agg(F.sum("n"), F.sum(F.col("n") * F.col("n") - F.col("same")) / 2).first()
        if not rows:
            return label
        left = X.stored(labelled.join(X.hinted(open_tokens.select("token")), "token"), "jaccard-left")
        number += 1
        dense = pairs > DENSE * rows
        bits = ("n_shared", "parity") if dense else ()
        near = _near(percent) if dense else F.lit(True)
        if dense:
            left = X.stored(left.join(parity, "rid"), "jaccard-dense")
        last = pairs <= rows or not progress
        side = lambda df, s, *more: df.select("token", *(F.col(c).alias(f"{c}_{s}") for c in ("rid", "n_shingles", "at", "before", "c", *bits, *more)))
        untested = lambda joined: joined.select(F.least("rid_x", "rid_y").alias("a"), F.greatest("rid_x", "rid_y").alias("b")).distinct().join(
            X.hinted(tested), ["a", "b"], "left_anti"
        )
        if not last:
            drawn = F.struct(F.xxhash64("rid", "token", F.lit(number)).alias("draw"), *(c for c in left.columns if c != "token"))
            pivots = X.stored(left.groupBy("token").agg(F.min(drawn).alias("p")).select("token", "p.*").drop("draw"), "jaccard-pivots")
            met = side(left, "x").join(side(pivots, "y"), "token").where((F.col("c_x") != F.col("c_y")) & _possible(percent) & near)
            new = X.stored(untested(met), "jaccard-pairs")
            made = new.count()
            # A round makes a pair per row and token; so many of all that a pivot could have made pass.  When they are
            # few, this round's are among them.
            last = dense and made * pairs <= rows * rows
        if last:
            # A pair is made at the first token that both prefixes have, hence once: no earlier one is common.  The
            # larger set lies in the size class of the smaller one or in the next, so the class is joined on, too.
            # Tokens that rows of different components share are open, so the open ones are all that is looked at.
            rows_of = left.groupBy("rid", "n_shingles", "c").agg(
                F.sort_array(F.collect_list(F.struct("at", "before", "token"))).alias("open"),
                *(F.first(b).alias(b) for b in bits),
            )
            prefixed = rows_of.select("rid", "n_shingles", "c", *bits, "open", F.posexplode("open").alias("place", "p")).select(
                "rid", "n_shingles", "c", *bits, "p.*",
                _size_class("n_shingles", percent).alias("size"),
                F.slice("open.token", F.lit(1), F.col("place")).alias("earlier"),
            )
            # The smaller set has all that is common from the first common token on, which must reach for its own size.
            x = prefixed.where((100 + percent) * (F.col("n_shingles") - F.col("before")) >= 2 * percent * F.col("n_shingles"))
            x = side(x, "x", "earlier", "size")
            x = x.withColumn("size", F.explode(F.array("size_x", F.col("size_x") + 1)))
            y = side(prefixed, "y", "earlier", "size").withColumnRenamed("size_y", "size")
            smaller = (F.col("n_shingles_x") < F.col("n_shingles_y")) | ((F.col("n_shingles_x") == F.col("n_shingles_y")) & (F.col("c_x") < F.col("c_y")))
            once = ~F.arrays_overlap("earlier_x", "earlier_y")
            joined = x.join(y, ["token", "size"]).where(smaller & (F.col("c_x") != F.col("c_y")) & _possible(percent) & near & once)
            new = X.stored(untested(joined), "jaccard-pairs")
        more = X.stored(_linked(new, sets, percent), "jaccard-more")
        links = more.count()
        # What is known so far is a star per component, so only the new links have to be worked in.
        label = components(label.unionAll(more)) if links else label
        if last:
            return label
        tested, progress = tested.unionAll(new), links > 0 and links >= WORTHWHILE * made


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, rid`` and ``component``, the smallest row number that it reaches."""
    spark = docs.sparkSession
    # A null id travels as the largest number that no row of a table of numbers would use for an id.
    ids = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(2**63 - 1))
    plain = docs.select(ids.alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("body"))
    tasks = X.task_count(spark, X.volume(plain, "body"), TASK_BYTES)
    slices = SLICES_PER_TASK * tasks
    asked = plain.mapInArrow(_units(size, percent, slices), _SENT_SQL)
    counted = asked.repartition(tasks, "slice").sortWithinPartitions("slice", "unit").mapInArrow(_count, _SENT_SQL)
    found = counted.repartition(tasks, "unit").sortWithinPartitions("unit", "slice").mapInArrow(_prefixes(percent), _FIRST_COLUMNS + ", doc_id long")
    rows = X.stored(found.withColumn("doc_id", F.when(F.col("doc_id") < 2**63 - 1, F.col("doc_id"))), "jaccard-rows")

    some = rows.where("n_shingles > 0")
    classes = some.groupBy("one", "two", "n_shingles").agg(F.min("rid").alias("class"), F.count("*").alias("copies"))
    several = X.stored(classes.where("copies > 1"), "jaccard-classes")
    members = (
        rows.select("rid", "doc_id", "n_shingles", "one", "two")
        .join(X.hinted(several), ["one", "two", "n_shingles"], "left")
        .select("rid", "doc_id", "n_shingles", F.coalesce("class", "rid").alias("class"))
    )
    candidates = rows.where("first is not null")
    named = candidates.select("rid", "one", "two", "n_shingles").join(X.hinted(several), ["one", "two", "n_shingles"], "left")
    named = X.stored(named.select("rid", F.coalesce(F.col("rid") != F.col("class"), F.lit(False)).alias("copy")), "jaccard-copies")
    wide = candidates.select("rid", "n_shingles", "own", "first", "second", "third", "shared", "n_shared", "parity")
    sets = X.stored(X.without(wide, "rid", named.where("copy").select("rid"), named.where("not copy").select("rid")), "jaccard-sets")

    postings = sets.select("rid", "n_shingles", "own", F.posexplode("first").alias("at", "token")).select(
        "token", "rid", "n_shingles", "at", (F.col("own") + F.col("at")).alias("before")
    )
    ends = postings.groupBy("token").agg(F.min("rid").alias("least"), F.max("rid").alias("most")).where("least <> most")
    # Stored, so that the join can split a token that many classes have.
    ends = X.stored(ends.select("token", "least"), "jaccard-tokens")
    postings = X.stored(postings.join(ends, "token"), "jaccard-postings")
    stars = X.stored(postings.where("rid <> least").select(F.col("least").alias("a"), F.col("rid").alias("b")).distinct(), "jaccard-stars")
    edges = X.stored(_linked(stars, sets, percent), "jaccard-edges")
    merged = _across(postings, sets, edges, stars, percent)
    return members.join(X.hinted(merged), F.col("class") == F.col("vertex"), "left").select("doc_id", "n_shingles", "rid", F.coalesce("component", "class").alias("component"))


def digest(docs: DataFrame) -> DataFrame:
    """Per row its number of shingles and the smallest id of its component.

    Components that hold a task's share of all rows or more are at most as many as there are tasks; their smallest
    ids are broadcast, so their rows stay where they are.
    """
    rows = X.stored(similar(docs), "jaccard-similar")
    parts, total = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count()
    least = X.stored(rows.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")), "jaccard-least")
    large = F.broadcast(least.where(F.col("n") * parts >= total).select("component", F.col("n").alias("large"), F.col("component_id").alias("id")))
    split = rows.join(large, "component", "left")
    many = split.where("large is not null").select("doc_id", "n_shingles", F.col("id").alias("component_id"))
    few = split.where("large is null").select("doc_id", "n_shingles", "component").join(least.where(F.col("n") * parts < total), "component")
    return many.unionAll(few.select("doc_id", "n_shingles", "component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component: the smallest id (null last), then the smallest digest of the text.

    Rows are told apart by a 64-bit hash of id and text.  Those that repeat both stay once.  Rows without words are
    no one's copies and stay, also all of those with a null id.
    """
    text = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    number = F.xxhash64("doc_id", text)
    found = X.stored(similar(docs.select(number.alias("doc_id"), "text")), "jaccard-similar")
    rows = found.groupBy(F.col("doc_id").alias("number")).agg(
        F.count("*").alias("_rows"), F.min("n_shingles").alias("n_shingles"), F.min("component").alias("component")
    )
    named = docs.select(number.alias("number"), "doc_id", text.alias("digest")).distinct()
    rows = X.stored(rows.join(named, "number"), "jaccard-named")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "number", "_rows")).alias("first")
    best = rows.where("n_shingles > 0").groupBy("component").agg(first).select("first.number", "first._rows")
    empty = rows.where("n_shingles = 0").select("number", F.when(F.col("doc_id").isNull(), 1).otherwise(F.col("_rows")).alias("_rows"))
    kept = X.stored(best.unionAll(empty), "jaccard-kept")
    once = X.stored(kept.where("_rows = 1").select("number"), "jaccard-once")
    others = X.stored(rows.select("number").distinct().join(once, "number", "left_anti"), "jaccard-others")
    body = docs.select(number.alias("number"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    single = X.without(body, "number", others, once).select("row.*")
    several = kept.where("_rows > 1").select("number")
    if several.isEmpty():
        return single
    asked = X.marker(several, 3)(body, "number", "asked").where("asked").drop("asked")
    return single.unionAll(asked.join(several, "number", "left_semi").select("row.*").dropDuplicates(["doc_id", "text"]))
