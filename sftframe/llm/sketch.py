"""Bottom-k sketches of word shingles as document fingerprints, in DataFrame functions only.

A text's shingles are its runs of ``SIZE`` words (fewer words: the sequence as one; no words: none), in lower case,
as 48-bit hashes.  Its sketch has the ``K`` smallest distinct ones in rising order, so equal texts have equal
sketches.  The union of two sketches, cut to ``K`` again, is the sketch of both texts together, whatever the parts:
long texts are worked through in parts of ``PART`` shingles, and ``merged`` joins the sketches of whole groups of
rows.  From sketches alone follow the share of common shingles (``resemblance``), the share of one set that lies in
the other (``containment``) and the number of distinct shingles (``distinct_count``); all three are exact as long as
a sketch holds its whole set.  As text a sketch is the base64 of six bytes a hash, in the same order.

A null text counts as empty.  Two sketches without shingles resemble each other fully, one of them with none not at
all.  Columns of the input may have any names; ids may repeat or be null.

``digest`` compares each document with the next one by falling id, null ids last; rows that share an id follow each
other by the hash of the text, and the last row is followed by the first.  Texts are shuffled once, by cells of
neighbouring ids: a cell has about ``CELL_ROWS`` rows.  A cell of ``HOT_ROWS`` rows or more is divided by id, and an
id of as many rows by its hashes, so no task depends on how ids are spread.  The first row of a cell is handed to
the cell before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftframe.llm import textcore as X

SIZE = 5
K = 128
PART = 8192
BITS = 48
CELL_ROWS = 64
HOT_ROWS = 8192
#: Cells and ids that are divided are at most this many, however many rows there are: their list is broadcast.
HOT_MOST = 50_000
TASK_BYTES = 24 << 20
#: Cell of null ids: below that of any number.
_NO_CELL = -(2**63)


def words_of(text: Column) -> Column:
    """Lower-case words between white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _cut(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def sketch_of(words: Column, size: int = SIZE, k: int = K) -> Column:
    """The sketch of an array of words; ``words`` should be a plain column, as it is read many times."""
    shingles = F.when(F.size(words) > 0, F.greatest(F.size(words) - (size - 1), F.lit(1))).otherwise(0)

    def hashed(at: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*(F.get(words, at + step) for step in range(size))), 64 - BITS)

    def with_part(found: Column, first: Column) -> Column:
        places = F.sequence(first, F.least(first + PART, shingles) - 1)
        return _cut(F.concat(found, F.transform(places, hashed)), k)

    empty = F.array().cast("array<bigint>")
    parts = F.sequence(F.lit(0), shingles - 1, F.lit(PART))
    return F.when(shingles > 0, F.aggregate(parts, empty, with_part)).otherwise(empty)


def union_of(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two sets together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def _ratio(part: Column, whole: Column, empty: float) -> Column:
    return F.when(F.size(whole) > 0, F.size(part).cast("double") / F.size(whole)).otherwise(F.lit(empty))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among those of either set: 0 to 1, and 1 between equal sketches."""
    both = union_of(a, b, k)
    return _ratio(F.array_intersect(F.array_intersect(both, a), b), both, 1.0)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second set has, too; 1 for an empty first set."""
    both = union_of(a, b, k)
    own = F.array_intersect(both, a)
    return _ratio(F.array_intersect(own, b), own, 1.0)


def distinct_count(sketch: Column, k: int = K) -> Column:
    """Number of distinct shingles: exact below ``k``, else estimated from the largest hash that is kept."""
    estimate = F.lit(float((k - 1) * 2**BITS)) / F.element_at(sketch, -1)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(estimate)


def as_text(sketch: Column) -> Column:
    """Base64 on one line, whatever line length the session's settings ask for."""
    digits = F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), BITS // 4, "0")), "")
    return F.translate(F.base64(F.unhex(digits)), "\r\n", "")


def from_text(fingerprint: Column) -> Column:
    """The sketch that ``as_text`` has written."""
    digits, step = F.hex(F.unbase64(fingerprint)), BITS // 4
    count = F.length(digits) / step
    places = F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: F.conv(F.substring(digits, p * step + 1, F.lit(step)), 16, 10).cast("bigint"))


def merged(rows: DataFrame, group: str, sketch: str, k: int = K) -> DataFrame:
    """``group, sketch`` of all rows of a group together; each task sends at most ``k`` hashes a group."""
    hashes = rows.select(F.col(f"`{group}`").alias("g"), F.explode(F.col(f"`{sketch}`")).alias("h")).distinct()
    least = hashes.withColumn("at", F.row_number().over(Window.partitionBy("g").orderBy("h"))).where(F.col("at") <= k)
    return least.groupBy("g").agg(F.sort_array(F.collect_list("h")).alias("sketch")).withColumnRenamed("g", group)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "sketch", size: int = SIZE, k: int = K) -> DataFrame:
    """Add the sketch of each row's text as ``array<bigint>``."""
    worded = docs.withColumn("_sketch_words", words_of(F.col(f"`{text}`").cast("string")))
    return worded.withColumn(out, sketch_of(F.col("_sketch_words"), size, k)).drop("_sketch_words")


def _cells(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text, h`` and the place of each row in cells by falling order: ``cell, id, part``."""
    number, body = F.col(f"`{doc_id}`").cast("bigint"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    least, most, rows = docs.agg(F.min(number), F.max(number), F.count("*")).first()
    width = max(1, CELL_ROWS * ((most or 0) - (least or 0)) // max(rows, 1))
    cell = F.coalesce(F.floor(number.cast("double") / F.lit(float(width))), F.lit(_NO_CELL))
    plain = docs.select(number.alias("doc_id"), body.alias("text"), cell.alias("cell"))
    limit = max(HOT_ROWS, rows // HOT_MOST)
    count = F.count("*").alias("n")
    hot_cells = F.broadcast(plain.groupBy("cell").agg(count).where(F.col("n") >= limit).select("cell", F.lit(True).alias("hot")))
    within = plain.join(hot_cells, "cell", "left")
    ids = within.where("hot").groupBy("doc_id").agg(count).where(F.col("n") >= limit)
    hot_ids = F.broadcast(ids.select(F.col("doc_id").alias("hot_id"), (2 * F.col("n") / limit).cast("int").alias("parts")))
    found = within.join(hot_ids, F.col("doc_id").eqNullSafe(F.col("hot_id")) & F.col("hot"), "left")
    h = F.xxhash64("text")
    # Parts of an id follow each other as its hashes do: both fall.
    part = F.coalesce(F.floor((h / 2.0**64 + 0.5) * F.col("parts")), F.lit(0))
    return found.select("doc_id", "text", h.alias("h"), "cell", F.coalesce(F.when(F.col("hot"), F.col("doc_id")), F.lit(_NO_CELL)).alias("id"), part.alias("part"))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Per row ``doc_id, text, sketch, next_text, next_sketch`` of the row and of the one that follows it."""
    where = ["cell", "id", "part"]
    rows = _cells(docs, doc_id, text)
    tasks = X.task_count(docs.sparkSession, X.volume(rows, "text"), TASK_BYTES)
    dealt = rows.repartition(tasks, *where)
    falling = [F.desc_nulls_last(c) for c in ("doc_id", "h", "text")]

    # Cells in falling order, and before which one each comes; the borders of a piece of the list come from one row
    # per piece, and there are as many pieces as tasks.
    cell = F.struct(*where)
    falling_cells = [F.desc(c) for c in where]
    listed = X.stored(rows.select(*where).distinct().repartitionByRange(*falling_cells).withColumn("piece", F.spark_partition_id()), "sketch-cells")
    inner = listed.select("piece", cell.alias("own"), F.lag(cell).over(Window.partitionBy("piece").orderBy(*falling_cells)).alias("before"))
    across = Window.orderBy("piece")
    to_end = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = listed.groupBy("piece").agg(F.min(cell).alias("last"))
    ends = ends.select("piece", F.coalesce(F.lag("last").over(across), F.last("last").over(to_end)).alias("carried"))
    before = inner.join(F.broadcast(ends), "piece").select(
        *(F.col(f"own.{c}").alias(f"own_{c}") for c in where), F.coalesce("before", "carried").alias("to")
    )

    # The first row of each cell, for the cell before it.
    first = dealt.withColumn("at", F.row_number().over(Window.partitionBy(*where).orderBy(*falling))).where("at = 1")
    named = first.join(before, _same(first, before, where))
    guests = fingerprints(named.select("to", F.col("text").alias("guest_text")), "guest_text", "guest_sketch", k=k)
    guests = guests.select(*(F.col(f"to.{c}").alias(f"to_{c}") for c in where), "guest_text", "guest_sketch")

    ahead = Window.partitionBy(*where).orderBy(*falling)
    known = fingerprints(dealt, k=k).withColumns(
        {"lead_text": F.lead("text").over(ahead), "lead_sketch": F.lead("sketch").over(ahead)}
    )
    return known.join(guests, _same(known, guests, where, "to"), "left").select(
        "doc_id", "text", "sketch", F.coalesce("lead_text", "guest_text").alias("next_text"), F.coalesce("lead_sketch", "guest_sketch").alias("next_sketch")
    )


def _same(left: DataFrame, right: DataFrame, where: list[str], prefix: str = "own") -> Column:
    return (left[where[0]] == right[f"{prefix}_{where[0]}"]) & (left[where[1]] == right[f"{prefix}_{where[1]}"]) & (left[where[2]] == right[f"{prefix}_{where[2]}"])


def digest(docs: DataFrame, k: int = K) -> DataFrame:
    """Per document its size, its fingerprint, that of its edited text, and how like they and the next one's are.

    The edited text ends in the beginning of the next document's text, in place of the last third.
    """
    n = F.length("text")
    lost = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - lost), F.substring(F.col("next_text"), F.lit(1), lost))
    rows = with_next(docs, k=k).select("doc_id", n.cast("bigint").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    both = fingerprints(rows, "edited", "edited_sketch", k=k)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_count(F.col("sketch"), k).alias("distinct_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("kept_share"),
    )
