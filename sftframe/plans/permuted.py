"""Epoch order by arithmetic: a keyed bijection says where each row stands, so an epoch needs no sort and no shuffle.

Rows are numbered once (``numbered``).  A number below ``n`` is written as a pair ``(l, r)`` with ``l < a`` and
``r < b``, where ``a * b`` is at least ``n`` and exceeds it by less than ``a``.  Each round adds a keyed function of one
half to the other, modulo its size, so any number of rounds is a bijection of the pairs and runs backwards as well.  A
number that leaves ``0 .. n - 1`` is permuted again until it is back; it walks over numbers beyond ``n`` only, of which
there are fewer than ``a``.  Places of all epochs and their inverse follow from the seed alone.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftframe.options import SftOptions
from sftframe.plans.index import ranged_positions

ROUNDS = 8
PRIME = 2**31 - 1
#: Repeats after which a walk is given up with an error; its chance is below n to the power of minus half of it.
MOST_STEPS = 64
_KEYS = "split STRING, epoch INT, n BIGINT, a BIGINT, b BIGINT, keys ARRAY<STRUCT<left BOOLEAN, x BIGINT, y BIGINT, z BIGINT>>"


def halves(n: int) -> tuple[int, int]:
    """``a, b`` with ``a * b >= n`` and less than ``a`` to spare."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1) if n > 1 else 1
    return a, max(1, -(-n // a))


def round_keys(seed: int, epoch: int, split: str, rounds: int = ROUNDS) -> list[tuple]:
    """Three numbers of 28 bits a round from a hash of seed, epoch and split."""
    part = lambda r, k: int(hashlib.md5(f"{seed}|{epoch}|{split}|{r}|{k}".encode()).hexdigest()[:7], 16)
    return [(r % 2 == 0, part(r, 0), part(r, 1) + 1, part(r, 2)) for r in range(rounds)]


def key_table(spark: SparkSession, sizes: dict[str, int], opts: SftOptions) -> DataFrame:
    """One row per split and epoch: sizes and round keys."""
    rows = [
        (split, epoch, n, *halves(n), round_keys(opts.seed, epoch, split)) for split, n in sizes.items() for epoch in range(opts.num_epochs)
    ]
    return spark.createDataFrame(rows, _KEYS)


def _mixed(half: Column, key: Column) -> Column:
    return ((half + key["x"]) * key["y"] + key["z"]) % PRIME


def _once(place: Column, forward: bool) -> Column:
    a, b = F.col("a"), F.col("b")
    keys = F.col("keys") if forward else F.reverse("keys")
    sign = 1 if forward else -1

    def step(s: Column, key: Column) -> Column:
        left = F.when(key["left"], F.pmod(s["l"] + sign * _mixed(s["r"], key), a)).otherwise(s["l"])
        right = F.when(~key["left"], F.pmod(s["r"] + sign * _mixed(s["l"], key), b)).otherwise(s["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    start = F.struct(F.floor(place / b).alias("l"), F.pmod(place, b).alias("r"))
    return F.aggregate(keys, start, step, lambda s: s["l"] * b + s["r"])


def _permuted(df: DataFrame, number: str, out: str, forward: bool) -> DataFrame:
    first, n = df.withColumn(out, _once(F.col(number), forward)), F.col("n")
    steps = F.sequence(F.lit(1), F.lit(MOST_STEPS))
    walked = F.aggregate(steps, F.col(out), lambda x, _: F.when(x < n, x).otherwise(_once(x, forward)))
    inside = first.withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(walked))
    return inside.withColumn(out, F.when(F.col(out) < n, F.col(out)).otherwise(F.raise_error(F.lit("a walk did not end")).cast("bigint")))


def places(df: DataFrame, number: str = "i", out: str = "p") -> DataFrame:
    """Add the place of each row number; ``df`` has the columns of ``key_table``."""
    return _permuted(df, number, out, True)


def numbers(df: DataFrame, place: str = "p", out: str = "i") -> DataFrame:
    """Add the row number at each place: the inverse of ``places``."""
    return _permuted(df, place, out, False)


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``i``, the row's number within its split by rising ``pair_id``; to be written once, for all epochs."""
    return ranged_positions(rows, "split", ["pair_id"], "i")


def split_counts(rows: DataFrame) -> dict[str, int]:
    return {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}


def _slots(df: DataFrame, opts: SftOptions) -> DataFrame:
    world, size, p, n = F.lit(opts.world_size), F.lit(opts.batch_size), F.col("p"), F.col("n")
    used = p < F.floor(n / world) * world
    if opts.single_process:
        used = (F.col("split") == "test") | (p < F.floor(n / size) * size)
    in_rank = F.floor(p / world)
    return df.where(used).withColumns(
        {"rank": F.pmod(p, world).cast("int"), "batch": F.floor(in_rank / size), "slot": F.pmod(in_rank, size).cast("int")}
    )


def epoch_order(rows: DataFrame, opts: SftOptions) -> DataFrame:
    """``split, epoch, pair_id, n_tokens, p, rank, batch, slot`` of all epochs from ``numbered`` rows, without a shuffle.

    Which rows are used follows ``epochs.epoch_plan``.  The table of keys has a row per split and epoch.
    """
    keys = F.broadcast(key_table(rows.sparkSession, split_counts(rows), opts))
    placed = places(rows.join(keys, "split"))
    return _slots(placed, opts).select("split", "epoch", "pair_id", "n_tokens", "p", "rank", "batch", "slot")


def row_numbers(spark: SparkSession, sizes: dict[str, int], opts: SftOptions, split: str, epoch: int, rank: int, first_batch: int = 0) -> DataFrame:
    """``batch, slot, i`` of the rows that a rank reads in an epoch from ``first_batch`` on, from the sizes alone."""
    n = sizes.get(split, 0)
    mine = n // opts.world_size
    if opts.single_process:
        mine = n if split == "test" else n // opts.batch_size * opts.batch_size
    first = min(first_batch * opts.batch_size, mine)
    keys = F.broadcast(key_table(spark, {split: n}, opts).where(F.col("epoch") == epoch))
    at = spark.range(first, mine).crossJoin(keys).withColumn("p", F.col("id") * opts.world_size + rank)
    size = F.lit(opts.batch_size)
    return numbers(at).select(F.floor(F.col("id") / size).alias("batch"), F.pmod("id", size).cast("int").alias("slot"), "i")
