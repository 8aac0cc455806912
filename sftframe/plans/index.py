"""Dense positions (0, 1, 2, ...) over whole tables, without gathering a group in one task."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftframe.session import cut_lineage

BROADCAST_ROWS = 500_000
_ROWS_PER_BUCKET = 2_000
_MAX_DIGITS = 4
_SELECT_DIGITS = 4
_SELECT_ROWS = 10_000


def seeded_key(*parts: Column) -> Column:
    """Uniform, repeatable sort key of 16 hex digits: the same for any partitioning of the data."""
    return F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 16)


def bucket_digits(rows: int) -> int:
    """Hex digits of the sort key that name a bucket: at most four, with about 2,000 rows per bucket up to there.

    Small buckets make the sort cheaper, as the bucket settles most comparisons.
    """
    digits = 1
    while digits < _MAX_DIGITS and rows > _ROWS_PER_BUCKET * 16**digits:
        digits += 1
    return digits


def among_first(df: DataFrame, key: Column, tie: str, share: Decimal) -> Column:
    """Whether a row is one of the first ``ceil(share * N)`` in ``key, tie`` order, without sorting the table.

    ``key`` is a ``seeded_key``.  Rows are counted per leading digits of the key, then again within the one bucket
    that the limit falls into, until a few rows are left to sort.  The driver sees at most 65,536 counts at a time,
    and the result is a plain comparison with the first row beyond the limit.
    """
    rows = df.select(key.alias("_key"), F.col(tie).alias("_tie"))
    left, limit = None, 0
    for digits in range(_SELECT_DIGITS, 17, _SELECT_DIGITS):
        bucket = F.substring("_key", 1, digits)
        counts = sorted(rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows")).collect())
        if left is None:
            total = sum(row["rows"] for row in counts)
            limit = left = math.ceil(share * total)
            if limit == 0 or limit == total:
                return F.lit(limit > 0)
        for row in counts:
            if left < row["rows"]:
                break
            left -= row["rows"]
        rows = rows.where(bucket == row["bucket"])
        if row["rows"] <= _SELECT_ROWS:
            break
    beyond = rows.orderBy("_key", "_tie").offset(left).first()
    return (key < beyond["_key"]) | ((key == beyond["_key"]) & (F.col(tie) < beyond["_tie"]))


def hashed_positions(
    df: DataFrame,
    key: Column,
    tie: str,
    groups: list[str],
    digits: int,
    position: str = "p",
    size: str = "n",
    n_groups: int = 1,
) -> DataFrame:
    """Add the row's position in ``key, tie`` order within its group, and the size of the group.

    ``key`` is a ``seeded_key``, hence uniform: its first digits cut every group, however large, into even buckets.
    Rows are sorted per bucket; a bucket's first position comes from the counts of the buckets before it.  There
    are at most ``n_groups * 16**digits`` counts.  Up to ``BROADCAST_ROWS`` they are broadcast; beyond, they are
    joined on the columns that the rows are partitioned by already.  ``tie`` must identify a row in its group.
    """
    keyed = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, digits))
    counts = keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_rows"))
    in_group = Window.partitionBy(*groups)
    before = in_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *groups,
        "_bucket",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(in_group).alias(size),
    )
    if n_groups * 16**digits <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    in_bucket = Window.partitionBy("_bucket", *groups).orderBy("_key", tie)
    return (
        keyed.withColumn("_at", F.row_number().over(in_bucket) - 1)
        .join(starts, [*groups, "_bucket"])
        .withColumn(position, (F.col("_start") + F.col("_at")).cast("bigint"))
        .drop("_key", "_bucket", "_at", "_start")
    )


def ranged_positions(df: DataFrame, group: str, order: list[str], position: str) -> DataFrame:
    """Add the row's position (from 0) within ``group`` in the given order, for any distribution of the order.

    The table is range-partitioned by ``group, order``, so that a hot group spreads over many partitions.  The
    checkpoint fixes which partition a row is in.  Only the first group of a partition can have begun in an
    earlier one, so the table of carried counts has at most one row per partition and is safe to broadcast.
    ``group, order`` must identify a row; a null group is a group like any other.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(parts, group, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(group, "_part")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_carried", F.sum("_rows").over(before))
        .where(F.col("_carried") > 0)
        .select(group, "_part", "_carried")
    )
    in_part = Window.partitionBy("_part", group).orderBy(*order)
    return (
        ranged.withColumn("_in_part", F.row_number().over(in_part) - 1)
        .join(
            F.broadcast(carried.select(F.col(group).alias("_group"), F.col("_part").alias("_in"), "_carried")),
            F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_in")),
            "left",
        )
        .withColumn(position, (F.coalesce("_carried", F.lit(0)) + F.col("_in_part")).cast("bigint"))
        .drop("_part", "_in_part", "_carried", "_group", "_in")
    )
