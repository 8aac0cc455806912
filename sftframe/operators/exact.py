"""Sums and means of doubles that come out the same, bit for bit, however the rows are divided and merged.

An accumulator is a set of rows ``name, place, amount``: a double is cut without loss into whole digits of base
``2**26``, and digits of one place are added as whole numbers, in any order.  Accumulators are merged by adding their
amounts, so parts of micro-batches or files can be kept and added later.  The sum is the true sum, rounded once to
the nearest double.  A place overflows only beyond ``2**36`` rows of one group.

Nulls are skipped.  NaN and infinities are counted and give what adding them would give.  A group without values has
a null mean and a zero sum; zeros have no sign.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 26
MASK = (1 << BITS) - 1
#: Places beside those of digits: numbers of values, NaN, and both infinities.
VALUES, NANS, HIGHS, LOWS = 1000, 1001, 1002, 1003
#: Places above the highest digit that carries of added digits can reach.
HEADROOM = 3


def _entry(place: Column, amount: Column) -> Column:
    return F.struct(place.cast("int").alias("place"), amount.cast("bigint").alias("amount"))


def _scaled(value: Column, half: Column) -> Column:
    """``value * 4**half`` in two steps, as the factor itself may be no double."""
    factor = F.pow(F.lit(2.0), half)
    return value * factor * factor


def digits(value: Column) -> Column:
    """``place, amount`` entries of a finite double other than zero.

    The logarithm may be off near a power of two; the first digit then has a bit more or the last one is used.
    """
    top = F.floor(F.log2(F.abs(value)) / BITS)
    rest, made = _scaled(value, -top * (BITS // 2)), []
    for i in range(4):
        whole = rest.cast("bigint")
        made.append(_entry(top - i, whole))
        rest = (rest - whole.cast("double")) * float(1 << BITS)
    return F.array(*made)


def _entries(value: Column) -> Column:
    one = F.lit(1)
    special = (
        F.when(F.isnan(value), F.array(_entry(F.lit(NANS), one)))
        .when(value == float("inf"), F.array(_entry(F.lit(HIGHS), one)))
        .when(value == float("-inf"), F.array(_entry(F.lit(LOWS), one)))
        .when(value == 0, F.array(_entry(F.lit(VALUES), F.lit(0))))
        .otherwise(digits(value))
    )
    return F.concat(F.array(_entry(F.lit(VALUES), one)), special)


def parts(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """Accumulators ``*keys, name, place, amount`` of named values; rows are added up before they are shuffled."""
    named = F.array(*[F.struct(F.lit(n).alias("name"), v.cast("double").alias("value")) for n, v in values.items()])
    single = df.select(*keys, F.inline(named)).where(F.col("value").isNotNull())
    cut = single.select(*keys, "name", F.inline(_entries(F.col("value"))))
    return merge(cut.where((F.col("amount") != 0)), keys)


def merge(accumulators: DataFrame, keys: list[str]) -> DataFrame:
    """Add accumulators of the same keys and name."""
    return accumulators.groupBy(*keys, "name", "place").agg(F.sum("amount").alias("amount"))


def _carried(amounts: Column) -> Column:
    """``carry, digits``: amounts, lowest place first, as digits from 0 to the base; what is left has the sign."""
    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.expr("CAST(ARRAY() AS ARRAY<BIGINT>)").alias("digits"))

    def step(made: Column, amount: Column) -> Column:
        here = amount + made["carry"]
        kept = here.bitwiseAND(F.lit(MASK).cast("bigint"))
        return F.struct(F.shiftright(here, BITS).alias("carry"), F.concat(made["digits"], F.array(kept)).alias("digits"))

    return F.aggregate(amounts, start, step)


def sums(accumulators: DataFrame, keys: list[str]) -> DataFrame:
    """``*keys, name, n, total``; a group holds at most one row per place, less than a hundred."""

    def at(place: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("place") == place, F.col("amount"))), F.lit(0).cast("bigint"))

    is_digit = F.col("place") < VALUES
    grouped = accumulators.groupBy(*keys, "name").agg(
        at(VALUES).alias("n"),
        at(NANS).alias("_nans"),
        at(HIGHS).alias("_highs"),
        at(LOWS).alias("_lows"),
        F.min(F.when(is_digit, F.col("place"))).alias("_low"),
        (F.max(F.when(is_digit, F.col("place"))) + HEADROOM).alias("_high"),
        F.map_from_entries(F.collect_list(F.when(is_digit, F.struct("place", "amount")))).alias("_at"),
    )
    nothing = F.lit(0).cast("bigint")
    dense = F.transform(F.sequence("_low", "_high"), lambda p: F.coalesce(F.try_element_at("_at", p), nothing))
    signed = grouped.withColumn("_amounts", dense).withColumn("_made", _carried(F.col("_amounts")))
    negative = F.col("_made")["carry"] < 0
    turned = _carried(F.transform("_amounts", lambda a: -a))["digits"]
    placed = signed.withColumn("_digits", F.reverse(F.when(negative, turned).otherwise(F.col("_made")["digits"])))
    first = F.array_position(F.transform("_digits", lambda d: d != 0), True).cast("int")
    placed = placed.withColumn("_first", first)

    def digit(i: int) -> Column:
        return F.coalesce(F.get("_digits", F.col("_first") - 1 + i), nothing)

    # Four digits hold more than a double does; what is below them only has to be noticed in the last bit, so that
    # the one addition rounds as the whole number would.
    below = F.exists(F.slice("_digits", F.col("_first") + 4, F.size("_digits")), lambda d: d != 0)
    upper = F.shiftleft(digit(0), BITS) + digit(1)
    lower = (F.shiftleft(digit(2), BITS) + digit(3)).bitwiseOR(below.cast("bigint"))
    size = _scaled(upper.cast("double") * float(1 << 2 * BITS) + lower.cast("double"), (F.col("_high") - F.col("_first") - 2) * (BITS // 2))
    finite = F.when(F.coalesce(F.col("_first"), F.lit(0)) == 0, 0.0).otherwise(F.when(negative, -size).otherwise(size))
    total = (
        F.when((F.col("_nans") > 0) | ((F.col("_highs") > 0) & (F.col("_lows") > 0)), float("nan"))
        .when(F.col("_highs") > 0, float("inf"))
        .when(F.col("_lows") > 0, float("-inf"))
        .otherwise(finite)
    )
    return placed.select(*keys, "name", "n", total.alias("total"))


def means(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    """``*keys`` and a column per name with its mean; groups without any value are not there."""
    made = sums(parts(df, keys, values), keys)
    wide = [F.max(F.when(F.col("name") == name, F.col("total") / F.col("n"))).alias(name) for name in values]
    return made.groupBy(*keys).agg(*wide)
