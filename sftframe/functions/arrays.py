"""Column expressions over token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column) -> Column:
    """For ``select``: the value as a column of its own, so that later filters and explodes do not repeat its work."""
    return F.explode(F.array(value))


def total(values: Column) -> Column:
    """Sum of a numeric array as a double."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def ones(mask: Column) -> Column:
    """Sum of a 0/1 array as a bigint."""
    return F.aggregate(mask, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def pad_right(values: Column, width: Column, pad: Column) -> Column:
    return F.concat(values, F.array_repeat(pad, width - F.size(values)))


def pad_left(values: Column, width: Column, pad: Column) -> Column:
    return F.concat(F.array_repeat(pad, width - F.size(values)), values)


def head(values: Column, n: Column | int) -> Column:
    return F.slice(values, F.lit(1), n if isinstance(n, Column) else F.lit(n))


def tail(values: Column, n: Column | int) -> Column:
    """The last ``n`` values, or all when there are fewer."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.slice(values, F.greatest(F.size(values) - n, F.lit(0)) + 1, n)


def rotate_left(values: Column, n: Column) -> Column:
    return F.concat(F.slice(values, n + 1, F.size(values) - n), F.slice(values, F.lit(1), n))


def rotate_right(values: Column, n: Column) -> Column:
    return rotate_left(values, F.size(values) - n)


def roll_back(values: Column) -> Column:
    """Every value moves one place to the front; the first one becomes the last."""
    return F.when(F.size(values) > 0, rotate_left(values, F.lit(1))).otherwise(values)


def leading_zeros(mask: Column) -> Column:
    first = F.array_position(mask, F.lit(1)).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.lit(0))


def trailing_zeros(mask: Column) -> Column:
    return leading_zeros(F.reverse(mask))


def last_one(mask: Column) -> Column:
    """1-based place of the last 1; 0 when there is none."""
    found = F.array_position(F.reverse(mask), F.lit(1)).cast("int")
    return F.when(found > 0, F.size(mask) - found + 1).otherwise(F.lit(0))


def as_text(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")
