"""Numerically safe column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftframe.functions.arrays import total


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, also where ``body`` uses it inside another lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def neg_log_sigmoid(x: Column) -> Column:
    """``-log(sigmoid(x))`` without overflow for large negative ``x``."""
    return F.greatest(-x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def log_sum_exp(values: Column) -> Column:
    """``log(sum(exp(v)))`` over a double array, taken relative to the maximum."""

    def relative(x: Column, top: Column) -> Column:
        return top + F.log(F.aggregate(x, F.lit(0.0), lambda acc, v: acc + F.exp(v - top)))

    return let(values, lambda x: let(F.array_max(x), lambda top: relative(x, top)))


def softmax(values: Column) -> Column:
    def weights(x: Column) -> Column:
        return let(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top)))

    def shares(w: Column) -> Column:
        return let(total(w), lambda mass: F.transform(w, lambda v: v / mass))

    return let(let(values, weights), shares)
