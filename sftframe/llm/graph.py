"""Connected components of a table of edges, by alternating large and small stars.

Edges that a step repeats go before the next one, as a vertex would have as many rows there as it had neighbours.  The
question whether all is done takes one shuffle, so that short tables do not wait for tasks without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftframe.llm.textcore import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges ``a > b``; a vertex with many edges is only ever aggregated."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``vertex, component`` (its smallest vertex) of every vertex of ``edges`` that is not the smallest itself.

    ``edges`` has two columns of numbers; the order and repeats of edges do not matter.  It is read several times, so
    what it comes from should be stored.
    """
    a, b = edges.columns
    current = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    if _is_done(current):
        current = stored(current.distinct(), "components")
    else:
        current = stored(_star(_star(current, True), False), "components")
        while not _is_done(current):
            current = stored(_star(_star(current, True), False), "components")
    return current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))


def _is_done(edges: DataFrame) -> bool:
    """Whether every vertex points to one other only, which points to none."""
    ends = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.lit(None).cast("long").alias("b")))
    vertices = ends.groupBy("a").agg(F.min("b").alias("x"), F.max("b").alias("y"), F.count("*").alias("n"), F.count("b").alias("out"))
    return vertices.where("x <> y or (x is not null and n > out)").isEmpty()
