"""Generation from a table of next tokens, by a recursive query.

The next token follows from the last ``order`` ids alone, so requests that end alike go on alike: the query grows one
chain per distinct ending, and requests take the chain of their ending by one join.  A chain stops at EOS, at the cap,
or where the table knows nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftframe.session import shared_folder

GROWN = """
WITH RECURSIVE grown(start, step, context, id) MAX RECURSION LEVEL {levels} AS (
  SELECT context, 0, context, CAST(NULL AS INT) FROM {starts}
  UNION ALL
  SELECT g.start, g.step + 1, slice(concat(g.context, array(f.next)), 2, {order}), f.next
  FROM grown g JOIN {following} f ON f.context = g.context
  WHERE g.step < {cap} AND f.next <> {eos}
)
SELECT start, step, id FROM grown WHERE step > 0
"""


def ending(ids: Column, order: int) -> Column:
    """The last ``order`` ids, or all of a shorter list."""
    return F.slice(ids, F.greatest(F.size(ids) - order + 1, F.lit(1)), F.lit(order))


def next_tokens(sequences: DataFrame, order: int, ids: str = "input_ids") -> DataFrame:
    """``context, next``: the most frequent id after every ``order`` ids, of equal ones the smallest."""
    places = F.sequence(F.lit(1), F.size(ids) - order)
    steps = F.transform(places, lambda i: F.struct(F.slice(ids, i, F.lit(order)).alias("context"), F.element_at(ids, (i + order).cast("int")).alias("next")))
    long_enough = sequences.where(F.size(ids) > order)
    counts = long_enough.select(F.inline(steps)).groupBy("context", "next").agg(F.count("*").alias("times"))
    return counts.groupBy("context").agg(F.max_by("next", F.struct("times", -F.col("next"))).alias("next"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """The table in the shared folder: every step of the recursion reads it, none makes it again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def generate(requests: DataFrame, following: DataFrame, eos_id: int, max_new_tokens: int, order: int = 1) -> DataFrame:
    """Add ``new_ids`` to requests with ``ids``: what the table appends until EOS or the cap; EOS is not appended.

    ``following`` holds ``context`` (the last ``order`` ids) and ``next``, one row per context.  Null or empty ``ids``
    and endings that the table lacks give no new ids.  The query's limit on rows is lifted for the session, as the
    caps on steps and on distinct endings bound them.
    """
    if order < 1 or max_new_tokens < 0:
        raise ValueError("order must be 1 or more, and max_new_tokens 0 or more")
    spark = requests.sparkSession
    spark.conf.set("spark.sql.cteRecursionRowLimit", -1)
    asked = requests.withColumn("_start", ending(F.col("ids"), order))
    starts = _written(asked.select(F.col("_start").alias("context")).where(F.size("context") == order).distinct(), "starts")
    table = _written(following.select("context", F.col("next").cast("int").alias("next")).where(F.col("next").isNotNull()), "following")
    grown = spark.sql(
        GROWN,
        starts=starts,
        following=table,
        levels=max_new_tokens + 2,
        order=order,
        cap=max_new_tokens,
        eos=eos_id,
    )
    steps = F.array_sort(F.collect_list(F.struct("step", "id")))
    chains = grown.groupBy("start").agg(F.transform(steps, lambda s: s["id"]).alias("new_ids")).withColumnRenamed("start", "_start")
    nothing = F.expr("CAST(ARRAY() AS ARRAY<INT>)")
    return asked.join(chains, "_start", "left").drop("_start").withColumn("new_ids", F.coalesce("new_ids", nothing))
