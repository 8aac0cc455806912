"""Replace every element of an array by its entry in a table: the step behind encoding, decoding and scoring.

A table within the bounds goes to the executors once and rows stay where they are; a larger one is joined.  Both ways
give the same result: a key that the table has twice fails the job, rows need no key of their own, and an element
that the table lacks gets the default or, where there is none, fails the job.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftframe.functions.arrays import once
from sftframe.session import cut_lineage

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
#: An element with at least this share of all elements is hot, so there are at most as many as its inverse.
HOT_SHARE = 0.001


def is_small(table: DataFrame, bound: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the table has at most ``bound`` rows and ``most_bytes`` of text; reads one row beyond the bound at most."""
    text = [F.octet_length(name) for name, kind in table.dtypes if kind in ("string", "binary")]
    size = sum((F.coalesce(t, F.lit(0)) for t in text), F.lit(8 * len(table.columns)))
    rows, total = table.limit(bound + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= bound and total <= most_bytes


def _plain(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _struct_udf(shared, names: list[str], defaults: list, types: list[str]):
    """One search per array for all the columns that are wanted of its elements."""
    fields = ",".join(f"f{k}:array<{kind}>" for k, kind in enumerate(types))

    @F.arrow_udf(f"struct<{fields}>")
    def replace(lists: pa.Array) -> pa.Array:
        keys, columns = shared.value
        flat = lists.flatten()
        at = pc.index_in(flat, value_set=keys.cast(flat.type))
        starts = pc.subtract(lists.offsets, lists.offsets[0])
        parts = []
        for name, default in zip(names, defaults):
            found = pc.take(columns[name], at)
            if default is not None:
                found = pc.fill_null(found, pa.scalar(default, found.type))
            elif found.null_count:
                raise ValueError(f"the lookup table lacks {flat.filter(found.is_null())[0].as_py()!r}")
            parts.append(type(lists).from_arrays(starts, found))
        return pa.StructArray.from_arrays(parts, [f"f{k}" for k in range(len(parts))])

    return replace


def lookup_arrays(
    df: DataFrame,
    table: DataFrame,
    table_key: str,
    wanted: list[tuple[str, str, str, object]],
    bound: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add array columns made by looking up each element of an array column in ``table``.

    ``wanted`` lists ``(array column, table column, new column, default)``.  Arrays must not be null.  The join form
    checkpoints the rows, to tell them apart by a number, so it does not take a stream; streams go through it one
    micro-batch at a time.
    """
    if is_small(table, bound):
        return _lookup_by_broadcast(df, table, table_key, wanted)
    return _lookup_by_join(df, table, table_key, wanted)


def _by_source(wanted):
    for source in dict.fromkeys(source for source, _, _, _ in wanted):
        yield source, [(column, new, default) for s, column, new, default in wanted if s == source]


def _lookup_by_broadcast(df, table, table_key, wanted):
    names = list(dict.fromkeys(column for _, column, _, _ in wanted))
    types = dict(table.dtypes)
    entries = table.select(table_key, *[n for n in names if n != table_key]).toArrow()
    keys = _plain(entries[table_key])
    if len(pc.unique(keys)) < len(keys):
        raise ValueError(f"the lookup table has a {table_key} twice")
    columns = {name: _plain(entries[name]) for name in names}
    shared = df.sparkSession.sparkContext.broadcast((keys, columns))
    result = df
    for number, (source, parts) in enumerate(_by_source(wanted)):
        replace = _struct_udf(shared, [c for c, _, _ in parts], [d for _, _, d in parts], [types[c] for c, _, _ in parts])
        found = f"_found_{number}"
        result = result.withColumn(found, replace(F.col(source))).withColumns(
            {new: F.col(f"{found}.f{k}") for k, (_, new, _) in enumerate(parts)}
        )
    return result.drop(*[f"_found_{k}" for k in range(len({s for s, _, _, _ in wanted}))])


def _lookup_by_join(df, table, table_key, wanted):
    types = dict(table.dtypes)
    names = list(dict.fromkeys(column for _, column, _, _ in wanted))
    twice = F.raise_error(F.concat(F.lit(f"the lookup table has a {table_key} twice: "), F.col("_element").cast("string")))
    entries = (
        table.select(F.col(table_key).alias("_element"), F.struct(*[F.col(n).alias(f"_to_{n}") for n in names]).alias("_entry"))
        .groupBy("_element")
        .agg(F.when(F.count("*") > 1, twice.cast("boolean")).alias("_twice"), F.first("_entry").alias("_entry"))
        .where("_twice is null")
        .select("_element", "_entry.*")
    )
    result = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    for source, parts in _by_source(wanted):
        elements = result.select("_row", once(F.col(source)).alias("_array")).select(
            "_row", F.posexplode("_array").alias("_at", "_element")
        )
        found = _join_elements(elements, entries, result.agg(F.sum(F.size(source))).first()[0] or 0)
        entry = F.struct("_at", *[_or_default(F.col(f"_to_{column}"), default).alias(new) for column, new, default in parts])
        lists = found.groupBy("_row").agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        arrays = {
            new: F.coalesce(F.col(f"_entries.{new}"), F.array().cast(f"array<{types[column]}>")) for column, new, _ in parts
        }
        result = result.join(lists, "_row", "left").withColumns(arrays).drop("_entries")
    return result.drop("_row")


def _join_elements(elements, entries, total):
    """Hot elements never shuffle: their entries, at most ``1 / HOT_SHARE`` rows, are broadcast."""
    counts = elements.groupBy("_element").agg(F.count("*").alias("_n"))
    hot = [row["_element"] for row in counts.where(F.col("_n") >= max(1.0, HOT_SHARE * total)).select("_element").collect()]
    is_hot = F.col("_element").isin(hot) if hot else F.lit(False)
    kept = F.coalesce(is_hot, F.lit(False))
    frequent = elements.where(kept).join(F.broadcast(entries.where(kept)), "_element", "left")
    return frequent.unionByName(elements.where(~kept).join(entries, "_element", "left"))


def _or_default(value: Column, default) -> Column:
    if default is None:
        lacking = F.concat(F.lit("the lookup table lacks "), F.col("_element").cast("string"))
        return F.coalesce(value, F.raise_error(lacking))
    return F.coalesce(value, F.lit(default))
