"""Readers for instruction and preference tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftframe.options import SftOptions

FORMATS = ("parquet", "json", "csv", "orc")


def require_columns(df: DataFrame, names: list[str], what: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}; it has {df.columns}")
    return df


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    split: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read a table; with ``split``, only the rows (or the partition) of that split.

    Columns of a CSV file are found by its header, whatever their order; a value that does not fit the schema fails
    the job.  ``multi_line`` allows line breaks in quoted CSV values, at the price of one task per file.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line).option("escape", '"').option("mode", "FAILFAST")
        df = reader.load(path)
        if schema is not None:
            df = _by_name(df, T.StructType.fromDDL(schema) if isinstance(schema, str) else schema, path)
    else:
        df = (reader if schema is None else reader.schema(schema)).load(path)
    if split is None:
        return df
    return require_columns(df, ["split"], path).where(F.col("split") == split)


def _by_name(df: DataFrame, schema: T.StructType, path: str) -> DataFrame:
    require_columns(df, schema.fieldNames(), path)
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def spread(scan: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a small table before costly work on its rows.

    A table whose scan has a split per core or more is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores, key)


def instruction_table(df: DataFrame, opts: SftOptions) -> DataFrame:
    """``pair_id, instruction, response``, taken from the columns that the options name."""
    require_columns(df, [opts.id_col, opts.instruction_col, opts.response_col], "the instruction table")
    return df.select(
        F.col(opts.id_col).alias("pair_id"),
        F.col(opts.instruction_col).cast("string").alias("instruction"),
        F.col(opts.response_col).cast("string").alias("response"),
    )


def _is_messages(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


def plain_turn(message: Column) -> Column:
    """A message as its content alone."""
    return message["content"]


def named_turn(message: Column) -> Column:
    """A message with its role in front."""
    return F.concat(message["role"], F.lit(": "), message["content"])


def _last_content(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))["content"]


def _rendered(messages: Column, turn: Callable[[Column], Column]) -> Column:
    return F.array_join(F.transform(messages, turn), "\n\n")


def _turns_before(messages: Column) -> Column:
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def preference_table(df: DataFrame, id_col: str = "pair_id", turn: Callable[[Column], Column] = plain_turn) -> DataFrame:
    """``pair_id, prompt, chosen, rejected`` as text.

    ``chosen`` and ``rejected`` may be lists of role/content messages: the last message is the completion and the
    ones before it are the prompt, written as ``turn`` says.  Both lists must share the prompt, else the job fails.
    An empty list has no completion (null).  An own ``prompt`` column wins over the prompt in the messages.
    """
    require_columns(df, [id_col, "chosen", "rejected"], "the preference table")
    messages = _is_messages(df, "chosen")
    if messages != _is_messages(df, "rejected"):
        raise ValueError("chosen and rejected must both be text or both be message lists")
    if "prompt" in df.columns:
        prompt = _rendered(F.col("prompt"), turn) if _is_messages(df, "prompt") else F.col("prompt")
    elif messages:
        before = _turns_before(F.col("chosen"))
        unlike = F.raise_error(F.lit("chosen and rejected have different prompts"))
        prompt = F.when(before == _turns_before(F.col("rejected")), _rendered(before, turn)).otherwise(unlike)
    else:
        raise ValueError("a preference table of plain text needs a prompt column")
    pick = _last_content if messages else (lambda c: c)
    return df.select(
        F.col(id_col).alias("pair_id"),
        prompt.alias("prompt"),
        pick(F.col("chosen")).alias("chosen"),
        pick(F.col("rejected")).alias("rejected"),
    )

