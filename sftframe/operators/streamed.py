"""Collators that take a batch row by row: a polymorphic table function over partitions of examples.

A group handed over as one frame has to fit into a worker.  Here rows of a batch arrive in order, and the collator
decides what it keeps and when it gives rows out, so a batch may be larger than a worker's memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from sftframe.operators.collate import BATCH_KEY
from sftframe.session import ship_package


class Collator(Protocol):
    """What the user writes.  An object is made for every batch."""

    @staticmethod
    def schema(examples: T.StructType) -> T.StructType:
        """Columns of the rows that are given out, from those of the examples; called once, when the plan is made."""

    def add(self, row: Row) -> Iterator[tuple]:
        """Take a row; give out any number of rows."""

    def finish(self) -> Iterator[tuple]:
        """Called after the last row of the batch."""


def collate_streamed(
    examples: DataFrame, collator: type[Collator], keys: tuple[str, ...] = BATCH_KEY, order: tuple[str, ...] = ("slot",)
) -> DataFrame:
    """``*keys`` and the columns of the collator's rows, batch by batch.

    Rows of one batch go to one task in the order of ``order``; a null in a key is a value like any other.  A key that
    the collator also gives out is an error, as is a missing column.
    """
    ship_package(examples.sparkSession)
    absent = [name for name in (*keys, *order) if name not in examples.columns]
    if absent:
        raise ValueError(f"the examples lack the columns {absent}")
    key_names = list(keys)

    class Batches:
        @staticmethod
        def analyze(table: AnalyzeArgument) -> AnalyzeResult:
            given = table.dataType
            own = collator.schema(given)
            twice = [name for name in own.names if name in key_names]
            if twice:
                raise ValueError(f"the collator gives out the keys {twice}")
            return AnalyzeResult(T.StructType([*[given[name] for name in key_names], *own.fields]))

        def __init__(self):
            self.collator, self.key = collator(), None

        def eval(self, row: Row):
            if self.key is None:
                self.key = tuple(row[name] for name in key_names)
            for made in self.collator.add(row):
                yield (*self.key, *made)

        def terminate(self):
            if self.key is not None:
                for made in self.collator.finish():
                    yield (*self.key, *made)

    batches = F.udtf(Batches)
    return batches(examples.asTable().partitionBy(*key_names).orderBy(*order))
