import pytest
from conftest import rows
from pyspark.sql import types as T

from sftframe.operators.streamed import collate_streamed

SCHEMA = "split STRING, epoch INT, rank INT, batch BIGINT, slot INT, text STRING, extra DOUBLE"


def pairs():
    """A class that workers get by value, as they cannot import this file."""

    class Pairs:
        """Joins every two texts and counts the batch at its end; keeps one text at most."""

        @staticmethod
        def schema(examples):
            return T.StructType([T.StructField("text", examples["text"].dataType), T.StructField("seen", T.LongType())])

        def __init__(self):
            self.kept, self.seen = None, 0

        def add(self, row):
            self.seen += 1
            if self.kept is None:
                self.kept = row["text"] or "-"
            else:
                yield f"{self.kept}{row['text'] or '-'}", self.seen
                self.kept = None

        def finish(self):
            yield self.kept, self.seen

    return Pairs


def examples(spark, batches):
    given = [("train", 0, None, b, s, t, 0.5) for b, texts in batches.items() for s, t in reversed(list(enumerate(texts)))]
    return spark.createDataFrame(given, SCHEMA).repartition(3)


def test_rows_arrive_in_order_per_batch(spark):
    made = collate_streamed(examples(spark, {0: "abc", 1: "de", 2: [None]}), pairs())
    assert made.columns == ["split", "epoch", "rank", "batch", "text", "seen"]
    got = {}
    for split, epoch, rank, batch, text, seen in rows(made):
        assert (split, epoch, rank) == ("train", 0, None)
        got.setdefault(batch, []).append((text, seen))
    assert got == {0: [("ab", 2), ("c", 3)], 1: [("de", 2), (None, 2)], 2: [("-", 1)]}


def test_empty_table_missing_columns_and_clashing_names(spark):
    table = examples(spark, {0: "a"})
    assert rows(collate_streamed(table.limit(0), pairs())) == []
    with pytest.raises(ValueError, match="slot"):
        collate_streamed(table.drop("slot"), pairs())
    with pytest.raises(Exception, match="gives out the keys"):
        collate_streamed(table, pairs(), ("split", "text")).collect()


def test_a_batch_is_never_held(spark):
    """A batch of 400 MB of text passes through a collator that keeps only counts."""

    class Letters:
        @staticmethod
        def schema(_):
            return T.StructType([T.StructField("letters", T.LongType()), T.StructField("peak_mb", T.LongType())])

        def __init__(self):
            self.letters = 0

        def add(self, row):
            self.letters += len(row["text"])
            return ()

        def finish(self):
            import resource

            yield self.letters, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10

    big = spark.range(400).selectExpr("'train' AS split", "0 AS epoch", "0 AS rank", "0L AS batch", "CAST(id AS INT) AS slot", "repeat(chr(CAST(97 + id % 26 AS INT)), 1000000) AS text")
    ((*_, letters, peak_mb),) = rows(collate_streamed(big, Letters))
    assert letters == 400_000_000 and peak_mb < 1000
