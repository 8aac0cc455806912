import math
import random
import struct

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sftframe.operators import exact as E

SCHEMA = "k STRING, v DOUBLE"


def bits(value):
    return struct.pack(">d", value)


def groups():
    draw = random.Random(7)
    any_double = [struct.unpack(">d", draw.randbytes(8))[0] for _ in range(4000)]
    small = [v for v in any_double if math.isfinite(v) and abs(v) < 1e300]
    return {
        "whole range": small,
        "subnormal": [draw.randrange(-50, 50) * 5e-324 for _ in range(50)] + [2.2250738585072014e-308],
        "cancels": [v for x in small[:300] for v in (x, -x)] + [1e-300],
        "plain": [draw.gauss(0, 1) for _ in range(3000)],
        "negative": [-draw.random() * 10 ** draw.randrange(20) for _ in range(500)],
        "powers": [s * 2.0**e for e in range(-1074, 1020, 13) for s in (1, -1, 1)],
        "next to powers": [math.nextafter(2.0**e, 0.0) for e in range(-1040, 1000, 26)],
        "halfway": [1.0, 2.0**-53], "above halfway": [1.0, 2.0**-53, 2.0**-1074], "odd halfway": [1.0 + 2.0**-52, 2.0**-53],
        "largest": [1.7976931348623157e308], "zeros": [0.0, -0.0], "one": [0.1],
        "many": [0.1] * 2000,
    }


def test_equal_to_sums_without_error(spark):
    given = groups()
    df = spark.createDataFrame([(k, v) for k, values in given.items() for v in values], SCHEMA)
    made = {k: (n, total) for k, name, n, total in rows(E.sums(E.parts(df, ["k"], {"v": F.col("v")}), ["k"]))}
    for k, values in given.items():
        assert made[k][0] == len(values)
        assert bits(made[k][1]) == bits(math.fsum(values) + 0.0), k


@pytest.mark.parametrize("parts", [1, 8, 64])
def test_any_division_gives_the_same_bits(spark, parts):
    values = groups()["plain"] + groups()["negative"]
    df = spark.createDataFrame([(str(i % 3), v) for i, v in enumerate(values)], SCHEMA).repartition(parts)
    made = dict(rows(E.means(df, ["k"], {"m": F.col("v")})))
    for k in range(3):
        own = values[k::3]
        assert bits(made[str(k)]) == bits(math.fsum(own) / len(own))


def test_parts_are_merged(spark):
    values = groups()["negative"] + groups()["plain"]
    halves = [spark.createDataFrame([("a", v) for v in values[i::2]], SCHEMA) for i in (0, 1)]
    kept = [E.parts(half, ["k"], {"v": F.col("v")}) for half in halves]
    merged = rows(E.sums(E.merge(kept[0].unionByName(kept[1]), ["k"]), ["k"]))
    assert merged == [("a", "v", len(values), math.fsum(values))]


def test_nulls_special_values_and_empty_tables(spark):
    inf, nan = math.inf, math.nan
    given = [("a", 1.0), ("a", None), (None, 2.0), ("b", inf), ("b", 1.0), ("c", -inf), ("d", inf), ("d", -inf), ("e", nan), ("f", None), ("g", 0.0)]
    df = spark.createDataFrame(given, SCHEMA)
    made = {k: (n, total) for k, _, n, total in rows(E.sums(E.parts(df, ["k"], {"v": F.col("v")}), ["k"]))}
    assert made["a"] == (1, 1.0) and made[None] == (1, 2.0) and made["g"] == (1, 0.0)
    assert made["b"] == (2, inf) and made["c"] == (1, -inf) and "f" not in made
    assert math.isnan(made["d"][1]) and math.isnan(made["e"][1])
    assert rows(E.means(df.limit(0), [], {"v": F.col("v")})) == [(None,)]
