"""Gapless numbers against sorting on the driver."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators.numbering import numbered


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_numbers_follow_the_order_without_gaps(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice([None, "a", "b", "b", "b"]), rng.randrange(50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(7)
    got = numbered(df, ["k", "v", "id"], "n", start=100, partitions=partitions)
    assert got.columns == ["k", "v", "id", "n"]
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert [(r.k, r.v, r.id) for r in got.orderBy("n").collect()] == want
    assert sorted(r.n for r in got.collect()) == list(range(100, 600))


def test_one_value_spreads_over_partitions(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), "id")
    got = numbered(df, ["k"], "n", partitions=8)
    assert sorted(r.n for r in got.collect()) == list(range(20_000))
    sizes = [r["count"] for r in got.groupBy(F.floor(F.col("n") / 20_000 * 8)).count().collect()]
    assert len(sizes) == 8
    stored = {r["f"] for r in got.select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(stored) > 4


def test_empty_clashing_names_and_dots(spark):
    df = spark.createDataFrame([], "_n_place int, kept string, `a.b` int")
    assert numbered(df, ["_n_place"], "n").count() == 0
    df = spark.createDataFrame([(2, "x", 5), (1, "y", 6)], "_n_place int, kept string, `a.b` int")
    got = numbered(df, ["_n_place"], "n")
    assert [tuple(r) for r in got.orderBy("n").collect()] == [(1, "y", 6, 0), (2, "x", 5, 1)]
