"""Gapless numbers for the rows of a table, in a given order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize

#: monotonically_increasing_id keeps the row's place in its partition in these bits.
_PLACE_BITS = 33


def numbered(df: DataFrame, order: list[str | Column], name: str = "id", start: int = 0,
             partitions: int | None = None) -> DataFrame:
    """``df`` with a ``bigint`` column ``name``: ``start``, ``start + 1``, ... in
    the order of ``order`` (rows equal in it in any order), without gaps.

    The rows are sorted over the cluster by range, numbered within their
    partition and written to the shared folder; a count per partition, summed up
    on the driver (one number for each), gives where each partition starts.  No
    task sees more than its range, unlike ``row_number()`` over the whole table.
    Rows that are equal in ``order`` are dealt by a row number too, so that one
    frequent value spreads over several partitions."""
    place, part, row = f"_{name}_place", f"_{name}_part", f"_{name}_row"
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    kept = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("kept")
    rows = df.select(kept, *(k.alias(f"k{i}") for i, k in enumerate(keys)), F.monotonically_increasing_id().alias(row))
    by = [*(f"k{i}" for i in range(len(keys))), row]
    dealt = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).select(
        "kept", F.spark_partition_id().alias(part),
        F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1).alias(place))
    stored = materialize(dealt, label="numbered")
    starts, at = [], start
    for r in stored.groupBy(part).agg(F.count("*").alias("n")).orderBy(part).collect():
        starts.append((r[part], at))
        at += r["n"]
    offsets = spark.createDataFrame(starts, f"{part} int, _first bigint")
    return stored.join(F.broadcast(offsets), part).select("kept.*", (F.col("_first") + F.col(place)).alias(name))
