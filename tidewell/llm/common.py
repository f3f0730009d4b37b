"""Helpers shared by the operators: text to words, tables, scratch folders."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import read_table, scratch_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Java class of the characters between words: space and tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*(columns or ("doc_id", "text")))


def shared_dir(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder (``spark.checkpoint.dir``)."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/tidewell-llm/{app}/{label}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed
    once, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys of documents that are broadcast; more are joined by shuffling.
BROADCAST_KEYS = 500_000


def boxed(docs: DataFrame, **named: Column) -> DataFrame:
    """``docs`` as one struct ``row``, so that its column names clash with none,
    and beside it the columns ``named``."""
    return docs.select(F.struct("*").alias("row"), *(c.alias(k) for k, c in named.items()))


def unboxed(df: DataFrame, columns: list[str], own: list[str] = (), **replaced: Column) -> DataFrame:
    """The fields ``columns`` of ``row``, ``replaced`` ones with their new value,
    then the columns ``own``, which take the place of fields of that name."""
    taken = {c.lower() for c in own}
    return df.select(*(replaced.get(c, F.col("row")[c]).alias(c) for c in columns if c.lower() not in taken), *own)


def without(docs: DataFrame, gone: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows of ``docs`` whose id and text hash are not in ``gone`` (_id, _h).
    The keys are written and counted; up to ``BROADCAST_KEYS`` of them go to the texts, not
    the texts to them."""
    keys = written(gone.select("_id", "_h").distinct(), "gone")
    side = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    rows = boxed(docs, id=F.col(doc_id), h=F.xxhash64(F.col(text)))
    left = rows.join(side, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left_anti")
    return unboxed(left, docs.columns)


#: Vectors of tasks that the driver adds itself; more are added in a level of tasks first.
DIRECT_SUMS = 256


def vector_sum(df: DataFrame, vectors: Callable[[pa.RecordBatch], Iterator[np.ndarray]]) -> np.ndarray | None:
    """Sum of the equally long vectors of doubles that ``vectors`` yields for the
    batches of ``df``; None if there are none.  A task sends one vector; those of
    many tasks are added in tasks before the driver gets them."""
    def added(found) -> Iterator[pa.RecordBatch]:
        acc = None
        for v in found:
            acc = v if acc is None else acc + v
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([acc.tobytes()], pa.binary())], names=["v"])

    sent = df.mapInArrow(lambda batches: added(v for b in batches for v in vectors(b)), "v binary")
    tasks = sent.rdd.getNumPartitions()
    if tasks > DIRECT_SUMS:
        sent = sent.repartition(math.isqrt(tasks)).mapInArrow(
            lambda batches: added(np.frombuffer(v.as_py()) for b in batches for v in b.column(0)), "v binary")
    found = [np.frombuffer(r["v"]) for r in sent.collect()]
    return np.sum(found, axis=0) if found else None


def lower_az(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: Column, between: str = BLANKS) -> Column:
    """The non-empty pieces of ``text`` between matches of ``between``;
    null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), between), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable
    is bound once, while a repeated expression may be evaluated again)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def window_hashes(words: Column, width: int, body) -> Column:
    """``body(hashes)`` with the 64-bit hash of every window of ``width``
    words, in order (empty if there are fewer words).  Hashes of four words
    are taken first and those of a window made of them, with look-ups by
    index: ``slice`` would copy the whole array for each window."""

    def cut(h: Column) -> Column:
        return let(F.slice(h, F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(0))), body)

    def all_of(first: Column, i: Column, steps: list[tuple[Column, int]]) -> Column:
        return F.xxhash64(first, *(F.get(a, i + k) for a, k in steps))

    if width < 4:
        return cut(F.transform(words, lambda v, i: all_of(v, i, [(words, k) for k in range(1, width)])))

    def whole(four: Column) -> Column:
        steps = [(four, k) for k in range(4, width - 3, 4)] + [(words, k) for k in range(width - width % 4, width)]
        return cut(F.transform(four, lambda v, i: all_of(v, i, steps)))

    return let(F.transform(words, lambda v, i: all_of(v, i, [(words, k) for k in (1, 2, 3)])), whole)


def window_text(words: Column, start: Column, width: int) -> Column:
    """The ``width`` words from 0-based ``start``, joined by spaces."""
    return F.concat_ws(" ", *(F.get(words, start + k) for k in range(width)))


def text_or_empty(values) -> list[str]:
    return ["" if v is None else v for v in values]
