"""Types of text columns (E4) as an aggregation.

A value's narrowest type is one bit; the state of a column is the bits of the
types seen and the longest whole number.  States are made within the tasks,
merged over tasks, and merge again over files or days (``bit_or`` and ``max``), so that a
table's profile is kept up by profiling the new file only.  The type of a column
is the least upper bound of the types seen, as schema inference gives it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, NullType,
                               StringType, StructType, TimestampType)

# fixed values: the bits of a state
INT, LONG, DECIMAL, DOUBLE, DATE, TIMESTAMP, BOOLEAN, STRING = (1 << i for i in range(8))
STATE_TYPE = "column string, seen bigint, digits int, values bigint"

_WHOLE = r"^[+-]?[0-9]+$"
_WHOLE_POINT = r"^[+-]?[0-9]+\.?$"
# Java's parseDouble: decimal numbers with an exponent and a type letter, NaN, Infinity
_DOUBLE = r"^[\x00-\x20]*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)[\x00-\x20]*$|^-?Inf$"
_DATE = r"^[0-9]{4,7}-[0-9]{1,2}-[0-9]{1,2}$"
_TIME = r"^[+-]?[0-9]{4,6}(-[0-9]{1,2}(-[0-9]{1,2}([ T].*)?)?)?$|^T?[0-9]{1,2}:[0-9]{1,2}(:.*)?$"


def value_type(c: Column) -> Column:
    """The bit of a text's narrowest type; 0 for null and the empty text."""
    whole = c.rlike(_WHOLE)
    return (F.when(c.isNull() | (c == ""), F.lit(0))
             .when(whole & c.try_cast("int").isNotNull(), F.lit(INT))
             .when(whole & c.try_cast("bigint").isNotNull(), F.lit(LONG))
             .when(c.rlike(_WHOLE_POINT) & (_digits(c) <= 38), F.lit(DECIMAL))
             .when(c.rlike(_DOUBLE), F.lit(DOUBLE))
             .when(c.rlike(_DATE) & c.try_cast("date").isNotNull(), F.lit(DATE))
             .when(c.rlike(_TIME) & c.try_cast("timestamp").isNotNull(), F.lit(TIMESTAMP))
             .when(F.lower(c).isin("true", "false"), F.lit(BOOLEAN))
             .otherwise(F.lit(STRING))).cast("bigint")


def _digits(c: Column) -> Column:
    return F.greatest(F.length(F.regexp_replace(c, r"^[+-]?0*|\.$", "")), F.lit(1))


def states(df: DataFrame, by: list[str | Column] = ()) -> DataFrame:
    """Per text column (and per ``by``: the file, the day, ...) its state:
    ``column``, ``seen``, ``digits``, ``values`` (not null, not empty).  One
    aggregation for all columns, whatever their number; columns of other types are
    left out."""
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if by and all(isinstance(c, str) for c in by):
        names = [n for n in names if n not in by]
    aggs = []
    for i, n in enumerate(names):
        c = F.col(f"`{n}`")
        t = value_type(c)
        aggs += [F.bit_or(t).alias(f"_s{i}"), F.max(F.when(t.isin(DECIMAL), _digits(c))).alias(f"_d{i}"),
                 F.count_if(t > 0).alias(f"_n{i}")]
    if not names:
        return df.sparkSession.createDataFrame([], STATE_TYPE)
    wide = df.groupBy(*keys).agg(*aggs)
    kept = [c for c in wide.columns if c not in {f"_{k}{i}" for k in "sdn" for i in range(len(names))}]
    rows = F.array(*(F.struct(F.lit(n).alias("column"), F.coalesce(f"_s{i}", F.lit(0)).cast("bigint").alias("seen"),
                              F.coalesce(f"_d{i}", F.lit(0)).cast("int").alias("digits"), F.col(f"_n{i}").alias("values"))
                     for i, n in enumerate(names)))
    return wide.select(*kept, F.inline(rows))


def merge_states(*parts: DataFrame) -> DataFrame:
    """One state per column from states of several files, days or frames."""
    every = reduce(lambda a, b: a.unionByName(b), [p.select("column", "seen", "digits", "values") for p in parts])
    return every.groupBy("column").agg(F.bit_or("seen").alias("seen"), F.max("digits").alias("digits"),
                                       F.sum("values").alias("values"))


def type_of(seen: int, digits: int) -> DataType:
    """The least upper bound of the types seen; no value at all: null type."""
    if not seen:
        return NullType()
    numbers, times = INT | LONG | DECIMAL | DOUBLE, DATE | TIMESTAMP
    if seen & STRING or sum(bool(seen & group) for group in (numbers, times, BOOLEAN)) > 1:
        return StringType()
    if seen & BOOLEAN:
        return BooleanType()
    if seen & times:
        return TimestampType() if seen & TIMESTAMP else DateType()
    if seen & DOUBLE:
        return DoubleType()
    if seen & DECIMAL:
        least = 20 if seen & LONG else 10 if seen & INT else 0  # what whole numbers of those types need
        return DecimalType(max(digits, least), 0)
    return LongType() if seen & LONG else IntegerType()


def inferred_types(profile: DataFrame) -> dict[str, DataType]:
    """Type per column of merged states (a row per column)."""
    return {r["column"]: type_of(r["seen"], r["digits"]) for r in profile.collect()}


def typed(df: DataFrame, types: dict[str, DataType], only: list[str] | None = None) -> DataFrame:
    """``df`` with its text columns cast to ``types`` (columns without a value
    stay strings); ``only``: these columns."""
    out = []
    for c in df.columns:
        t = types.get(c, StringType())
        cast = not isinstance(t, (StringType, NullType)) and (only is None or c in only)
        v = F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`")) if cast else None
        out.append(v.cast(t).alias(c) if cast else F.col(f"`{c}`"))
    return df.select(*out)


def as_schema(df: DataFrame, types: dict[str, DataType]) -> StructType:
    """``df``'s columns with the inferred types; columns without a value are strings."""
    out = StructType()
    for c in df.columns:
        t = types.get(c, StringType())
        out.add(c, StringType() if isinstance(t, NullType) else t)
    return out
