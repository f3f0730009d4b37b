"""Column expressions used by the operators (all built-in, JVM side)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_valid_key(c: str | Column, dtype: DataType | None = None, blank_is_null: bool = True) -> Column:
    """Not null, and for strings not blank after trim (P6); non-strings: not null."""
    c = col_of(c)
    if blank_is_null and (dtype is None or isinstance(dtype, StringType)):
        return c.isNotNull() & (F.trim(c.cast("string")) != F.lit(""))
    return c.isNotNull()


def all_null(cols: list[str | Column]) -> Column:
    """True when every listed column is null: the record is an erase."""
    return reduce(lambda a, b: a & b, [col_of(c).isNull() for c in cols])


def any_null(cols: list[str | Column]) -> Column:
    return reduce(lambda a, b: a | b, [col_of(c).isNull() for c in cols])


def tolerant_int(c: str | Column) -> Column:
    """``INT(x)`` that gives null instead of failing on '' or junk."""
    return col_of(c).try_cast("int")


def tolerant_double(c: str | Column) -> Column:
    return col_of(c).try_cast("double")


def text_add(a: str | Column, b: str | Column) -> Column:
    """``'100' + '20'`` on text amounts: both sides as double, back to text."""
    return (tolerant_double(a) + tolerant_double(b)).cast("string")


def surrogate_key(c: str | Column, slot) -> Column:
    """``concat(id, '_', slot)``; a null id gives a null key (F1)."""
    return F.concat(col_of(c).cast("string"), F.lit("_"), F.lit(str(slot)))


def bucket(c: str | Column, n: int) -> Column:
    """Hash bucket of a key, stable across runs and engines of this library."""
    return F.pmod(F.xxhash64(col_of(c)), F.lit(n)).cast("int")


def first_true(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """Ordered CASE: the first branch whose condition is TRUE wins; NULL counts as FALSE."""
    expr = None
    for cond, value in cases:
        cond = F.coalesce(cond, F.lit(False))
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return otherwise if expr is None else expr.otherwise(otherwise)


def _requires(dtype: DataType) -> bool:
    """Whether a value of the type can break a NOT NULL inside it."""
    if isinstance(dtype, StructType):
        return any(not f.nullable or _requires(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return not dtype.containsNull or _requires(dtype.elementType)
    if isinstance(dtype, MapType):
        return not dtype.valueContainsNull or _requires(dtype.valueType) or _requires(dtype.keyType)
    return False


def null_path(c: Column, dtype: DataType, nullable: bool, path: Column) -> Column:
    """The path of the first null in ``c`` where the type forbids one, e.g.
    ``items[2].price`` or ``tags['a']``; null if there is none.  A null that is
    allowed is not looked into."""
    cases = [] if nullable else [F.when(c.isNull(), path)]
    if isinstance(dtype, StructType):
        cases += [F.when(c.isNotNull(), null_path(c.getField(f.name), f.dataType, f.nullable, F.concat(path, F.lit(f".{f.name}"))))
                  for f in dtype.fields if not f.nullable or _requires(f.dataType)]
    elif isinstance(dtype, ArrayType) and _requires(dtype):
        of = F.transform(c, lambda x, i: null_path(x, dtype.elementType, dtype.containsNull,
                                                   F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
        cases.append(F.get(F.filter(of, lambda p: p.isNotNull()), 0))
    elif isinstance(dtype, MapType) and _requires(dtype):
        def entry(e: Column) -> Column:
            at = F.concat(path, F.lit("['"), e["key"].cast("string"), F.lit("']"))
            within = null_path(e["value"], dtype.valueType, dtype.valueContainsNull, at)
            if _requires(dtype.keyType):
                return F.coalesce(null_path(e["key"], dtype.keyType, True, F.concat(path, F.lit("{key}"))), within)
            return within
        cases.append(F.get(F.filter(F.transform(F.map_entries(c), entry), lambda p: p.isNotNull()), 0))
    return F.coalesce(*cases) if cases else F.lit(None).cast("string")


def guard_not_null(df, schema) -> "DataFrame":
    """Enforce the NOT NULL columns, struct fields, list elements and map values
    of a declared ``schema`` (Parquet files do not): a null there fails the job
    that writes the frame, naming its path, with no extra pass over the data (the
    check is a projection evaluated during the write)."""
    required = {f.name: f for f in schema.fields if (not f.nullable or _requires(f.dataType)) and f.name in df.columns}
    if not required:
        return df
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in required:
            f = required[c]
            at = null_path(col, f.dataType, f.nullable, F.lit(c))
            msg = F.concat(F.lit("NOT NULL column "), at, F.lit(" received a null"))
            col = F.when(at.isNotNull(), F.raise_error(msg)).otherwise(col).alias(c)
        out.append(col)
    return df.select(*out)
