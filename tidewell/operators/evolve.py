"""Schema evolution for appends.

``evolve(table_schema, df)`` returns the table schema widened by the
incoming file's new columns, and ``df`` aligned to it *by name*:

* E1 columns new in ``df`` are appended last, typed string by default
  (scalars cast, structs/arrays as JSON text); ``new_columns="infer"`` keeps
  the incoming type;
* E2 table columns missing from ``df`` become typed nulls (structs too);
* E3 column order in the file does not matter;
* nested structs are aligned field by field by name, so a struct missing a
  field, or with fields in another order, still lands right; a struct with a
  field the table lacks is refused (``NestedFieldError``) rather than losing
  its values, since only top-level columns are added automatically.

Names match case-insensitively (Spark's rule); two incoming names that
differ only by case are an error.  Driver-side work is schema only; the
data path is one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (ArrayType, DataType, DateType, DecimalType, MapType, NullType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)


class SchemaClashError(ValueError):
    pass


class NestedFieldError(ValueError):
    """An incoming struct has a field the table's struct lacks: appending
    would drop its values, so it is refused (only top-level columns are
    added automatically)."""


class LossyCastError(TypeError):
    """An incoming type does not fit the table's column: 3.7 would become 3, a
    timestamp would lose its time."""


# Numbers by width; a type fits those after it that hold all of its values.
_FITS = {"byte": {"short", "integer", "long", "float", "double"}, "short": {"integer", "long", "float", "double"},
         "integer": {"long", "double"}, "long": set(), "float": {"double"}, "double": set()}
_DIGITS = {"byte": 3, "short": 5, "integer": 10, "long": 19}


def widens(src: DataType, dst: DataType) -> bool:
    """Whether every value of ``src`` is kept by a cast to ``dst``."""
    if src == dst or isinstance(src, NullType):
        return True
    if isinstance(dst, StringType):
        return not isinstance(src, (StructType, ArrayType, MapType))
    if isinstance(dst, DecimalType):
        whole = dst.precision - dst.scale
        if isinstance(src, DecimalType):
            return src.scale <= dst.scale and src.precision - src.scale <= whole
        return _DIGITS.get(src.typeName(), 99) <= whole
    if isinstance(src, DateType):
        return isinstance(dst, (TimestampType, TimestampNTZType))
    return dst.typeName() in _FITS.get(src.typeName(), set())


def _by_lower(fields) -> dict[str, StructField]:
    out: dict[str, StructField] = {}
    for f in fields:
        k = f.name.lower()
        if k in out:
            raise SchemaClashError(f"columns {out[k].name!r} and {f.name!r} differ only by case")
        out[k] = f
    return out


def align(c: Column, src: DataType, dst: DataType) -> Column:
    """Cast ``c`` of type ``src`` to ``dst``, matching struct fields by name;
    only casts that keep every value, anything else is refused."""
    if isinstance(src, StructType) and isinstance(dst, StructType):
        have = _by_lower(src.fields)
        want = _by_lower(dst.fields)
        extra = [f.name for f in src.fields if f.name.lower() not in want]
        if extra:
            raise NestedFieldError(f"nested field(s) {extra} are not in the table's struct")
        parts = []
        for f in dst.fields:
            sf = have.get(f.name.lower())
            v = align(c.getField(sf.name), sf.dataType, f.dataType) if sf else F.lit(None).cast(f.dataType)
            parts.append(v.alias(f.name))
        return F.when(c.isNull(), F.lit(None).cast(dst)).otherwise(F.struct(*parts))
    if isinstance(src, ArrayType) and isinstance(dst, ArrayType):
        if src.elementType == dst.elementType:
            return c
        return F.transform(c, lambda x: align(x, src.elementType, dst.elementType))
    if isinstance(dst, StringType) and isinstance(src, (StructType, ArrayType)):
        return F.to_json(c)
    if src == dst:
        return c
    if not widens(src, dst):
        raise LossyCastError(f"{src.simpleString()} does not fit a column of type {dst.simpleString()}")
    return c.cast(dst)


def evolve(table_schema: StructType, df: DataFrame, new_columns: str = "string") -> tuple[StructType, DataFrame]:
    incoming = _by_lower(df.schema.fields)
    table = _by_lower(table_schema.fields)
    fields = list(table_schema.fields)
    for f in df.schema.fields:
        if f.name.lower() not in table:
            t = f.dataType if new_columns == "infer" else StringType()
            fields.append(StructField(f.name, t, True))
    schema = StructType(fields)
    cols = []
    for f in schema.fields:
        src = incoming.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(align(F.col(f"`{src.name}`"), src.dataType, f.dataType).alias(f.name))
    return schema, df.select(*cols)


def new_columns_of(table_schema: StructType, df: DataFrame) -> list[StructField]:
    table = _by_lower(table_schema.fields)
    return [f for f in df.schema.fields if f.name.lower() not in table]


def all_strings(schema: StructType) -> bool:
    """E5: every top-level column is a string."""
    return all(isinstance(f.dataType, StringType) for f in schema.fields)


def profile_types(spark: SparkSession, stored: StructType, inferred: StructType) -> DataFrame:
    """Per column its stored type and the type inference would give.

    Built from the two schemas (one row per column, not per data row); the
    inference itself is the Spark job that scanned the file.
    """
    inf = _by_lower(inferred.fields)
    rows = []
    for f in stored.fields:
        i = inf.get(f.name.lower())
        rows.append((f.name, f.dataType.typeName(), i.dataType.typeName() if i else None))
    return spark.createDataFrame(rows, "column string, stored_type string, inferred_type string")


def document_types(spark: SparkSession, table: str, inferred: StructType) -> None:
    """E4 on a catalog table: record each inferred type as the column comment."""
    for f in inferred.fields:
        doc = f.dataType.typeName().replace("'", "")
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{f.name}` COMMENT '{doc}'")
