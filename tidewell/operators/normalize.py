"""Split one wide record into rows per slot.

``unpivot_slots`` turns numbered column groups (``Ph1, Ph2, Ph3`` or
``streetNo1, cityName1, ... streetNo2, ...``) into one row per slot in a
single pass over the input: ``inline(array(struct(slot 1), struct(slot 2),
...))`` is a generator inside one projection, so the batch is read once
(the reference's UNION ALL of one SELECT per slot reads it once per slot).
Null slots are kept, because deletes depend on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unpivot_slots(df: DataFrame, keep: list[str], slots: dict, slot_col: str | None = "slot") -> DataFrame:
    """``slots``: ``{slot_value: {out_col: in_col, ...}, ...}`` (every slot
    names the same out columns; N4's mapping tables are this dict)."""
    items = list(slots.items())
    out_cols = list(items[0][1].keys())
    types = {f.name: f.dataType for f in df.schema.fields}
    first = items[0][1]
    structs = []
    for slot, mapping in items:
        fields = [F.lit(slot).alias(slot_col)] if slot_col else []
        for oc in out_cols:
            fields.append(F.col(mapping[oc]).cast(types[first[oc]]).alias(oc))
        structs.append(F.struct(*fields))
    return df.select(*keep, F.inline(F.array(*structs)))


def unpivot_union(df: DataFrame, keep: list[str], slots: dict, slot_col: str | None = "slot") -> DataFrame:
    """The reference's form: one SELECT per slot, UNION ALL by position."""
    parts = []
    for slot, mapping in slots.items():
        cols = [F.col(k) for k in keep]
        if slot_col:
            cols.append(F.lit(slot).alias(slot_col))
        cols += [F.col(src).alias(dst) for dst, src in mapping.items()]
        parts.append(df.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def with_surrogate_key(df: DataFrame, id_col: str, slot_col: str, name: str) -> DataFrame:
    """``name = concat(id, '_', slot)``; drops the slot column."""
    return df.withColumn(name, F.concat(F.col(id_col).cast("string"), F.lit("_"),
                                        F.col(slot_col).cast("string"))).drop(slot_col)
