"""Normalisation driven by a mapping table.

A mapping table says, row by row, which bronze column fills which silver column
of which silver table, and in which slot::

    silver_table  slot  silver_column  bronze_column  rule       is_key
    person        null  id             id             column     true
    person        null  firstName      firstName      column     false
    address       null  id             id             column     true
    address       null  AddressId      null           slot       true
    address       1     cityName       cityName1      column     false
    address       2     cityName       cityName2      column     false

Rows without a slot hold for every slot of their table; a table without slots gets
one silver row per bronze row, one with slots a row per slot, from one generator in
one projection.  ``rule``: ``column`` copies the bronze column, ``slot`` is the slot,
``surrogate`` is ``concat(bronze column, '_', slot)``, ``constant`` the text in
``bronze_column``.  ``is_key`` columns are the MERGE key.

The table has a row per silver column, so it is collected; it is checked against
both schemas before any data is read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, IntegerType, StringType, StructType

from tidewell.operators.evolve import widens

MAPPING_TYPE = "silver_table string, slot int, silver_column string, bronze_column string, rule string, is_key boolean"
RULES = ("column", "slot", "surrogate", "constant")


class MappingError(ValueError):
    """The mapping table does not fit the bronze or silver schemas; the message
    lists every fault found."""


@dataclass(frozen=True)
class Fill:
    """How one silver column is filled."""
    rule: str
    bronze: str | None

    def column(self, slot: int | None) -> Column:
        if self.rule == "slot":
            return F.lit(slot)
        if self.rule == "constant":
            return F.lit(self.bronze)
        c = F.col(f"`{self.bronze}`")
        return c if self.rule == "column" else F.concat(c.cast("string"), F.lit(f"_{slot}"))

    def type(self, bronze: StructType) -> DataType:
        if self.rule == "column":
            return bronze[self.bronze].dataType
        return IntegerType() if self.rule == "slot" else StringType()


@dataclass
class SilverTable:
    """One silver table's compiled mapping."""
    name: str
    schema: StructType
    slots: dict[int | None, dict[str, Fill]]
    keys: list[str] = field(default_factory=list)

    def project(self, bronze: DataFrame, extra: list[str] = ()) -> DataFrame:
        """The silver rows of ``bronze``; ``extra`` bronze columns (record type,
        batch, ...) go along after the silver ones."""
        def cells(slot, fills: dict[str, Fill]) -> list[Column]:
            return [fills[f.name].column(slot).cast(f.dataType).alias(f.name) if f.name in fills
                    else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]

        if set(self.slots) == {None}:
            return bronze.select(*cells(None, self.slots[None]), *extra)
        rows = F.array(*(F.struct(*cells(s, self.slots[s])) for s in sorted(self.slots)))
        return bronze.select(*extra, F.inline(rows)).select(*self.schema.fieldNames(), *extra)


def compile_mapping(mapping: DataFrame, bronze: StructType, silver: dict[str, StructType]) -> dict[str, SilverTable]:
    """The silver tables of a mapping table.  Refused (:class:`MappingError`):
    unknown tables, columns or rules, a silver column filled twice in a slot, a
    required silver column that a slot leaves out, a bronze type that does not fit the
    silver one without loss, ``slot`` or ``surrogate`` in a table without slots, a
    table without key."""
    rows = mapping.select(*MAPPING_TYPE.replace(",", "").split()[::2]).collect()
    faults: list[str] = []
    tables: dict[str, SilverTable] = {}
    by_lower = {c.lower(): c for c in bronze.fieldNames()}
    for name in sorted({r.silver_table for r in rows}, key=str):
        own = [r for r in rows if r.silver_table == name]
        if name not in silver:
            faults.append(f"{name}: no such silver table")
            continue
        schema = silver[name]
        columns = {c.lower(): c for c in schema.fieldNames()}
        slots = sorted({r.slot for r in own if r.slot is not None}) or [None]
        filled: dict = {s: {} for s in slots}
        keys = set()
        for r in own:
            at = f"{name}.{r.silver_column}" + (f" in slot {r.slot}" if r.slot is not None else "")
            rule = r.rule or "column"
            column = columns.get((r.silver_column or "").lower())
            source = by_lower.get((r.bronze_column or "").lower())
            if column is None:
                faults.append(f"{at}: no such silver column")
                continue
            if rule not in RULES:
                faults.append(f"{at}: rule {rule!r} is none of {', '.join(RULES)}")
                continue
            if rule in ("slot", "surrogate") and slots == [None]:
                faults.append(f"{at}: rule {rule!r} in a table without slots")
                continue
            if rule in ("column", "surrogate") and source is None:
                faults.append(f"{at}: no bronze column {r.bronze_column!r}")
                continue
            fill = Fill(rule, r.bronze_column if rule == "constant" else source)
            have, want = fill.type(bronze), schema[column].dataType
            # a constant is a text that must read as the column's type; the cast says so when it runs
            if rule != "constant" and not widens(have, want):
                faults.append(f"{at}: {have.simpleString()} does not fit {want.simpleString()}")
                continue
            if r.is_key:
                keys.add(column)
            for s in slots if r.slot is None else [r.slot]:
                if column in filled[s]:
                    faults.append(f"{at}: filled twice")
                filled[s][column] = fill
        for s in slots:
            for f in schema.fields:
                if not f.nullable and f.name not in filled[s]:
                    faults.append(f"{name}.{f.name}" + (f" in slot {s}" if s is not None else "") + ": required, but not filled")
        if not keys:
            faults.append(f"{name}: no key column")
        tables[name] = SilverTable(name, schema, filled, [c for c in schema.fieldNames() if c in keys])
    if faults:
        repeated = Counter(faults)
        raise MappingError("; ".join(repeated))
    return tables
