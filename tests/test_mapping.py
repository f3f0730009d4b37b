"""Mapping tables: compiled projections, slots, rules, and what is refused."""

import pytest
from conftest import rows

from tidewell.operators.mapping import MAPPING_TYPE, MappingError, compile_mapping
from tidewell.session import ddl_schema

BRONZE = "id int, First string, zip1 int, zip2 int, city1 string, city2 string, kind string"
SILVER = {"person": "id bigint NOT NULL, firstName string, origin string",
          "address": "AddressId string NOT NULL, id bigint NOT NULL, slot int, zip bigint, city string"}
GOOD = [
    ("person", None, "id", "id", "column", True),
    ("person", None, "firstname", "first", None, False),
    ("person", None, "origin", "crm", "constant", None),
    ("address", None, "AddressId", "id", "surrogate", True),
    ("address", None, "id", "id", "column", False),
    ("address", None, "slot", None, "slot", False),
    ("address", 1, "zip", "zip1", "column", False),
    ("address", 2, "zip", "zip2", "column", False),
    ("address", 2, "city", "city2", "column", False),
]


def compiled(spark, mapping, silver=SILVER):
    return compile_mapping(spark.createDataFrame(mapping, MAPPING_TYPE), ddl_schema(spark, BRONZE),
                           {k: ddl_schema(spark, v) for k, v in silver.items()})


def test_projections(spark):
    got = compiled(spark, GOOD)
    bronze = spark.createDataFrame([(1, "Ann", 10, 20, "a", "b", "new"), (2, None, None, None, None, None, "old")], BRONZE)
    assert got["person"].keys == ["id"] and got["address"].keys == ["AddressId"]
    person = got["person"].project(bronze, ["kind"])
    assert person.columns == ["id", "firstName", "origin", "kind"]
    assert rows(person) == [(1, "Ann", "crm", "new"), (2, None, "crm", "old")]
    address = got["address"].project(bronze)
    assert [f.dataType.simpleString() for f in address.schema] == ["string", "bigint", "int", "bigint", "string"]
    assert rows(address) == [("1_1", 1, 1, 10, None), ("1_2", 1, 2, 20, "b"), ("2_1", 2, 1, None, None), ("2_2", 2, 2, None, None)]


def test_one_generator_and_one_scan(spark, tmpdir_str):
    spark.createDataFrame([(1, "Ann", 10, 20, "a", "b", "new")], BRONZE).write.parquet(f"{tmpdir_str}/b")
    plan = compiled(spark, GOOD)["address"].project(spark.read.parquet(f"{tmpdir_str}/b"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Generate ") == 1 and "Exchange" not in plan


@pytest.mark.parametrize("row,message", [
    (("nowhere", None, "id", "id", "column", True), "nowhere: no such silver table"),
    (("person", None, "nothing", "id", "column", False), "person.nothing: no such silver column"),
    (("person", None, "firstName", "nothing", "column", False), "no bronze column 'nothing'"),
    (("person", None, "firstName", "id", "magic", False), "rule 'magic' is none of"),
    (("person", None, "firstName", None, "slot", False), "rule 'slot' in a table without slots"),
    (("person", None, "id", "id", "column", False), "person.id: filled twice"),
    (("address", 1, "zip", "zip2", "column", False), "address.zip in slot 1: filled twice"),
    (("address", 1, "city", "zip1", "column", False), None),
    (("address", 3, "zip", "First", "column", False), "address.zip in slot 3: string does not fit bigint"),
])
def test_refusals(spark, row, message):
    if message is None:
        compiled(spark, GOOD + [row])  # a number is kept as text
        return
    with pytest.raises(MappingError) as e:
        compiled(spark, GOOD + [row])
    assert message in str(e.value)


def test_all_faults_are_told_at_once(spark):
    bad = [("person", None, "firstName", "x", "column", False), ("address", 1, "id", "id", "column", False),
           ("address", 2, "zip", "zip2", "column", False)]
    with pytest.raises(MappingError) as e:
        compiled(spark, bad)
    for part in ("no bronze column 'x'", "person.id: required, but not filled", "person: no key column",
                 "address.id in slot 2: required, but not filled", "address.AddressId in slot 1: required, but not filled"):
        assert part in str(e.value)


def test_empty_mapping(spark):
    assert compiled(spark, []) == {}
