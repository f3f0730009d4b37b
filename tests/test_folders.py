"""Folders of unlike CSV headers, quarantine of what a read skips, required
nested fields."""

import gzip
import os

import pytest
from conftest import rows, write_lines
from pyspark.errors import PySparkException
from pyspark.sql.types import StructType

from tidewell.functions import guard_not_null
from tidewell.operators.evolve import SchemaClashError
from tidewell.sources.folders import BROKEN, MALFORMED, NO_MAGIC, csv_headers, read_csv_folder, read_with_quarantine


def test_unlike_headers(spark, tmpdir_str):
    write_lines(f"{tmpdir_str}/a.csv", ["id,name", "1,x", '2,"y, z"'])
    write_lines(f"{tmpdir_str}/b.csv", ["Name,extra,ID", "p,q,3"])
    write_lines(f"{tmpdir_str}/c.csv", ["id,name", "4,"])
    write_lines(f"{tmpdir_str}/d.csv", ["extra,name"])
    write_lines(f"{tmpdir_str}/notes.txt", ["this is no csv"])
    open(f"{tmpdir_str}/empty.csv", "w").close()
    got = read_csv_folder(spark, tmpdir_str)
    assert got.columns == ["id", "name", "extra"]
    assert rows(got) == [("1", "x", None), ("2", "y, z", None), ("3", "p", "q"), ("4", None, None)]
    assert [(c, len(f)) for c, f in csv_headers(spark, tmpdir_str)] == [(["id", "name"], 2), (["Name", "extra", "ID"], 1), (["extra", "name"], 1)]


def test_header_line_of_a_file_in_many_splits(spark, tmpdir_str):
    write_lines(f"{tmpdir_str}/big.csv", ["k,v"] + [f"{i},{'x' * 40}" for i in range(5000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        got = read_csv_folder(spark, tmpdir_str)
        assert got.columns == ["k", "v"] and got.count() == 5000 and got.rdd.getNumPartitions() > 4
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_names_with_odd_characters(spark, tmpdir_str):
    folder = f"{tmpdir_str}/ä b [x]"
    write_lines(f"{folder}/one {{1}}.csv", ["id,v", "1,2"])
    write_lines(f"{folder}/two%20*.csv", ["v,id", "3,4"])
    whole = f"{tmpdir_str}/ä b \\[x\\]"
    assert rows(read_csv_folder(spark, whole)) == [("1", "2"), ("4", "3")]
    write_lines(f"{folder}/bad ?.parquet", ["no parquet"])
    got = read_with_quarantine(spark, whole, "parquet", "a int", glob="*.parquet")
    assert [r["reason"] for r in got.quarantine.collect()] == [NO_MAGIC] and got.good.count() == 0


def test_separator_recursion_and_clashes(spark, tmpdir_str):
    write_lines(f"{tmpdir_str}/x/a.csv", ["id;v", "1;2"])
    write_lines(f"{tmpdir_str}/y/b.csv", ["v;id;w", "3;4;5"])
    assert rows(read_csv_folder(spark, tmpdir_str, sep=";", recursive=True)) == [("1", "2", None), ("4", "3", "5")]
    assert read_csv_folder(spark, f"{tmpdir_str}/x", glob="*.none").columns == []
    write_lines(f"{tmpdir_str}/z/c.csv", ["id,ID", "1,2"])
    with pytest.raises(SchemaClashError):
        read_csv_folder(spark, f"{tmpdir_str}/z")


def by_name(df, *cols):
    return sorted((os.path.basename(r["file"]), *(r[c] for c in cols)) for r in df.collect())


def test_quarantine_json_and_csv(spark, tmpdir_str):
    write_lines(f"{tmpdir_str}/j/good.json", ['{"a": 1, "b": "x"}', '{"a": 2}'])
    write_lines(f"{tmpdir_str}/j/mixed.json", ['{"a": 3}', '{"a": ', "no json", '{"a": "text"}'])
    open(f"{tmpdir_str}/j/nothing.json", "w").close()
    with open(f"{tmpdir_str}/j/cut.json.gz", "wb") as f:
        f.write(b"this is no gzip stream at all")
    got = read_with_quarantine(spark, f"{tmpdir_str}/j", "json", "a int, b string")
    assert rows(got.good) == [(1, "x"), (2, None), (3, None)]
    assert by_name(got.quarantine, "record", "reason") == [
        ("cut.json.gz", None, BROKEN), ("mixed.json", "no json", MALFORMED), ("mixed.json", '{"a": ', MALFORMED),
        ("mixed.json", '{"a": "text"}', MALFORMED)]
    assert by_name(got.account, "good_rows", "bad_records", "status") == [
        ("cut.json.gz", 0, 0, "unreadable"), ("good.json", 2, 0, "read"), ("mixed.json", 1, 3, "partly"), ("nothing.json", 0, 0, "empty")]
    write_lines(f"{tmpdir_str}/c/a.csv", ["a,b", "1,x", "oops,y", "2,z,too,many"])
    got = read_with_quarantine(spark, f"{tmpdir_str}/c", "csv", "a int, b string", {"header": "true"})
    assert rows(got.good) == [(1, "x")]
    assert by_name(got.quarantine, "record") == [("a.csv", "2,z,too,many"), ("a.csv", "oops,y")]


def test_quarantine_parquet(spark, tmpdir_str):
    df = spark.range(10).selectExpr("id", "cast(id AS string) AS _record")
    df.coalesce(1).write.parquet(f"{tmpdir_str}/p/one")
    df.limit(0).write.parquet(f"{tmpdir_str}/p/none")
    write_lines(f"{tmpdir_str}/p/bad.parquet", ["PAR1 is not enough"])
    with gzip.open(f"{tmpdir_str}/p/zip.parquet", "wb") as f:
        f.write(b"x" * 100)
    got = read_with_quarantine(spark, f"{tmpdir_str}/p", "parquet", df.schema, recursive=True, glob="*.parquet")
    assert got.good.columns == ["id", "_record"] and got.good.count() == 10
    assert by_name(got.quarantine, "reason") == [("bad.parquet", NO_MAGIC), ("zip.parquet", NO_MAGIC)]
    status = sorted((r["status"], r["good_rows"]) for r in got.account.collect())
    assert status == [("empty", 0), ("read", 10), ("unreadable", 0), ("unreadable", 0)]


REQUIRED = ("id int NOT NULL, who struct<key: int NOT NULL, name: string>, items array<struct<price: double NOT NULL>>, "
            "tags map<string, array<int>>")


def required_schema():
    schema = StructType.fromDDL(REQUIRED)
    schema["tags"].dataType.valueType.containsNull = False
    schema["items"].dataType.containsNull = False
    return schema


@pytest.mark.parametrize("row,path", [
    ((1, (2, None), [(1.5,), (2.0,)], {"a": [1], "b": None}), None),
    ((1, None, None, None), None),
    ((1, (2, "x"), [], {}), None),
    ((None, (2, "x"), [], {}), "id"),
    ((1, (None, "x"), [], {}), "who.key"),
    ((1, (2, "x"), [(1.0,), None], {}), "items[1]"),
    ((1, (2, "x"), [(1.0,), (2.0,), (None,)], {}), "items[2].price"),
    ((1, (2, "x"), [], {"a": [1], "b": [1, None]}), "tags['b'][1]"),
])
def test_required_nested_fields(spark, tmpdir_str, row, path):
    loose = "id int, who struct<key: int, name: string>, items array<struct<price: double>>, tags map<string, array<int>>"
    df = guard_not_null(spark.createDataFrame([row], loose), required_schema())
    if path is None:
        df.write.parquet(f"{tmpdir_str}/t")
        assert [tuple(r) for r in spark.read.parquet(f"{tmpdir_str}/t").collect()] == [tuple(spark.createDataFrame([row], loose).first())]
        return
    with pytest.raises(PySparkException) as e:
        df.write.parquet(f"{tmpdir_str}/t")
    assert f"NOT NULL column {path} received a null" in str(e.value)


def test_nothing_required_adds_nothing(spark):
    df = spark.createDataFrame([(1, [None])], "a int, b array<int>")
    assert guard_not_null(df, df.schema) is df
