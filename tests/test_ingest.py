"""Ingestion with schema evolution on the reference's CSV and JSON people
files (FIXTURES 1-2), typed in as literals."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from conftest import rows, write_lines
from tidewell.operators.evolve import all_strings, evolve, profile_types, SchemaClashError
from tidewell.plans.ingest import ingest
from tidewell.sources import files

# The sample CSV and JSON people files of the reference, as text,
# in their natural order (see FIXTURES.md sections 1 and 2); the rows of
# individual_data_type.csv are invented ones of the same shape.
CSV = {
    "individual.csv": ["firstName,lastName,age,location", "David,Cooker,17,Redmond", "Kate,Lucy,27,Bellevue"],
    "individual_new_field.csv": ["firstName,lastName,contactNumber", "Kathy,Bloomberg,111-222-333",
                                 "Terry,Tracy,555-222-444", "Harris,Porter,123-456-789"],
    "individual_order_change.csv": ["age,firstName,lastName,location", "22,Macy,Kingdom,Seattle",
                                    "34,Bryant,Mercy,Fremont"],
    "individual_delete_field.csv": ["firstName,lastName,age", "Ann,Irelia,29", "Tim,Frank,47"],
    "individual_data_type.csv": ["firstName,lastName,age,location,createdAt",
                                 "Petra,Halden,41,Tacoma,2021-03-02 00:00:00",
                                 "Oskar,Lindt,28,Everett,2021-08-19 00:00:00"],
    "different_data_types.csv": ["boolean,int,long,float,double,timestamp,timestampz,date",
                                 "True,10,123456789123456789,1.1F,1.23456D,2021-10-23T18:25:43.511,"
                                 "2021-10-23T18:25:43.511Z,2022-09-24"],
}

JSON = {
    "individual.json": [
        '{"firstName":"David","lastName":"Cooker","age":17,"address":{"streetNo":"123","cityName":"Redmond","zipCode":98052,"country":"U.S.A"}}',
        '{"firstName":"Kate","lastName":"Lucy","age":27,"address":{"streetNo":"456","cityName":"Bellevue","zipCode":98004,"country":"U.S.A"}}'],
    "individual_order_change.json": [
        '{"firstName":"David","lastName":"Cooker","age":17,"address":{"streetNo":"123","cityName":"Redmond","zipCode":98052,"country":"U.S.A"}}',
        '{"age":27,"address":{"country":"U.S.A","zipCode":98004,"cityName":"Bellevue","streetNo":"456"},"lastName":"Lucy","firstName":"Kate"}'],
    "individual_new_field.json": [
        '{"firstName":"Kathy","lastName":"Bloomberg","contactNumber":"111-222-333"}',
        '{"firstName":"Terry","lastName":"Tracy","contactNumber":"555-222-444"}',
        '{"firstName":"Harris","lastName":"Porter","contactNumber":"123-456-789"}'],
    "individual_delete_field.json": [
        '{"firstName":"Ann","lastName":"Irelia","age":29}', '{"firstName":"Tim","lastName":"Frank","age":47}'],
    "individual_with_array.json": [
        '{"firstName":"David","lastName":"Cooker","age":17,"address":[{"cityName":"Redmond"},{"cityName":"Fremont"}]}',
        '{"firstName":"Kate","lastName":"Lucy","age":27,"address":[{"cityName":"Bellevue"},{"cityName":"Sammamish"}]}'],
}


@pytest.fixture
def fx(tmp_path):
    out = {}
    for name, lines in {**CSV, **JSON}.items():
        out[name] = write_lines(str(tmp_path / name), lines)
    return out


def _table(spark):
    return f"tw_test_{uuid.uuid4().hex[:8]}"


def _csv(spark, p, infer=True):
    return files.read_csv(spark, p, header=True, infer=infer)


def test_load_base(spark, fx, tmp_path):
    t = _table(spark)
    ingest(spark, t, _csv(spark, fx["individual.csv"]), str(tmp_path / "t"))
    assert spark.table(t).count() == 2


def test_new_field_added_last_as_string(spark, fx, tmp_path):
    t = _table(spark)
    ingest(spark, t, _csv(spark, fx["individual.csv"]), str(tmp_path / "t"))
    ingest(spark, t, _csv(spark, fx["individual_new_field.csv"]))
    df = spark.table(t)
    assert df.columns == ["firstName", "lastName", "age", "location", "contactNumber"]
    assert isinstance(df.schema["contactNumber"].dataType, StringType)
    assert df.count() == 5
    assert ("David", None) in rows(df, "firstName", "contactNumber")
    assert ("Kathy", None, None) in rows(df, "firstName", "age", "location")


def test_reordered_columns_land_by_name(spark, fx, tmp_path):
    t = _table(spark)
    ingest(spark, t, _csv(spark, fx["individual.csv"]), str(tmp_path / "t"))
    ingest(spark, t, _csv(spark, fx["individual_order_change.csv"]))
    assert ("Macy", "Kingdom", 22, "Seattle") in rows(spark.table(t), "firstName", "lastName", "age", "location")
    assert spark.table(t).count() == 4


def test_deleted_field_is_null_filled(spark, fx, tmp_path):
    t = _table(spark)
    ingest(spark, t, _csv(spark, fx["individual.csv"]), str(tmp_path / "t"))
    ingest(spark, t, _csv(spark, fx["individual_delete_field.csv"]))
    df = spark.table(t)
    assert df.count() == 4
    assert rows(df.filter("location IS NULL"), "firstName") == [("Ann",), ("Tim",)]


def test_all_strings_without_inference(spark, fx):
    df = _csv(spark, fx["individual_data_type.csv"], infer=False)
    assert df.count() == 2 and all_strings(df.schema)


def test_profile_inferred_types(spark, fx):
    p = fx["different_data_types.csv"]
    prof = profile_types(spark, _csv(spark, p, infer=False).schema, _csv(spark, p).schema)
    got = {r["column"]: (r["stored_type"], r["inferred_type"]) for r in prof.collect()}
    assert got == {"boolean": ("string", "boolean"), "int": ("string", "integer"),
                   "long": ("string", "long"), "float": ("string", "double"),
                   "double": ("string", "double"), "timestamp": ("string", "timestamp"),
                   "timestampz": ("string", "timestamp"), "date": ("string", "date")}


def test_case_clash_is_an_error(spark):
    s = spark.createDataFrame([(1,)], "x int").schema
    bad = spark.createDataFrame([(1, 2)], "`Col` int, `col2` int").withColumnRenamed("col2", "COL")
    with pytest.raises(SchemaClashError):
        evolve(s, bad)


def test_json_primitives_as_string_keeps_nesting(spark, fx):
    df = files.read_json(spark, fx["individual.json"], primitives_as_string=True)
    assert df.count() == 2
    assert df.schema["address"].dataType["zipCode"].dataType == StringType()
    assert df.schema["age"].dataType == StringType()


def test_json_array_element_filter(spark, fx):
    df = files.read_json(spark, fx["individual_with_array.json"])
    assert df.count() == 2
    hit = df.filter(F.get(F.col("address"), 1).getField("cityName") == "Fremont")
    assert rows(hit, "firstName") == [("David",)]


def test_json_evolution_new_field_and_struct_null_fill(spark, fx, tmp_path):
    t = _table(spark)
    ingest(spark, t, files.read_json(spark, fx["individual.json"]), str(tmp_path / "t"))
    ingest(spark, t, files.read_json(spark, fx["individual_new_field.json"]))
    df = spark.table(t)
    assert df.count() == 5
    assert rows(df.filter(F.col("address.cityName") == "Redmond"), "firstName") == [("David",)]
    assert rows(df.filter(F.col("address.cityName") == "Bellevue"), "firstName") == [("Kate",)]
    t2 = _table(spark)
    ingest(spark, t2, files.read_json(spark, fx["individual.json"]), str(tmp_path / "t2"))
    ingest(spark, t2, files.read_json(spark, fx["individual_delete_field.json"]))
    df2 = spark.table(t2)
    assert df2.count() == 4 and df2.filter("address IS NULL").count() == 2


def test_json_key_order_is_irrelevant(spark, fx):
    a = files.read_json(spark, fx["individual.json"])
    b = files.read_json(spark, fx["individual_order_change.json"])
    assert a.schema == b.schema and rows(a) == rows(b)


def test_nested_struct_aligned_by_field_name(spark):
    """Fields matched by name whatever their order; a missing one is null.
    (An extra nested field is refused: see the array-of-structs test.)"""
    table = spark.createDataFrame([], "id int, s struct<a:int,b:string>").schema
    df = spark.createDataFrame([(1, ("x", 3))], "id int, s struct<b:string,a:int>")
    schema, out = evolve(table, df)
    assert schema.fieldNames() == ["id", "s"]
    assert out.collect()[0]["s"].asDict() == {"a": 3, "b": "x"}
    df2 = spark.createDataFrame([(1, ("y",))], "id int, s struct<b:string>")
    assert evolve(table, df2)[1].collect()[0]["s"].asDict() == {"a": None, "b": "y"}


from hypothesis import HealthCheck, given, settings, strategies as hst  # noqa: E402

COLS = ["a", "b", "c", "d", "e"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hst.permutations(COLS), hst.lists(hst.sampled_from(COLS), min_size=1, max_size=5, unique=True),
       hst.lists(hst.sampled_from(COLS), min_size=1, max_size=5, unique=True))
def test_evolve_lands_every_value_by_name(spark, order, table_cols, file_cols):
    """Random table and file column sets, random file order: every value
    lands under its own name; missing ones are null; new ones are appended
    as strings."""
    table = spark.createDataFrame([], ", ".join(f"{c} int" for c in table_cols)).schema
    file_cols = [c for c in order if c in file_cols]
    df = spark.createDataFrame([tuple(COLS.index(c) for c in file_cols)],
                               ", ".join(f"{c} int" for c in file_cols))
    schema, out = evolve(table, df)
    new = [c for c in file_cols if c not in table_cols]
    assert schema.fieldNames() == table_cols + new
    got = out.first().asDict()
    for c in schema.fieldNames():
        want = COLS.index(c) if c in file_cols else None
        if c in new:
            want = str(want)
        assert got[c] == want


def test_new_columns_infer_keeps_their_type_and_structs_become_json(spark):
    table = spark.createDataFrame([], "id int").schema
    df = spark.createDataFrame([(1, 5, ("x", 2))], "id int, n int, s struct<a:string,b:int>")
    schema, out = evolve(table, df, new_columns="infer")
    assert [f.dataType.simpleString() for f in schema.fields] == ["int", "int", "struct<a:string,b:int>"]
    schema2, out2 = evolve(table, df)
    assert [f.dataType.simpleString() for f in schema2.fields] == ["int", "string", "string"]
    r = out2.first()
    assert r["n"] == "5" and r["s"] == '{"a":"x","b":2}'


def test_array_of_structs_aligned_and_nested_additions_refused(spark):
    import pytest as _pt
    from tidewell.operators.evolve import NestedFieldError
    table = spark.createDataFrame([], "id int, address array<struct<cityName:string,zip:int>>").schema
    df = spark.createDataFrame([(1, [("Redmond",), ("Fremont",)])], "id int, address array<struct<cityName:string>>")
    _, out = evolve(table, df)
    got = out.first()["address"]
    assert [a["cityName"] for a in got] == ["Redmond", "Fremont"] and got[1]["zip"] is None
    wider = spark.createDataFrame([(1, [("Redmond", 5)])], "id int, address array<struct<cityName:string,floor:int>>")
    with _pt.raises(NestedFieldError):
        evolve(table, wider)


def test_lossy_casts_are_refused(spark):
    """3.7 into an int column, a timestamp into a date column, a long into an
    int or double column, text into a number: errors, not other values."""
    from tidewell.operators.evolve import LossyCastError
    bad = [("CAST(3.7 AS DOUBLE)", "int"), ("TIMESTAMP'2024-01-01 10:00:00'", "date"), ("5000000000L", "int"),
           ("9007199254740993L", "double"), ("'7'", "int"), ("CAST(1.25 AS DECIMAL(5,2))", "decimal(5,1)"), ("1", "float")]
    for value, kind in bad:
        table = spark.createDataFrame([], f"v {kind}").schema
        with pytest.raises(LossyCastError):
            evolve(table, spark.sql(f"SELECT {value} AS v"))
    with pytest.raises(LossyCastError):
        evolve(spark.createDataFrame([], "s struct<a: int>").schema, spark.sql("SELECT struct(1.5D AS a) AS s"))


def test_widening_casts_keep_values(spark):
    good = [("7", "bigint", 7), ("7", "double", 7.0), ("CAST(7 AS SMALLINT)", "float", 7.0), ("1.5F", "double", 1.5), ("7", "string", "7"),
            ("DATE'2024-01-02'", "string", "2024-01-02"), ("7", "decimal(12,2)", 7), ("NULL", "int", None)]
    for value, kind, want in good:
        _, df = evolve(spark.createDataFrame([], f"v {kind}").schema, spark.sql(f"SELECT {value} AS v"))
        assert df.first()["v"] == want


def test_json_column_is_inferred(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": 2.5, "d": [1, 2]}'), (3, None)], "id int, j string")
    out = files.parse_json_column(df, "j", alias="p").orderBy("id").select("p.a", "p.b.c", "p.d").collect()
    assert [tuple(r) for r in out] == [(1.0, "x", None), (2.5, None, [1, 2]), (None, None, None)]
