"""Type states against Spark's own schema inference, merging, and typing."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidewell.operators.profile import inferred_types, merge_states, states, typed
from tidewell.sources import files

VALUES = {
    "int": ["0", "1", "-7", "+5", "007", "2147483647", "-2147483648"],
    "long": ["2147483648", "-9000000000", "9223372036854775807"],
    "decimal": ["9223372036854775808", "123456789012345678901234567890", "-99999999999999999999"],
    "huge": ["1" + "0" * 40],
    "double": ["1.5", "-.5", "2.", "1e3", "-1.5E-7", "NaN", "Inf", "-Inf", "1.0d"],
    "date": ["2024-01-05", "1999-12-31"],
    "timestamp": ["2024-01-05 10:00:00", "2024-01-05T10:00:00Z", "2024-01-05 10:00:00.123"],
    "boolean": ["true", "False", "TRUE"],
    "string": ["x", "1,5", "2024-13-45", "tru", "12 x", "2024-01-05x", "--1", "1 2", "0x1F", "1_000"],
}


def spark_type(spark, folder, values):
    spark.createDataFrame([(v,) for v in values], "c string").coalesce(1).write.csv(folder, header=True)
    return files.read_csv(spark, folder, header=True, infer=True).schema["c"].dataType


def own_type(spark, values):
    got = inferred_types(states(spark.createDataFrame([(v,) for v in values], "c string")))["c"]
    return StringType() if got.typeName() == "void" else got


def cases():
    one = [[v] for group in VALUES.values() for v in group]
    rng = random.Random(5)
    groups = list(VALUES)
    mixed = [[rng.choice(VALUES[g]) for g in rng.sample(groups, rng.choice([2, 2, 3]))] for _ in range(25)]
    return one + mixed + [[None, None], ["", None], ["1", None, ""]]


def test_same_types_as_inference(spark, tmpdir_str):
    wrong = []
    for i, values in enumerate(cases()):
        a, b = spark_type(spark, f"{tmpdir_str}/{i}", values), own_type(spark, values)
        if a != b:
            wrong.append((values, a.simpleString(), b.simpleString()))
    assert not wrong


def test_states_merge_over_files(spark):
    rng = random.Random(2)
    every = [v for g in ("int", "long", "double", "date") for v in VALUES[g]]
    data = [(f"f{rng.randrange(4)}", rng.choice(VALUES["int"]), rng.choice(every), rng.choice(VALUES["date"] + VALUES["timestamp"]), None, i)
            for i in range(200)]
    df = spark.createDataFrame(data, "file string, a string, b string, `c.d` string, e string, n int")
    per_file = states(df, ["file"])
    assert per_file.count() == 4 * 4
    parts = [per_file.filter(F.col("file") == f"f{k}") for k in range(4)]
    key = lambda p: sorted(map(tuple, p.select("column", "seen", "digits", "values").collect()))
    whole = states(df.drop("file"))
    assert key(merge_states(*parts)) == key(merge_states(per_file)) == key(whole)
    assert key(merge_states(merge_states(*parts[:2]), merge_states(*parts[2:]))) == key(whole)
    types = inferred_types(merge_states(per_file))
    assert {c: t.typeName() for c, t in types.items()} == {"a": "integer", "b": "string", "c.d": "timestamp", "e": "void"}
    out = typed(df, types)
    assert [f.dataType.typeName() for f in out.schema] == ["string", "integer", "string", "timestamp", "string", "integer"]
    assert out.count() == 200


@pytest.mark.parametrize("values,name", [(["1", "", "3"], "integer"), (["", None], "void")])
def test_empty_texts_are_nulls(spark, values, name):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    types = inferred_types(states(df))
    assert types["c"].typeName() == name
    got = [r.c for r in typed(df, types).collect()]
    assert got == ([1, None, 3] if name == "integer" else values)


def test_no_rows_and_no_text_columns(spark):
    assert {c: t.typeName() for c, t in inferred_types(states(spark.createDataFrame([], "c string"))).items()} == {"c": "void"}
    assert states(spark.createDataFrame([(1,)], "c int")).count() == 0


def test_one_aggregation_for_all_columns(spark):
    df = spark.createDataFrame([("1", "x", "2.5")], "a string, b string, c string")
    plan = states(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bit_or" in plan
