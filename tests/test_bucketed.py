"""Co-located MERGE: no exchange above the target, the same rows as the plain
MERGE, hot and null keys, reopening, and versions."""

import random
import re
import uuid

import pytest
from conftest import rows

from tidewell.operators.merge import MergeCardinalityError, delete, insert, merge, update
from tidewell.session import ddl_schema
from tidewell.sources.bucketed import SALT, BucketedTable

SCHEMA = "id long, part string, ver int, v string"
MATCHED = [delete("source.v = 'gone' AND source.ver > target.ver"), update("source.ver > target.ver", "*")]
NOT_MATCHED = [insert("source.v <> 'gone'", "*")]


def table(spark, path, keys=("id",), buckets=4, schema=SCHEMA, name=None):
    return BucketedTable(spark, name or f"t_{uuid.uuid4().hex[:8]}", f"{path}/t", ddl_schema(spark, schema), list(keys), buckets)


def random_rows(rng, n, hot):
    return [(rng.choice([None, 7] + [rng.randrange(60)] * 8) if not hot or rng.random() < 0.6 else 7, rng.choice("ab"),
             rng.randrange(5), rng.choice(["x", "y", "gone", None])) for _ in range(n)]


def unique(batch, keys):
    seen, out = set(), []
    for r in batch:
        k = (r[0], r[1])[:keys]
        if r[0] is None or k not in seen:
            out.append(r)
        seen.add(k)
    return out


@pytest.mark.parametrize("seed,keys,hot", [(0, 1, False), (1, 1, True), (2, 2, True), (3, 2, False)])
def test_equals_plain_merge_over_many_batches(spark, tmpdir_str, seed, keys, hot):
    rng = random.Random(seed)
    on = ["id", "part"][:keys]
    first = spark.createDataFrame(random_rows(rng, 300, hot), SCHEMA)
    t = table(spark, tmpdir_str, on)
    t.load(first)
    want = first
    for _ in range(4):
        batch = spark.createDataFrame(unique(random_rows(rng, 80, False), keys), SCHEMA)
        t.merge(batch, MATCHED, NOT_MATCHED)
        want = spark.createDataFrame(merge(want, batch, on, MATCHED, NOT_MATCHED).collect(), SCHEMA)
        assert rows(t.read()) == rows(want)
    assert len(t.versions()) == 5
    assert t.vacuum() == [0, 1, 2, 3] and rows(t.read()) == rows(want)


def exchanges_above_the_scan(plan):
    """Exchange nodes on the path from a parquet scan of the table to the root."""
    path, found = [], []
    for line in plan.splitlines():
        m = re.match(r"^([\s:|+-]*)(\S.*)$", line)
        if not m:
            continue
        depth = len(m[1])
        path = [(d, x) for d, x in path if d < depth] + [(depth, m[2])]
        if "FileScan parquet" in m[2] and "Bucketed: true" in m[2]:
            found.append([x for _, x in path if "Exchange" in x])
    return found


@pytest.mark.parametrize("hot", [False, True])
def test_the_target_is_not_shuffled(spark, tmpdir_str, hot):
    rng = random.Random(9)
    t = table(spark, tmpdir_str, buckets=4)  # fewer buckets than shuffle partitions
    t.load(spark.createDataFrame(random_rows(rng, 400, hot), SCHEMA))
    batch = spark.createDataFrame(unique(random_rows(rng, 80, False), 1), SCHEMA)
    out = t.merged(batch, MATCHED, NOT_MATCHED)
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = exchanges_above_the_scan(plan)
    assert above == [[]], plan
    assert "SortMergeJoin" in plan and "FullOuter" in plan
    # the version written is bucketed again, by the same tasks
    t.merge(batch, MATCHED, NOT_MATCHED)
    files = {r[0] for r in t._stored().selectExpr("input_file_name()").distinct().collect()}
    assert all(re.search(r"_\d{5}\.c\d{3}|_0000\d", f) for f in files)


def test_hot_key_is_spread_and_keeps_its_matches(spark, tmpdir_str):
    data = [(7, "a", i % 3, "x") for i in range(3000)] + [(i, "b", 1, "y") for i in range(100, 1100)]
    t = table(spark, tmpdir_str, buckets=8)
    t.load(spark.createDataFrame(data, SCHEMA))
    per = {r[SALT]: r["count"] for r in t._stored().filter("id = 7").groupBy(SALT).count().collect()}
    assert len(per) >= 6 and max(per.values()) < 1000
    t.merge(spark.createDataFrame([(7, "z", 2, "new"), (5, "z", 1, "ins")], SCHEMA), MATCHED, NOT_MATCHED)
    got = {(r.id, r.ver, r.v): r["count"] for r in t.read().filter("id IN (5, 7)").groupBy("id", "ver", "v").count().collect()}
    assert got == {(7, 2, "new"): 2000, (7, 2, "x"): 1000, (5, 1, "ins"): 1}
    # the key goes, and may come again as one row
    t.merge(spark.createDataFrame([(7, "z", 9, "gone")], SCHEMA), MATCHED, NOT_MATCHED)
    assert t.read().filter("id = 7").count() == 0 and t._hot() is None
    t.merge(spark.createDataFrame([(7, "z", 1, "back")], SCHEMA), MATCHED, NOT_MATCHED)
    assert t.read().filter("id = 7").count() == 1


def test_a_key_that_becomes_hot_is_spread_later(spark, tmpdir_str):
    t = table(spark, tmpdir_str, buckets=4)
    t.load(spark.createDataFrame([(i, "a", 0, "x") for i in range(200)], SCHEMA))
    many = spark.createDataFrame([(999, "a", 0, "x")] * 2000, SCHEMA)
    t.merge(many, MATCHED, NOT_MATCHED, cardinality="off")
    assert [(r.id, r.salts) for r in t._hot().collect()] == [(999, 4)]
    t.merge(spark.createDataFrame([(999, "b", 1, "y"), (1, "b", 1, "y")], SCHEMA), MATCHED, NOT_MATCHED)
    got = t.read().groupBy("id", "v").count().filter("id IN (1, 999)").collect()
    assert {(r.id, r.v): r["count"] for r in got} == {(999, "y"): 2000, (1, "y"): 1}


def test_a_lost_hot_list_is_made_again(spark, tmpdir_str):
    t = table(spark, tmpdir_str, buckets=4)
    t.load(spark.createDataFrame([(7, "a", 0, "x")] * 500 + [(1, "a", 0, "x")], SCHEMA))
    t.merge(spark.createDataFrame([(7, "a", 5, "gone")], SCHEMA), MATCHED, NOT_MATCHED)
    t._fs.delete(f"{t.path}/hot/v1")
    t.merge(spark.createDataFrame([(7, "a", 1, "back")], SCHEMA), MATCHED, NOT_MATCHED)
    assert rows(t.read()) == [(1, "a", 0, "x"), (7, "a", 1, "back")]


def test_another_session_takes_the_table_up(spark, tmpdir_str):
    t = table(spark, tmpdir_str, name="one")
    t.load(spark.createDataFrame([(i, "a", 0, "x") for i in range(20)], SCHEMA))
    other = table(spark, tmpdir_str, name="two")
    other.merge(spark.createDataFrame([(3, "a", 1, "y")], SCHEMA), MATCHED, NOT_MATCHED)
    assert other.read().filter("v = 'y'").count() == 1 and other.read().count() == 20
    plan = other.merged(spark.createDataFrame([(3, "a", 1, "y")], SCHEMA), MATCHED, NOT_MATCHED)
    assert exchanges_above_the_scan(plan._jdf.queryExecution().executedPlan().toString()) == [[]]


def test_cardinality_empty_and_required(spark, tmpdir_str):
    t = table(spark, tmpdir_str)
    t.merge(spark.createDataFrame([(1, "a", 0, "x"), (None, "a", 0, "x")], SCHEMA), MATCHED, NOT_MATCHED)
    assert t.read().count() == 2
    twice = spark.createDataFrame([(1, "a", 2, "y"), (1, "a", 3, "z")], SCHEMA)
    with pytest.raises(MergeCardinalityError):
        t.merge(twice, MATCHED, NOT_MATCHED)
    t.merge(spark.createDataFrame([], SCHEMA), MATCHED, NOT_MATCHED)
    assert t.read().count() == 2


def test_a_replayed_batch_is_skipped(spark, tmpdir_str):
    """Accumulating MERGEs in a stream: a replay, also after vacuum, adds nothing."""
    schema = "id long, v int"
    t = table(spark, tmpdir_str, schema=schema)
    add = ([update(None, {"v": "target.v + source.v"})], [insert(None, "*")])
    one = spark.createDataFrame([(1, 10), (2, 20)], schema)
    assert t.merge(one, *add, job="q", batch=0) == 0 and t.merge(one, *add, job="q", batch=0) is None
    assert t.merge(one, *add, job="q", batch=1) == 1
    t.vacuum()
    again = table(spark, tmpdir_str, schema=schema)
    assert again.merge(one, *add, job="q", batch=0) is None and again.merge(one, *add, job="q", batch=1) is None
    again._fs.delete(f"{t.path}/done/q__1")  # lost between the version and its marker
    assert again.merge(one, *add, job="q", batch=1) is None
    assert rows(again.read()) == [(1, 20), (2, 40)]


def test_a_stream_merges_into_buckets(spark, tmpdir_str):
    from tidewell.streaming.refine import query_id, refine_stream
    schema = "id long, ver int"
    t = table(spark, tmpdir_str, schema=schema)
    ck = f"{tmpdir_str}/ck"

    def handle(batch_df, batch_id):
        src = batch_df.groupBy("id").agg({"ver": "max"}).withColumnRenamed("max(ver)", "ver")
        t.merge(src, [update("source.ver > target.ver", "*")], [insert(None, "*")], job=query_id(batch_df.sparkSession, ck), batch=batch_id)

    for rows_in in ([(1, 1), (1, 2), (None, 1)], [(1, 1), (2, 5)]):
        spark.createDataFrame(rows_in, schema).coalesce(1).write.mode("append").parquet(f"{tmpdir_str}/in")
        refine_stream(spark, f"{tmpdir_str}/in", schema, handle, ck)
    assert rows(t.read()) == [(None, 1), (1, 2), (2, 5)] and t.versions() == [0, 1]
