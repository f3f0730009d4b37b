"""Snapshot tables: versions, atomic publish, idempotent replay, upkeep
(FIXTURES 1 spike scenarios)."""

import os

from pyspark.sql import functions as F

from conftest import rows
from tidewell.sources.tables import SnapshotTable

# The reference's "spike" people rows (FIXTURES.md section 1).
SPIKE = [("David", "Cooker", "17", "Redmond"), ("Kate", "Lucy", "27", "Bellevue"),
         ("Mike", "Patrick", "44", "Seattle")]
SCHEMA = "firstName string, lastName string, age string, location string"


def _spike(spark, tmp_path, **kw):
    t = SnapshotTable(spark, str(tmp_path / "spike"), **kw)
    t.replace(spark.createDataFrame(SPIKE, SCHEMA))
    return t


def test_delete_where_and_view(spark, tmp_path):
    t = _spike(spark, tmp_path)
    t.delete_where("location = 'Redmond'")
    assert rows(t.read(), "firstName") == [("Kate",), ("Mike",)]
    t.as_view("tw_spike_view")
    assert rows(spark.sql("SELECT firstName FROM tw_spike_view WHERE age > '30'")) == [("Mike",)]
    assert spark.table("tw_spike_view").count() == 2


def test_partition_identity_compact_vacuum(spark, tmp_path):
    t = _spike(spark, tmp_path)
    t.repartition_by(["location"])
    assert t.read().count() == 3
    t.append(spark.createDataFrame(SPIKE, SCHEMA).repartition(3), job="more")
    t.compact(target_bytes=1 << 30)
    assert t.read().count() == 6
    assert len(t.vacuum()) == 3
    assert [v.number for v in t.versions()] == [3] and t.read().count() == 6


def test_half_written_version_is_ignored_and_replaced(spark, tmp_path):
    t = _spike(spark, tmp_path)
    os.makedirs(os.path.join(t.path, "tw_version=000001__crashed__7"))
    assert t.current().number == 0 and t.read().count() == 3
    v = t.append(spark.createDataFrame([("Ann", "Irelia", "29", None)], SCHEMA))
    assert v.number == 1 and t.read().count() == 4
    assert not os.path.exists(os.path.join(t.path, "tw_version=000001__crashed__7"))


def test_publish_is_idempotent_per_job_and_batch(spark, tmp_path):
    t = _spike(spark, tmp_path)

    def double_ages(df):
        return df.withColumn("age", (F.col("age").cast("int") * 2).cast("string"))

    assert t.publish(double_ages, "job-a", 5) is not None
    assert t.publish(double_ages, "job-a", 5) is None          # replay: skipped
    assert rows(t.read(), "age") == [("34",), ("54",), ("88",)]
    assert t.publish(double_ages, "job-b", 5) is not None      # a new job id is new work


def test_bucket_layout(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "b"), bucket_key="firstName", buckets=4)
    t.replace(spark.createDataFrame(SPIKE, SCHEMA))
    assert rows(t.read()) == rows(spark.createDataFrame(SPIKE, SCHEMA))
    raw = spark.read.parquet(t.current().path)
    assert "bucket" in raw.columns and raw.select("bucket").distinct().count() <= 4


def _kv(spark, recs):
    return spark.createDataFrame(recs, "k int, v int, ver int")


def test_merge_touched_rewrites_only_touched_buckets(spark, tmp_path):
    from tidewell.operators.merge import delete, insert, merge, update
    t = SnapshotTable(spark, str(tmp_path / "kv"), schema=_kv(spark, []).schema, bucket_key="k", buckets=32)
    base = _kv(spark, [(k, k * 10, 1) for k in range(200)])
    t.replace(base)
    matched = [delete("source.v IS NULL AND source.ver > target.ver"),
               update("source.ver > target.ver", "*")]
    batch = _kv(spark, [(3, 31, 2), (7, None, 2), (500, 5000, 1), (9, 99, 0)])
    v = t.merge_touched(batch, ["k"], matched, [insert("source.v IS NOT NULL", "*")], "job", 1)
    assert v.partial
    want = merge(base, batch, ["k"], matched, [insert("source.v IS NOT NULL", "*")])
    assert rows(t.read()) == rows(want)
    touched = {f"bucket={b}" for b in t.touched_buckets(batch)}
    assert set(t.folders_of(v)) == touched and len(touched) < 32
    # replay of the same batch is skipped
    assert t.merge_touched(batch, ["k"], matched, [insert(None, "*")], "job", 1) is None
    # a second partial version stacks on the first
    b2 = _kv(spark, [(3, 32, 3)])
    t.merge_touched(b2, ["k"], [update("source.ver > target.ver", "*")], [insert(None, "*")], "job", 2)
    assert (3, 32, 3) in rows(t.read()) and t.read().count() == 200
    # upkeep keeps every version the current rows live in, and the replay markers
    t.vacuum()
    assert [x.number for x in t.versions()] == [0, 1, 2] and t.read().count() == 200
    t.compact(target_bytes=1 << 30)
    t.vacuum()
    assert [x.number for x in t.versions()] == [3] and t.read().count() == 200
    assert t.merge_touched(b2, ["k"], [update(None, "*")], [insert(None, "*")], "job", 2) is None


def test_merge_touched_bucket_emptied(spark, tmp_path):
    from tidewell.operators.merge import delete, insert
    t = SnapshotTable(spark, str(tmp_path / "kv"), schema=_kv(spark, []).schema, bucket_key="k", buckets=64)
    t.replace(_kv(spark, [(1, 1, 1), (2, 2, 1)]))
    t.merge_touched(_kv(spark, [(1, None, 2)]), ["k"], [delete("source.ver > target.ver")],
                    [insert("source.v IS NOT NULL", "*")], "j", 0)
    assert rows(t.read()) == [(2, 2, 1)]


def test_merge_touched_needs_the_bucket_key(spark, tmp_path):
    import pytest
    t = SnapshotTable(spark, str(tmp_path / "kv"), schema=_kv(spark, []).schema, bucket_key="k", buckets=32)
    with pytest.raises(ValueError):
        t.merge_touched(_kv(spark, [(1, 1, 1)]), ["v"], [], [], "j", 0)


def test_many_batches_never_rewrite_the_table(spark, tmp_path):
    """Every merge and append stays local, however many came before; a merge
    folds the appends of the buckets it touches."""
    from tidewell.operators.merge import insert, update
    t = SnapshotTable(spark, str(tmp_path / "kv"), schema=_kv(spark, []).schema, bucket_key="k", buckets=8)
    t.replace(_kv(spark, [(k, k, 1) for k in range(50)]))
    for i in range(5):
        t.append(_kv(spark, [(100 + i, 1, 1)]))
        v = t.merge_touched(_kv(spark, [(i, 100 + i, 2)]), ["k"], [update(None, "*")], [insert(None, "*")], "j", i)
        assert len(t.folders_of(v)) == 1
    assert [v.kind for v in t.versions()] == [""] + ["a", "p"] * 5
    assert t.read().count() == 55 and (3, 103, 2) in rows(t.read())
    t.vacuum()
    assert t.read().count() == 55


def test_a_batch_of_all_buckets_and_a_new_table_use_the_same_path(spark, tmp_path):
    from tidewell.operators.merge import insert, update
    t = SnapshotTable(spark, str(tmp_path / "kv"), schema=_kv(spark, []).schema, bucket_key="k", buckets=4)
    for i in range(2):
        v = t.merge_touched(_kv(spark, [(k, i, i) for k in range(40)]), ["k"], [update(None, "*")], [insert(None, "*")], "j", i)
        assert v.partial and len(t.folders_of(v)) == 4
    assert t.read().count() == 40 and t.read().filter("v = 1").count() == 40


def test_layout_is_stored_and_another_one_refused(spark, tmp_path):
    import pytest
    from tidewell.operators.merge import insert, update
    from tidewell.sources.tables import LayoutError
    p = str(tmp_path / "kv")
    t = SnapshotTable(spark, p, schema=_kv(spark, []).schema, bucket_key="k", buckets=16)
    t.replace(_kv(spark, [(k, k, 1) for k in range(200)]))
    with pytest.raises(LayoutError):
        SnapshotTable(spark, p, schema=_kv(spark, []).schema, bucket_key="k", buckets=32)
    again = SnapshotTable(spark, p, schema=_kv(spark, []).schema, bucket_key="k")
    assert again.buckets == 16
    again.merge_touched(_kv(spark, [(1, 7, 2)]), ["k"], [update(None, "*")], [insert(None, "*")], "j", 0)
    assert again.read().count() == 200 and SnapshotTable(spark, p).read().count() == 200


def test_replay_after_compaction_and_vacuum_is_skipped(spark, tmp_path):
    from tidewell.operators.merge import insert, update
    t = SnapshotTable(spark, str(tmp_path / "acc"), schema=_kv(spark, []).schema, bucket_key="k", buckets=8)
    add = [update(None, {"v": "target.v + source.v"})]
    for i in range(2):
        t.merge_touched(_kv(spark, [(1, 1, i)]), ["k"], add, [insert(None, "*")], "j", i)
    t.compact()
    t.vacuum()
    assert t.merge_touched(_kv(spark, [(1, 1, 1)]), ["k"], add, [insert(None, "*")], "j", 1) is None
    assert rows(t.read(), "v") == [(2,)]
    assert t.append(_kv(spark, [(5, 5, 5)]), "load", 3) is not None
    assert t.append(_kv(spark, [(5, 5, 5)]), "load", 3) is None
    assert t.read().count() == 2


def _files_per_folder(t):
    import collections
    return collections.Counter(r["file"].rsplit("/", 2)[1] for r in t.data_files().collect())


def test_compaction_follows_the_target(spark, tmp_path):
    wide = spark.range(20000).selectExpr("id", "id % 4 AS part", "sha2(CAST(id AS STRING), 256) AS text")
    for kw in ({}, {"partition_by": ["part"]}, {"bucket_key": "id", "buckets": 4}):
        t = SnapshotTable(spark, str(tmp_path / "_".join(["t", *kw])), schema=wide.schema, **kw)
        t.replace(wide.limit(0))
        for k in range(5):
            t.append(wide.filter(f"id % 5 = {k}").repartition(4))
        t.compact(target_bytes=1 << 30)
        one = _files_per_folder(t)
        assert set(one.values()) == {1} and t.read().count() == 20000
        t.compact(target_bytes=100_000)
        many = _files_per_folder(t)
        assert all(n > 1 for n in many.values()) and sum(many.values()) < 60
        assert rows(t.read().agg(F.sum("id"), F.count_distinct("text"))) == [(199990000, 20000)]


def test_compaction_joins_stored_files_without_a_shuffle(spark, tmp_path, monkeypatch):
    t = SnapshotTable(spark, str(tmp_path / "joined"))
    t.replace(spark.range(20000).selectExpr("id", "repeat('x', 200) AS text").repartition(6))
    written, write = [], t._write
    monkeypatch.setattr(t, "_write", lambda out, *a: (written.append(out), write(out, *a))[1])
    t.compact(target_bytes=1 << 30)
    assert "Exchange" not in written[0]._jdf.queryExecution().executedPlan().toString()
    assert set(_files_per_folder(t).values()) == {1}
    assert rows(t.read().agg(F.sum("id"), F.count("text"))) == [(199990000, 20000)]


def test_filtered_compaction_writes_one_file_per_folder(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "f"), partition_by=["part"])
    t.replace(spark.range(400).selectExpr("id", "id % 20 AS part"))
    for k in range(3):
        t.append(spark.range(400 + k * 20, 420 + k * 20).selectExpr("id", "id % 20 AS part"))
    v = t.compact(where="part < 15")
    assert v.partial and len(t.folders_of(v)) == 15
    files = _files_per_folder(t)
    assert all(files[f"part={k}"] == 1 for k in range(15)) and all(files[f"part={k}"] > 1 for k in range(15, 20))
    assert t.read().count() == 460


def test_bucket_expression_keeps_derived_key_matches_together(spark, tmp_path):
    """Order number join: '007' in the batch must find '7' in the table, and an
    id beyond the int range itself."""
    from tidewell.plans.orders import VERSIONED_INSERT, VERSIONED_MATCHED, number_key, order_key
    from tidewell.operators.merge import merge
    sch = "order_id string, record_version int, amount double, ship_status string"
    t = SnapshotTable(spark, str(tmp_path / "o"), schema=spark.createDataFrame([], sch).schema,
                      bucket_expr=order_key("order_id"), buckets=32)
    base = spark.createDataFrame([(str(k), 1, 10.0, "") for k in range(99)] + [("3000000000", 1, 1.0, "")], sch)
    t.replace(base)
    batch = spark.createDataFrame([("007", 2, 5.0, None), ("500", 1, 1.0, None), ("x", 1, 2.0, None), ("3000000000", 2, 2.0, None)], sch)
    v = t.merge_touched(batch, number_key(), VERSIONED_MATCHED(), VERSIONED_INSERT, "j", 0, cardinality="off")
    assert v.partial
    want = merge(base, batch, number_key(), VERSIONED_MATCHED(), VERSIONED_INSERT, cardinality="off")
    assert rows(t.read()) == rows(want)
    assert ("7", 1, 15.0, "") in rows(t.read()) and t.read().count() == 102
    assert rows(t.read().filter("order_id = '3000000000'")) == [("3000000000", 1, 3.0, "")]


def test_two_spellings_of_an_order_in_one_batch_are_refused(spark, tmp_path):
    import pytest
    from tidewell.operators.merge import MergeCardinalityError
    from tidewell.plans.orders import order_key
    from tidewell.plans.streams import versioned_accumulate_touched
    sch = "order_id string, record_version int, amount double, ship_status string"
    t = SnapshotTable(spark, str(tmp_path / "o"), schema=spark.createDataFrame([], sch).schema,
                      bucket_expr=order_key("order_id"), buckets=8)
    t.replace(spark.createDataFrame([("7", 1, 10.0, "")], sch))
    batch = spark.createDataFrame([("7", 2, 5.0, None), ("007", 2, 5.0, None)], sch)
    with pytest.raises(MergeCardinalityError):
        versioned_accumulate_touched(t, batch, "j", 0)
    assert rows(t.read()) == [("7", 1, 10.0, "")]


def test_append_writes_only_new_rows(spark, tmp_path):
    from tidewell.operators.merge import insert, update
    # plain table with a partition column
    t = SnapshotTable(spark, str(tmp_path / "plain"), partition_by=["location"])
    t.replace(spark.createDataFrame(SPIKE, SCHEMA))
    v = t.append(spark.createDataFrame([("Ann", "Irelia", "29", "Redmond")], SCHEMA))
    assert v.kind == "a" and spark.read.parquet(v.path).count() == 1
    assert t.read().count() == 4
    assert rows(t.read().filter("location = 'Redmond'"), "firstName") == [("Ann",), ("David",)]
    # bucketed: appended rows are read, then superseded by a partial MERGE of their bucket
    b = SnapshotTable(spark, str(tmp_path / "kv"), schema=_kv(spark, []).schema, bucket_key="k", buckets=32)
    b.replace(_kv(spark, [(k, k, 1) for k in range(40)]))
    b.append(_kv(spark, [(100, 1, 1), (101, 1, 1)]))
    assert b.read().count() == 42
    b.merge_touched(_kv(spark, [(100, 7, 2)]), ["k"], [update("source.ver > target.ver", "*")],
                    [insert(None, "*")], "j", 0)
    got = rows(b.read())
    assert len(got) == 42 and (100, 7, 2) in got and (101, 1, 1) in got and (100, 1, 1) not in got


def test_declared_not_null_is_enforced_on_write(spark, tmp_path):
    import pytest
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType
    schema = StructType([
        StructField("level", StringType(), False),
        StructField("event_time", StringType(), False, metadata={"comment": "EventType"}),
        StructField("message", StringType(), False),
        StructField("call_stack", ArrayType(StringType(), containsNull=False), True)])
    t = SnapshotTable(spark, str(tmp_path / "logs"), schema=schema)
    ok = spark.createDataFrame([("INFO", "2021-01-01 00:00:00", "up", ["a", "b"])], schema)
    t.replace(ok)
    assert t.read().count() == 1 and t.schema["event_time"].metadata["comment"] == "EventType"
    bad = spark.createDataFrame([("INFO", None, "up", None)],
                                "level string, event_time string, message string, call_stack array<string>")
    with pytest.raises(Exception, match="NOT NULL column event_time"):
        t.append(bad)
    assert t.read().count() == 1          # the failed write never committed


def test_partition_aligned_delete_is_metadata_only_and_filtered_compaction(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "spike"), partition_by=["location"])
    t.replace(spark.createDataFrame(SPIKE, SCHEMA).repartition(3))
    t.append(spark.createDataFrame([("Ann", "Irelia", "29", "Bellevue")], SCHEMA))
    v = t.delete_where("location = 'Redmond'")
    assert v.partial and spark.read.schema(SCHEMA).parquet(v.path).isEmpty()     # nothing rewritten
    assert rows(t.read(), "firstName") == [("Ann",), ("Kate",), ("Mike",)]
    # a predicate on a data column is not partition-aligned: rows are filtered and rewritten
    t.delete_where("age = '44'")
    assert rows(t.read(), "firstName") == [("Ann",), ("Kate",)]
    # compact only Bellevue (two files from the base and the append -> one)
    t2 = SnapshotTable(spark, str(tmp_path / "spike2"), partition_by=["location"])
    t2.replace(spark.createDataFrame(SPIKE, SCHEMA))
    t2.append(spark.createDataFrame([("Ann", "Irelia", "29", "Bellevue")], SCHEMA))
    before = t2.data_files().count()
    v2 = t2.compact(target_bytes=1 << 30, where="location = 'Bellevue'")
    assert v2.partial and t2.folders_of(v2) == ["location=Bellevue"]
    assert t2.data_files().count() == before - 1
    assert rows(t2.read()) == rows(spark.createDataFrame(SPIKE + [("Ann", "Irelia", "29", "Bellevue")], SCHEMA))


def test_create_if_not_exists_replace_and_drop(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "new"), schema=_kv(spark, []).schema, bucket_key="k", buckets=4)
    assert not t.exists() and t.read().count() == 0
    assert t.create() is not None and t.exists()
    t.append(_kv(spark, [(1, 1, 1)]))
    assert t.create() is None and t.read().count() == 1            # IF NOT EXISTS: no-op
    t.create(replace=True)
    assert t.read().count() == 0
    assert t.drop() and not t.exists()


def test_partitioned_table_history_matches_a_model(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "hist"), partition_by=["location"])
    history = []

    def state():
        return sorted(tuple(r) for r in t.read().select(*SCHEMA_COLS).collect())

    model = list(SPIKE)
    t.replace(spark.createDataFrame(SPIKE, SCHEMA)); history.append(sorted(model))
    new = [("Ann", "Irelia", "29", "Tacoma"), ("Tim", "Frank", "47", "Bellevue")]
    t.append(spark.createDataFrame(new, SCHEMA)); model += new; history.append(sorted(model))
    t.delete_where("location = 'Bellevue'"); model = [r for r in model if r[3] != "Bellevue"]
    history.append(sorted(model))
    t.append(spark.createDataFrame([("Ben", "Red", "31", "Tacoma")], SCHEMA))
    model.append(("Ben", "Red", "31", "Tacoma")); history.append(sorted(model))
    t.compact(target_bytes=1 << 30, where="location = 'Tacoma'"); history.append(sorted(model))
    t.delete_where("age > '40'"); model = [r for r in model if not r[2] > "40"]; history.append(sorted(model))
    assert state() == sorted(model)
    t.vacuum()
    assert state() == sorted(model)
    assert [v.kind for v in t.versions()] == [""]


SCHEMA_COLS = ["firstName", "lastName", "age", "location"]


def test_bucket_scoped_merges_equal_plain_merges_on_random_batches(spark, tmp_path):
    import random
    from tidewell.operators.merge import delete, insert, merge, update
    rnd = random.Random(7)
    sch = _kv(spark, []).schema
    t = SnapshotTable(spark, str(tmp_path / "rk"), schema=sch, bucket_key="k", buckets=32)
    base = [(k, rnd.randint(0, 9), 1) for k in range(120)]
    t.replace(_kv(spark, base))
    plain = spark.createDataFrame(base, sch)
    matched = [delete("source.v IS NULL AND source.ver > target.ver"),
               update("source.ver > target.ver", "*")]
    not_matched = [insert("source.v IS NOT NULL", "*")]
    for b in range(6):
        keys = rnd.sample(range(200), 6)
        batch = [(k, rnd.choice([None, rnd.randint(0, 9)]), rnd.randint(0, 3)) for k in keys]
        src = spark.createDataFrame(batch, sch)
        t.merge_touched(src, ["k"], matched, not_matched, "job", b)
        plain = spark.createDataFrame(merge(plain, src, ["k"], matched, not_matched).collect(), sch)
        if b == 1:
            extra = [(1000 + b, 1, 1)]
            t.append(_kv(spark, extra))
            plain = plain.unionByName(spark.createDataFrame(extra, sch))
        assert rows(t.read()) == rows(plain), b
    kinds = [v.kind for v in t.versions()]
    assert "p" in kinds and "a" in kinds and kinds.count("") == 1   # no batch rewrote the table


def test_delete_keys_rewrites_only_their_buckets(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "dk"), schema=_kv(spark, []).schema, bucket_key="k", buckets=32)
    t.replace(_kv(spark, [(k, k, 1) for k in range(100)]))
    gone = spark.createDataFrame([(5,), (6,), (5,), (777,)], "k int")
    v = t.delete_keys(gone)
    assert v.partial and len(t.folders_of(v)) <= 3
    assert sorted(r["k"] for r in t.read().collect()) == [k for k in range(100) if k not in (5, 6)]
