"""MERGE semantics on the reference's scenarios (FIXTURES 3-5), the
cardinality rule, null keys, and a randomised check against a dict model."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidewell.operators import cleanse
from tidewell.operators.merge import (MergeCardinalityError, cardinality_conflicts, delete, insert,
                                      merge, update)
from tidewell.plans import contact, individual

STRATEGIES = ["broadcast", "shuffle"]

# --- contact (party + phones) with deletes: FIXTURES 5 --------------------------
# The scenario rows below (ids, names, phones, versions) are the
# reference's, as text in their natural order; so are the person/address rows
# (FIXTURES 4) and the orders rows (FIXTURES 3) further down.

BRONZE = ("id int, name string, Ph1 int, Ph2 int, Ph3 int, recordVersion int, "
          "recordType string, arrivalTime timestamp, seq int")
PARTY = "id int, name string, Ph1 int, Ph2 int, Ph3 int, recordVersion int"
POINT = "ContactPointId string, PartyId int, Ph int, recordVersion int"
T0 = dt.datetime(2021, 8, 1)


def _batch(spark, *recs):
    return spark.createDataFrame([r + (T0, i) for i, r in enumerate(recs)], BRONZE)


def _apply(spark, parties, points, batch, strategy):
    latest = contact.latest_parties(batch)
    parties = contact.merge_parties(parties, latest, strategy=strategy)
    points = contact.merge_points(points, contact.contact_points(latest), strategy=strategy)
    # tiny fixtures: rebuild from rows so the next step starts from plain data
    return (spark.createDataFrame(parties.collect(), PARTY),
            spark.createDataFrame(points.collect(), POINT))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_contact_scenarios(spark, strategy):
    p = spark.createDataFrame([], PARTY)
    c = spark.createDataFrame([], POINT)
    p, c = _apply(spark, p, c, _batch(spark, (1, "Some", 2222, None, 3333, 1, "upsert")), strategy)
    assert rows(p) == [(1, "Some", 2222, None, 3333, 1)]
    assert rows(c) == [("1_1", 1, 2222, 1), ("1_3", 1, 3333, 1)]
    # overwrite + insert
    p, c = _apply(spark, p, c, _batch(spark, (1, "Some", 2222, 4444, 3333, 2, "upsert")), strategy)
    assert rows(p) == [(1, "Some", 2222, 4444, 3333, 2)]
    assert rows(c) == [("1_1", 1, 2222, 2), ("1_2", 1, 4444, 2), ("1_3", 1, 3333, 2)]
    # overwrite + delete of a null phone
    p, c = _apply(spark, p, c, _batch(spark, (1, "Some", None, 5555, 3333, 3, "upsert")), strategy)
    assert rows(p) == [(1, "Some", None, 5555, 3333, 3)]
    assert rows(c) == [("1_2", 1, 5555, 3), ("1_3", 1, 3333, 3)]
    # full delete
    p, c = _apply(spark, p, c, _batch(spark, (1, None, None, None, None, 4, "delete")), strategy)
    assert rows(p) == [] and rows(c) == []
    # stale record after the delete comes back (no tombstone)
    p, c = _apply(spark, p, c, _batch(spark, (1, "Some", 2222, None, 3333, 2, "upsert")), strategy)
    assert rows(p) == [(1, "Some", 2222, None, 3333, 2)]
    assert rows(c) == [("1_1", 1, 2222, 2), ("1_3", 1, 3333, 2)]


def test_same_or_older_version_is_ignored_and_null_type_keeps(spark):
    p = spark.createDataFrame([(1, "A", 1, 2, 3, 5)], PARTY)
    b = _batch(spark, (1, "B", 9, 9, 9, 5, "upsert"))
    assert rows(contact.merge_parties(p, contact.latest_parties(b))) == [(1, "A", 1, 2, 3, 5)]
    b = _batch(spark, (1, "B", 9, 9, 9, 6, None))
    assert rows(contact.merge_parties(p, contact.latest_parties(b))) == [(1, "A", 1, 2, 3, 5)]
    # unmatched 'delete' with payload is inserted: the insert clause ignores the type
    b = _batch(spark, (2, "C", 1, None, None, 1, "delete"))
    assert (2, "C", 1, None, None, 1) in rows(contact.merge_parties(p, contact.latest_parties(b)))


# --- person + address: FIXTURES 4 -------------------------------------------------

PBRONZE = ("id int, firstName string, lastName string, streetNo1 int, cityName1 string, zipcode1 int, "
           "country1 string, streetNo2 int, cityName2 string, zipcode2 int, country2 string, "
           "arrivalTime timestamp, recordVersion int, seq int")


def _people(spark, *recs):
    return spark.createDataFrame([r[:11] + (T0, r[11], i) for i, r in enumerate(recs)], PBRONZE)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_person_address_scenarios(spark, strategy):
    start = _people(spark,
                    (1, "abc", "bcd", 123, "redmond", 98022, "usa", 343, "bellevue", 98077, "usa", 1),
                    (2, "some", "one", 444, "seattle", 98008, "usa", None, None, None, None, 1))
    latest = individual.refine_people(start)
    persons = latest.select(*individual.PERSON_COLS)
    addrs = individual.addresses(latest)
    assert rows(persons) == [(1, "abc", "bcd", 1), (2, "some", "one", 1)]
    assert rows(addrs) == [(1, 1, 123, "redmond", 98022, "usa", 1), (1, 2, 343, "bellevue", 98077, "usa", 1),
                           (2, 1, 444, "seattle", 98008, "usa", 1), (2, 2, None, None, None, None, 1)]

    def step(persons, addrs, *recs):
        l2 = individual.refine_people(_people(spark, *recs))
        p = individual.merge_upsert(persons, l2.select(*individual.PERSON_COLS), ["id"], strategy=strategy)
        a = individual.merge_upsert(addrs, individual.addresses(l2), ["id", "AddressId"], strategy=strategy)
        return p, a

    p, a = step(persons, addrs, (3, "no", "one", 456, "boston", 90578, "usa", 888, "san francisco", 99999,
                                 "usa", 1))
    assert (3, "no", "one", 1) in rows(p) and len(rows(a)) == 6
    p, a = step(persons, addrs, (2, "some", "body", 444, "seattle", 98008, "usa", None, None, None, None, 2))
    assert rows(p) == [(1, "abc", "bcd", 1), (2, "some", "body", 2)]
    p, a = step(persons, addrs, (2, "some", "one", 444, "seattle", 98008, "usa", None, None, None, None, 1))
    assert rows(p) == rows(persons)


def test_null_version_and_null_id_are_cleansed(spark):
    b = _people(spark, (None, "x", "y", 1, "c", 1, "u", None, None, None, None, 1),
                (5, "x", "y", 1, "c", 1, "u", None, None, None, None, None))
    assert individual.refine_people(b).count() == 0


# --- orders V3: FIXTURES 3 ------------------------------------------------------------

OB = "OrderId string, OrderAmount string, InsertDate string, Record_Version string, seq int"


def test_orders_v3_golden(spark):
    """Cleansing + next ids from the text MAX of amounts, merged into empty
    silver: ids 4, 5, 6 with 898.0, 908.0, 918.0; then (1, 999, V2) adds 999
    to order 1 and keeps version V1."""
    base = [("1", "100", "8/1/2021", "V1"), ("2", "20", "8/2/2021", "V1"), ("3", "30", "8/3/2021", "V1"),
            ("1", "888", "8/1/2021", "V1"), (None, "777", "8/1/2021", "V1"), ("2", "666", "8/1/2021", None),
            (None, "555", "8/1/2021", "V8"), ("3", "444", "8/1/2021", "   "), ("", "333", "8/1/2021", "V1")]
    recs = list(base)
    for _ in range(3):
        df = spark.createDataFrame([r + (i,) for i, r in enumerate(recs)], OB)
        nxt = df.agg((F.max(F.col("OrderId").try_cast("int")) + 1).alias("id"),
                     (F.max("OrderAmount").try_cast("double") + 10).alias("amt")).first()
        recs.append((str(nxt["id"]), str(nxt["amt"]), "8/3/2021", "V1"))
    bronze = spark.createDataFrame([r + (i,) for i, r in enumerate(recs)], OB)
    valid = cleanse.valid_keys(bronze, ["OrderId", "Record_Version"])
    # the reference keeps 100 over 888 (same key, version and date): first inserted wins here
    latest = cleanse.latest_version(valid, "OrderId", "Record_Version", ties="one",
                                    tie_break=[F.col("InsertDate").desc(), F.col("seq").asc()],
                                    method="row_number")
    silver_schema = "OrderId string, OrderAmount string, ShipmentStatus string, Record_Version string"
    empty = spark.createDataFrame([], silver_schema)
    on = [(F.expr("try_cast(target.OrderId AS INT)"), F.expr("try_cast(source.OrderId AS INT)"))]
    ins = insert(None, {"OrderId": "source.OrderId", "OrderAmount": "source.OrderAmount",
                        "ShipmentStatus": "''", "Record_Version": "source.Record_Version"})
    upd = update("source.Record_Version > target.Record_Version",
                 {"OrderAmount": F.expr("try_cast(target.OrderAmount AS DOUBLE) + "
                                        "try_cast(source.OrderAmount AS DOUBLE)").cast("string")})
    silver = merge(empty, latest, on, [upd], [ins])
    assert rows(silver, "OrderId", "OrderAmount", "Record_Version") == [
        ("1", "100", "V1"), ("2", "20", "V1"), ("3", "30", "V1"),
        ("4", "898.0", "V1"), ("5", "908.0", "V1"), ("6", "918.0", "V1")]
    silver = spark.createDataFrame(silver.collect(), silver_schema)
    later = spark.createDataFrame([("1", "999", "8/3/2021", "V2", 0)], OB)
    out = merge(silver, later, on, [upd], [ins])
    assert ("1", "1099.0", "V1") in rows(out, "OrderId", "OrderAmount", "Record_Version")


# --- cardinality, null keys -----------------------------------------------------------

def test_cardinality_rule(spark):
    t = spark.createDataFrame([(1, 10.0)], "k int, v double")
    s = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0), (2, 4.0)], "k int, v double")
    with pytest.raises(MergeCardinalityError):
        merge(t, s, ["k"], [update(None, {"v": "source.v"})], [insert()])
    assert rows(cardinality_conflicts(t, s, ["k"])) == [(1, 2)]
    # duplicates of a key absent from the target are fine in "merge" mode...
    ok = merge(t, s.filter("k = 2"), ["k"], [update()], [insert()])
    assert ok.count() == 3
    # ...but not in "strict" mode
    with pytest.raises(MergeCardinalityError):
        merge(t, s.filter("k = 2"), ["k"], [update()], [insert()], cardinality="strict")


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_key_never_matches_and_is_inserted(spark, strategy):
    t = spark.createDataFrame([(None, 1.0), (1, 2.0)], "k int, v double")
    s = spark.createDataFrame([(None, 5.0), (1, 7.0)], "k int, v double")
    out = merge(t, s, ["k"], [update(None, "*")], [insert(None, "*")], strategy=strategy)
    assert rows(out) == [(None, 1.0), (None, 5.0), (1, 7.0)]


# --- randomised: merge against a dict model ------------------------------------------------

def _model(target, source):
    out = dict(target)
    for k, (ver, typ, val) in source.items():
        if k in target:
            tver = target[k][0]
            if ver > tver and (typ == "delete" or val is None):
                del out[k]
            elif ver > tver and typ == "upsert":
                out[k] = (ver, typ, val)
        elif val is not None:
            out[k] = (ver, typ, val)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("strategy", STRATEGIES)
def test_merge_matches_model(spark, seed, strategy):
    rnd = random.Random(seed)
    keys = list(range(60))
    target = {k: (rnd.randint(0, 4), "upsert", rnd.choice([None, rnd.random()]))
              for k in rnd.sample(keys, 35)}
    target = {k: v for k, v in target.items() if v[2] is not None}
    source = {k: (rnd.randint(0, 5), rnd.choice(["upsert", "delete", None]), rnd.choice([None, rnd.random()]))
              for k in rnd.sample(keys, 40)}
    sch = "k int, ver int, typ string, val double"
    t = spark.createDataFrame([(k,) + v for k, v in target.items()], sch)
    s = spark.createDataFrame([(k,) + v for k, v in source.items()], sch)
    newer = "source.ver > target.ver"
    out = merge(t, s, ["k"],
                matched=[delete(f"{newer} AND (source.typ = 'delete' OR source.val IS NULL)"),
                         update(f"{newer} AND source.typ = 'upsert'", "*")],
                not_matched=[insert("source.val IS NOT NULL", "*")], strategy=strategy)
    want = sorted((k,) + v for k, v in _model(target, source).items())
    assert sorted(tuple(r) for r in out.collect()) == want


def test_auto_strategy_follows_the_measured_bound(spark):
    t = spark.range(0, 2000).selectExpr("CAST(id AS INT) AS k", "CAST(id AS DOUBLE) AS v")
    s = spark.range(1500, 2500).selectExpr("CAST(id AS INT) AS k", "CAST(-id AS DOUBLE) AS v")
    args = (t, s, ["k"], [update(None, "*")], [insert(None, "*")])
    small = merge(*args, strategy="auto")
    tiny_limit = merge(*args, strategy="auto", broadcast_max_bytes=100)
    forced = merge(*args, strategy="broadcast", broadcast_max_bytes=100)   # falls back, too
    for df in (small, tiny_limit, forced):
        df.write.format("noop").mode("overwrite").save()
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(small) and "FullOuter" not in plan(small)
    for df in (tiny_limit, forced):
        assert "FullOuter" not in plan(df) and "LeftOuter" in plan(df) and "LeftAnti" in plan(df)
    assert rows(small) == rows(tiny_limit) == rows(forced)
    assert len(rows(small)) == 2500


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_composite_key_with_a_null_part(spark, strategy):
    sch = "a int, b string, v int"
    t = spark.createDataFrame([(1, "x", 1), (1, None, 2), (2, "y", 3)], sch)
    s = spark.createDataFrame([(1, "x", 10), (1, None, 20), (3, "z", 30)], sch)
    out = merge(t, s, ["a", "b"], [update(None, "*")], [insert(None, "*")], strategy=strategy)
    assert rows(out) == [(1, None, 2), (1, None, 20), (1, "x", 10), (2, "y", 3), (3, "z", 30)]


def test_shuffle_merge_splits_a_hot_target_key(spark):
    """One key holds a third of the target; its partition of the join is split."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
                "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        t = spark.range(0, 90000).selectExpr("IF(id % 3 = 0, -1L, id) AS k", "id AS v", "sha2(CAST(id AS STRING), 256) AS text")
        s = spark.range(-1, 100000, 7).selectExpr("id AS k", "1000000 + id AS v", "'new' AS text")
        out = merge(t, s, ["k"], [update(None, "*")], [insert(None, "*")], cardinality="off", strategy="shuffle", materialize=False)
        got = out.groupBy("text").agg(F.count("*").alias("n")).filter("text = 'new'").first()["n"]
        keys = set(range(-1, 100000, 7))
        hit = sum(1 for i in range(90000) if (-1 if i % 3 == 0 else i) in keys)
        fresh = len(keys - {-1} - {i for i in range(90000) if i % 3})
        assert got == hit + fresh
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("form", [{"strategy": "outer"}, {"strategy": "shuffle", "target_unique": True}])
@pytest.mark.parametrize("seed", [4, 5])
def test_one_outer_join_equals_the_other_forms(spark, form, seed):
    """Unique target keys, null keys on both sides, duplicate source keys that the target lacks."""
    rnd = random.Random(seed)
    sch = "a int, b string, v int, w string"
    keys = [(a, b) for a in [None, *range(12)] for b in [None, "x", "y"]]
    target = [(*k, rnd.randrange(4), "t") for k in rnd.sample(keys, 20)] + [(None, "x", 1, "t")] * 3
    source = [(*k, rnd.randrange(6), "s") for k in rnd.sample(keys, 20)] + [(50, "x", 1, "s")] * 2
    args = (spark.createDataFrame(target, sch), spark.createDataFrame(source, sch), ["a", "b"],
            [delete("source.v = 5"), update("source.v > target.v", "*")], [insert("source.v <> 4", "*")])
    assert rows(merge(*args, **form)) == rows(merge(*args, strategy="broadcast"))


def test_a_unique_target_is_shuffled_once(spark, tmpdir_str):
    spark.range(0, 5000).selectExpr("id AS k", "id AS v").write.parquet(f"{tmpdir_str}/t")
    s = spark.range(4000, 9000).selectExpr("id AS k", "-id AS v")
    out = merge(spark.read.parquet(f"{tmpdir_str}/t"), s, ["k"], [update(None, "*")], [insert(None, "*")],
                cardinality="off", strategy="shuffle", target_unique=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 2
    assert out.count() == 9000
