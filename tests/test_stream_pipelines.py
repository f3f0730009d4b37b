"""The person/address (L2) and contact (L3) handlers inside a real
Structured Streaming query: the reference's scenarios (FIXTURES 4, 5) arrive
as files, one micro-batch each, into bucketed snapshot tables."""

import datetime as dt

from conftest import rows
from tidewell.plans import contact, individual
from tidewell.session import ddl_schema
from tidewell.sources.tables import SnapshotTable
from tidewell.streaming.refine import query_id, refine_stream

T0 = dt.datetime(2021, 8, 1)
# The scenario rows in the tests below are the reference's
# (FIXTURES.md sections 4 and 5), in their natural order.

CONTACT_IN = ("id int, name string, Ph1 int, Ph2 int, Ph3 int, recordVersion int, recordType string, "
              "arrivalTime timestamp, seq int")
PERSON_IN = ("id int, firstName string, lastName string, streetNo1 int, cityName1 string, zipcode1 int, "
             "country1 string, streetNo2 int, cityName2 string, zipcode2 int, country2 string, "
             "recordVersion int, arrivalTime timestamp, seq int")


def _stream(spark, tmp_path, schema, arrivals, handle_tables, tables):
    landing, ckpt = str(tmp_path / "landing"), str(tmp_path / "ckpt")
    states = []

    def handle(df, batch_id):
        handle_tables(*tables, df, query_id(df.sparkSession, ckpt), batch_id)

    for recs in arrivals:
        spark.createDataFrame([r + (T0, i) for i, r in enumerate(recs)], schema) \
            .write.mode("append").parquet(landing)
        refine_stream(spark, landing, schema, handle, ckpt)
        states.append(tuple(rows(t.read()) for t in tables))
    return states


def test_contact_scenarios_as_a_stream(spark, tmp_path):
    parties = SnapshotTable(spark, str(tmp_path / "p"), ddl_schema(spark, contact.PARTY_TYPE),
                            bucket_key="id", buckets=16)
    points = SnapshotTable(spark, str(tmp_path / "c"), ddl_schema(spark, contact.POINT_TYPE),
                           bucket_key="PartyId", buckets=16)
    arrivals = [[(1, "Some", 2222, None, 3333, 1, "upsert"), (9, "Other", 1, 2, 3, 1, "upsert")],
                [(1, "Some", 2222, 4444, 3333, 2, "upsert")],
                [(1, "Some", None, 5555, 3333, 3, "upsert")],
                [(1, None, None, None, None, 4, "delete")],
                [(1, "Some", 2222, None, 3333, 2, "upsert")]]
    s = _stream(spark, tmp_path, CONTACT_IN, arrivals, contact.refine_batch, (parties, points))
    other = [(9, "Other", 1, 2, 3, 1)]
    assert s[0] == (sorted([(1, "Some", 2222, None, 3333, 1)] + other),
                    [("1_1", 1, 2222, 1), ("1_3", 1, 3333, 1), ("9_1", 9, 1, 1), ("9_2", 9, 2, 1),
                     ("9_3", 9, 3, 1)])
    assert s[1][0] == sorted([(1, "Some", 2222, 4444, 3333, 2)] + other)
    assert [r for r in s[1][1] if r[1] == 1] == [("1_1", 1, 2222, 2), ("1_2", 1, 4444, 2), ("1_3", 1, 3333, 2)]
    assert [r for r in s[2][1] if r[1] == 1] == [("1_2", 1, 5555, 3), ("1_3", 1, 3333, 3)]
    assert s[3][0] == other and [r for r in s[3][1] if r[1] == 1] == []
    assert s[4][0] == sorted([(1, "Some", 2222, None, 3333, 2)] + other)
    assert [r for r in s[4][1] if r[1] == 1] == [("1_1", 1, 2222, 2), ("1_3", 1, 3333, 2)]
    # untouched party 9 was never rewritten after the first batch
    assert all(r in s[4][1] for r in [("9_1", 9, 1, 1), ("9_2", 9, 2, 1), ("9_3", 9, 3, 1)])


def test_person_address_scenarios_as_a_stream(spark, tmp_path):
    persons = SnapshotTable(spark, str(tmp_path / "p"), ddl_schema(spark, "id int, firstName string, "
                            "lastName string, recordVersion int"), bucket_key="id", buckets=16)
    addrs = SnapshotTable(spark, str(tmp_path / "a"), ddl_schema(spark, "id int, AddressId int, streetNo int, "
                          "cityName string, zipcode int, country string, recordVersion int"),
                          bucket_key="id", buckets=16)
    start = [(1, "abc", "bcd", 123, "redmond", 98022, "usa", 343, "bellevue", 98077, "usa", 1),
             (2, "some", "one", 444, "seattle", 98008, "usa", None, None, None, None, 1)]
    insert = [(3, "no", "one", 456, "boston", 90578, "usa", 888, "san francisco", 99999, "usa", 1)]
    upd = [(2, "some", "body", 444, "seattle", 98008, "usa", None, None, None, None, 2)]
    same = [(2, "some", "one", 444, "seattle", 98008, "usa", None, None, None, None, 1)]
    s = _stream(spark, tmp_path, PERSON_IN, [start, insert, upd, same], individual.refine_batch,
                (persons, addrs))
    assert s[0][0] == [(1, "abc", "bcd", 1), (2, "some", "one", 1)]
    assert (2, 2, None, None, None, None, 1) in s[0][1] and len(s[0][1]) == 4
    assert (3, "no", "one", 1) in s[1][0] and len(s[1][1]) == 6
    assert s[2][0] == [(1, "abc", "bcd", 1), (2, "some", "body", 2), (3, "no", "one", 1)]
    assert s[3] == s[2]


def test_handler_dying_between_tables_replays_safely(spark, tmp_path):
    """The person table is published, then the address publish fails; the
    replay of the same batch skips persons and finishes addresses, giving the
    same state as an uninterrupted run."""
    import pytest

    def tables(tag):
        p = SnapshotTable(spark, str(tmp_path / f"{tag}p"), ddl_schema(spark, "id int, firstName string, "
                          "lastName string, recordVersion int"), bucket_key="id", buckets=16)
        a = SnapshotTable(spark, str(tmp_path / f"{tag}a"), ddl_schema(spark, "id int, AddressId int, "
                          "streetNo int, cityName string, zipcode int, country string, recordVersion int"),
                          bucket_key="id", buckets=16)
        return p, a

    recs = [(1, "abc", "bcd", 123, "redmond", 98022, "usa", 343, "bellevue", 98077, "usa", 1),
            (2, "some", "one", 444, "seattle", 98008, "usa", None, None, None, None, 1)]
    batch = spark.createDataFrame([r + (T0, i) for i, r in enumerate(recs)], PERSON_IN)
    clean_p, clean_a = tables("clean")
    individual.refine_batch(clean_p, clean_a, batch, "job", 0)

    p, a = tables("crash")
    real = a.merge_touched
    calls = []

    def failing_once(*args, **kw):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("executor lost")
        return real(*args, **kw)

    a.merge_touched = failing_once
    with pytest.raises(RuntimeError):
        individual.refine_batch(p, a, batch, "job", 0)
    assert p.published("job", 0) and not a.published("job", 0)
    individual.refine_batch(p, a, batch, "job", 0)          # the replay
    assert len(p.versions()) == 1 and len(a.versions()) == 1
    assert rows(p.read()) == rows(clean_p.read()) and rows(a.read()) == rows(clean_a.read())


def test_stream_forms_equal_the_oracle_checked_batch_queries(spark):
    """The L2/L3 handlers run in a real stream give exactly what the batch
    queries give (and those match their DuckDB oracles)."""
    import __spark_entry__ as E
    from tidewell.plans.streams import contact_stream, individual_stream
    sf = "/root/testdata/sf0.001"
    q = E.queries()
    assert rows(individual_stream(spark, sf)) == rows(q["individual_refine"](spark, sf))
    assert rows(contact_stream(spark, sf)) == rows(q["contact_refine"](spark, sf))
