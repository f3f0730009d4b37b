"""Person + address refinement (L2): cleanse, dedupe, latest, N1 + N2 with M4.

Silver person: id, firstName, lastName, recordVersion.
Silver address: id, AddressId (1 or 2), streetNo, cityName, zipcode,
country, recordVersion.  An all-null address slot is inserted like any
other (the reference has no guard here, unlike the contact pipeline).

Both slots go into one MERGE: their keys (id, AddressId) are disjoint, so
this equals the reference's two MERGEs in a row, with one join instead of
two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell.operators import cleanse
from tidewell.operators.merge import insert, merge, update
from tidewell.operators.normalize import unpivot_slots
from tidewell.plans import bronze as B
from tidewell.plans.registry import query
from tidewell.session import materialize, read_table

PERSON_COLS = ["id", "firstName", "lastName", "recordVersion"]
ADDRESS_COLS = ["id", "AddressId", "streetNo", "cityName", "zipcode", "country", "recordVersion"]
ADDRESS_SLOTS = {
    1: {"streetNo": "streetNo1", "cityName": "cityName1", "zipcode": "zipcode1", "country": "country1"},
    2: {"streetNo": "streetNo2", "cityName": "cityName2", "zipcode": "zipcode2", "country": "country2"},
}
NEWER = "source.recordVersion IS NOT NULL AND source.recordVersion > target.recordVersion"


def refine_people(bronze: DataFrame, batch_cols: list[str] = ()) -> DataFrame:
    """Drop null id / null version (the code's rule, not the comment's),
    then one row per id: highest version, latest arrival, highest sequence."""
    valid = cleanse.not_null(bronze, ["id", "recordVersion"])
    return cleanse.latest_version(valid, list(batch_cols) + ["id"], "recordVersion", ties="one",
                                  tie_break=["arrivalTime", "seq"], method="row_number")


def addresses(people: DataFrame, extra: list[str] = ()) -> DataFrame:
    u = unpivot_slots(people, ["id", "recordVersion", *extra], ADDRESS_SLOTS, "AddressId")
    return u.select(*ADDRESS_COLS, *extra)


def merge_upsert(silver: DataFrame, batch: DataFrame, keys: list[str], **kw) -> DataFrame:
    """M4: newer non-null version -> UPDATE SET *; unknown key -> INSERT *."""
    return merge(silver, batch, keys, matched=[update(NEWER, "*")],
                 not_matched=[insert(None, "*")], target_unique=True, **kw)


def _two_batches(spark, sf_dir):
    b = B.person_bronze(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                        read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "supplier"))
    latest = materialize(refine_people(b, ["first_batch"]), "first_batch")
    return latest.filter("first_batch"), latest.filter("NOT first_batch")


def persons_after_two_batches(spark, sf_dir) -> DataFrame:
    first, second = _two_batches(spark, sf_dir)
    return merge_upsert(first.select(*PERSON_COLS), second.select(*PERSON_COLS), ["id"],
                        cardinality="off")


def addresses_after_two_batches(spark, sf_dir) -> DataFrame:
    first, second = _two_batches(spark, sf_dir)
    return merge_upsert(addresses(first), addresses(second), ["id", "AddressId"], cardinality="off")


_LATEST_SQL = """
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY first_batch, id
           ORDER BY recordVersion DESC, arrivalTime DESC, seq DESC) AS r
           FROM person_bronze WHERE id IS NOT NULL AND recordVersion IS NOT NULL) WHERE r = 1)"""

PERSON_SQL = B.with_sql(B.PERSON_BRONZE_SQL, _LATEST_SQL) + """,
t AS (SELECT id, firstName, lastName, recordVersion FROM latest WHERE first_batch),
s AS (SELECT id, firstName, lastName, recordVersion FROM latest WHERE NOT first_batch),
j AS (SELECT t.*, s.firstName AS s_first, s.lastName AS s_last, s.recordVersion AS s_ver,
             coalesce(s.recordVersion IS NOT NULL AND s.recordVersion > t.recordVersion, false) AS upd
      FROM t LEFT JOIN s ON s.id = t.id)
SELECT id, CASE WHEN upd THEN s_first ELSE firstName END AS firstName,
       CASE WHEN upd THEN s_last ELSE lastName END AS lastName,
       CASE WHEN upd THEN s_ver ELSE recordVersion END AS recordVersion
FROM j
UNION ALL
SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id)"""

_ADDR_SQL = """
addr AS (
  SELECT id, 1 AS AddressId, streetNo1 AS streetNo, cityName1 AS cityName, zipcode1 AS zipcode,
         country1 AS country, recordVersion, first_batch FROM latest
  UNION ALL
  SELECT id, 2, streetNo2, cityName2, zipcode2, country2, recordVersion, first_batch FROM latest)"""

ADDRESS_SQL = B.with_sql(B.PERSON_BRONZE_SQL, _LATEST_SQL, _ADDR_SQL) + """,
t AS (SELECT * EXCLUDE (first_batch) FROM addr WHERE first_batch),
s AS (SELECT * EXCLUDE (first_batch) FROM addr WHERE NOT first_batch),
j AS (SELECT t.*, s.streetNo AS s_street, s.cityName AS s_city, s.zipcode AS s_zip, s.country AS s_country,
             s.recordVersion AS s_ver,
             coalesce(s.recordVersion IS NOT NULL AND s.recordVersion > t.recordVersion, false) AS upd
      FROM t LEFT JOIN s ON s.id = t.id AND s.AddressId = t.AddressId)
SELECT id, AddressId, CASE WHEN upd THEN s_street ELSE streetNo END AS streetNo,
       CASE WHEN upd THEN s_city ELSE cityName END AS cityName,
       CASE WHEN upd THEN s_zip ELSE zipcode END AS zipcode,
       CASE WHEN upd THEN s_country ELSE country END AS country,
       CASE WHEN upd THEN s_ver ELSE recordVersion END AS recordVersion
FROM j
UNION ALL
SELECT s.* FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id AND t.AddressId = s.AddressId)"""


@query("normalize_person", PERSON_SQL)
def normalize_person(spark, sf_dir):
    """Person slice, two batches, M4."""
    return persons_after_two_batches(spark, sf_dir)


@query("normalize_addresses", ADDRESS_SQL)
def normalize_addresses(spark, sf_dir):
    """Two address slots -> rows keyed (id, AddressId), two batches, M4."""
    return addresses_after_two_batches(spark, sf_dir)


@query("cleanse_not_null", B.with_sql(B.PERSON_BRONZE_SQL) + """
SELECT seq, id, recordVersion, arrivalTime, firstName FROM person_bronze
WHERE id IS NOT NULL AND recordVersion IS NOT NULL""")
def cleanse_not_null(spark, sf_dir):
    """Non-string keys: not null only."""
    b = B.person_bronze(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                        read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "supplier"))
    return cleanse.not_null(b, ["id", "recordVersion"]).select("seq", "id", "recordVersion",
                                                               "arrivalTime", "firstName")


@query("surrogate_key", B.with_sql(B.PERSON_BRONZE_SQL) + """
SELECT seq, CAST(id AS VARCHAR) || '_' || '1' AS address_key_1,
       CAST(zipcode2 AS VARCHAR) || '_' || '2' AS zip_key_2 FROM person_bronze""")
def surrogate_key(spark, sf_dir):
    """concat(int, '_', n); a null operand gives a null key."""
    from tidewell.functions import surrogate_key as sk
    b = B.person_bronze(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                        read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "supplier"))
    return b.select("seq", sk("id", 1).alias("address_key_1"), sk("zipcode2", 2).alias("zip_key_2"))


#: The mapping table of L2: silver table, slot, silver column, bronze column, rule, key.
PERSON_MAPPING = [
    ("person", None, "id", "id", "column", True),
    ("person", None, "firstName", "firstName", "column", False),
    ("person", None, "lastName", "lastName", "column", False),
    ("person", None, "recordVersion", "recordVersion", "column", False),
    ("address", None, "id", "id", "column", True),
    ("address", None, "AddressId", None, "slot", True),
    ("address", None, "recordVersion", "recordVersion", "column", False),
    *(("address", slot, column, f"{column}{slot}", "column", False)
      for slot in (1, 2) for column in ("streetNo", "cityName", "zipcode", "country")),
]


def refine_by_mapping(tables: dict, mapping: dict, batch: DataFrame, job: str, batch_id: int) -> None:
    """One micro-batch: refined once (stored), then each silver table that the
    compiled ``mapping`` names gets its rows, published once per (job, batch_id)."""
    from tidewell.operators.merge import measured_size_bound
    if all(tables[name].published(job, batch_id) for name in mapping):
        return
    src = materialize(refine_people(batch))
    _, nbytes = measured_size_bound(src)
    for name, silver in mapping.items():
        # a silver row has columns of one bronze row, and there is one for each slot
        tables[name].merge_touched(silver.project(src), silver.keys, [update(NEWER, "*")], [insert(None, "*")],
                                   job, batch_id, cardinality="off", source_bytes=len(silver.slots) * nbytes)


def refine_batch(persons: "SnapshotTable", addrs: "SnapshotTable", batch: DataFrame, job: str,
                 batch_id: int) -> None:
    """One micro-batch of L2: refine once (stored), then publish both silver
    tables under (job, batch_id); a replay skips what is done."""
    from tidewell.operators.merge import measured_size_bound
    if persons.published(job, batch_id) and addrs.published(job, batch_id):
        return
    src = materialize(refine_people(batch))
    # one measurement of the batch bounds both sources: the person slice
    # is a projection of it, the address rows two projections per row
    _, nbytes = measured_size_bound(src)
    persons.merge_touched(src.select(*PERSON_COLS), ["id"], [update(NEWER, "*")],
                          [insert(None, "*")], job, batch_id, cardinality="off", source_bytes=nbytes)
    addrs.merge_touched(addresses(src), ["id", "AddressId"], [update(NEWER, "*")],
                        [insert(None, "*")], job, batch_id, cardinality="off", source_bytes=2 * nbytes)


# Keys are declared NOT NULL, as in the reference's silver DDL; the snapshot
# table enforces it while writing.
PERSON_TYPE = "id bigint NOT NULL, firstName string, lastName string, recordVersion int"
ADDRESS_TYPE = ("id bigint NOT NULL, AddressId int NOT NULL, streetNo int, cityName string, zipcode int, "
                "country string, recordVersion int")


INDIVIDUAL_SQL = ("WITH p AS (" + PERSON_SQL + "),\na AS (" + ADDRESS_SQL + """)
SELECT a.id, a.AddressId, p.firstName, p.lastName, a.cityName, a.country,
       p.recordVersion AS person_version, a.recordVersion AS address_version
FROM a LEFT JOIN p ON a.id = p.id""")


@query("individual_refine", INDIVIDUAL_SQL)
def individual_refine(spark, sf_dir):
    """L2 end to end: two batches through the batch handler into two
    snapshot tables bucketed by id (each batch rewrites only the buckets
    its ids fall into), read back and joined for the consumer."""
    from tidewell.session import ddl_schema, fresh_dir
    from tidewell.sources.tables import SnapshotTable
    b = B.person_bronze(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                        read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "supplier"))
    from tidewell.operators.merge import estimated_bytes
    from tidewell.sources.tables import buckets_for
    n = buckets_for(estimated_bytes(read_table(spark, sf_dir, "orders")))
    persons = SnapshotTable(spark, fresh_dir(spark, "person"), ddl_schema(spark, PERSON_TYPE),
                            bucket_key="id", buckets=n)
    addrs = SnapshotTable(spark, fresh_dir(spark, "address"), ddl_schema(spark, ADDRESS_TYPE),
                          bucket_key="id", buckets=n)
    for i, part in enumerate([b.filter("first_batch"), b.filter("NOT first_batch")]):
        refine_batch(persons, addrs, part.drop("first_batch"), "individual", i)
    p, a = persons.read(), addrs.read()
    return (a.join(p, "id", "left")
             .select("id", "AddressId", "firstName", "lastName", "cityName", "country",
                     p["recordVersion"].alias("person_version"),
                     a["recordVersion"].alias("address_version")))


@query("individual_consistent", INDIVIDUAL_SQL)
def individual_consistent(spark, sf_dir):
    """L2 with both silver tables committed together per batch, read as of one
    commit."""
    from tidewell.operators.merge import estimated_bytes
    from tidewell.session import ddl_schema, fresh_dir
    from tidewell.sources.group import TableGroup
    from tidewell.sources.tables import SnapshotTable, buckets_for
    b = B.person_bronze(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                        read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "supplier"))
    n = buckets_for(estimated_bytes(read_table(spark, sf_dir, "orders")))
    root = fresh_dir(spark, "person-group")
    group = TableGroup(f"{root}/commits", {
        "person": SnapshotTable(spark, f"{root}/person", ddl_schema(spark, PERSON_TYPE), bucket_key="id", buckets=n),
        "address": SnapshotTable(spark, f"{root}/address", ddl_schema(spark, ADDRESS_TYPE), bucket_key="id", buckets=n)})
    for i, part in enumerate([b.filter("first_batch"), b.filter("NOT first_batch")]):
        group.publish("individual", i, lambda t, rows=part.drop("first_batch"), i=i: refine_batch(
            t["person"], t["address"], rows, "individual", i))
    now = group.read()
    p, a = now["person"], now["address"]
    return (a.join(p, "id", "left")
             .select("id", "AddressId", "firstName", "lastName", "cityName", "country",
                     p["recordVersion"].alias("person_version"),
                     a["recordVersion"].alias("address_version")))


@query("individual_by_mapping", INDIVIDUAL_SQL)
def individual_by_mapping(spark, sf_dir):
    """L2 driven by N4's mapping table: stored as a table, read back, checked
    against the bronze and silver schemas and compiled; no column is named in code."""
    from tidewell.operators.mapping import MAPPING_TYPE, compile_mapping
    from tidewell.operators.merge import estimated_bytes
    from tidewell.session import ddl_schema, fresh_dir
    from tidewell.sources.tables import SnapshotTable, buckets_for
    stored = materialize(spark.createDataFrame(PERSON_MAPPING, MAPPING_TYPE), label="person-mapping")
    b = B.person_bronze(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                        read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "supplier"))
    silver = {"person": ddl_schema(spark, PERSON_TYPE), "address": ddl_schema(spark, ADDRESS_TYPE)}
    mapping = compile_mapping(stored, b.schema, silver)
    n = buckets_for(estimated_bytes(read_table(spark, sf_dir, "orders")))
    tables = {name: SnapshotTable(spark, fresh_dir(spark, name), silver[name], bucket_key=t.keys[0], buckets=n)
              for name, t in mapping.items()}
    for i, part in enumerate([b.filter("first_batch"), b.filter("NOT first_batch")]):
        refine_by_mapping(tables, mapping, part.drop("first_batch"), "mapped", i)
    p, a = tables["person"].read(), tables["address"].read()
    return (a.join(p, "id", "left")
             .select("id", "AddressId", "firstName", "lastName", "cityName", "country",
                     p["recordVersion"].alias("person_version"),
                     a["recordVersion"].alias("address_version")))
