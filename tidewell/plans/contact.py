"""Contact refinement (L3): party record -> party silver (M5) + contact points.

Silver 1 (party): id, name, Ph1, Ph2, Ph3, recordVersion.
Silver 2 (contact point): ContactPointId = id_slot, PartyId, Ph, recordVersion.

Per batch: keep one record per party (highest version, then latest arrival,
then highest sequence: the reference keeps duplicates of one version and
then breaks MERGE's cardinality rule, see SURVEY 7.4.7), then MERGE with
delete-before-update clause order:

* newer and (type 'delete' or payload all null) -> DELETE
* newer and type 'upsert'                       -> UPDATE
* not matched and payload not all null          -> INSERT (type ignored)

Deletes leave no tombstone, so a stale record arriving later is inserted
again (as the reference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.functions import all_null
from tidewell.operators import cleanse
from tidewell.operators.merge import delete, insert, merge, update
from tidewell.operators.normalize import unpivot_slots, unpivot_union, with_surrogate_key
from tidewell.plans import bronze as B
from tidewell.plans.registry import query
from tidewell.session import materialize, read_table

PHONE_SLOTS = {1: {"Ph": "Ph1"}, 2: {"Ph": "Ph2"}, 3: {"Ph": "Ph3"}}
PARTY_COLS = ["id", "name", "Ph1", "Ph2", "Ph3", "recordVersion"]
POINT_COLS = ["ContactPointId", "PartyId", "Ph", "recordVersion"]
PAYLOAD = ["name", "Ph1", "Ph2", "Ph3"]
PARTY_TYPE = "id bigint, name string, Ph1 bigint, Ph2 bigint, Ph3 bigint, recordVersion int"
POINT_TYPE = "ContactPointId string, PartyId bigint, Ph bigint, recordVersion int"


def latest_parties(bronze: DataFrame, batch_cols: list[str] = ()) -> DataFrame:
    return cleanse.latest_version(bronze, list(batch_cols) + ["id"], "recordVersion", ties="one",
                                  tie_break=["arrivalTime", "seq"], method="row_number")


def contact_points(parties: DataFrame, extra: list[str] = ()) -> DataFrame:
    """One row per phone slot, null phones kept (they delete)."""
    u = unpivot_slots(parties, ["id", "recordVersion", "recordType", *extra], PHONE_SLOTS, "slot")
    return (with_surrogate_key(u, "id", "slot", "ContactPointId")
            .select("ContactPointId", F.col("id").alias("PartyId"), "Ph", "recordVersion", "recordType",
                    *extra))


def party_clauses() -> tuple[list, list]:
    """(matched, not matched) of the party MERGE."""
    newer = F.expr("source.recordVersion > target.recordVersion")
    erase = all_null([f"source.{c}" for c in PAYLOAD])
    values = {c: f"source.{c}" for c in PARTY_COLS}
    return ([delete(newer & ((F.col("source.recordType") == "delete") | erase)),
             update(newer & (F.col("source.recordType") == "upsert"), values)], [insert(~erase, values)])


def point_clauses() -> tuple[list, list]:
    """(matched, not matched) of the contact point MERGE."""
    newer = "source.recordVersion > target.recordVersion"
    values = {c: f"source.{c}" for c in POINT_COLS}
    return ([delete(f"{newer} AND (source.recordType = 'delete' OR source.Ph IS NULL)"),
             update(f"{newer} AND source.recordType = 'upsert'", values)], [insert("source.Ph IS NOT NULL", values)])


def merge_parties(silver: DataFrame, batch: DataFrame, **kw) -> DataFrame:
    return merge(silver, batch, ["id"], *party_clauses(), target_unique=True, **kw)


def merge_points(silver: DataFrame, batch: DataFrame, **kw) -> DataFrame:
    return merge(silver, batch, ["PartyId", "ContactPointId"], *point_clauses(), target_unique=True, **kw)


def first_load_parties(latest: DataFrame) -> DataFrame:
    """MERGE into an empty table: only the insert clause can fire."""
    return latest.filter(~all_null(PAYLOAD)).select(*PARTY_COLS)


def first_load_points(points: DataFrame) -> DataFrame:
    return points.filter(F.col("Ph").isNotNull()).select(*POINT_COLS)


def _two_batches(spark, sf_dir):
    latest = materialize(latest_parties(B.contact_bronze(read_table(spark, sf_dir, "orders")),
                                        ["first_batch"]), "first_batch")
    return latest.filter("first_batch"), latest.filter("NOT first_batch")


def parties_after_two_batches(spark, sf_dir, strategy: str = "auto") -> DataFrame:
    first, second = _two_batches(spark, sf_dir)
    return merge_parties(first_load_parties(first), second, cardinality="off", strategy=strategy)


def points_after_two_batches(spark, sf_dir) -> DataFrame:
    first, second = _two_batches(spark, sf_dir)
    return merge_points(first_load_points(contact_points(first)), contact_points(second),
                        cardinality="off")


_LATEST_SQL = """
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY first_batch, id
           ORDER BY recordVersion DESC, arrivalTime DESC, seq DESC) AS r FROM contact_bronze) WHERE r = 1)"""

_ERASE = "(s.name IS NULL AND s.Ph1 IS NULL AND s.Ph2 IS NULL AND s.Ph3 IS NULL)"

PARTIES_SQL = B.with_sql(B.CONTACT_BRONZE_SQL, _LATEST_SQL) + f""",
t AS (SELECT id, name, Ph1, Ph2, Ph3, recordVersion FROM latest
      WHERE first_batch AND NOT (name IS NULL AND Ph1 IS NULL AND Ph2 IS NULL AND Ph3 IS NULL)),
s AS (SELECT * FROM latest WHERE NOT first_batch),
j AS (SELECT t.*, s.id AS s_id, s.name AS s_name, s.Ph1 AS s_Ph1, s.Ph2 AS s_Ph2, s.Ph3 AS s_Ph3,
             s.recordVersion AS s_ver,
             CASE WHEN s.recordVersion > t.recordVersion AND (s.recordType = 'delete' OR {_ERASE}) THEN 'd'
                  WHEN s.recordVersion > t.recordVersion AND s.recordType = 'upsert' THEN 'u'
                  ELSE 'k' END AS act
      FROM t LEFT JOIN s ON s.id = t.id)
SELECT CASE WHEN act = 'u' THEN s_id ELSE id END AS id,
       CASE WHEN act = 'u' THEN s_name ELSE name END AS name,
       CASE WHEN act = 'u' THEN s_Ph1 ELSE Ph1 END AS Ph1,
       CASE WHEN act = 'u' THEN s_Ph2 ELSE Ph2 END AS Ph2,
       CASE WHEN act = 'u' THEN s_Ph3 ELSE Ph3 END AS Ph3,
       CASE WHEN act = 'u' THEN s_ver ELSE recordVersion END AS recordVersion
FROM j WHERE act <> 'd'
UNION ALL
SELECT s.id, s.name, s.Ph1, s.Ph2, s.Ph3, s.recordVersion FROM s
WHERE NOT {_ERASE} AND NOT EXISTS (SELECT 1 FROM t WHERE t.id = s.id)"""

_POINTS_SQL = """
points AS (
  SELECT CAST(id AS VARCHAR) || '_1' AS ContactPointId, id AS PartyId, Ph1 AS Ph, recordVersion, recordType, first_batch FROM latest
  UNION ALL
  SELECT CAST(id AS VARCHAR) || '_2', id, Ph2, recordVersion, recordType, first_batch FROM latest
  UNION ALL
  SELECT CAST(id AS VARCHAR) || '_3', id, Ph3, recordVersion, recordType, first_batch FROM latest)"""

POINTS_SQL = B.with_sql(B.CONTACT_BRONZE_SQL, _LATEST_SQL, _POINTS_SQL) + """,
t AS (SELECT ContactPointId, PartyId, Ph, recordVersion FROM points WHERE first_batch AND Ph IS NOT NULL),
s AS (SELECT * FROM points WHERE NOT first_batch),
j AS (SELECT t.*, s.Ph AS s_Ph, s.recordVersion AS s_ver,
             CASE WHEN s.recordVersion > t.recordVersion AND (s.recordType = 'delete' OR s.Ph IS NULL) THEN 'd'
                  WHEN s.recordVersion > t.recordVersion AND s.recordType = 'upsert' THEN 'u'
                  ELSE 'k' END AS act
      FROM t LEFT JOIN s ON s.PartyId = t.PartyId AND s.ContactPointId = t.ContactPointId)
SELECT ContactPointId, PartyId,
       CASE WHEN act = 'u' THEN s_Ph ELSE Ph END AS Ph,
       CASE WHEN act = 'u' THEN s_ver ELSE recordVersion END AS recordVersion
FROM j WHERE act <> 'd'
UNION ALL
SELECT s.ContactPointId, s.PartyId, s.Ph, s.recordVersion FROM s
WHERE s.Ph IS NOT NULL AND NOT EXISTS (SELECT 1 FROM t WHERE t.PartyId = s.PartyId
                                       AND t.ContactPointId = s.ContactPointId)"""


@query("merge_upsert_delete", PARTIES_SQL)
def merge_upsert_delete(spark, sf_dir):
    """M5 on the party table across two batches."""
    return parties_after_two_batches(spark, sf_dir)


def parties_bucketed(spark, sf_dir) -> "BucketedTable":
    """The party table bucketed on its key, after two batches."""
    import uuid

    from tidewell.operators.merge import measured_size_bound
    from tidewell.session import ddl_schema, fresh_dir
    from tidewell.sources.bucketed import BucketedTable
    from tidewell.sources.tables import buckets_for
    first, second = _two_batches(spark, sf_dir)
    load = first_load_parties(first)
    table = BucketedTable(spark, f"tw_parties_{uuid.uuid4().hex[:12]}", fresh_dir(spark, "parties-bucketed"),
                          ddl_schema(spark, PARTY_TYPE), ["id"], buckets_for(measured_size_bound(load)[1]))
    table.load(load)
    table.merge(second, *party_clauses(), cardinality="off")
    return table


@query("merge_upsert_delete_colocated", PARTIES_SQL)
def merge_upsert_delete_colocated(spark, sf_dir):
    """M5 with the target kept in buckets: only the batch is shuffled."""
    return parties_bucketed(spark, sf_dir).read()


@query("contact_refine", POINTS_SQL)
def contact_refine(spark, sf_dir):
    """L3: contact points after two batches (N3 + M5)."""
    return points_after_two_batches(spark, sf_dir)


_UNPIVOT_SQL = B.with_sql(B.CONTACT_BRONZE_SQL) + """
SELECT seq, id, recordVersion, recordType, 1 AS slot, Ph1 AS Ph FROM contact_bronze
UNION ALL SELECT seq, id, recordVersion, recordType, 2, Ph2 FROM contact_bronze
UNION ALL SELECT seq, id, recordVersion, recordType, 3, Ph3 FROM contact_bronze"""


@query("unpivot_union", _UNPIVOT_SQL)
def unpivot_union_q(spark, sf_dir):
    """U1 as the reference writes it: three SELECTs, UNION ALL (three scans)."""
    b = B.contact_bronze(read_table(spark, sf_dir, "orders"))
    return unpivot_union(b, ["seq", "id", "recordVersion", "recordType"], PHONE_SLOTS, "slot")


@query("normalize_phones", _UNPIVOT_SQL)
def normalize_phones(spark, sf_dir):
    """U1/N3 in one pass: inline(array(struct per slot)), nulls kept."""
    b = B.contact_bronze(read_table(spark, sf_dir, "orders"))
    return unpivot_slots(b, ["seq", "id", "recordVersion", "recordType"], PHONE_SLOTS, "slot")


def refine_batch(parties: "SnapshotTable", points: "SnapshotTable", batch: DataFrame, job: str,
                 batch_id: int) -> None:
    """One micro-batch of L3: one record per party (stored once), then both
    silver tables, each published once per (job, batch_id) and rewriting only
    the buckets the batch's parties fall into."""
    from tidewell.operators.merge import measured_size_bound
    if parties.published(job, batch_id) and points.published(job, batch_id):
        return
    src = materialize(latest_parties(batch))
    # one measurement bounds both sources (a projection; three slots per row)
    _, nbytes = measured_size_bound(src)
    parties.merge_touched(src.select(*PARTY_COLS, "recordType"), ["id"], *party_clauses(),
                          job, batch_id, cardinality="off", source_bytes=nbytes)
    points.merge_touched(contact_points(src), ["PartyId", "ContactPointId"], *point_clauses(),
                         job, batch_id, cardinality="off", source_bytes=3 * nbytes)
