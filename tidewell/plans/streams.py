"""Streaming refinement over arrivals of the orders bronze.

Arrivals are slices of the events-derived bronze by time, appended as new
Parquet files to a landing folder; after each arrival the stream runs with
``availableNow`` and the same checkpoint, so each arrival is exactly one
micro-batch, in order.  The oracles fold the batches in that order: inside a
batch the latest arrival wins, across batches only a strictly newer version
replaces (an equal version from a later batch is ignored).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.merge import insert, merge, update
from tidewell.plans import bronze as B
from tidewell.plans.orders import MERGE_ACCUMULATE_SQL, ORDERS_SWAPPED_SQL, order_key, refine_orders
from tidewell.plans.registry import query
from tidewell.session import ddl_schema, fresh_dir, materialize, read_table
from tidewell.sources import sinks
from tidewell.sources.tables import SnapshotTable, buckets_for
from tidewell.streaming.refine import query_id, refine_stream

BRONZE_SCHEMA = ("order_id string, record_version int, amount double, arrival timestamp_ntz, "
                 "record_type string, event_id bigint")
UPSERT_SCHEMA = "order_id string, record_version int, amount double, arrival timestamp_ntz"
ACCUMULATE_SCHEMA = "order_id string, amount double, ship_status string"
VERSIONED_SCHEMA = "order_id string, record_version int, amount double, ship_status string"


def _bronze(spark, sf_dir) -> DataFrame:
    return B.orders_bronze(read_table(spark, sf_dir, "events")).drop("first_batch")


def run_arrivals(spark, arrivals: list[DataFrame], silver: SnapshotTable, apply, label: str) -> DataFrame:
    """Land each arrival, run the stream once per arrival (same checkpoint);
    each micro-batch: refine once (stored), then ``apply(silver, batch,
    job, batch_id)`` publishes the MERGE under (job, batch_id)."""
    landing = fresh_dir(spark, f"{label}-landing")
    checkpoint = fresh_dir(spark, f"{label}-checkpoint")

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        job = query_id(batch_df.sparkSession, checkpoint)
        if silver.published(job, batch_id):
            return
        apply(silver, materialize(refine_orders(batch_df)), job, batch_id)

    for arrival in arrivals:
        arrival.write.mode("append").parquet(landing)
        refine_stream(spark, landing, BRONZE_SCHEMA, handle, checkpoint, trigger="available_now")
    return silver.read()


UPSERT_COLS = ["order_id", "record_version", "amount", "arrival"]
UPSERT_MATCHED = [update("source.record_version IS NOT NULL AND "
                         "source.record_version > target.record_version", "*")]
ACC_MATCHED = [update(None, {"amount": "target.amount + source.amount"})]
ACC_INSERT = [insert(None, {"order_id": "source.order_id", "amount": "source.amount", "ship_status": "''"})]


def upsert(t: DataFrame, s: DataFrame) -> DataFrame:
    """M4 on the orders silver: a strictly newer version overwrites the row."""
    return merge(t, s.select(*UPSERT_COLS), ["order_id"], matched=UPSERT_MATCHED,
                 not_matched=[insert(None, "*")], cardinality="off")


def accumulate(t: DataFrame, s: DataFrame) -> DataFrame:
    """M1: matched orders add the batch amount (not idempotent by itself)."""
    return merge(t, s, ["order_id"], matched=ACC_MATCHED, not_matched=ACC_INSERT, cardinality="off")


def versioned_accumulate_touched(silver: SnapshotTable, src: DataFrame, job: str, batch_id: int) -> None:
    """M3 by buckets of the order number.  The batch is unique by id text, so
    '7' and '007' may both be in it: the cardinality rule is checked."""
    from tidewell.plans.orders import VERSIONED_INSERT, VERSIONED_MATCHED, number_key
    silver.merge_touched(src, number_key(), VERSIONED_MATCHED(), VERSIONED_INSERT, job, batch_id)


def upsert_touched(silver: SnapshotTable, src: DataFrame, job: str, batch_id: int) -> None:
    """M4, rewriting only the order buckets the batch touches."""
    silver.merge_touched(src.select(*UPSERT_COLS), ["order_id"], UPSERT_MATCHED,
                         [insert(None, "*")], job, batch_id, cardinality="off")


def accumulate_touched(silver: SnapshotTable, src: DataFrame, job: str, batch_id: int) -> None:
    silver.merge_touched(src.select("order_id", "amount"), ["order_id"], ACC_MATCHED, ACC_INSERT,
                         job, batch_id, cardinality="off")


CUT1, CUT2 = "2024-01-11 00:00:00", "2024-01-21 00:00:00"
def silver_buckets(spark, sf_dir) -> int:
    """Bucket count of a new silver table, from the size of the table its
    bronze comes from (a scan estimate: file sizes, no job); merges rewrite
    only the buckets a batch touches."""
    from tidewell.operators.merge import estimated_bytes
    return buckets_for(estimated_bytes(read_table(spark, sf_dir, "events")))


def _fold(prev: str, nxt: str) -> str:
    return f"""
SELECT CASE WHEN l.record_version > s.record_version THEN l.order_id ELSE s.order_id END AS order_id,
       CASE WHEN l.record_version > s.record_version THEN l.record_version ELSE s.record_version END AS record_version,
       CASE WHEN l.record_version > s.record_version THEN l.amount ELSE s.amount END AS amount,
       CASE WHEN l.record_version > s.record_version THEN l.arrival ELSE s.arrival END AS arrival
FROM {prev} s LEFT JOIN {nxt} l ON s.order_id = l.order_id
UNION ALL
SELECT l.order_id, l.record_version, l.amount, l.arrival FROM {nxt} l
WHERE NOT EXISTS (SELECT 1 FROM {prev} s WHERE s.order_id = l.order_id)"""


STREAM_UPSERT_SQL = B.with_sql(B.ORDERS_BRONZE_SQL) + f""",
valid AS (SELECT *, CASE WHEN arrival < TIMESTAMP '{CUT1}' THEN 1
                         WHEN arrival < TIMESTAMP '{CUT2}' THEN 2 ELSE 3 END AS b
          FROM orders_bronze
          WHERE order_id IS NOT NULL AND trim(order_id) <> '' AND record_version IS NOT NULL),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY b, order_id
           ORDER BY record_version DESC, arrival DESC, event_id DESC) AS r FROM valid) WHERE r = 1),
l1 AS (SELECT order_id, record_version, amount, arrival FROM latest WHERE b = 1),
l2 AS (SELECT order_id, record_version, amount, arrival FROM latest WHERE b = 2),
l3 AS (SELECT order_id, record_version, amount, arrival FROM latest WHERE b = 3),
s2 AS ({_fold('l1', 'l2')}),
s3 AS ({_fold('s2', 'l3')})
SELECT * FROM s3"""


@query("stream_upsert_versioned", STREAM_UPSERT_SQL)
def stream_upsert_versioned(spark, sf_dir):
    """K13 + R1: three arrivals, three micro-batches, M4 into a snapshot table."""
    b = _bronze(spark, sf_dir)
    arrivals = [b.filter(F.col("arrival") < B.ntz(CUT1)),
                b.filter((F.col("arrival") >= B.ntz(CUT1)) & (F.col("arrival") < B.ntz(CUT2))),
                b.filter(F.col("arrival") >= B.ntz(CUT2))]
    silver = SnapshotTable(spark, fresh_dir(spark, "silver-upsert"), schema=_schema(spark, UPSERT_SCHEMA),
                           bucket_key="order_id", buckets=silver_buckets(spark, sf_dir))
    return run_arrivals(spark, arrivals, silver, upsert_touched, "upsert")


@query("stream_progress", B.with_sql(B.ORDERS_BRONZE_SQL) + f""",
b AS (SELECT CASE WHEN arrival < TIMESTAMP '{CUT1}' THEN 0 WHEN arrival < TIMESTAMP '{CUT2}' THEN 1 ELSE 2 END AS batch FROM orders_bronze)
SELECT CAST(batch AS BIGINT) AS arrival, count(*) AS input_rows, CAST(sum(count(*)) OVER (ORDER BY batch) AS BIGINT) AS rows_so_far
FROM b GROUP BY batch""")
def stream_progress(spark, sf_dir):
    """R2 + R7: a query that keeps running, drained after each of three arrivals:
    what its record of micro-batches says was read for each (an arrival may come in
    several), and in all."""
    from tidewell.streaming.progress import Progress, drain
    b = _bronze(spark, sf_dir)
    arrivals = [b.filter(F.col("arrival") < B.ntz(CUT1)),
                b.filter((F.col("arrival") >= B.ntz(CUT1)) & (F.col("arrival") < B.ntz(CUT2))),
                b.filter(F.col("arrival") >= B.ntz(CUT2))]
    landing, out = fresh_dir(spark, "progress-landing"), fresh_dir(spark, "progress-out")

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        refine_orders(batch_df).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    sinks.write_parquet(arrivals[0].limit(0), landing)
    done = []
    with Progress(spark) as progress:
        q = refine_stream(spark, landing, BRONZE_SCHEMA, handle, fresh_dir(spark, "progress-ckpt"), trigger="100 milliseconds")
        try:
            for arrival in arrivals:
                arrival.write.mode("append").parquet(landing)
                drain(q, progress)
                done.append(progress.record(q.id).agg(F.coalesce(F.sum("input_rows"), F.lit(0))).first()[0])
        finally:
            q.stop()
    rows = [(k, n - before, n) for k, (before, n) in enumerate(zip([0, *done], done))]
    return spark.createDataFrame(rows, "arrival bigint, input_rows bigint, rows_so_far bigint")


def _schema(spark, ddl):
    return ddl_schema(spark, ddl)


def _halves(spark, sf_dir):
    b = _bronze(spark, sf_dir)
    return (b.filter(F.col("arrival") < B.ntz(B.ORDERS_CUTOFF)),
            b.filter(F.col("arrival") >= B.ntz(B.ORDERS_CUTOFF)))


@query("stream_resume", MERGE_ACCUMULATE_SQL)
def stream_resume(spark, sf_dir):
    """Run, stop, land more files, run again on the same checkpoint:
    only the new files are processed (the M1 amounts would double
    otherwise).  Same result as ``merge_accumulate``."""
    first, second = _halves(spark, sf_dir)
    silver = SnapshotTable(spark, fresh_dir(spark, "silver-acc"), schema=_schema(spark, ACCUMULATE_SCHEMA),
                           bucket_key="order_id", buckets=silver_buckets(spark, sf_dir))
    out = run_arrivals(spark, [first, second], silver, accumulate_touched, "resume")
    return out.select("order_id", F.round("amount", 2).alias("amount"), "ship_status")


@query("stream_out_of_order", ORDERS_SWAPPED_SQL)
def stream_out_of_order(spark, sf_dir):
    """The later half arrives first; older or equal versions arriving
    afterwards do not add their amounts (M3 version guard)."""
    first, second = _halves(spark, sf_dir)
    # The MERGE joins on the order number ('007' = '7'), so the table buckets
    # on that expression: matching rows share a bucket.
    silver = SnapshotTable(spark, fresh_dir(spark, "silver-ooo"), schema=_schema(spark, VERSIONED_SCHEMA),
                           bucket_expr=order_key("order_id"), buckets=silver_buckets(spark, sf_dir))
    out = run_arrivals(spark, [second, first], silver, versioned_accumulate_touched, "ooo")
    return out.select("order_id", "record_version", F.round("amount", 2).alias("amount"))


@query("stream_append_copy", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_append_copy(spark, sf_dir):
    """S22 + R9: stream a catalog table that is appended to between two runs,
    pass every row through, file sink (exactly-once via its commit log)."""
    src = read_table(spark, sf_dir, "events")
    name = f"tw_stream_{uuid.uuid4().hex[:10]}"
    sinks.replace_table(src.filter("event_id % 2 = 0"), name, fresh_dir(spark, "append-src"))
    out, checkpoint = fresh_dir(spark, "append-out"), fresh_dir(spark, "append-ckpt")
    for more in (None, src.filter("event_id % 2 <> 0")):
        if more is not None:
            sinks.append_by_name(more, name)
        q = (spark.readStream.table(name).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.schema(src.schema).parquet(out)


# --- L2 / L3 as streams (same handlers as the batch queries) -----------------

def _two_arrivals(spark, bronze: DataFrame, schema_ddl: str, handler, tables, label: str) -> None:
    landing = fresh_dir(spark, f"{label}-landing")
    checkpoint = fresh_dir(spark, f"{label}-checkpoint")

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        handler(*tables, batch_df, query_id(batch_df.sparkSession, checkpoint), batch_id)

    for arrival in (bronze.filter("first_batch"), bronze.filter("NOT first_batch")):
        arrival.drop("first_batch").write.mode("append").parquet(landing)
        refine_stream(spark, landing, schema_ddl, handle, checkpoint, trigger="available_now")


def individual_stream(spark, sf_dir) -> DataFrame:
    """L2 through a file stream: two arrivals, the person/address handler per
    micro-batch; the same result as ``individual_refine``."""
    from tidewell.plans import individual as I
    from tidewell.operators.merge import estimated_bytes
    b = B.person_bronze(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"),
                        read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "supplier"))
    n = buckets_for(estimated_bytes(read_table(spark, sf_dir, "orders")))
    persons = SnapshotTable(spark, fresh_dir(spark, "s-person"), ddl_schema(spark, I.PERSON_TYPE),
                            bucket_key="id", buckets=n)
    addrs = SnapshotTable(spark, fresh_dir(spark, "s-address"), ddl_schema(spark, I.ADDRESS_TYPE),
                          bucket_key="id", buckets=n)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in b.drop("first_batch").schema.fields)
    _two_arrivals(spark, b, ddl, I.refine_batch, (persons, addrs), "s-individual")
    p, a = persons.read(), addrs.read()
    return (a.join(p, "id", "left")
             .select("id", "AddressId", "firstName", "lastName", "cityName", "country",
                     p["recordVersion"].alias("person_version"), a["recordVersion"].alias("address_version")))


def contact_stream(spark, sf_dir) -> DataFrame:
    """L3 through a file stream: two arrivals, the party/contact-point handler
    per micro-batch; the same result as ``contact_refine``."""
    from tidewell.plans import contact as C
    from tidewell.operators.merge import estimated_bytes
    b = B.contact_bronze(read_table(spark, sf_dir, "orders"))
    n = buckets_for(estimated_bytes(read_table(spark, sf_dir, "orders")))
    parties = SnapshotTable(spark, fresh_dir(spark, "s-party"), ddl_schema(spark, C.PARTY_TYPE),
                            bucket_key="id", buckets=n)
    points = SnapshotTable(spark, fresh_dir(spark, "s-point"), ddl_schema(spark, C.POINT_TYPE),
                           bucket_key="PartyId", buckets=n)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in b.drop("first_batch").schema.fields)
    _two_arrivals(spark, b, ddl, C.refine_batch, (parties, points), "s-contact")
    return points.read()
