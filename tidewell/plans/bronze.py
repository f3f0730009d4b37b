"""Bronze feeds derived from the driver tables, identical in Spark and SQL.

Each feed is a projection (plus, for the person feed, joins) of a given
table, so its size grows with the table.  The moduli below only shape the
values (null keys, blank keys, versions, record types); no row is filtered
away by them.  The matching SQL text sits beside each function for the
oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed split points: rows before them form the first batch (what silver
# already holds), the rest the second batch.
ORDERS_CUTOFF = "2024-01-16 00:00:00"      # events.ts
PARTY_CUTOFF = "1998-07-01 00:00:00"       # orders.o_orderdate


def ntz(ts: str):
    return F.expr(f"TIMESTAMP_NTZ '{ts}'")


# --- orders bronze (events) ---------------------------------------------------

def orders_bronze(events: DataFrame) -> DataFrame:
    """order_id text (null / '' / blanks on purpose), int version (some null),
    amount, arrival, record type, tie-break id."""
    eid = F.col("event_id")
    order_id = (F.when(eid % 97 == 0, F.lit(None).cast("string"))
                 .when(eid % 89 == 0, F.lit(""))
                 .when(eid % 83 == 0, F.lit("   "))
                 .otherwise((F.col("user_id") * 20 + eid % 20).cast("string")))
    version = F.when(eid % 53 == 0, F.lit(None)).otherwise(F.expr("(event_id div 20) % 5")).cast("int")
    rtype = F.when(eid % 13 == 0, F.lit("delete")).otherwise(F.lit("upsert"))
    return events.select(
        order_id.alias("order_id"), version.alias("record_version"),
        F.col("value").alias("amount"), F.col("ts").alias("arrival"),
        rtype.alias("record_type"), eid.alias("event_id"),
        (F.col("ts") < ntz(ORDERS_CUTOFF)).alias("first_batch"))


ORDERS_BRONZE_SQL = f"""
orders_bronze AS (
  SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN ''
              WHEN event_id % 83 = 0 THEN '   '
              ELSE CAST(user_id * 20 + event_id % 20 AS VARCHAR) END AS order_id,
         CAST(CASE WHEN event_id % 53 = 0 THEN NULL ELSE (event_id // 20) % 5 END AS INTEGER) AS record_version,
         value AS amount, ts AS arrival,
         CASE WHEN event_id % 13 = 0 THEN 'delete' ELSE 'upsert' END AS record_type,
         event_id, ts < TIMESTAMP '{ORDERS_CUTOFF}' AS first_batch
  FROM events)"""


def sequenced_orders_bronze(events: DataFrame) -> DataFrame:
    """Orders keyed like :func:`orders_bronze` but versioned by a sequence
    number (the event id), with every purchase event delivered twice: exact
    copies, as an at-least-once feed gives them (M2: DISTINCT removes them)."""
    base = events.select(
        (F.col("user_id") * 20 + F.col("event_id") % 20).cast("string").alias("order_id"),
        F.col("event_id").alias("record_version"), F.col("value").alias("amount"),
        (F.col("ts") < ntz(ORDERS_CUTOFF)).alias("first_batch"), "event_type")
    again = base.filter(F.col("event_type") == "purchase")
    return base.unionByName(again).drop("event_type")


SEQUENCED_BRONZE_SQL = f"""
seq_base AS (
  SELECT CAST(user_id * 20 + event_id % 20 AS VARCHAR) AS order_id, event_id AS record_version,
         value AS amount, ts < TIMESTAMP '{ORDERS_CUTOFF}' AS first_batch, event_type FROM events),
seq_bronze AS (
  SELECT order_id, record_version, amount, first_batch FROM seq_base
  UNION ALL
  SELECT order_id, record_version, amount, first_batch FROM seq_base WHERE event_type = 'purchase')"""


# --- contact bronze (orders): one wide party record per order -----------------

def contact_bronze(orders: DataFrame) -> DataFrame:
    """id, name, Ph1..Ph3 (each null by its own modulus, all null for
    o_orderkey % 60 = 0 with name null too), recordVersion, arrival, type."""
    k = F.col("o_orderkey")

    def phone(i: int, m: int):
        return F.when(k % m == 0, F.lit(None)).otherwise(k * 10 + i).cast("long")

    rtype = (F.when(k % 13 == 0, F.lit("delete"))
              .when(k % 17 == 0, F.lit(None).cast("string"))
              .otherwise(F.lit("upsert")))
    return orders.select(
        F.col("o_custkey").alias("id"),
        F.when(k % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("name"),
        phone(1, 3).alias("Ph1"), phone(2, 4).alias("Ph2"), phone(3, 5).alias("Ph3"),
        F.expr("(o_orderkey div 7) % 5").cast("int").alias("recordVersion"),
        F.col("o_orderdate").alias("arrivalTime"), rtype.alias("recordType"),
        k.alias("seq"),
        (F.col("o_orderdate") < ntz(PARTY_CUTOFF)).alias("first_batch"))


CONTACT_BRONZE_SQL = f"""
contact_bronze AS (
  SELECT o_custkey AS id,
         CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS name,
         CAST(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey * 10 + 1 END AS BIGINT) AS Ph1,
         CAST(CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderkey * 10 + 2 END AS BIGINT) AS Ph2,
         CAST(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey * 10 + 3 END AS BIGINT) AS Ph3,
         CAST((o_orderkey // 7) % 5 AS INTEGER) AS recordVersion,
         o_orderdate AS arrivalTime,
         CASE WHEN o_orderkey % 13 = 0 THEN 'delete' WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE 'upsert' END AS recordType,
         o_orderkey AS seq, o_orderdate < TIMESTAMP '{PARTY_CUTOFF}' AS first_batch
  FROM orders)"""


# --- person + address bronze (orders x customer x nation, supplier) -----------

def person_bronze(orders: DataFrame, customer: DataFrame, nation: DataFrame,
                  supplier: DataFrame) -> DataFrame:
    """One wide person record per order: names, address slot 1 from the
    customer's nation, slot 2 from supplier ``o_custkey div 15`` (absent for
    a third of the records), arrival, version (some null)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    s = supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n2 = nation.select(F.col("n_nationkey").alias("s_nk"), F.col("n_name").alias("s_nation"))
    k = F.col("o_orderkey")
    slot2 = (k % 3 != 0)
    wide = (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .join(n, c.c_nationkey == n.n_nationkey, "left")
             .join(s, F.expr("o_custkey div 15") == s.s_suppkey, "left")
             .join(n2, F.col("s_nationkey") == n2.s_nk, "left"))
    return wide.select(
        F.col("o_custkey").alias("id"),
        F.col("c_name").alias("firstName"), F.col("o_orderpriority").alias("lastName"),
        (k % 1000).cast("int").alias("streetNo1"), F.col("c_mktsegment").alias("cityName1"),
        (F.lit(10000) + F.col("c_nationkey") * 100 + k % 100).cast("int").alias("zipcode1"),
        F.col("n_name").alias("country1"),
        F.when(slot2, F.col("s_acctbal").cast("int")).alias("streetNo2"),
        F.when(slot2, F.col("s_name")).alias("cityName2"),
        F.when(slot2, F.col("s_nationkey")).cast("int").alias("zipcode2"),
        F.when(slot2, F.col("s_nation")).alias("country2"),
        F.col("o_orderdate").alias("arrivalTime"),
        F.when(k % 53 == 0, F.lit(None)).otherwise(F.expr("(o_orderkey div 7) % 5")).cast("int").alias("recordVersion"),
        k.alias("seq"),
        (F.col("o_orderdate") < ntz(PARTY_CUTOFF)).alias("first_batch"))


PERSON_BRONZE_SQL = f"""
person_bronze AS (
  SELECT o.o_custkey AS id, c.c_name AS firstName, o.o_orderpriority AS lastName,
         CAST(o.o_orderkey % 1000 AS INTEGER) AS streetNo1, c.c_mktsegment AS cityName1,
         CAST(10000 + c.c_nationkey * 100 + o.o_orderkey % 100 AS INTEGER) AS zipcode1,
         n.n_name AS country1,
         CASE WHEN o.o_orderkey % 3 <> 0 THEN CAST(trunc(s.s_acctbal) AS INTEGER) END AS streetNo2,
         CASE WHEN o.o_orderkey % 3 <> 0 THEN s.s_name END AS cityName2,
         CAST(CASE WHEN o.o_orderkey % 3 <> 0 THEN s.s_nationkey END AS INTEGER) AS zipcode2,
         CASE WHEN o.o_orderkey % 3 <> 0 THEN n2.n_name END AS country2,
         o.o_orderdate AS arrivalTime,
         CAST(CASE WHEN o.o_orderkey % 53 = 0 THEN NULL ELSE (o.o_orderkey // 7) % 5 END AS INTEGER) AS recordVersion,
         o.o_orderkey AS seq, o.o_orderdate < TIMESTAMP '{PARTY_CUTOFF}' AS first_batch
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN supplier s ON o.o_custkey // 15 = s.s_suppkey
  LEFT JOIN nation n2 ON s.s_nationkey = n2.n_nationkey)"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)
