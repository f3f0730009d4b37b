"""Orders bronze -> silver (L1): cleanse, dedupe, latest version, MERGE.

Silver orders: order_id string, record_version int, amount double,
ship_status string.  Queries here read ``events`` through
:func:`tidewell.plans.bronze.orders_bronze`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.operators import cleanse
from tidewell.operators.merge import insert, merge, update, cardinality_conflicts
from tidewell.operators.numbering import numbered
from tidewell.plans import bronze as B
from tidewell.plans.registry import query
from tidewell.session import materialize, read_table

SILVER_COLS = ["order_id", "record_version", "amount", "ship_status"]
def order_key(column: str) -> str:
    """The order's number without leading zeros as text ('007' = '7'), whatever
    its size up to 18 digits; an id that is no number is its own key."""
    return (f"CASE WHEN regexp_like(trim({column}), '^[+-]?[0-9]{{1,18}}$') "
            f"THEN CAST(CAST(trim({column}) AS BIGINT) AS STRING) ELSE {column} END")


def order_key_sql(column: str) -> str:
    """``order_key`` in DuckDB's words."""
    return order_key(column).replace("regexp_like", "regexp_matches").replace("AS STRING", "AS VARCHAR")


def number_key():
    """MERGE key: equal order numbers."""
    return [(F.expr(order_key("target.order_id")), F.expr(order_key("source.order_id")))]


def refine_orders(bronze: DataFrame, batch_cols: list[str] = ()) -> DataFrame:
    """Cleanse (key and version set, not blank) then keep, per order, the
    latest version; within a version the latest arrival, then the highest
    event id.  One window (partial top-1 before the shuffle).  ``batch_cols``
    refine several batches side by side in one pass."""
    valid = cleanse.valid_keys(bronze, ["order_id", "record_version"])
    return cleanse.latest_version(valid, list(batch_cols) + ["order_id"], "record_version",
                                  ties="one", tie_break=["arrival", "event_id"],
                                  method="row_number")


def as_silver(refined: DataFrame) -> DataFrame:
    """First load into an empty silver table: every row is an insert."""
    return refined.select("order_id", "record_version", "amount", F.lit("").alias("ship_status"))


VERSIONED_INSERT = [insert(None, {"order_id": "source.order_id", "record_version": "source.record_version",
                                   "amount": "source.amount", "ship_status": "''"})]


def VERSIONED_MATCHED(advance_version: bool = False):  # noqa: N802 - clause list, like the constant above
    values = {"amount": "target.amount + source.amount"}
    if advance_version:
        values["record_version"] = "source.record_version"
    return [update("source.record_version > target.record_version", values)]


def merge_versioned_accumulate(silver: DataFrame, batch: DataFrame, advance_version: bool = False,
                               **kw) -> DataFrame:
    """M2/M3: a newer source version adds its amount; an older or equal one is
    ignored; unknown orders are inserted with an empty ship status.  As in
    the reference, the target keeps its version unless ``advance_version``."""
    return merge(silver, batch, number_key(), matched=VERSIONED_MATCHED(advance_version),
                 not_matched=VERSIONED_INSERT, **kw)


def _two_batches(spark, sf_dir):
    """Both batches refined in one pass, then materialized once: the MERGE
    reads each side several times (join, key semi/anti joins)."""
    refined = materialize(refine_orders(B.orders_bronze(read_table(spark, sf_dir, "events")),
                                        ["first_batch"]), "first_batch")
    return refined.filter("first_batch"), refined.filter("NOT first_batch")


def orders_refine_df(spark, sf_dir) -> DataFrame:
    first, second = _two_batches(spark, sf_dir)
    silver = merge_versioned_accumulate(as_silver(first), second)
    return silver.select("order_id", "record_version", F.round("amount", 2).alias("amount"))


_REFINED_SQL = """
valid AS (SELECT * FROM orders_bronze
          WHERE order_id IS NOT NULL AND trim(order_id) <> '' AND record_version IS NOT NULL),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY first_batch, order_id
                          ORDER BY record_version DESC, arrival DESC, event_id DESC) AS r FROM valid)
           WHERE r = 1),
t AS (SELECT * FROM latest WHERE first_batch),
s AS (SELECT * FROM latest WHERE NOT first_batch)"""

_SAME_ORDER = f"{order_key_sql('s.order_id')} = {order_key_sql('t.order_id')}"

ORDERS_REFINE_SQL = B.with_sql(B.ORDERS_BRONZE_SQL, _REFINED_SQL) + f"""
SELECT t.order_id, t.record_version,
       round(CASE WHEN s.record_version > t.record_version THEN t.amount + s.amount
                  ELSE t.amount END, 2) AS amount
FROM t LEFT JOIN s ON {_SAME_ORDER}
UNION ALL
SELECT s.order_id, s.record_version, round(s.amount, 2) AS amount
FROM s WHERE NOT EXISTS (SELECT 1 FROM t
      WHERE {_SAME_ORDER})"""


# The same MERGE with the batches in the other order (late, older data second).
ORDERS_SWAPPED_SQL = ORDERS_REFINE_SQL.replace(
    "t AS (SELECT * FROM latest WHERE first_batch),\ns AS (SELECT * FROM latest WHERE NOT first_batch)",
    "t AS (SELECT * FROM latest WHERE NOT first_batch),\ns AS (SELECT * FROM latest WHERE first_batch)")
assert ORDERS_SWAPPED_SQL != ORDERS_REFINE_SQL


@query("orders_refine", ORDERS_REFINE_SQL)
def orders_refine(spark, sf_dir):
    return orders_refine_df(spark, sf_dir)


MERGE_ACCUMULATE_SQL = B.with_sql(B.ORDERS_BRONZE_SQL, _REFINED_SQL) + """
SELECT t.order_id, round(CASE WHEN s.order_id IS NOT NULL THEN t.amount + s.amount ELSE t.amount END, 2) AS amount,
       '' AS ship_status
FROM t LEFT JOIN s ON s.order_id = t.order_id
UNION ALL
SELECT s.order_id, round(s.amount, 2) AS amount, '' AS ship_status
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id)"""


@query("merge_accumulate", MERGE_ACCUMULATE_SQL)
def merge_accumulate(spark, sf_dir):
    """M1: no versions; a matched order adds the batch amount, a new one is
    inserted with an empty ship status."""
    first, second = _two_batches(spark, sf_dir)
    silver = as_silver(first).drop("record_version")
    out = merge(silver, second, ["order_id"],
                matched=[update(None, {"amount": "target.amount + source.amount"})],
                not_matched=[insert(None, {"order_id": "source.order_id", "amount": "source.amount",
                                           "ship_status": "''"})])
    return out.select("order_id", F.round("amount", 2).alias("amount"), "ship_status")


def _max_version_distinct(seq: DataFrame) -> DataFrame:
    """M2 source: DISTINCT rows whose version is the per-order maximum (the
    reference's self-join form; ties kept)."""
    d = seq.distinct()
    return cleanse.latest_version(d, ["first_batch", "order_id"], "record_version",
                                  ties="all", method="join")


_SEQ_SQL = """
d AS (SELECT DISTINCT * FROM seq_bronze),
mx AS (SELECT first_batch, order_id, max(record_version) AS mv FROM d GROUP BY 1, 2),
top AS (SELECT d.* FROM d JOIN mx ON d.first_batch = mx.first_batch AND d.order_id = mx.order_id
        AND d.record_version = mx.mv),
t AS (SELECT * FROM top WHERE first_batch),
s AS (SELECT * FROM top WHERE NOT first_batch)"""


@query("merge_accumulate_versioned", B.with_sql(B.SEQUENCED_BRONZE_SQL, _SEQ_SQL) + f"""
SELECT t.order_id, t.record_version,
       round(CASE WHEN s.record_version > t.record_version THEN t.amount + s.amount ELSE t.amount END, 2) AS amount
FROM t LEFT JOIN s ON {_SAME_ORDER}
UNION ALL
SELECT s.order_id, s.record_version, round(s.amount, 2) AS amount
FROM s WHERE NOT EXISTS (SELECT 1 FROM t
      WHERE {_SAME_ORDER})""")
def merge_accumulate_versioned(spark, sf_dir):
    seq = B.sequenced_orders_bronze(read_table(spark, sf_dir, "events"))
    top = _max_version_distinct(seq)
    first, second = top.filter("first_batch"), top.filter("NOT first_batch")
    silver = first.select("order_id", "record_version", "amount", F.lit("").alias("ship_status"))
    out = merge_versioned_accumulate(silver, second)
    return out.select("order_id", "record_version", F.round("amount", 2).alias("amount"))


@query("merge_upsert_versioned", B.with_sql(B.ORDERS_BRONZE_SQL, _REFINED_SQL) + """
SELECT CASE WHEN s.record_version > t.record_version THEN s.order_id ELSE t.order_id END AS order_id,
       CASE WHEN s.record_version > t.record_version THEN s.record_version ELSE t.record_version END AS record_version,
       CASE WHEN s.record_version > t.record_version THEN s.amount ELSE t.amount END AS amount,
       CASE WHEN s.record_version > t.record_version THEN s.arrival ELSE t.arrival END AS arrival
FROM t LEFT JOIN s ON s.order_id = t.order_id
UNION ALL
SELECT s.order_id, s.record_version, s.amount, s.arrival
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.order_id = s.order_id)""")
def merge_upsert_versioned(spark, sf_dir):
    """M4: a newer, non-null version overwrites the whole row; new keys insert."""
    first, second = _two_batches(spark, sf_dir)
    cols = ["order_id", "record_version", "amount", "arrival"]
    out = merge(first.select(*cols), second.select(*cols), ["order_id"],
                matched=[update("source.record_version IS NOT NULL AND "
                                "source.record_version > target.record_version", "*")],
                not_matched=[insert(None, "*")])
    return out


@query("merge_cardinality_conflicts", B.with_sql(B.ORDERS_BRONZE_SQL) + """,
valid AS (SELECT * FROM orders_bronze
          WHERE order_id IS NOT NULL AND trim(order_id) <> '' AND record_version IS NOT NULL),
top AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY first_batch, order_id
                       ORDER BY record_version DESC) AS r FROM valid) WHERE r = 1),
t AS (SELECT * FROM top WHERE first_batch),
s AS (SELECT * FROM top WHERE NOT first_batch)
SELECT order_id, count(*) AS n_source_rows FROM s
WHERE order_id IN (SELECT order_id FROM t)
GROUP BY order_id HAVING count(*) > 1""")
def merge_cardinality_conflicts(spark, sf_dir):
    """M6: orders whose batch holds several rows at the top version and that
    silver already has: a MERGE of this batch would be ambiguous."""
    b = cleanse.valid_keys(B.orders_bronze(read_table(spark, sf_dir, "events")),
                           ["order_id", "record_version"])
    top = cleanse.latest_version(b, ["first_batch", "order_id"], "record_version", ties="all")
    t, s = top.filter("first_batch"), top.filter("NOT first_batch")
    c = cardinality_conflicts(t, s, ["order_id"])
    return c.select(F.col("__k0").alias("order_id"), "n_source_rows")


_BRONZE_COLS = ["order_id", "record_version", "amount", "arrival", "record_type", "event_id"]


def _bronze(spark, sf_dir):
    return B.orders_bronze(read_table(spark, sf_dir, "events"))


@query("cleanse_valid_keys", B.with_sql(B.ORDERS_BRONZE_SQL) + """
SELECT order_id, record_version, amount, arrival, record_type, event_id FROM orders_bronze
WHERE order_id IS NOT NULL AND trim(order_id) <> '' AND record_version IS NOT NULL""")
def cleanse_valid_keys(spark, sf_dir):
    return cleanse.valid_keys(_bronze(spark, sf_dir), ["order_id", "record_version"]).select(*_BRONZE_COLS)


@query("cast_tolerant", B.with_sql(B.ORDERS_BRONZE_SQL) + """
SELECT event_id, order_id, TRY_CAST(order_id AS INTEGER) AS order_no FROM orders_bronze""")
def cast_tolerant(spark, sf_dir):
    from tidewell.functions import tolerant_int
    return _bronze(spark, sf_dir).select("event_id", "order_id", tolerant_int("order_id").alias("order_no"))


_VALID_SQL = B.with_sql(B.ORDERS_BRONZE_SQL) + """,
valid AS (SELECT order_id, record_version, amount, arrival, record_type, event_id FROM orders_bronze
          WHERE order_id IS NOT NULL AND trim(order_id) <> '' AND record_version IS NOT NULL)
"""

_DEDUPE_SQL = _VALID_SQL + """
SELECT order_id, record_version, amount, arrival, record_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, record_version
                               ORDER BY arrival DESC, event_id DESC) AS r FROM valid) WHERE r = 1"""


def _valid(spark, sf_dir):
    return cleanse.valid_keys(_bronze(spark, sf_dir), ["order_id", "record_version"]).select(*_BRONZE_COLS)


@query("dedupe_latest", _DEDUPE_SQL)
def dedupe_latest(spark, sf_dir):
    """A5: one row per (order, version): the latest arrival, then highest id."""
    return cleanse.dedupe_latest(_valid(spark, sf_dir), ["order_id", "record_version"],
                                 ["arrival", "event_id"])


@query("dedupe_max_by", _DEDUPE_SQL)
def dedupe_max_by(spark, sf_dir):
    """A5/A6 as one partial aggregation: max_by(row, (arrival, event_id))."""
    return cleanse.dedupe_max_by(_valid(spark, sf_dir), ["order_id", "record_version"],
                                 ["arrival", "event_id"])


_LATEST_ALL_SQL = _VALID_SQL + """
SELECT v.* FROM valid v JOIN (SELECT order_id, max(record_version) AS mv FROM valid GROUP BY order_id) m
  ON v.order_id = m.order_id AND v.record_version = m.mv"""


@query("latest_by_join", _LATEST_ALL_SQL)
def latest_by_join(spark, sf_dir):
    """J1 as written in the reference: join with the per-key maximum."""
    return cleanse.latest_version(_valid(spark, sf_dir), "order_id", "record_version",
                                  ties="all", method="join")


@query("latest_by_rank", _LATEST_ALL_SQL)
def latest_by_rank(spark, sf_dir):
    """J1 as one window: rank() = 1 keeps the same ties."""
    return cleanse.latest_version(_valid(spark, sf_dir), "order_id", "record_version",
                                  ties="all", method="rank")


@query("latest_by_row_number", _VALID_SQL + """
SELECT order_id, record_version, amount, arrival, record_type, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id
                               ORDER BY record_version DESC, arrival DESC, event_id DESC) AS r
  FROM valid) WHERE r = 1""")
def latest_by_row_number(spark, sf_dir):
    """One row per order, highest version, ties by arrival then id."""
    return cleanse.latest_version(_valid(spark, sf_dir), "order_id", "record_version",
                                  ties="one", tie_break=["arrival", "event_id"],
                                  method="row_number")


@query("max_version_per_key", _VALID_SQL + """
SELECT order_id, max(record_version) AS max_version FROM valid GROUP BY order_id""")
def max_version_per_key(spark, sf_dir):
    return cleanse.max_version_per_key(_valid(spark, sf_dir), "order_id", "record_version",
                                       "max_version")


@query("next_record", B.with_sql(B.ORDERS_BRONZE_SQL) + """
SELECT max(TRY_CAST(order_id AS INTEGER)) + 1 AS next_order_id,
       max(CAST(amount AS VARCHAR)) AS max_amount_text,
       TRY_CAST(max(CAST(amount AS VARCHAR)) AS DOUBLE) + 10 AS next_amount
FROM orders_bronze""")
def next_record(spark, sf_dir):
    """Next id = numeric max + 1; next amount from the *text* maximum
    of the amounts (text order: '99.5' > '490.02') + 10, as the reference."""
    b = _bronze(spark, sf_dir)
    mt = F.max(F.col("amount").cast("string"))
    return b.agg((F.max(F.col("order_id").try_cast("int")) + 1).alias("next_order_id"),
                 mt.alias("max_amount_text"),
                 (mt.try_cast("double") + 10).alias("next_amount"))


@query("next_ids", B.with_sql(B.ORDERS_BRONZE_SQL) + """
SELECT event_id, amount, (SELECT max(TRY_CAST(order_id AS INTEGER)) FROM orders_bronze)
       + row_number() OVER (ORDER BY arrival, event_id) AS new_order_id
FROM orders_bronze WHERE order_id IS NULL OR trim(order_id) = ''""")
def next_ids(spark, sf_dir):
    """A2 for many rows: every order without an id gets the next free one, in
    order of arrival, without gaps and without a single-task window."""
    b = _bronze(spark, sf_dir)
    top = b.agg(F.max(F.col("order_id").try_cast("int"))).first()[0] or 0
    fresh = b.filter("order_id IS NULL OR trim(order_id) = ''").select("event_id", "amount", "arrival")
    return numbered(fresh, ["arrival", "event_id"], "new_order_id", start=top + 1).select("event_id", "amount", "new_order_id")


@query("distinct_rows", B.with_sql(B.SEQUENCED_BRONZE_SQL) + """
SELECT DISTINCT order_id, record_version, amount, first_batch FROM seq_bronze""")
def distinct_rows(spark, sf_dir):
    """A4: exact copies (redelivered purchase events) collapse to one."""
    return cleanse.distinct_rows(B.sequenced_orders_bronze(read_table(spark, sf_dir, "events")))


@query("delete_where", B.with_sql(B.ORDERS_BRONZE_SQL) + """
SELECT order_id, record_version, amount, arrival, record_type, event_id FROM orders_bronze
WHERE NOT coalesce(record_type = 'delete' OR trim(order_id) = '', false)""")
def delete_where(spark, sf_dir):
    """M7: drop rows where the predicate is TRUE; a NULL predicate keeps the row."""
    b = _bronze(spark, sf_dir).select(*_BRONZE_COLS)
    return cleanse.delete_where(b, "record_type = 'delete' OR trim(order_id) = ''")
