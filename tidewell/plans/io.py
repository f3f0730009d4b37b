"""Sources, sinks, views and table upkeep over the driver tables
(S9-S18, S20-S21, K1-K8, K10-K12, D5, D8, D10, D11, P1, P4, P5, P12, P13,
A3, O3, T1-T3).

Every query writes a given table (or part of it) to a fresh folder under
the shared scratch root, reads it back the way the operator under test
reads, and returns the frame; the driver evaluates it later, so the files
are left in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidewell.plans.registry import query
from tidewell.session import fresh_dir, read_table, table_path
from tidewell.sources import files, sinks
from tidewell.sources.tables import SnapshotTable


def _name(label: str) -> str:
    return f"tw_{label}_{uuid.uuid4().hex[:10]}"


# --- Parquet scans -----------------------------------------------------------

@query("scan_parquet", """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
  WHERE l_returnflag = 'R'""")
def scan_parquet(spark, sf_dir):
    """Default format is Parquet; the filter and the 4-column projection
    reach the scan (PushedFilters / ReadSchema)."""
    df = spark.read.load(table_path(sf_dir, "lineitem"))
    return (df.filter(F.col("l_returnflag") == "R")
              .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))


@query("sql_on_file", """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def sql_on_file(spark, sf_dir):
    """SQL straight on a file path."""
    return files.sql_on_file(spark, "parquet", table_path(sf_dir, "orders"),
                             where="o_orderstatus = 'F'", columns="o_orderkey, o_totalprice")


@query("scan_ignore_corrupt", "SELECT * FROM customer")
def scan_ignore_corrupt(spark, sf_dir):
    """A folder holding Parquet and a non-Parquet file; the reader
    option skips the unreadable file (no session setting is touched)."""
    cust = read_table(spark, sf_dir, "customer")
    d = fresh_dir(spark, "corrupt")
    cust.write.parquet(d)
    cust.select("c_name").write.mode("append").text(d)
    return files.read_parquet(spark, d, ignore_corrupt=True, schema=cust.schema)


@query("scan_recursive", "SELECT * FROM customer")
def scan_recursive(spark, sf_dir):
    """Files two and three folders down, found by recursive lookup."""
    cust = read_table(spark, sf_dir, "customer")
    d = fresh_dir(spark, "nested")
    cust.filter(F.col("c_nationkey") < 12).write.parquet(f"{d}/low/deeper")
    cust.filter(F.col("c_nationkey") >= 12).write.parquet(f"{d}/high/deeper/still")
    return files.read_parquet(spark, d, recursive=True).select(*cust.columns)


@query("scan_glob", "SELECT * FROM customer")
def scan_glob(spark, sf_dir):
    """Only file names matching ``*.parquet`` are read."""
    cust = read_table(spark, sf_dir, "customer")
    d = fresh_dir(spark, "glob")
    cust.write.parquet(d)
    cust.write.mode("append").json(d)
    return files.read_parquet(spark, d, glob="*.parquet")


@query("scan_modified_between", "SELECT * FROM customer")
def scan_modified_between(spark, sf_dir):
    """File modification-time window, interpreted in zone CST.  Beside the
    customers' files lie older copies, dated 1999, that the window leaves out."""
    cust = read_table(spark, sf_dir, "customer")
    d = fresh_dir(spark, "mtime")
    cust.write.parquet(f"{d}/old")
    files.set_modified(spark, f"{d}/old", "1999-06-01T00:00:00")
    cust.write.parquet(f"{d}/new")
    return files.read_parquet(spark, d, recursive=True, modified_after="2000-01-01T00:00:00",
                              modified_before="2100-01-01T00:00:00", time_zone="CST").select(*cust.columns)


@query("scan_merge_schema", """SELECT p_partkey AS value,
  CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size * p_size AS INTEGER) END AS square,
  CASE WHEN p_partkey % 2 = 1 THEN CAST(p_size * p_size * p_size AS INTEGER) END AS cube,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS key FROM part""")
def scan_merge_schema(spark, sf_dir):
    """Partition folders key=1 (value, square) and key=2 (value, cube);
    ``mergeSchema`` gives value, square, cube, key."""
    part = read_table(spark, sf_dir, "part")
    d = fresh_dir(spark, "merge-schema")
    even = part.filter(F.col("p_partkey") % 2 == 0)
    odd = part.filter(F.col("p_partkey") % 2 == 1)
    even.select(F.col("p_partkey").alias("value"),
                (F.col("p_size") * F.col("p_size")).alias("square")).write.parquet(f"{d}/key=1")
    odd.select(F.col("p_partkey").alias("value"),
               (F.col("p_size") * F.col("p_size") * F.col("p_size")).alias("cube")).write.parquet(f"{d}/key=2")
    return files.read_parquet(spark, d, merge_schema=True).select("value", "square", "cube", "key")


# --- text ----------------------------------------------------------------------

_EVENT_LINE = "concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type)"


def _event_lines(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.concat_ws(",", F.col("event_id").cast("string"), F.col("user_id").cast("string"),
                                 "event_type").alias("value"))


@query("scan_text_lines", f"SELECT {_EVENT_LINE} AS value FROM events")
def scan_text_lines(spark, sf_dir):
    """One row per line."""
    p = sinks.write_text(_event_lines(spark, sf_dir), fresh_dir(spark, "lines"))
    return files.read_text(spark, p)


@query("scan_text_linesep", "SELECT c_name AS value FROM customer")
def scan_text_linesep(spark, sf_dir):
    """Records separated by ',' instead of newlines."""
    cust = read_table(spark, sf_dir, "customer").select(F.col("c_name").alias("value"))
    p = sinks.write_text(cust, fresh_dir(spark, "linesep"), line_sep=",")
    return files.read_text(spark, p, line_sep=",")


@query("scan_text_whole", """SELECT doc_id, text || chr(10) AS value FROM documents""")
def scan_text_whole(spark, sf_dir):
    """One row per file.  Each document is written as its own file (rows
    of one id in one file of the input share it), and ``wholetext`` reads every
    file back as one value; the id comes from the file's name, or by the numbers
    in it where only Spark's writer reaches the folder."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("_metadata.file_path").alias("input"), "text")
    d = fresh_dir(spark, "whole")
    if not sinks.mounted(spark, d):
        ids = sinks.write_text_per_key(docs, d, "text", ["doc_id", "input"])
        read = files.read_text(spark, d, whole=True).withColumn("file", sinks.file_number(F.col("_metadata.file_name")))
        # Spark plans a task for every few files; as many tasks as wrote them read them
        last = ids.agg(F.max(F.shiftright("file", 33))).first()[0]
        return read.coalesce((last or 0) + 1).join(ids, "file").select("doc_id", "value")
    read = files.read_text_files(spark, sinks.write_text_files(docs, d, "text", ["doc_id", "input"], "doc_id"))
    return read.select(F.col("label").cast("long").alias("doc_id"), "value")


# --- tables, typed rows, views -------------------------------------------------

@query("table_scan", "SELECT * FROM customer")
def table_scan(spark, sf_dir):
    """A stored table read by name in SQL, all columns."""
    cust = read_table(spark, sf_dir, "customer")
    t = SnapshotTable(spark, fresh_dir(spark, "table"))
    t.replace(cust)
    name = _name("table")
    t.as_view(name)
    return spark.sql(f"SELECT * FROM {name}")


CUST_TYPE = StructType([StructField("id", LongType()), StructField("name", StringType()),
                        StructField("sales", DoubleType()), StructField("discount", DoubleType()),
                        StructField("state", StringType())])


@query("typed_rows", """SELECT c_custkey AS id, c_name AS name, c_acctbal AS sales,
  CAST(c_nationkey AS DOUBLE) AS discount, c_mktsegment AS state FROM customer
  WHERE c_mktsegment = 'BUILDING'""")
def typed_rows(spark, sf_dir):
    """A frame viewed through a declared row type: ``to(schema)``
    reorders by name and up-casts (int -> double), then a typed filter."""
    cust = read_table(spark, sf_dir, "customer")
    raw = cust.select(F.col("c_mktsegment").alias("state"), F.col("c_nationkey").alias("discount"),
                      F.col("c_acctbal").alias("sales"), F.col("c_name").alias("name"),
                      F.col("c_custkey").alias("id"))
    return raw.to(CUST_TYPE).filter(F.col("state") == "BUILDING")


@query("sql_between_view", "SELECT c_name FROM customer WHERE c_acctbal BETWEEN 1000 AND 2000")
def sql_between_view(spark, sf_dir):
    """D5 + P5: temp view, SQL with an inclusive BETWEEN."""
    v = _name("customers")
    read_table(spark, sf_dir, "customer").createOrReplaceTempView(v)
    return spark.sql(f"SELECT c_name FROM {v} WHERE c_acctbal BETWEEN 1000 AND 2000")


@query("project_filter", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def project_filter(spark, sf_dir):
    """P1 + P4: projection and equality filter, both pushed to the scan."""
    return (read_table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
            .select("c_custkey", "c_name"))


@query("map_prefix", "SELECT 'Name: ' || c_name AS value FROM customer WHERE c_acctbal BETWEEN 1000 AND 2000")
def map_prefix(spark, sf_dir):
    """The row map ``"Name: " + name`` as a column expression (no UDF)."""
    return (read_table(spark, sf_dir, "customer").filter(F.col("c_acctbal").between(1000, 2000))
            .select(F.concat(F.lit("Name: "), F.col("c_name")).alias("value")))


@query("count_rows", "SELECT count(*) AS n_rows FROM lineitem")
def count_rows(spark, sf_dir):
    """A3 (answered from Parquet row-group metadata where possible)."""
    return read_table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query("top_n", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
  ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def top_n(spark, sf_dir):
    """O3: head of a table for display, made definite by a total order
    (planned as a per-partition top-k then a merge: no full sort)."""
    return (read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey")).limit(20))


# --- sinks -----------------------------------------------------------------------

@query("sink_parquet", "SELECT * FROM orders")
def sink_parquet(spark, sf_dir):
    """K1: write, then overwrite the same path with the full table."""
    orders = read_table(spark, sf_dir, "orders")
    d = fresh_dir(spark, "sink-parquet")
    sinks.write_parquet(orders.filter(F.col("o_orderstatus") == "O"), d)
    sinks.write_parquet(orders, d, mode="overwrite")
    return spark.read.parquet(d)


@query("sink_orc_options", "SELECT * FROM orders")
def sink_orc_options(spark, sf_dir):
    """K2: ORC with a bloom filter on o_custkey, dictionary threshold and a
    directly encoded column."""
    orders = read_table(spark, sf_dir, "orders")
    d = sinks.write_orc(orders, fresh_dir(spark, "sink-orc"), bloom_columns=["o_custkey"],
                        dictionary_threshold=0.5, direct_encoding=["o_orderpriority"])
    return spark.read.orc(d)


@query("sink_parquet_options", "SELECT * FROM lineitem")
def sink_parquet_options(spark, sf_dir):
    """K3: Parquet with a bloom filter (and expected distinct count) on
    l_orderkey, dictionary off, page checksums off."""
    li = read_table(spark, sf_dir, "lineitem")
    # the filter of a file is sized for the keys it may hold
    keys = li.agg(F.approx_count_distinct("l_orderkey")).first()[0]
    d = sinks.write_parquet_tuned(li, fresh_dir(spark, "sink-pq"), bloom_ndv={"l_orderkey": max(1, keys)},
                                  dictionary=False, page_checksum=False)
    return spark.read.parquet(d)


@query("sink_bucketed", "SELECT * FROM customer")
def sink_bucketed(spark, sf_dir):
    """K4/O2: 42 buckets by name, sorted by balance within each bucket."""
    cust = read_table(spark, sf_dir, "customer")
    t = sinks.save_bucketed(cust, _name("bucketed"), 42, "c_name", sort_by="c_acctbal",
                            path=fresh_dir(spark, "sink-bucketed"))
    return spark.table(t).select(*cust.columns)


@query("sink_partitioned", "SELECT * FROM orders")
def sink_partitioned(spark, sf_dir):
    """K5: one folder per order status."""
    orders = read_table(spark, sf_dir, "orders")
    d = sinks.write_parquet(orders, fresh_dir(spark, "sink-part"), partition_by="o_orderstatus")
    return spark.read.parquet(d).select(*orders.columns)


@query("sink_part_bucket", "SELECT * FROM orders")
def sink_part_bucket(spark, sf_dir):
    """K6: partitioned by priority, 42 buckets by customer inside each."""
    orders = read_table(spark, sf_dir, "orders")
    t = sinks.save_bucketed(orders, _name("partbucket"), 42, "o_custkey", partition_by="o_orderpriority",
                            path=fresh_dir(spark, "sink-partbucket"))
    return spark.table(t).select(*orders.columns)


@query("sink_csv", "SELECT * FROM part")
def sink_csv(spark, sf_dir):
    """K7: CSV with header; read back with the table's own schema."""
    part = read_table(spark, sf_dir, "part")
    d = sinks.write_csv(part, fresh_dir(spark, "sink-csv"))
    return files.read_csv(spark, d, header=True, schema=part.schema)


@query("sink_text_gzip", f"SELECT {_EVENT_LINE} AS value FROM events")
def sink_text_gzip(spark, sf_dir):
    """K8: text lines, gzip-compressed; read back transparently."""
    d = sinks.write_text(_event_lines(spark, sf_dir), fresh_dir(spark, "sink-gz"), compression="gzip")
    return spark.read.text(d)


@query("table_replace", "SELECT * FROM part")
def table_replace(spark, sf_dir):
    """Create-or-replace a catalog table twice; the second wins."""
    part = read_table(spark, sf_dir, "part")
    t, loc = _name("replace"), fresh_dir(spark, "replace")
    sinks.replace_table(part.filter(F.col("p_size") > 25), t, loc)
    sinks.replace_table(part, t, loc)
    return spark.table(t)


@query("append_by_name", "SELECT * FROM customer")
def append_by_name(spark, sf_dir):
    """The second append lists the columns in another order."""
    cust = read_table(spark, sf_dir, "customer")
    t = _name("append")
    sinks.replace_table(cust.filter(F.col("c_nationkey") < 10), t, fresh_dir(spark, "append"))
    sinks.append_by_name(cust.filter(F.col("c_nationkey") >= 10).select(*reversed(cust.columns)), t)
    return spark.table(t)


@query("insert_select", "SELECT * FROM supplier")
def insert_select(spark, sf_dir):
    """CREATE TABLE, then INSERT INTO ... SELECT."""
    t, v = _name("insert"), _name("suppliers")
    read_table(spark, sf_dir, "supplier").createOrReplaceTempView(v)
    loc = fresh_dir(spark, "insert")
    spark.sql(f"CREATE TABLE {t} (s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE) "
              f"USING parquet LOCATION '{loc}'")
    spark.sql(f"INSERT INTO {t} SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM {v}")
    return spark.table(t)


# --- layouts and upkeep ---------------------------------------------------------------

@query("bucket_layout", """SELECT CAST(count(*) AS BIGINT) AS n_keys, CAST(count(*) AS BIGINT) AS n_rows,
  CAST(1 AS BIGINT) AS max_buckets_per_key FROM customer""")
def bucket_layout(spark, sf_dir):
    """A table in 10 folders by hash of the key; read from the folders,
    every key lies in one bucket and no row is lost."""
    t = SnapshotTable(spark, fresh_dir(spark, "buckets"), bucket_key="c_custkey", buckets=10)
    v = t.replace(read_table(spark, sf_dir, "customer"))
    per_key = spark.read.parquet(v.path).groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("bucket").alias("b"))
    return per_key.agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"), F.max("b").alias("max_buckets_per_key"))


@query("partition_by_month", """SELECT o_orderkey, o_orderdate, strftime(o_orderdate, '%Y-%m') AS month
  FROM orders""")
def partition_by_month(spark, sf_dir):
    """A table laid out by year, re-laid by month (one rewrite job)."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    t = SnapshotTable(spark, fresh_dir(spark, "by-month"))
    t.partition_by = ["year"]
    t.replace(orders.withColumn("year", F.date_format("o_orderdate", "yyyy")))
    t.repartition_by({"month": F.date_format("o_orderdate", "yyyy-MM")})
    cur = t.current()
    return spark.read.parquet(cur.path).select("o_orderkey", "o_orderdate", "month")


@query("partition_identity", "SELECT * FROM customer")
def partition_identity(spark, sf_dir):
    """Add an identity partition field to an existing table."""
    cust = read_table(spark, sf_dir, "customer")
    t = SnapshotTable(spark, fresh_dir(spark, "identity"))
    t.replace(cust)
    t.repartition_by(["c_mktsegment"])
    return t.read().select(*cust.columns)


@query("compact_files", "SELECT * FROM lineitem")
def compact_files(spark, sf_dir):
    """A table loaded in many small appends, rewritten into files of the
    target size; the rows are unchanged."""
    li = read_table(spark, sf_dir, "lineitem")
    t = SnapshotTable(spark, fresh_dir(spark, "compact"))
    t.replace(li.filter("l_linenumber = 1"))
    for k in (F.col("l_linenumber") == 2, F.col("l_linenumber") > 2):
        t.append(li.filter(k))
    t.compact(target_bytes=512 * 1024 * 1024)
    return t.read()


@query("table_delete", """SELECT * FROM customer
  WHERE c_mktsegment <> 'BUILDING' AND NOT (c_acctbal > 9000)""")
def table_delete(spark, sf_dir):
    """M7 on a stored table, read back: whole folders go (a predicate on the
    partition column), then rows, and a delete that matches nothing."""
    cust = read_table(spark, sf_dir, "customer")
    t = SnapshotTable(spark, fresh_dir(spark, "delete"), partition_by=["c_mktsegment"])
    t.replace(cust)
    t.delete_where("c_mktsegment = 'BUILDING'")
    t.delete_where("c_acctbal > 9000")
    t.delete_where("c_mktsegment = 'NONE'")
    return t.read().select(*cust.columns)
