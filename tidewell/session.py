"""Session settings and the shared scratch location.

Operators never depend on these settings: the caller may pass any session.
``build`` is for scripts, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


MiB = 1024 * 1024


def sizing(input_bytes: int, target_partition_bytes: int = 256 * MiB) -> dict:
    """Partition sizing for a job reading ``input_bytes``: shuffle partitions
    so each holds about ``target_partition_bytes`` before AQE coalesces small
    ones (AQE cannot split a partition that is too big, except for skew, so
    start fine-grained), file splits of the same size, and AQE's advisory
    size.  E.g. 100 TB -> 372,530 partitions of 256 MiB; 1 GB -> 200."""
    parts = max(200, -(-max(input_bytes, 0) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MiB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def build(master: str | None = None, app: str = "tidewell",
          shuffle_partitions: int | None = None, extra: dict | None = None,
          input_bytes: int | None = None) -> SparkSession:
    """Session with UTC time zone, ANSI mode and AQE (incl. skew joins) on.
    ``input_bytes`` sizes partitions for that much input (see ``sizing``);
    ``shuffle_partitions`` overrides the count (tests, local runs)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if input_bytes is not None:
        conf.update(sizing(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a shared file system (HDFS, object
    store) that every executor and the driver can reach, and it must be set.
    Only in local mode (tests) a private temporary folder stands in for it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="tidewell-")
    return _LOCAL_SCRATCH[sc.applicationId]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch root (Spark creates it on write),
    grouped per Spark application so one folder never collects every run."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/tidewell/{app}/{label}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))


def ddl_schema(spark: SparkSession, ddl: str):
    """A StructType from a DDL string, parsed by Spark."""
    return spark.createDataFrame([], ddl).schema


def materialize(df, partition_by=(), label: str = "materialized"):
    """Compute ``df`` once and cut its lineage: Parquet in the shared folder,
    read back with the same schema, so later reads prune columns and push
    filters down, and a lost executor costs a re-read.  A filter on a column
    of ``partition_by`` reads only its folder."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    names = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    w = df.write
    if names:
        w = w.partitionBy(*names)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
