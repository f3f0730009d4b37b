"""Streaming refinement: file stream -> ``foreachBatch`` handler.

``refine_stream`` starts a Structured Streaming query over a folder of
files with a declared schema (a file stream cannot infer one) and calls the
handler once per micro-batch.  The checkpoint folder records which files
were consumed, so a restart with the same checkpoint processes only new
files (R5).  Trigger: ``"available_now"`` (run over what is there, in
rate-limited batches, then stop; R1), a processing-time interval such as
``"2 seconds"`` (R2), or None (as fast as possible, R3).

Exactly-once into snapshot tables: the handler publishes each batch under
``(job, batch_id)`` with :meth:`SnapshotTable.publish`, where ``job`` is the
streaming query id, which Spark keeps in the checkpoint (new checkpoint,
new id), so a replay after a failure skips what was already published.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark stored for the query of ``checkpoint`` (its small
    ``metadata`` file, read on the driver through Hadoop's FileSystem; not
    cached, since a new checkpoint at the same path has a new id)."""
    path = f"{checkpoint.rstrip('/')}/metadata"
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        stream = fs.open(p)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        first = text.splitlines()[0]
    except Exception:  # noqa: BLE001 - no JVM access: read it as a tiny text file
        first = spark.read.text(path).first()["value"]
    return json.loads(first)["id"]


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def size_bytes(size: int | str) -> int:
    """``4096``, ``"512m"``, ``"4g"`` -> bytes."""
    if isinstance(size, int):
        return size
    text = size.strip().lower().removesuffix("b") if size.strip().lower() != "b" else "1"
    num, unit = (text[:-1], text[-1]) if text and text[-1] in _UNITS else (text, "")
    return int(float(num) * _UNITS[unit])


def refine_stream(spark: SparkSession, source: str, schema: StructType | str,
                  handler: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: str | None = "available_now", max_files: int | None = None,
                  max_bytes: int | str | None = None, fmt: str = "parquet", options: dict | None = None):
    """``max_files`` / ``max_bytes`` (bytes, or e.g. ``"4g"``) bound each
    micro-batch (R6), so a backlog is processed in batches of a planned size;
    with ``availableNow`` the backlog is drained in such batches, then the
    query stops."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    if max_bytes:
        r = r.option("maxBytesPerTrigger", str(size_bytes(max_bytes)))
    if options:
        r = r.options(**options)
    stream = r.load(source)
    w = (stream.writeStream.foreachBatch(handler)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    q = w.start()
    if trigger == "available_now":
        q.awaitTermination()
    return q

