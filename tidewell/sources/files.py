"""Reader presets for files, JDBC and SQL-on-file.

Thin wrappers over ``spark.read`` that name the options the reference uses
and avoid two PySpark traps: ``wholetext`` must be passed to ``text()``
itself (``.option("wholetext", ...)`` is overridden by the keyword default),
and CSV/JSON inference is an extra job over the input, so a schema should be
given whenever it is known.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from datetime import datetime, timezone
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.session import fresh_dir
from tidewell.sources import sinks


def _reader(spark: SparkSession, schema=None, glob: str | None = None, recursive: bool = False,
            modified_after: str | None = None, modified_before: str | None = None,
            time_zone: str | None = None, ignore_corrupt: bool = False):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if modified_before:
        r = r.option("modifiedBefore", modified_before)
    if time_zone:
        r = r.option("timeZone", time_zone)
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    return r


def _finish(r, options: dict | None):
    """Explicit option maps go last, so they win over the keyword presets."""
    return r.options(**options) if options else r


def read_csv(spark: SparkSession, path, header: bool = True, infer: bool = False, sep: str | None = None,
             schema: StructType | str | None = None, options: dict | None = None, **kw) -> DataFrame:
    """S1-S5.  ``infer=False`` keeps every column a string."""
    r = _reader(spark, schema, **kw).option("header", str(header).lower())
    if infer and schema is None:
        r = r.option("inferSchema", "true")
    if sep:
        r = r.option("sep", sep)
    return _finish(r, options).csv(path)


def read_json(spark: SparkSession, path, primitives_as_string: bool = False,
              schema: StructType | str | None = None, options: dict | None = None, **kw) -> DataFrame:
    """JSON lines; nested objects become structs, fields sorted by name."""
    r = _reader(spark, schema, **kw)
    if primitives_as_string:
        r = r.option("primitivesAsString", "true")
    return _finish(r, options).json(path)


def infer_json_schema(df: DataFrame, column: str) -> StructType:
    """The schema Spark infers from a column of JSON texts (one job)."""
    spark = df.sparkSession
    texts = df.select(F.col(column).cast("string"))._jdf
    strings = getattr(texts, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(spark._jsparkSession.read().json(strings), spark).schema


def parse_json_column(df: DataFrame, column: str, schema: StructType | str | None = None,
                      alias: str | None = None) -> DataFrame:
    """Parse a JSON text column per row; without ``schema`` it is inferred
    from the whole column first."""
    return df.withColumn(alias or column, F.from_json(F.col(column), infer_json_schema(df, column) if schema is None else schema))


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False,
                 schema: StructType | str | None = None, options: dict | None = None, **kw) -> DataFrame:
    """One or several paths; ``merge_schema`` unions the file
    schemas.  Give ``schema`` when the folder may hold unreadable files:
    inference could otherwise pick one of them."""
    r = _reader(spark, schema, **kw)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return _finish(r, options).parquet(*paths)


def read_text(spark: SparkSession, path, line_sep: str | None = None, whole: bool = False,
              options: dict | None = None, **kw) -> DataFrame:
    """One row per line, per custom separator, or per file."""
    r = _finish(_reader(spark, None, **kw), options)
    if whole:
        return r.text(path, wholetext=True)
    if line_sep is not None:
        return r.text(path, lineSep=line_sep)
    return r.text(path)


#: Folders of ``read_text_files`` read at a time.
_FOLDERS_AT_ONCE = 16


def read_text_files(spark: SparkSession, written: list[tuple[str, str, int]]) -> DataFrame:
    """S18 over the files of ``sinks.write_text_files``: ``label`` from a file's
    name and ``value``, its text.  Several folders are read into Parquet, which is
    returned, each by a job of its own and some at a time: the driver holds the
    lists of these alone, and the tasks of one read that share a JVM wait for each
    other at every file, where Spark copies the read's Hadoop settings under a lock."""
    by_folder = defaultdict(dict)
    for folder, attempt, n in written:
        by_folder[folder][attempt] = n
    name = F.col("_metadata.file_name")

    def of(folder: str, tasks: int) -> DataFrame:
        # Spark plans a task for every few files
        read = read_text(spark, folder, whole=True).where(sinks.file_attempt(name).isin([*by_folder[folder]])).coalesce(tasks)
        return read.select(sinks.file_label(name).alias("label"), "value")

    if len(by_folder) == 1:
        (folder, counts), = by_folder.items()
        return of(folder, max(1, -(-sum(counts.values()) // sinks._FILES_PER_TASK)))
    out, cores = fresh_dir(spark, "texts"), spark.sparkContext.defaultParallelism
    parts = [(folder, f"{out}/{k:05d}") for k, folder in enumerate(sorted(by_folder))]
    threads = min(cores, _FOLDERS_AT_ONCE)

    def read_one(folder: str, to: str) -> None:
        of(folder, -(-cores // threads)).write.option("compression", "zstd").parquet(to)

    with ThreadPoolExecutor(threads) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(partial(read_one, *x))) for x in parts]
        wait(jobs, return_when=FIRST_EXCEPTION)
        for job in jobs:
            job.cancel()  # those that wait, if one failed
    for job in jobs:
        if not job.cancelled():
            job.result()
    return spark.read.schema("label string, value string").parquet(*(to for _, to in parts))


def set_modified(spark: SparkSession, folder: str, when: str) -> None:
    """Gives the files directly in ``folder`` a modification time (UTC)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    ms = int(datetime.fromisoformat(when).replace(tzinfo=timezone.utc).timestamp() * 1000)
    for st in fs.listStatus(p):
        fs.setTimes(st.getPath(), ms, -1)


def sql_on_file(spark: SparkSession, fmt: str, path: str, where: str | None = None,
                columns: str = "*") -> DataFrame:
    """``SELECT ... FROM fmt.`path```."""
    q = f"SELECT {columns} FROM {fmt}.`{path}`"
    if where:
        q += f" WHERE {where}"
    return spark.sql(q)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, fetch_size: int | None = None) -> DataFrame:
    """S19.  With ``partition_column`` the read is split into
    ``num_partitions`` range queries that run in parallel, instead of one
    task pulling the whole table."""
    props = dict(properties or {})
    if fetch_size:
        props["fetchsize"] = str(fetch_size)
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)
