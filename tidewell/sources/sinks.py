"""Writer presets (K1-K12).  Each returns the path or table name written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidewell.session import materialize

#: Files one task of ``write_text_per_key`` makes, about, and that a task of
#: ``write_text_files`` puts into one folder in a row; their number is the work, not their bytes.
_FILES_PER_TASK = 1000

#: Files in one folder of ``write_text_files``, about; a job reads a folder.
_FILES_PER_FOLDER = 10_000

#: Local files without a ``.crc`` beside each: one child process (``chmod``) a
#: file instead of four.  Paths of other file systems do not look at it.
_PLAIN_LOCAL = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None,
                  options: dict | None = None) -> str:
    """K1/K5.  Never overwrite the path being read: write a new version
    directory instead (see :mod:`tidewell.sources.tables`)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if options:
        w = w.options(**options)
    w.parquet(path)
    return path


def write_orc(df: DataFrame, path: str, bloom_columns: list[str] = (), bloom_fpp: float = 0.05,
              dictionary_threshold: float | None = None, direct_encoding: list[str] = (),
              mode: str = "overwrite") -> str:
    """K2: ORC with bloom filters, dictionary key threshold, direct encoding."""
    w = df.write.mode(mode).format("orc")
    if bloom_columns:
        w = w.option("orc.bloom.filter.columns", ",".join(bloom_columns))
        w = w.option("orc.bloom.filter.fpp", str(bloom_fpp))
    if dictionary_threshold is not None:
        w = w.option("orc.dictionary.key.threshold", str(dictionary_threshold))
    if direct_encoding:
        w = w.option("orc.column.encoding.direct", ",".join(direct_encoding))
    w.save(path)
    return path


def write_parquet_tuned(df: DataFrame, path: str, bloom_ndv: dict | None = None,
                        dictionary: bool = True, page_checksum: bool = False,
                        mode: str = "overwrite") -> str:
    """K3: Parquet with per-column bloom filters (and expected distinct
    counts), dictionary encoding on/off, page checksums on/off."""
    w = df.write.mode(mode).format("parquet")
    for c, ndv in (bloom_ndv or {}).items():
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
        if ndv:
            w = w.option(f"parquet.bloom.filter.expected.ndv#{c}", str(ndv))
    w = w.option("parquet.enable.dictionary", str(dictionary).lower())
    w = w.option("parquet.page.write-checksum.enabled", str(page_checksum).lower())
    w.save(path)
    return path


def save_bucketed(df: DataFrame, table: str, buckets: int, by, sort_by=None, partition_by=None,
                  path: str | None = None, mode: str = "overwrite") -> str:
    """K4/K6: bucketed (and sorted, and partitioned) catalog table.  Later
    joins and aggregations on ``by`` with the same bucket count skip the
    shuffle.  ``path`` keeps the files in a shared location of choice."""
    by = [by] if isinstance(by, str) else list(by)
    folders = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    # rows of a bucket (and folder) meet in one task, hashed as Spark's own
    # bucketing does: one file per bucket and folder, not one per task
    df = df.repartition(buckets, *by) if not folders else df.repartition(*folders, F.pmod(F.hash(*by), F.lit(buckets)))
    w = df.write.mode(mode).format("parquet")
    if folders:
        w = w.partitionBy(*folders)
    w = w.bucketBy(buckets, *by)
    if sort_by:
        w = w.sortBy(*([sort_by] if isinstance(sort_by, str) else sort_by))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return table


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str | None = None,
              mode: str = "errorifexists") -> str:
    """K7.  The reference writes without a mode, so a second run fails;
    the default here is the same."""
    w = df.write.mode(mode).option("header", str(header).lower())
    if sep:
        w = w.option("sep", sep)
    w.csv(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def write_text(df: DataFrame, path: str, compression: str | None = None, line_sep: str | None = None,
               mode: str = "overwrite") -> str:
    """K8: one string column; optional codec (gzip, ...) and line separator."""
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if line_sep is not None:
        w = w.option("lineSep", line_sep)
    w.text(path)
    return path


def write_text_per_key(df: DataFrame, path: str, column: str, key: list[str]) -> DataFrame:
    """The counterpart of S18: a file for each value of ``key`` holding its
    rows' texts in their order, all files in one folder.  A folder per value
    (``partitionBy``) is a second thing to make for each and has to be listed by
    itself.  Returns ``key`` with ``file``, which ``file_number`` gives for the
    file's name: Spark names a file after its task and its place there, and the
    keys alone, dealt and sorted as the texts are, have the same two numbers."""
    tasks = max(1, -(-df.count() // _FILES_PER_TASK))
    lines = df.select(*key, F.struct(F.monotonically_increasing_id().alias("row"), F.col(column).alias("text")).alias("line"))
    texts = F.transform(F.array_sort(F.collect_list("line")), lambda x: x["text"])
    whole = lines.repartition(tasks, *key).groupBy(*key).agg(F.array_join(texts, "\n", "").alias(column))
    w = whole.sortWithinPartitions(*key).select(column).write
    w.option("maxRecordsPerFile", 1).options(**_PLAIN_LOCAL).text(path)
    keys = df.select(*key).repartition(tasks, *key).distinct().sortWithinPartitions(*key)
    return materialize(keys.withColumn("file", F.monotonically_increasing_id()), label="keys")


def file_number(name):
    """The number of a file of ``write_text_per_key`` from its name, laid out as
    ``monotonically_increasing_id`` does: the task above 33 bits of place."""
    def part(group):
        return F.regexp_extract(name, r"^part-(\d+)-.*-c(\d+)\.", group).cast("long")
    return F.shiftleft(part(1), 33) + part(2)


def mounted(spark, path: str) -> str | None:
    """``path`` as the operating system has it, if it lies on disks or shares
    mounted there and not in a store that only Hadoop reaches."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def write_text_files(df: DataFrame, path: str, column: str, key: list[str], name: str) -> list[tuple[str, str, int]]:
    """``write_text_per_key`` for a mounted ``path``, where Spark's writer starts
    a child process (``chmod``) for each file: the tasks open the files
    themselves, and texts are dealt only where a key comes again.  A file's name
    has ``name``, a whole number of ``key`` (``file_label``).  Returns folders
    (``path`` itself if one is enough), the attempts whose files in them count
    (``file_attempt``; a failed task's lie beside them) and how many these are."""
    spark, root = df.sparkSession, mounted(df.sparkSession, path)
    if root is None:
        raise ValueError(f"{path} is not on a mounted file system")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hadoop.Path(path))
    folders, run = max(1, -(-df.count() // _FILES_PER_FOLDER)), min(_FILES_PER_TASK, _FILES_PER_FOLDER)

    lines = df.select(*key, F.monotonically_increasing_id().alias("row"), F.coalesce(column, F.lit("")).alias("text"))
    whole = lines.select(name, "text")
    again = materialize(df.groupBy(*key).count().where("count > 1").select(*key), label="again")
    if not again.isEmpty():
        same = reduce(lambda a, b: a & b, [lines[k].eqNullSafe(again[k]) for k in key])
        texts = F.transform(F.array_sort(F.collect_list(F.struct("row", "text"))), lambda x: x["text"])
        many = lines.join(again, same, "left_semi").groupBy(*key).agg(F.array_join(texts, "\n").alias("text"))
        whole = lines.join(again, same, "left_anti").select(name, "text").union(many.select(name, "text"))

    def put(batches):
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        task, n, made = TaskContext.get(), 0, {}
        attempt = f"{task.partitionId():05d}-{task.taskAttemptId()}"
        for b in batches:
            for label, text in zip(*(c.to_pylist() for c in b.columns)):
                folder = f"{(task.partitionId() + n // run) % folders:05d}" if folders > 1 else "."
                if folder not in made:
                    os.makedirs(f"{root}/{folder}", exist_ok=True)
                with open(f"{root}/{folder}/part-{attempt}-c{n:06d}-{label}.txt", "xb") as f:
                    f.write(text)
                made[folder] = made.get(folder, 0) + 1
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([*made], pa.string()), pa.array([attempt] * len(made), pa.string()),
                                          pa.array([*made.values()], pa.int64())], names=["folder", "attempt", "files"])

    lined = whole.select(F.coalesce(F.col(name).cast("string"), F.lit("")).alias("label"),
                         F.concat("text", F.lit("\n")).cast("binary").alias("text"))
    found = lined.mapInArrow(put, "folder string, attempt string, files long").collect()
    return [(f"{path}/{r['folder']}" if folders > 1 else path, r["attempt"], r["files"]) for r in found] or [(path, "", 0)]


def file_attempt(name):
    """The attempt that made a file of ``write_text_files``, from its name."""
    return F.regexp_extract(name, r"^part-(\d+-\d+)-c\d+-", 1)


def file_label(name):
    """What a file of ``write_text_files`` is named for; null if that is null."""
    label = F.regexp_extract(name, r"^part-\d+-\d+-c\d+-(.*)\.txt$", 1)
    return F.when(label != "", label)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               mode: str = "append", column_types: str | None = None,
               batch_size: int | None = None, num_partitions: int | None = None) -> str:
    """K9.  ``num_partitions`` caps concurrent connections; ``column_types``
    sets the DDL types of a created table (``createTableColumnTypes``)."""
    props = dict(properties or {})
    if column_types:
        props["createTableColumnTypes"] = column_types
    if batch_size:
        props["batchsize"] = str(batch_size)
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, table, mode=mode, properties=props)
    return table


def replace_table(df: DataFrame, table: str, path: str | None = None) -> str:
    """Create or replace a catalog table from a frame (built-in tables
    reject ``writeTo().createOrReplace()``)."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return table


def append_by_name(df: DataFrame, table: str) -> str:
    """Append matching columns by name, not position."""
    df.write.mode("append").format("parquet").saveAsTable(table)
    return table


def drop_partitions(spark, table: str, spec: dict) -> None:
    """M7 when the predicate is a partition value: a metadata delete on a
    partitioned catalog table (``ALTER TABLE ... DROP PARTITION``); no data
    file is read or rewritten."""
    def lit(v):
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    parts = ", ".join(f"`{k}` = {lit(v)}" for k, v in spec.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({parts})")
