"""Folders whose files do not fit together (S5, S11): CSV files with unlike
headers, unreadable files, records that do not parse."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.operators.evolve import SchemaClashError
from tidewell.session import fresh_dir

PATH = "_metadata.file_path"


def _listed(uri: str) -> str:
    """A listed file as ``_metadata.file_path`` writes it (one slash after the
    scheme of a path without host)."""
    return re.sub(r"^([A-Za-z][\w+.-]*):///", r"\1:/", uri)


def _to_read(uri: str) -> str:
    """A file path as Spark's readers take it: not encoded, no glob characters."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


# --- S5: CSV files with unlike headers --------------------------------------

def csv_headers(spark: SparkSession, path, glob: str | None = "*.csv", sep: str = ",",
                recursive: bool = False) -> list[tuple[list[str], list[str]]]:
    """(columns, files) of each header in a folder, the first by file name first.

    One distributed pass over the text keeps the first line of each file: a
    minimum per file, taken within the tasks first.  The driver gets a row per
    file, as it does when Spark lists the folder.  Files without a line have no
    header and no rows; a header stands on one line."""
    r = spark.read
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    try:
        lines = r.text(path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return []
        raise
    first = lines.filter(F.col("_metadata.file_block_start") == 0).filter(F.trim("value") != "") \
        .select(F.col(PATH).alias("file"), "value", F.monotonically_increasing_id().alias("place")) \
        .groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():
        found.setdefault(r["header"].lstrip("﻿").rstrip("\r"), []).append(r["file"])
    out = []
    for header, names in found.items():
        columns = next(csv.reader([header], delimiter=sep))
        lower = [c.lower() for c in columns]
        if len(set(lower)) < len(lower):
            raise SchemaClashError(f"{names[0]}: a column stands twice in the header {header!r}")
        out.append((columns, names))
    return out


def read_csv_folder(spark: SparkSession, path, glob: str | None = "*.csv", sep: str = ",", recursive: bool = False,
                    options: dict | None = None) -> DataFrame:
    """All rows of a folder of CSV files whose headers differ: one scan per
    header, put together by column name (whatever its case, as the first header writes
    it); a column that a file lacks is null there.  Columns stand in the order
    in which the files, by name, bring them.  All columns are strings (see
    :func:`tidewell.operators.profile.typed`).  No file: no columns."""
    groups = csv_headers(spark, path, glob, sep, recursive)
    names: dict[str, str] = {}
    for columns, _ in groups:
        for c in columns:
            names.setdefault(c.lower(), c)
    out = None
    for columns, files in groups:
        schema = StructType([StructField(names[c.lower()], StringType()) for c in columns])
        r = spark.read.schema(schema).option("header", "true").option("sep", sep).option("enforceSchema", "true")
        part = (r.options(**options) if options else r).csv([_to_read(x) for x in files])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        return spark.createDataFrame([], StructType([]))
    return out.select(*[F.col(f"`{c}`") for c in names.values()])


# --- S11: what a read skips ---------------------------------------------------

@dataclass
class Intake:
    """``good``: the rows; ``quarantine``: (file, record, reason) of everything
    that is no row; ``account``: a row per file with its bytes, good rows, bad records
    and status (``read``, ``partly``, ``empty``, ``unreadable``)."""
    good: DataFrame
    quarantine: DataFrame
    account: DataFrame


MALFORMED = "record does not fit the schema"
NO_MAGIC = "not a Parquet file"
BROKEN = "no record could be read"


def read_with_quarantine(spark: SparkSession, path, fmt: str, schema: StructType | str, options: dict | None = None,
                         glob: str | None = None, recursive: bool = False) -> Intake:
    """Reads ``csv``, ``json`` or ``parquet`` files once: rows and malformed
    records are written side by side, with their file, to the shared folder, in one pass.
    Unreadable files do not end the read.  Files that gave nothing are then looked at
    once more, these only, for a reason.

    A file that breaks off in its middle (a cut gzip stream) counts as ``read``
    with the rows before the break: Spark's reader does not tell."""
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError("fmt must be csv, json or parquet")
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    record = "_record"
    while record in {f.name for f in fields}:
        record = "_" + record

    def reader(names=None):
        r = spark.read.option("ignoreCorruptFiles", "true")
        if names is None and glob:
            r = r.option("pathGlobFilter", glob)
        if names is None and recursive:
            r = r.option("recursiveFileLookup", "true")
        return r

    r = reader()
    if fmt == "parquet":
        scanned = r.schema(StructType(fields)).options(**(options or {})).parquet(path).withColumn(record, F.lit(None).cast("string"))
    else:
        r = r.schema(StructType([*fields, StructField(record, StringType())])).option("mode", "PERMISSIVE") \
            .option("columnNameOfCorruptRecord", record).options(**(options or {}))
        scanned = r.csv(path) if fmt == "csv" else r.json(path)
    row = F.struct(*[F.col(f"`{f.name}`") for f in fields]) if fields else F.struct(F.lit(None).alias("none"))
    bad = F.col(record).isNotNull()
    kept = scanned.select(F.col(PATH).alias("file"), F.when(~bad, row).alias("row"), F.col(record).alias("record"),
                          F.when(bad, "bad").otherwise("good").alias("kind"))
    where = fresh_dir(spark, "intake")
    kept.write.partitionBy("kind").parquet(where)
    stored = spark.read.schema(kept.schema).parquet(where)
    good = stored.filter("kind = 'good'")
    malformed = stored.filter("kind = 'bad'").select("file", "record", F.lit(MALFORMED).alias("reason"))

    # the files themselves, from the listing (files of no bytes get no task): the content is not read
    files = reader().format("binaryFile").load(path)
    listed = spark.createDataFrame([(_listed(x),) for x in files.inputFiles()], "file string").join(
        files.select(F.col(PATH).alias("file"), F.col("length").alias("bytes")), "file", "left").na.fill(0, ["bytes"])
    counts = stored.groupBy("file").agg(F.count_if(F.col("kind") == "good").alias("good_rows"),
                                        F.count_if(F.col("kind") == "bad").alias("bad_records"))
    account = listed.join(counts, "file", "left").na.fill(0, ["good_rows", "bad_records"])
    silent = account.filter("good_rows + bad_records = 0")
    names = [x["file"] for x in silent.filter("bytes > 0").select("file").collect()]
    reasons = _reasons(spark, fmt, names, reader)
    account = account.join(reasons, "file", "left").select(
        "file", "bytes", "good_rows", "bad_records",
        F.when(F.col("reason").isNotNull(), "unreadable").when(F.col("good_rows") + F.col("bad_records") == 0, "empty")
        .when(F.col("bad_records") > 0, "partly").otherwise("read").alias("status"))
    quarantine = malformed.unionByName(reasons.select("file", F.lit(None).cast("string").alias("record"), "reason"))
    return Intake(good.select("row.*") if fields else good.select(), quarantine, account)


def _reasons(spark: SparkSession, fmt: str, names: list[str], reader) -> DataFrame:
    """(file, reason) of the files among ``names`` that cannot be read; the
    others have no rows.  Reads these files' bytes, or, for texts, their lines."""
    empty = spark.createDataFrame([], "file string, reason string")
    if not names:
        return empty
    if fmt == "parquet":
        content = spark.read.format("binaryFile").load([_to_read(x) for x in names])
        magic = F.lit(bytearray(b"PAR1"))
        whole = (F.substring("content", 1, 4) == magic) & (F.substring(F.col("content"), -4, 4) == magic)
        # a Parquet file without rows keeps the marks of one; so does one with broken pages, told by its size in rows
        return content.select(F.col(PATH).alias("file"), F.when(~whole, NO_MAGIC).alias("reason")).filter("reason IS NOT NULL")
    lines = reader(names).text([_to_read(x) for x in names]).groupBy(F.col(PATH).alias("file")).agg(F.count("*").alias("n"))
    all_of = spark.createDataFrame([(x,) for x in names], "file string")
    return all_of.join(lines, "file", "left_anti").select("file", F.lit(BROKEN).alias("reason"))
