"""Parquet tables that a MERGE can publish to.

A table is a folder of version folders written by ordinary Spark jobs::

    <root>/tw_version=000007__<job>__<batch>/            full: every row
    <root>/tw_version=000008p__<job>__<batch>/bucket=3/  partial: the new rows of
    <root>/tw_version=000008p__<job>__<batch>/bucket=9/  the folders it replaces
    <root>/tw_version=000009a__<job>__<batch>/           append: new rows only

A version counts once its ``_SUCCESS`` marker exists; a half-written one is
ignored and later overwritten.  The current rows are the newest full version,
each layout folder (hash bucket, or the one partition column) replaced by its
newest partial copy, plus the appended rows after that.  One writer per table.

``merge_touched`` reads and rewrites only the buckets the batch's keys fall into
(``bucket = pmod(xxhash64(key), n)``), at every table size: O(touched buckets +
batch).  A merge that touches a bucket also folds the appends made to it.
The layout (key, number of buckets, partition columns) is stored in
``_layout`` with the first version; opening the table with another one fails.

Exactly once: a (job, batch) that was published leaves a marker in ``_done``,
which compaction and ``vacuum`` do not touch, so a replayed micro-batch is
skipped.  ``vacuum`` deletes the folders that hold none of the current rows.

File-system calls go through Hadoop's ``FileSystem`` on the driver: names of
versions and layout folders only, never of data files.
"""

from __future__ import annotations

import json
import math
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from tidewell.functions import bucket as bucket_col, guard_not_null

# Read with the table root as base path, Spark sees the version folder as a
# partition column of this name, which the reader drops.
VERSION_COL = "tw_version"
_VERSION_DIR = re.compile(r"^" + VERSION_COL + r"=(\d+)([pa]?)__(.*)__(-?\d+)$")
_NO_SUCCESS = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


class LayoutError(ValueError):
    """The table was written with another layout."""


@dataclass(frozen=True)
class Version:
    number: int
    job: str
    batch: int
    path: str
    committed: bool
    kind: str = ""          # "" full, "p" partial (folder replacement), "a" append

    @property
    def partial(self) -> bool:
        return self.kind == "p"

    @property
    def full(self) -> bool:
        return self.kind == ""


def buckets_for(input_bytes: int, bytes_per_bucket: int = 256 * 1024 * 1024, lo: int = 8) -> int:
    """A bucket count for a new table: about ``bytes_per_bucket`` of input per
    bucket, a power of two, ``lo`` at least, so that small batches stay local in
    small tables too.  Fixed for the table's life."""
    want = max(lo, math.ceil(max(input_bytes, 0) / bytes_per_bucket))
    return 1 << (want - 1).bit_length()


class _FS:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.jvm = jvm
        self.Path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.Path(p))

    def delete(self, p: str) -> bool:
        return self.fs.delete(self.Path(p), True)

    def glob(self, pattern: str) -> list[tuple[str, str]]:
        """(name, parent's name) of every path matching ``pattern``: one metadata call."""
        found = self.fs.globStatus(self.Path(pattern))
        paths = [st.getPath() for st in found] if found is not None else []
        return [(p.getName(), p.getParent().getName()) for p in paths]

    def mkdirs(self, p: str) -> bool:
        return self.fs.mkdirs(self.Path(p))

    def put(self, p: str, text: str = "") -> None:
        out = self.fs.create(self.Path(p), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def get(self, p: str) -> str:
        stream = self.fs.open(self.Path(p))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None,
                 partition_by: list[str] | None = None, bucket_key: str | None = None,
                 buckets: int | None = None, bucket_expr: str | None = None):
        """``bucket_key``: a column hashed into ``buckets``; or ``bucket_expr``:
        a SQL expression over the row for MERGEs joined on a derived key, so
        rows that match share a bucket."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.partition_by = list(partition_by or [])
        self.bucket_expr = bucket_expr
        self.bucket_key = bucket_key or (f"expr:{bucket_expr}" if bucket_expr else None)
        self.buckets = buckets
        self._fs = _FS(spark, self.path)
        self._check_layout()

    # -- layout ---------------------------------------------------------------
    def _layout(self) -> dict:
        return {"bucket": self.bucket_key, "buckets": self.buckets if self.bucket_key else None,
                "partition_by": self.partition_by}

    def _check_layout(self) -> None:
        """Takes the stored layout over what was not given, refuses any other."""
        if not self._fs.exists(f"{self.path}/_layout"):
            return
        stored = json.loads(self._fs.get(f"{self.path}/_layout"))
        if self.bucket_key is None and not self.partition_by:
            self.bucket_key, self.buckets, self.partition_by = stored["bucket"], stored["buckets"], stored["partition_by"]
            if self.bucket_key and self.bucket_key.startswith("expr:"):
                self.bucket_expr = self.bucket_key[5:]
        elif self.bucket_key and self.buckets is None:
            self.buckets = stored["buckets"]
        if self._layout() != stored:
            raise LayoutError(f"{self.path} has layout {stored}, not {self._layout()}")

    def _layout_col(self) -> str | None:
        """The one folder level partial versions replace."""
        if self.bucket_key:
            return "bucket"
        return self.partition_by[0] if len(self.partition_by) == 1 else None

    # -- versions -------------------------------------------------------------
    def versions(self) -> list[Version]:
        """All version folders, committed or not: two metadata calls."""
        done = {parent for _, parent in self._fs.glob(f"{self.path}/{VERSION_COL}=*/_SUCCESS")}
        out = []
        for name, _ in self._fs.glob(f"{self.path}/{VERSION_COL}=*"):
            m = _VERSION_DIR.match(name)
            if m:
                out.append(Version(int(m.group(1)), m.group(3), int(m.group(4)), f"{self.path}/{name}",
                                   name in done, m.group(2)))
        return sorted(out, key=lambda v: v.number)

    def current(self) -> Version | None:
        done = [v for v in self.versions() if v.committed]
        return done[-1] if done else None

    def chain(self, upto: int | None = None) -> list[Version]:
        """The newest full version (up to ``upto``) and the committed ones after it."""
        done = [v for v in self.versions() if v.committed and (upto is None or v.number <= upto)]
        fulls = [v for v in done if v.full]
        return done if not fulls else [v for v in done if v.number >= fulls[-1].number]

    def _folders(self, chain: list[Version]) -> dict[str, dict[str, str]]:
        """Layout folders of each version of ``chain``, from one glob."""
        out: dict[str, dict[str, str]] = {v.path: {} for v in chain}
        for folder, version in self._fs.glob(f"{self.path}/{VERSION_COL}=*/{self._layout_col()}=*"):
            if f"{self.path}/{version}" in out:
                out[f"{self.path}/{version}"][folder] = f"{self.path}/{version}/{folder}"
        return out

    def folders_of(self, v: Version) -> list[str]:
        return sorted(self._folders([v])[v.path])

    def _paths(self, chain: list[Version], keys: set[str] | None = None) -> list[str]:
        """Folders holding the rows: per layout folder its newest full or
        partial copy and the appends after it; without layout, the versions."""
        if self._layout_col() is None or (len(chain) == 1 and keys is None):
            return [v.path for v in chain]
        index = self._folders(chain)
        owner: dict[str, list[str]] = {}
        for v in chain:
            for k, p in index[v.path].items():
                owner[k] = owner.get(k, []) + [p] if v.kind == "a" else [p]
        return [p for k in sorted(owner) if keys is None or k in keys for p in owner[k]]

    # -- read -----------------------------------------------------------------
    def _stored_schema(self) -> StructType:
        s = StructType(list(self.schema.fields))
        if self.bucket_key and "bucket" not in s.fieldNames():
            s = s.add("bucket", IntegerType())
        return s

    def _read_paths(self, paths: list[str]) -> DataFrame:
        if not paths:
            if self.schema is None:
                raise ValueError(f"{self.path} has no rows and no declared schema")
            return self.spark.createDataFrame([], self.schema)
        r = self.spark.read.option("basePath", self.path)
        if self.schema is not None:
            r = r.schema(self._stored_schema().add(VERSION_COL, StringType()))
        df = r.parquet(*paths).drop(VERSION_COL)
        if self.schema is not None:
            return df.select(*self.schema.fieldNames())
        return df.drop("bucket") if self.bucket_key else df

    def read(self, upto: int | None = None) -> DataFrame:
        """The current rows; with ``upto`` the rows as of that version, of those
        that ``vacuum`` has left."""
        return self._read_paths(self._paths(self.chain(upto)))

    def as_view(self, name: str) -> DataFrame:
        """The current rows under ``name``, for ``SELECT * FROM name`` and
        ``spark.table(name)``; call again after a publish."""
        df = self.read()
        df.createOrReplaceTempView(name)
        return df

    # -- write ----------------------------------------------------------------
    def _next(self) -> int:
        """The next version's number; stores the layout, drops half-written versions."""
        every = self.versions()
        n = max((v.number + 1 for v in every if v.committed), default=0)
        for stale in every:
            if stale.number >= n and not stale.committed:
                self._fs.delete(stale.path)
        self._check_layout()
        if not self._fs.exists(f"{self.path}/_layout"):
            self._fs.put(f"{self.path}/_layout", json.dumps(self._layout()))
        return n

    def _with_layout(self, df: DataFrame, balance: bool = True):
        out, parts = df, list(self.partition_by)
        if self.schema is not None:
            out = guard_not_null(out, self.schema)
        if self.bucket_key:
            out = out.withColumn("bucket", bucket_col(self._bucket_source(), self.buckets))
            parts = parts + ["bucket"]
        if parts and balance:
            # AQE splits a large folder over several tasks and joins small ones
            out = out.hint("rebalance", *parts)
        return out, parts

    def _write(self, out: DataFrame, parts: list[str], kind: str, job: str, batch: int) -> Version:
        n = self._next()
        p = f"{self.path}/{VERSION_COL}={n:06d}{kind}__{job}__{batch}"
        w = out.write.mode("overwrite")
        if parts:
            w = w.partitionBy(*parts)
        w.parquet(p)
        return self._done(Version(n, job, batch, p, True, kind))

    def _done(self, v: Version) -> Version:
        self._fs.put(f"{self.path}/_done/{v.job}__{v.batch}")
        return v

    def write(self, df: DataFrame, job: str = "batch", batch: int = 0) -> Version:
        """Write ``df`` as the next full version."""
        return self._write(*self._with_layout(df), "", job, batch)

    def published(self, job: str, batch: int) -> bool:
        """Whether this batch is in the table; true after upkeep as well."""
        return self._fs.exists(f"{self.path}/_done/{job}__{batch}") or any(
            v.committed and (v.job, v.batch) == (job, batch) for v in self.versions())

    def publish(self, build, job: str, batch: int) -> Version | None:
        """Write ``build(current_frame)`` as a full version unless
        ``(job, batch)`` is already published; None when skipped."""
        if self.published(job, batch):
            return None
        return self.write(build(self.read()), job, batch)

    def _bucket_source(self) -> Column:
        return F.expr(self.bucket_expr) if self.bucket_expr else F.col(self.bucket_key)

    def touched_buckets(self, source: DataFrame) -> list[int]:
        """Buckets of the source keys: at most ``buckets`` values.  The key is
        hashed as the table stores it (an int and a bigint 1 hash differently)."""
        k = self._bucket_source()
        if not self.bucket_expr:
            stored = self.schema if self.schema is not None else (self.read().schema if self.exists() else source.schema)
            k = k.cast(stored[self.bucket_key].dataType)
        c = bucket_col(k, self.buckets)
        return sorted(r[0] for r in source.select(c.alias("b")).distinct().collect())

    def merge_touched(self, source: DataFrame, on, matched=(), not_matched=(), job: str = "merge",
                      batch: int = 0, **kw) -> Version | None:
        """MERGE that reads and rewrites only the buckets the batch touches.

        The join must include plain equality on ``bucket_key`` (the same
        column name on both sides), or imply equal ``bucket_expr`` values, and
        updates must not change it, so that a row and its match always share
        a bucket."""
        from tidewell.operators.merge import merge
        if not self.bucket_key or self.partition_by:
            raise ValueError("merge_touched needs a bucket_key and no other partition columns")
        if not self.bucket_expr and self.bucket_key not in [o for o in on if isinstance(o, str)]:
            raise ValueError(f"the MERGE key must include {self.bucket_key!r} by name")
        if self.published(job, batch):
            return None
        touched = [f"bucket={b}" for b in self.touched_buckets(source)]
        paths = self._paths(self.chain(), set(touched))
        target = self._read_paths(paths) if paths or self.schema is not None else self.read().limit(0)
        out, _ = self._with_layout(merge(target, source, on, matched, not_matched, **kw))
        return self._write_partial(out, touched, job, batch)

    def _write_partial(self, out: DataFrame | None, folders: list[str], job: str, batch: int) -> Version:
        """A partial version replacing exactly ``folders`` (layout folders):
        ``out`` holds their new rows (None: all emptied); a folder that gets
        no rows is created empty, then the version is committed."""
        n = self._next()
        p = f"{self.path}/{VERSION_COL}={n:06d}p__{job}__{batch}"
        if out is not None:
            out.write.mode("overwrite").options(**_NO_SUCCESS).partitionBy(self._layout_col()).parquet(p)
        self._fs.mkdirs(p)
        filled = {name for name, _ in self._fs.glob(f"{p}/{self._layout_col()}=*")}
        for f in folders:
            if f not in filled:
                self._fs.mkdirs(f"{p}/{f}")        # emptied by this version
        self._fs.put(f"{p}/_SUCCESS")
        return self._done(Version(n, job, batch, p, True, "p"))

    def _aligned_folders(self, chain: list[Version], predicate: Column) -> list[str] | None:
        """The partition folders whose value satisfies ``predicate`` when it
        reads only the partition column (evaluated on the folder values, no
        data read); None when it reads any other column."""
        col = self._layout_col()
        if col is None or self.bucket_key:
            return None
        names = sorted({k for d in self._folders(chain).values() for k in d})
        if not names:
            return []
        dtype = (self.schema if self.schema is not None and col in self.schema.fieldNames()
                 else self.read().schema)[col].dataType
        raw = F.col("__raw")
        vals = (self.spark.createDataFrame([(k, unquote(k.split("=", 1)[1])) for k in names],
                                           "__folder string, __raw string")
                .withColumn(col, F.when(raw == "__HIVE_DEFAULT_PARTITION__", F.lit(None))
                                  .otherwise(raw).cast(dtype)))
        try:
            hit = vals.filter(F.coalesce(predicate, F.lit(False))).select("__folder").collect()
        except AnalysisException:
            return None
        return [r[0] for r in hit]

    # -- table operations -----------------------------------------------------
    def exists(self) -> bool:
        return self.current() is not None

    def create(self, replace: bool = False) -> Version | None:
        """An empty full version of the declared schema; a no-op if the
        table exists, unless ``replace``."""
        if self.schema is None:
            raise ValueError("create needs a declared schema")
        if self.exists() and not replace:
            return None
        return self.write(self.spark.createDataFrame([], self.schema), "create", 0)

    def drop(self) -> bool:
        """D3: remove the table's folder (explicit request only)."""
        return self._fs.delete(self.path)

    def replace(self, df: DataFrame, job: str = "replace", batch: int = 0) -> Version:
        return self.write(df, job, batch)

    def append(self, df: DataFrame, job: str | None = None, batch: int = 0) -> Version | None:
        """Add rows, matched by column name: O(new rows).  With a
        ``job``, (job, batch) is appended once only."""
        if job is not None and self.published(job, batch):
            return None
        out, parts = self._with_layout(df.select(*self.read().columns))
        return self._write(out, parts, "a", job or "append", batch)

    def delete_where(self, predicate: Column | str, job: str = "delete", batch: int = 0) -> Version:
        """M7: keeps the rows for which ``predicate`` is not TRUE.  If it reads
        only the partition column, whole folders go and no data is read;
        otherwise the rest of the table is rewritten."""
        p = F.expr(predicate) if isinstance(predicate, str) else predicate
        chain = self.chain()
        folders = self._aligned_folders(chain, p) if chain else None
        if folders is not None:
            return self._write_partial(None, folders, job, batch)
        return self.write(self.read().filter(~F.coalesce(p, F.lit(False))), job, batch)

    def delete_keys(self, keys: DataFrame, job: str = "delete_keys", batch: int = 0) -> Version | None:
        """M7 for a set of keys (a frame with the ``bucket_key`` column),
        rewriting just the buckets those keys fall into."""
        from tidewell.operators.merge import delete
        k = keys.select(self.bucket_key).distinct()
        return self.merge_touched(k, [self.bucket_key], [delete()], [], job, batch, cardinality="off")

    def merge(self, source: DataFrame, on, matched=(), not_matched=(), job: str = "merge",
              batch: int = 0, **kw) -> Version | None:
        from tidewell.operators.merge import merge
        return self.publish(lambda t: merge(t, source, on, matched, not_matched, **kw), job, batch)

    def data_files(self) -> DataFrame:
        """file and rows of every data file of the current rows, by a Spark job."""
        return self.read().groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))

    def compact(self, target_bytes: int = 512 * 1024 * 1024, job: str = "compact",
                where: Column | str | None = None) -> Version:
        """Rewrite the current rows into files of about ``target_bytes``;
        each layout folder gets its share, ceil(its size / target) files.
        Without folders the stored files' splits are joined, not shuffled, so that a
        task reads about ``target_bytes`` of files instead of as many rows unpacked.
        ``where`` on the partition column compacts only those folders."""
        from tidewell.operators.merge import estimated_bytes
        chain, folders = self.chain(), None
        if where is not None:
            folders = self._aligned_folders(chain, F.expr(where) if isinstance(where, str) else where)
        df = self._read_paths(self._paths(chain, set(folders) if folders else None))
        out, parts = self._with_layout(df, balance=False)
        size = estimated_bytes(df)                        # of the files, no job
        if not parts:
            files = max(1, math.ceil(size / target_bytes))
            whole = out.rdd.getNumPartitions() >= files   # else files smaller than a split
            return self._write(out.coalesce(files) if whole else out.repartition(files), parts, "", job, 0)
        # rows per layout folder, at most one row per folder
        counted = out.groupBy(*parts).agg(F.count(F.lit(1)).alias("__n")).collect()
        per_row = size / max(1, sum(r["__n"] for r in counted))
        shares = [(tuple(r[p] for p in parts), max(1, math.ceil(r["__n"] * per_row / target_bytes))) for r in counted]
        plan = self.spark.createDataFrame(
            [(*key, files, at) for (key, files), at in zip(shares, _running([f for _, f in shares]))],
            StructType([out.schema[p] for p in parts]).add("__files", IntegerType()).add("__at", IntegerType()))
        same = [out[p].eqNullSafe(plan[p]) for p in parts]
        spread = out.join(F.broadcast(plan), same).select(
            *(out[c] for c in out.columns), (plan["__at"] + F.pmod(F.monotonically_increasing_id(), plan["__files"])).cast("int").alias("__to"))
        placed = spread.repartitionById(max(1, sum(f for _, f in shares)), F.col("__to")).drop("__to")
        if folders:
            return self._write_partial(placed, folders, job, 0)
        return self._write(placed, parts, "", job, 0)

    def repartition_by(self, columns: list[str] | dict, job: str = "layout") -> Version:
        """Rewrite under a new partition layout.  ``columns`` may map
        new column names to expressions, e.g. ``{"month": date_format(ts,
        'yyyy-MM')}``."""
        df = self.read()
        names = list(columns)
        if isinstance(columns, dict):
            df = df.withColumns(columns)
        if self.schema is not None:
            for nm in names:
                if nm not in self.schema.fieldNames():
                    self.schema = self.schema.add(nm, df.schema[nm].dataType)
        self._fs.delete(f"{self.path}/_layout")
        self.partition_by, self.bucket_key, self.bucket_expr, self.buckets = names, None, None, None
        return self.write(df, job, 0)

    def vacuum(self) -> list[str]:
        """Deletes the version folders that hold none of the current rows."""
        chain = self.chain()
        if not chain:
            return []
        used = {p[len(self.path) + 1:].split("/", 1)[0] for p in self._paths(chain)}
        # emptied folders count: dropping them would bring older rows back
        used |= {v.path[len(self.path) + 1:] for v in chain if v.full or v.number == chain[-1].number or self._empties(v, chain)}
        gone = [v for v in self.versions() if v.committed and v.path[len(self.path) + 1:] not in used]
        for v in gone:
            self._fs.delete(v.path)
        return [v.path for v in gone]

    def _empties(self, v: Version, chain: list[Version]) -> bool:
        return v.partial and any(set(self.folders_of(v)) & set(self.folders_of(o)) for o in chain if o.number < v.number)


def _running(counts: list[int]) -> list[int]:
    out, total = [], 0
    for c in counts:
        out.append(total)
        total += c
    return out
