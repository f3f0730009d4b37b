"""Silver tables kept bucketed and sorted on the MERGE key.

The table is a Spark catalog table, bucketed and sorted on the key columns and a
salt.  MERGE joins it bucket by bucket: the batch is shuffled into the table's
buckets, the table is not shuffled, neither for the join nor for writing the next
version, whose files are bucketed alike.

The salt is 0 for ordinary rows.  Rows of a *hot* key (more rows than an average
bucket) and rows with a null key are dealt over several salts, so that no bucket
task gets them all; a batch row of a hot key is sent to each of its salts.  Hot
keys are looked for in oversized buckets only, and there are at most as many as
buckets.

Each MERGE writes a whole new version beside the old one; readers go through
:meth:`BucketedTable.read`.  For batches that touch few buckets
``SnapshotTable.merge_touched`` rewrites less; this form is for batches spread over
all of them.  One writer per table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidewell.functions import guard_not_null
from tidewell.operators.merge import Clause, _check_cardinality, merge
from tidewell.session import materialize
from tidewell.sources.tables import _FS

SALT = "_salt"
_VERSION = re.compile(r"^v(\d+)(?:__(.+)__(-?\d+))?$")


class BucketedTable:
    # Versions are folders v<n> or v<n>__<job>__<batch> with a _SUCCESS marker each;
    # hot/v<n> has the hot keys of version n, done/<job>__<batch> outlives vacuum.
    def __init__(self, spark: SparkSession, name: str, path: str, schema: StructType,
                 keys: list[str], buckets: int):
        """``name``: prefix of the catalog tables (one per version); ``path``:
        the shared folder that holds the versions.  An existing folder is taken up
        again, in a catalog that does not know it too."""
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        self.schema, self.keys, self.buckets = schema, list(keys), int(buckets)
        self._fs = _FS(spark, self.path)

    # -- versions -----------------------------------------------------------
    def _folders(self) -> dict[int, str]:
        """Folder of each committed version, by number."""
        done = self._fs.glob(f"{self.path}/v*/_SUCCESS")
        return {int(m[1]): parent for _, parent in done if (m := _VERSION.match(parent))}

    def versions(self) -> list[int]:
        return sorted(self._folders())

    def published(self, job: str, batch: int) -> bool:
        """Whether the batch of this job is in the table, vacuumed or not."""
        return self._fs.exists(f"{self.path}/done/{job}__{batch}") or any(
            (m := _VERSION.match(f)) and m[2] == job and m[3] == str(batch) for f in self._folders().values())

    def _table(self, version: int) -> str:
        return f"{self.name}_v{version}"

    def _stored(self) -> DataFrame:
        """The current rows with their salt, as a bucketed scan."""
        found = self._folders()
        if not found:
            return self.spark.createDataFrame([], self.schema).withColumn(SALT, F.lit(0))
        newest = max(found)
        table = self._table(newest)
        if not self.spark.catalog.tableExists(table):
            # another session wrote it: the files carry their bucket in their names
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
            by = ", ".join(f"`{c}`" for c in [*self.keys, SALT])
            self.spark.sql(f"CREATE TABLE {table} ({columns}, `{SALT}` INT) USING parquet CLUSTERED BY ({by}) "
                           f"SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{found[newest]}'")
        return self.spark.table(table)

    def read(self) -> DataFrame:
        return self._stored().drop(SALT)

    def _next(self) -> int:
        return (self.versions() or [-1])[-1] + 1

    def _write(self, rows: DataFrame, job: str | None = None, batch: int = 0) -> int:
        n = self._next()
        folder = f"v{n}" if job is None else f"v{n}__{job}__{batch}"
        by = [*self.keys, SALT]
        self.spark.sql(f"DROP TABLE IF EXISTS {self._table(n)}")
        guard_not_null(rows, self.schema).write.mode("overwrite").format("parquet").bucketBy(self.buckets, *by) \
            .sortBy(*by).option("path", f"{self.path}/{folder}").saveAsTable(self._table(n))
        if job is not None:
            self._fs.put(f"{self.path}/done/{job}__{batch}")
        return n

    def vacuum(self, keep: int = 1) -> list[int]:
        """Drops all but the newest ``keep`` versions."""
        folders = self._folders()
        old = sorted(folders)[:-keep]
        for n in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(n)}")
            self._fs.delete(f"{self.path}/{folders[n]}")
            self._fs.delete(f"{self.path}/hot/v{n}")
        return old

    # -- hot keys -----------------------------------------------------------
    def _null_key(self, side: str = "") -> Column:
        return reduce(lambda a, b: a | b, [F.col(f"{side}`{k}`").isNull() for k in self.keys])

    def _store_hot(self, version: int, known: DataFrame | None) -> None:
        """Keys with more rows than an average bucket, and over how many salts
        they go.  Rows are counted by bucket first, from the key columns; only
        buckets of more than twice the average are counted by key.  A key of
        ``known`` keeps its salts as long as it has rows."""
        stored = self._stored().filter(~self._null_key())
        at = F.pmod(F.hash(*self.keys, SALT), F.lit(self.buckets))
        sizes = {r["at"]: r["n"] for r in stored.groupBy(at.alias("at")).agg(F.count("*").alias("n")).collect()}
        average = max(1, sum(sizes.values()) // self.buckets)
        large = [b for b, n in sizes.items() if n > 2 * average]
        found = self._over(stored.filter(at.isin(large)) if large else stored.limit(0), average)
        if known is not None:
            alive = stored.join(F.broadcast(known), self.keys).groupBy(*self.keys).agg(F.first("salts").alias("salts"))
            found = found.join(F.broadcast(known), self.keys, "left_anti").unionByName(alive)
        self._put_hot(version, found)

    def _over(self, rows: DataFrame, average: int) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.count("*").alias("n")).filter(F.col("n") > average) \
            .select(*self.keys, F.least(F.lit(self.buckets), F.ceil(F.col("n") / average)).cast("int").alias("salts"))

    def _put_hot(self, version: int, hot: DataFrame) -> None:
        hot.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/hot/v{version}")

    def _get_hot(self, version: int) -> DataFrame | None:
        hot = self.spark.read.parquet(f"{self.path}/hot/v{version}")
        return None if hot.isEmpty() else hot

    def _hot(self) -> DataFrame | None:
        """The current version's hot keys, at most as many as buckets; None: no
        such key.  A list that a failure left unwritten is made up for."""
        found = self.versions()
        if not found:
            return None
        if not self._fs.exists(f"{self.path}/hot/v{found[-1]}/_SUCCESS"):
            older = [n for n in found[:-1] if self._fs.exists(f"{self.path}/hot/v{n}/_SUCCESS")]
            self._store_hot(found[-1], self._get_hot(older[-1]) if older else None)
        return self._get_hot(found[-1])

    def _salted(self, rows: DataFrame, hot: DataFrame | None) -> DataFrame:
        """``rows`` with the salt under which the table keeps each."""
        # a number beside the values, so that equal rows are spread too; no shuffle of
        # rows that could come in another order follows
        any_salt = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns], F.monotonically_increasing_id())
        spread = F.when(self._null_key(), F.pmod(any_salt, F.lit(self.buckets)))
        if hot is None:
            return rows.withColumn(SALT, spread.otherwise(0).cast("int"))
        h = hot.select(*[F.col(k).alias(f"_h_{k}") for k in self.keys], F.col("salts").alias("_h_salts"))
        on = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"_h_{k}") for k in self.keys])
        salt = spread.when(F.col("_h_salts").isNotNull(), F.pmod(any_salt, F.col("_h_salts"))).otherwise(0).cast("int")
        return rows.join(F.broadcast(h), on, "left").select(*rows.columns, salt.alias(SALT))

    def _sent(self, batch: DataFrame, hot: DataFrame | None) -> DataFrame:
        """Batch rows with the salts they must meet, and whether the key is hot
        (then the table has it, and a copy that meets nothing is no insert).  Rows
        with a null key meet nothing; MERGE does not join them."""
        # always 0, but no literal: a literal would leave the join's keys, and with it
        # the table's buckets
        none = F.pmod(F.hash(*self.keys), F.lit(1))
        if hot is None:
            return batch.select("*", F.lit(False).alias("_hot"), none.alias(SALT))
        h = hot.select(*[F.col(k).alias(f"_h_{k}") for k in self.keys], F.col("salts").alias("_h_salts"))
        on = reduce(lambda a, b: a & b, [F.col(f"`{k}`") == F.col(f"_h_{k}") for k in self.keys])
        salts = F.when(F.col("_h_salts").isNotNull(), F.sequence(F.lit(0), F.col("_h_salts") - 1)) \
            .otherwise(F.array(none))
        return batch.join(F.broadcast(h), on, "left").select(
            *batch.columns, F.col("_h_salts").isNotNull().alias("_hot"), F.explode(salts).alias(SALT))

    # -- writing ------------------------------------------------------------
    def load(self, rows: DataFrame) -> int:
        """First load, or replacement of all rows: stored once, counted by key,
        then one shuffle into the buckets."""
        rows = materialize(rows.select(*self.schema.fieldNames()))
        known = rows.filter(~self._null_key())
        n = self._next()
        self._put_hot(n, self._over(known, max(1, known.count() // self.buckets)))
        return self._write(self._salted(rows, self._get_hot(n)).repartition(self.buckets, *self.keys, SALT))

    def merged(self, source: DataFrame, matched: list[Clause] = (), not_matched: list[Clause] = ()) -> DataFrame:
        """The table after a MERGE of ``source``, lazily, with salts."""
        hot = self._hot()
        fresh = [Clause(c.action, F.coalesce(F.expr(c.cond) if isinstance(c.cond, str) else F.lit(True) if c.cond is None else c.cond,
                                             F.lit(False)) & ~F.col("source._hot"), c.values) for c in not_matched]
        out = merge(self._stored(), self._sent(source, hot), [*self.keys, SALT], matched, fresh,
                    cardinality="off", strategy="outer")
        return self._salted(out.drop(SALT), hot)

    def merge(self, source: DataFrame, matched: list[Clause] = (), not_matched: list[Clause] = (),
              cardinality: str = "merge", job: str | None = None, batch: int = 0) -> int | None:
        """MERGE on the table's key columns (equal names on both sides);
        returns the new version's number.  With a ``job`` (the streaming query's
        id), a batch that was published is skipped (None): the version's folder
        carries both, so a replay after a failure meets it or nothing."""
        if job is not None and self.published(job, batch):
            return None
        _check_cardinality(self.read(), source, self.keys, cardinality)
        known = self._hot()
        n = self._write(self.merged(source, matched, not_matched), job, batch)
        self._store_hot(n, known)
        return n
