"""MERGE (conditional update / delete / insert) on the DataFrame API (M1-M7).

``merge(target, source, on, matched, not_matched)`` returns the new target as
a lazy DataFrame; the caller writes it (see :mod:`tidewell.sources.tables`).

Conditions and values are written against the aliases ``target`` and
``source``, e.g. ``"source.ver > target.ver"`` or
``F.col("target.amount") + F.col("source.amount")``.  Clauses are tried in
order and the first whose condition is TRUE wins (NULL counts as FALSE), as
in SQL MERGE.  A matched row no clause takes is kept; an unmatched source
row no clause takes is dropped.

Physical plan, chosen by ``strategy``:

* ``"broadcast"``: ``target LEFT JOIN broadcast(source)``.  The big target is
  streamed once, never shuffled; inserts are ``source LEFT ANTI`` the target
  keys that matched (a key-only scan of the target semi-joined with the
  broadcast batch keys, so the anti join is small on both sides).
* ``"shuffle"``: the target ``LEFT JOIN`` the source, and the source ``LEFT
  ANTI`` the target's distinct keys (reduced before their shuffle).  Both keep
  the big side on the left, where AQE can split a hot key.  Target rows with a
  null key never match; a deterministic salt spreads them over the partitions.
  With ``target_unique`` (no key occurs twice in the target, as in a silver table)
  there is no hot target key, and one ``FULL OUTER JOIN`` does both: the target is
  shuffled once.
* ``"outer"``: one ``FULL OUTER JOIN`` of both sides.  Its output keeps the
  target's partitioning, so a target bucketed on the key is neither shuffled for
  the join nor for writing it back; hot keys must be spread in the key itself
  (:class:`tidewell.sources.bucketed.BucketedTable` does both).
* ``"auto"``: ``"broadcast"`` when a measured upper bound of the source size
  (rows x widest row, one aggregation) is under ``broadcast_max_bytes``,
  else ``"shuffle"``; Catalyst's estimate only skips the measuring when it
  already exceeds the limit.  ``"broadcast"`` asks for the broadcast plan
  but is still measured and falls back to ``"shuffle"`` beyond the limit.

Source rows with a null key never match (NULL = x is not TRUE): they skip the
join and go to the NOT MATCHED clauses directly, so a hot null key cannot
skew the join.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType, BinaryType

from tidewell.functions import first_true

DEFAULT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024

# Bytes per value of the fixed-width types, as Spark's rows hold them.
_FIXED_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "long": 8, "float": 4,
                "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16,
                "void": 1}


class MergeCardinalityError(Exception):
    """A target row was matched by more than one source row (M6)."""


@dataclass
class Clause:
    action: str                       # "update" | "delete" | "insert"
    cond: Column | str | None = None
    values: dict | str | None = None  # {target_col: Column | sql str} or "*"


def update(cond=None, values="*") -> Clause:
    return Clause("update", cond, values)


def delete(cond=None) -> Clause:
    return Clause("delete", cond, None)


def insert(cond=None, values="*") -> Clause:
    return Clause("insert", cond, values)


def _expr(e) -> Column:
    if e is None:
        return F.lit(True)
    return F.expr(e) if isinstance(e, str) else e


def _side_expr(e, side: str) -> Column:
    return F.col(f"{side}.{e}") if isinstance(e, str) else e


def _key_pairs(on) -> list[tuple[Column, Column]]:
    pairs = []
    for item in on:
        if isinstance(item, str):
            pairs.append((F.col(f"target.{item}"), F.col(f"source.{item}")))
        else:
            t, s = item
            pairs.append((_side_expr(t, "target"), _side_expr(s, "source")))
    return pairs


def _row_width(df: DataFrame) -> Column:
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (StructType, ArrayType, MapType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(_FIXED_WIDTH.get(f.dataType.typeName(), 16)))
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0)


def measured_size_bound(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) where bytes = rows x widest row: a true upper bound of the
    data size, measured by one aggregation over ``df``."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.max(_row_width(df)).alias("w")).first()
    n = int(row["n"] or 0)
    return n, n * int(row["w"] or 0)


def _profile(source: DataFrame, on) -> tuple[int, bool]:
    """One aggregation over the source giving both the size bound (rows x
    widest row) and whether a non-null join key occurs more than once:
    grouped by the key (partial aggregation first), then reduced to one row."""
    s = source.alias("source")
    pairs = _key_pairs(on)
    names = [f"__k{i}" for i in range(len(pairs))]
    keyed = s.select(*[se.alias(n) for (_, se), n in zip(pairs, names)],
                     _row_width(source).alias("__w"))
    not_null = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    per_key = keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("__n"), F.max("__w").alias("__w"))
    row = per_key.agg(F.sum("__n").alias("n"), F.max("__w").alias("w"),
                      F.max(F.when(not_null, F.col("__n"))).alias("dup")).first()
    n = int(row["n"] or 0)
    return n * int(row["w"] or 0), int(row["dup"] or 0) > 1


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df`` (no job).  Not a bound: it may be
    low (compressed files, generators), so it is only used to rule
    broadcasting *out* without measuring."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no JVM plan access (e.g. remote session)
        return -1


def _is_materialized(df: DataFrame) -> bool:
    return df.storageLevel.useMemory or df.storageLevel.useDisk


def cardinality_conflicts(target: DataFrame, source: DataFrame, on) -> DataFrame:
    """Source keys that occur more than once and exist in the target (M6):
    ``(key columns..., n_source_rows)``.  Aggregates the source only, then a
    semi join against the target keys."""
    t = target.alias("target")
    s = source.alias("source")
    pairs = _key_pairs(on)
    names = [f"__k{i}" for i in range(len(pairs))]
    dup = (s.select(*[se.alias(n) for (_, se), n in zip(pairs, names)])
             .filter(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))
             .groupBy(*names).agg(F.count(F.lit(1)).alias("n_source_rows"))
             .filter(F.col("n_source_rows") > 1))
    tkeys = t.select(*[te.alias(n) for (te, _), n in zip(pairs, names)])
    return dup.join(tkeys, names, "left_semi")


def _check_cardinality(target, source, on, mode: str) -> None:
    if mode == "off":
        return
    s = source.alias("source")
    pairs = _key_pairs(on)
    names = [f"__k{i}" for i in range(len(pairs))]
    dup = (s.select(*[se.alias(n) for (_, se), n in zip(pairs, names)])
             .filter(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))
             .groupBy(*names).count().filter(F.col("count") > 1))
    if dup.isEmpty():
        return
    _raise_on_conflicts(target, source, on, mode)


def _raise_on_conflicts(target, source, on, mode: str) -> None:
    """The source has duplicated keys: always an error in "strict" mode, in
    "merge" mode only if one of them exists in the target."""
    if mode == "strict":
        raise MergeCardinalityError("source holds duplicate keys")
    if not cardinality_conflicts(target, source, on).isEmpty():
        raise MergeCardinalityError(
            "a target row matched several source rows; update/delete would be ambiguous")


def merge(target: DataFrame, source: DataFrame, on, matched: list[Clause] = (),
          not_matched: list[Clause] = (), cardinality: str = "merge",
          strategy: str = "auto", broadcast_max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
          materialize: bool = True, source_bytes: int | None = None, target_unique: bool = False) -> DataFrame:
    """Return ``target`` after applying ``source`` with MERGE semantics.

    ``on``: column names present on both sides, or ``(target_expr,
    source_expr)`` pairs (names or Columns over ``target.``/``source.``).
    ``cardinality``: ``"merge"`` fails when a duplicated source key exists in
    the target, ``"strict"`` on any duplicated source key, ``"off"`` skips the
    check (for sources unique per key by construction).
    ``materialize``: when the source is read more than once (size bound,
    cardinality check, the merge itself) and is not cached, cut its lineage
    once with a reliable ``checkpoint()`` into the shared checkpoint folder
    instead of recomputing it per read.
    ``source_bytes``: an upper bound of the source size the caller already
    measured (e.g. once per micro-batch for several MERGEs of projections of
    it); it replaces the measuring job.
    ``target_unique``: the target's non-null keys are unique, so the shuffle form
    needs no protection against a hot one.
    """
    tcols = target.columns
    ttypes = {f.name: f.dataType for f in target.schema.fields}
    scols = set(source.columns)
    est = estimated_bytes(source)
    if strategy == "auto" and est > broadcast_max_bytes:
        strategy = "shuffle"
    # Without cost-based statistics Catalyst's estimate follows the size of
    # the inputs of the lineage, so a small estimate means re-reading is
    # cheaper than writing a checkpoint.
    measure = strategy not in ("shuffle", "outer") and source_bytes is None
    extra_reads = (cardinality != "off") + measure
    big = est < 0 or est > broadcast_max_bytes
    if extra_reads and materialize and big and not _is_materialized(source):
        from tidewell.session import materialize as cut_lineage
        source = cut_lineage(source)
    if measure and cardinality != "off":
        # one pass over the source answers both questions
        source_bytes, dup = _profile(source, on)
        if dup:
            _raise_on_conflicts(target, source, on, cardinality)
    else:
        _check_cardinality(target, source, on, cardinality)
    if strategy not in ("shuffle", "outer"):
        # Broadcast only behind a measured bound; beyond it, shuffle.
        nbytes = source_bytes if source_bytes is not None else measured_size_bound(source)[1]
        strategy = "broadcast" if nbytes <= broadcast_max_bytes else "shuffle"

    pairs = _key_pairs(on)
    src = source.withColumn("__sp", F.lit(True)).alias("source")
    tgt = target.withColumn("__tp", F.lit(True)).alias("target")
    s_null = reduce(lambda a, b: a | b, [se.isNull() for _, se in pairs])
    t_null = reduce(lambda a, b: a | b, [te.isNull() for te, _ in pairs])

    def value_of(clause: Clause, c: str) -> Column:
        if clause.values == "*":
            return F.col(f"source.`{c}`") if c in scols else None
        v = clause.values.get(c) if clause.values else None
        if v is None:
            return None
        return _expr(v)

    def matched_action() -> Column:
        cases = [(_expr(cl.cond), F.lit(f"m{i}")) for i, cl in enumerate(matched)]
        return first_true(cases, F.lit("keep"))

    def insert_action() -> Column:
        cases = [(_expr(cl.cond), F.lit(f"i{i}")) for i, cl in enumerate(not_matched)]
        return first_true(cases, F.lit("skip"))

    def project(df: DataFrame, act: Column, has_target: bool = True) -> DataFrame:
        df = df.withColumn("__act", act)
        out = []
        for c in tcols:
            cases = []
            if has_target:
                cases.append((F.col("__act") == "keep", F.col(f"target.`{c}`")))
                for i, cl in enumerate(matched):
                    if cl.action == "update":
                        v = value_of(cl, c)
                        cases.append((F.col("__act") == f"m{i}",
                                      v if v is not None else F.col(f"target.`{c}`")))
            for i, cl in enumerate(not_matched):
                v = value_of(cl, c)
                cases.append((F.col("__act") == f"i{i}", v if v is not None else F.lit(None)))
            e = first_true(cases, F.lit(None))
            out.append(e.cast(ttypes[c]).alias(c))
        dropped = [f"m{i}" for i, cl in enumerate(matched) if cl.action == "delete"] + ["skip"]
        return df.filter(~F.col("__act").isin(dropped)).select(*out)

    if strategy == "outer":
        cond = reduce(lambda a, b: a & b, [te == se for te, se in pairs])
        act = (F.when(F.col("target.__tp").isNull(), insert_action())
                .when(F.col("source.__sp").isNull(), F.lit("keep")).otherwise(matched_action()))
        joined = project(tgt.join(src.filter(~s_null), cond, "full"), act)
        return joined.unionByName(project(src.filter(s_null), insert_action(), has_target=False))

    src_keyed = src.filter(~s_null)
    src_nullkey = src.filter(s_null)
    cond = reduce(lambda a, b: a & b, [te == se for te, se in pairs])

    if strategy == "broadcast":
        b = F.broadcast(src_keyed)
        left = tgt.join(b, cond, "left")
        act = F.when(F.col("source.__sp").isNull(), F.lit("keep")).otherwise(matched_action())
        kept = project(left, act)
        tkeys = tgt.select(*[te.alias(f"__k{i}") for i, (te, _) in enumerate(pairs)])
        skeys = F.broadcast(src_keyed.select(*[se.alias(f"__k{i}") for i, (_, se) in enumerate(pairs)]))
        hit = tkeys.join(skeys, [f"__k{i}" for i in range(len(pairs))], "left_semi").alias("hit")
        hcond = reduce(lambda a, b: a & b,
                       [se == F.col(f"hit.__k{i}") for i, (_, se) in enumerate(pairs)])
        fresh = src_keyed.join(hit, hcond, "left_anti")
        inserted = project(fresh, insert_action(), has_target=False)
        parts = [kept, inserted]
    else:
        # Two joins that AQE can split on a hot target key (a full outer join it
        # cannot): the target's own rows, and the source keys it lacks.
        salt_t = F.when(t_null, F.xxhash64(*[F.col(f"target.`{c}`") for c in tcols])).otherwise(F.lit(0))
        tgt_s = tgt.withColumn("__salt", salt_t).alias("target")
        src_s = src_keyed.withColumn("__salt", F.lit(0).cast("long")).alias("source")
        salted = cond & (F.col("target.__salt") == F.col("source.__salt"))
        if target_unique:
            act = (F.when(F.col("target.__tp").isNull(), insert_action())
                    .when(F.col("source.__sp").isNull(), F.lit("keep")).otherwise(matched_action()))
            joined = project(tgt_s.join(src_s, salted, "full"), act)
            return joined.unionByName(project(src_nullkey, insert_action(), has_target=False))
        left = tgt_s.join(src_s, salted, "left")
        act = F.when(F.col("source.__sp").isNull(), F.lit("keep")).otherwise(matched_action())
        tkeys = tgt.filter(~t_null).select(*[te.alias(f"__k{i}") for i, (te, _) in enumerate(pairs)]).distinct().alias("hit")
        hcond = reduce(lambda a, b: a & b, [se == F.col(f"hit.__k{i}") for i, (_, se) in enumerate(pairs)])
        fresh = src_keyed.join(tkeys, hcond, "left_anti")
        parts = [project(left, act), project(fresh, insert_action(), has_target=False)]

    parts.append(project(src_nullkey, insert_action(), has_target=False))
    return reduce(lambda a, b: a.unionByName(b), parts)
