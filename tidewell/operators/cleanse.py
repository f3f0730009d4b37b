"""Cleansing, de-duplication and latest-version selection.

Every "keep one row" here is deterministic: the caller gives a total order
(version, arrival time, then a unique tie-break column).  Sorting the whole
frame before ``dropDuplicates`` guarantees nothing after a shuffle, so it is
never used.

Skew: one key may hold a large share of all rows.  ``max_by`` aggregates
partially on the map side, and Spark plans ``row_number() ... = 1`` with a
partial ``WindowGroupLimit`` before the exchange, so in both forms a hot key
reaches the shuffle as at most one row per map partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.functions import col_of, is_valid_key


def _desc(cols: list[str | Column]) -> list[Column]:
    out = []
    for c in cols:
        out.append(F.col(c).desc() if isinstance(c, str) else c)
    return out


def valid_keys(df: DataFrame, keys: list[str], blank_is_null: bool = True) -> DataFrame:
    """Keep rows whose key (and version) columns are set: not null, and for
    string columns not blank after trim."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cond = None
    for k in keys:
        c = is_valid_key(k, types.get(k), blank_is_null)
        cond = c if cond is None else cond & c
    return df.filter(cond)


def dedupe_latest(df: DataFrame, keys: list[str], order_by: list[str | Column]) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` (descending for names).

    ``order_by`` must be a total order within a key, e.g. arrival time then a
    unique id, or the result is not defined.
    """
    w = Window.partitionBy(*keys).orderBy(*_desc(order_by))
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn"))


def dedupe_max_by(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Same result as :func:`dedupe_latest` (names, descending) as one
    aggregation: ``max_by(struct(*), struct(order_by))`` per key."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    order = F.struct(*[F.col(c) for c in order_by])
    return (df.groupBy(*keys)
              .agg(F.max_by(packed, order).alias("__row"))
              .select(*keys, *[F.col("__row")[c].alias(c) for c in others])
              .select(*df.columns))


def max_version_per_key(df: DataFrame, key: str | list[str], version: str,
                        alias: str | None = None) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.max(version).alias(alias or version))


def latest_version(df: DataFrame, key: str | list[str], version: str, ties: str = "all",
                   tie_break: list[str | Column] | None = None, method: str | None = None) -> DataFrame:
    """Rows of the highest version per key.

    ``ties="all"`` keeps every row at the top version (J1); ``ties="one"``
    keeps one, chosen by ``tie_break`` (W1).  Null keys and null versions
    are dropped, as the inner join of the reference form drops them.

    ``method`` for ``ties="all"``: ``"join"`` (default: the per-key maximum
    by a partially pre-aggregated aggregation, joined back; a hot key's tied
    rows sit on the streamed side of the join, which AQE's skew handling
    splits over several tasks) or ``"rank"`` (one window and one shuffle, but
    all rows tied at a hot key's top version are sorted in one task).  For
    ``ties="one"``: ``"row_number"`` (default; partial top-1 before the
    shuffle) or ``"max_by"`` (partial aggregation).
    """
    method = method or ("join" if ties == "all" else "row_number")
    keys = [key] if isinstance(key, str) else list(key)
    clean = df.filter(F.col(version).isNotNull())
    for k in keys:
        clean = clean.filter(F.col(k).isNotNull())
    if ties == "all":
        if method == "join":
            mx = max_version_per_key(clean, keys, version, "__maxv")
            return (clean.join(mx, keys, "inner")
                         .filter(F.col(version) == F.col("__maxv"))
                         .select(*df.columns))
        w = Window.partitionBy(*keys).orderBy(F.col(version).desc())
        return (clean.withColumn("__rk", F.rank().over(w))
                     .filter(F.col("__rk") == 1).drop("__rk"))
    order = [version] + list(tie_break or [])
    if method == "max_by":
        return dedupe_max_by(clean, keys, [o for o in order if isinstance(o, str)])
    return dedupe_latest(clean, keys, order)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows for which ``predicate`` is not TRUE (null counts as not deleted, M7)."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~F.coalesce(p, F.lit(False)))


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    cond = None
    for c in cols:
        e = col_of(c).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond)
