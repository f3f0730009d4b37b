"""SimHash near-duplicates by segment-popcount embedding (operator 4).

A fingerprint is cut into 2-bit segments and mapped to the vector of their bit
counts.  The Manhattan distance of two such vectors is at most the Hamming
distance of the fingerprints, so it is a lower bound: links are searched among
vectors that are near in the grid and then verified on the fingerprints.
Counts 0, 1, 2 are kept as 00, 01, 11 in the segment's own place, so one
``bit_count`` of an XOR is the Manhattan distance of whole vectors.

Grid join: the vector's coordinates are dealt into ``groups`` groups.  Vectors
within distance ``bits`` differ in at most ``bits`` groups, hence agree on some
``groups - bits`` of them; each choice of so many groups makes one cell key.
Distinct fingerprints only are joined: exact copies have met before.

Cells are worked through without emitting all pairs: see ``links``.

Edge cases: null and empty texts have fingerprint zero, linked like any other;
repeated rows share theirs; rows with a null id join a component and never name
it (a component of such rows only has a null id); an empty table gives an empty
result.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import boxed, unboxed, without, written

SEED = 42
EVEN = 0x5555555555555555
BLOCK = 1 << 15


def fingerprint(text: bytes, width: int) -> int:
    """64-bit SimHash of the shingles of ``width`` words, as a signed integer."""
    words = text.lower().split()
    if not words:
        return 0
    width = min(width, len(words))
    n = len(words) - width + 1
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        bits = np.unpackbits(hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text") -> DataFrame:
    """The columns of ``docs`` without its text, and ``fp``."""
    ids = [c for c in docs.columns if c != text]
    schema = docs.select(*ids, F.lit(0).cast("bigint").alias("fp")).schema

    def of(batches):
        for b in batches:
            at = b.schema.get_field_index(text)
            fps = [fingerprint(t.encode() if t else b"", width) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in ids] + [pa.array(fps, pa.int64())],
                                             names=[*ids, "fp"])

    return docs.select(*ids, text).mapInArrow(of, schema)


def embedded(fp: Column) -> Column:
    """Bit counts of the 32 segments, each in unary in its own two bits."""
    high = F.shiftrightunsigned(fp, 1)
    both, some = fp.bitwiseAND(high).bitwiseAND(F.lit(EVEN)), fp.bitwiseOR(high).bitwiseAND(F.lit(EVEN))
    return F.shiftleft(both, 1).bitwiseOR(some)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def cell_masks(bits: int, groups: int) -> list[int]:
    """Masks over the embedded vector, one for each choice of the
    ``groups - bits`` groups of segments that must agree."""
    if not 0 <= bits < groups <= 32:
        raise ValueError("0 <= bits < groups <= 32 must hold")
    segments = [[s for s in range(32) if s % groups == g] for g in range(groups)]
    return [_signed(sum(3 << 2 * s for g in chosen for s in segments[g]))
            for chosen in combinations(range(groups), groups - bits)]


def groups_for(fingerprints: int, bits: int) -> int:
    """Number of groups for so many distinct fingerprints: the fewest (each
    choice of groups is a row per fingerprint) whose cells hold about one fingerprint
    each.  A count of two random bits has 1.5 bits of information."""
    for groups in range(max(2 * bits, 2), 32):
        if fingerprints <= 2 ** (48 * (groups - bits) / groups):
            return groups
    return 32


def links(fps: DataFrame, bits: int = 3, groups: int | None = None) -> DataFrame:
    """Pairs a < b of the distinct values of ``fps.fp`` at ``bits`` or fewer
    differing bits, whatever the number of ``groups`` (by default chosen by the
    number of distinct fingerprints, so that a cell stays small at every size).  A value has at most sum(C(64, i), i <= bits) partners
    however large its group of near copies is, and only verified pairs leave
    the join; a crowded cell is a skewed join key, which is split at run time."""
    values = fps.select("fp").distinct()
    if groups is None:
        groups = groups_for(values.count(), bits)
    masks = F.array(*(F.lit(m) for m in cell_masks(bits, groups)))
    cells = values.select("fp", F.posexplode(masks).alias("choice", "mask")).select(
        F.xxhash64("choice", embedded(F.col("fp")).bitwiseAND(F.col("mask"))).alias("cell"), "fp")
    a, b = cells.alias("a"), cells.alias("b")
    x, y = F.col("a.fp"), F.col("b.fp")
    near = F.bit_count(embedded(x).bitwiseXOR(embedded(y))) <= bits
    same = F.bit_count(x.bitwiseXOR(y)) <= bits
    return a.join(b, (F.col("a.cell") == F.col("b.cell")) & (x < y) & near & same) \
        .select(x.alias("a"), y.alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its connected component) for
    all nodes of ``edges`` (a, b), by alternating large-star and small-star
    steps: each is one aggregation and one join, and halves paths, so long
    chains take a logarithmic number of rounds.  Each round is written to the
    shared folder, which cuts the lineage."""
    def state(e: DataFrame):
        return e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    def star(pairs: DataFrame, small: bool) -> DataFrame:
        """pairs (u, v): v the neighbours of u, the larger or equal side left out
        for the small star."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        j = pairs.join(least, "u")
        if small:
            linked = j.select(F.col("v").alias("b"), F.col("m").alias("a")).union(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
        else:
            linked = j.filter("v > u").select(F.col("v").alias("b"), F.col("m").alias("a"))
        return linked.filter("a < b").select("a", "b").distinct()

    now = written(edges.select("a", "b").filter("a < b"), "edges")
    before = None
    while before != (before := state(now)):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = star(both, False)
        now = written(star(large.select(F.col("b").alias("u"), F.col("a").alias("v")), True), "edges")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def classes(docs: DataFrame, width: int = 3, bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: its columns without the text, ``fp`` and
    ``component_id``, the smallest id among all rows linked to it directly or
    through others.  Columns of ``docs`` with these two names give way."""
    columns = [c for c in docs.columns if c != text]
    inner = docs.select(F.struct(*columns).alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    marked = written(fingerprints(inner, width, "text"), "fingerprints")
    first = marked.groupBy("fp").agg(F.min("id").alias("least"))
    found = components(links(marked, bits))
    named = found.join(first, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("least").alias("component"))
    linked = found.join(named, "root").select("node", "component")
    by_fp = first.join(linked, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("_fp"), F.coalesce("component", "least").alias("component_id"))
    return unboxed(marked.join(by_fp, F.col("fp") == F.col("_fp")), columns, ["fp", "component_id"])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_first(docs: DataFrame, width: int = 3, bits: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, of those with its smallest id (a null id
    counts as larger than any) the one with the smallest text hash."""
    keyed = docs.select(F.col(doc_id).alias("_id"), F.xxhash64(F.col(text)).alias("_h"), F.col(text).alias("_text"))
    found = classes(keyed, width, bits, "_id", "_text")
    order = F.struct(F.col("_id").isNull(), F.col("_id").alias("_id"), F.col("_h").alias("_h"))
    rows = written(found.select("_id", "_h", "component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("unnamed")), "classes")
    best = rows.groupBy("component_id", "unnamed").agg(F.min(order).alias("best"))
    stay = best.select(F.col("best._id").alias("s_id"), F.col("best._h").alias("s_h"))
    gone = rows.join(stay, F.col("_id").eqNullSafe(F.col("s_id")) & (F.col("_h") == F.col("s_h")), "left_anti")
    kept = without(docs, gone, doc_id, text)
    if rows.groupBy("_id", "_h").count().filter("count > 1").isEmpty():
        return kept
    return unboxed(boxed(kept, id=F.col(doc_id), h=F.xxhash64(F.col(text))).dropDuplicates(["id", "h"]), docs.columns)
