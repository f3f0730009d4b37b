"""Line dedup by pairwise alignment (operator 2).

Documents that share a line, or a run of lines with ``min_words`` words, are
candidates.  A rare one (held by up to ``rare_documents``) pairs all its holders;
a more frequent one pairs each holder with the first, which grows with the
number of lines, not of pairs.  The runs are, from each line on and up to each
line, the shortest with ``min_words`` words: every common block of any two
documents is made of such runs, so each part of it is paired with its first holder.
Each pair is aligned by patience diff on line hashes, and blocks of consecutive
common lines with ``min_words`` words or more are deleted from the later
document.  Where common lines are left, so are the blocks that the alignment
does not meet (repeated in one of the two, or in another order).  The first
holder of a block keeps it.

"Later" is by id (null last), then by text hash.  Rows with equal id and text
count as one document and all lose the same lines.  Lines are what stands
between ``\\n``; lines without a word are no candidates, and go when they stand
inside a deleted block.

Edge cases: null and empty texts have no line with a word and stay as they
are; ties follow the order above; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import boxed, unboxed, written

MIN_WORDS = 30
RARE_DOCUMENTS = 4
#: Base of the runs' hashes.
BASE = 0x9E3779B97F4A7C15


def _numbered(a: list[int], lo: int, hi: int) -> dict[tuple[int, int], int]:
    """Place of the k-th occurrence of each line between ``lo`` and ``hi``."""
    seen, out = {}, {}
    for i in range(lo, hi):
        k = seen[a[i]] = seen.get(a[i], -1) + 1
        out[a[i], k] = i
    return out


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched places (in a, in b), rising in both: the longest rising run of the
    lines that are unique in both, and the same again between these; where there is
    no such line, equal ends, then what is unique between them, and if there is none,
    the k-th occurrences in both."""
    out = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        if a[a0:a1] == b[b0:b1]:
            out += zip(range(a0, a1), range(b0, b1))
            continue
        unique = _unique_in_both(a, a0, a1, b, b0, b1)
        if not unique:
            while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
                out.append((a0, b0))
                a0, b0 = a0 + 1, b0 + 1
            while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
                a1, b1 = a1 - 1, b1 - 1
                out.append((a1, b1))
            unique = _unique_in_both(a, a0, a1, b, b0, b1)
        if not unique:
            in_a, in_b = _numbered(a, a0, a1), _numbered(b, b0, b1)
            unique = sorted((i, in_b[h]) for h, i in in_a.items() if h in in_b)
        if not unique:
            continue
        ends, tops, back = [], [], [None] * len(unique)
        for k, (_, j) in enumerate(unique):
            at = bisect_left(ends, j)
            back[k] = tops[at - 1] if at else None
            if at == len(ends):
                ends.append(j)
                tops.append(k)
            else:
                ends[at], tops[at] = j, k
        run, k = [], tops[-1]
        while k is not None:
            run.append(unique[k])
            k = back[k]
        pa0, pb0 = a0, b0
        for i, j in reversed(run):
            out.append((i, j))
            todo.append((pa0, i, pb0, j))
            pa0, pb0 = i + 1, j + 1
        todo.append((pa0, a1, pb0, b1))
    return sorted(out)


def _unique_in_both(a: list[int], a0: int, a1: int, b: list[int], b0: int, b1: int) -> list[tuple[int, int]]:
    in_a, in_b = {}, {}
    for i in range(a0, a1):
        in_a[a[i]] = -1 if a[i] in in_a else i
    for j in range(b0, b1):
        in_b[b[j]] = -1 if b[j] in in_b else j
    return sorted((i, in_b[h]) for h, i in in_a.items() if i >= 0 and in_b.get(h, -1) >= 0)


def common_blocks(a: list[int], b: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(from, to) in b of the aligned blocks with ``min_words`` words or more, and,
    where common lines are left, of all runs of lines that a has too."""
    shared = set(a).intersection(b)
    if sum(w for h, w in zip(b, words) if h in shared) < min_words:
        return []
    out, start, left = [], None, 0
    match = patience(a, b)
    for k, (i, j) in enumerate(match):
        if start is None:
            start = j
        if k + 1 == len(match) or match[k + 1] != (i + 1, j + 1):
            if sum(words[start:j + 1]) >= min_words:
                out.append((start, j + 1))
            start = None
    at = 0
    for s, e in [*out, (len(b), len(b))]:
        left += sum(w for h, w in zip(b[at:s], words[at:s]) if h in shared)
        at = e
    return out + repeated(a, b, words, min_words) if left else out


def repeated(a: list[int], b: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(from, to) in b of the longest runs of lines that stand anywhere in a and
    have ``min_words`` words: what an alignment leaves that goes once through both
    (passages that b repeats or has in another order)."""
    step, link, longest = [{}], [-1], [0]  # suffix automaton of a
    end = 0
    for h in a:
        new = len(step)
        step.append({})
        link.append(0)
        longest.append(longest[end] + 1)
        p = end
        while p >= 0 and h not in step[p]:
            step[p][h] = new
            p = link[p]
        if p >= 0:
            q = step[p][h]
            if longest[q] != longest[p] + 1:
                step.append(dict(step[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                copy = len(step) - 1
                link[q] = copy
                while p >= 0 and step[p].get(h) == q:
                    step[p][h] = copy
                    p = link[p]
                q = copy
            link[new] = q
        end = new
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)]).tolist()
    out, at, n = [], 0, 0
    for j, h in enumerate(b):
        while at and h not in step[at]:
            at = link[at]
            n = longest[at]
        at, n = (step[at][h], n + 1) if h in step[at] else (0, 0)
        if n and total[j + 1] - total[j + 1 - n] >= min_words:
            s = j + 1 - n
            while out and out[-1][0] >= s:
                out.pop()
            out.append((s, j + 1))
    return out


def _identity(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).alias("_id"), F.coalesce(F.xxhash64(F.col(text)), F.lit(0)).alias("_h")]


def line_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key (orders documents), the hash of each line and its
    number of words."""
    rows = docs.select(*_identity(doc_id, text), F.split(F.coalesce(F.col(text), F.lit("")), "\n").alias("l"))
    return rows.select(
        F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_h")).alias("key"),
        F.transform("l", lambda x: F.xxhash64(x)).alias("hashes"),
        F.transform("l", lambda x: F.regexp_count(x, F.lit(r"[^\x20\x09-\x0D]+"))).alias("words")) \
        .dropDuplicates(["key"])


def runs(words: np.ndarray, lens: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the shortest runs with ``min_words`` words from each line on
    and up to each line (lines with a word), in documents of ``lens`` lines."""
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    last = np.cumsum(lens)
    first, last = np.repeat(last - lens, lens), np.repeat(last, lens)
    at = np.flatnonzero(words > 0)
    to = np.searchsorted(total, total[at] + min_words)
    start = np.searchsorted(total, total[at + 1] - min_words, "right") - 1
    on, up = to <= last[at], start >= first[at]
    return np.concatenate([at[on], start[up]]), np.concatenate([to[on], at[up] + 1])


def run_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial over the lines' hashes; a run of one line has the line's."""
    n = len(hashes)
    up, down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (BASE, pow(BASE, -1, 1 << 64)))
    total = np.concatenate([[np.uint64(0)], np.cumsum(hashes.view(np.uint64) * up[:n])])
    return ((total[end] - total[start]) * down[start]).view(np.int64)


def held_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """key, line: the lines with a word and the runs of each document, once each."""
    def hold(batches):
        for batch in batches:
            hashes, words = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (1, 2))
            lens = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(lens)), lens)
            one = np.flatnonzero(words > 0)
            start, end = runs(words, lens, max(min_words, 1))
            line, doc = np.concatenate([hashes[one], run_hashes(hashes, start, end)]), np.concatenate([doc[one], doc[start]])
            order = np.lexsort((line, doc))
            line, doc = line[order], doc[order]
            new = np.ones(len(line), bool)
            new[1:] = (np.diff(line) != 0) | (np.diff(doc) != 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[new])), pa.array(line[new])], names=["key", "line"])

    schema = lines.select("key", F.lit(0).cast("long").alias("line")).schema
    return lines.select("key", "hashes", "words").mapInArrow(hold, schema)


def candidates(lines: DataFrame, rare_documents: int = RARE_DOCUMENTS, min_words: int = MIN_WORDS) -> DataFrame:
    """Pairs earlier, later of documents that share a line with a word or a run."""
    held = held_lines(lines, min_words)
    shared = held.groupBy("line").agg(F.count("*").alias("n"), F.min("key").alias("earlier")).filter("n > 1")
    with_first = held.join(shared, "line")
    first = with_first.filter("earlier < key").select("earlier", F.col("key").alias("later"))
    # grouped by another expression than the join's, so that the join, which
    # still has the frequent lines, may be split on them
    rare = with_first.filter(F.col("n").between(3, rare_documents)).groupBy(F.struct("line").alias("line")) \
        .agg(F.array_sort(F.collect_set("key")).alias("k"))
    # the first holder has its pairs already; at most rare_documents - 1 are left
    others = rare.select(F.slice("k", F.lit(2), F.size("k") - 1).alias("k")).select(F.posexplode("k").alias("at", "later"), "k") \
        .select(F.explode(F.slice("k", F.lit(1), F.col("at"))).alias("earlier"), "later")
    return first.union(others).distinct()


def blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
           rare_documents: int = RARE_DOCUMENTS) -> DataFrame:
    """Per document that loses lines: _id, _h (text hash) and cut, its
    sorted (from, to) line ranges."""
    lines = written(line_table(docs, doc_id, text), "lines")
    pairs = candidates(lines, rare_documents, min_words)
    earlier = lines.select(F.col("key").alias("earlier"), F.col("hashes").alias("a"))
    later = lines.select(F.col("key").alias("later"), F.col("hashes").alias("b"), "words")
    both = pairs.join(earlier, "earlier").join(later, "later")

    def align(batches):
        for batch in batches:
            ids, hashes, start, end = [], [], [], []
            cols = [batch.column(k).to_pylist() for k in range(5)]
            for i, h, a, b, words in zip(*cols):
                for s, e in common_blocks(a, b, words, min_words):
                    ids.append(i)
                    hashes.append(h)
                    start.append(s)
                    end.append(e)
            kind = batch.schema.field(0).type
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hashes, pa.int64()), pa.array(np.array(start, np.int32)), pa.array(np.array(end, np.int32))],
                                             names=["_id", "_h", "s", "e"])

    flat = both.select(F.col("later._id").alias("_id"), F.col("later._h").alias("_h"), "a", "b", "words")
    schema = flat.select("_id", "_h", F.lit(0).alias("s"), F.lit(0).alias("e")).schema
    return flat.mapInArrow(align, schema).groupBy("_id", "_h").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("cut"))


def _merged(cut: Column) -> Column:
    """Sorted ranges without overlaps."""
    empty = F.array().cast("array<struct<s:int,e:int>>")

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        touches = F.when(F.size(acc) == 0, F.lit(False)).otherwise(x["s"] <= last["e"])
        joined = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))
        return F.when(touches, F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(
            F.concat(acc, F.array(F.struct(x["s"].alias("s"), x["e"].alias("e")))))

    return F.aggregate(cut, empty, add)


def _dedup(docs: DataFrame, **options) -> DataFrame:
    """``row``, ``text`` without the deleted lines, n_lines and n_deleted, from
    ``row``, ``id`` and ``text``."""
    found = blocks(docs, "id", "text", **options).select("_id", "_h", _merged(F.col("cut")).alias("_cut"))
    rows = docs.withColumn("_t", F.coalesce(F.xxhash64("text"), F.lit(0)))
    out = rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_h")), "left")
    kept = F.concat(F.array().cast("array<string>"), F.flatten(F.transform(
        F.sequence(F.lit(0), F.size("_cut")), lambda k: F.slice(
            F.col("_lines"), F.when(k == 0, 1).otherwise(F.get("_cut", k - 1)["e"] + 1),
            F.coalesce(F.get("_cut", k)["s"], F.size("_lines")) - F.when(k == 0, 0).otherwise(F.get("_cut", k - 1)["e"])))))
    gone = F.aggregate("_cut", F.lit(0), lambda a, x: a + x["e"] - x["s"])
    return out.withColumn("_lines", F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).select(
        "row", F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size("_lines").alias("n_lines"), F.coalesce(gone, F.lit(0)).alias("n_deleted"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the deleted lines out of ``text``, then n_lines and
    n_deleted (columns of ``docs`` with these names give way)."""
    out = _dedup(boxed(docs, id=F.col(doc_id), text=F.col(text)), **options)
    return unboxed(out, docs.columns, ["n_lines", "n_deleted"], **{text: F.col("text")})


def dedup_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``dedup`` with the columns of ``docs`` only; a text that lost its last
    word goes."""
    out = _dedup(boxed(docs, id=F.col(doc_id), text=F.col(text)), **options)
    left = out.filter((F.col("n_deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return unboxed(left, docs.columns, **{text: F.col("text")})
