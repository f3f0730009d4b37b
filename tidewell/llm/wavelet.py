"""Token ids as wavelet matrices in Parquet shards (operator 9).

Documents are sorted by id over range partitions and encoded; each partition
writes one file of blocks.  A block holds up to ``block_tokens`` ids (more only
for a single longer document) as succinct bit-planes: plane by plane, from the
highest bit, the bits of all ids in the order that the planes above left, zeros
first.  With the number of ones before every 512 bits beside them, access, rank
(counting) and select (occurrences) read a few words of each plane.  The block
also has its documents' ids and lengths.

Edge cases: null and empty texts are one end id; a null doc_id sorts first and
equal ids by text; an empty table writes files without blocks.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.encode import encoder, tokenizer_json, with_end

BLOCK_TOKENS = 1 << 20
SUPER = 512
BLOCKS = ("part int, block int, first long, n_docs int, n_tokens long, levels int, "
          "doc_ids binary, no_id binary, doc_tokens binary, zeros binary, planes array<binary>, ones array<binary>")


class WaveletMatrix:
    """Ids of one block; ``planes`` are packed bits, ``ones`` the number of
    ones before every ``SUPER`` bits of each."""

    def __init__(self, n: int, zeros: np.ndarray, planes: list[np.ndarray], ones: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ones = n, zeros, planes, ones

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        zeros, planes, ones = [], [], []
        v = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        for shift in range(levels - 1, -1, -1):
            bit = v & v.dtype.type(1 << shift) != 0
            packed = np.packbits(bit, bitorder="little")
            wide = np.zeros(-(-len(packed) // (SUPER // 8)) * (SUPER // 8), np.uint8)
            wide[:len(packed)] = packed
            count = np.bitwise_count(wide).reshape(-1, SUPER // 8).sum(axis=1, dtype=np.uint32)
            planes.append(packed)
            ones.append((np.cumsum(count, dtype=np.uint32) - count).astype(np.uint32))
            low = np.compress(~bit, v)
            zeros.append(len(low))
            v = np.concatenate([low, np.compress(bit, v)])
        return cls(len(ids), np.array(zeros, np.int64), planes, ones)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i``."""
        block = min(i // SUPER, len(self.ones[level]) - 1)
        if block < 0:
            return 0
        row = self.planes[level][block * (SUPER // 8):(i + 7) // 8]
        if not len(row):
            return int(self.ones[level][block])
        extra = int(row[-1]) >> (i & 7) if i & 7 else 0
        return int(self.ones[level][block]) + int(np.bitwise_count(row).sum(dtype=np.int64)) - extra.bit_count()

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(len(self.planes)):
            bit, before = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = int(self.zeros[level]) + before if bit else i - before
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``end`` lie in the last order."""
        lo, hi, levels = 0, end, len(self.planes)
        for level in range(levels):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if value >> (levels - 1 - level) & 1:
                lo, hi = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, value: int, end: int | None = None) -> int:
        """Occurrences of ``value`` before place ``end``."""
        if value >> len(self.planes):
            return 0
        lo, hi = self._range(value, self.n if end is None else end)
        return hi - lo

    def select(self, value: int, k: int) -> int:
        """Place of the ``k``-th occurrence of ``value``, from 0."""
        if not 0 <= k < self.rank(value):
            raise IndexError(k)
        at = self._range(value, self.n)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - level) & 1
            want = at - int(self.zeros[level]) if one else at
            lo, hi = 0, self.n - 1  # the smallest place with `want` such bits before it that has one
            while lo < hi:
                mid = (lo + hi) // 2
                before = self._ones(level, mid + 1)
                if (before if one else mid + 1 - before) > want:
                    hi = mid
                else:
                    lo = mid + 1
            at = lo
        return at

    def occurrences(self, value: int) -> list[int]:
        """Places of all occurrences of ``value``: ``select`` for all of them, plane by plane."""
        if value >> len(self.planes):
            return []
        at = np.arange(*self._range(value, self.n))
        for level in range(len(self.planes) - 1, -1, -1):
            if not len(at):
                break
            one = value >> (len(self.planes) - 1 - level) & 1
            bits = np.unpackbits(self.planes[level], count=self.n, bitorder="little")
            at = np.flatnonzero(bits == one)[at - int(self.zeros[level]) if one else at]
        return at.tolist()

    def ids(self) -> np.ndarray:
        """All ids, by undoing the orders from the lowest plane up."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        v = np.zeros(self.n, kind)
        for k in range(len(self.planes) - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            up = np.empty_like(v)  # by places: masks take twice the time
            up[np.flatnonzero(~bit)] = v[:self.zeros[k]]
            up[np.flatnonzero(bit)] = v[self.zeros[k]:] | kind(1 << (len(self.planes) - 1 - k))
            v = up
        return v.astype(np.uint32)


def matrix(row: dict) -> WaveletMatrix:
    """The matrix of a stored block (a row as a dict)."""
    return WaveletMatrix(row["n_tokens"], np.frombuffer(row["zeros"], "<i8"),
                         [np.frombuffer(p, np.uint8) for p in row["planes"]],
                         [np.frombuffer(o, "<u4") for o in row["ones"]])


def _block(part: int, block: int, first: int, ids: list, counts: np.ndarray, tokens: np.ndarray, levels: int) -> pa.RecordBatch:
    m = WaveletMatrix.build(tokens, levels)
    row = {"part": part, "block": block, "first": first, "n_docs": len(ids), "n_tokens": len(tokens), "levels": levels,
           "doc_ids": np.array([0 if i is None else i for i in ids], "<i8").tobytes(),
           "no_id": np.packbits([i is None for i in ids], bitorder="little").tobytes(),
           "doc_tokens": counts.astype("<i8").tobytes(), "zeros": m.zeros.astype("<i8").tobytes(),
           "planes": [p.tobytes() for p in m.planes], "ones": [o.astype("<u4").tobytes() for o in m.ones]}
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary())}
    return pa.RecordBatch.from_pylist([row], pa.schema([(c, types[t]) for c, t in (x.split(" ") for x in BLOCKS.split(", "))]))


def write(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end_id: int = 1,
          tokenizer: str | None = None, block_tokens: int = BLOCK_TOKENS) -> None:
    """Writes the ids of all texts, each followed by ``end_id``, in the order of
    ``doc_id`` (an integer column) to Parquet files under ``path``."""
    source = tokenizer_json(docs.sparkSession, tokenizer, "word_bpe_49k.json")

    def build(batches):
        enc = encoder(source.value)
        levels = max(1, (max(enc.size - 1, end_id)).bit_length())
        part, block, done = TaskContext.get().partitionId(), 0, 0
        ids, counts, tokens = [], [], []
        for b in batches:
            keys = b.column(0).to_pylist()
            for at, to, flat, n in enc.encode(b.column(1)):
                flat, n = with_end(flat, n, end_id)
                ends = np.cumsum(n)
                lo, held = 0, sum(map(len, tokens))
                while lo < len(n):
                    base = int(ends[lo] - n[lo])
                    hi = int(np.searchsorted(ends, base + block_tokens - held, side="right"))
                    if hi <= lo and not ids:
                        hi = lo + 1
                    if hi > lo:
                        ids += keys[at + lo:at + hi]
                        counts.append(n[lo:hi])
                        tokens.append(flat[base:int(ends[hi - 1])])
                        held += len(tokens[-1])
                        lo = hi
                    if lo < len(n):
                        yield _block(part, block, done, ids, np.concatenate(counts), np.concatenate(tokens), levels)
                        block, done, held = block + 1, done + held, 0
                        ids, counts, tokens = [], [], []
        if ids:
            yield _block(part, block, done, ids, np.concatenate(counts), np.concatenate(tokens), levels)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("hash"),
                       F.monotonically_increasing_id().alias("row"))
    order = [F.col("doc_id").asc_nulls_first(), "hash", "row"]  # rows of one id go over several files too
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(build, BLOCKS).write.option("compression", "zstd").parquet(path)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(path)


def starts(spark: SparkSession, path: str) -> DataFrame:
    """part and the number of ids in all parts before it: one row per file."""
    rows, at = [], 0
    for r in _blocks(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        rows.append((r["part"], at))
        at += r["n"]
    return F.broadcast(spark.createDataFrame(rows, "part int, part_start long"))


def read(spark: SparkSession, path: str, tokens: bool = False) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, and
    with ``tokens`` its ids."""

    def decode(batches):
        for b in batches:
            for row in b.to_pylist():
                n = np.frombuffer(row["doc_tokens"], "<i8")
                ends = np.cumsum(n)
                none = np.unpackbits(np.frombuffer(row["no_id"], np.uint8), count=len(n), bitorder="little").astype(bool)
                flat = matrix(row).ids()
                data = memoryview(flat.astype("<u4")).cast("B")
                crc = [zlib.crc32(data[4 * (e - m):4 * e]) for e, m in zip(ends.tolist(), n.tolist())]
                cols = [pa.array(np.full(len(n), row["part"], np.int32)), pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=none),
                        pa.array(row["first"] + ends - n), pa.array(n), pa.array(crc, pa.int64())]
                names = ["part", "doc_id", "at", "n_tokens", "ids_crc32"]
                if tokens:
                    cols.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "part int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if tokens else "")
    docs = _blocks(spark, path).mapInArrow(decode, schema)
    out = docs.join(starts(spark, path), "part")
    return out.select("doc_id", (F.col("part_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * tokens)


def token_counts(spark: SparkSession, path: str, token_ids: list[int]) -> DataFrame:
    """token_id and its number of occurrences in all files, by rank."""
    wanted = sorted({int(t) for t in token_ids})

    def count(batches):
        for b in batches:
            for row in b.to_pylist():
                m = matrix(row)
                yield pa.RecordBatch.from_pydict({"token_id": pa.array(wanted, pa.int64()),
                                                  "n": pa.array([m.rank(t) for t in wanted], pa.int64())})

    return _blocks(spark, path).mapInArrow(count, "token_id long, n long").groupBy("token_id").agg(F.sum("n").alias("n"))


def token_places(spark: SparkSession, path: str, token_id: int) -> DataFrame:
    """Places of a token among all ids, by select."""
    def find(batches):
        for b in batches:
            for row in b.to_pylist():
                at = matrix(row).occurrences(token_id)
                yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]] * len(at), pa.int32()),
                                                  "at": pa.array([row["first"] + i for i in at], pa.int64())})

    places = _blocks(spark, path).mapInArrow(find, "part int, at long").join(starts(spark, path), "part")
    return places.select((F.col("part_start") + F.col("at")).alias("place"))
