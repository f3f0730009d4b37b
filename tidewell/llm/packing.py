"""Vector best-fit packing of token sequences (operator 3).

A document's ids (with its end id) are cut into pieces of at most ``tokens``
ids, only if it is longer.  Pieces are dealt by hash into groups of about
``group_pieces``, and each group is packed by itself: pieces in falling order of
length, each into the open sequence that stays within all three capacities
(tokens, documents, attention cost: the sum of squared piece lengths) and fits
best.  Best is the smallest weighted norm of the residual capacities after
placing (``rule="norm"``), or the largest weighted dot product of the piece's
demands and the residuals (``rule="dot"``).  A group wastes at most about one
sequence's room, so the number of sequences stays near total / tokens, and no
task sees more than its group.

Edge cases: null and empty texts are one end id; repeated rows and ids are
packed row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import written
from tidewell.llm.encode import encoder, tokenizer_json, with_end

TOKENS = 4096
GROUP_PIECES = 20_000
PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokens: int = TOKENS, end_id: int = 1,
           tokenizer: str | None = None, ids: bool = False) -> DataFrame:
    """One row per piece of each row of ``docs``: doc_id, piece, start, length,
    ids_crc32, and with ``ids`` the ids themselves."""
    source = tokenizer_json(docs.sparkSession, tokenizer, "word_bpe_49k.json")
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.simpleString()[7:-1].replace(":", " ", 1)

    def cut(batches):
        enc = encoder(source.value)
        for b in batches:
            keys = b.column(0)
            for at, to, flat, counts in enc.encode(b.column(1)):
                flat, counts = with_end(flat, counts, end_id)
                n = -(-counts // tokens)
                doc = np.repeat(np.arange(to - at), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * tokens
                length = np.minimum(tokens, counts[doc] - start)
                data = memoryview(np.ascontiguousarray(flat, "<u4")).cast("B")
                edge = 4 * (np.repeat(np.cumsum(counts) - counts, n) + start)
                crc = [zlib.crc32(data[e:e + 4 * m]) for e, m in zip(edge.tolist(), length.tolist())]
                cols = [keys.take(pa.array(doc + at)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if ids:
                    offsets = np.append(edge // 4, len(flat)).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")) \
        .mapInArrow(cut, f"{schema}, {PIECES}" + (", ids array<int>" if ids else ""))


class Bins:
    """Open sequences of one group and their residual capacities, as shares."""

    def __init__(self, capacity: np.ndarray, weights: np.ndarray, rule: str):
        self.capacity, self.weights, self.rule = capacity, weights, rule
        self.free = np.zeros((3, 256))
        self.number = np.zeros(256, np.int64)
        self.open = self.made = 0

    def place(self, demand: np.ndarray) -> tuple[int, int]:
        """(sequence, tokens already in it) for a piece of this demand."""
        d = demand / self.capacity
        left = self.free[:, :self.open] - d[:, None]
        fits = (left >= -1e-12).all(axis=0)
        if fits.any():
            score = self.weights @ (left * left) if self.rule == "norm" else -(self.weights * d) @ self.free[:, :self.open]
            k = int(np.argmin(np.where(fits, score, np.inf)))
        else:
            k = self.open
            if k == self.free.shape[1]:
                self.free = np.concatenate([self.free, np.zeros_like(self.free)], axis=1)
                self.number = np.concatenate([self.number, np.zeros_like(self.number)])
            self.free[:, k], self.number[k] = 1.0, self.made
            self.open += 1
            self.made += 1
        at = round((1.0 - self.free[0, k]) * self.capacity[0])
        self.free[:, k] -= d
        return int(self.number[k]), at

    def close(self, least: int) -> None:
        """Forgets the sequences with no room for ``least`` tokens or one document."""
        room = (self.free[:2, :self.open] >= np.array([[least / self.capacity[0]], [1 / self.capacity[1]]]) - 1e-12).all(axis=0)
        n = int(room.sum())
        self.free[:, :n], self.number[:n] = self.free[:, :self.open][:, room], self.number[:self.open][room]
        self.open = n


def best_fit(lengths: np.ndarray, capacity, weights, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each of ``lengths``, which must not increase."""
    if rule not in ("norm", "dot"):
        raise ValueError("rule is 'norm' or 'dot'")
    bins = Bins(np.array(capacity, float), np.array(weights, float), rule)
    least = int(lengths.min()) if len(lengths) else 0
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        sequence[i], offset[i] = bins.place(np.array([n, 1.0, float(n) * n]))
        if i % 32 == 31:
            bins.close(least)
    return sequence, offset


def pack(cut: DataFrame, tokens: int = TOKENS, documents: int | None = None, attention: float | None = None,
         weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm",
         group_pieces: int = GROUP_PIECES) -> DataFrame:
    """The rows of ``cut`` (a stored frame with doc_id, piece and length) with
    ``sequence_id`` and ``offset``.  ``documents`` and ``attention`` default to
    what ``tokens`` allows at most."""
    capacity = (tokens, documents or tokens, attention or float(tokens) * tokens)
    if capacity[2] < capacity[0] ** 2 and attention is not None:
        longest = int(capacity[2] ** 0.5)
        if not cut.filter(F.col("length") > longest).isEmpty():
            raise ValueError(f"a piece of more than {longest} tokens is over the attention capacity by itself")
    groups = max(1, -(-cut.count() // group_pieces))
    keyed = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    schema = cut.withColumns({"sequence_id": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}).schema

    def place(key, t):
        t = t.combine_chunks().sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = best_fit(t.column("length").to_numpy(), capacity, weights, rule)
        t = t.drop_columns(["_group"])
        return t.append_column("sequence_id", pa.array(sequence * groups + key[0].as_py())).append_column("offset", pa.array(offset))

    return keyed.groupBy("_group").applyInArrow(place, schema)


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ids: bool = False,
                   tokenizer: str | None = None, tokens: int = TOKENS, end_id: int = 1, **options) -> DataFrame:
    return pack(written(pieces(docs, doc_id, text, tokens, end_id, tokenizer, ids), "pieces"), tokens, **options)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from packed pieces that carry ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
