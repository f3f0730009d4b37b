"""Benchmark decontamination by a broadcast set of test n-grams (operator 7).

Words of the benchmark items and of the documents are normalised alike.  The
distinct windows of the items form the set; it is broadcast only after it has
been counted and found within ``broadcast_windows``, else the same join
shuffles.  A document is read once: its windows are hashed inside the row, a
bitmap literal of the set's hashes (one byte per slot, sized from the counted
windows) drops nearly all of them, and only the rest, now carrying their words,
meet the set, where the join compares whole windows: that is the verification.
One aggregation per document follows, over a few hits per document.

Edge cases: null or empty text has no words and no hits; items without words
have no window; items with fewer words than the window are one window of their
own length; several items with the same window all count; repeated document
rows are judged row by row; an empty benchmark hits nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import (BROADCAST_KEYS, boxed, let, lower_az, split_words, unboxed, window_hashes,
                                 window_text, without, written)

#: Characters between words after A-Z are lower-cased, and before that.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RAW_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 13
BROADCAST_WINDOWS = 1_000_000
BITMAP_SLOTS = 1 << 22


def normal_words(text: Column) -> Column:
    return split_words(lower_az(text), BETWEEN)


def benchmark_windows(items: DataFrame, width: int = WIDTH, item_id: str = "item_id",
                      text: str = "text") -> DataFrame:
    """One row per distinct window: gram (words joined by a space), size, and
    the items that have it."""
    w = items.select(F.col(item_id).cast("string").alias("item"), normal_words(F.col(text)).alias("w")) \
        .filter(F.size("w") > 0).withColumn("size", F.least(F.size("w"), F.lit(width)))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)
    grams = w.select("item", "size", F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice("w", i, F.col("size")), " "))).alias("gram"))
    return grams.groupBy("gram", "size").agg(F.collect_set("item").alias("items"))


def _slot(h: Column, slots: int) -> Column:
    return F.pmod(h, F.lit(slots)).cast("int") + 1


def hits(docs: DataFrame, items: DataFrame, width: int = WIDTH, text: str = "text",
         item_id: str = "item_id", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """Per row of ``docs`` its id, ``_row`` (unique per row), ``n_words`` and
    every benchmark window in it: ``hit`` (start, size) and ``items``, null in
    the one row of a document without any.  Only ids leave the scan."""
    grams = benchmark_windows(items, width, item_id)
    sizes = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())  # at most `width` sizes were collected
    small = total <= broadcast_windows
    slots = min(BITMAP_SLOTS, 1 << max(10, (32 * total).bit_length()))
    bitmap = bytearray(slots)
    if small:
        for size in sizes:
            own = grams.filter(F.col("size") == size).select(window_hashes(F.split("gram", " "), size, lambda h: F.get(h, F.lit(0))).alias("h"))
            for r in own.select(_slot(F.col("h"), slots).alias("s")).distinct().collect():
                bitmap[r["s"] - 1] = 1
    set_bits, one = F.lit(bitmap), F.lit(bytearray(b"\1"))
    none = F.array().cast("array<struct<i:int,size:int,gram:string>>")

    def of_size(w: Column, size: int) -> Column:
        def found(hashes: Column) -> Column:
            at = F.transform(hashes, lambda h, i: F.when(
                F.substring(set_bits, _slot(h, slots), F.lit(1)) == one, i)) if small else F.transform(hashes, lambda h, i: i)
            return F.transform(F.filter(at, lambda i: i.isNotNull()), lambda i: F.struct(
                (i + 1).alias("i"), F.lit(size).alias("size"), window_text(w, i, size).alias("gram")))
        return window_hashes(w, size, found)

    rows = docs.withColumn("_w", normal_words(F.col(text))).withColumns({
        "n_words": F.size("_w").cast("bigint"),
        "_f": F.concat(none, *(of_size(F.col("_w"), s) for s in sorted(sizes)))})
    ids = [c for c in docs.columns if c != text]
    rows = rows.select(*ids, "n_words", F.explode_outer("_f").alias("_x"))
    known = grams.select(F.col("gram").alias("_g"), "items")
    return rows.join(F.broadcast(known) if small else known, F.col("_x.gram") == F.col("_g"), "left").select(
        *ids, "n_words", "items",
        F.when(F.col("_g").isNotNull(), F.struct(F.col("_x.i").alias("i"), F.col("_x.size").alias("size"))).alias("hit"))


def _union_length(spans: Column) -> Column:
    """Number of words covered by (start, size) spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(
        F.array_sort(spans), start,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["i"] + x["size"] - F.greatest(x["i"], a["end"]))).alias("n"),
            F.greatest(a["end"], x["i"] + x["size"]).alias("end")),
        lambda a: a["n"])


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_words, n_hit (words
    inside any occurrence of a window), n_items, items_sha256, contaminated and
    spans, the sorted (start, size) of the occurrences."""
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                        F.xxhash64(F.col(text)).alias("text_hash"),
                        F.monotonically_increasing_id().alias("_row"))
    found = hits(keyed, items, item_id=item_id, **options) \
        .groupBy("doc_id", "text_hash", "_row", "n_words") \
        .agg(F.array_sort(F.collect_set("hit")).alias("spans"),
             F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_ids"))
    return found.withColumns({
        "n_hit": _union_length(F.col("spans")), "n_items": F.size("_ids").cast("bigint"),
        "items_sha256": F.sha2(F.array_join("_ids", ","), 256),
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).drop("_row", "_ids")


def remove_documents(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = report(docs, items, doc_id, text, **options).filter("contaminated") \
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"))
    return without(docs, bad, doc_id, text)


def remove_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 **options) -> DataFrame:
    """``docs`` with the hit words cut out of the contaminated texts, and what
    stands between two hit words; other texts are as they were."""
    bad = report(docs, items, doc_id, text, **options).filter("contaminated") \
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"), F.col("spans").alias("_s")).distinct()
    bad = written(bad, "contaminated")
    side = F.broadcast(bad) if (bad.agg(F.sum(F.size("_s"))).first()[0] or 0) <= BROADCAST_KEYS else bad
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"({RAW_BETWEEN}|{RAW_BETWEEN.replace('[', '[^')})"), F.lit(1))

    def kept(p: Column) -> Column:
        first = F.when(F.get(p, F.lit(0)).rlike(f"^{RAW_BETWEEN}"), 1).otherwise(0)

        def hit(word: Column) -> Column:
            return F.exists("_s", lambda s: (word + 1 >= s["i"]) & (word + 1 < s["i"] + s["size"]))

        def stays(k: Column) -> Column:
            at = k - first
            word = F.floor(at / 2)
            return ~F.when(at % 2 == 0, hit(word)).otherwise(hit(word) & hit(word + 1))

        return F.array_join(F.filter(p, lambda x, k: stays(k)), "")

    rows = boxed(docs, id=F.col(doc_id), text=F.col(text), h=F.xxhash64(F.col(text)))
    out = rows.join(side, F.col("id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
    return unboxed(out, docs.columns, **{text: F.when(F.col("_s").isNull(), F.col("text")).otherwise(let(pieces, kept))})
