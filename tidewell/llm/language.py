"""Language identification by naive Bayes over hashed n-grams (operator 6).

Lower-cased texts are cut into character n-grams, hashed into ``buckets``
features.  Training adds up feature counts per language inside the tasks and
then in one aggregation of at most languages x buckets rows; the matrix of log
probabilities, of that fixed size, is broadcast.  Scoring adds up the rows of
the features of a batch of texts in numpy.  Characters that are no letters
count as blanks, and runs of them as one, so marks and digits say nothing.

Only rows with a language and a text train.  Edge cases: a text that is null
or has no letter is ``und`` with score 0; without any training row every text
is; ties go to the language that sorts first; repeated rows count and are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.encode import worker_state

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
CHUNK_CHARS = 500_000
_MIX = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


def _letters() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    return worker_state("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def features(texts: list[str | None], letters: np.ndarray, orders=ORDERS, buckets: int = BUCKETS):
    """(bucket of every n-gram, text it is in, whether each text has a letter)."""
    joined = " ".join((t or "").lower() + " " for t in texts)
    code = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    # every text and the blank behind it; lower() may change a text's length
    size = np.fromiter((len((t or "").lower()) + 2 for t in texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), size)[:len(code)]
    code = np.where(letters[code], code, np.uint32(32))
    blank = code == 32
    keep = ~blank | np.append(True, ~blank[:-1])
    code, owner, blank = code[keep], owner[keep], blank[keep]
    has = np.zeros(len(texts), bool)
    has[owner[~blank]] = True
    out, of = [], []
    for n in orders:
        if len(code) < n:
            continue
        h = np.full(len(code) - n + 1, n, np.uint32)
        for k in range(n):
            h = (h ^ code[k:len(code) - n + 1 + k]) * _MIX[0]
            h ^= h >> np.uint32(15)
        h *= _MIX[1]
        h ^= h >> np.uint32(16)
        inside = owner[:len(h)] == owner[n - 1:]
        inside &= ~blank[:len(h)] if n == 1 else True
        out.append((h % np.uint32(buckets))[inside])
        of.append(owner[:len(h)][inside])
    return (np.concatenate(out) if out else np.zeros(0, np.uint32)), (np.concatenate(of) if of else np.zeros(0, np.int64)), has


def _runs(texts: list[str | None]):
    at = 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars + len(texts[to] or "") <= CHUNK_CHARS):
            chars += len(texts[to] or "")
            to += 1
        yield at, to
        at = to


class LanguageModel:
    def __init__(self, languages: list[str], log_prior: np.ndarray, log_prob: np.ndarray):
        """``log_prob``: buckets x languages."""
        self.languages, self.log_prior, self.log_prob = languages, log_prior, log_prob


def train(rows: DataFrame, text: str = "text", lang: str = "lang", buckets: int = BUCKETS, smooth: float = 0.5) -> LanguageModel:
    """The model of all rows of ``rows`` with a language and a text."""

    def count(batches):
        letters = _letters()
        total: dict[str, np.ndarray] = {}
        for b in batches:
            langs, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at, to in _runs(texts):
                bucket, of, _ = features(texts[at:to], letters, buckets=buckets)
                names = sorted(set(langs[at:to]))
                code = np.array([names.index(x) for x in langs[at:to]])
                n = np.bincount(code[of] * buckets + bucket, minlength=len(names) * buckets).reshape(len(names), -1)
                for i, x in enumerate(names):
                    row = total.setdefault(x, np.zeros(buckets + 1, np.int64))
                    row[:-1] += n[i]
                    row[-1] += int((code == i).sum())  # the last one counts texts
        for x, row in total.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x] * len(at)), "bucket": pa.array(at, pa.int32()), "n": pa.array(row[at])})

    found = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text")) \
        .mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # languages x (buckets + 1) rows at most, whatever the number of texts
    table = found.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    counts = np.zeros((buckets + 1, len(table)))
    for j, r in enumerate(table):
        counts[r["b"], j] = r["n"]
    texts, counts = counts[-1], counts[:-1] + smooth
    return LanguageModel([r["lang"] for r in table], np.log((texts + 1) / (texts.sum() + max(1, len(table)))),
                         np.log(counts / counts.sum(axis=0, keepdims=True)))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` without its text, then lang_pred and score, the
    predicted language's posterior probability."""
    shipped = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, np.ascontiguousarray(model.log_prob.T, np.float32)))
    ids = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    schema = docs.select(*ids, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def of(batches):
        languages, prior, prob = shipped.value
        letters = _letters()
        buckets = prob.shape[1]
        for b in batches:
            texts = b.column(b.schema.get_field_index(text)).to_pylist()
            names, scores = [], []
            for at, to in _runs(texts):
                bucket, owner, has = features(texts[at:to], letters, buckets=buckets)
                if languages:
                    total = np.stack([np.bincount(owner, weights=p[bucket], minlength=to - at) for p in prob], axis=1) + prior
                    best = total.argmax(axis=1)
                    score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                else:
                    has[:] = False
                names += [languages[best[i]] if has[i] else "und" for i in range(to - at)]
                scores += [float(score[i]) if has[i] else 0.0 for i in range(to - at)]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in ids] + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*ids, "lang_pred", "score"])

    return docs.select(*ids, text).mapInArrow(of, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that do not train: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
