"""Token counts by rank-synchronous merging in arrays (operator 10).

The pre-tokens of a batch of texts that the worker has not met yet are laid
out as one ragged array of byte symbols.  In each round every sequence finds
the lowest rank among its adjacent pairs and merges all places of that pair at
once (from the left where they overlap), which is what merging one by one
gives: a merge that uses a new symbol always has a higher rank.  Sequences
without a pair of the vocabulary leave the array with the number of symbols
they still have.  A text's count is the sum over its pre-tokens.

Strings of the special tokens inside a text are one token each, as the
library's default has it.

Edge cases: null and empty texts have no token; repeated rows are counted row
by row; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import text_or_empty
from tidewell.llm.encode import byte_letters, tokenizer_json, worker_state

CACHE_WORDS = 400_000
CHUNK_CHARS = 2_000_000
#: The pattern of byte-level pre-tokens, and its white space.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
NO_RANK = np.int64(1) << 40
#: Bytes from which on a word is merged by places kept by rank.
LONG_WORD = 1024


class RankMerger:
    def __init__(self, source: str):
        spec = json.loads(source)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.size = max(vocab.values()) + 1
        self.byte_id = np.array([vocab[c] for c in byte_letters()], np.int64)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.int64(1) << 62)
        self.rank, self.made = np.append(order, NO_RANK), np.append(made[order], -1)
        self.words = regex.compile(PATTERN)
        special = [x["content"] for x in spec["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.known: dict[str, int] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of the pairs among the merges; the last one if not there."""
        key = a * self.size + b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, at, len(self.keys) - 1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols that are left of each word after all merges."""
        out = np.empty(len(words), np.int64)
        long = np.fromiter((len(w) > LONG_WORD for w in words), bool, len(words))
        for k, some in ((~long, self._short), (long, self._long)):
            at = np.flatnonzero(k)
            if len(at):
                out[at] = some([words[i] for i in at.tolist()])
        return out

    def _long(self, words: list[bytes]) -> np.ndarray:
        """As ``_short``, for words of many symbols and so of many rounds: the places
        of pairs are kept by rank, and a round looks at those of the least rank and, after
        merging them, at their neighbours only."""
        lens = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lens)
        n, none = len(sym), len(self.keys) - 1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # n and -1: no symbol
        edge = np.flatnonzero(owner[1:] != owner[:-1])
        after[edge], before[edge + 1], after[-1] = n, -1, n
        pair = np.full(n, none)
        places: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def look(at: np.ndarray) -> None:
            """The pairs that begin at ``at``, filed by rank."""
            right = after[at]
            there = right < n
            pair[at] = none
            at, right = at[there], right[there]
            pair[at] = self.ranks(sym[at], sym[right])
            at = at[pair[at] < none]
            rank = self.rank[pair[at]]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank, prepend=-1))
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(at)]):
                r = int(rank[lo])
                if r not in places:
                    places[r] = []
                    heapq.heappush(queue, r)
                places[r].append(at[lo:hi])

        look(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[self.rank[pair[at]] == r]  # the others have changed since
            if not len(at):
                continue
            # of places in a row only every other one, from the left, can merge
            run = np.append(True, after[at[:-1]] != at[1:])
            step = np.arange(len(at))
            at = at[(step - np.maximum.accumulate(np.where(run, step, 0))) % 2 == 0]
            gone = after[at]
            sym[at] = self.made[pair[at]]
            pair[gone] = none
            after[at] = after[gone]
            has = after[at] < n
            before[after[at[has]]] = at[has]
            lens -= np.bincount(owner[at], minlength=len(lens))
            left = before[at]
            look(np.unique(np.concatenate([at, left[left >= 0]])))
        return lens

    def _short(self, words: list[bytes]) -> np.ndarray:
        lens = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lens)
        out = lens.copy()
        while len(sym) > 1:
            inner = owner[:-1] == owner[1:]
            pair = np.where(inner, self.ranks(sym[:-1], sym[1:]), len(self.keys) - 1)
            rank = np.append(self.rank[pair], NO_RANK)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            merge = (rank == np.repeat(least, size)) & (rank < NO_RANK)
            at = np.flatnonzero(merge)
            if not len(at):
                break
            # of places in a row only every other one, from the left, can merge
            run = np.append(True, np.diff(at) > 1)
            step = np.arange(len(at))
            at = at[(step - np.maximum.accumulate(np.where(run, step, 0))) % 2 == 0]
            sym[at] = self.made[pair[at]]
            alive = np.ones(len(sym), bool)
            alive[at + 1] = False
            out -= np.bincount(owner[at], minlength=len(out))
            alive &= np.repeat(least < NO_RANK, size)
            sym, owner = sym[alive], owner[alive]
        return out

    def count_texts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        extra = np.zeros(len(texts), np.int64)
        find = self.words.findall
        cut = []
        for i, t in enumerate(texts):
            if self.special and self.special.search(t):
                parts = self.special.split(t)
                extra[i] = len(parts) - 1
                cut.append([w for p in parts for w in find(p)])
            else:
                cut.append(find(t))
        new = list(set(chain.from_iterable(cut)).difference(self.known))
        if new:
            self.known.update(zip(new, self.counts([w.encode() for w in new]).tolist()))
        of = self.known.__getitem__
        return extra + np.fromiter((sum(map(of, words)) for words in cut), np.int64, len(cut))


def count_tokens(docs: DataFrame, text: str = "text", tokenizer: str | None = None, limit: int = 512) -> DataFrame:
    """The columns of ``docs`` without its text, then n_bytes, n_tokens and
    over_limit (more than ``limit`` tokens)."""
    source = tokenizer_json(docs.sparkSession, tokenizer, "byte_bpe_50k.json")
    ids = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    zero = F.lit(0).cast("bigint")
    schema = docs.select(*ids, zero.alias("n_bytes"), zero.alias("n_tokens"), F.lit(False).alias("over_limit")).schema

    def of(batches):
        merger = worker_state(("ranks", hash(source.value)), lambda: RankMerger(source.value))
        for b in batches:
            texts = text_or_empty(b.column(b.schema.get_field_index(text)).to_pylist())
            n, at = [], 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to]) <= CHUNK_CHARS):
                    chars += len(texts[to])
                    to += 1
                n.append(merger.count_texts(texts[at:to]))
                at = to
            n = np.concatenate(n) if n else np.zeros(0, np.int64)
            size = np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(c)) for c in ids] + [pa.array(size), pa.array(n), pa.array(n > limit)],
                names=[*ids, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(*ids, text).mapInArrow(of, schema)
