"""Texts to token ids by the ``tokenizers`` library, inside Arrow batches."""

from __future__ import annotations

import json
import os
import re
import sys
import types
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import SparkSession

#: Words that one Python worker keeps before it forgets those it met once.
CACHE_WORDS = 300_000
#: New words that are encoded together: the library holds about a kilobyte a word meanwhile.
LEARN_WORDS = 20_000
#: Bytes of text that are encoded together.
CHUNK_BYTES = 4_000_000


def tokenizer_json(spark: SparkSession, path: str | None, name: str):
    """The tokenizer file as a broadcast string (a file of fixed size), so
    that executors need no copy of it.  ``path`` defaults to the file ``name``
    of the installed vocabularies."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(name)
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def worker_state(key, make):
    """An object that lives as long as the Python worker, over many tasks."""
    store = sys.modules.setdefault("tidewell_worker_state", types.ModuleType("tidewell_worker_state")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def byte_letters() -> list[str]:
    """The printable character of each byte in byte-level vocabularies: itself
    where it is printable, else the next of those from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


#: The shape of a tokenizer that lower-cases, drops white space and
#: parts letters from marks, so that words and marks are encoded on their own.
DROPS_SPACE = {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"],
               "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
#: Characters whose normal and lower-case form is one letter of Latin's first
#: blocks, or that are ASCII; the forms of others may end in a mark.
PLAIN_CHARS = "\x20-\x7e\xa1-įı-ňŊ-ž"
#: A mark that may belong to another one before it.
JOINED_MARK = rf"([^\pL\pN]|[^{PLAIN_CHARS}])[.,] "


class Encoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)``
    does.  For a tokenizer that drops white space, distinct blank-separated
    words are encoded once and looked up afterwards."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer
        spec = json.loads(source)
        self.full = Tokenizer.from_str(source)
        self.size = self.full.get_vocab_size()
        shape = {"normalizer": [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])],
                 "pre_tokenizer": [x["type"] for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]}
        first = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        shape["pattern"] = first.get("pattern", {}).get("Regex")
        self.by_word = shape == DROPS_SPACE
        if self.by_word:
            self.pieces = regex.compile(shape["pattern"])
            contents = [x["content"] for x in spec["added_tokens"]]
            special = "|".join(map(re.escape, contents))
            self.mark = os.path.commonprefix(contents)
            # words for the whole tokenizer: special strings, and other letters
            self.odd = re.compile(f"[^{PLAIN_CHARS}]|{special}")
            self.merges = Tokenizer.from_str(json.dumps(
                {**spec, "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": []}))
            self.merges.model._resize_cache(0)  # every word comes once
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends_word = np.zeros(self.size, bool)
            self.ends_word[[i for t, i in spec["model"]["vocab"].items() if t.endswith(suffix)]] = True
            self.letters = dict(enumerate(byte_letters()))
            self._clear()

    def _clear(self):
        self.index = {"": 0}
        self.starts, self.lengths, self.met = (np.zeros(1024, np.int64) for _ in range(3))
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _forget(self) -> None:
        """Keeps the words met more than once, or none if these are too many too."""
        n = len(self.index)
        keep = np.append(np.array([False]), self.met[1:n] > 1)
        if 2 * keep.sum() > CACHE_WORDS:
            return self._clear()
        flat, lens = self._ids(np.flatnonzero(keep))
        words = [w for w, k in zip(self.index, keep.tolist()) if k]
        self._clear()
        self._put(words, flat, lens)

    def _put(self, words: list[str], flat: np.ndarray, lens: np.ndarray) -> None:
        at, n = len(self.index), len(words)
        for name, need in (("starts", at + n), ("lengths", at + n), ("met", at + n), ("ids", self.used + len(flat))):
            old = getattr(self, name)
            if need > len(old):
                grown = np.zeros(max(need, 2 * len(old)), old.dtype)
                grown[:len(old)] = old
                setattr(self, name, grown)
        self.lengths[at:at + n] = lens
        self.starts[at:at + n] = self.used + np.cumsum(lens) - lens
        self.ids[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        self.index.update(zip(words, range(at, at + n)))

    def _places(self, words: list[str]) -> np.ndarray:
        """Places of ``words`` in the store, learning those that are new."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            words = [words[i] for i in new.tolist()]
            for k in range(0, len(words), LEARN_WORDS):
                self._learn(set(words[k:k + LEARN_WORDS]).difference(self.index))
            at[new] = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        met = np.bincount(at)
        self.met[:len(met)] += met
        return at

    def _ids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words at these places, and their number of each."""
        lens = self.lengths[at]
        ends = np.cumsum(lens)
        return self.ids[np.repeat(self.starts[at] - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)], lens

    def _learn(self, words: set[str]) -> None:
        if self.odd.search("\x20".join(words)):
            odd = [w for w in words if self.odd.search(w)]
            ids = [e.ids for e in self.full.encode_batch_fast(odd, add_special_tokens=False)]
            self._put(odd, np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids)))
            words = words.difference(odd)
        parts, cut = [], {}
        for w in words:  # the usual shapes are cut without the pattern
            if w.isalpha():
                if w.islower():
                    parts.append(w)
                else:
                    cut[w] = [w.lower()]
            elif w[-1] in ".," and w[:-1].isalpha():
                cut[w] = [w[:-1].lower(), w[-1]]
            else:
                cut[w] = self.pieces.findall(w.lower())
        # one by one: with two sets Python walks through all of the second
        parts += set(chain.from_iterable(cut.values())).difference(parts).difference(self.index)
        if parts:
            spelled = " ".join(parts)
            if not spelled.isascii():
                spelled = " ".join(p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in parts)
            flat = np.array(self.merges.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, np.uint32)
            self._put(parts, flat, np.diff(np.flatnonzero(self.ends_word[flat]), prepend=-1))
        whole = [w for w, c in cut.items() if w not in self.index]
        if whole:
            flat, lens = self._ids(self._places(list(chain.from_iterable(cut[w] for w in whole))))
            last = np.cumsum(np.fromiter((len(cut[w]) for w in whole), np.int64, len(whole)))
            ends = np.append(0, np.cumsum(lens))[np.append(0, last)]
            self._put(whole, flat, np.diff(ends))

    def _spaced(self, texts: pa.Array) -> pa.Array:
        """The texts with blanks for line ends, in lower case, and a blank before
        commas and stops at the ends of words: the same ids from fewer
        different words.  A text where a mark may belong to another one before
        it keeps its marks, and one that may hold special tokens its case."""
        plain = pc.replace_substring(texts, "\n", " ")
        if self.mark and not re.search("[A-Za-z]", self.mark) and not pc.any(pc.match_substring(texts, self.mark)).as_py():
            plain = pc.ascii_lower(plain)
        apart = pc.replace_substring(pc.replace_substring(plain, ", ", " , "), ". ", " . ")
        return pc.if_else(pc.match_substring_regex(plain, JOINED_MARK), plain, apart)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.by_word:
            ids = [e.ids for e in self.full.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))
        if len(self.index) > CACHE_WORDS:
            self._forget()
        cut = pc.split_pattern(self._spaced(texts), " ")
        words = cut.flatten().dictionary_encode()  # so that Python sees each word once
        at = self._places(words.dictionary.to_numpy(zero_copy_only=False).tolist())[words.indices.to_numpy()]
        flat, lens = self._ids(at)
        last = np.cumsum(pc.list_value_length(cut).to_numpy()) - 1
        return flat, np.diff(np.cumsum(lens)[last], prepend=0)

    def encode(self, texts: list[str | None] | pa.Array):
        """Yields (from, to, flat ids, ids per text) for runs of ``texts``; null
        is empty."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy())
        at = 0
        while at < len(texts):
            before = int(size[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(size, before + CHUNK_BYTES, side="right")))
            yield at, to, *self._encode(texts[at:to])
            at = to


def encoder(source: str) -> Encoder:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    return worker_state(("encoder", hash(source)), lambda: Encoder(source))


def with_end(flat: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each text."""
    counts = counts + 1
    ends = np.cumsum(counts) - 1
    out = np.empty(len(flat) + len(counts), flat.dtype)
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[ends] = end_id
    out[inner] = flat
    return out, counts
