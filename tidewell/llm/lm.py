"""LM scoring by a hierarchical Pitman-Yor model of word pairs (operator 1).

Every word that occurs before another has a restaurant: the words after it are
its customers, the tables they sit at are customers of the parent restaurant
that all contexts share, and that one's base is uniform over the vocabulary and
one unknown word.  Seating is sampled by Gibbs moves (a customer leaves its
table and sits down again), and the predictive probabilities of several sampled
seatings are averaged.

One shuffle moves the tokens: packed by numpy, with 64-bit word hashes, to
``buckets`` of about ``bucket_tokens`` by their context; a context with more than
an eighth of a bucket is split by pair, and its totals are exchanged.  A
bucket seats its restaurants (with its own share of the counts as the parent's
probabilities), and sends counts and tables per word to the parent; the parent,
split by word, seats these and answers each bucket's words; the bucket seats its
customers again with these and the estimated discount, moves every customer once
per sweep, and scores its tokens.  So a bucket meets a third of all
rows under one context only as its own part, and what is sent is about one row
per distinct word and bucket.  The token shuffle is read twice and written once
(the same exchange is reused).  Tokens under split contexts are scored last, when
the tables of all buckets are added up, so that a context's probabilities sum to one
however many buckets hold it.

Edge cases: null and empty texts are one end token; rows with a null id train;
repeated rows count, and are scored each; without training rows every
probability is 1 (score 0); an empty table gives an empty result.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import text_or_empty, written

BUCKET_TOKENS = 2_000_000
FLUSH_TOKENS = 2_500_000
CHUNK_BYTES = 1 << 20
#: Bytes of text that a token takes, for the number of buckets before tokens are counted.
TOKEN_BYTES = 6
END, START = np.uint64(1), np.uint64(2)
DISCOUNT, STRENGTH = 0.8, 1.0
#: Steps of a sweep; a dish with more customers moves several of them in a step.
STEPS = 32
PARENT_SWEEPS = 5
#: Of the type of the tables' sizes: numpy adds in place many times faster without a cast.
ONE = np.int32(1)


# ---- tokens --------------------------------------------------------------------------------

class Hasher:
    """64-bit hashes of the words of texts: a polynomial over the bytes, from
    prefix sums of the whole buffer, then mixed."""

    def __init__(self):
        rng = np.random.default_rng(20240229)
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        upper = np.arange(65, 91)
        self.value[upper] = self.value[upper + 32]
        self.blank = np.zeros(256, bool)
        self.blank[[32, *range(9, 14)]] = True
        self.base = np.uint64(0x9E3779B97F4A7C15)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (self.base, self.inverse))

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word, number of words of each text)."""
        parts = [t.encode() for t in texts]
        buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        self._powers(len(buf) + 1)
        blank = self.blank[buf]
        edge = np.diff(blank.view(np.int8), prepend=1)
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.value[buf] * self.up[:len(buf)], out=total[1:])
        h = (total[end] - total[start]) * self.down[start]
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(factor)
        h ^= h >> np.uint64(32)
        lens = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        return np.maximum(h, np.uint64(3)), np.diff(np.searchsorted(start, np.cumsum(lens)), prepend=0)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, token, tokens of each text), with an end token per text."""
        h, n = self.words(texts)
        n = n + 1
        ends = np.cumsum(n) - 1
        token = np.empty(len(h) + len(n), np.uint64)
        token[ends] = END
        token[np.delete(np.arange(len(token)), ends)] = h
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[ends - n + 1] = START
        return context, token, n


def _chunks(texts: list[str]):
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= CHUNK_BYTES):
            size += len(texts[to])
            to += 1
        yield at, to
        at = to


def _pack(**arrays) -> bytes:
    """Arrays as compressed bytes: sorted hashes as the bytes of their steps, first
    byte first, of which the upper are mostly zero; integers in the narrowest type."""
    z = zstandard.ZstdCompressor(level=1)
    out = {}
    for k, a in arrays.items():
        if a.dtype == np.uint64:
            out[k] = "steps", z.compress(np.ascontiguousarray(np.diff(a, prepend=np.uint64(0)).view("u1").reshape(-1, 8).T).tobytes())
            continue
        if a.dtype.kind != "f":
            kind = next(t for t in ("u1", "u2", "u4", "i8") if t == "i8" or not len(a) or (0 <= a.min() and a.max() <= np.iinfo(t).max))
            a = a.astype(kind)
        out[k] = a.dtype.str, z.compress(a.tobytes())
    return pickle.dumps(out)


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    z = zstandard.ZstdDecompressor()
    out = {}
    for k, (t, b) in pickle.loads(data).items():
        b = z.decompress(b)
        if t == "steps":
            steps = np.ascontiguousarray(np.frombuffer(b, "u1").reshape(8, -1).T).view("<u8").ravel()
            out[k] = np.cumsum(steps, dtype=np.uint64)
        else:
            out[k] = np.frombuffer(b, t)
    return out


def _place(h: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash, rising with it."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (b * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(31))


def common_contexts(docs: DataFrame, buckets: int) -> np.ndarray:
    """Contexts that may have an eighth of a bucket or more: those with half as
    large a share in some partition, of which there are at most 16 x buckets in
    each; a sorted array of fewer than 16 x buckets in all."""
    def count(batches):
        hasher = Hasher()
        seen, total, size = [], 0, 0
        for b in batches:
            texts = text_or_empty(b.column(0).to_pylist())
            for at, to in _chunks(texts):
                context, _, _ = hasher.tokens(texts[at:to])
                u, n = np.unique(context, return_counts=True)
                total += len(context)
                seen.append((u, n))
                size += len(u)
                if size > 2_000_000:
                    seen = [_summed(seen)]
                    size = len(seen[0][0])
        if total:
            u, n = _summed(seen)
            big = n * 16 * buckets >= total
            rows = {"h": np.append(u[big].view(np.int64), 0), "n": np.append(n[big], total), "total": np.append(np.zeros(big.sum(), bool), True)}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in rows.items()})

    rows = docs.select("text").mapInArrow(count, "h long, n long, total boolean").groupBy("total", "h").agg(F.sum("n").alias("n"))
    rows = written(rows, "contexts")
    total = rows.filter("total").agg(F.sum("n")).first()[0] or 0
    found = rows.filter(~F.col("total") & (16 * buckets * F.col("n") >= total)).select("h").collect() if buckets > 1 else []
    return np.sort(np.array([r["h"] for r in found], np.int64).view(np.uint64))


def _summed(parts: list) -> tuple[np.ndarray, np.ndarray]:
    u, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return u, np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _is_in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _dealt(context, token, doc, docs: np.ndarray, common: np.ndarray, buckets: int):
    """(bucket, payload) of the tokens of a run of documents."""
    key = np.where(_is_in(common, context), _mixed(context, token), context)
    # contexts START and END stand in the lowest places; words are spread
    key = np.where(key < 3, _mixed(key, key + np.uint64(7)), key)
    order = np.argsort(key)
    part = _place(key[order], buckets)
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(order))):
        at = order[lo:hi]
        u, of, n = np.unique(context[at], return_inverse=True, return_counts=True)
        at = at[np.argsort(of, kind="stable")]
        w, wi = np.unique(token[at], return_inverse=True)
        d, di = np.unique(doc[at], return_inverse=True)
        yield int(part[lo]), _pack(u=u, n=n, w=w, wi=wi, di=di, row=np.diff(docs[0][d], prepend=0), id=np.diff(docs[1][d], prepend=0),
                                   none=docs[2][d], train=docs[3][d])


# ---- seating -------------------------------------------------------------------------------

class Seating:
    """Tables of the dishes of many restaurants.  Dish i has ``c[i]`` customers in
    restaurant ``r[i]``.  A dish with one customer has one table; the others have
    a seat (table) per customer, the tables' sizes, and a stack of free tables.
    ``total`` counts the tables of each restaurant; other buckets hold ``elsewhere``
    times as many of the same restaurant.  Moves of one step are made for all dishes
    at once, each from the tables as they were before it."""

    def __init__(self, c, r, restaurants, p, rng, discount=DISCOUNT, strength=STRENGTH, elsewhere=None):
        self.d, self.s, self.rng = discount, strength, rng
        self.t = np.minimum(c, 1)
        self.c, self.r = c, r
        self.total = np.bincount(r, self.t, restaurants)
        self.share = np.ones(restaurants) if elsewhere is None else 1 + elsewhere
        self.many = np.flatnonzero(c > 1)
        self.n = c[self.many]
        self.off = np.cumsum(self.n) - self.n
        size = int(self.n.sum())
        self.seat, self.size = np.zeros(size, np.int32), np.zeros(size, np.int32)
        self.size[self.off] = 1
        self._seat_all(p[self.many])
        self.free = np.repeat(self.n, self.n) - 1 - (np.arange(size) - np.repeat(self.off, self.n))

    def _new(self, k, seated, p, t):
        """Probability that the next customer of dishes ``k`` opens a table."""
        r = self.r[self.many[k]]
        a = (self.s + self.d * self.total[r] * self.share[r]) * p
        return a / (a + seated - self.d * t)

    def _join(self, off, seated, skip=None, many=1):
        """Table of a random seated customer, taken with a share of (size - d) / size;
        not one of ``many`` from seat ``skip`` on."""
        out = np.empty(len(off), np.int64)
        todo = np.arange(len(off))
        while len(todo):
            j = (self.rng.random(len(todo)) * seated[todo]).astype(np.int64)
            if skip is not None:
                j += (j >= skip[todo]) * (many if np.isscalar(many) else many[todo])
            table = self.seat[off[todo] + j]
            size = self.size[off[todo] + table]
            ok = self.rng.random(len(todo)) * size < size - self.d
            out[todo[ok]] = table[ok]
            todo = todo[~ok]
        return out

    def _seat_all(self, p):
        """First seating: one customer at a time, later in runs of half as many as
        sit already."""
        done = 1
        t = np.ones(len(self.n), np.int64)
        active = np.arange(len(self.n))
        while len(active):
            run = 1 if done < 16 else done // 2
            m = np.minimum(run, self.n[active] - done)
            k = np.repeat(active, m)
            j = done + np.arange(len(k)) - np.repeat(np.cumsum(m) - m, m)
            new = self.rng.random(len(k)) < np.repeat(self._new(active, done, p[active], t[active]), m)
            old = np.flatnonzero(~new)
            table = np.empty(len(k), np.int64)
            table[old] = self._join(self.off[k[old]], np.full(len(old), done))
            before = np.cumsum(new) - new
            first = np.repeat(before[np.cumsum(m) - m], m)
            table[new] = (t[k] + before - first)[new]
            self.seat[self.off[k] + j] = table
            np.add.at(self.size, self.off[k] + table, ONE)
            opened = np.bincount(k[new], minlength=len(t))
            t += opened
            np.add.at(self.total, self.r[self.many[k[new]]], 1.0)
            done += run
            active = active[self.n[active] > done]
        self.t[self.many] = t

    def move(self, p):
        """One customer of every dish leaves and sits down again."""
        n, off, t = self.n, self.off, self.t[self.many]
        r = self.r[self.many]
        j = (self.rng.random(len(n)) * n).astype(np.int64)
        table = self.seat[off + j].astype(np.int64)
        self.size[off + table] -= 1
        gone = self.size[off + table] == 0
        t = t - gone
        self.free[(off + n - t - 1)[gone]] = table[gone]
        np.add.at(self.total, r[gone], -1.0)
        new = self.rng.random(len(n)) < self._new(np.arange(len(n)), n - 1, p[self.many], t)
        stay = np.flatnonzero(~new)
        table[stay] = self._join(off[stay], (n - 1)[stay], j[stay])
        table[new] = self.free[(off + n - t - 1)[new]]
        self.seat[off + j] = table
        self.size[off + table] += 1
        np.add.at(self.total, r[new], 1.0)
        self.t[self.many] = t + new

    def sweep(self, p):
        """Every customer of every dish leaves and sits down again, in ``STEPS`` steps
        (a dish with fewer customers: one in each of as many steps)."""
        m = -(-self.n // STEPS)
        for k in range(STEPS):
            lo = k * m
            at = np.flatnonzero(lo < self.n)
            if not len(at):
                return
            self._move_run(at, lo[at], np.minimum(m[at], self.n[at] - lo[at]), p[self.many[at]])

    def _move_run(self, at, lo, m, p):
        """``m`` customers of each dish ``at``, from seat ``lo`` on, leave together and sit
        down again, each from the tables that the others left."""
        n, off, i = self.n[at], self.off[at], self.many[at]
        r, t = self.r[i], self.t[i]
        of = np.repeat(np.arange(len(at)), m)
        rank = np.arange(len(of)) - np.repeat(np.cumsum(m) - m, m)
        seat = off[of] + lo[of] + rank
        np.add.at(self.size, off[of] + self.seat[seat], -ONE)
        gone = np.unique((off[of] + self.seat[seat])[self.size[off[of] + self.seat[seat]] == 0])
        g = np.searchsorted(off, gone, "right") - 1
        left = np.bincount(g, minlength=len(at))
        self.free[off[g] + n[g] - t[g] + np.arange(len(g)) - (np.cumsum(left) - left)[g]] = gone - off[g]
        t = t - left
        np.add.at(self.total, r, -left.astype(float))
        new = self.rng.random(len(of)) < self._new(at, n - m, p, t)[of]
        table = np.empty(len(of), np.int64)
        old = of[~new]
        table[~new] = self._join(off[old], (n - m)[old], lo[old], m[old])
        fresh = of[new]
        opened = np.bincount(fresh, minlength=len(at))
        table[new] = self.free[off[fresh] + n[fresh] - t[fresh] - 1 - (np.arange(len(fresh)) - (np.cumsum(opened) - opened)[fresh])]
        self.seat[seat] = table
        np.add.at(self.size, off[of] + table, ONE)
        np.add.at(self.total, r, opened.astype(float))
        self.t[i] = t + opened


# ---- buckets -------------------------------------------------------------------------------

class Bucket:
    """Tokens of one bucket: contexts, words, documents and pairs."""

    def __init__(self, payloads: list[bytes]):
        parts = sorted((_unpack(x) for x in payloads), key=lambda x: int(x["row"][0]))
        self.contexts, self.words = (np.unique(np.concatenate([x[k] for x in parts])) for k in ("u", "w"))
        u = np.concatenate([np.repeat(np.searchsorted(self.contexts, x["u"]), x["n"]) for x in parts])
        w = np.concatenate([np.searchsorted(self.words, x["w"])[x["wi"]] for x in parts])
        at = np.cumsum([0] + [len(x["row"]) for x in parts])
        self.doc = np.concatenate([x["di"].astype(np.int64) + a for x, a in zip(parts, at)])
        self.row, self.id = (np.concatenate([np.cumsum(x[k].astype(np.int64)) for x in parts]) for k in ("row", "id"))
        self.none, train = (np.concatenate([x[k] for x in parts]).astype(bool) for k in ("none", "train"))
        pair, self.pair = np.unique(u * len(self.words) + w, return_inverse=True)
        self.u, self.w = pair // len(self.words), pair % len(self.words)
        self.c = np.bincount(self.pair[train[self.doc]], minlength=len(pair))

    def by_word(self, x):
        return np.bincount(self.w, x, len(self.words)).astype(np.int64)

    def by_context(self, x):
        return np.bincount(self.u, x, len(self.contexts)).astype(np.int64)

    def seated(self, seed: int, split: np.ndarray, buckets: int) -> Seating:
        """The first seating, with the words' shares in the bucket as parent; of the
        contexts ``split`` the bucket has about one part in ``buckets``."""
        share = (self.by_word(self.c) + 0.5) / (self.c.sum() + 0.5 * len(self.words) + 1)
        elsewhere = np.zeros(len(self.contexts))
        elsewhere[split] = buckets - 1
        return Seating(self.c, self.u, len(self.contexts), share[self.w], np.random.default_rng(seed), elsewhere=elsewhere)


def _send(bucket: int, data: list[bytes], seed: int, common: np.ndarray, buckets: int, parts: int):
    """(part, payload) for every part: counts and tables of its words for the
    parent, and the totals of its split contexts."""
    b = Bucket(data)
    split = np.flatnonzero(_is_in(common, b.contexts))
    seats = b.seated(seed, split, buckets)
    c, t = b.by_word(b.c), b.by_word(seats.t)
    one, two = int((b.c == 1).sum()), int((b.c == 2).sum())
    cu, tu = b.by_context(b.c)[split], seats.total[split].astype(np.int64)
    of_word, of_context = _place(_spread(b.words), parts), _place(_spread(b.contexts[split]), parts)
    for k in range(parts):
        w, s = of_word == k, of_context == k
        yield k, _pack(bucket=np.array([bucket]), w=b.words[w], c=c[w], t=t[w], u=b.contexts[split][s], cu=cu[s], tu=tu[s],
                       few=np.array([one, two]) if k == 0 else np.array([0, 0]))


def _spread(h: np.ndarray) -> np.ndarray:
    return _mixed(h, h + np.uint64(11))


def _answer(part: int, data: list[bytes], seed: int):
    """Seats the parent's words of one part; (bucket, payload) for each bucket, in
    the order of the words it sent, with the part's totals."""
    asked = sorted((_unpack(x) for x in data), key=lambda x: int(x["bucket"][0]))
    words, at = np.unique(np.concatenate([x["w"] for x in asked]), return_inverse=True)
    c = np.bincount(at, np.concatenate([x["c"] for x in asked]), len(words)).astype(np.int64)
    t = np.bincount(at, np.concatenate([x["t"] for x in asked]), len(words)).astype(np.int64)
    known = int((c > 0).sum())
    # the base gives every word the same; parts are equal shares of the vocabulary
    seats = Seating(t, np.zeros(len(t), np.int64), 1, np.full(len(t), 1 / max(known, 1)), np.random.default_rng(seed))
    for _ in range(PARENT_SWEEPS):
        seats.sweep(np.full(len(t), 1 / max(known, 1)))
    split, which = np.unique(np.concatenate([x["u"] for x in asked]), return_inverse=True)
    cu = np.bincount(which, np.concatenate([x["cu"] for x in asked]), len(split)).astype(np.int64) if len(split) else np.zeros(0, np.int64)
    tu = np.bincount(which, np.concatenate([x["tu"] for x in asked]), len(split)).astype(np.int64) if len(split) else np.zeros(0, np.int64)
    sums = np.array([int(c.sum()), known, int(t.sum()), int(seats.t.sum()), *sum(x["few"].astype(np.int64) for x in asked).tolist()])
    lo = np.cumsum([0] + [len(x["w"]) for x in asked])
    lu = np.cumsum([0] + [len(x["u"]) for x in asked])
    for k, x in enumerate(asked):
        w, u = at[lo[k]:lo[k + 1]], which[lu[k]:lu[k + 1]]
        yield int(x["bucket"][0]), _pack(part=np.array([part]), c=c[w], t=t[w], t0=seats.t[w], u=x["u"], cu=cu[u], tu=tu[u], own=x["tu"], sums=sums)


class Sampled:
    """A bucket's restaurants after all sweeps.  The probability of pair i is
    ``a[i] + b[i] * tables``, with the mean number of tables of its context: the
    bucket's own, or for the contexts ``split`` (places in the bucket) the sum over all buckets."""

    def __init__(self, data: list[bytes], answers: list[bytes], parts: int, seed: int, burn: int, samples: int, sweeps: int):
        b = self.bucket = Bucket(data)
        of_word = _place(_spread(b.words), parts)
        c, t, t0 = (np.zeros(len(b.words)) for _ in range(3))
        cu, elsewhere = b.by_context(b.c).astype(float), np.zeros(len(b.contexts))
        sums, split = np.zeros(6), []
        for x in map(_unpack, answers):
            sums += x["sums"]
            at = of_word == x["part"][0]
            c[at], t[at], t0[at] = x["c"], x["t"], x["t0"]
            at = np.searchsorted(b.contexts, x["u"])
            cu[at] = x["cu"]
            elsewhere[at] = x["tu"] / np.maximum(x["own"], 1) - 1
            split.append(at)
        n, vocabulary, tables, roots, one, two = sums
        self.split = np.sort(np.concatenate(split)).astype(np.int64) if split else np.zeros(0, np.int64)
        base = 1 / (vocabulary + 1)
        parent = (t - DISCOUNT * t0 + (STRENGTH + DISCOUNT * roots) * base) / (STRENGTH + tables)
        p = parent[b.w]
        # the share of pairs seen once among those seen once or twice says how much to take off
        d = min(0.98, max(0.3, one / (one + 2 * two))) if one else DISCOUNT
        seats = Seating(b.c, b.u, len(b.contexts), p, np.random.default_rng(seed), d, elsewhere=np.maximum(elsewhere, 0))
        own, total = np.zeros(len(b.c)), np.zeros(len(b.contexts))
        for k in range(burn + samples):
            for _ in range(sweeps):
                seats.sweep(p)
            if k >= burn:
                own += seats.t
                total += seats.total
        customers = STRENGTH + cu[b.u]
        self.a = (b.c - d * own / samples + STRENGTH * p) / customers
        self.b = d * p / customers
        self.tables = total / samples
        self.count, self.corpus = c.astype(np.int64), np.array([n, vocabulary], np.int64)
        self.discount, self.customers = d, cu


def _scores(bucket: int, sampled: Sampled, common: np.ndarray, parts: int):
    """(part, payload) of the bucket's share of its documents, by row: n (tokens),
    score, and id and none (no id) where the bucket has the document's first token;
    of each token its word's count; the tokens under split contexts, whose tables
    are not known yet, are a document, a context (place in ``common``), a and b each.
    So what is sent grows with the tokens, however many buckets share a document."""
    s, b = sampled, sampled.bucket
    open_pair = np.zeros(len(b.contexts), bool)
    open_pair[s.split] = True
    open_pair = open_pair[b.u]
    with np.errstate(divide="ignore"):
        score = np.where(open_pair, 0.0, np.log10(s.a + s.b * s.tables[b.u]))
    score = np.bincount(b.doc, score[b.pair], len(b.row)).astype(np.float32)
    n = np.bincount(b.doc, minlength=len(b.row))
    place = np.searchsorted(common, b.contexts)
    first = np.zeros(len(b.row), bool)
    first[b.doc[b.contexts[b.u[b.pair]] == START]] = True
    part = _place(_spread(b.row.astype(np.uint64)), parts)
    docs = np.lexsort((b.row, part))  # part after part, by row
    rank = np.empty(len(docs), np.int64)
    rank[docs] = np.arange(len(docs))
    tokens = np.argsort(rank[b.doc], kind="stable")
    cut = np.searchsorted(part[docs], np.arange(parts + 1))
    cut_tokens = np.append(0, np.cumsum(n[docs]))[cut]
    for p in range(parts):
        at, token = docs[cut[p]:cut[p + 1]], tokens[cut_tokens[p]:cut_tokens[p + 1]]
        if not len(at):
            continue
        value, which = np.unique(s.count[b.w[b.pair[token]]], return_inverse=True)
        later = token[open_pair[b.pair[token]]]
        pair, of = np.unique(b.pair[later], return_inverse=True)
        own = np.flatnonzero(first[at])
        yield p, _pack(bucket=np.array([bucket]), corpus=s.corpus, row=b.row[at].astype(np.uint64), n=n[at], score=score[at],
                       c=value, ci=which, at=own, id=b.id[at[own]], none=b.none[at[own]],
                       td=rank[b.doc[later]] - cut[p], tp=of, pi=place[b.u[pair]],
                       pa=s.a[pair].astype(np.float32), pb=s.b[pair].astype(np.float32))


def _summed_docs(data: list[bytes]) -> dict[str, np.ndarray]:
    """The buckets' shares of documents added up, by row, with the tokens under
    split contexts: ``open`` of each document, then their ``i``, ``a``, ``b``."""
    parts = sorted((_unpack(x) for x in data), key=lambda x: int(x["bucket"][0]))
    row, at = np.unique(np.concatenate([x["row"] for x in parts]), return_inverse=True)
    at = np.split(at, np.cumsum([len(x["row"]) for x in parts])[:-1])
    out = {"id": np.zeros(len(row), np.int64), "none": np.zeros(len(row), bool), "n": np.zeros(len(row), np.int64),
           "known": np.zeros(len(row), np.int64), "base": np.zeros(len(row)), "score": np.zeros(len(row))}
    doc = []
    for x, k in zip(parts, at):
        n, vocabulary = x["corpus"].astype(float)
        out["id"][k[x["at"]]], out["none"][k[x["at"]]] = x["id"], x["none"]
        out["n"][k] += x["n"]
        out["score"][k] += x["score"]
        token = np.repeat(k, x["n"])
        c = x["c"].astype(np.int64)
        out["base"] += np.bincount(token, np.log10((c + 0.1) / (n + 0.1 * (vocabulary + 1)))[x["ci"]], len(row))
        out["known"] += np.bincount(token[(c > 0)[x["ci"]]], minlength=len(row))
        doc.append(k[x["td"].astype(np.int64)])
    doc = np.concatenate(doc)
    order = np.argsort(doc, kind="stable")
    for name, key in (("i", "pi"), ("a", "pa"), ("b", "pb")):
        out[name] = np.concatenate([x[key][x["tp"]] for x in parts])[order]
    out["open"] = np.bincount(doc, minlength=len(row))
    return out


# ---- the operator --------------------------------------------------------------------------

#: Buckets to a part of the parent's words and of the documents: each bucket sends
#: to every part.
BUCKETS_A_PART = 8


def score(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", bucket_tokens: int = BUCKET_TOKENS,
          seed: int = 1, burn: int = 2, samples: int = 3, sweeps: int = 1) -> DataFrame:
    """Per row of ``docs``: doc_id (an integer), n_tokens, n_known, train_tokens,
    base_score and score, from a model of the rows where ``train`` holds."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       F.coalesce(train, F.lit(True)).alias("train"), F.monotonically_increasing_id().alias("row"))
    size = rows.agg(F.sum(F.octet_length("text") + TOKEN_BYTES)).first()[0] or 0
    buckets = max(1, -(-size // (TOKEN_BYTES * bucket_tokens)))
    common = common_contexts(rows, buckets)

    def deal(batches):
        hasher = Hasher()
        context, token, doc, meta, held, at_doc = [], [], [], [], 0, 0

        def flush():
            d = [np.concatenate(x) for x in zip(*meta)]
            yield pa.RecordBatch.from_pydict(dict(zip(("bucket", "payload"), map(list, zip(*_dealt(
                np.concatenate(context), np.concatenate(token), np.concatenate(doc), d, common, buckets))))),
                schema=pa.schema([("bucket", pa.int64()), ("payload", pa.binary())]))

        for b in batches:
            texts = b.column(1).to_pylist()
            ids, rows = b.column(0), b.column(3).to_numpy()
            none = ids.is_null().to_numpy(zero_copy_only=False)
            ids, trains = ids.fill_null(0).to_numpy(), b.column(2).to_numpy(zero_copy_only=False)
            for at, to in _chunks(texts):
                u, w, n = hasher.tokens(texts[at:to])
                context.append(u)
                token.append(w)
                doc.append(np.repeat(np.arange(at_doc, at_doc + to - at), n))
                meta.append((rows[at:to], ids[at:to], none[at:to], trains[at:to]))
                at_doc += to - at
                held += len(u)
                if held >= FLUSH_TOKENS:
                    yield from flush()
                    context, token, doc, meta, held, at_doc = [], [], [], [], 0, 0
        if held:
            yield from flush()

    def column(t, name):
        return t.column(name).to_pylist()

    fewer = -(-buckets // BUCKETS_A_PART)

    def ask(key, t):
        found = list(_send(key[0].as_py(), column(t, "payload"), seed + key[0].as_py(), common, buckets, fewer))
        return pa.table({"part": pa.array([k for k, _ in found], pa.int64()), "payload": pa.array([x for _, x in found], pa.binary())})

    def answer(key, t):
        found = list(_answer(key[0].as_py(), column(t, "payload"), seed + 31 * key[0].as_py() + 7))
        return pa.table({"bucket": pa.array([k for k, _ in found], pa.int64()), "answer": pa.array([x for _, x in found], pa.binary())})

    def finish(key, left, right):
        bucket = key[0].as_py()
        answers = column(right, "answer")
        sampled = Sampled(column(left, "payload"), answers, fewer, seed + bucket, burn, samples, sweeps)
        train_tokens = sum(int(_unpack(x)["sums"][0]) for x in answers)
        found = list(_scores(bucket, sampled, common, fewer))
        split = sampled.split
        tables = _pack(i=np.searchsorted(common, sampled.bucket.contexts[split]), t=sampled.tables[split]) if len(split) else None
        n = len(found)
        # the bucket's tables go with its first share
        return pa.table({"part": pa.array([p for p, _ in found], pa.int64()), "train_tokens": pa.array(np.full(n, train_tokens)),
                         "payload": pa.array([x for _, x in found], pa.binary()),
                         "tables": pa.array([tables] + [None] * (n - 1) if n else [], pa.binary())})

    def tables_of(key, t):
        found = [_unpack(x) for x in column(t, "tables") if x is not None]
        return pa.table({k: pa.array(np.concatenate([x[k] for x in found]) if found else np.zeros(0), kind)
                         for k, kind in (("i", pa.int64()), ("t", pa.float64()))})

    def gather(key, t):
        d = _summed_docs(column(t, "payload"))
        tokens = pa.StructArray.from_arrays([pa.array(d["i"].astype(np.int32)), pa.array(d["a"].astype(np.float32)), pa.array(d["b"].astype(np.float32))],
                                            names=["i", "a", "b"])
        return pa.table({"doc_id": pa.array(d["id"].astype(np.int64), mask=d["none"].astype(bool)),
                         "n_tokens": pa.array(d["n"].astype(np.int64)), "n_known": pa.array(d["known"].astype(np.int64)),
                         "train_tokens": pa.array(np.full(len(d["id"]), t.column("train_tokens")[0].as_py())),
                         "base_score": pa.array(d["base"]), "score": pa.array(d["score"]),
                         "tokens": pa.ListArray.from_arrays(np.append(0, np.cumsum(d["open"])).astype(np.int32), tokens)})

    dealt = rows.mapInArrow(deal, "bucket long, payload binary")
    told = dealt.groupBy("bucket").applyInArrow(ask, "part long, payload binary") \
        .groupBy("part").applyInArrow(answer, "bucket long, answer binary")
    shares = dealt.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(
        finish, "part long, train_tokens long, payload binary, tables binary").groupBy("part")
    scored = shares.applyInArrow(gather, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
                                         "tokens array<struct<i:int,a:float,b:float>>")
    if len(common):
        # one row: the tables of every split context, in the order of ``common``, over all buckets
        whole = shares.applyInArrow(tables_of, "i long, t double").groupBy("i").agg(F.sum("t").alias("t")) \
            .agg(F.array_sort(F.collect_list(F.struct("i", "t")))["t"].alias("_tables"), (F.max("i") * 0).alias("_zero"))
        scored = scored.withColumn("_zero", F.col("n_tokens") * 0).join(F.broadcast(whole), "_zero")
        scored = scored.withColumn("score", F.aggregate("tokens", F.col("score"), lambda x, k: x + F.log10(
            k["a"].cast("double") + k["b"].cast("double") * F.get("_tables", k["i"]))))
    return scored.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def perplexity(scored: DataFrame) -> Column:
    """10 ** -(mean log10 probability of a token), an aggregate over ``score``'s rows."""
    return F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens"))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 10, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))
