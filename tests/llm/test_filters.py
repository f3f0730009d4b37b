"""Operators 4, 6, 7 and 8 against brute force."""

import collections
import hashlib
import random
import re

import pytest
import xxhash

from tests.conftest import SF_SMALL
from tests.llm.helpers import corpus, frame, key
from tidewell.llm import decontaminate, language, quality, simhash

BLANK = r"[^\x20\x09-\x0D]+"


def brute_signals(text):
    text = text or ""
    words = re.findall(BLANK, text)
    n = len(words)
    grams = collections.Counter(tuple(words[i:i + 8]) for i in range(n - 7))
    hit = {p for i in range(n - 7) if grams[tuple(words[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


REPEATS = ["a b c d e f g h a b c d e f g h", "x " * 9, "x " * 8, "a b c d e f g h i a b c d e f g h j",
           "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9", "q\nq\n\nq r\nq r\n \n ", "# | <> 5% €&*$"]


def test_op8_signals(spark):
    rows = corpus() + [(500 + i, t) for i, t in enumerate(REPEATS)]
    got = quality.signals(frame(spark, rows, clashes=True)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert sorted(map(tuple, got), key=key) == sorted([(i, *brute_signals(t)) for i, t in rows], key=key)


def test_op8_verdicts(spark):
    rows = corpus()
    docs = frame(spark, rows, clashes=True)
    judged = quality.judge(docs).collect()
    assert len(judged) == len(rows)
    for r in judged:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= 0.5) and 0 <= r.posterior <= 1
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([r.doc_id for r in judged if r.kept], key=str)
    assert quality.filter_documents(frame(spark, [])).count() == 0


def test_op8_estimates_known_rules():
    """Votes drawn from known rates: the estimate finds the rates and the classes."""
    rng = random.Random(3)
    rates = {"a": (0.6, 0.01), "b": (0.5, 0.02), "c": (0.4, 0.0), "d": (0.3, 0.3), "e": (0.5, 0.01)}
    rows = []
    for _ in range(20000):
        good = rng.random() < 0.8
        rows.append((good, tuple(-1 if rng.random() < r[good] else rng.choice([0, 1, 1, 1, 1]) for r in rates.values())))
    model = quality.estimate([(dict(zip(rates, v)), n) for v, n in collections.Counter(v for _, v in rows).items()], list(rates))
    assert abs(model.prior - 0.8) < 0.05
    for k, (bad, good) in rates.items():  # a fifth of the other documents get no vote
        assert abs(model.given[k][-1][0] - bad / (bad + (1 - bad) * 0.8)) < 0.08
        assert abs(model.given[k][-1][1] - good / (good + (1 - good) * 0.8)) < 0.05
    right = sum((model.log_odds(dict(zip(rates, v))) >= 0) == good for good, v in rows)
    assert right / len(rows) > 0.9
    assert all(0.5 < x <= 1 for k, x in model.accuracies().items() if k != "d")
    assert quality.estimate([], ["a"]).prior == 0.85


def test_op8_agrees_with_labels(spark):
    from tidewell.session import read_table
    judged = {r.doc_id: r.kept for r in quality.judge(read_table(spark, SF_SMALL, "documents")).collect()}
    labels = read_table(spark, SF_SMALL, "labels").collect()
    assert sum(judged[r.doc_id] == bool(r.quality) for r in labels) / len(labels) > 0.9


def brute_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items):
    words, spans, hit_items = brute_words(text), set(), set()
    for item, t in items:
        w = brute_words(t)
        size = min(13, len(w))
        grams = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in grams:
                spans.update(range(i, i + size))
                hit_items.add(str(item))
    ids = sorted(hit_items)
    return (len(words), len(spans), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(),
            bool(spans) and 20 * len(spans) >= len(words))


def bench_case():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocab, k=30))) for i in range(12)]
    items += [(20, items[0][1].upper()), (21, "only Five, words; stand here"), (22, ""), (23, None), (24, "solo"), (None, "no id item " * 5)]
    rows = corpus()
    for k in range(20):
        t = rng.choice(items[:14])[1]
        rows.append((300 + k, " ".join(rng.choices(vocab, k=rng.choice([0, 5, 300]))) + "\n" + t.replace(" ", ", ") + " solo" * (k % 3 == 0)))
    rows += [(400, "w1 " + "only five words stand here " * 3), (401, " ".join(items[3][1].split()[:12])), (402, items[3][1])]
    return rows, items


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_WINDOWS, 0])
def test_op7_report(spark, limit):
    rows, items = bench_case()
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS gram", "1 AS size")
    got = decontaminate.report(frame(spark, rows, clashes=True), bench, broadcast_windows=limit).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    want = [(i, *brute_hits(t, [x for x in items if x[0] is not None])) for i, t in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_op7_removal(spark):
    rows, items = bench_case()
    docs, bench = frame(spark, rows, clashes=True), spark.createDataFrame(items, "item_id long, text string")
    bad = [r for r in rows if brute_hits(r[1], items)[-1]]
    left = decontaminate.remove_documents(docs, bench)
    assert left.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=key) == sorted([r for r in rows if r not in bad], key=key)
    cut = decontaminate.remove_spans(docs, bench)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    for r in cut.collect():
        if not any(i == r.doc_id for i, _ in bad):
            assert (r.doc_id, r.text) in rows
        elif r.doc_id is not None and r.doc_id >= 300:
            old = next(t for i, t in rows if i == r.doc_id)
            assert len(brute_words(r.text)) == brute_hits(old, items)[0] - brute_hits(old, items)[1]
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove_documents(docs, empty).count() == len(rows)
    assert decontaminate.report(frame(spark, []), bench).count() == 0


def brute_fingerprint(text, width=3):
    words = (text or "").encode().lower().split()
    width = min(width, len(words))
    shingles = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """fps: list of (id, fingerprint) -> smallest id of each one's component."""
    n = len(fps)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        if fps[i][0] is not None:
            r = find(i)
            least[r] = min(least.get(r, fps[i][0]), fps[i][0])
    return [least.get(find(i)) for i in range(n)]


def near_copies():
    rng = random.Random(2)
    base = corpus()[4][1].split() + [f"z{i}" for i in range(300)]
    rows = []
    for k in range(120):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(50)}"
        rows.append((900 - k, " ".join(w)))
    return rows


def test_op4_classes(spark):
    rows = corpus() + near_copies()
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    docs = frame(spark, rows, clashes=True)
    got = simhash.classes(docs).select("doc_id", simhash.hex_digits(simhash.F.col("fp")), "component_id").collect()
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps))]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert len({c for _, _, c in want}) < len(rows) - 50
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    classes = collections.Counter(r.doc_id for r in kept.collect())
    assert classes == collections.Counter(set(c for _, _, c in want))


@pytest.mark.parametrize("bits,groups", [(3, 6), (3, 4), (3, 9), (3, None), (1, 3), (0, 1), (5, 8)])
def test_op4_links_lose_nothing(spark, bits, groups):
    rng = random.Random(bits)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps):
        g = f
        for _ in range(4):
            g ^= 1 << rng.randrange(64)
            fps.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bits, groups).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= bits}
    assert got == want


def test_op4_groups_grow_with_the_fingerprints():
    assert [simhash.groups_for(n, 3) for n in (0, 10 ** 6, 2 ** 24, 2 ** 24 + 1, 10 ** 9, 10 ** 11)] == [6, 6, 6, 7, 8, 13]
    assert simhash.groups_for(1, 0) == 2 and simhash.groups_for(10 ** 30, 3) == 32


def test_op4_long_chain_and_empty(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (100, 300), (250, 300)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in (100, 200, 250, 300)}}
    assert simhash.classes(frame(spark, [])).count() == 0
    assert simhash.keep_first(frame(spark, [(None, "a b c d"), (None, "a b c d")])).count() == 1


def test_op6_held_out_accuracy(spark):
    from tidewell.session import read_table
    docs = read_table(spark, SF_SMALL, "documents").withColumn("held_out", language.held_out(language.F.col("doc_id")))
    model = language.train(docs.filter("NOT held_out"))
    got = language.predict(docs.select("doc_id", "text", "held_out", "lang"), model).collect()
    held = [r for r in got if r.held_out]
    assert held and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.9
    assert all(0 <= r.score <= 1 for r in got)


def brute_model(rows, buckets):
    letters = language._letters()
    total = {}
    for lang, t in rows:
        if lang is not None and t is not None:
            n = total.setdefault(lang, collections.Counter())
            n.update(language.features([t], letters, buckets=buckets)[0].tolist())
    return total


def test_op6_counts_and_edges(spark):
    rows = [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("de", "Öl 123"), (None, "the thing"), ("fr", None),
            ("en", ""), ("en", "the cat and the dog")]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"), buckets=64, smooth=1.0)
    assert model.languages == ["de", "en"]
    for j, lang in enumerate(model.languages):
        n = brute_model(rows, 64)[lang]
        for b in range(64):
            assert abs(2.718281828459045 ** model.log_prob[b, j] - (n[b] + 1) / (sum(n.values()) + 64)) < 1e-9
    odd = frame(spark, [(1, None), (2, ""), (3, "12 !? \n"), (7, "😀 😀"), (4, "Der Hund"), (4, "Der Hund"), (None, "the dog"), (6, "the dog " * 200_000)], clashes=True)
    got = {(r.doc_id, r.lang_pred) for r in language.predict(odd, model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (7, "und"), (4, "de"), (None, "en"), (6, "en")}
    nothing = language.train(spark.createDataFrame([], "lang string, text string"))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(frame(spark, []), model).count() == 0


def test_op6_features_do_not_cross_texts():
    letters = language._letters()
    both, of, _ = language.features(["ab c", "İx 1", "", None, "def"], letters)
    for i, t in enumerate(["ab c", "İx 1", "", None, "def"]):
        alone, _, has = language.features([t], letters)
        assert sorted(alone.tolist()) == sorted(both[of == i].tolist())
        assert has[0] == bool(t)


@pytest.mark.parametrize("limit", [0, 500_000])
def test_filters_keep_texts_and_columns_whichever_side_moves(spark, monkeypatch, limit):
    """Dropped keys go to the texts, or beyond the limit both are shuffled: the same rows."""
    from tidewell.llm import common, lines
    monkeypatch.setattr(common, "BROADCAST_KEYS", limit)
    rows = corpus() + near_copies()[:20] + [(3000, "x " * 60), (3000, "x " * 60)]
    docs = frame(spark, rows, clashes=True)
    for out in (quality.filter_documents(docs), simhash.keep_first(docs), lines.dedup_documents(docs)):
        assert out.columns == docs.columns
        left = out.collect()
        assert left and all(r["_id"] == "9" and r["row"] == 9 and r["fp"] == "9" for r in left)
    judged = quality.judge(frame(spark, rows))
    verdict = {(r.doc_id, r.n_words): r.kept for r in judged.collect()}
    kept = sorted(((r.doc_id, r.text) for r in quality.filter_documents(frame(spark, rows)).collect()), key=key)
    assert kept == sorted([(i, t) for i, t in rows if verdict[(i, len(re.findall(BLANK, t or "")))]], key=key)
    n = quality.judge(docs).columns
    assert len(set(n)) == len(n)
