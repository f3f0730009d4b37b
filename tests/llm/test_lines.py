"""Operator 2 against a brute-force version."""

import random

import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from tests.llm.helpers import corpus, frame, key, prose
from tidewell.llm import lines


@settings(max_examples=1000, deadline=None)
@example([1, 0, 0], [0, 1, 0])
@given(st.lists(st.integers(0, 8), max_size=14), st.lists(st.integers(0, 8), max_size=14))
def test_patience_is_an_alignment(a, b):
    match = lines.patience(a, b)
    assert all(a[i] == b[j] for i, j in match)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(match, match[1:]))
    assert a != b or len(match) == len(a)
    only = [x for x in a if a.count(x) == 1 and b.count(x) == 1]
    if only and [x for x in b if x in only] == only:  # unique lines in one order are all matched
        assert {a[i] for i, _ in match} >= set(only)


def brute(rows, min_words=30, rare=4):
    """{(id, text): (text left, lines deleted)} of distinct documents."""
    def order(r):
        return (r[0] is None, r[0] or 0, lines_hash[r])
    docs = sorted(set(rows), key=order)
    words = [[len([w for w in x.replace("\x0b", " ").split(" ") if w.strip()]) for x in (t or "").split("\n")] for _, t in docs]
    text = [(t or "").split("\n") for _, t in docs]
    holders = {}
    for k, ls in enumerate(text):
        for x in {x for x, w in zip(ls, words[k]) if w}:
            holders.setdefault(x, []).append(k)
    pairs = set()
    for ks in holders.values():
        pairs |= {(ks[0], k) for k in ks[1:]}
        if len(ks) <= rare:
            pairs |= {(a, b) for x, a in enumerate(ks) for b in ks[x + 1:]}
    gone = [set() for _ in docs]
    for a, b in pairs:
        match = lines.patience(text[a], text[b])
        run = []
        for k, (i, j) in enumerate(match):
            run.append(j)
            if k + 1 == len(match) or match[k + 1] != (i + 1, j + 1):
                if sum(words[b][x] for x in run) >= min_words:
                    gone[b].update(run)
                run = []
    return {d: (d[1] if not gone[k] else "\n".join(x for j, x in enumerate(text[k]) if j not in gone[k]), len(gone[k]))
            for k, d in enumerate(docs)}


lines_hash = {}


def passages():
    rng = random.Random(4)
    rows = corpus()
    shared = [prose(rng, n) for n in (60, 70, 20, 200)]
    many = prose(rng, 40, 40)
    for k in range(40):
        own = [prose(rng, rng.choice([5, 30])) for _ in range(rng.randint(1, 3))]
        own.insert(rng.randint(0, len(own)), rng.choice(shared))
        if k % 2:
            own.append(many)
        rows.append((2000 - k, "\n".join(own)))
    return rows


@pytest.mark.parametrize("options", [{}, {"min_words": 5, "rare_documents": 2}])
def test_op2_equals_brute_force(spark, options):
    rows = passages()
    docs = frame(spark, rows, clashes=True).selectExpr("*", "1 AS n_deleted", "2 AS cut", "3 AS words", "4 AS line")
    for r in docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").collect():
        lines_hash[(r.doc_id, r.text)] = r.h if r.text is not None else 0
    want = brute(rows, options.get("min_words", 30), options.get("rare_documents", 4))
    got = lines.dedup(docs, **options).select("doc_id", "text", "n_deleted").collect()
    assert sorted(map(tuple, got), key=key) == sorted([(r[0], *want[r]) for r in rows], key=key)
    left = lines.dedup_documents(docs, **options)
    assert left.columns == docs.columns
    expect = [(r[0], want[r][0]) for r in rows if not want[r][1] or (want[r][0] or "").strip(" \t\n\r\x0b\x0c")]
    assert sorted([(r.doc_id, r.text) for r in left.collect()], key=key) == sorted(expect, key=key)
    assert sum(n > 0 for _, n in want.values()) > 20


def test_op2_first_copy_stays(spark):
    t = prose(random.Random(1), 80)
    got = {r.doc_id: r.text for r in lines.dedup_documents(frame(spark, [(3, t), (1, t), (2, t), (None, t), (5, "own line\n" + t)])).collect()}
    assert got == {1: t, 5: "own line"}


def test_op2_empty_table(spark):
    assert lines.dedup(frame(spark, [])).count() == 0


def test_op2_passage_whose_lines_stand_alone_before(spark):
    """Single lines lead each later holder to the wrong first holder only."""
    rng = random.Random(8)
    one, two, blank = prose(rng, 20, 20), prose(rng, 20, 20), ""
    rows = [(1, "a1\n" + one), (2, "a2\n" + two)]
    rows += [(k, f"start {k}\n{one}\n{blank}\n{two}\nend {k}") for k in range(3, 12)]
    got = {r.doc_id: r.text for r in lines.dedup_documents(frame(spark, rows)).collect()}
    assert got == {**dict(rows[:3]), **{k: f"start {k}\nend {k}" for k in range(4, 12)}}


def every_pair(rows, min_words):
    """{id: text left}: every pair of documents, every common run of lines."""
    text = [t.split("\n") for _, t in rows]
    out = {}
    for k, b in enumerate(text):
        gone = set()
        for a in text[:k]:
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                        n += 1
                    if sum(len(x.split()) for x in b[j:j + n]) >= min_words:
                        gone |= set(range(j, j + n))
        out[rows[k][0]] = "\n".join(x for j, x in enumerate(b) if j not in gone)
    return out


def test_op2_repeated_passages(spark):
    """A passage twice in the first holder, in a later one, or in both."""
    rng = random.Random(9)
    p = prose(rng, 40, 20)
    rows = [(1, f"x\n{p}\nm\n{p}\ny")] + [(k, f"u{k}\n{p}\nw{k}") for k in range(2, 9)] + [(9, f"s\n{p}\nt\n{p}\nv")]
    got = {r.doc_id: r.text for r in lines.dedup_documents(frame(spark, rows)).collect()}
    assert got == {**dict(rows[:1]), **{k: f"u{k}\nw{k}" for k in range(2, 9)}, 9: "s\nt\nv"}


def test_patience_without_unique_lines():
    assert lines.patience([0, 1, 2, 3, 1, 2, 4], [5, 1, 2, 6]) == [(1, 1), (2, 2)]


def test_op2_equals_every_pair(spark):
    """Few lines, so that they repeat, cross and stand alone in earlier documents."""
    rng = random.Random(10)
    pool = [prose(rng, n, n) for n in (3, 4, 5, 6, 7, 12, 5, 6)]
    rows = [(k, "\n".join([f"own {k}"] + [rng.choice(pool) for _ in range(rng.randint(1, 9))])) for k in range(60)]
    got = {r.doc_id: r.text for r in lines.dedup(frame(spark, rows), min_words=11).collect()}
    assert got == every_pair(rows, 11)
