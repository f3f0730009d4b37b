"""Quality rules with weak supervision (operator 8).

Each rule votes good (1), bad (-1) or abstains (0) on a document.  The rules'
accuracies are not assumed: expectation-maximisation over the counts of all
vote patterns of the corpus estimates, for each class, how often each rule
votes each way, and a document is kept if its posterior probability of being
good is at least ``threshold``.  There are at most 3 ** rules patterns, however many
documents there are: one aggregation makes that table, the estimation runs on
it, and scoring is one expression.  Texts are read once, into a small table of
signals.  Everything is built-in expressions.

Edge cases: null or empty text has no words, fails the base rule and is not
kept; repeated rows and null ids are scored like any other row; an empty table
gives an empty result (no vote pattern: the prior stands).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import let, split_words, unboxed, window_hashes, without, written

SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _covered(words: Column) -> Column:
    """Words inside 8-word windows whose words occur twice or more.  Where no
    window hash repeats (nearly always) that is 0; else the hashes are sorted
    with their starts, starts next to an equal hash are picked, and the picked
    windows' lengths are added up without their overlaps.  Windows are compared
    by 64-bit hash within one text."""
    def picked(s: Column) -> Column:
        return F.filter(s, lambda x, k:
                        ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) |
                        (F.get(s, k + 1)["h"].eqNullSafe(x["h"])))

    def total(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.when(k == 0, F.lit(WINDOW)).otherwise(
                F.least(F.lit(WINDOW), x - F.get(p, k - 1)))),
            F.lit(0).cast("bigint"), lambda a, x: a + x)

    def covered(hashes: Column) -> Column:
        every = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            let(every, lambda s: let(F.sort_array(F.transform(picked(s), lambda x: x["i"])), total)))

    return window_hashes(words, WINDOW, covered)


def signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``SIGNALS`` added after its own, replacing
    columns of the same names."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = split_words(t)
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.when(n <= WINDOW, F.lit(0).cast("bigint")).otherwise(_covered(w)).alias("n_repeat_words"))

    def of_lines(a: Column) -> Column:
        n = F.size(a)
        return F.struct(n.cast("bigint").alias("n_lines"),
                        (n - F.size(F.array_distinct(a))).cast("bigint").alias("n_dup_lines"))

    def n_of(cls: str) -> Column:
        return F.regexp_count(t, F.lit(cls)).cast("bigint")

    return docs.withColumns({"_w": let(words, of_words), "_l": let(lines, of_lines)}).withColumns({
        **{k: F.col(f"_w.{k}") for k in ("n_words", "word_chars", "n_repeat_words")},
        **{k: F.col(f"_l.{k}") for k in ("n_lines", "n_dup_lines")},
        "n_symbols": n_of("[" + re.escape(SYMBOLS) + "]"),
        "n_upper": n_of(r"\p{Lu}"), "n_exclaims": n_of("!"),
        "n_plain": n_of(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]+(?![^\x20\x09-\x0D])"),
        "n_stops": n_of(r"[.,;:?](?=[\x20\x09-\x0D]|$)"),
    }).drop("_w", "_l")


SIGNALS = ("n_words", "word_chars", "n_repeat_words", "n_lines", "n_dup_lines",
           "n_symbols", "n_upper", "n_exclaims", "n_plain", "n_stops")


def _vote(share: Column, good_below: float, bad_above: float, applies: Column) -> Column:
    return F.when(~applies, 0).when(share <= good_below, 1).when(share >= bad_above, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes by name.  A rule abstains between its two bounds, and where a
    text is too short for its share to mean anything."""
    c = F.col
    words = F.greatest(c("n_words"), F.lit(1))
    mean = c("word_chars") / words
    return {
        "length": F.when(c("n_words") >= 50, 1).when(c("n_words") < 20, -1).otherwise(0),
        "word_length": F.when(c("n_words") < 10, 0).when(mean.between(4.0, 6.5), 1)
            .when((mean < 2.5) | (mean > 9.0), -1).otherwise(0),
        "symbols": _vote(c("n_symbols") / words, 0.02, 0.1, c("n_words") > 0),
        "repeats": _vote(c("n_repeat_words") / words, 0.05, 0.3, c("n_words") >= 16),
        "lines": _vote(c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)), 0.1, 0.3, c("n_lines") >= 4),
        "letters": _vote(c("n_plain") / words, 0.1, 0.2, c("n_words") >= 10),
        "capitals": _vote(c("n_upper") / F.greatest(c("word_chars"), F.lit(1)), 0.15, 0.3, c("word_chars") >= 40),
        "exclaims": _vote(c("n_exclaims") / words, 0.05, 0.25, c("n_words") >= 10),
        "punctuation": F.when(c("n_words") < 50, 0).when(c("n_stops") / words >= 0.06, 1)
            .when(c("n_stops") / words < 0.03, -1).otherwise(0),
    }


class VoteModel:
    """Class prior and, per rule, each vote's share of the votes it casts on
    (bad, good) documents."""

    def __init__(self, prior: float, given: dict[str, dict[int, tuple[float, float]]]):
        self.prior, self.given = prior, given

    def accuracies(self) -> dict[str, float]:
        """Per rule, how often a vote is right."""
        return {k: self.prior * g[1][1] + (1 - self.prior) * g[-1][0] for k, g in self.given.items()}

    def weight(self, name: str, vote: int) -> float:
        """What a vote adds to the log odds; an abstention says nothing."""
        if not vote:
            return 0.0
        bad, good = self.given[name][vote]
        return math.log(good / bad)

    def log_odds(self, votes: dict[str, int]) -> float:
        return math.log(self.prior / (1 - self.prior)) + sum(self.weight(k, v) for k, v in votes.items())

    def posterior(self, votes: dict[str, Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, vote in votes.items():
            odds = odds + F.when(vote == 1, F.lit(self.weight(name, 1))).when(
                vote == -1, F.lit(self.weight(name, -1))).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-odds))


#: Where the estimation starts: how many of a rule's votes on bad and on good
#: documents are bad.  A bad document is mostly bad in one way, so most rules
#: miss it; a rule seldom fires on a good one.
FIRES = (0.25, 0.002)


def estimate(patterns: list[tuple[dict[str, int], int]], names: list[str], rounds: int = 50,
             prior: float = 0.85, held: float = 10.0) -> VoteModel:
    """Expectation-maximisation over (votes, number of documents).  ``held`` is
    the number of made-up votes and documents with the starting shares that
    stay in each round, so that no probability becomes zero."""
    start = {-1: FIRES, 1: tuple(1 - f for f in FIRES)}
    model = VoteModel(prior, {k: dict(start) for k in names})
    total = sum(n for _, n in patterns)
    for _ in range(rounds if total else 0):
        good = held * prior
        votes = {k: {s: [held * start[s][c] for c in (0, 1)] for s in start} for k in names}
        for v, n in patterns:
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, model.log_odds(v)))))
            good += n * p
            for k in names:
                if v[k]:
                    votes[k][v[k]][0] += n * (1 - p)
                    votes[k][v[k]][1] += n * p
        model = VoteModel(good / (total + held), {
            k: {s: tuple(votes[k][s][c] / (votes[k][1][c] + votes[k][-1][c]) for c in (0, 1)) for s in start} for k in names})
    return model


def fit(judged: DataFrame) -> VoteModel:
    """The model of all rows of a frame with the ``SIGNALS``; at most
    3 ** rules pattern counts reach the driver."""
    votes = rules()
    counted = judged.select(*(v.alias(k) for k, v in votes.items())) \
        .groupBy(*votes).agg(F.count("*").alias("_n")).collect()
    patterns = sorted((({k: r[k] for k in votes}, r["_n"]) for r in counted),
                      key=lambda p: tuple(p[0].values()))
    return estimate(patterns, list(votes))


def judge(docs: DataFrame, text: str = "text", threshold: float = 0.5, model: VoteModel | None = None) -> DataFrame:
    """The rows of ``docs`` without their text, with ``SIGNALS``,
    ``base_failed``, ``posterior`` and ``kept``.  Texts are read once: the
    signals are written to the shared folder, and the model and the verdicts
    come from there.  A column of ``docs`` with the name of one of these gives way."""
    columns = [c for c in docs.columns if c != text]
    inner = docs.select(F.struct(*columns).alias("row") if columns else F.struct(F.lit(0)).alias("row"), F.col(text).alias("text"))
    out = written(signals(inner, "text").drop("text"), "signals")
    model = model or fit(out)
    judged = out.withColumns({
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "posterior": model.posterior(rules()),
    }).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    return unboxed(judged, columns, [c for c in judged.columns if c != "row"])


def filter_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The kept rows of ``docs``, with its own columns.  A verdict depends on
    the text alone, so rows with equal ids and texts share theirs."""
    keyed = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), F.xxhash64(F.col(text)).alias("_h"))
    bad = judge(keyed, "_text", **options).filter(~F.col("kept")).select("_id", "_h")
    return without(docs, bad, doc_id, text)
