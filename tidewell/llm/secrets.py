"""Secret scan with a random forest against false positives (operator 5).

Findings are long runs of value characters with a digit or a run of capitals, of
which a word may have several, addresses with a password in them, and whatever
is assigned to a secret's name.  Each has
features: length, transitions between kinds of characters and between the
characters themselves, entropy, how much of its letters is words of the
corpus' own dictionary, what its place looks like (source, path marks) and its
neighbouring words.  A forest trained on labelled findings gives each a
probability; those under ``threshold`` are false positives.

``labelled`` labels the findings whose form settles the question: a provider's
prefix or an assignment to a secret's name is a secret, an address, a number,
a date, a UUID or a placeholder is none.  The forest is not told which form it
was and judges every finding.  It trains on about ``TRAINING_ROWS`` of them,
chosen by hash within their class.  Everything is DataFrame operations and Spark's own forest.

Edge cases: null and empty texts have no findings; rows with equal ids have
their own findings each; without labels of both classes the probability is
null and nothing is removed; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import let, lower_az, split_words, written

TRAINING_ROWS = 100_000
MIN_LENGTH = 10
#: documents that must hold a word before the dictionary knows it
DICTIONARY_DOCUMENTS = 3
SECRET_NAME = r"(?i)(passw|pwd|secret|token|api.?key|access.?key|credential|auth|private.?key)"
#: What ends with an assignment to a secret's name.
NAMED = SECRET_NAME + r"[\w.-]*[^\w\s:=]*\s*[:=]+>?\s*[^\w\s]*$"
#: The assignment at the start of a run that has one, with the place of its value.
ASSIGNED = (r"^[\w.-]*?(?i:passw|pwd|secret|token|api.?key|access.?key|credential|auth|private.?key)"
            r"[\w.-]*[\"'`\]]*[:=]+>?[\"'`]?")
#: scheme://user:password@host
CREDENTIALS = r"[A-Za-z][A-Za-z0-9+.-]{0,20}://[^\s:/@\"'`<>?#]{0,64}:(?!//)[^\s/@\"'`<>]{1,128}@[A-Za-z0-9.-]+"
#: user:password@host
USER_AT = r"^[A-Za-z0-9_.+~-]+:(?!//)[^\s@]+@[A-Za-z0-9.-]+"
#: The runs of a word, read from left to right: an address with a password, a value
#: assigned to a secret's name (all up to the quote, or to a separator), or value characters.
RUNS = (CREDENTIALS + r"[A-Za-z0-9/_.:~-]*|(?<![\w.-])[\w.-]{0,64}?" + ASSIGNED[len(r"^[\w.-]*?"):].replace(r"[\w.-]*", r"[\w.-]{0,64}").replace(r"[\"'`]?", "")
        + r"(?:\"[^\"]+|'[^']+|`[^`]+|[^\s\"'`,;&<>(){}\[\]|]+)"
        + r"|[A-Za-z0-9+/_.@:~-]+(?:=+(?![A-Za-z0-9+/_.@:~=\"'`-]))?")
PLACEHOLDER = r"(?i)(example|sample|dummy|changeme|placeholder|your[_-]|xxxx|test)"
#: Forms that are secrets whatever stands around them.
SECRET_FORM = (r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36,}$|^xox[abprs]-[0-9A-Za-z-]{10,}$"
               r"|^sk_live_[0-9A-Za-z]{16,}$|^AIza[0-9A-Za-z_-]{35}$|^eyJ[0-9A-Za-z_-]{10,}\.eyJ")
#: Forms that are none.
PLAIN_FORM = (r"^[0-9.,:/+-]+$|^[^@\s]+@[A-Za-z0-9.-]+$|^[a-z]+://|^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
              r"|^v?[0-9]+(\.[0-9A-Za-z]+)+$")


def findings(docs: DataFrame, text: str = "text", source: str | None = "source") -> DataFrame:
    """One row per candidate, of which a word may have several: the other columns
    of ``docs`` in ``row``, at (the word's place), value, name (what stands before
    it in its word), before and after (two words each), and path (the document's
    source)."""
    def found(w: Column) -> Column:
        def named(i: Column) -> Column:
            """The two words before end with an assignment to a secret's name, or do so with the mark that begins the word."""
            p, q = F.coalesce(F.get(w, i - 1), F.lit("")), F.coalesce(F.get(w, i - 2), F.lit(""))
            return (p.rlike("[:=]>?[^A-Za-z0-9]{0,4}$") | F.get(w, i).rlike("^[:=]")) & F.concat_ws(
                " ", q, p, F.regexp_extract(F.get(w, i), "^[:=]*", 0)).rlike(NAMED)

        at = F.transform(w, lambda x, i: F.when(
            (F.length(x) >= MIN_LENGTH) & x.rlike("[0-9]|[A-Z]{16}|://|:.*@") | x.rlike("[:=]") & x.rlike(SECRET_NAME) | named(i), F.struct(
                i.alias("at"), x.alias("word"), F.concat_ws(" ", F.get(w, i - 2), F.get(w, i - 1)).alias("before"),
                F.concat_ws(" ", F.get(w, i + 1), F.get(w, i + 2)).alias("after"))))
        return F.filter(at, lambda x: x.isNotNull())

    def placed(runs: Column) -> Column:
        """value and name of each run; a run is looked for behind the one before it."""
        start = F.struct(F.lit(1).alias("to"), F.array().cast("array<struct<value:string,name:string>>").alias("out"))

        def add(acc: Column, run: Column) -> Column:
            lead = F.length(F.regexp_extract(run, ASSIGNED, 0))
            at = F.call_function("locate", run, F.col("word"), acc["to"]) + lead
            value = F.substring(run, lead + 1, F.length(run))
            return F.struct((at - lead + F.length(run)).alias("to"), F.concat(acc["out"], F.array(F.struct(
                value.alias("value"), F.substring(F.col("word"), F.lit(1), at - 1).alias("name")))).alias("out"))

        return F.aggregate(runs, start, add, lambda acc: acc["out"])

    own = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*own).alias("row") if own else F.struct(F.lit(0).alias("_")).alias("row"),
                       (F.col(source) if source in docs.columns else F.lit(None).cast("string")).alias("path"),
                       F.explode(let(split_words(F.col(text)), found)).alias("x"))
    runs = rows.select("row", "path", "x.*").withColumn("x", F.explode(placed(F.regexp_extract_all("word", F.lit(RUNS), F.lit(0)))))
    return runs.select("row", "path", "at", "x.value", "x.name", "before", "after").filter(
        strong(F.col("value")) | is_named() & F.col("value").rlike("[A-Za-z0-9]") | F.col("value").rlike(f"^{CREDENTIALS}|{USER_AT}"))


def strong(value: Column) -> Column:
    """Long, with a digit or a run of capitals: a candidate wherever it stands."""
    return (F.length(value) >= MIN_LENGTH) & value.rlike("[0-9]|[A-Z]{16}")


def is_named() -> Column:
    """The value stands directly after an assignment to a secret's name, in its word or before it."""
    return F.col("name").rlike(NAMED) | ~F.col("name").rlike("[A-Za-z0-9]") & F.concat_ws(" ", "before", "name").rlike(NAMED)


def labelled(found: DataFrame) -> Column:
    """1.0, 0.0 or null by the finding's form, read from value, name and before.
    A short value or one without a digit after a secret's name has no label: it
    may be a password or a word of prose.  An address with a password is a secret
    unless the password is a placeholder, or unlabelled if it is a variable;
    user:password@host without a scheme has no label (mailto:user@host)."""
    v = F.col("value")
    password = F.regexp_extract(v, "^" + CREDENTIALS.replace(":(?!//)[", ":((?!//)[").replace("}@", "})@"), 1)
    return F.when(password != "", F.when(password.rlike(PLACEHOLDER), 0.0).when(~password.rlike(r"[${}%]"), 1.0)) \
        .when(v.rlike(PLACEHOLDER), 0.0).when(v.rlike(SECRET_FORM), 1.0) \
        .when(v.rlike(USER_AT) & ~v.rlike("^[a-z]+://"), F.lit(None).cast("double")) \
        .when(v.rlike(PLAIN_FORM), 0.0).when(is_named() & strong(v), 1.0)


def dictionary(docs: DataFrame, text: str = "text", documents: int = DICTIONARY_DOCUMENTS) -> DataFrame:
    """Lower-case words of three letters or more that ``documents`` documents hold."""
    words = F.array_distinct(F.filter(split_words(lower_az(F.coalesce(F.col(text), F.lit("")))), lambda w: w.rlike(r"^\p{L}{3,}[.,;:!?]?$")))
    return docs.select(F.explode(words).alias("w")).groupBy(F.regexp_replace("w", "[.,;:!?]$", "").alias("known")) \
        .agg(F.count("*").alias("n")).filter(F.col("n") >= documents).select("known")


FEATURES = ["length", "digits", "upper", "lower", "marks", "switches", "turns", "entropy", "distinct", "covered",
            "path_marks", "path_plain", "assigned", "secret_name", "placeholder", "quoted", "neighbours"]


def with_features(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with the ``FEATURES``, all doubles."""
    v = F.col("value")
    n = F.length(v)
    kinds = F.translate(F.translate(F.translate(v, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A" * 26),
                                    "abcdefghijklmnopqrstuvwxyz", "a" * 26), "0123456789", "0" * 10)
    chars = F.split(v, "")

    def share(kind: str) -> Column:
        return (n - F.length(F.translate(F.col("_kinds"), kind, ""))) / n

    def entropy(c: Column) -> Column:
        return F.aggregate(F.transform(F.array_distinct(c), lambda x: F.size(F.filter(c, lambda y: y == x)) / F.size(c)),
                           F.lit(0.0), lambda a, p: a - p * F.log2(p))

    def turns(c: Column) -> Column:
        """Share of steps that go neither to the same nor the next character."""
        steps = F.transform(c, lambda x, i: F.abs(F.ascii(x) - F.ascii(F.get(c, i - 1))) > 1)
        return F.size(F.filter(steps, lambda s: F.coalesce(s, F.lit(False)))) / F.greatest(F.size(c) - 1, F.lit(1))

    runs = F.filter(F.split(lower_az(v), "[^a-z]+"), lambda x: F.length(x) >= 3)
    both = F.concat_ws(" ", "before", "name", "after")
    rows = found.withColumn("_kinds", kinds).withColumn("_runs", runs).withColumns({
        "_key": F.monotonically_increasing_id(),
        "length": n.cast("double"), "digits": share("0"), "upper": share("A"), "lower": share("a"),
        "marks": 1 - share("0Aa"),
        "switches": (F.length(F.regexp_replace("_kinds", r"(.)\1+", "$1")) - 1) / F.greatest(n - 1, F.lit(1)),
        "turns": let(chars, turns), "entropy": let(chars, entropy),
        "distinct": let(chars, lambda c: F.size(F.array_distinct(c)) / F.size(c)),
        "path_marks": F.regexp_count(v, F.lit("[/.@:]")).cast("double"),
        "path_plain": F.coalesce(F.col("path"), F.lit("")).rlike(r"(?i)(test|example|sample|mock|docs?\b)").cast("double"),
        "assigned": (F.col("name").rlike("[=:]") | F.col("before").rlike("[=:]$")).cast("double"),
        "secret_name": both.rlike(SECRET_NAME).cast("double"), "placeholder": v.rlike(PLACEHOLDER).cast("double"),
        "quoted": F.col("name").rlike("[\"'`]$").cast("double"),
        "neighbours": (F.length(F.regexp_replace(both, r"[^\p{L} ]", "")) / F.greatest(F.length(both), F.lit(1))),
    }).drop("_kinds")
    rows = written(rows, "findings")  # fixes the keys
    parts = rows.select("_key", F.explode("_runs").alias("known"))
    covered = parts.join(known, "known").groupBy("_key").agg(F.sum(F.length("known")).alias("_letters"))
    return rows.join(covered, "_key", "left").withColumn(
        "covered", F.coalesce(F.col("_letters") / F.col("length"), F.lit(0.0))).drop("_key", "_letters", "_runs")


def train(examples: DataFrame, label: str = "label", rows: int = TRAINING_ROWS, trees: int = 30, depth: int = 6, seed: int = 7):
    """A forest of the labelled rows of ``examples``, or None if a class is
    missing.  Of more than ``rows`` labelled rows each class gives its share, but
    a tenth of ``rows`` if it has them, chosen by hash: at most about 1.1 x ``rows``."""
    known = examples.filter(F.col(label).isNotNull())
    sizes = {r[label]: r["n"] for r in known.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0.0) or not sizes.get(1.0):
        return None
    total = sum(sizes.values())
    # equal findings are chosen each by itself
    keyed = known.withColumn("_hash", F.xxhash64("value", "before", "after", F.monotonically_increasing_id()))
    share = {k: min(1.0, max(rows * n / total, rows / 10) / n) if total > rows else 1.0 for k, n in sizes.items()}
    chosen = F.lit(False)
    for k, x in share.items():
        chosen = chosen | (F.col(label) == k) & (F.pmod("_hash", F.lit(1 << 20)) < round(x * (1 << 20)))
    part = written(keyed.filter(chosen), "training")
    for k in share:
        if part.filter(F.col(label) == k).isEmpty():  # by bad luck: one of the class, so that there are two
            part = part.unionByName(keyed.filter(F.col(label) == k).orderBy("_hash").limit(1))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    forest = RandomForestClassifier(featuresCol="_features", labelCol=label, numTrees=trees, maxDepth=depth, seed=seed)
    ready = assembler.transform(part.orderBy("value", "before", "after", "_hash")).select("_features", label)
    return forest.fit(ready)


def score(rows: DataFrame, forest, threshold: float = 0.5) -> DataFrame:
    """``rows`` with probability and is_secret."""
    if forest is None:
        return rows.withColumns({"probability": F.lit(None).cast("double"), "is_secret": F.lit(True)})
    ready = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)
    return forest.transform(ready).withColumn("probability", vector_to_array("probability")[1]) \
        .withColumn("is_secret", F.col("probability") >= threshold).drop("_features", "rawPrediction", "prediction")


def scan(docs: DataFrame, text: str = "text", source: str | None = "source", threshold: float = 0.5,
         forest=None, label=labelled) -> DataFrame:
    """Every finding with its features, label, probability and verdict."""
    found = with_features(findings(docs, text, source), written(dictionary(docs, text), "dictionary"))
    rows = written(found.withColumn("label", label(found)), "features")
    return score(rows, forest or train(rows), threshold)
