"""Small tables for the operators' tests."""

import random

LETTERS = "the of and onth er in ation re is to a b c d e".split()
#: extra columns whose names the operators use inside
CLASHES = ("n_words long, kept string, fp string, cell long, _w string, row long, n_tokens string, lang_pred string, score string, "
           "_id string, _h string, _s string, _cut string, _i long, _t string, _lines string, _l string, _fp string, component_id string, "
           "id string, h string")


def prose(rng, n, per_line=12):
    words = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + per_line]) for i in range(0, n, per_line))


def corpus(seed=7, n=60):
    """(doc_id, text) with nulls, empty and long texts, copies and odd characters."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([1, 3, 8, 40, 120, 400])) for _ in range(n)]
    rows = list(enumerate(texts))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n "), (n + 3, texts[0]), (n + 4, texts[0]), (n + 4, texts[0]), (None, texts[1]), (None, None)]
    rows += [(n + 5, prose(rng, 9000)), (n + 6, "É ñandú <|endoftext|> 你好\x1cx\xa0y don't  STOP!!\r\n\x0b"), (n + 7, "x y z " * 300)]
    words = texts[5].split() or ["a"]
    rows += [(n + 8 + k, " ".join(texts[5].split()[:k] + ["changed"] + texts[5].split()[k + 1:])) for k in range(min(5, len(words)))]
    return rows


def frame(spark, rows, clashes=False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clashes:
        for c in CLASHES.split(", "):
            name, kind = c.split(" ")
            df = df.selectExpr("*", f"CAST('9' AS {kind}) AS {name}")
    return df


def key(r):
    return tuple((x is not None, str(x)) for x in r)
