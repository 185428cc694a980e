"""Small tables with everything odd in them."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names the operators use inside.
CLASHING = {"fp": "'x'", "row": "1", "h": "2", "hash": "3", "score": "0.1", "length": "7", "label": "1", "th": "4", "root": "5", "features": "'f'", "line_no": "6", "words": "'w'", "class_id": "8", "kept": "true"}
LONG = " ".join(f"w{i}" for i in range(40_000))


def sentence(seed, n, low=0, high=5000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(low, high)}" for _ in range(n))


def odd_rows():
    passage = sentence(1, 90) + ". " + sentence(2, 30) + "."
    return [
        (None, "a row without id " + passage, "en", "s", 1),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \n\t ", "en", "s", 3),
        (4, "one", "en", "s", 3),
        (5, "one", "en", "s", 3),
        (6, passage, "en", "s", 9),
        (6, passage, "en", "s", 9),
        (7, sentence(3, 60) + " " + passage, "de", "s", 9),
        (8, LONG, "en", "s", len(LONG)),
        (9, "Ünïcödé ß　" + "x" * 3000, "de", "s", 9),
        (10, "x y " * 500, "en", "s", 9),
    ]


def odd_docs(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    return docs.selectExpr("*", *[f"{v} AS {k}" for k, v in CLASHING.items()])


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
