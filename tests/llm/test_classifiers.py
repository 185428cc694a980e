import math
import random
import re
import unicodedata
import zlib

import pytest
from pyspark.sql import functions as F

from stationflow.llm import quality, toxicity
from stationflow.llm.common import held_out


def corpus(spark):
    draw = random.Random(2)
    rows = []
    for i in range(600):
        words = ["".join(draw.choice(["ba", "lo", "ti", "ren", "su"]) for _ in range(draw.randrange(1, 4))) for _ in range(draw.randrange(8, 80))]
        toxic, poor = draw.random() < 0.3, draw.random() < 0.3
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(["vilewretch", "Filthhead"])
        if poor:
            words = [w + "***" for w in words]
        rows.append((i, " ".join(words) + ".", int(not poor), int(toxic)))
    table = spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")
    return table.select("doc_id", "text"), table.drop("text")


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy_and_independence(spark, module, label):
    docs, labels = corpus(spark)
    out = module.score(docs, module.fit(docs, labels)).join(labels, "doc_id").toPandas()
    held = out[out.held_out]
    assert (held.predicted == held[label]).mean() > 0.95 and out.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in zip(out.doc_id, out.held_out))
    # Labels of held-out rows have no part in any score.
    turned = labels.withColumn(label, F.when(held_out("doc_id"), 1 - F.col(label)).otherwise(F.col(label)))
    again = module.score(docs, module.fit(docs, turned)).toPandas().set_index("doc_id").score
    assert (again.loc[out.doc_id].to_numpy() - out.score.to_numpy()).__abs__().max() < 1e-9


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_one_class_or_none(spark, module, label):
    docs, labels = corpus(spark)
    docs = docs.limit(20)
    scores = {r["score"] for r in module.score(docs, module.fit(docs, labels.where("false"))).collect()}
    assert scores == {0.5}
    scores = {r["score"] for r in module.score(docs, module.fit(docs, labels.where(f"{label} = 1"))).collect()}
    assert len(scores) == 1 and scores.pop() > 0.5


def test_rules_are_one_column(spark):
    docs, labels = corpus(spark)
    plan = quality.score(docs, quality.fit(docs, labels))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan


def test_paths_of_a_printed_tree():
    text = "Model\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 0.5)\n     If (feature 1 > 2.0)\n      Predict: 1\n     Else (feature 1 <= 2.0)\n      Predict: 0\n    Else (feature 0 > 0.5)\n     Predict: 1\n"
    assert quality.paths(text, ["a", "b"]) == [
        (("a", "<=", 0.5),), (("a", "<=", 0.5), ("b", ">", 2.0)), (("a", "<=", 0.5), ("b", "<=", 2.0)), (("a", ">", 0.5),),
    ]


ODD_TEXTS = [None, "", " ", "\n\n", "a", "É 12 |x| *** ok. no break", "abc " * 3000, "<|end|> A1! b?\ttab\r\nline", "日本語 テキスト。", "\U0001f600 UPPER lower"]


def given(spark, sf_dir):
    """The given documents and odd texts, and models fitted on the given labels."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    return docs, labels, docs.select("doc_id", "text").unionByName(odd)


def logistic(x):
    return 1 / (1 + math.exp(-x))


def plain_place(gram):
    """Place of an n-gram, with whole numbers."""
    whole, h = (1 << 64) - 1, 0
    for c in gram:
        h = (h * 0x100000001B3 + ord(c)) & whole
    h = (h ^ len(gram)) * 0x9E3779B97F4A7C15 & whole
    return ((h ^ h >> 29) * 0xBF58476D1CE4E5B9 & whole) >> (64 - toxicity.BITS)


def test_toxicity_scores_equal_a_plain_sum(spark, sf_dir):
    docs, labels, every = given(spark, sf_dir)
    model = toxicity.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] or "" for r in every.collect()}
    assert any(model.weights) and len(texts) == every.count()
    for r in toxicity.score(every, model).collect():
        padded = f" {texts[r['doc_id']].lower()} "
        places = {plain_place(padded[i : i + n]) for n in toxicity.LENGTHS for i in range(len(padded) - n + 1)}
        want = logistic(max(-30, min(30, model.intercept + sum(float(model.weights[p]) for p in places))))
        assert r["score"] == pytest.approx(want, abs=1e-5) and r["predicted"] == (r["score"] >= 0.5)


def plain_statistics(text):
    words, lines = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w], text.split("\n")
    kinds = [unicodedata.category(c) for c in text]
    letters = sum(k[0] == "L" for k in kinds)

    def share(part, whole):
        return part / whole if whole else 0.0

    def of(signs):
        return share(sum(c in signs for c in text), len(words))

    return {
        "n_words": len(words),
        "word_length": share(letters, len(words)),
        "letter_share": share(letters, len(text)),
        "distinct_words": share(len(set(words)), len(words)),
        "distinct_lines": share(len(set(lines)), len(lines)),
        "words_per_line": share(len(words), len(lines)),
        "digit_share": share(sum(c in "0123456789" for c in text), len(text)),
        "upper_share": share(kinds.count("Lu"), len(words)),
        "stops": of(".!?"),
        "bars": of("|<>{}[]=_/\\"),
        "signs": of("*#%&$@~^+"),
        "short_words": share(sum(len(w) <= 3 for w in words), len(words)),
    }


def test_quality_scores_equal_rules_one_by_one(spark, sf_dir):
    docs, labels, every = given(spark, sf_dir)
    model = quality.fit(docs, labels)
    texts = {r["doc_id"]: r["text"] or "" for r in every.collect()}
    assert model.rules
    for r in quality.score(every, model).collect():
        known = plain_statistics(texts[r["doc_id"]])
        total = model.intercept
        for conditions, weight in model.rules:
            if all(known[name] <= border if sign == "<=" else known[name] > border for name, sign, border in conditions):
                total += weight
        assert r["score"] == pytest.approx(logistic(total), abs=1e-9) and r["predicted"] == (r["score"] >= 0.3)
