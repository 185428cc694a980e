import hashlib
import random
from collections import Counter

import pytest

from stationflow.llm import suffix_dedup
from stationflow.llm.suffixes import runs


def brute(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, 6)))
    passages = [" ".join(word() for _ in range(n)) for n in (60, 110, 130, 200)]
    texts = [None, "", "ab " * 400, "ba " * 400, "x" * 900, "x" * 401, "x" * 399]
    for _ in range(60):
        parts = [" ".join(word() for _ in range(draw.randrange(0, 80))) for _ in range(3)]
        text = " ".join([parts[0], draw.choice(passages), parts[1], draw.choice(passages)[draw.randrange(80) :], parts[2]])
        texts.append(text)
        if draw.random() < 0.4:
            at = draw.randrange(len(text))
            texts.append(text[:at] + "#" + text[at + 1 :])
    return texts + texts[10:14]


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 3), (3, 4)])
def test_equals_brute_force(spark, seed, batches):
    texts = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = suffix_dedup.deduplicate(docs, batches=batches).orderBy("doc_id").collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got] == brute(texts, 400)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] and len(r["spans"]) == r["n_spans"] for r in got)


def test_frequent_anchors_are_counted_as_rows(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_RUNS", 3)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", 0)
    texts = corpus(4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = suffix_dedup.deduplicate(docs, with_text=False).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, 400)


def test_runs_cover_all_windows_and_follow_the_content():
    data = random.Random(5).randbytes(5000)
    begin, end, h = runs(data)
    assert begin[0] == 0 and end[-1] == 5000 - 400 and (begin[1:] == end[:-1] + 1).all()
    assert set(runs(b"0" * 777 + data)[2]) >= set(h[1:-1])


def test_levels_grow_geometrically(spark):
    family = suffix_dedup.SuffixFamily()
    entries = spark.range(100).selectExpr("id % 40 AS h", "id % 50 AS r", "id")
    for n in range(6):
        family.add(entries.where(f"id % 6 = {n}"))
    assert [n for n, _ in family.levels] == [4, 1, 1]
    assert sum(level.agg({"n": "sum"}).first()[0] for _, level in family.levels) == 100
