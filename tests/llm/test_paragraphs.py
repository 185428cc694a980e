import random

from corpora import sentence

from stationflow.llm import paragraphs as p
from stationflow.llm.words import PLAIN


def words(text):
    return text.encode().translate(PLAIN).split()


def similar(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    return len(x & y) / len(x | y) >= 0.8


def variants(draw, base, n):
    out = []
    for i in range(n):
        own = base.split()
        for _ in range(draw.randrange(3)):
            own[draw.randrange(len(own))] = f"edit{draw.randrange(9)}"
        out.append(" ".join(own))
    return out


def test_classes_equal_brute_force(spark):
    draw = random.Random(6)
    lines = [sentence(i, draw.randrange(8, 60)) for i in range(40)]
    for seed in range(6):
        lines += variants(draw, sentence(1000 + seed, 50), 25)
    lines += [sentence(500, 20) + " " + sentence(600 + i, 25) for i in range(60)]  # alike at the start only
    draw.shuffle(lines)
    docs = [(i, "\n".join(lines[i * 3 : i * 3 + 3])) for i in range(len(lines) // 3)]
    got = p.duplicate_paragraphs(spark.createDataFrame(docs, "doc_id int, text string"), recall=0.999999).collect()
    split = [words(line) for i, text in docs for line in text.split("\n")]
    root = list(range(len(split)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(split)):
        for j in range(i):
            if similar(split[i], split[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    want: dict = {}
    for i in range(len(split)):
        want.setdefault(find(i), set()).add((i // 3, i % 3))
    want = {frozenset(v) for v in want.values() if len(v) > 1}
    found: dict = {}
    for r in got:
        found.setdefault(r["class_id"], set()).add((r["doc_id"], r["number"]))
    # At this recall the bands lose no pair.
    assert {frozenset(v) for v in found.values()} == want and want
    kept = [(r["doc_id"], r["number"]) for r in got if r["kept"]]
    assert sorted(kept) == sorted(min(v) for v in want)


def test_passages_inside_lines_are_found(spark):
    passage = " ".join(f"{sentence(i, 9)}." for i in range(7))
    docs = [(i, f"{sentence(50 + i, 20)} {passage} {sentence(90 + i, 15)}.") for i in range(5)] + [(9, sentence(7777, 200))]
    found = p.duplicate_paragraphs(spark.createDataFrame(docs, "doc_id int, text string"))
    assert {r["doc_id"] for r in found.collect()} == set(range(5))


def test_bands():
    assert p.bands_for(1, 0.8, 0.99) == 3 and 1 - (1 - 0.8**8) ** p.bands_for(8) >= 0.99


def test_shuffled_places_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, sentence(i % 3, 30)) for i in range(9)], "doc_id int, text string")
    one = sorted(map(tuple, p.duplicate_paragraphs(docs).collect()))
    monkeypatch.setattr(p, "BROADCAST_ROWS", -1)
    assert sorted(map(tuple, p.duplicate_paragraphs(docs).collect())) == one and len(one) == 9


def test_a_failed_member_meets_those_that_passed(spark, monkeypatch):
    """In a group f < b < a, b is like f and like a, but a is not like f; one deep band holds all three."""
    from pyspark.sql import functions as F

    for seed in range(200):
        base = [f"v{seed}x{i}" for i in range(40)]
        f, b, a = base, [f"s{seed}", *base[1:]], [f"s{seed}", *base[1:-4], "t", *base[-3:]]
        texts = [" ".join(w) for w in (f, b, a)]
        hashes = [int(p.Sketcher(0).paragraphs(t.encode())[1][0]) for t in texts]
        if hashes[0] < hashes[1] < hashes[2] and similar(f, b) and similar(b, a) and not similar(f, a):
            break
    else:
        raise AssertionError("no seed gives the order")
    monkeypatch.setattr(p, "deep_keys", lambda sets, bands: sets.select(F.lit(1).cast("long").alias("key"), "hash"))
    docs = p.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    places = p.sketches(docs, 1).withColumn("id", F.xxhash64("doc_id", "th", "number"))
    distinct = places.select("hash", F.col("id").alias("rep"), F.lit(7).cast("long").alias("k0"))
    found = {(r["a"], r["b"]) for r in p.links(distinct, docs, places.select("hash", "id", "doc_id", "th", "number"), 1, 0.8).collect()}
    assert {frozenset(e) for e in found} == {frozenset(hashes[:2]), frozenset(hashes[1:])}
