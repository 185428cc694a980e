import random

from corpora import sentence

from stationflow.llm import decontaminate as d


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(d, "BLOCK_ITEMS", 4)
    draw = random.Random(4)
    items = [(i, sentence(100 + i, draw.randrange(8, 60))) for i in range(10)] + [(10, "too few words"), (11, None)]
    docs = []
    for n in range(80):
        words = sentence(n, draw.randrange(0, 120)).split()
        if n % 2:
            leak = items[n % 10][1].split()
            for _ in range(n % 5 // 4):
                leak[draw.randrange(len(leak))] = "changed"
            at = draw.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," if n % 3 else w for w in leak[: len(leak) - n % 3]]
        docs.append((n, " ".join(words)))
    got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["first_word"], r["n_words"]) for r in d.contaminated(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")).collect()}
    want = {}
    for n, text in docs:
        words = text.encode().translate(d_plain()).split()
        for i, item in items:
            own = (item or "").encode().translate(d_plain()).split()
            m = len(own) - 4
            if m < 1:
                continue
            shingles = lambda w: d.Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
            best = max(((d.weighted_jaccard(shingles(words[a : a + len(own)]), shingles(own)), -a) for a in range(len(words) - len(own) + 1)), default=(0, 0))
            if best[0] >= 0.8:
                want[n, i] = (round(best[0], 9), -best[1], len(own))
    assert got == want and len(want) > 10


def d_plain():
    from stationflow.llm.words import PLAIN

    return PLAIN


def test_clean_documents_stay(spark):
    item = sentence(1, 30)
    docs = spark.createDataFrame([(1, f"x {item} y"), (2, sentence(2, 200)), (3, None), (None, item.upper())], "doc_id int, text string")
    kept = d.keep_clean(docs, spark.createDataFrame([(1, item)], "item_id int, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]


def test_no_items(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id int, text string")
    none = spark.createDataFrame([], "item_id int, text string")
    assert d.contaminated(docs, none).isEmpty() and d.keep_clean(docs, none).count() == 1


def test_documents_shorter_than_the_item(spark):
    """Against brute force with the whole document as the window where it is shorter."""
    items = [(i, sentence(300 + i, n)) for i, n in enumerate((15, 15, 40, 60, 60))]
    docs = []
    for i, text in items:
        words = text.split()
        for cut in range(1, 16):
            docs.append((len(docs), " ".join(words[:-cut])))
            docs.append((len(docs), " ".join(words[cut // 2 : len(words) - cut // 3])))
            docs.append((len(docs), " ".join(w for j, w in enumerate(words) if j != 3 * cut)))
    items, docs = spark.createDataFrame(items, "item_id int, text string"), spark.createDataFrame(docs, "doc_id int, text string")
    shingles = lambda text: d.Counter(d.shingles_of(text).tolist())
    want = {}
    for doc_id, text in docs.collect():
        for item_id, item in items.collect():
            if len(text.split()) < len(item.split()) and (s := d.weighted_jaccard(shingles(text), shingles(item))) >= 0.8:
                want[doc_id, item_id] = (round(s, 9), 0, len(text.split()))
    got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), r["first_word"], r["n_words"]) for r in d.contaminated(docs, items).collect()}
    assert want and {k: v for k, v in got.items() if v[2] < (15, 15, 40, 60, 60)[k[1]]} == want
    clean = {r["doc_id"] for r in d.keep_clean(docs, items).collect()}
    assert not clean & {doc_id for doc_id, _ in want}
