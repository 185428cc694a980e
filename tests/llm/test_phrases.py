"""Collocations against a count of every phrase in plain Python."""

import re
import string
from collections import Counter

import pytest

from stationflow.llm import common, phrases

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "lang string, text string, rank int, phrase string, segment string, f string"


def expected(rows, least, longest, share=50, top=2000):
    counts, words_of = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            words_of[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang or "und", *words[i : i + n]) for i in range(len(words) - n + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    dropped = set()
    for longer, f in candidates.items():
        words = longer[1:]
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                inner = (longer[0], *words[i : i + n])
                if 100 * f >= share * candidates[inner]:
                    dropped.add(inner)
    found = []
    for phrase, a in candidates.items():
        lang, *words = phrase
        score, k = min((1_000_000 * a * a // (counts[(lang, *words[:k])] * counts[(lang, *words[k:])]), k) for k in range(1, len(words)))
        if phrase not in dropped:
            found.append((lang, -score, -a, " ".join(words).encode(), counts[(lang, *words[:k])], counts[(lang, *words[k:])]))
    ranks, out = Counter(), []
    for lang, score, a, phrase, left, right in sorted(found):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase.decode(), -a, left, right, words_of[lang], -score))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, 1, "p", "s", "f") for lang, text in rows], SCHEMA)


CASES = [
    ("en", "New York, new york; NEW YORK! new york city. new york city"),
    ("en", "a a a a a a a"),
    ("en", "red green blue red green blue\tred  green blue\nred green"),
    ("en", ""),
    ("en", None),
    (None, "Äpfel äpfel Äpfel äpfel Äpfel äpfel"),
    (None, "no language no language no language"),
    ("de", "x"),
    ("de", " \t .,; \r\n"),
    ("fr", "un deux trois quatre un deux trois quatre un deux trois quatre un deux trois"),
    ("fr", "un deux trois quatre un deux trois quatre un deux trois quatre un deux trois"),
]


@pytest.mark.parametrize(("least", "longest"), [(2, 3), (3, 3), (2, 5)])
@pytest.mark.parametrize("segment", [3, 1024])
def test_equals_brute_force(spark, monkeypatch, least, longest, segment):
    monkeypatch.setattr(phrases, "SEGMENT", segment)
    got = phrases.collocations(frame(spark, CASES), least, longest)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(expected(CASES, least, longest))


def test_shuffled_joins_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_SENT", 0)
    assert sorted(map(tuple, phrases.collocations(frame(spark, CASES), 2).collect())) == sorted(expected(CASES, 2, 3))


def test_limit_per_language(spark):
    got = phrases.collocations(frame(spark, CASES), 2, top=2)
    assert sorted(map(tuple, got.collect())) == sorted(expected(CASES, 2, 3, top=2))


def test_a_very_long_piece(spark):
    rows = [("en", "ab cd " * 20_000), ("en", "ab cd")]
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows)).collect())) == sorted(expected(rows, 10, 3))


def test_empty_and_hopeless_tables(spark):
    assert phrases.collocations(frame(spark, [])).count() == 0
    assert phrases.collocations(frame(spark, [("en", "one two three"), (None, None)])).count() == 0


def test_leaves_no_table_and_no_setting(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key), spark.sql("SHOW TABLES").count()
    phrases.collocations(frame(spark, CASES), 2)
    assert (spark.conf.get(key), spark.sql("SHOW TABLES").count()) == before


def test_joins_need_no_shuffle(spark, monkeypatch):
    plans = []
    pairs = phrases.Occurrences.pairs

    def seen(self):
        found = pairs(self)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(phrases.Occurrences, "pairs", seen)
    phrases.collocations(frame(spark, CASES), 2)
    assert len(plans) == 2
    for plan in plans:
        assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_whole_segments_are_dealt_out_and_one_side_is_sorted(spark, monkeypatch):
    order = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before, plans, dealt = spark.conf.get(order), [], []
    pairs, made = phrases.Occurrences.pairs, phrases.Occurrences.__init__

    def seen(self):
        found = pairs(self)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    def written(self, rows, *args, **kwargs):
        dealt.append(rows._jdf.queryExecution().optimizedPlan().toString())
        made(self, rows, *args, **kwargs)

    monkeypatch.setattr(phrases.Occurrences, "pairs", seen)
    monkeypatch.setattr(phrases.Occurrences, "__init__", written)
    rows = [("en", "ab cd ef. " * 3000)] * 3
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows)).collect())) == sorted(expected(rows, 10, 3))
    assert [plan.count("Sort [") for plan in plans] == [1, 1]
    # The words come from the segments after the shuffle, not before it.
    assert dealt[0].index("Generate posexplode") < dealt[0].index("RepartitionByExpression [segment")
    assert spark.conf.get(order) == before


def test_segments_travel_as_text(spark):
    """An array of words takes 16 bytes and more a word in a shuffle."""
    cut = phrases.segments(frame(spark, CASES), 3).selectExpr("lang", "monotonically_increasing_id() AS segment", "words")
    dealt = phrases.dealt_out(cut, 3)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, cut.collect()))
    plan = dealt._jdf.queryExecution().optimizedPlan()
    while "Repartition" not in plan.nodeName():
        plan = plan.children().head()
    assert "string" in plan.schema().simpleString() and "array" not in plan.schema().simpleString()


def test_shuffles_are_removed_as_a_table_is_written(spark, monkeypatch):
    """Not when the driver's garbage is collected, which may be after the query."""
    key, set_to = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before, stage = spark.conf.get(key), common.stage

    def seen(df, *parts):
        set_to.append(df.sparkSession.conf.get(key))
        return stage(df, *parts)

    monkeypatch.setattr(common, "stage", seen)
    assert common.stored(spark.range(9).groupBy("id").count(), "few").count() == 9
    assert set_to == ["true"] and spark.conf.get(key) == before
