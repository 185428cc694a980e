"""Every operator on tables with nulls, empty and long texts, repeated rows, clashing columns, and on no rows."""

import pytest
from corpora import odd_docs, odd_rows
from pyspark.sql import functions as F

from stationflow.llm import chat, decontaminate, line_dedup, packing, paragraphs, phrases, quality, simhash_dedup, suffix_dedup, topk, toxicity

N = len(odd_rows())
LABELS = "doc_id bigint, quality int, toxic int, text string"
ITEMS = "item_id bigint, text string, doc_id bigint"


def labels(spark, docs):
    return spark.createDataFrame([(None, 1, 1, "x"), (4, None, None, "x"), (6, 1, 0, "x"), (8, 0, 1, "x"), (6, 1, 0, "x")], LABELS)


def items(spark):
    return spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "three words only", 3), (4, " ".join(odd_rows()[6][1].split()[:30]), 4)], ITEMS)


BY_ROW = {
    "simhash": lambda s, d: simhash_dedup.near_duplicates(d),
    "suffixes": lambda s, d: suffix_dedup.deduplicate(d),
    "toxicity": lambda s, d: toxicity.score(d, toxicity.fit(d, labels(s, d))),
    "quality": lambda s, d: quality.score(d, quality.fit(d, labels(s, d))),
}
ANY = {
    "packing": lambda s, d: packing.pack(d),
    "lines": lambda s, d: line_dedup.duplicate_lines(d),
    "decontamination": lambda s, d: decontaminate.contaminated(d, items(s)),
    "paragraphs": lambda s, d: paragraphs.duplicate_paragraphs(d),
}
FILTERS = {
    "quality": lambda s, d: quality.keep_good(d, quality.fit(d, labels(s, d))),
    "lines": lambda s, d: line_dedup.without_duplicates(d),
    "simhash": lambda s, d: simhash_dedup.keep_one(d),
    "decontamination": lambda s, d: decontaminate.keep_clean(d, items(s)),
}


@pytest.mark.parametrize("name", BY_ROW)
def test_one_result_per_row(spark, name):
    assert BY_ROW[name](spark, odd_docs(spark)).count() == N


@pytest.mark.parametrize("name", ANY)
def test_odd_rows(spark, name):
    assert ANY[name](spark, odd_docs(spark)).count() > 0


SAME = {**BY_ROW, **{n: ANY[n] for n in ("packing", "decontamination")}, "phrases": lambda s, d: phrases.collocations(d, 2)}


@pytest.mark.parametrize("name", SAME)
def test_clashing_columns_change_no_value(spark, name):
    docs = odd_docs(spark)
    if "lang" not in docs.columns:
        docs = docs.withColumn("lang", F.lit(None).cast("string"))
    plain = docs.select("doc_id", "text", "lang")
    taken = [c for c in SAME[name](spark, plain).columns if c not in plain.columns]
    clashing = docs.withColumns({c: F.lit("clash") for c in taken})
    got, want = ([str(r) for r in SAME[name](spark, d).collect()] for d in (clashing, plain))
    assert len(taken) > 0 and sorted(got) == sorted(want)


@pytest.mark.parametrize("name", [*BY_ROW, *ANY])
def test_no_rows(spark, name):
    assert (BY_ROW | ANY)[name](spark, odd_docs(spark).limit(0)).isEmpty()


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_all_columns(spark, name):
    docs = odd_docs(spark)
    out = FILTERS[name](spark, docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert 0 < out.count() <= N
    assert FILTERS[name](spark, docs.limit(0)).isEmpty()


def test_no_partners(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert topk.top_k(none, F.col("vec_id") % 20 == 0).isEmpty()
    assert chat.rotate(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).isEmpty()
