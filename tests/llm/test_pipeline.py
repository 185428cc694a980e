import corpus_pipeline
from pyspark.sql import functions as F

from stationflow.llm import decontaminate, simhash_dedup
from stationflow.llm.queries import QUERIES


def test_stages_in_order_and_in_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    counts = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] == counts[0] < before and counts[3] <= counts[2] <= counts[1]
    found = simhash_dedup.near_duplicates(docs)
    assert found.select("component_id").distinct().count() == counts[3]
    assert decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).isEmpty()
    assert corpus_pipeline.run(spark, sf_dir).agg(F.count_distinct("doc_id")).first()[0] == counts[3]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
