"""Toxicity: a linear classifier over naive-Bayes-scaled character n-grams.

Features are the distinct character n-grams of a document, hashed into a fixed
number of places, each scaled by its log-count ratio between toxic and other
documents. Weights come from a ridge logistic regression. Both are learnt from
at most ``SAMPLE`` labelled rows; scoring reads every whole text once and
shuffles nothing, with one table of ``PLACES`` numbers on each executor.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import held_out, labelled_sample, rows_of, stored, texts

LENGTHS = (3, 4, 5)
BITS = 18
PLACES = 1 << BITS
#: Most labelled rows that the classifier is fitted on; those with the smallest hash of their id.
SAMPLE = 16_000
#: N-grams in fewer training documents, or with a smaller absolute ratio, carry no weight.
LEAST_DOCUMENTS = 5
LEAST_RATIO = 1.0
RIDGE = 0.001


def places(text: str) -> np.ndarray:
    """Hash places of all n-grams of the lower-case text between two spaces, repeats included."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    state, found = np.zeros(len(codes) + 1, np.uint64), []
    for n in range(1, max(LENGTHS) + 1):
        state = state[:-1] * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in LENGTHS:
            mixed = (state ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BITS))
    return np.concatenate(found).astype(np.int64)


@dataclass(frozen=True)
class ToxicityModel:
    """Weight of every place, and the intercept."""

    weights: np.ndarray
    intercept: float


def score_text(text: str, weights: np.ndarray, intercept: float) -> float:
    hit = places(text)
    present = np.unique(hit[weights[hit] != 0])
    return float(1 / (1 + np.exp(-np.clip(intercept + weights[present].sum(), -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Learns from labelled rows that are not held out.

    Without labelled rows every score is 0.5; with one class only, its smoothed share.
    """
    known = labelled_sample(docs, labels, label, sample)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(places(text)) for (text,) in rows_of([batch.select(["text"])])]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.list_(pa.int64()))], ["label", "at"])

    grams = stored(known.select("label", "text").mapInArrow(present, "label int, at array<bigint>"), "grams")
    n, positives = grams.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not n or positives in (0, n):
        share = (positives + 1) / (n + 2)
        return ToxicityModel(np.zeros(PLACES, np.float32), float(np.log(share / (1 - share))))
    # At most one row per place reaches the driver.
    counts = grams.select("label", F.explode("at").alias("at")).groupBy("at").agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).toArrow()
    at, number, toxic = (counts.column(c).to_numpy().astype(np.int64) for c in ("at", "n", "toxic"))
    seen, bad = np.zeros(PLACES), np.zeros(PLACES)
    seen[at], bad[at] = number, toxic
    good = seen - bad
    ratio = np.log((bad + 1) / (positives + 2)) - np.log((good + 1) / (n - positives + 2))
    ratio[(seen < LEAST_DOCUMENTS) | (np.abs(ratio) < LEAST_RATIO)] = 0
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(ratio)

    def vector(at: list[int]):
        kept = np.array(at, np.int64)
        kept = kept[shared.value[kept] != 0]
        return Vectors.sparse(PLACES, kept.tolist(), shared.value[kept].tolist())

    rows = stored(grams.select(F.col("label").cast("double").alias("label"), F.udf(vector, VectorUDT())("at").alias("features")), "vectors")
    fitted = LogisticRegression(regParam=RIDGE, maxIter=60, standardization=False).fit(rows)
    return ToxicityModel((fitted.coefficients.toArray() * ratio).astype(np.float32), float(fitted.intercept))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row.

    A null text is an empty one and scores like a text without known n-grams.
    Other columns are ignored, repeated rows kept, an empty table stays empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score_text(text, *shared.value) for (text,) in rows_of([batch.select(["text"])])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = texts(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
