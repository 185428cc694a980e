"""Quality: a sparse ensemble of rules over text statistics.

Boosted trees over statistics of labelled texts propose rules, one for every
path from a root to a node. A lasso logistic regression over the rules as 0/1
features keeps few of them. The kept rules and their weights become one Spark
column, so that scoring is a scan without a shuffle or Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import held_out, labelled_sample, own_name, stored

#: Most labelled rows that the rules are fitted on; those with the smallest hash of their id.
SAMPLE = 20_000
TREES = 24
DEPTH = 3
LASSO = 0.001
THRESHOLD = 0.3


def statistics(text: Column) -> dict[str, Column]:
    """Numbers of one text, by name; shares are 0 where there is nothing to divide by."""
    words, lines = F.filter(F.split(text, r"\s+"), lambda w: w != ""), F.split(text, "\n")
    n_chars, n_words = F.length(text), F.size(words)
    letters = F.length(F.regexp_replace(text, r"[\P{L}]+", ""))

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return {
        "n_words": n_words.cast("double"),
        "word_length": share(letters, n_words),
        "letter_share": share(letters, n_chars),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "words_per_line": share(n_words, F.size(lines)),
        "digit_share": share(F.regexp_count(text, F.lit(r"\d")), n_chars),
        "upper_share": share(F.regexp_count(text, F.lit(r"\p{Lu}")), n_words),
        "stops": share(F.regexp_count(text, F.lit(r"[.!?]")), n_words),
        "bars": share(F.regexp_count(text, F.lit(r"[|<>{}\[\]=_/\\]")), n_words),
        "signs": share(F.regexp_count(text, F.lit(r"[*#%&$@~^+]")), n_words),
        "short_words": share(F.regexp_count(text, F.lit(r"(?<!\S)\S{1,3}(?!\S)")), n_words),
    }


Condition = tuple[str, str, float]


@dataclass(frozen=True)
class RuleModel:
    """Conjunctions of conditions with their weights, and the intercept."""

    rules: tuple[tuple[tuple[Condition, ...], float], ...]
    intercept: float

    def column(self, stats: dict[str, Column]) -> Column:
        """Score between 0 and 1 as one expression over statistics."""
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            total = total + F.when(holds(conditions, stats), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def holds(conditions: tuple[Condition, ...], stats: dict[str, Column]) -> Column:
    out = F.lit(True)
    for name, sign, border in conditions:
        out = out & (stats[name] <= border if sign == "<=" else stats[name] > border)
    return out


def paths(described: str, names: list[str]) -> list[tuple[Condition, ...]]:
    """All paths from a root to a node, from the printed form of trees."""
    found: dict[tuple[Condition, ...], None] = {}
    way: list[tuple[int, Condition]] = []
    for line in described.split("\n"):
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-\d.Ee]+)\)", line):
            depth = len(m[1])
            way = [w for w in way if w[0] < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
            found[tuple(sorted(c for _, c in way))] = None
        elif line.lstrip().startswith("Tree "):
            way = []
    return list(found)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> RuleModel:
    """Learns from labelled rows that are not held out.

    Without labelled rows every score is 0.5; with one class only, its smoothed share.
    """
    import math

    known = labelled_sample(docs, labels, label, sample)
    stats = statistics(F.col("text"))
    names = list(stats)
    rows = stored(known.select(F.col("label").cast("double").alias("label"), *[c.alias(n) for n, c in stats.items()]), "statistics")
    n, positives = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or positives in (0, n):
        share = (positives + 1) / (n + 2)
        return RuleModel((), math.log(share / (1 - share)))
    vectors = rows.select("label", array_to_vector(F.array(*names)).alias("features"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=5, stepSize=0.3, seed=1).fit(vectors)
    rules = paths(trees.toDebugString, names)
    held = {s: F.col(s) for s in names}
    as_rules = rows.select("label", array_to_vector(F.array(*[holds(r, held).cast("double") for r in rules])).alias("features"))
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=100, standardization=False).fit(as_rules)
    kept = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w)
    return RuleModel(kept, float(lasso.intercept))


def with_score(docs: DataFrame, model: RuleModel, name: str) -> DataFrame:
    """All columns of ``docs`` and the score; statistics of a null text are those of an empty one."""
    stats = {s: (own_name(), c) for s, c in statistics(F.coalesce(F.col("text"), F.lit(""))).items()}
    wide = docs.withColumns(dict(stats.values()))
    return wide.select(*docs.columns, model.column({s: F.col(own) for s, (own, _) in stats.items()}).alias(name))


def score(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; repeated rows are kept, an empty table stays empty."""
    return with_score(docs.select("doc_id", "text"), model, "score").select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``threshold``."""
    name = own_name()
    return with_score(docs, model, name).where(F.col(name) >= threshold).select(*docs.columns)
