"""Collocations by SETM: relations of phrase occurrences, extended by merge joins.

An occurrence is a row ``segment, at, phrase``: a phrase that starts at a
position of a piece of text. Occurrences of one word come from the texts; those
of ``k + 1`` words are the merge join of those of ``k`` words with themselves,
the second starting one position later. Before every join the relation is
reduced to frequent phrases, and it is kept as a table that is bucketed by
segment and sorted by position, so that the join needs no shuffle.

Pieces are cut into segments of ``SEGMENT`` words, each followed by copies of as
many words as a phrase can reach beyond it. So neither a very long piece nor a
very frequent phrase makes a large group: counts are combined before the shuffle.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stationflow.llm.common import shuffles_removed, stored
from stationflow.session import shared_dir

SEGMENT = 1024
#: What separates pieces.
PIECE_END = r"[.,;:!?\x0A-\x0D]"
#: Most phrases of a table that is sent to every executor, and most bytes of their text.
MOST_SENT, MOST_SENT_BYTES = 2_000_000, 64_000_000
#: Occurrences of a bucket; the session's shuffle partitions are the least number of buckets.
BUCKET_ROWS, MOST_BUCKETS = 2_000_000, 100_000
_PLACE_BITS = 33


def segments(docs: DataFrame, longest: int) -> DataFrame:
    """``lang, words``: words of every segment as they are written, and the ``longest - 1`` words that follow it."""
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\t"), F.lit(" "))
    pieces = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.explode(F.split(text, PIECE_END)).alias("piece"))
    # A single character to split at needs no regular expression.
    words = pieces.select("lang", F.array_remove(F.split("piece", " "), "").alias("words"))
    begins = F.when(F.size("words") > 0, F.sequence(F.lit(1), F.size("words"), F.lit(SEGMENT)))
    return words.select("lang", "words", F.explode(begins).alias("begin")).select(
        "lang", F.slice("words", F.col("begin"), F.lit(SEGMENT + longest - 1)).alias("words")
    )


def dealt_out(cut: DataFrame, buckets: int) -> DataFrame:
    """Rows ``lang, segment, words`` dealt to ``buckets`` partitions in order; words travel as one text, which is shorter than an array."""
    joined = cut.select("lang", "segment", F.array_join("words", " ").alias("said")).repartition(buckets, "segment").sortWithinPartitions("segment")
    return joined.select("lang", "segment", F.split("said", " ").alias("words"))


def lowered(word: str) -> Column:
    """``word`` with A to Z in lower case."""
    return F.translate(word, string.ascii_uppercase, string.ascii_lowercase)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with ``id``: its place, from 0, by falling ``f``; frequent phrases have small numbers."""
    placed = stored(df.orderBy(F.desc("f")).withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", _PLACE_BITS)
    # One row per partition of the sort.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + within).alias("id"))


def _fits(df: DataFrame, texts: str | None = None) -> bool:
    """Whether the counted rows and bytes of ``df`` allow to send it to every executor."""
    rows, size = df.agg(F.count("*"), F.sum(F.octet_length(texts)) if texts else F.lit(0)).first()
    return rows <= MOST_SENT and (size or 0) <= MOST_SENT_BYTES


def _small(df: DataFrame) -> DataFrame:
    """``df`` to be sent to every executor if it fits; else joined by a shuffle."""
    return F.broadcast(df) if _fits(df) else df


@contextmanager
def _joins_by_segment(spark: SparkSession) -> Iterator[None]:
    """Lets a join on segment and position use tables bucketed by segment alone, and the order of their buckets of one file each."""
    wanted = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class Occurrences:
    """A sorted, bucketed table ``segment, at, phrase``; rows that are ``dealt`` lie in as many partitions by segment already."""

    def __init__(self, rows: DataFrame, buckets: int, dealt: bool = False) -> None:
        self.spark, self.buckets = rows.sparkSession, buckets
        self.path, self.name = shared_dir(self.spark, "staged", "llm", "occurrences"), f"occurrences_{uuid.uuid4().hex}"
        writer = (rows if dealt else rows.repartition(buckets, "segment")).write.bucketBy(buckets, "segment").sortBy("segment", "at")
        with shuffles_removed(self.spark):
            writer.option("path", self.path).saveAsTable(self.name)

    def pairs(self) -> DataFrame:
        """``segment, at, x, y``: occurrences ``x`` followed by ``y`` one position later."""
        first, then = self.spark.table(self.name).alias("a"), self.spark.table(self.name).alias("b")
        adjacent = (F.col("a.segment") == F.col("b.segment")) & (F.col("a.at") + 1 == F.col("b.at"))
        return first.join(then.hint("merge"), adjacent).select("a.segment", "a.at", F.col("a.phrase").alias("x"), F.col("b.phrase").alias("y"))

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def _longer(counts: DataFrame, shorter: DataFrame, name: str) -> DataFrame:
    """Frequent phrases ``id, lang, text, last, f, heads, tails, x, y`` from counted pairs of shorter ones.

    ``heads`` are the counts of the first 1, 2, ... words, ``tails`` those of the last.
    """
    first = shorter.select(F.col("id").alias("x"), "lang", "text", F.concat("heads", F.array("f")).alias("heads"))
    then = shorter.select(F.col("id").alias("y"), "last", F.concat("tails", F.array("f")).alias("tails"))
    joined = counts.join(first, "x").join(then, "y").select("lang", F.concat_ws(" ", "text", "last").alias("text"), "last", "f", "heads", "tails", "x", "y")
    return numbered(joined, name)


def _cut(length: int) -> Column:
    """``score, k, l, r`` of the lowest-scoring cut, exact beyond 64 bits."""

    def cut(k: int) -> Column:
        exact = "cast(1000000 AS decimal(7,0)) * cast(f AS decimal(19,0)) * cast(f AS decimal(19,0))"
        parts = f"cast(heads[{k - 1}] AS decimal(19,0)) * cast(tails[{length - k - 1}] AS decimal(19,0))"
        return F.struct(
            F.expr(f"cast(({exact}) div ({parts}) AS bigint)").alias("score"),
            F.lit(k).alias("k"),
            F.col("heads")[k - 1].alias("l"),
            F.col("tails")[length - k - 1].alias("r"),
        )

    return F.array_min(F.array(*[cut(k) for k in range(1, length)]))


def collocations(docs: DataFrame, least: int = 10, longest: int = 3, share: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of 2 to ``longest`` words of every language.

    A phrase of ``a >= least`` occurrences, overlaps included, is cut into two
    parts with ``l`` and ``r`` occurrences; its score is
    ``floor(1000000 * a * a / (l * r))`` of its lowest-scoring cut (ties: the
    shorter first part). Phrases inside a longer one that has ``share`` percent
    of their occurrences are dropped. ``n`` counts the words of the language.
    Order: score, then ``a``, falling, then the phrase by its bytes.

    Only A to Z are lower-cased. A null text is empty, a null language ``und``;
    repeated rows count as often as they stand; other columns play no part. No
    phrase that is frequent enough: no row, also for an empty table.
    """
    spark = docs.sparkSession
    docs = docs.select("lang", "text")
    own = F.slice("words", 1, SEGMENT)
    each = segments(docs, longest).select("lang", F.explode(own).alias("written"))
    # Only distinct words are lower-cased.
    spelled = each.groupBy("lang", "written").agg(F.count("*").alias("f")).withColumn("text", lowered("written"))
    spelled = stored(spelled, "spellings")
    counted = spelled.groupBy("lang", "text").agg(F.sum("f").alias("f"))
    totals = spelled.groupBy("lang").agg(F.sum("f").alias("n"))
    none = F.array().cast("array<bigint>")
    frequent = counted.where(F.col("f") >= least).select("lang", "text", F.col("text").alias("last"), "f", none.alias("heads"), none.alias("tails"))
    known = numbered(frequent, "frequent-words")
    spellings = stored(spelled.join(known.select("lang", "text", F.col("id").alias("phrase")), ["lang", "text"]).select("lang", "written", "phrase"), "codes")

    words = totals.agg(F.sum("n")).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), words // BUCKET_ROWS))
    cut, sent = segments(docs, longest).where(F.size("words") > 1).withColumn("segment", F.monotonically_increasing_id()), _fits(spellings, "written")
    if sent:
        # Whole segments are dealt out, fewer rows than their words, and these come in order.
        cut, spellings = dealt_out(cut, buckets), F.broadcast(spellings)
    each = cut.select("lang", "segment", F.posexplode("words").alias("at", "written"))
    occurrences = Occurrences(each.join(spellings, ["lang", "written"]).select("segment", "at", "phrase"), buckets, dealt=sent)
    found = []
    with _joins_by_segment(spark):
        for length in range(2, longest + 1):
            pairs = occurrences.pairs()
            counts = stored(
                pairs.where(F.col("at") < SEGMENT).groupBy("x", "y").agg(F.count("*").alias("f")).where(F.col("f") >= least), f"pairs-{length}"
            )
            longer = _longer(counts, known, f"phrases-{length}")
            found.append(longer.select("lang", "text", "f", _cut(length).alias("cut"), "id", "x", "y"))
            if length < longest:
                kept = pairs.join(_small(longer.select("x", "y", F.col("id").alias("phrase"))), ["x", "y"])
                further = Occurrences(kept.select("segment", "at", "phrase"), buckets)
                occurrences.drop()
                occurrences = further
            known = longer
    occurrences.drop()

    candidates = []
    for phrase, longer in zip(found, [*found[1:], None]):
        if longer is not None:
            ends = longer.select(F.explode(F.array("x", "y")).alias("id"), "f").groupBy("id").agg(F.max("f").alias("most"))
            phrase = phrase.join(ends, "id", "left").where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("f")))
        candidates.append(phrase.select("lang", "text", "f", "cut"))
    ranked = candidates[0]
    for more in candidates[1:]:
        ranked = ranked.union(more)
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("f"), "text")
    best = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        F.col("text").alias("phrase"),
        F.col("f").alias("a"),
        F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"),
        "n",
        F.col("cut.score").alias("score"),
    )
