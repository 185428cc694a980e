"""Substring deduplication over paragraphs by MinHash bands.

A paragraph is a line, cut further after those sentence ends that the bytes before
them choose, seven of eight. So a passage inside a longer line falls
into the same paragraphs wherever it stands. Paragraphs of fewer than
``LEAST_WORDS`` words say too little and are left alone; equal ones are one from then on.

Bands are tuned for recall, in two depths. The shallow bands (one MinHash each)
find every paragraph with a possible partner. In each band's group all are verified
against one of them by exact Jaccard similarity of their 5-word shingles. Those
that fail, mostly around the borders of frequent passages, are regrouped by deep
bands (eight MinHashes each), again verified against one, and only what fails
there is compared with its whole deep group. Connected paragraphs form a class and its first
occurrence is kept.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import rows_of, stored
from stationflow.llm.components import components
from stationflow.llm.suffix_dedup import keyed
from stationflow.llm.words import SHINGLE, mixed, shingles, word_hashes

SIMILARITY = 0.8
RECALL = 0.99
LEAST_WORDS = 8
SENTENCE_END = re.compile(rb"\n|[.!?](?=[ \t\r\n])")
#: Paragraphs whose places are sent to the executors; beyond, texts are shuffled to them.
BROADCAST_ROWS = 1_000_000
DEEP = 8


def bands_for(rows: int, similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """Fewest bands of ``rows`` MinHashes that find a pair of ``similarity`` with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows) - 1e-9)


def cuts(data: bytes) -> list[tuple[int, int]]:
    """Byte ranges of all paragraphs."""
    out, at = [], 0
    for match in SENTENCE_END.finditer(data):
        end = match.end()
        if data[end - 1] == 10 or zlib.crc32(data[max(at, end - 8) : end]) & 7:
            out.append((at, end))
            at = end
    if at < len(data):
        out.append((at, len(data)))
    return out


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of all ranges, and where each range begins among them."""
    sizes = high - low
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.repeat(low - starts, sizes) + np.arange(sizes.sum()), starts


class Sketcher:
    """Shingles and MinHashes of paragraphs."""

    def __init__(self, hashes: int):
        draw = np.random.default_rng(10)
        self.factors = draw.integers(0, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
        self.terms = draw.integers(0, 1 << 63, hashes, np.uint64)
        self.powers = np.ones(1, np.uint64)

    def paragraphs(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number and hash of every paragraph, all shingles, and where each paragraph's begin."""
        h, at = word_hashes(data)
        borders = np.array(cuts(data), np.int64).reshape(-1, 2)
        low, high = np.searchsorted(at, borders[:, 0]), np.searchsorted(at, borders[:, 1])
        number = np.flatnonzero(high - low >= LEAST_WORDS)
        if not len(number):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        low, high = low[number], high[number]
        if len(self.powers) <= len(h):
            steps = np.full(2 * len(h), 0x9E3779B97F4A7C15, np.uint64)
            steps[0] = 1
            self.powers = np.cumprod(steps, dtype=np.uint64)
        word, starts = _ranges(low, high)
        digest = mixed(np.add.reduceat(h[word] * self.powers[word - np.repeat(low, high - low)], starts))
        # Shingles over the end of a paragraph belong to none.
        word, starts = _ranges(low, high - SHINGLE + 1)
        return number, digest.view(np.int64), shingles(h)[word], starts

    def minima(self, shingles: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        out = []
        for factor, term in zip(self.factors, self.terms, strict=True):
            mixed = (shingles + term) * factor
            mixed ^= mixed >> np.uint64(32)
            out.append(np.minimum.reduceat(mixed * factor, starts))
        return out


def sketches(docs: DataFrame, bands: int) -> DataFrame:
    """``doc_id, th, number, hash, keys`` of every paragraph; ``docs`` as from ``keyed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands)
        low = np.uint64((1 << 40) - 1)
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                part = batch.slice(begin, 128)
                row, number, digest, keys = [], [], [], [[] for _ in range(bands)]
                for i, (text,) in enumerate(rows_of([part.select(["text"])])):
                    own, hashes, found, starts = sketcher.paragraphs(text.encode("utf-8", "surrogatepass"))
                    if len(own):
                        row.append(np.full(len(own), i))
                        number.append(own)
                        digest.append(hashes)
                        for j, least in enumerate(sketcher.minima(found, starts)):
                            keys[j].append((least >> np.uint64(24) & low | np.uint64(j << 40)).view(np.int64))
                if row:
                    at = pa.array(np.concatenate(row))
                    numbers, digests = pa.array(np.concatenate(number)).cast("int32"), pa.array(np.concatenate(digest))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(at), part.column("th").take(at), numbers, digests, *(pa.array(np.concatenate(k)) for k in keys)],
                        ["doc_id", "th", "number", "hash", *names],
                    )

    names = [f"k{j}" for j in range(bands)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, th bigint, number int, hash bigint, " + ", ".join(f"{k} bigint" for k in names))


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``hash, shingles`` of the paragraphs ``of_id, of_th, numbers``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(0)
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                digest, sets = [], []
                for text, numbers in rows_of([batch.slice(begin, 128).select(["text", "numbers"])]):
                    own, hashes, found, starts = sketcher.paragraphs(text.encode("utf-8", "surrogatepass"))
                    ends = np.append(starts[1:], len(found))
                    for k in np.flatnonzero(np.isin(own, numbers)).tolist():
                        digest.append(int(hashes[k]))
                        sets.append(np.unique(found[starts[k] : ends[k]]).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(digest, "int64"), pa.array(sets, pa.list_(pa.int64()))], ["hash", "shingles"])

    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("th") == F.col("of_th"))
    return docs.join(wanted, same).select("text", "numbers").mapInArrow(run, "hash bigint, shingles array<bigint>")


def deep_keys(sets: DataFrame, bands: int) -> DataFrame:
    """``key, hash``: a row for each deep band of every paragraph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands * DEEP)
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                column = part.column("shingles")
                offsets = column.offsets.to_numpy().astype(np.int64)
                least = sketcher.minima(column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), offsets[:-1] - offsets[0])
                for band in range(bands):
                    key = np.full(part.num_rows, band, np.uint64)
                    for j in range(DEEP):
                        key = key * np.uint64(0x9E3779B97F4A7C15) + least[band * DEEP + j]
                        key ^= key >> np.uint64(29)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part.column("hash")], ["key", "hash"])

    return sets.select("hash", "shingles").mapInArrow(run, "key bigint, hash bigint")


def _alike(similarity: float):
    shared = F.size(F.array_intersect("x", "y"))
    return shared >= similarity * (F.size("x") + F.size("y") - shared) - 1e-9


def _against_first(groups: DataFrame, sets: DataFrame, similarity: float, name: str) -> DataFrame:
    """``key, hash, first, same`` for every member of a group but its first; ``groups`` has ``key, hash``."""
    firsts = groups.groupBy("key").agg(F.min("hash").alias("first"), F.max("hash").alias("last")).where("first < last").select("key", "first")
    members = stored(groups.join(firsts, "key").where("hash > first"), name)
    pairs = members.select("hash", "first").distinct()
    checked = (
        pairs.join(sets.withColumnRenamed("shingles", "x"), "hash")
        .join(sets.select(F.col("hash").alias("first"), F.col("shingles").alias("y")), "first")
        .select("hash", "first", _alike(similarity).alias("same"))
    )
    checked = stored(checked, f"{name}-checked")
    return members.join(checked, ["hash", "first"])


def links(distinct: DataFrame, docs: DataFrame, places: DataFrame, bands: int, similarity: float, recall: float = RECALL) -> DataFrame:
    """Edges ``a, b`` between distinct paragraphs."""
    keyed_rows = distinct.select("hash", F.explode(F.array(*[f"k{j}" for j in range(bands)])).alias("key"))
    shared = keyed_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    groups = stored(keyed_rows.join(shared, "key", "left_semi").select("key", "hash"), "bands")
    wanted = groups.select("hash").distinct().join(distinct.select("hash", "rep"), "hash")
    wanted = places.join(wanted, ["hash"]).where("id = rep").groupBy("doc_id", "th").agg(F.collect_set("number").alias("numbers"))
    wanted = stored(wanted.withColumnsRenamed({"doc_id": "of_id", "th": "of_th"}), "wanted")
    if wanted.agg(F.coalesce(F.sum(F.size("numbers")), F.lit(0))).first()[0] <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    sets = stored(shingle_sets(docs, wanted).dropDuplicates(["hash"]), "sets")

    shallow = _against_first(groups, sets, similarity, "shallow")
    edges = shallow.where("same").select(F.col("hash").alias("a"), F.col("first").alias("b"))
    # Whoever shares a group with a paragraph that failed may be its partner.
    open_groups = shallow.where("not same").select("key").distinct()
    again = groups.join(open_groups, "key", "left_semi").select("hash").distinct()
    deep = stored(deep_keys(sets.join(again, "hash", "left_semi"), bands_for(DEEP, similarity, recall)).distinct(), "deep")
    second = _against_first(deep, sets, similarity, "second")
    edges = edges.union(second.where("same").select(F.col("hash").alias("a"), F.col("first").alias("b")))
    failed = second.where("not same").select("key", F.col("hash").alias("a")).join(sets.select(F.col("hash").alias("a"), F.col("shingles").alias("x")), "a")
    others = deep.select("key", F.col("hash").alias("b")).join(second.where("not same").select("key").distinct(), "key", "left_semi")
    others = others.join(sets.select(F.col("hash").alias("b"), F.col("shingles").alias("y")), "b").withColumnRenamed("key", "of")
    rest = failed.join(others, (F.col("key") == F.col("of")) & (F.col("a") != F.col("b")) & _alike(similarity))
    return edges.union(rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).distinct()


def duplicate_paragraphs(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """``doc_id, number, class_id, kept`` of every paragraph that occurs, alike, more than once.

    ``number`` counts the paragraphs of a text from 0, ``class_id`` is the
    smallest hash of the class. The paragraph kept is the first by ``doc_id``
    (null last), text hash and number. Null and empty texts have no paragraphs. Rows
    that agree in id and text are one document, whose result comes once.
    """
    docs = keyed(docs)
    bands = bands_for(1, similarity, recall)
    places = stored(sketches(docs, bands).withColumn("id", F.xxhash64("doc_id", "th", "number")), "paragraphs")
    keys = [F.min(f"k{j}").alias(f"k{j}") for j in range(bands)]
    distinct = stored(places.groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("rep"), F.max("id").alias("other"), *keys), "distinct")
    found = components(links(distinct.select("hash", "rep", *[f"k{j}" for j in range(bands)]), docs, places.select("hash", "id", "doc_id", "th", "number"), bands, similarity, recall))
    rooted = distinct.join(found.toDF("hash", "root"), "hash", "left").where("root is not null or rep < other")
    rooted = stored(rooted.select("hash", F.coalesce("root", "hash").alias("class_id")), "classes")
    members = stored(places.join(rooted, "hash").select("doc_id", "th", "number", "class_id").distinct(), "members")
    # The first of each class in three steps, each an aggregation of numbers.
    last = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)) if dict(members.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint") else F.xxhash64("doc_id")
    ranked = members.withColumn("place", last)
    for step in ("place", "th", "number"):
        least = ranked.groupBy("class_id").agg(F.min(step).alias("least")).withColumnRenamed("class_id", "of")
        ranked = ranked.join(least, (F.col("class_id") == F.col("of")) & (F.col(step) == F.col("least"))).drop("of", "least")
    first = ranked.select(F.col("class_id").alias("of"), F.col("place").alias("first_place"), F.col("th").alias("first_th"), F.col("number").alias("first_number"))
    kept = (F.col("place") == F.col("first_place")) & (F.col("th") == F.col("first_th")) & (F.col("number") == F.col("first_number"))
    return members.withColumn("place", last).join(first, F.col("class_id") == F.col("of")).select("doc_id", "number", "class_id", kept.alias("kept"))
