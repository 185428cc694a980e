"""SimHash near-duplicates by anchor-point covering.

The anchors are the words of a product of perfect codes on 61 of the 64 bits:
two binary Golay codes (23 bits, covering radius 3) and one Hamming code
(15 bits, covering radius 1). A fingerprint is replicated to every anchor
within the covering radius plus one bit in one of the codes. That is the
threshold's share of each side: between two fingerprints at two bits or fewer lies
a word within one bit of both, and the anchor that covers this word covers
both of them. About 16 anchors per fingerprint follow, of 2^35 in all.

At an anchor that holds more than one fingerprint, two of them link if they share a
word within one bit of both that belongs to this anchor. Sharing is an
aggregation by word, so a group of any size costs its length, not its square,
and each member is linked to the word's smallest fingerprint. Equal
fingerprints are one row throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from stationflow.llm.common import own_name, rows_of, stored, texts
from stationflow.llm.components import components

SHINGLE = 3
SEED = 42


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 majority bits over the hashes of all word shingles; zero without words."""
    words = text.encode().lower().split()  # for bytes both know ASCII only
    if not words:
        return 0
    data = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, width = ends - lengths, min(shingle, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashed, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    hashes = np.array([hashed(data[i:j], seed) for i, j in spans], "<u8")
    for begin in range(0, len(hashes), 50_000):
        bits = np.unpackbits(hashes[begin : begin + 50_000].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every row; ``fp`` holds the 64 bits as a signed integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text) for (text,) in rows_of([batch.select(["text"])])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs, "doc_id").mapInArrow(run, f"doc_id {kind}, fp bigint")


class PerfectCode:
    """A cyclic code whose balls of one radius fill the space; homes are code words."""

    def __init__(self, bits: int, generator: int, radius: int):
        self.bits = bits
        checks, rest = [], 1
        for _ in range(bits):
            checks.append(rest)
            rest <<= 1
            if rest >> (generator.bit_length() - 1):
                rest ^= generator
        self.bytes = []
        for low in range(0, bits, 8):
            part = np.zeros(1, np.uint64)
            for check in checks[low : low + 8]:
                part = np.concatenate([part, part ^ np.uint64(check)])
            self.bytes.append(np.resize(part, 256))
        self.leaders = np.zeros(1 << (generator.bit_length() - 1), np.uint64)
        for weight in range(1, radius + 1):
            for places in combinations(range(bits), weight):
                syndrome = 0
                for p in places:
                    syndrome ^= checks[p]
                self.leaders[syndrome] = sum(1 << p for p in places)

    def home(self, words: np.ndarray) -> np.ndarray:
        syndrome = np.zeros_like(words)
        for i, part in enumerate(self.bytes):
            syndrome ^= part[(words >> np.uint64(8 * i)) & np.uint64(255)]
        return words ^ self.leaders[syndrome]


class Anchors:
    """Words within one bit of a fingerprint and the anchor that each belongs to."""

    def __init__(self):
        golay, hamming = PerfectCode(23, 0b110001110101, 3), PerfectCode(15, 0b10011, 1)
        self.codes = ((golay, 0), (golay, 23), (hamming, 46))

    def around(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two matrices, a row per fingerprint: 65 words, their anchors."""
        x = fps.astype(np.int64).view(np.uint64)
        words = x[:, None] ^ np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
        homes = np.zeros_like(words)
        for code, low in self.codes:
            mask = np.uint64((1 << code.bits) - 1)
            homes |= code.home((words >> np.uint64(low)) & mask) << np.uint64(low)
        return words, homes


def links(prints: DataFrame) -> DataFrame:
    """Edges ``a, b`` whose closure joins all fingerprints (column ``fp``, distinct) at two bits or fewer."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = Anchors()
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            homes = np.sort(cover.around(fps)[1], axis=1)
            new = np.ones(homes.shape, bool)
            new[:, 1:] = homes[:, 1:] != homes[:, :-1]
            row, _ = np.nonzero(new)
            yield pa.RecordBatch.from_arrays([pa.array(homes[new].view(np.int64)), pa.array(fps[row])], ["anchor", "fp"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = Anchors()
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            near, homes = cover.around(fps)
            own = homes == batch.column("anchor").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[:, None]
            row, _ = np.nonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(near[own].view(np.int64)), pa.array(fps[row])], ["word", "fp"])

    at = prints.select("fp").mapInArrow(anchors, "anchor bigint, fp bigint")
    at = stored(at, "anchors")
    shared = at.groupBy("anchor").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi").select("anchor")
    near = stored(at.join(shared, "anchor", "left_semi").mapInArrow(words, "word bigint, fp bigint"), "words")
    least = near.groupBy("word").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo < hi")
    return near.join(least, "word").where("fp > lo").select(F.col("fp").alias("a"), F.col("lo").alias("b")).distinct()


def classes(prints: DataFrame) -> DataFrame:
    """``fp, root``: the classes of all fingerprints of ``prints`` that have a partner."""
    return components(links(prints.select("fp").distinct())).toDF("fp", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    A null text is an empty one; documents without words have fingerprint zero
    and link like others. Rows with a null id take part but name no component:
    ``component_id`` is the smallest id reachable, null if there is none.
    Repeated rows are kept; an empty table gives an empty result.
    """
    prints = stored(fingerprints(docs), "fingerprints")
    by_print = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = by_print.join(classes(by_print), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are first in their class: by id (null last), then as read."""
    row, fp, names = own_name(), own_name(), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text or "") for (text,) in rows_of([batch.select(["text"])])]
            yield batch.append_column(fp, pa.array(found, pa.int64()))

    printed = docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(fp, LongType())]))
    rows = stored(printed.withColumn(row, F.monotonically_increasing_id()), "printed")
    known = rows.select(F.col(row).alias("row"), "doc_id", F.col(fp).alias("fp"))
    rooted = known.join(classes(known), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("first"))
    return rows.join(first.select(F.col("first.row").alias(row)), row, "left_semi").select(*names)
