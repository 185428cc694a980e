"""Benchmark decontamination by fingerprints of item-sized windows.

For every benchmark item the windows of its length slide over each document; a
shorter document is one window as a whole. A window's SimHash over 5-word shingles is looked up in eight 8-bit blocks of the
items' fingerprints; a block matches with two differing bits or fewer, so every
item within 23 bits is found. Weighted Jaccard similarity over the counted
shingles then decides.

Fingerprints are only made of windows that hold enough shingles of any item:
at similarity ``s`` texts of ``m`` and ``n`` shingles share ``s(m + n) / (1 + s)`` of
them, so this loses nothing. The benchmark is a stated query set: it goes to the
executors in blocks of bounded size, and documents are never shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from stationflow.llm.common import rows_of
from stationflow.llm.words import SHINGLE, shingles, word_hashes

SIMILARITY = 0.8
#: A block of the benchmark holds at most so many items and words.
BLOCK_ITEMS = 5_000
BLOCK_WORDS = 1_000_000
RADIUS = 23
FILTER_BITS = 22

def shingles_of(text: str | None) -> np.ndarray:
    return shingles(word_hashes((text or "").encode("utf-8", "replace"))[0])


def majority(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
    return int(np.packbits(2 * bits.sum(0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0])


def weighted_jaccard(a: Counter, b: Counter) -> float:
    shared = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return shared / (a.total() + b.total() - shared)


class Index:
    """Fingerprints of some items, by length, with tables of their 8-bit blocks."""

    def __init__(self, items: list[tuple], similarity: float):
        self.similarity = similarity
        self.items: dict[int, list] = {}  # by number of shingles
        known = []
        for item_id, text in items:
            found = shingles_of(text)
            if len(found):
                self.items.setdefault(len(found), []).append((item_id, Counter(found.tolist()), majority(found)))
                known.append(found)
        self.known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.known >> np.uint64(64 - FILTER_BITS)] = True
        self.tables = {}
        values = np.arange(256, dtype=np.uint64)
        for m, own in self.items.items():
            prints = np.array([f for _, _, f in own], np.uint64)
            blocks = prints[None] >> (np.uint64(8) * np.arange(8, dtype=np.uint64))[:, None] & np.uint64(255)
            self.tables[m] = prints, np.bitwise_count(values[None, :, None] ^ blocks[:, None]) <= RADIUS // 8

    def matches(self, found: np.ndarray) -> dict:
        """``item: (similarity, first word, words)`` of the best window, by the shingles of a document."""
        out: dict = {}
        maybe = np.nonzero(self.filter[found >> np.uint64(64 - FILTER_BITS)])[0]
        if not len(maybe):
            return out
        at = np.minimum(np.searchsorted(self.known, found[maybe]), len(self.known) - 1)
        maybe = maybe[self.known[at] == found[maybe]]
        if not len(maybe):
            return out
        hit = np.zeros(len(found) + 1, np.int64)
        hit[maybe + 1] = 1
        total = np.cumsum(hit)
        for m, own in self.items.items():
            # A document shorter than the item is one window, if it can be similar at all.
            size = min(m, len(found))
            if size < self.similarity * m - 1e-9:
                continue
            least = math.ceil(self.similarity * (size + m) / (1 + self.similarity) - 1e-9)
            prints, tables = self.tables[m]
            for at in np.nonzero(total[size:] - total[:-size] >= least)[0].tolist():
                window = found[at : at + size]
                own_print = majority(window)
                near = np.zeros(len(own), bool)
                for block in range(8):
                    near |= tables[block, own_print >> 8 * block & 255]
                near &= np.bitwise_count(prints ^ np.uint64(own_print)) <= RADIUS
                counted = Counter(window.tolist())
                for i in np.nonzero(near)[0].tolist():
                    item_id, shingled, _ = own[i]
                    s = weighted_jaccard(counted, shingled)
                    if s >= self.similarity and s > out.get(item_id, (0,))[0]:
                        out[item_id] = s, at, size + SHINGLE - 1
        return out


def blocks_of(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """The benchmark in lists of bounded size."""
    block, words = [], 0
    for item_id, text in benchmark.select("item_id", "text").toLocalIterator():
        n = len(text or "") // 4
        if block and (len(block) == BLOCK_ITEMS or words + n > BLOCK_WORDS):
            yield block
            block, words = [], 0
        block.append((item_id, text))
        words += n
    yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words`` of the best window per row and item.

    Words are runs of ASCII letters, digits and non-ASCII characters, ASCII in lower case.
    Null or empty texts, and items of fewer than five words, match nothing; of
    several best windows the first is named; repeated rows repeat their result;
    without documents or items there are no rows.
    """
    context = docs.sparkSession.sparkContext
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, similarity double, first_word bigint, n_words bigint"
    item_type = to_arrow_type(benchmark.schema["item_id"].dataType)
    out = None
    for block in blocks_of(benchmark):
        items = context.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items.value, similarity)
            for batch in batches:
                rows, found = [], []
                for row, (text,) in enumerate(rows_of([batch.select(["text"])])):
                    for item_id, match in index.matches(shingles_of(text)).items():
                        rows.append(row)
                        found.append((item_id, *match))
                columns = list(zip(*found)) if found else [()] * 4
                kinds = (item_type, pa.float64(), pa.int64(), pa.int64())
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").take(pa.array(rows, "int64")), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                        ["doc_id", "item_id", "similarity", "first_word", "n_words"],
                    )

        part = docs.select("doc_id", "text").mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found; null texts stay."""
    for block in blocks_of(benchmark):
        items = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = Index(items.value, similarity)
            for batch in batches:
                clean = [not index.matches(shingles_of(text)) for (text,) in rows_of([batch.select(["text"])])]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
