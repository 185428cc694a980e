"""Exact substring deduplication with a logarithmic family of suffix arrays.

The suffixes are sampled (:mod:`stationflow.llm.suffixes`): one entry ``h, r`` for
every run of windows with one anchor, where ``h`` hashes the first bytes of the
suffix at the anchor and ``r`` all bytes of the run. Order is by these hashes: it
keeps equal suffixes adjacent, which is all that a merge scan needs.

A new batch of documents becomes a sorted array of distinct entries. It is merge-
scanned against all levels for entries with the same ``h``; levels of equal size
are merged before the next batch comes, so each entry is rewritten a logarithmic
number of times.

What the scans report settles nearly all windows: a run whose ``h, r`` occurs twice is
covered, one whose ``h`` occurs once is not. For the rest, at the borders of
repeated passages, one copy of each distinct run is compared window by window
with the other runs of its anchor. Bytes never leave a document but for these runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import rows_of, stored, texts
from stationflow.llm.suffixes import WINDOW, gram_hashes, run_hashes, runs

#: Border runs whose positions are sent to the executors; beyond, texts are shuffled to them.
BROADCAST_ROWS = 1_000_000
#: Distinct runs of one anchor that a task compares; beyond, their windows are counted as rows.
GROUP_RUNS = 20_000
CHUNK_RUNS = 2_000


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, th, text``: rows that agree in id and text hash are copies and share all results."""
    return texts(docs, "doc_id").select("doc_id", F.xxhash64("text").alias("th"), "text")


def entries(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, th, first, last, h, r`` of every run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                row, first, last, h, r = [], [], [], [], []
                for i, (text,) in enumerate(rows_of([part.select(["text"])])):
                    data = text.encode("utf-8", "surrogatepass")
                    own = runs(data, window)
                    if len(own[0]):
                        row.append(np.full(len(own[0]), i))
                        first.append(own[0])
                        last.append(own[1])
                        h.append(own[2].view(np.int64))
                        r.append(np.array(run_hashes(data, own[0], own[1], window), np.uint64).view(np.int64))
                if row:
                    at = pa.array(np.concatenate(row))
                    columns = [pa.array(np.concatenate(c)) for c in (first, last, h, r)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(at), part.column("th").take(at), columns[0].cast("int32"), columns[1].cast("int32"), *columns[2:]],
                        ["doc_id", "th", "first", "last", "h", "r"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, th bigint, first int, last int, h bigint, r bigint")


class SuffixFamily:
    """Levels of sorted suffix arrays; a level is ``(batches, h, r, n, rep)``."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []

    def _merge(self) -> None:
        """Equal-sized levels become one, until all sizes differ."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels.pop(), self.levels.pop()
            both = a.union(b).groupBy("h", "r").agg(F.sum("n").alias("n"), F.min("rep").alias("rep"))
            self.levels.append((n + m, stored(both.sortWithinPartitions("h", "r"), "level")))

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds entries ``h, r, id`` and returns ``h, r, n, rep`` of both sides of all matches with the batch.

        A match is a piece at an anchor that occurs twice in the batch or in
        it and in a level; matches within levels were reported before.
        """
        self._merge()
        new = stored(batch.groupBy("h", "r").agg(F.count("*").alias("n"), F.min("id").alias("rep")).sortWithinPartitions("h", "r"), "level")
        scan = new.withColumn("new", F.lit(True))
        for _, level in self.levels:
            scan = scan.union(level.withColumn("new", F.lit(False)))
        self.levels.append((1, new))
        scan = scan.repartition("h")
        met = scan.groupBy("h").agg(F.sum("n").alias("total"), F.max("new").alias("any")).where("total > 1 and any").select("h")
        return stored(scan.join(met, "h", "left_semi").select("h", "r", "n", "rep"), "matches")


def _window_hashes(data: bytes, h: int, window: int) -> np.ndarray:
    """Hash of every window of a run, mixed with its anchor's."""
    return gram_hashes(np.frombuffer(data, np.uint8), window) ^ np.uint64(h * 0x9E3779B97F4A7C15 & (1 << 64) - 1)


def _intervals(first: int, covered: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [(first + int(a), first + int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _border_windows(content: DataFrame, window: int) -> DataFrame:
    """``doc_id, th, first, last`` of windows that two distinct runs of one anchor have in common."""

    def settle(held: list[tuple]) -> Iterator[tuple]:
        hashes = [_window_hashes(data, h, window) for h, _, _, _, data in held]
        _, place, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        twice, at = count[place] > 1, 0
        for (_, doc_id, th, first, _), own in zip(held, hashes, strict=True):
            for a, b in _intervals(first, twice[at : at + len(own)]):
                yield doc_id, th, a, b
            at += len(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            held: list[tuple] = []
            for row in rows_of(batches):
                if len(held) >= CHUNK_RUNS and held[-1][0] != row[0]:
                    yield from settle(held)
                    held = []
                held.append(row)
            if held:
                yield from settle(held)

        out: list[tuple] = []
        for row in found():
            out.append(row)
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    kind = content.schema["doc_id"].dataType.simpleString()
    result = content.select("doc_id", "th", "first", F.col("first").alias("last"))
    schema = to_arrow_schema(result.schema)
    runs_of = content.select("h", "doc_id", "th", "first", "data").repartition("h").sortWithinPartitions("h")
    return runs_of.mapInArrow(run, f"doc_id {kind}, th bigint, first int, last int")


def _counted_windows(content: DataFrame, window: int) -> DataFrame:
    """The same for anchors with very many distinct runs: a row per window, combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (h, first, data) in enumerate(rows_of([batch.select(["h", "first", "data"])])):
                hashes = _window_hashes(data, h, window)
                at = pa.array(np.full(len(hashes), i))
                places = pa.array(np.arange(first, first + len(hashes), dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(at) for c in ("h", "doc_id", "th")), places, pa.array(hashes.view(np.int64))], ["h", "doc_id", "th", "first", "w"]
                )

    kind = content.schema["doc_id"].dataType.simpleString()
    rows = content.mapInArrow(run, f"h bigint, doc_id {kind}, th bigint, first int, w bigint")
    twice = rows.groupBy("h", "w").agg(F.count("*").alias("n")).where("n > 1").select("h", "w")
    return rows.join(twice, ["h", "w"]).select("doc_id", "th", "first", F.col("first").alias("last"))


def covered(docs: DataFrame, window: int = WINDOW, batches: int = 3) -> DataFrame:
    """``doc_id, th, first, last``: window starts that occur elsewhere too; ``docs`` as from :func:`keyed`."""
    own = stored(entries(docs, window), "entries").withColumn("id", F.xxhash64("doc_id", "th", "first"))
    family, found = SuffixFamily(), None
    for number in range(batches):
        matches = family.add(own.where(F.pmod(F.xxhash64("doc_id", "th"), F.lit(batches)) == number).select("h", "r", "id"))
        found = matches if found is None else found.union(matches)
    several = (F.max("n") > 1) | (F.min("rep") < F.max("rep"))
    known = stored(found.groupBy("h", "r").agg(several.alias("several"), F.min("rep").alias("rep")), "matched")
    anchors = known.groupBy("h").agg(F.count("*").alias("runs"))
    known = known.join(anchors, "h").where("several or runs > 1")
    marked = stored(
        own.join(known, ["h", "r"]).select(
            "doc_id", "th", "first", "last", "h", "runs", "several", ((F.col("runs") > 1) & (~F.col("several") | (F.col("id") == F.col("rep")))).alias("border")
        ),
        "marked",
    )
    border = stored(marked.where("border").groupBy("doc_id", "th").agg(F.collect_set(F.struct("h", "first", "last", "runs")).alias("runs")), "border")
    if border.agg(F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()[0] <= BROADCAST_ROWS:
        border = F.broadcast(border)
    border = border.withColumnsRenamed({"doc_id": "of_id", "th": "of_th"})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                part = batch.slice(begin, 128)
                row, columns = [], ([], [], [], [])
                for i, (text, own) in enumerate(rows_of([part.select(["text", "runs"])])):
                    data = text.encode("utf-8", "surrogatepass")
                    for run in own:
                        row.append(i)
                        for column, value in zip(columns, (run["h"], run["first"], run["runs"], data[run["first"] : run["last"] + window]), strict=True):
                            column.append(value)
                at = pa.array(row, "int64")
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("th").take(at), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", "th", "h", "first", "runs", "data"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("th") == F.col("of_th"))
    content = docs.join(border, same).select("doc_id", "th", "text", "runs")
    content = content.mapInArrow(cut, f"doc_id {kind}, th bigint, h bigint, first int, runs bigint, data binary")
    content = stored(content, "content")
    few = _border_windows(content.where(F.col("runs") <= GROUP_RUNS), window)
    many = _counted_windows(content.where(F.col("runs") > GROUP_RUNS), window)
    return marked.where("several").select("doc_id", "th", "first", "last").union(few).union(many)


def deduplicate(docs: DataFrame, window: int = WINDOW, batches: int = 3, with_text: bool = True) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if ``with_text``, ``spans`` and ``kept``.

    Every byte is removed that a ``window``-byte string covers which also starts
    elsewhere in any document, this one included. ``spans`` holds half-open byte ranges, ``kept``
    the remaining bytes. Null and empty texts have no bytes; rows with a null
    id and repeated rows count as documents of their own; an empty table
    gives an empty result.
    """
    docs = keyed(docs)
    found = covered(docs, window, batches)
    spans = found.groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "last")).alias("windows")).withColumnsRenamed({"doc_id": "of_id", "th": "of_th"})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                out = []
                for text, own in rows_of([part.select(["text", "windows"])]):
                    data, gone, kept, at = text.encode("utf-8", "surrogatepass"), [], [], 0
                    for first, last in sorted((w["first"], w["last"] + window) for w in own or ()):
                        if gone and first <= gone[-1][1]:
                            gone[-1][1] = max(gone[-1][1], last)
                        else:
                            gone.append([first, last])
                    for first, last in gone:
                        kept.append(data[at:first])
                        at = last
                    rest = b"".join([*kept, data[at:]])
                    out.append((len(data), len(data) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), gone, rest))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())), pa.binary()]
                keep = len(kinds) if with_text else 4
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns[:keep], kinds[:keep]))], names[: keep + 1])

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", spans array<array<bigint>>, kept binary" * with_text
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("th") == F.col("of_th"))
    return docs.join(spans, same, "left").select("doc_id", "text", "windows").mapInArrow(cut, schema)
