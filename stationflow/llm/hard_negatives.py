"""Hard negatives by branch and bound over vertically stored dimensions (BOND).

Vectors are dealt to slices of about ``SLICE`` rows, and a slice is stored by
columns: one row per dimension with all its values, their least and greatest,
and one with ids and labels. Anchors, in blocks, are scanned against every slice:
the dimensions are read in the anchor's order of falling magnitude and partial
scores summed. From the least and greatest value of what is still unread follows
how far a score can still go; rows that cannot matter any more leave the
candidate bitmap, so the last dimensions are read for few of them.

Two scans are made. The first finds every anchor's positives, its best rows of
its own label. The second finds, for each positive's window of scores, the best
rows of other labels. Scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import stored

SCALE = 256
#: Rows of a slice, anchors of a block, dimensions that are read between two looks at the bounds.
SLICE, BLOCK, STEP = 8192, 8192, 8
#: The row of a slice that holds ids and labels instead of a dimension.
HEAD = -1


def integer_vectors(vectors: DataFrame, is_anchor: Column, label: Column, scale: int = SCALE) -> DataFrame:
    """``row, vec_id, label, v, anchor``: sound vectors with a label, scaled and floored."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.select("vec_id", label.cast("long").alias("label"), "embedding", F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
        .where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            "label",
            F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("v"),
            "anchor",
        )
    )


def padded(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers; shorter ones end in zeros."""
    column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def by_dimension(rows: DataFrame, slices: int, width: int) -> DataFrame:
    """``slice, dim, values, low, high, ids, labels``: the vertical slices, rows in the order of their ids."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def turn(group: pa.Table) -> pa.Table:
        group = group.sort_by([("vec_id", "ascending")])  # null last
        n, x = group.column("slice")[0].as_py(), padded(group.column("v"), width)
        ids = group.column("vec_id").combine_chunks()
        whole = pa.ListArray.from_arrays(pa.array([0, *[len(ids)] * (width + 1)], pa.int32()), ids)
        known = pa.array([True, *[False] * width])
        return pa.table(
            {
                "slice": pa.array([n] * (width + 1), pa.int32()),
                "dim": pa.array(range(HEAD, width), pa.int32()),
                "values": pa.array([None, *x.T], pa.list_(pa.int64())),
                "low": pa.array([None, *x.min(0).tolist()], pa.int64()),
                "high": pa.array([None, *x.max(0).tolist()], pa.int64()),
                "ids": pc.if_else(known, whole, pa.scalar(None, whole.type)),
                "labels": pa.array([group.column("label").to_numpy(), *[None] * width], pa.list_(pa.int64())),
            }
        )

    dealt = rows.select(F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("slice"), "vec_id", "label", "v")
    return dealt.groupBy("slice").applyInArrow(
        turn, f"slice int, dim int, values array<bigint>, low bigint, high bigint, ids array<{kind}>, labels array<bigint>"
    )


def dominating(part: np.ndarray, k: int) -> float:
    """The k-th greatest of ``part``, or minus infinity."""
    return np.partition(part, len(part) - k)[len(part) - k] if len(part) >= k else -np.inf


def scan(anchor: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, candidates: np.ndarray, k: int, windows: list[tuple[int, int]] | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows, of ``candidates``, and their scores: a superset of the ``k`` best, or of those of every window."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    a = anchor[order]
    ends = np.sort(np.stack([a * low[order], a * high[order]]), axis=0)
    # What the dimensions from each place on can still add, at least and at most.
    least, most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in ends)
    part = np.zeros(len(candidates), columns.dtype)
    for begin in range(0, len(order), STEP):
        dims = order[begin : begin + STEP]
        read = columns[dims] if len(candidates) == columns.shape[1] else columns[dims[:, None], candidates]
        part += a[begin : begin + STEP].astype(columns.dtype) @ read
        down, up = least[min(begin + STEP, len(order))], most[min(begin + STEP, len(order))]
        if windows is None:
            alive = part + up >= dominating(part, k) + down
        else:
            alive = np.zeros(len(part), bool)
            for floor, ceiling in windows:
                certain = part[(part + down >= floor) & (part + up <= ceiling)]
                alive |= (part + down <= ceiling) & (part + up >= max(floor, dominating(certain, k) + down))
        candidates, part = candidates[alive], part[alive]
        if not len(candidates):
            break
    return candidates, part


def window_of(score: int, least: Fraction, most: Fraction) -> tuple[int, int]:
    """Whole scores from ``least`` to ``most`` times ``score``, both included."""
    low, high = least * score, most * score
    return -(-low.numerator // low.denominator), high.numerator // high.denominator


def _best(rows: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller row, best first."""
    return np.lexsort((rows, -score))[:k]


def _scanned(anchors: DataFrame, slices: DataFrame, n_slices: int, width: int, k: int, share: tuple[Fraction, Fraction] | None) -> DataFrame:
    """``anchor, positive_score, vec_id, score``: the ``k`` best rows of every slice.

    Without ``share``, of the anchor's own label, and ``positive_score`` is null;
    with it, of other labels, for every score in the anchor's ``positives``.
    """
    kind = anchors.schema["vec_id"].dataType.simpleString()
    blocks = max(1, -(-anchors.count() // BLOCK))
    asked = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("slice"),
        F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
        "row",
        "vec_id",
        "label",
        "v",
        "positives",
    )
    offered = slices.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def solve(asked: pa.Table, offered: pa.Table) -> pa.Table:
        schema = pa.schema([("anchor", pa.int64()), ("positive_score", pa.int64()), ("vec_id", asked.schema.field("vec_id").type), ("score", pa.int64())])
        if not asked.num_rows or not offered.num_rows:
            return schema.empty_table()
        offered = offered.sort_by("dim")
        head = offered.slice(0, 1)
        ids, labels = head.column("ids").combine_chunks().flatten(), head.column("labels").combine_chunks().flatten().to_numpy()
        columns = offered.column("values").slice(1).combine_chunks().flatten().to_numpy().reshape(width, -1)
        low, high = (offered.column(c).slice(1).to_numpy() for c in ("low", "high"))
        x = padded(asked.column("v"), width)
        if float(np.abs(x).max(initial=0)) * float(np.abs(columns).max(initial=0)) * width < 2**53:
            columns = columns.astype(float)  # exact there, and faster
        found: list[pa.Table] = []
        rows, own_ids = asked.column("row").to_pylist(), asked.column("vec_id").to_pylist()
        positives = asked.column("positives").to_pylist()
        for anchor, own, label, v, scores in zip(rows, own_ids, asked.column("label").to_pylist(), x, positives):
            wanted = (labels == label) == (share is None)
            wanted &= pc.fill_null(pc.not_equal(ids, pa.scalar(own, ids.type)), True).to_numpy(zero_copy_only=False)
            windows = None if share is None else [window_of(p, *share) for p in scores]
            left, score = scan(v, columns, low, high, wanted.nonzero()[0], k, windows)
            for i, p in enumerate([None] if windows is None else scores):
                inside = np.arange(len(left)) if windows is None else ((score >= windows[i][0]) & (score <= windows[i][1])).nonzero()[0]
                best = inside[_best(left[inside], score[inside], k)]
                n = len(best)
                if n:
                    columns_ = [pa.array([anchor] * n), pa.array([p] * n, pa.int64()), ids.take(pa.array(left[best])), pa.array(score[best].astype(np.int64))]
                    found.append(pa.Table.from_arrays(columns_, schema=schema))
        return pa.concat_tables(found) if found else schema.empty_table()

    keys = ("slice", "block")
    result = f"anchor bigint, positive_score bigint, vec_id {kind}, score bigint"
    return asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(solve, result)


def _ranked(found: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    least: Fraction = Fraction(80, 100),
    most: Fraction = Fraction(1),
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    An anchor's positives are its ``positives`` best other rows of its label. Each
    positive's negatives are the ``negatives`` best rows of other labels that score
    from ``least`` to ``most`` times the positive; a negative score of a positive
    leaves no room. Best: higher score, then smaller id; a null id comes last.
    Fewer rows than asked: all of them.

    Other rows are those of another id, so repeated rows of the anchor's id are its
    own; repeated anchors and positives give repeated rows. ``label`` may replace the
    column. Rows with a null label or vector, or a null or non-finite component,
    take no part; shorter vectors count as padded with zeros, and scores must fit
    64 bits. An empty table gives no row; other columns play no part.
    """
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, is_anchor, F.col("label") if label is None else label, scale), "labelled-vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not width:
        return spark.createDataFrame(
            [], f"anchor_id {kind}, positive_id {kind}, rank int, negative_id {kind}, positive_score bigint, negative_score bigint"
        )
    n_slices = -(-n // SLICE)
    slices = stored(by_dimension(rows, n_slices, width), "dimensions")
    anchors = rows.where("anchor").withColumn("positives", F.lit(None).cast("array<bigint>"))
    own = stored(_ranked(_scanned(anchors, slices, n_slices, width, positives, None), positives, "anchor"), "positives")
    scores = own.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("score").alias("positives"))
    ready = anchors.drop("positives").join(scores, "row")
    found = _ranked(_scanned(ready, slices, n_slices, width, negatives, (least, most)), negatives, "anchor", "positive_score")
    named = own.select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (
        found.join(named, ["anchor", "positive_score"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
