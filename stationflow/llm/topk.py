"""Exact top-k inner products by a Voronoi join.

With one more coordinate, ``sqrt(M^2 - |x|^2)`` for a candidate (``M`` the largest
norm) and 0 for a query, a larger inner product is a smaller distance. In that
space the rows are grouped by their nearest pivot. From a summary of each group,
its ``k + 1`` smallest distances to the pivot, follows a distance within which
every query of a group has ``k`` candidates; a candidate goes only to those query
groups that the triangle inequality cannot rule out. Query groups are cut into
blocks and candidates into slices, so that a task holds a bounded number of each;
the best ``k`` of every slice meet in a last, small ranking.

Vectors are integers by then; distances only prune, with slack, and the scores
that rank are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import stored

SCALE = 64


def integer_vectors(vectors: DataFrame, is_query: Column, scale: int = SCALE) -> DataFrame:
    """``row, vec_id, v, query``: vectors without nulls, NaN or infinities, scaled and floored."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        vectors.select("vec_id", "embedding", F.coalesce(is_query, F.lit(False)).alias("query"))
        .where(F.col("embedding").isNotNull() & sound)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            F.transform("embedding", lambda x: F.floor(scale * x.cast("double"))).alias("v"),
            "query",
        )
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Rows of integers, shorter ones padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), max(width, lengths.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer inner products; in floating point where that is exact."""
    width = max(queries.shape[1], candidates.shape[1])
    q, c = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (queries, candidates))
    largest = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * width
    if largest < 2**53:
        return (q.astype(float) @ c.T.astype(float)).astype(np.int64)
    return q @ c.T


def lifted(vectors: np.ndarray, norm2: float, query: np.ndarray | bool) -> np.ndarray:
    x = vectors.astype(float)
    last = np.sqrt(np.maximum(norm2 - (x * x).sum(1), 0))
    return np.column_stack([x, np.where(query, 0.0, last)])


def nearest(points: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gaps = (points * points).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * points @ pivots.T
    cell = gaps.argmin(1)
    return cell, np.sqrt(np.maximum(gaps[np.arange(len(points)), cell], 0))


def needs(close: pd.DataFrame, far: dict[int, float], between: np.ndarray, k: int, slack: float) -> dict[int, np.ndarray]:
    """By query cell: how far a candidate of each cell must at least be from its pivot to be among the best of any query there.

    ``close`` holds ``cell, vec_id, away``. Any k + 1 different ids bound the distance of a query's k-th
    best, as one of them may be its own; rows that repeat an id count once.
    """
    out = {}
    for i, reach in far.items():
        within = pd.Series(reach + between[i, close.cell.to_numpy(int)] + close.away.to_numpy(float))
        within = np.sort(within.groupby(close.vec_id.to_numpy()).min().to_numpy())
        bound = within[k] if len(within) > k else np.inf
        out[i] = between[i] - reach - bound - slack
    return out


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, pivots: int = 64, block: int = 2048, slice_rows: int = 16384, scale: int = SCALE
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best candidates, ties to the smaller id.

    Candidates are all rows whose id is not the query's own, so repeated rows of
    one id are its own too; a candidate without id ranks last among equals. A
    shorter vector counts as padded with zeros. Rows with a null vector, or a
    null or non-finite component, take no part. Fewer than ``k`` candidates:
    all of them; no rows: an empty result.
    """
    spark = vectors.sparkSession
    rows = stored(integer_vectors(vectors, is_query, scale), "vectors")
    width, norm2, n, queries = rows.agg(
        F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)), F.count("*"), F.count_if("query")
    ).first()
    kind = vectors.schema["vec_id"].dataType.simpleString()
    result = f"query bigint, query_id {kind}, vec_id {kind}, score bigint"
    if not queries or not width:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score bigint")
    norm2 = float(norm2)
    # At most `pivots` rows of bounded width reach the driver.
    chosen = rows.orderBy(F.xxhash64("row"), "row").limit(pivots).select("v").toArrow()
    centres = lifted(matrix(chosen.column("v"), width), norm2, False)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), width)
            columns = []
            for query in (False, True):
                columns += nearest(lifted(x, norm2, query), centres)
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], [*batch.schema.names, "cell", "away", "q_cell", "q_away"])

    placed = stored(
        rows.mapInArrow(assign, f"row bigint, vec_id {kind}, v array<bigint>, query boolean, cell bigint, away double, q_cell bigint, q_away double"),
        "cells",
    )

    # Summaries: per cell the k + 1 ids closest to its pivot, and the farthest query.
    by_gap = Window.partitionBy("cell").orderBy("away")
    nearest_of_id = placed.where("vec_id IS NOT NULL").groupBy("cell", "vec_id").agg(F.min("away").alias("away"))
    close = nearest_of_id.withColumn("place", F.row_number().over(by_gap)).where(F.col("place") <= k + 1).toPandas()
    reach = placed.where("query").groupBy("q_cell").agg(F.max("q_away").alias("far"), F.count("*").alias("n")).toPandas()
    between = np.sqrt(np.maximum(((centres[:, None] - centres[None]) ** 2).sum(2), 0))
    slack = 1e-6 * (1 + np.sqrt(norm2))
    far, count = dict(zip(reach.q_cell, reach.far)), dict(zip(reach.q_cell, reach.n))
    need = needs(close, far, between, k, slack)
    # Query cells that lie close form groups of about `block` queries, larger ones are cut.
    left, groups = set(far), []
    while left:
        first = min(left, key=lambda i: between[0, i])
        group, size = [], 0
        for i in sorted(left, key=lambda i: between[first, i]):
            if not group or size + count[i] <= block:
                group.append(i)
                size += count[i]
        left -= set(group)
        groups.append((group, -(-size // block)))
    wanted = spark.createDataFrame(
        [(g, b, j, float(min(need[i][j] for i in group))) for g, (group, blocks) in enumerate(groups) for b in range(blocks) for j in range(len(centres))],
        "grp int, block int, cell bigint, need double",
    )
    owner = spark.createDataFrame([(g, int(i), blocks) for g, (group, blocks) in enumerate(groups) for i in group], "grp int, q_cell bigint, blocks int")
    slices = -(-n // slice_rows)
    asked = (
        placed.where("query")
        .join(owner, "q_cell")
        .select("grp", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("part"), "row", "vec_id", "v")
    )
    offered = (
        placed.join(wanted, "cell")
        .where("away >= need")
        .select("grp", "block", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int").alias("part"), F.col("vec_id").alias("vec_id"), F.col("v").alias("v"))
    )

    def solve(asked: pa.Table, offered: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if asked.num_rows and offered.num_rows:
            offered = offered.sort_by([("vec_id", "ascending")])  # nulls last
            ids, own = offered.column("vec_id").to_pylist(), asked.column("vec_id").to_pylist()
            x, q, row = matrix(offered.column("v")), matrix(asked.column("v")), asked.column("row").to_pylist()
            known = offered.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            plain = offered.column("vec_id").fill_null(0).to_numpy()
            for begin in range(0, len(q), 128):
                table = scores(q[begin : begin + 128], x)
                for i, line in enumerate(table, begin):
                    other = ~known | (plain != own[i])
                    free = np.nonzero(other)[0]
                    line = line[free]
                    if len(free) > k:
                        least = np.partition(line, len(line) - k)[len(line) - k]
                        keep = np.nonzero(line >= least)[0]
                        keep = keep[np.argsort(-line[keep], kind="stable")[:k]]
                    else:
                        keep = np.arange(len(free))
                    found += [(row[i], own[i], ids[free[j]], int(line[j])) for j in keep]
        columns = zip(*found) if found else ([], [], [], [])
        schema = pa.schema([("query", pa.int64()), ("query_id", asked.schema.field("vec_id").type), ("vec_id", asked.schema.field("vec_id").type), ("score", pa.int64())])
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    keys = ("grp", "block", "part")
    best = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(lambda a, b: solve(a, b), result)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
