"""Approximate nearest neighbours by cosine: one navigable small-world graph per shard.

Equal vectors are one node first, so that copies neither fill a graph with links
of length zero nor a shard. Nodes are dealt to shards by hash; the number of
shards grows with the square root of the number of nodes, and further where a
shard would take more than ``SHARD_BYTES``. The index is a table of chunks: flat
arrays of neighbour numbers by layer, and of the vectors they stand for. A query
is searched in every shard, shards and blocks of queries being the tasks; what
the shards find is scored exactly and merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm import hnsw
from stationflow.llm.common import stored

#: Bytes of a shard's vectors in double precision, queries of a block, nodes of a chunk of the index.
SHARD_BYTES, BLOCK, CHUNK = 64_000_000, 16_384, 1024
#: Shards of a table of n vectors are at least sqrt(n) / ROOT.
ROOT = 32
VECTORS = -1
INDEX = "shard int, layer int, begin int, nodes array<bigint>, vectors array<double>, neighbours array<int>"


@dataclass(frozen=True)
class Index:
    """``nodes``: ``node, v, ids`` of every distinct vector; ``graph``: the chunks of all shards."""

    nodes: DataFrame
    graph: DataFrame
    shards: int
    width: int
    links: int


def directions(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors in double precision that have a direction, without nulls, NaN or infinities."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    return vectors.select("vec_id", v.alias("v")).where(F.col("v").isNotNull() & sound)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows by a power of two each, so that squares neither vanish nor overflow; their cosines stay the same bits."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0))[1][:, None])


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return (x / norms(x)[:, None]).astype(np.float32)


def padded(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of doubles; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def build_index(vectors: DataFrame, copies: int = 6, links: int = 16, build_width: int = 64) -> Index:
    """Index over every row of ``vec_id, embedding``.

    Of equal vectors, the ``copies`` smallest ids are kept with their node: a
    search for ``k`` needs ``k + 1``. A shorter vector counts as padded with
    zeros; a null id comes last.
    """
    rows = directions(vectors).withColumn("h", F.xxhash64("v"))
    place = F.row_number().over(Window.partitionBy("h", "v").orderBy(F.asc_nulls_last("vec_id")))
    first = rows.withColumn("place", place).where(F.col("place") <= copies)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("place", "vec_id"))), lambda m: m["vec_id"])
    nodes = stored(first.groupBy("h", "v").agg(ids.alias("ids")).select(F.monotonically_increasing_id().alias("node"), "v", "ids"), "ann-nodes")
    n, width = nodes.agg(F.count("*"), F.max(F.size("v"))).first()
    width = width or 0
    shards = max(1, int(np.ceil(np.sqrt(n) / ROOT)), -(-n * width * 8 // SHARD_BYTES))

    def build(group: pa.Table) -> Iterator[pa.RecordBatch]:
        shard = group.column("shard")[0].as_py()
        group = group.sort_by("node")
        mixed = np.random.default_rng(shard).permutation(group.num_rows)
        x = padded(group.column("v"), width)[mixed]
        ids = group.column("node").to_numpy()[mixed]
        schema = pa.schema(
            [("shard", pa.int32()), ("layer", pa.int32()), ("begin", pa.int32()), ("nodes", pa.list_(pa.int64())), ("vectors", pa.list_(pa.float64())), ("neighbours", pa.list_(pa.int32()))]
        )
        layers = hnsw.build(units(x), links, build_width, shard)
        for begin in range(0, len(x), CHUNK):
            part = slice(begin, begin + CHUNK)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "layer": VECTORS, "begin": begin, "nodes": ids[part], "vectors": x[part].ravel()}], schema)
        for height, layer in enumerate(reversed(layers)):
            for begin in range(0, len(layer), CHUNK):
                flat = layer[begin : begin + CHUNK].ravel()
                yield pa.RecordBatch.from_pylist([{"shard": shard, "layer": height, "begin": begin, "neighbours": flat}], schema)

    def build_table(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(build(group)))

    dealt = nodes.select(F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"), "node", "v")
    graph = stored(dealt.groupBy("shard").applyInArrow(build_table, INDEX), "ann-graph")
    return Index(nodes, graph, shards, width, links)


def opened(chunks: pa.Table, width: int, links: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Nodes, vectors and layers, top first, from the chunks of one shard."""
    chunks = chunks.sort_by([("layer", "descending"), ("begin", "ascending")])
    height = chunks.column("layer").to_numpy()

    def joined(name: str, at: int) -> np.ndarray:
        return chunks.filter(pa.array(height == at)).column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)

    layers = [joined("neighbours", h).reshape(-1, links if h else 2 * links) for h in range(int(height.max()), VECTORS, -1)]
    return joined("nodes", VECTORS), joined("vectors", VECTORS).reshape(-1, width), layers


def search(index: Index, queries: DataFrame, k: int = 5, search_width: int = 96) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found for every row of ``queries``.

    ``score`` is the cosine of the original vectors in double precision; ties go to
    the smaller id. Rows of the query's own id take no part. Queries need
    ``vec_id, embedding``; those without direction get no row.
    """
    kind = queries.schema["vec_id"].dataType.simpleString()
    asked = stored(directions(queries).select(F.monotonically_increasing_id().alias("query"), "vec_id", "v"), "ann-queries")
    n, widest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    width, links, longest = index.width, index.links, max(widest or 0, index.width)
    blocks = max(1, -(-n // BLOCK))
    per_shard = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))).alias("shard"), F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block"), "query", "v"
    )
    per_block = index.graph.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def solve(asked: pa.Table, chunks: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])
        if not asked.num_rows or not chunks.num_rows:
            return schema.empty_table()
        nodes, x, layers = opened(chunks, width, links)
        # Components that no indexed vector has only lengthen the query.
        whole = scaled(padded(asked.column("v"), longest))
        q, x = whole[:, :width], scaled(x)
        lengths, length = norms(whole), norms(x)
        near = hnsw.search((x / length[:, None]).astype(np.float32), layers, (q / lengths[:, None]).astype(np.float32), search_width, search_width)
        at, column = (near >= 0).nonzero()
        node = near[at, column]
        score = np.einsum("ij,ij->i", q[at], x[node]) / (lengths[at] * length[node])
        # The k + 1 best, one of which may be the query itself, and all that tie with the last of them.
        order = np.lexsort((-score, at))
        at, node, score = at[order], node[order], score[order]
        begin = np.searchsorted(at, np.arange(len(q)))
        end = np.searchsorted(at, np.arange(len(q)), "right")
        bound = np.full(len(q), -np.inf)
        full = end - begin > k
        bound[full] = score[begin[full] + k]
        keep = score >= bound[at]
        return pa.table([asked.column("query").to_numpy()[at[keep]], nodes[node[keep]], score[keep]], schema=schema)

    keys = ("shard", "block")
    found = per_shard.groupBy(*keys).cogroup(per_block.groupBy(*keys)).applyInArrow(solve, "query bigint, node bigint, score double")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"))
    nearest = found.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= k + 1)
    own = asked.select("query", F.col("vec_id").alias("query_id"))
    rows = nearest.join(index.nodes.select("node", F.explode("ids").alias("vec_id")), "node").join(own, "query")
    others = rows.where(F.col("vec_id").isNull() | F.col("query_id").isNull() | (F.col("vec_id") != F.col("query_id")))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = others.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query_id").cast(kind).alias("query_id"), "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, search_width: int = 96) -> DataFrame:
    """``query_id, rank, vec_id, score``: near rows among all ``vectors`` of those that ``is_query`` marks.

    Every row is indexed. Rows with a null or zero vector, or a null or non-finite
    component, take no part. Repeated rows of one id are all candidates of others
    and each a query of its own. Fewer than ``k`` candidates: all of them; an empty
    table: no row. Other columns play no part.
    """
    return search(build_index(vectors, k + 1), vectors.where(F.coalesce(is_query, F.lit(False))), k, search_width)
