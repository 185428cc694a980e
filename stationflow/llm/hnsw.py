"""A hierarchical navigable small-world graph over unit vectors, in flat arrays.

Nodes are numbered by falling level, so that every layer consists of the first
nodes and is one array ``nodes x links`` of neighbour numbers, -1 where there is
none. A layer is built from the top down: its nodes enter in batches, each batch
searched at once in the graph so far and among itself. Nearness is the inner
product of unit vectors.
"""

from __future__ import annotations

import numpy as np

#: Nodes or queries that are searched together, and nodes that each expands per step.
BATCH, EXPANDED = 256, 4


def levels(n: int, links: int, seed: int) -> np.ndarray:
    """Levels of ``n`` nodes, falling: each is reached by one in ``links`` nodes of the one below."""
    drawn = np.random.default_rng(seed).random(n)
    return np.sort((-np.log1p(-drawn) / np.log(links)).astype(np.int32))[::-1]


def _near(points: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Nearness of every query to its own row of ``ids``; -inf where an id is missing."""
    found = np.matmul(points[ids], queries[:, :, None])[:, :, 0]
    return np.where(ids >= 0, found, -np.inf)


def beam(points: np.ndarray, layer: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest nodes that a best-first search of one layer reaches, nearest first.

    ``entries`` has a row of distinct start nodes per query. Ends for a query when
    none of its ``width`` best is left to be expanded.
    """
    n, rows = len(queries), np.arange(len(queries))[:, None]
    ids = np.full((n, max(width, entries.shape[1])), -1, np.int64)
    ids[:, : entries.shape[1]] = entries
    near = _near(points, queries, ids)
    done = ids < 0
    seen = np.zeros((n, len(layer)), bool)
    for column in entries.T:
        seen[rows[:, 0], column] = True
    while True:
        rank = np.where(done, -np.inf, near)
        best = np.argpartition(-rank, min(EXPANDED, rank.shape[1]) - 1, axis=1)[:, :EXPANDED]
        open_ = np.take_along_axis(rank, best, 1) > -np.inf
        active = open_.any(1).nonzero()[0]
        if not len(active):
            break
        np.put_along_axis(done, best, True, 1)
        from_ = np.where(open_, np.take_along_axis(ids, best, 1), -1)[active]
        found = np.where(from_[:, :, None] >= 0, layer[from_], -1).reshape(len(active), -1)
        found[seen[active[:, None], found]] = -1
        found.sort(1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        at, column = (found >= 0).nonzero()
        seen[active[at], found[at, column]] = True
        ids_ = np.concatenate([ids[active], found], 1)
        near_ = np.concatenate([near[active], _near(points, queries[active], found)], 1)
        done_ = np.concatenate([done[active], found < 0], 1)
        kept = np.argpartition(-near_, ids.shape[1] - 1, axis=1)[:, : ids.shape[1]]
        ids[active], near[active], done[active] = (np.take_along_axis(a, kept, 1) for a in (ids_, near_, done_))
    order = np.argsort(-near, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def _spread(points: np.ndarray, ids: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Up to ``links`` of every row's candidates: those nearer to the row's node than to any taken one, then the nearest others."""
    order = np.argsort(-near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    known = ids >= 0
    known[:, 1:] &= ids[:, 1:] != ids[:, :-1]
    vectors = points[ids]
    between = np.matmul(vectors, vectors.transpose(0, 2, 1))
    shadow = np.full(near.shape, -np.inf, np.float32)
    taken = np.zeros(ids.shape, bool)
    count = np.zeros(len(ids), np.int64)
    for j in range(ids.shape[1]):
        free = known[:, j] & (near[:, j] > shadow[:, j]) & (count < links)
        taken[:, j] = free
        count += free
        np.maximum(shadow, np.where(free[:, None], between[:, j], -np.inf), out=shadow)
    # Diverse ones first, then the nearest of the rest.
    place = np.where(taken, 0, np.where(known, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
    first = np.argsort(place, axis=1)[:, :links]
    out = np.full((len(ids), links), -1, np.int32)
    out[:, : first.shape[1]] = np.where(np.take_along_axis(known, first, 1), np.take_along_axis(ids, first, 1), -1)
    return out


def _link_back(points: np.ndarray, layer: np.ndarray, new: np.ndarray) -> None:
    """Every neighbour of a new node links back to it; full lists keep their spread ones."""
    links = layer.shape[1]
    at, column = (layer[new] >= 0).nonzero()
    source, target = new[at], layer[new][at, column].astype(np.int64)
    near = np.einsum("ij,ij->i", points[source], points[target])
    order = np.lexsort((-near, target))
    source, target, near = source[order], target[order], near[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    keep = place < links  # more than a list can hold cannot enter it
    source, target, place = source[keep], target[keep], place[keep]
    owners = np.unique(target)
    added = np.full((len(owners), links), -1, np.int64)
    added[np.searchsorted(owners, target), place] = source
    for begin in range(0, len(owners), BATCH):
        some = owners[begin : begin + BATCH]
        ids = np.concatenate([layer[some].astype(np.int64), added[begin : begin + BATCH]], 1)
        ids.sort(1)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        layer[some] = _spread(points, ids, _near(points, points[some], ids), links)


def entries(points: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, width: int = 1) -> np.ndarray:
    """Start nodes for the layer below ``layers`` (top first), one per query."""
    start = np.zeros((len(queries), 1), np.int64)
    for layer in layers:
        start = beam(points, layer, queries, start, width)[0][:, :1]
    return start


def build(points: np.ndarray, links: int = 16, width: int = 64, seed: int = 0) -> list[np.ndarray]:
    """Layers, top first, of unit ``points`` in any order; the lowest has twice the links."""
    level = levels(len(points), links, seed)
    layers: list[np.ndarray] = []
    for height in range(int(level[0]) if len(level) else -1, -1, -1):
        n = int((level >= height).sum())
        layer = np.full((n, links * 2 if height == 0 else links), -1, np.int32)
        for begin in range(0, n, BATCH):
            new = np.arange(begin, min(begin + BATCH, n))
            own = points[new] @ points[new].T
            np.fill_diagonal(own, -np.inf)
            peers = np.argsort(-own, axis=1, kind="stable")[:, : min(width, len(new))]
            ids, near = new[peers], np.take_along_axis(own, peers, 1)
            if begin:
                start = entries(points, layers, points[new])
                # Nodes of the layer above that are not in this one yet are no way in.
                found = beam(points, layer[:begin], points[new], np.where(start < begin, start, 0), width)
                ids, near = np.concatenate([found[0], ids], 1), np.concatenate([found[1], near], 1)
            ids = np.where(near > -np.inf, ids, -1)
            layer[new] = _spread(points, ids, near, layer.shape[1])
            _link_back(points, layer, new)
        layers.append(layer)
    return layers


def search(points: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, k: int, width: int = 96) -> np.ndarray:
    """Up to ``k`` near nodes per query, nearest first, -1 where there are fewer."""
    out = np.full((len(queries), k), -1, np.int64)
    for begin in range(0, len(queries), BATCH):
        some = queries[begin : begin + BATCH]
        ids, _ = beam(points, layers[-1], some, entries(points, layers[:-1], some), max(width, k))
        out[begin : begin + BATCH, : min(k, ids.shape[1])] = ids[:, :k]
    return out
