"""Hierarchical navigable small-world graphs over unit vectors, built and searched for many vectors at once."""

from __future__ import annotations

import numpy as np

LINKS, BUILD_BEAM, BATCH = 16, 64, 256
#: Nodes that one step of a search opens for every query.
OPENED = 6
NEVER = np.float32(-2.0)


def most_links(level: int) -> int:
    return LINKS if level else 2 * LINKS


class Graph:
    """Nodes are numbered from the highest level down, so the nodes of a level are the first ones.

    `links[level]` holds up to `most_links(level)` neighbours per node, -1 where there are fewer.
    """

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.links = vectors, links

    def search(self, queries: np.ndarray, beam: int, level: int = 0, entry: np.ndarray | None = None, size: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` nearest nodes that a best-first walk finds, with their similarity, best first (-1: none).

        Walks the levels above from node 0 unless `entry` nodes are given. Only the first `size` nodes exist.
        """
        q, size = len(queries), len(self.vectors) if size is None else size
        if entry is None:
            entry = np.zeros((q, 1), np.int64)
            for above in range(len(self.links) - 1, level, -1):
                entry = self.search(queries, 8, above, entry, size)[0][:, :4]
        seen = np.zeros((q, size + 1), bool)  # one more for "none"
        seen[:, size] = True
        ids, sims = np.full((q, beam), -1), np.full((q, beam), NEVER, np.float32)
        opened = np.zeros((q, beam), bool)
        active, new = np.arange(q), entry
        while True:
            ids[active], sims[active], opened[active] = self._merge(queries[active], new, seen, active, ids[active], sims[active], opened[active], size)
            waiting = (ids >= 0) & ~opened
            active = np.flatnonzero(waiting.any(1))
            if not len(active):
                return ids, sims
            turn = waiting[active] & (np.cumsum(waiting[active], axis=1) <= OPENED)
            opened[active] |= turn
            # the nodes to open, -1 for queries with fewer
            place = np.argsort(~turn, axis=1, kind="stable")[:, :OPENED]
            nodes = np.where(np.take_along_axis(turn, place, 1), np.take_along_axis(ids[active], place, 1), -1)
            near = np.where(nodes[:, :, None] >= 0, self.links[level][nodes], -1)
            new = near.reshape(len(active), -1)

    def _merge(self, queries, new, seen, active, ids, sims, opened, size):
        """Add nodes that were not seen before to the beams and cut them to their width."""
        new = np.sort(np.where((new < 0) | (new >= size), size, new), axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = size
        fresh = ~seen[active[:, None], new]
        width = int(fresh.sum(1).max(initial=0))
        if not width:
            return ids, sims, opened
        place = np.argsort(~fresh, axis=1, kind="stable")[:, :width]
        new = np.where(np.take_along_axis(fresh, place, 1), np.take_along_axis(new, place, 1), size)
        seen[active[:, None], new] = True
        like = np.einsum("qnd,qd->qn", self.vectors[np.minimum(new, size - 1)], queries).astype(np.float32)
        like[new == size] = NEVER
        every = np.concatenate([sims, like], axis=1)
        best = np.argsort(-every, axis=1, kind="stable")[:, : ids.shape[1]]
        ids = np.take_along_axis(np.concatenate([ids, np.where(new == size, -1, new)], axis=1), best, 1)
        opened = np.take_along_axis(np.concatenate([opened, np.zeros(new.shape, bool)], axis=1), best, 1)
        return ids, np.take_along_axis(every, best, 1), opened


def _spread(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates `keep` that lie in different directions, filled up with the nearest others."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    found = vectors[np.maximum(ids, 0)]
    between = np.einsum("qad,qbd->qab", found, found)
    closest = np.full(ids.shape, NEVER, np.float32)  # to any chosen candidate so far
    chosen = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        take = (ids[:, c] >= 0) & (closest[:, c] < sims[:, c]) & (chosen.sum(1) < keep)
        chosen[:, c] = take
        closest = np.where(take[:, None], np.maximum(closest, between[:, c]), closest)
    rank = np.where(ids < 0, 2, np.where(chosen, 0, 1))
    place = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    out = np.full((len(ids), keep), -1, np.int64)
    out[:, : place.shape[1]] = np.take_along_axis(ids, place, 1)
    return out


def _link_back(graph: Graph, level: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Let the chosen neighbours know of the new nodes; full lists are chosen anew."""
    links, width = graph.links[level], most_links(level)
    source = np.repeat(nodes, chosen.shape[1])
    target = chosen.ravel()
    source, target = source[target >= 0], target[target >= 0]
    like = np.einsum("nd,nd->n", graph.vectors[source], graph.vectors[target])
    order = np.lexsort((-like, target))
    source, target = source[order], target[order]
    uniq, first, count = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, count)
    most = min(int(count.max(initial=0)), 2 * width)  # only the nearest newcomers of a crowded node
    coming = np.full((len(uniq), most), -1, np.int64)
    inside = place < most
    coming[np.repeat(np.arange(len(uniq)), count)[inside], place[inside]] = source[inside]
    for start in range(0, len(uniq), 256):
        part = uniq[start : start + 256]
        every = np.concatenate([links[part], coming[start : start + 256]], axis=1)
        sims = np.einsum("qnd,qd->qn", graph.vectors[np.maximum(every, 0)], graph.vectors[part])
        sims[every < 0] = NEVER
        links[part] = _spread(graph.vectors, every, sims, width)


def build(vectors: np.ndarray, draw: np.ndarray) -> tuple[Graph, np.ndarray]:
    """A graph of unit vectors, and the order in which they became its nodes. `draw` in (0, 1) sets the levels."""
    levels = np.minimum((-np.log(draw) / np.log(LINKS)).astype(int), 8)
    order = np.lexsort((draw, -levels))
    vectors, levels = np.ascontiguousarray(vectors[order], np.float32), levels[order]
    n = len(vectors)
    graph = Graph(vectors, [np.full((n, most_links(k)), -1, np.int64) for k in range(int(levels.max(initial=0)) + 1)])
    start = 0
    while start < n:
        stop = min(n, start + max(32, min(BATCH, start)))
        batch, among = np.arange(start, stop), vectors[start:stop] @ vectors[start:stop].T
        entry = np.zeros((len(batch), 1), np.int64)
        for level in range(len(graph.links) - 1, -1, -1):
            here = levels[batch] >= level
            existing = int(np.searchsorted(-levels[:start], -level, "right")) if start else 0
            found, sims = np.full((len(batch), 0), -1), np.full((len(batch), 0), NEVER, np.float32)
            if existing:
                found, sims = graph.search(vectors[batch], 8 if level else BUILD_BEAM, level, entry, existing)
                entry = found[:, :8]
            if not here.any():
                continue
            mates = min(BUILD_BEAM // 2, len(batch))
            like = among.copy()
            np.fill_diagonal(like, NEVER)
            like[:, ~here] = NEVER
            near = np.argsort(-like, axis=1, kind="stable")[:, :mates]
            mate_sims = np.take_along_axis(like, near, 1)
            mate_ids = np.where(mate_sims > NEVER, batch[near], -1)
            ids, every = np.concatenate([found, mate_ids], axis=1)[here], np.concatenate([sims, mate_sims], axis=1)[here]
            chosen = _spread(vectors, ids, every, LINKS)
            graph.links[level][batch[here], : chosen.shape[1]] = chosen
            _link_back(graph, level, batch[here], chosen)
        start = stop
    return graph, order
