"""A hierarchical navigable small world as flat numpy arrays.

Nodes are numbered by falling level, so that the nodes of level l and above are the first
ones; neighbours of level l are one array with a row per such node, -1 where it has fewer.
All vectors have the same norm (`same_norm`), so that a larger inner product is a smaller
distance. Many nodes are inserted, and many queries searched, by each numpy call: a batch
of new nodes searches the graph as it was, is compared within itself, and is then linked
both ways, links being chosen so that they point in different directions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LINKS = 16  # of a node at upper levels; twice as many at the lowest
CHUNK = 256  # queries searched at once
FIRST = 1_024  # nodes that a level begins with, compared with each other
BATCH = 2_048  # nodes inserted at once, and at most as many as there are


def same_norm(x: np.ndarray) -> np.ndarray:
    """Vectors scaled into the unit ball by their largest norm, with one entry more that brings
    all norms to 1: for a query with 0 there, the order of inner products stays."""
    x = x.astype(np.float64)
    x = x / max(float(np.abs(x).max(initial=0.0)), np.finfo(float).tiny)
    square = (x * x).sum(axis=1)
    most = max(float(square.max(initial=0.0)), np.finfo(float).tiny)
    rest = np.sqrt(np.maximum(1 - square / most, 0))
    return np.column_stack([x / np.sqrt(most), rest]).astype(np.float32)


def as_queries(q: np.ndarray) -> np.ndarray:
    q = q.astype(np.float64)
    q = q / np.maximum(np.abs(q).max(axis=1, keepdims=True, initial=0.0), np.finfo(float).tiny)
    q = q / np.sqrt(np.maximum((q * q).sum(axis=1, keepdims=True), np.finfo(float).tiny))
    return np.column_stack([q, np.zeros(len(q))]).astype(np.float32)


def levels(u: np.ndarray) -> np.ndarray:
    """Levels of nodes by numbers in (0, 1]: each has 1 in LINKS of the nodes below it."""
    return np.minimum(-np.log(np.maximum(u, 1e-12)) / np.log(LINKS), 15).astype(np.int64)


@dataclass
class Graph:
    x: np.ndarray
    links: list[np.ndarray]  # by level, the lowest first

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, inner products) of the `width` best found for each query, best first; -1 pads."""
        ids, sims = np.full((len(q), width), -1, np.int32), np.full((len(q), width), -np.inf, np.float32)
        for a in range(0, len(q), CHUNK):
            own = q[a : a + CHUNK]
            found = self.beam(own, 0, self.enter(own, 0), width)
            ids[a : a + CHUNK], sims[a : a + CHUNK] = found
        return ids, sims

    def enter(self, q: np.ndarray, level: int, width: int = 8) -> np.ndarray:
        """Nodes to start from at a level: the best of the levels above, from the top down."""
        at = np.zeros((len(q), 1), np.int32)
        for above in range(len(self.links) - 1, level, -1):
            at = self.beam(q, above, at, width)[0]
        return at

    def beam(self, q: np.ndarray, level: int, start: np.ndarray, width: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries at once: in each round a query's `step` best nodes
        that weren't expanded yet are, until its `width` best all are."""
        links = self.links[level]
        ids = np.full((len(q), width), -1, np.int32)
        sims = np.full((len(q), width), -np.inf, np.float32)
        done = np.zeros((len(q), width), bool)
        seen = np.zeros((len(q), len(links)), bool)
        rows = np.arange(len(q))
        fresh = start
        while len(rows):
            new_ids, new_sims = self._look(q, rows, fresh, seen)
            all_ids = np.concatenate([ids[rows], new_ids], axis=1)
            all_sims = np.concatenate([sims[rows], new_sims], axis=1)
            all_done = np.concatenate([done[rows], np.zeros(new_ids.shape, bool)], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[rows], sims[rows] = np.take_along_axis(all_ids, best, 1), np.take_along_axis(all_sims, best, 1)
            done[rows] = np.take_along_axis(all_done, best, 1)
            open_ = (ids[rows] >= 0) & ~done[rows]
            rows, open_ = rows[open_.any(axis=1)], open_[open_.any(axis=1)]
            if not len(rows):
                break
            take = open_ & (np.cumsum(open_, axis=1) <= step)
            done[rows] |= take
            first = np.argsort(~take, axis=1, kind="stable")[:, :step]
            chosen = np.where(np.take_along_axis(take, first, 1), np.take_along_axis(ids[rows], first, 1), -1)
            fresh = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(rows), -1)
        return ids, sims

    def _look(self, q: np.ndarray, rows: np.ndarray, fresh: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of fresh that a query hasn't seen, each once, with their inner products."""
        fresh = np.sort(fresh, axis=1)
        ok = fresh >= 0
        ok[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
        r, c = np.nonzero(ok)
        node = fresh[r, c]
        new = ~seen[rows[r], node]
        r, c, node = r[new], c[new], node[new]
        seen[rows[r], node] = True
        place = np.arange(len(r)) - np.searchsorted(r, r)  # r rises
        wide = int(place.max(initial=-1)) + 1
        ids, sims = np.full((len(rows), wide), -1, np.int32), np.full((len(rows), wide), -np.inf, np.float32)
        ids[r, place] = node
        sims[r, place] = np.einsum("ij,ij->i", self.x[node], q[rows[r]])
        return ids, sims


def choose(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` links out of candidates sorted by falling similarity: first those that are
    nearer to the node than to any one chosen before, then the nearest of the others."""
    n, width = ids.shape
    out = np.full((n, most), -1, np.int32)
    for a in range(0, n, CHUNK):
        own, near = ids[a : a + CHUNK], sims[a : a + CHUNK]
        vectors = x[own]
        between = vectors @ vectors.transpose(0, 2, 1)
        ruled = np.full(own.shape, -np.inf, np.float32)  # similarity to the chosen one that is nearest
        kept = np.zeros(own.shape, bool)
        for j in range(width):
            keep = (own[:, j] >= 0) & (ruled[:, j] < near[:, j]) & (kept.sum(axis=1) < most)
            kept[:, j] = keep
            ruled = np.where(keep[:, None], np.maximum(ruled, between[:, :, j]), ruled)
        rank = np.argsort(np.where(own < 0, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :most]
        out[a : a + CHUNK, : rank.shape[1]] = np.take_along_axis(own, rank, 1)
    return out


def _sorted(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    best = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)


def _among(x: np.ndarray, a: int, b: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each of the nodes a to b with its nearest others among them, some rows at a time."""
    width = min(width, b - a - 1)
    ids, sims = np.full((b - a, max(width, 0)), -1, np.int32), np.full((b - a, max(width, 0)), -np.inf, np.float32)
    if width <= 0:
        return ids, sims
    for k in range(a, b, CHUNK):
        m = min(k + CHUNK, b)
        s = x[k:m] @ x[a:b].T
        s[np.arange(m - k), np.arange(k - a, m - a)] = -np.inf
        part = np.argpartition(-s, width - 1, axis=1)[:, :width]
        ids[k - a : m - a], sims[k - a : m - a] = _sorted((part + a).astype(np.int32), np.take_along_axis(s, part, 1), width)
    return ids, sims


def _link_back(x: np.ndarray, links: np.ndarray, new: np.ndarray, most: int) -> None:
    """Links to the new nodes from those that they chose; where there are too many, the best directions."""
    r, c = np.nonzero(links[new] >= 0)
    target, source = links[new][r, c], new[r]
    order = np.lexsort((-np.einsum("ij,ij->i", x[target], x[source]), target))
    target, source = target[order], source[order]
    nodes, first = np.unique(target, return_index=True)
    place = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
    near = place < most  # the nearest of very many
    ids = np.full((len(nodes), most), -1, np.int32)
    ids[np.searchsorted(nodes, target[near]), place[near]] = source[near]
    had = links[nodes]
    ids = np.where((ids[:, :, None] == had[:, None, :]).any(axis=2), -1, ids)  # linked already
    both = np.concatenate([had, ids], axis=1)
    for k in range(0, len(nodes), CHUNK):
        own = both[k : k + CHUNK]
        sims = np.where(own >= 0, np.einsum("ijk,ik->ij", x[own], x[nodes[k : k + CHUNK]]), -np.inf).astype(np.float32)
        links[nodes[k : k + CHUNK]] = choose(x, *_sorted(own, sims, own.shape[1]), most)


def build(x: np.ndarray, level: np.ndarray, width: int = 64) -> Graph:
    """The graph of vectors of one norm, in the order of falling levels. width: of the search
    for a new node's neighbours."""
    top = int(level[0]) if len(level) else 0
    graph = Graph(x, [np.zeros((0, LINKS), np.int32)] * (top + 1))
    for at in range(top, -1, -1):
        n = int((level >= at).sum())
        most = LINKS if at else 2 * LINKS
        links = graph.links[at] = np.full((n, most), -1, np.int32)
        have = min(n, max(FIRST, int((level > at).sum())))
        links[:have] = choose(x, *_among(x, 0, have, width), most)
        _link_back(x, links, np.arange(have), most)
        while have < n:
            end = min(n, have + min(BATCH, have))
            new = np.arange(have, end)
            inner = _among(x, have, end, width)
            for a in range(0, len(new), CHUNK):
                q = x[new[a : a + CHUNK]]
                graph.links[at] = links[:have]
                found = graph.beam(q, at, graph.enter(q, at), width)
                both = [np.concatenate([f, i[a : a + CHUNK]], axis=1) for f, i in zip(found, inner, strict=True)]
                links[new[a : a + CHUNK]] = choose(x, *_sorted(*both, width), most)
            _link_back(x, links, new, most)
            graph.links[at] = links
            have = end
    return graph
