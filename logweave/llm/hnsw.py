"""Navigable small-world graph over unit vectors in two levels, in numpy, many rows at a time.

The nodes drawn for the upper level are compared with a query exactly, in one product;
the best of them are where the walk over the links of all nodes begins.  Nodes are
inserted in batches that double up to ``BATCH``; a batch searches the graph so far and
compares its own rows exactly.  Neighbours are chosen by the diversity rule (a candidate
counts if it is closer to the node than to every neighbour chosen before), then filled up
with the nearest ones, so that tight groups keep links to the outside.

Work tables are bounded: whatever the shard, the groups in it and the dimension, a step
takes pieces of its rows that keep each table to some megabytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

M = 12
M0 = 24
BATCH = 256
BUILD_BEAM = 48
#: Nodes of the upper level where a walk begins.
ENTRIES = 8
#: Guaranteed links into every node, and the most that a node holds for others.
WAYS, ROOM = 6, 24
#: Floats gathered at once, bytes of the table of seen nodes, and beam places of all rows that are searched together.
GATHER, SEEN, PLACES = 2 << 20, 16 << 20, 1 << 18


def _upper(n: int, seed: int) -> np.ndarray:
    """Sorted nodes of the upper level, one in ``M``; the first node is always there."""
    up = np.random.default_rng(seed).random(n) * M < 1
    up[:1] = True
    return np.flatnonzero(up)


def _choose(x: np.ndarray, cand: np.ndarray, sim: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` neighbours of each row from its candidates (sorted by falling similarity, -1 empty)."""
    q, c = cand.shape
    step = max(1, GATHER // (c * max(c, x.shape[1])))
    if q > step:
        return np.concatenate([_choose(x, cand[i:i + step], sim[i:i + step], m) for i in range(0, q, step)])
    v = x[np.maximum(cand, 0)]
    among = np.matmul(v, v.transpose(0, 2, 1))
    valid = cand >= 0
    taken = np.zeros((q, c), dtype=bool)
    block = np.full((q, c), -np.inf, dtype=np.float32)  # highest similarity to a chosen neighbour
    count = np.zeros(q, dtype=int)
    for j in range(c):
        ok = valid[:, j] & (sim[:, j] > block[:, j]) & (count < m)
        taken[ok, j] = True
        count += ok
        block[ok] = np.maximum(block[ok], among[ok, j])
    rank = np.where(taken, 0, np.where(valid, 1, 2)) * (c + 1) + np.arange(c)
    order = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.take_along_axis(cand, order, axis=1)
    if out.shape[1] < m:
        out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
    return out


def _dots(x: np.ndarray, q: np.ndarray, r: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Similarity of query row r[i] and node[i]."""
    step = max(1, GATHER // x.shape[1])
    if len(r) <= step:
        return np.einsum("kd,kd->k", q[r], x[node])
    return np.concatenate([np.einsum("kd,kd->k", q[r[i:i + step]], x[node[i:i + step]]) for i in range(0, len(r), step)])


def _entries(x: np.ndarray, upper: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The nodes of the upper level nearest to each query row."""
    k = min(ENTRIES, len(upper))
    s = q @ x[upper].T
    return upper[np.argpartition(s, len(upper) - k, axis=1)[:, len(upper) - k:]]


def beam_search(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``beam`` nodes of each query row: (ids, similarities), falling, -1 empty."""
    n, rows = len(x), len(q)
    ids = np.full((rows, beam), -1, dtype=np.int64)
    sims = np.full((rows, beam), -np.inf, dtype=np.float32)
    w = min(beam, start.shape[1])
    s = np.einsum("qd,qed->qe", q, x[start])
    order = np.argsort(-s, axis=1)[:, :w]
    ids[:, :w] = np.take_along_axis(start, order, axis=1)
    sims[:, :w] = np.take_along_axis(s, order, axis=1)
    # One more column, always set: the empty link -1 of a row is the last column of the row before (of the last row for the first).
    seen = np.zeros((rows, n + 1), dtype=bool)
    seen[:, n] = True
    seen[np.arange(rows)[:, None], start] = True
    flat = seen.reshape(-1)
    done = np.zeros((rows, beam), dtype=bool)
    active = np.arange(rows)
    while len(active):
        open_ = (ids[active] >= 0) & ~done[active]
        has = open_.any(axis=1)
        active, open_ = active[has], open_[has]
        if not len(active):
            break
        # The best open nodes are expanded together: one for a small beam, more for a widened one.
        rank = np.cumsum(open_, axis=1)
        width = max(1, beam // 16)
        er, ec = np.nonzero(open_ & (rank <= width))
        done[active[er], ec] = True
        slot, expand = rank[er, ec] - 1, ids[active[er], ec]
        r, node = [], []
        for j in range(int(slot.max()) + 1):  # one node of each row at a time: no new node twice
            of = slot == j
            nb = links[expand[of]]
            at = nb + (active[er[of]] * (n + 1))[:, None]
            new = np.flatnonzero(~flat[at])
            flat[at.ravel()[new]] = True
            r.append(er[of][new // nb.shape[1]])
            node.append(nb.ravel()[new])
        r, node = np.concatenate(r), np.concatenate(node).astype(np.int64)
        found = _dots(x, q, active[r], node)
        better = found > sims[active[r], -1]
        r, node, found = r[better], node[better], found[better]
        if not len(r):
            continue
        # One compact block of new nodes per row.
        o = np.argsort(r, kind="stable")
        r, node, found = r[o], node[o], found[o]
        got, r, count = np.unique(r, return_inverse=True, return_counts=True)
        c = np.arange(len(r)) - np.repeat(np.cumsum(count) - count, count)
        got = active[got]
        fresh = np.full((len(got), int(count.max())), -1, dtype=np.int64)
        fresh[r, c] = node
        s = np.full(fresh.shape, -np.inf, dtype=np.float32)
        s[r, c] = found
        all_s = np.concatenate([sims[got], s], axis=1)
        all_i = np.concatenate([ids[got], fresh], axis=1)
        all_d = np.concatenate([done[got], np.zeros(s.shape, dtype=bool)], axis=1)
        order = np.argsort(-all_s, axis=1, kind="stable")[:, :beam]
        sims[got] = np.take_along_axis(all_s, order, axis=1)
        ids[got] = np.take_along_axis(all_i, order, axis=1)
        done[got] = np.take_along_axis(all_d, order, axis=1)
    return ids, sims


class Graph:
    """``links`` holds the neighbours of all nodes (-1 empty), ``upper`` the nodes of the upper level."""

    def __init__(self, x: np.ndarray, links: np.ndarray, upper: np.ndarray):
        self.x, self.links, self.upper = x, links, upper

    def found(self, q: np.ndarray, beam: int, floor: float | None = None, chunk: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query rows, nodes) of the results, piece by piece; with ``floor`` only those at or above it.

        With ``floor`` the rows whose beam lies at or above it as a whole are searched again with twice the beam, fewer
        at once where it is large, so every node found there is kept however many they are.
        """
        n = len(self.x)
        todo = [(np.arange(len(q)), beam)]
        while todo:
            which, beam = todo.pop()
            step = max(1, min(chunk, max(16, SEEN // max(n, 1)), PLACES // beam))
            crowded = []
            for a in range(0, len(which), step):
                rows = which[a:a + step]
                part = q[rows]
                ids, sims = beam_search(self.x, self.links, part, _entries(self.x, self.upper, part), beam)
                ok = ids >= 0
                if floor is not None:
                    ok &= sims >= floor
                    full = ok[:, -1] & (beam < n)
                    ok[full] = False
                    crowded.append(rows[full])
                r, c = np.nonzero(ok)
                yield rows[r], ids[r, c]
            crowded = np.concatenate(crowded) if crowded else which[:0]
            if len(crowded):
                todo.append((crowded, min(2 * beam, n)))

    def search(self, q: np.ndarray, beam: int, floor: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(query row, node) pairs of all results."""
        rows, nodes = zip(*self.found(q, beam, floor), strict=True)
        return np.concatenate(rows), np.concatenate(nodes)


def build(x: np.ndarray, seed: int = 1) -> Graph:
    n = len(x)
    upper = _upper(n, seed)
    links = np.full((n, M0), -1, dtype=np.int32)
    at = 1
    while at < n:
        new = np.arange(at, min(n, at + min(BATCH, at)))
        q = x[new]
        inside = q @ q.T
        np.fill_diagonal(inside, -np.inf)
        ids, sims = beam_search(x[:at], links[:at], q, _entries(x, upper[:np.searchsorted(upper, at)], q), BUILD_BEAM)
        top = np.argsort(-inside, axis=1)[:, :min(M0, len(new))]
        ms = np.take_along_axis(inside, top, axis=1)
        ci = np.concatenate([ids, np.where(np.isfinite(ms), new[top], -1)], axis=1)
        cs = np.concatenate([sims, ms], axis=1).astype(np.float32)
        order = np.argsort(-cs, axis=1, kind="stable")
        ci, cs = np.take_along_axis(ci, order, axis=1), np.take_along_axis(cs, order, axis=1)
        links[new] = _choose(x, ci, cs, M0)
        _back(x, links, new, M0)
        at = new[-1] + 1
    links = np.concatenate([links, _ways_in(links)], axis=1)
    links = np.sort(links, axis=1)[:, ::-1].copy()
    links[:, 1:][links[:, 1:] == links[:, :-1]] = -1  # a search marks the links of a node at once: each is there once
    return Graph(x, links, upper)


def _ways_in(links: np.ndarray, need: int = WAYS, room: int = ROOM) -> np.ndarray:
    """Extra links y -> x for y among the neighbours of x, ``need`` per node, ``room`` per holder.

    In tight groups nearest-neighbour lists point at a few hubs and some nodes are in no
    list at all; with these links every node can be reached from its own neighbours.
    """
    n = len(links)
    out = np.full((n, room), -1, dtype=np.int32)
    load, have = np.zeros(n, dtype=int), np.zeros(n, dtype=int)
    for j in range(links.shape[1]):
        # Each node asks another of its neighbours; a different column per node spreads the load.
        ask = links[np.arange(n), (np.arange(n) * 7 + j) % links.shape[1]].astype(np.int64)
        who = np.flatnonzero((ask >= 0) & (have < need))
        who = who[np.argsort(ask[who], kind="stable")]
        to = ask[who]
        start = np.searchsorted(to, to)
        slot = load[to] + np.arange(len(to)) - start
        ok = slot < room
        out[to[ok], slot[ok]] = who[ok]
        np.add.at(load, to[ok], 1)
        have[who[ok]] += 1
    return out


def _back(x: np.ndarray, links: np.ndarray, new: np.ndarray, m: int) -> None:
    """Adds the reverse of the links of ``new``; a full node chooses again among old and new neighbours."""
    src = np.repeat(new, links.shape[1])
    dst = links[new].ravel().astype(np.int64)
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    node, first, count = np.unique(dst, return_index=True, return_counts=True)
    width = int(count.max(initial=0))
    if not width:
        return
    extra = np.full((len(node), width), -1, dtype=np.int64)
    extra[np.repeat(np.arange(len(node)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
    cand = np.concatenate([links[node], extra], axis=1)
    # A pair that already links both ways is kept once.
    cand = np.sort(cand, axis=1)[:, ::-1]
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
    step = max(1, min(1024, GATHER // (cand.shape[1] * x.shape[1])))
    for a in range(0, len(node), step):
        z = slice(a, a + step)
        s = np.matmul(x[np.maximum(cand[z], 0)], x[node[z]][:, :, None])[:, :, 0]
        s = np.where(cand[z] >= 0, s, -np.inf).astype(np.float32)
        o = np.argsort(-s, axis=1, kind="stable")[:, :96]
        links[node[z]] = _choose(x, np.take_along_axis(cand[z], o, axis=1), np.take_along_axis(s, o, axis=1), m)
