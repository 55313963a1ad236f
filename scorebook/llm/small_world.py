"""A hierarchical navigable small-world graph over unit vectors, built and searched in blocks of queries.

All queries of a block take a step together: each opens its best unopened entry, looks at the neighbours it has not
seen and keeps the `beam` best. Nodes are inserted in blocks that at most double the graph; a block is searched in the
graph so far, and its own vectors are candidates for each other. Neighbours are chosen by the usual rule (a candidate
nearer to a chosen neighbour than to the node is left out), in both directions.
"""

from __future__ import annotations

import numpy as np

DEGREE, BUILD_BEAM, BUILD_BLOCK, SEEN_BYTES = 12, 40, 1024, 1 << 25


class SmallWorld:
    """`x` (n, d) float32 unit vectors, `height` the top layer of each; a node is in all layers up to its height.

    Nodes of layer l are rows of `members[l]` (ascending node numbers); `near[l]` holds their neighbours as node numbers."""

    def __init__(self, x: np.ndarray, near: list[np.ndarray], members: list[np.ndarray], entry: int):
        self.x, self.near, self.members, self.entry = x, near, members, entry

    # ---- search -------------------------------------------------------------------------------------------------

    def _row(self, layer: int, nodes: np.ndarray) -> np.ndarray:
        return nodes if layer == 0 else np.searchsorted(self.members[layer], nodes)

    def _descend(self, q: np.ndarray, at: np.ndarray, layer: int) -> np.ndarray:
        """The nearest node that greedy steps reach in a layer."""
        sims = np.einsum("ij,ij->i", self.x[at], q)
        live = np.arange(len(q))
        while len(live):
            nb = self.near[layer][self._row(layer, at[live])]
            s = np.matmul(self.x[nb], q[live][:, :, None])[:, :, 0]
            s[nb < 0] = -2
            best = s.argmax(1)
            rows = np.arange(len(live))
            up = s[rows, best] > sims[live]
            live, rows, best = live[up], rows[up], best[up]
            at[live], sims[live] = nb[rows, best], s[rows, best]
        return at

    def _beam(self, q: np.ndarray, at: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities of the `beam` best that a search from `at` meets, best first (-1 where there are fewer)."""
        near, n = self.near[layer], len(self.members[layer]) if layer else len(self.x)
        b = len(q)
        ids, sims, opened = np.full((b, beam), -1, np.int32), np.full((b, beam), -2, np.float32), np.ones((b, beam), bool)
        seen = np.zeros((b, n), bool)
        rows = np.arange(b)
        ids[:, 0], sims[:, 0], opened[:, 0] = at, np.einsum("ij,ij->i", self.x[at], q), False
        seen[rows, self._row(layer, at)] = True
        live = rows
        while len(live):
            todo = ~opened[live]
            some = todo.any(1)
            live, todo = live[some], todo[some]
            if not len(live):
                break
            j = todo.argmax(1)
            opened[live, j] = True
            nb = near[self._row(layer, ids[live, j])]
            r, c = np.nonzero(nb >= 0)
            node = nb[r, c]
            place = self._row(layer, node)
            fresh = ~seen[live[r], place]
            r, c, node = r[fresh], c[fresh], node[fresh]
            seen[live[r], place[fresh]] = True
            s = np.einsum("ij,ij->i", self.x[node], q[live[r]])
            good = s > sims[live[r], -1]
            r, c, node, s = r[good], c[good], node[good], s[good]
            if not len(r):
                continue
            new = np.full((len(live), nb.shape[1]), -2, np.float32)
            new[r, c] = s
            got = np.unique(r)
            to = live[got]
            both = np.concatenate([sims[to], new[got]], axis=1)
            order = np.argsort(-both, axis=1, kind="stable")[:, :beam]
            ids[to] = np.take_along_axis(np.concatenate([ids[to], nb[got]], axis=1), order, 1)
            opened[to] = np.take_along_axis(np.concatenate([opened[to], np.zeros((len(got), nb.shape[1]), bool)], axis=1), order, 1)
            sims[to] = np.take_along_axis(both, order, 1)
            opened[to] |= sims[to] <= -2
        ids[sims <= -2] = -1
        return ids, sims

    def block(self) -> int:
        return int(np.clip(SEEN_BYTES // max(len(self.x), 1), 32, BUILD_BLOCK))

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(node, similarity) arrays of shape (queries, beam), best first; a beam of all nodes is an exact scan."""
        beam = min(beam, len(self.x))
        ids, sims = [], []
        step = self.block()
        for a in range(0, len(q), step):
            part = q[a:a + step]
            if beam == len(self.x):
                s = part @ self.x.T
                i = np.argsort(-s, axis=1, kind="stable").astype(np.int32)
                s = np.take_along_axis(s, i, 1)
            else:
                at = np.full(len(part), self.entry, np.int64)
                for layer in range(len(self.near) - 1, 0, -1):
                    at = self._descend(part, at, layer)
                i, s = self._beam(part, at, 0, beam)
            ids.append(i)
            sims.append(s)
        return (np.concatenate(ids), np.concatenate(sims)) if ids else (np.zeros((0, beam), np.int32), np.zeros((0, beam), np.float32))

    # ---- build --------------------------------------------------------------------------------------------------

    @classmethod
    def build(cls, x: np.ndarray, chance: np.ndarray, apart: float = 1.0) -> tuple[SmallWorld, np.ndarray]:
        """The graph over vectors of `x` and, for each vector, the node that stands for it.

        `chance` (uniform in (0, 1), one per vector) sets the heights. A vector whose similarity to a node is at least
        `apart` is not inserted: that node stands for it."""
        n = len(x)
        height = np.minimum((-np.log(np.maximum(chance, 1e-12)) / np.log(DEGREE)).astype(np.int64), 12)
        stands = np.full(n, -1, np.int64)  # by vector: node
        vector = np.zeros(n, np.int64)  # by node: vector
        g = cls(np.empty((0, x.shape[1]), np.float32), [], [], 0)
        store, nodes = np.empty_like(x, np.float32), 0
        tops = np.zeros(n, np.int64)
        a = 0
        while a < n:
            b = min(n, a + min(BUILD_BLOCK, max(1, nodes)))
            rows = np.arange(a, b)
            a = b
            q = x[rows]
            inner = q @ q.T
            if nodes:
                found, sims = g.search(q, BUILD_BEAM)
                covered = sims[:, 0] >= apart
                stands[rows[covered]] = found[covered, 0]
            else:
                covered = np.zeros(len(rows), bool)
            close = np.tril(inner >= apart, -1) & ~covered[:, None]
            taken = {}
            for i in np.flatnonzero(close.any(1)):  # near vectors of the block itself: the first stands for the others
                first = next((j for j in np.flatnonzero(close[i]) if not covered[j] and j not in taken), None)
                if first is not None:
                    taken[int(i)] = int(first)
            own = np.array([i for i in range(len(rows)) if not covered[i] and i not in taken], np.int64)
            new = nodes + np.arange(len(own))
            stands[rows[own]], vector[new], tops[new] = new, rows[own], height[rows[own]]
            for i, j in taken.items():
                stands[rows[i]] = stands[rows[j]]
            store[new] = q[own]
            if len(own):
                g._insert(store[:nodes + len(own)], nodes, tops[:nodes + len(own)], inner[np.ix_(own, own)])
            nodes += len(own)
        g.x = store[:nodes].copy()
        return g, stands

    def _insert(self, x: np.ndarray, start: int, tops: np.ndarray, inner: np.ndarray) -> None:
        """Adds the nodes from `start` on to all layers; `inner` holds their similarities to each other."""
        old_layers, old_entry = len(self.near), self.entry
        new = np.arange(start, len(x))
        q, top = x[start:], int(tops[start:].max())
        at = np.full(len(new), old_entry, np.int64)
        plans = []
        for layer in range(max(old_layers - 1, top), -1, -1):
            joins = np.flatnonzero(tops[start:] >= layer)
            found = sims = None
            if layer < old_layers and start:
                if len(joins):
                    found, sims = self._searched(q[joins], at[joins], layer)
                at = self._descend(q, at, layer) if layer else at
                if len(joins):
                    at[joins] = found[:, 0]
            if len(joins):
                plans.append((layer, joins, found, sims))
        self.x = x
        for layer, joins, found, sims in plans:
            while len(self.near) <= layer:
                degree = DEGREE if self.near else 2 * DEGREE
                self.near.append(np.full((0, degree), -1, np.int32))
                self.members.append(np.zeros(0, np.int64))
            self.near[layer] = np.concatenate([self.near[layer], np.full((len(joins), self.near[layer].shape[1]), -1, np.int32)])
            self.members[layer] = np.concatenate([self.members[layer], new[joins]])
            self._connect(layer, new[joins], found, sims, inner[np.ix_(joins, joins)])
        if top >= old_layers:
            self.entry = int(new[tops[start:].argmax()])

    def _searched(self, q, at, layer):
        ids, sims = [], []
        step = self.block()
        for a in range(0, len(q), step):
            i, s = self._beam(q[a:a + step], at[a:a + step], layer, BUILD_BEAM)
            ids.append(i)
            sims.append(s)
        return np.concatenate(ids), np.concatenate(sims)

    def _connect(self, layer, nodes, found, sims, inner):
        near, degree = self.near[layer], self.near[layer].shape[1]
        k = min(DEGREE, len(nodes))
        inner = inner.copy()
        np.fill_diagonal(inner, -2)
        best = np.argsort(-inner, axis=1, kind="stable")[:, :k]
        cand = nodes[best].astype(np.int32)
        cand_sims = np.take_along_axis(inner, best, 1).astype(np.float32)
        cand = np.where(cand_sims <= -2, -1, cand)
        if found is not None:
            cand, cand_sims = np.concatenate([found, cand], axis=1), np.concatenate([sims, cand_sims], axis=1)
        chosen = self._chosen(cand, cand_sims, DEGREE)
        near[self._row(layer, nodes), :chosen.shape[1]] = chosen
        # the other direction: what each node already has and what it is offered, chosen anew where there is no room
        r, c = np.nonzero(chosen >= 0)
        to, frm = chosen[r, c].astype(np.int64), nodes[r]
        s = np.einsum("ij,ij->i", self.x[to], self.x[frm])
        order = np.lexsort((-s, to))
        to, frm = to[order], frm[order].astype(np.int32)
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
        rank = np.arange(len(to)) - np.repeat(first, np.diff(np.r_[first, len(to)]))
        room = rank < degree
        to, frm, rank = to[room], frm[room], rank[room]
        heads = to[np.r_[True, to[1:] != to[:-1]]] if len(to) else to
        step = self.block()
        which = np.searchsorted(heads, to)
        for a in range(0, len(heads), step):
            some = heads[a:a + step]
            offered = np.full((len(some), degree), -1, np.int32)
            mine = (which >= a) & (which < a + len(some))
            offered[which[mine] - a, rank[mine]] = frm[mine]
            have = near[self._row(layer, some)]
            offered[(offered[:, :, None] == have[:, None, :]).any(2)] = -1
            both = np.concatenate([have, offered], axis=1)
            fits = (both >= 0).sum(1) <= degree
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :degree]
            full = np.flatnonzero(~fits)
            if len(full):
                s = np.matmul(self.x[both[full]], self.x[some[full]][:, :, None])[:, :, 0]
                s[both[full] < 0] = -2
                packed[full] = self._chosen(both[full], s, degree)
            near[self._row(layer, some)] = packed

    def _chosen(self, cand: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
        """Up to `degree` candidates of each row, best first, none nearer to a chosen one than to the node; what is left of the
        room goes to the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        out = np.full((len(cand), degree), -1, np.int32)
        for a in range(0, len(cand), 256):
            c, s = cand[a:a + 256], sims[a:a + 256]
            v = self.x[c]
            cross = np.matmul(v, v.transpose(0, 2, 1))
            keep, count = np.zeros(c.shape, bool), np.zeros(len(c), np.int64)
            worst = np.full(c.shape, -2, np.float32)  # similarity of each candidate to the nearest chosen one
            for j in range(c.shape[1]):
                take = (s[:, j] > -2) & (worst[:, j] < s[:, j]) & (count < degree)
                keep[take, j] = True
                count += take
                worst[take] = np.maximum(worst[take], cross[take, j])
            rank = np.where(keep, 0, np.where(s > -2, 1, 2))
            picked = np.argsort(rank, axis=1, kind="stable")[:, :degree]
            got = np.take_along_axis(c, picked, 1)
            got[np.take_along_axis(rank, picked, 1) == 2] = -1
            out[a:a + 256, :got.shape[1]] = got
        return out
