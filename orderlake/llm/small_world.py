"""A hierarchical navigable small-world graph over unit vectors (numpy, one shard's worth)."""

from __future__ import annotations

import heapq

import numpy as np

#: Links of a node on the upper layers (twice as many on the lowest), and the beam while building.
LINKS, BUILD_BEAM = 12, 40


class Graph:
    """Layers of neighbour lists. The vectors are given once, the nodes are put in one by one."""

    def __init__(self, unit: np.ndarray, seeds: np.ndarray) -> None:
        """unit: float64 rows of length 1; seeds: integers that draw the nodes' levels, the same each time."""
        self.x = np.ascontiguousarray(unit, dtype=np.float32)
        n = len(unit)
        draw = ((seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        self.levels = np.minimum(np.floor(-np.log(np.maximum(draw, 1e-12)) / np.log(LINKS)), 12).astype(np.int64)
        self.layers: list[dict[int, list[int]]] = [{} for _ in range(int(self.levels.max(initial=0)) + 1)]
        self.entry, self.top = -1, -1
        for node in range(n):
            self._insert(node)

    @classmethod
    def load(cls, unit: np.ndarray, entry: int, nodes: list[np.ndarray], links: list[np.ndarray]) -> "Graph":
        graph = cls.__new__(cls)
        graph.x = np.ascontiguousarray(unit, dtype=np.float32)
        graph.layers = []
        for own, table in zip(nodes, links):
            graph.layers.append({k: [x for x in row if x >= 0] for k, row in zip(own.tolist(), table.tolist())})
        graph.entry, graph.top = entry, len(graph.layers) - 1
        return graph

    def dump(self) -> tuple[int, list[np.ndarray], list[np.ndarray]]:
        """(entry, nodes of each layer, their links padded with -1)."""
        nodes, links = [], []
        for layer in self.layers[: self.top + 1]:
            width = max(map(len, layer.values()), default=0)
            nodes.append(np.fromiter(layer, np.int32, len(layer)))
            links.append(np.array([row + [-1] * (width - len(row)) for row in layer.values()], dtype=np.int32).reshape(len(layer), width))
        return self.entry, nodes, links

    def _beam(self, q: np.ndarray, entries: list[int], ef: int, layer: dict[int, list[int]]) -> list[tuple[float, int]]:
        """The ef nodes most similar to q that a best-first walk from the entries meets, best first."""
        seen = set(entries)
        best = [(float(s), e) for s, e in zip(self.x[entries] @ q, entries)]
        todo = [(-s, e) for s, e in best]
        heapq.heapify(best)
        heapq.heapify(todo)
        while len(best) > ef:
            heapq.heappop(best)
        while todo:
            s, node = heapq.heappop(todo)
            if len(best) >= ef and -s < best[0][0]:
                break
            new = [x for x in layer[node] if x not in seen]
            if not new:
                continue
            seen.update(new)
            for sim, x in zip((self.x[new] @ q).tolist(), new):
                if len(best) < ef:
                    heapq.heappush(best, (sim, x))
                    heapq.heappush(todo, (-sim, x))
                elif sim > best[0][0]:
                    heapq.heapreplace(best, (sim, x))
                    heapq.heappush(todo, (-sim, x))
        return sorted(best, reverse=True)

    def _choose(self, near: list[tuple[float, int]], most: int) -> list[int]:
        """Links to nodes in different directions first, then to the nearest of the rest."""
        if len(near) <= most:
            return [x for _, x in near]
        ids = [x for _, x in near]
        between = self.x[ids] @ self.x[ids].T
        closest = np.full(len(ids), -2.0, dtype=np.float32)  # of each one to those chosen
        chosen: list[int] = []
        left: list[int] = []
        for k, (sim, _) in enumerate(near):
            if len(chosen) == most:
                break
            if sim > closest[k]:
                chosen.append(k)
                np.maximum(closest, between[k], out=closest)
            else:
                left.append(k)
        return [ids[k] for k in (chosen + left)[:most]]

    def _descend(self, q: np.ndarray, down_to: int) -> int:
        node = self.entry
        for level in range(self.top, down_to, -1):
            node = self._beam(q, [node], 1, self.layers[level])[0][1]
        return node

    def _insert(self, node: int) -> None:
        level, q = int(self.levels[node]), self.x[node]
        if self.entry < 0:
            for k in range(level + 1):
                self.layers[k][node] = []
            self.entry, self.top = node, level
            return
        entries = [self._descend(q, min(level, self.top))]
        for k in range(min(level, self.top), -1, -1):
            layer, most = self.layers[k], LINKS * (2 if k == 0 else 1)
            near = self._beam(q, entries, BUILD_BEAM, layer)
            layer[node] = self._choose(near, LINKS)
            for x in layer[node]:
                row = layer[x]
                row.append(node)
                if len(row) > most:
                    sims = (self.x[row] @ self.x[x]).tolist()
                    layer[x] = self._choose(sorted(zip(sims, row), reverse=True), most)
            entries = [x for _, x in near]
        for k in range(self.top + 1, level + 1):
            self.layers[k][node] = []
        if level > self.top:
            self.entry, self.top = node, level

    def search(self, q: np.ndarray, ef: int, start: int | None = None) -> list[int]:
        """About the ef nodes most similar to q. start: a node known to be near."""
        q = q.astype(np.float32)
        entries = {self._descend(q, 0)} | ({start} if start is not None else set())
        return [x for _, x in self._beam(q, sorted(entries), ef, self.layers[0])]
