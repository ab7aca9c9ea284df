"""A prefix tree over ordered sets, and the search in it for sets similar to a given one.

Sets share a branch as far as their first elements agree, so an overlap with a shared
beginning is counted once for all sets below it. A branch is left when even the best size
below it, with all that remains of both sets in common, would not reach the threshold.
"""

from __future__ import annotations

import numpy as np


class PrefixTree:
    """Sets of ascending numbers ``0 .. universe - 1``; a branch holds a run of them."""

    def __init__(self, sets: list[np.ndarray], universe: int):
        keys = [s.astype(">u4").tobytes() for s in sets]
        order = sorted(range(len(sets)), key=keys.__getitem__)
        parent, begin, end, owner = [-1], [0], [0], [order[0] if order else 0]
        ends_at: list[tuple[int, int]] = []  # (node, set)
        path = [0]
        previous = None
        for i in order:
            own = sets[i]
            shared = 0
            if previous is not None:
                n = min(len(own), len(previous))
                differ = np.flatnonzero(own[:n] != previous[:n])
                shared = int(differ[0]) if len(differ) else n
            last = -1
            while end[path[-1]] > shared:
                last = path.pop()
            if last >= 0 and end[path[-1]] < shared:
                # Part the branch where the two sets part.
                parent.append(path[-1])
                begin.append(begin[last])
                end.append(shared)
                owner.append(owner[last])
                parent[last], begin[last] = len(parent) - 1, shared
                path.append(len(parent) - 1)
            if len(own) > shared:
                parent.append(path[-1])
                begin.append(shared)
                end.append(len(own))
                owner.append(i)
                path.append(len(parent) - 1)
            ends_at.append((path[-1], i))
            previous = own
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.depth = np.array(end, np.int64)
        start = np.array(begin, np.int64)
        self.length = self.depth - start
        self.parent = np.array(parent, np.int64)
        self.flat = np.concatenate([sets[o][b:e] for o, b, e in zip(owner, begin, end)]) if sets else np.zeros(0, np.int64)
        self.flat_start = np.cumsum(self.length) - self.length
        self.last = np.array([sets[o][e - 1] if e else -1 for o, e in zip(owner, end)], np.int64)
        count = len(parent)
        children = np.argsort(self.parent[1:], kind="stable") + 1
        self.children = children
        self.child_start = np.searchsorted(self.parent[children], np.arange(count + 1))
        self.ending = np.array([s for _, s in sorted(ends_at)], np.int64)
        self.ending_start = np.searchsorted(np.array(sorted(n for n, _ in ends_at)), np.arange(count + 1))
        # Sizes below each node, children first.
        self.least, self.most = np.full(count, 1 << 40), np.zeros(count, np.int64)
        for node, i in ends_at:
            self.least[node] = min(self.least[node], self.sizes[i])
            self.most[node] = max(self.most[node], self.sizes[i])
        for node in np.argsort(-self.depth, kind="stable").tolist():
            up = parent[node]
            if up >= 0:
                self.least[up] = min(self.least[up], self.least[node])
                self.most[up] = max(self.most[up], self.most[node])
        self.member = np.zeros(universe, bool)

    @staticmethod
    def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.cumsum(counts)
        return np.arange(total[-1] if len(total) else 0) + np.repeat(starts - (total - counts), counts)

    def similar(self, asked: np.ndarray, over: int, under: int) -> np.ndarray:
        """Sets with ``under * |both| >= over * |either|``."""
        size, member = len(asked), self.member
        member[asked] = True
        fewest, most = -(-over * size // under), under * size // over
        found = []
        node, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
        while len(node):
            ended = self.ending_start[node + 1] - self.ending_start[node]
            if ended.any():
                ids = self.ending[self._runs(self.ending_start[node], ended)]
                both = np.repeat(overlap, ended)
                found.append(ids[(over + under) * both >= over * (size + self.sizes[ids])])
            count = self.child_start[node + 1] - self.child_start[node]
            child = self.children[self._runs(self.child_start[node], count)]
            overlap = np.repeat(overlap, count)
            fit = (self.least[child] <= most) & (self.most[child] >= fewest)
            child, overlap = child[fit], overlap[fit]
            if not len(child):
                break
            length = self.length[child]
            hits = member[self.flat[self._runs(self.flat_start[child], length)]]
            overlap = overlap + np.add.reduceat(hits, np.cumsum(length) - length, dtype=np.int64)
            left = size - np.searchsorted(asked, self.last[child], side="right")
            best = np.clip(self.depth[child] + left, np.maximum(self.least[child], fewest), np.minimum(self.most[child], most))
            reach = overlap + np.minimum(left, best - self.depth[child])
            fit = (over + under) * reach >= over * (size + best)
            node, overlap = child[fit], overlap[fit]
        member[asked] = False
        return np.concatenate(found) if found else np.zeros(0, np.int64)
