"""A tree of ordered sets: sets that begin alike share a path, and a search shares its overlap.

The tree is compressed: a node holds the run of values between two branchings. A search counts the
values of each run that the probe holds, adds them up along the paths level by level, and leaves a
subtree when no set in it, by the sizes that are left, can reach the similarity.
"""

from __future__ import annotations

import numpy as np


class Links:
    """Disjoint sets of the numbers below `size`."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y

    def roots(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.up))], np.int64)


class PrefixTree:
    """Sets as arrays of distinct small integers, ascending."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        parent, owner, low, depth = [0], [0], [0], [0]
        ends = np.zeros(len(sets), np.int64)  # node where a set ends
        stack, before = [0], np.zeros(0, np.int64)

        def node(above: int, of: int, first: int, last: int) -> int:
            for column, value in zip((parent, owner, low, depth), (above, of, first, last)):
                column.append(value)
            return len(parent) - 1

        for i in self.order:
            values = sets[i]
            shared = min(len(before), len(values))
            differ = np.flatnonzero(before[:shared] != values[:shared])
            shared = int(differ[0]) if len(differ) else shared
            below = 0
            while depth[stack[-1]] > shared:
                below = stack.pop()
            if depth[stack[-1]] < shared:
                middle = node(stack[-1], owner[below], depth[stack[-1]], shared)
                parent[below], low[below] = middle, shared
                stack.append(middle)
            if len(values) > shared:
                stack.append(node(stack[-1], i, shared, len(values)))
            ends[i], before = stack[-1], values

        self.depth = np.array(depth)
        runs = [sets[owner[k]][low[k] : depth[k]] if len(sets) else before for k in range(len(parent))]
        self.flat = np.concatenate(runs) if runs else before
        self.stop = np.cumsum([len(r) for r in runs])
        self.start = self.stop - np.array([len(r) for r in runs])
        self.parent = np.array(parent)
        children = np.argsort(self.parent[1:], kind="stable") + 1
        self.children = children
        self.first_child = np.searchsorted(self.parent[children], np.arange(len(parent) + 1))
        self.sizes = np.array([len(s) for s in sets])
        self.ends = ends
        # a node's set, if one ends there: sets are distinct
        self.set_at = np.full(len(parent), -1)
        self.set_at[ends] = np.arange(len(sets))
        self.up_order = np.argsort(-self.depth, kind="stable")  # below before above
        self.least, self.most = self._spread(self.sizes)

    def _spread(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest and largest value of the sets below each node."""
        least = np.full(len(self.parent), np.iinfo(np.int64).max)
        most = np.full(len(self.parent), -1)
        least[self.ends] = most[self.ends] = values
        up, lows, highs = self.parent.tolist(), least.tolist(), most.tolist()
        for k in self.up_order.tolist():
            p = up[k]
            if lows[k] < lows[p]:
                lows[p] = lows[k]
            if highs[k] > highs[p]:
                highs[p] = highs[k]
        return np.array(lows), np.array(highs)

    def search(self, mark: np.ndarray, size: int, percent: int, skip: np.ndarray | None = None) -> np.ndarray:
        """Numbers of the sets at least `percent` per cent similar to the probe.

        `mark` is 1 at the values of the probe, which has `size` values in all. Subtrees with a
        true value in `skip` are left out.
        """
        sums = np.concatenate(([0], np.cumsum(mark[self.flat])))
        inside = sums[self.stop] - sums[self.start]
        nodes, shared = np.zeros(1, np.int64), np.zeros(1, np.int64)
        found = []
        whole = 100 + percent
        while len(nodes):
            depth = self.depth[nodes]
            best = np.clip(size + depth - shared, self.least[nodes], self.most[nodes])
            reach = np.minimum(shared + best - depth, size)
            go = whole * reach >= percent * (size + best)
            if skip is not None:
                go &= ~skip[nodes]
            nodes, shared = nodes[go], shared[go]
            at = self.set_at[nodes]
            own = (at >= 0) & (whole * shared >= percent * (size + self.depth[nodes]))
            found.append(at[own])
            count = self.first_child[nodes + 1] - self.first_child[nodes]
            slots = np.repeat(self.first_child[nodes] - np.cumsum(count) + count, count) + np.arange(count.sum())
            shared = np.repeat(shared, count)
            nodes = self.children[slots]
            shared = shared + inside[nodes]
        return np.concatenate(found)


def rank_values(sets: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The sets over small integers, the values of most sets first, so that paths are shared."""
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(values))
    bounds = np.cumsum([len(s) for s in sets])[:-1]
    return [np.sort(part) for part in np.split(rank[inverse], bounds)], len(values)


def link_all(sets: list[np.ndarray], percent: int) -> Links:
    """Components of all pairs of sets at least `percent` per cent similar."""
    links = Links(len(sets))
    if len(sets) < 2:
        return links
    ranked, size = rank_values(sets)
    tree = PrefixTree(ranked)
    mark = np.zeros(size, np.int64)
    for i, j in zip(tree.order, tree.order[1:]):  # neighbours in the tree first: mostly alike
        shared = len(np.intersect1d(ranked[i], ranked[j], assume_unique=True))
        if (100 + percent) * shared >= percent * (len(ranked[i]) + len(ranked[j])):
            links.join(i, j)
    _search_rest(tree, ranked, list(range(len(sets))), links, mark, percent)
    return links


def _search_rest(tree: PrefixTree, probes, numbers: list[int], links: Links, mark, percent: int) -> None:
    """Joins each probe with the sets it is similar to, past subtrees that it is joined with already."""
    stale = True
    for probe, number in zip(probes, numbers):
        if stale:
            low, high = tree._spread(links.roots()[: len(tree.sizes)])
            stale = False
        mine = links.find(number)
        if low[0] == high[0] == mine:
            continue
        mark[probe] = 1
        for other in tree.search(mark, len(probe), percent, (low == high) & (low == mine)).tolist():
            stale |= links.join(number, other)
        mark[probe] = 0


def link_probes(sets: list[np.ndarray], probes: list[np.ndarray], percent: int, known: list[int]) -> Links:
    """Components of probes (numbered behind the sets) and sets; `known` gives equal numbers to what is joined already."""
    links = Links(len(sets) + len(probes))
    first: dict[int, int] = {}
    for k, component in enumerate(known):
        links.join(k, first.setdefault(component, k))
    ranked, size = rank_values([*sets, *probes])
    tree = PrefixTree(ranked[: len(sets)])
    numbers = list(range(len(sets), len(ranked)))
    _search_rest(tree, ranked[len(sets) :], numbers, links, np.zeros(size, np.int64), percent)
    return links
