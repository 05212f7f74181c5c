"""A prefix tree over ordered sets, searched for all sets that are similar to given ones."""

from __future__ import annotations

import numpy as np

#: pairs of a probe's token and a node counted at once
COUNTED = 1_000_000


class Groups:
    """Disjoint groups of numbers, merged pair by pair."""

    def __init__(self, start: np.ndarray):
        self.of = start.copy()  # the group of each number, named by one of its numbers

    def merge(self, left: np.ndarray, right: np.ndarray) -> None:
        """Put both sides of each pair into one group, named by its smallest number."""
        parent = list(range(len(self.of)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(self.of[left].tolist(), self.of[right].tolist()):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
        self.of = np.array([top(x) for x in range(len(parent))], np.int64)[self.of]


class PrefixTree:
    """Sets of tokens in one order, stored by shared prefixes; chains without a branch are one node.

    Tokens held by most sets come first, so that similar sets share long paths. A search walks down from
    the root with all its probes at once and counts the overlap with each node's tokens once for all sets
    below it. It leaves a subtree whose sets are all too small or too large, or whose overlap cannot reach
    what the smallest of them needs even if all remaining tokens of the probe, or of the longest set
    below, were shared.
    """

    def __init__(self, sets: list[np.ndarray], percent: int):
        """``sets`` are distinct, without repeated tokens."""
        self.percent = percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.vocabulary, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        self.rank = np.empty(len(times), np.int64)
        self.rank[np.lexsort((self.vocabulary, -times))] = np.arange(len(times))
        ranks, ends = self.rank[at], np.cumsum(self.sizes)
        ordered = [np.sort(ranks[e - n:e]) for e, n in zip(ends.tolist(), self.sizes.tolist())]
        self._build(ordered)

    def _build(self, ordered: list[np.ndarray]) -> None:
        depth, parent, shown, ends_here = [0], [-1], [0], [-1]
        stack = [0]

        def node(at_depth: int, above: int, example: int, ends: int) -> int:
            depth.append(at_depth), parent.append(above), shown.append(example), ends_here.append(ends)
            return len(depth) - 1

        before = None
        spelled = [o.astype(">u4").tobytes() for o in ordered]
        for i in sorted(range(len(ordered)), key=spelled.__getitem__):
            shared = 0
            if before is not None:
                k = min(len(before), len(ordered[i]))
                differ = np.flatnonzero(before[:k] != ordered[i][:k])
                shared = int(differ[0]) if len(differ) else k
            last = -1
            while depth[stack[-1]] > shared:
                last = stack.pop()
            if depth[stack[-1]] < shared:  # a branch inside the chain of ``last``
                stack.append(node(shared, stack[-1], i, -1))
                parent[last] = stack[-1]
            stack.append(node(len(ordered[i]), stack[-1], i, i))
            before = ordered[i]

        self.parent, self.ends_here = np.array(parent), np.array(ends_here)
        n, deep = len(parent), np.array(depth, np.int64)
        first = np.where(self.parent >= 0, deep[self.parent], 0)
        tokens = [ordered[shown[v]][first[v]:deep[v]] for v in range(1, n)]
        # token -> nodes that hold it, sorted by token
        held = np.concatenate([np.zeros(0, np.int64), *tokens])
        owner = np.repeat(np.arange(1, n), [len(t) for t in tokens])
        order = np.argsort(held, kind="stable")
        self.holder = owner[order]
        self.holders = np.searchsorted(held[order], np.arange(len(self.vocabulary) + 1))
        self.last_token = np.array([-1, *[int(t[-1]) if len(t) else -1 for t in tokens]], np.int64)
        # children side by side, and nodes from the deepest to the root
        self.child = np.argsort(self.parent, kind="stable")[1:]
        self.children = np.searchsorted(self.parent[self.child], np.arange(n + 1))
        self.upward = np.argsort(-deep, kind="stable")
        own = np.where(self.ends_here >= 0, self.sizes[self.ends_here], -1)
        self.least = self._below(np.where(own >= 0, own, np.iinfo(np.int64).max), min)
        self.most = self._below(own, max)
        self.longest_rest = self.most - deep

    def _below(self, own: np.ndarray, pick) -> np.ndarray:
        """The smallest or largest of the values of each subtree."""
        values, parent = own.tolist(), self.parent.tolist()
        for v in self.upward.tolist()[:-1]:
            values[parent[v]] = pick(values[parent[v]], values[v])
        return np.array(values, np.int64)

    def _shared(self, ranks: np.ndarray, owner: np.ndarray, probes: int) -> np.ndarray:
        """How many tokens of each probe each node holds, probe by probe; probes are counted some at a time."""
        n, shared = len(self.parent), np.zeros(probes * len(self.parent), np.int32)
        count = self.holders[ranks + 1] - self.holders[ranks]
        ends = np.concatenate([[0], np.cumsum(count)])
        first_token = np.searchsorted(owner, np.arange(probes + 1))
        p = 0
        while p < probes:
            upto = int(np.searchsorted(ends[first_token], ends[first_token[p]] + COUNTED, "right")) - 1
            upto = min(max(upto, p + 1), probes)
            i, j = first_token[p], first_token[upto]
            held = np.repeat(self.holders[ranks[i:j]] - ends[i:j], count[i:j]) + np.arange(ends[i], ends[j])
            place = np.repeat((owner[i:j] - p) * n, count[i:j]) + self.holder[held]
            shared[p * n:upto * n] = np.bincount(place, minlength=(upto - p) * n)
            p = upto
        return shared

    def search(self, probes: list[np.ndarray], own: np.ndarray | None = None, group: np.ndarray | None = None,
               sets_group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a probe and a set that are at least ``percent`` alike.

        ``own`` is the number of the set that a probe itself is, which is not given. With groups of
        probes and sets, pairs inside a group are left out, whole subtrees at once.
        """
        sizes = np.array([len(p) for p in probes], np.int64)
        owner = np.repeat(np.arange(len(probes)), sizes)
        flat = np.concatenate([np.zeros(0, self.vocabulary.dtype), *probes])
        at = np.minimum(np.searchsorted(self.vocabulary, flat), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == flat
        ranks, owner = self.rank[at[known]], owner[known]
        width, n = len(self.vocabulary) + 1, len(self.parent)
        shared = self._shared(ranks, owner, len(probes))
        places = np.sort(owner * width + ranks)
        upto = np.searchsorted(places, (np.arange(len(probes)) + 1) * width)
        if group is not None:
            held = np.where(self.ends_here >= 0, sets_group[self.ends_here], -1)
            low = self._below(np.where(self.ends_here >= 0, held, np.iinfo(np.int64).max), min)
            high = self._below(held, max)
        found_probe, found_set = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        probe, at_node = np.arange(len(probes)), np.zeros(len(probes), np.int64)
        overlap = np.zeros(len(probes), np.int64)
        while len(probe):
            number = self.children[at_node + 1] - self.children[at_node]
            ends = np.cumsum(number)
            total = int(ends[-1])
            into = self.child[np.arange(total) + np.repeat(self.children[at_node] - (ends - number), number)]
            probe, overlap = np.repeat(probe, number), np.repeat(overlap, number) + shared[
                np.repeat(probe, number) * n + into]
            size, least, most = sizes[probe], self.least[into], self.most[into]
            rest = np.minimum(self.longest_rest[into],
                              upto[probe] - np.searchsorted(places, probe * width + self.last_token[into], "right"))
            fits = (most * 100 >= size * self.percent) & (size * 100 >= least * self.percent)
            # a set between the sizes of which the subtree has any needs no less than this
            small = np.maximum(least, -(-size * self.percent // 100))
            fits &= (overlap + rest) * (100 + self.percent) >= self.percent * (size + small)
            if group is not None:
                fits &= (low[into] != high[into]) | (low[into] != group[probe])
            probe, at_node, overlap = probe[fits], into[fits], overlap[fits]
            ending = self.ends_here[at_node]
            good = (ending >= 0) & (overlap * (100 + self.percent) >= self.percent * (
                sizes[probe] + np.where(ending >= 0, self.sizes[ending], 0)))
            if own is not None:
                good &= ending != own[probe]
            if group is not None:
                good &= np.where(ending >= 0, sets_group[ending], -1) != group[probe]
            found_probe.append(probe[good])
            found_set.append(ending[good])
        return np.concatenate(found_probe), np.concatenate(found_set)
