"""A sharing plan for many sums over overlapping sets of terms.

Items are sets of terms.  Shared term sets are mined bottom up: in every round
the pairs that stand side by side in at least two items become a node of their
own, which then takes the place of the pair in all of them.  Terms are ordered
by the number of items that hold them, then by which items those are, so terms
of the same items stand side by side.  The nodes form a directed acyclic
graph in which every shared set is summed once; what is left of each item is
summed pairwise.  Work and size are linear in the items' lengths.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field


@dataclass
class SharingPlan:
    """Nodes ``0..leaves-1`` are terms.  Each level ``(first, a, b)`` sums nodes
    ``a[i]`` and ``b[i]`` into node ``first + i``; ``roots`` are the items'."""

    leaves: int
    levels: list[tuple[int, list[int], list[int]]] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    shared: int = 0

    @property
    def nodes(self) -> int:
        return self.leaves + sum(len(a) for _, a, _ in self.levels)


def _merge_round(rows: list[list[int]], made: dict[tuple[int, int], int], children: list) -> bool:
    """Replace neighbouring pairs that two items or more share; False if none is left."""
    count = Counter(pair for row in rows for pair in zip(row, row[1:]))
    if not any(n > 1 for n in count.values()):
        return False
    for row in rows:
        out, i = [], 0
        while i < len(row):
            n = count.get((row[i], row[i + 1]), 0) if i + 1 < len(row) else 0
            later = count.get((row[i + 1], row[i + 2]), 0) if i + 2 < len(row) else 0
            if n > 1 and n >= later:
                pair = (row[i], row[i + 1])
                if pair not in made:
                    made[pair] = len(children)
                    children.append(pair)
                out.append(made[pair])
                i += 2
            else:
                out.append(row[i])
                i += 1
        row[:] = out
    return True


def sharing_plan(items: list[set[int]], leaves: int) -> SharingPlan:
    """The plan for ``items`` of terms ``0..leaves-1``; no item is empty."""
    holders: dict[int, list[int]] = {}
    for k, item in enumerate(items):
        for t in item:
            holders.setdefault(t, []).append(k)
    place = {t: r for r, t in enumerate(sorted(holders, key=lambda t: (-len(holders[t]), holders[t], t)))}
    rows = [sorted(item, key=place.__getitem__) for item in items]
    children: list[tuple[int, int] | None] = [None] * leaves
    made: dict[tuple[int, int], int] = {}
    while _merge_round(rows, made, children):
        pass
    shared = len(children) - leaves
    while any(len(row) > 1 for row in rows):  # what no other item has: a balanced sum
        for row in rows:
            out = []
            for i in range(0, len(row) - 1, 2):
                children.append((row[i], row[i + 1]))
                out.append(len(children) - 1)
            row[:] = out + row[len(row) - len(row) % 2:]
    level = [0] * len(children)
    for node in range(leaves, len(children)):
        level[node] = 1 + max(level[c] for c in children[node])
    order = sorted(range(leaves, len(children)), key=lambda n: (level[n], n))
    number = {**{n: n for n in range(leaves)}, **{n: leaves + i for i, n in enumerate(order)}}
    plan = SharingPlan(leaves, roots=[number[row[0]] for row in rows], shared=shared)
    for node in order:
        if not plan.levels or level[node] != len(plan.levels):
            plan.levels.append((number[node], [], []))
        for side, child in zip(plan.levels[-1][1:], children[node]):
            side.append(number[child])
    return plan
