"""Signature tree over sets, and the exact self join by dual traversal. Runs on one bounded unit of sets in a task."""

from __future__ import annotations

import numpy as np

LEAF = 16
FANOUT = 8


class SignatureTree:
    """Sets in order of size; each node holds the OR of its bitmaps, its size range and its largest slack.

    The slack of a set is its size minus the bits it sets: two sets whose bitmaps share ``c`` bits have at most
    ``c + slack`` tokens in common, by the slack of either. That bound holds for nodes as well.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], np.int64)
        width = 64
        while width < 2 * int(self.size.max(initial=1)) and width < 1 << 15:
            width *= 2
        n, words = len(sets), width // 64
        flat = np.concatenate(sets).astype(np.uint64, copy=False)
        owner = np.repeat(np.arange(n), self.size)
        bit = (flat >> np.uint64(7)) % np.uint64(width)
        bitmaps = np.zeros((n, words), np.uint64)
        np.bitwise_or.at(bitmaps, (owner, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
        slack = self.size - np.bitwise_count(bitmaps).sum(axis=1)
        self.levels = [(bitmaps, self.size, self.size, slack, np.arange(n), np.arange(1, n + 1))]
        step = LEAF
        while len(self.levels[-1][1]) > 1:
            maps, low, high, slack, first, last = self.levels[-1]
            at = np.arange(0, len(low), step)
            ends = np.append(at[1:], len(low)) - 1
            self.levels.append(
                (
                    np.bitwise_or.reduceat(maps, at, axis=0),
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.maximum.reduceat(slack, at),
                    first[at],
                    last[ends],
                )
            )
            step = FANOUT

    def children(self, level: int, node: int) -> tuple[int, int]:
        step = LEAF if level == 1 else FANOUT
        return node * step, min((node + 1) * step, len(self.levels[level - 1][1]))


def self_join(sets: list[np.ndarray], percent: int, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) with 100 * |i and j| >= percent * |i or j| that connect the same components as all links do.

    ``sets`` are arrays of distinct tokens. ``known`` gives components that are connected already. A pair of nodes
    is left when no pair below it can reach the overlap that its sizes ask for, or when all sets below both lie in
    one component by then: further links there connect nothing new. So copies of one text cost one link each.
    """
    found: list[tuple[int, int]] = []
    if len(sets) < 2:
        return found
    sizes = np.array([len(s) for s in sets])
    order = np.lexsort((np.array([s.min() if len(s) else 0 for s in sets], np.uint64), sizes))
    order = order[sizes[order] > 0]
    if len(order) < 2:
        return found
    tree = SignatureTree([sets[i] for i in order])
    component = np.arange(len(order)) if known is None else known[order].copy()
    share = percent / (100 + percent)

    def possible(level: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Which of the pairs (one[i], other[i]) of a level may hold a link; ``one`` comes before ``other`` in size."""
        maps, low, high, slack, _, _ = tree.levels[level]
        in_range = 100 * high[one] >= percent * low[other]
        shared = np.bitwise_count(maps[one] & maps[other]).sum(axis=1, dtype=np.int64)
        most = np.minimum(shared + np.minimum(slack[one], slack[other]), np.minimum(high[one], high[other]))
        return in_range & (most + 1e-6 >= share * (low[one] + low[other]))

    stack = [(len(tree.levels) - 1, 0, 0)]
    while stack:
        level, a, b = stack.pop()
        if level:
            first, last = tree.levels[level][4:6]
            below = np.concatenate([component[first[a] : last[a]], component[first[b] : last[b]]])
            if (below == below[0]).all():
                continue
            left, right = np.arange(*tree.children(level, a)), np.arange(*tree.children(level, b))
            one, other = (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
            keep = (one <= other) if level > 1 else (one < other)
            one, other = one[keep], other[keep]
            if level == 1:
                apart = component[one] != component[other]
                one, other = one[apart], other[apart]
            keep = possible(level - 1, one, other)
            # nearest sizes first, so that copies are joined before distant pairs are looked at
            stack.extend((level - 1, int(x), int(y)) for x, y in zip(one[keep][::-1], other[keep][::-1]))
            continue
        if component[a] == component[b]:
            continue
        common = len(np.intersect1d(tree.sets[a], tree.sets[b], assume_unique=True))
        if 100 * common >= percent * (len(tree.sets[a]) + len(tree.sets[b]) - common):
            found.append((int(order[a]), int(order[b])))
            component[component == component[b]] = component[a]
    return found


def signature(tokens: np.ndarray) -> bytes:
    """Bitmap of a set, with two to four bits per token, as bytes."""
    width = 64
    while width < 2 * len(tokens) and width < 1 << 17:
        width *= 2
    bits = np.zeros(width, np.uint8)
    bits[((tokens >> np.uint64(7)) % np.uint64(width)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def folded(signatures: list[bytes]) -> np.ndarray:
    """Bitmaps of one width, the smallest among them: a wider one is the OR of its halves, as widths are powers of two."""
    width = min(map(len, signatures))
    rows = [np.bitwise_or.reduce(np.frombuffer(s, np.uint8).reshape(-1, width), axis=0) for s in signatures]
    return np.ascontiguousarray(np.stack(rows)).view(np.uint64)


def promising(sizes: np.ndarray, signatures: list[bytes], percent: int) -> np.ndarray:
    """Which sets may be linked to another one, by their bitmaps and sizes alone; no linked set is left out."""
    maps = folded(signatures)
    order = np.argsort(sizes, kind="stable")
    maps, n = maps[order], sizes[order]
    slack = n - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    share = percent / (100 + percent)
    out = np.zeros(len(n), bool)
    for i in range(len(n) - 1):
        last = np.searchsorted(n, 100 * n[i] // percent, side="right")
        if last <= i + 1:
            continue
        near = slice(i + 1, last)
        most = np.bitwise_count(maps[near] & maps[i]).sum(axis=1, dtype=np.int64) + np.minimum(slack[near], slack[i])
        linked = most + 1e-6 >= share * (n[near] + n[i])
        if linked.any():
            out[i] = True
            out[near] |= linked
    keep = np.zeros(len(n), bool)
    keep[order] = out
    return keep
