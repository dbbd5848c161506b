"""Signature trees over token sets: links between similar sets without comparing all pairs."""

from __future__ import annotations

import numpy as np

#: bits of a node's bitmap, sets in a leaf, children of a node
BITS = 1024
LEAF = 8
FANOUT = 4


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    flags = np.zeros(BITS, dtype=np.uint8)
    flags[(tokens % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.uint64)


class Labels:
    """What is connected, as an array of labels; of two parts the smaller takes the other's."""

    def __init__(self, labels: np.ndarray) -> None:
        self.of = labels.copy()
        order = np.argsort(labels, kind="stable")
        cuts = np.flatnonzero(np.diff(labels[order])) + 1
        self.members = {int(labels[part[0]]): part.tolist() for part in np.split(order, cuts) if len(part)}

    def unite(self, one: int, other: int) -> None:
        keep, gone = int(self.of[one]), int(self.of[other])
        if len(self.members[keep]) < len(self.members[gone]):
            keep, gone = gone, keep
        moved = self.members.pop(gone)
        self.of[moved] = keep
        self.members[keep] += moved


class Tree:
    """Sets in order of size. A node holds the union of the bitmaps of the sets below it,
    the fewest bits that one of them sets, and with the order the range of their sizes."""

    def __init__(self, sets: list[np.ndarray], which: np.ndarray) -> None:
        sizes = np.array([len(sets[i]) for i in which], dtype=np.int64)
        first = np.array([sets[i][0] for i in which], dtype=np.uint64)
        order = np.lexsort((first, sizes))
        self.which, self.sizes = which[order], sizes[order]
        self.bits = np.stack([_bitmap(sets[i]) for i in self.which]) if len(which) else np.zeros((0, BITS // 64), np.uint64)
        self.n_bits = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        starts = np.arange(0, len(which), LEAF)
        #: from the leaves up: first set, end set, bitmap, fewest bits of each node
        self.levels = []
        if len(which):
            self.levels.append((starts, np.append(starts[1:], len(which)),
                                np.bitwise_or.reduceat(self.bits, starts, axis=0),
                                np.minimum.reduceat(self.n_bits, starts)))
        while self.levels and len(self.levels[-1][0]) > 1:
            low, high, bits, fewest = self.levels[-1]
            step = np.arange(0, len(low), FANOUT)
            self.levels.append((low[step], high[np.append(step[1:], len(low)) - 1],
                                np.bitwise_or.reduceat(bits, step, axis=0),
                                np.minimum.reduceat(fewest, step)))

    def children(self, level: int, node: int) -> list[tuple[int, int]]:
        last = len(self.levels[level - 1][0])
        return [(level - 1, i) for i in range(node * FANOUT, min((node + 1) * FANOUT, last))]


def _possible(common_bits, bits_a, bits_b, size_a, size_b, percent: int):
    """Whether sets with these bits can share enough tokens.

    A set with more distinct bits than it has in common with the other side holds at least
    one token for each further bit that the other lacks. Those tokens are in the union and
    not in the intersection.
    """
    only_a = np.maximum(bits_a - common_bits, 0)
    only_b = np.maximum(bits_b - common_bits, 0)
    shared = np.minimum(size_a - only_a, size_b - only_b)
    return (100 - percent) * shared >= percent * (only_a + only_b)


def _leaves(a: Tree, rows: slice, b: Tree, cols: slice, sets, labels: Labels, percent: int, same: bool):
    """Exact counts of the pairs that bitmaps cannot exclude and that aren't connected yet."""
    bits_a, bits_b = a.bits[rows], b.bits[cols]
    common = np.bitwise_count(bits_a[:, None, :] & bits_b[None, :, :]).sum(axis=2, dtype=np.int64)
    size_a, size_b = a.sizes[rows][:, None], b.sizes[cols][None, :]
    open_pairs = _possible(common, a.n_bits[rows][:, None], b.n_bits[cols][None, :], size_a, size_b, percent)
    open_pairs &= (100 * size_a >= percent * size_b) & (100 * size_b >= percent * size_a)
    if same:
        open_pairs &= np.arange(open_pairs.shape[0])[:, None] < np.arange(open_pairs.shape[1])[None, :]
    which_a, which_b = a.which[rows], b.which[cols]
    found = []
    for i in np.flatnonzero(open_pairs.any(axis=1)):
        one = which_a[i]
        for j in np.flatnonzero(open_pairs[i]):
            other = which_b[j]
            if labels.of[one] == labels.of[other]:
                continue
            shared = len(np.intersect1d(sets[one], sets[other], assume_unique=True))
            if 100 * shared >= percent * (len(sets[one]) + len(sets[other]) - shared):
                found.append((int(one), int(other)))
                labels.unite(one, other)
    return found


def join(a: Tree, b: Tree, sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between sets of both trees, enough to connect all sets that links connect.

    Both trees are walked together from their roots. A pair of nodes is dropped when the
    sizes below them are too far apart, when no two sets below them can share enough tokens,
    or when all of them are connected already. Pairs that reach the leaves are counted
    exactly. ``labels`` tells what is connected from the start.
    """
    if not a.levels or not b.levels:
        return []
    found, labels = [], Labels(labels)
    walk = [((len(a.levels) - 1, 0), (len(b.levels) - 1, 0))]
    while walk:
        (la, ia), (lb, ib) = walk.pop()
        low_a, high_a, or_a, few_a = (x[ia] for x in a.levels[la])
        low_b, high_b, or_b, few_b = (x[ib] for x in b.levels[lb])
        if 100 * a.sizes[high_a - 1] < percent * b.sizes[low_b] or 100 * b.sizes[high_b - 1] < percent * a.sizes[low_a]:
            continue
        common = int(np.bitwise_count(or_a & or_b).sum())
        if not _possible(common, few_a, few_b, a.sizes[high_a - 1], b.sizes[high_b - 1], percent):
            continue
        own = labels.of[a.which[low_a]]
        if (labels.of[a.which[low_a:high_a]] == own).all() and (labels.of[b.which[low_b:high_b]] == own).all():
            continue
        if la == 0 and lb == 0:
            found += _leaves(a, slice(low_a, high_a), b, slice(low_b, high_b), sets, labels, percent, a is b and ia == ib)
        elif a is b and la == lb:  # one tree with itself: each pair of children once
            kids, other = a.children(la, ia), b.children(lb, ib)
            walk += [(x, y) for x in kids for y in other if ia != ib or x <= y]
        elif la >= lb:
            walk += [(x, (lb, ib)) for x in a.children(la, ia)]
        else:
            walk += [((la, ia), y) for y in b.children(lb, ib)]
    return found
