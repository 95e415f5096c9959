r"""Ordering windows of bytes by deep-shallow sorting.

A window is WINDOW bytes of some data.  The shallow part is multikey quicksort with eight bytes as one character: a segment is parted
around a pivot in smaller, equal and larger, and the equal part goes on with the next character; segments of up to SMALL windows are put
in order together, one character at a time.  It ends SHALLOW bytes deep.  Windows that agree so far are a deep group: a blind trie,
which keeps branching depths and bytes alone, takes them one after another and compares each with one other window; its leaves in
order are the group in order, and a leaf of several windows is a class of equal ones.  A trie of two windows is a single comparison, made for all
such groups at once.
"""

from __future__ import annotations

import numpy as np

WINDOW = 100
#: Bytes in one character of the quicksort.
CHAR = 8
SHALLOW = 16
SMALL = 4096


class BlindTrie:
    """Windows in order.  An inner node is [depth, {byte: child}], a leaf the list of its equal windows; what lies between branchings is skipped."""

    def __init__(self, data: bytes, first: int):
        self.data, self.root = data, [first]

    def insert(self, start: int) -> None:
        data, node = self.data, self.root
        while type(node[-1]) is dict:
            depth, children = node
            node = children.get(data[start + depth]) or next(iter(children.values()))
        own, other = data[start : start + WINDOW], data[node[0] : node[0] + WINDOW]
        if own == other:
            node.append(start)
            return
        differing = (int.from_bytes(own, "big") ^ int.from_bytes(other, "big")).bit_length()
        apart = WINDOW - (differing + 7) // 8  # the first byte that differs
        parent, node = None, self.root
        while type(node[-1]) is dict and node[0] < apart:
            parent, node = node, node[1][own[node[0]]]
        if type(node[-1]) is dict and node[0] == apart:
            node[1][own[apart]] = [start]
            return
        branch = [apart, {other[apart]: node, own[apart]: [start]}]
        if parent is None:
            self.root = branch
        else:
            parent[1][own[parent[0]]] = branch

    def leaves(self) -> list[list[int]]:
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if type(node[-1]) is dict:
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def characters(data: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as one number; data ends with as many spare bytes."""
    out = np.zeros(len(data) - CHAR, np.uint64)
    for i in range(CHAR):
        out = out << np.uint64(8) | data[i : len(out) + i]
    return out


def shallow(chars: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order the windows of each of some segments, which follow one another, by SHALLOW bytes.

    Gives the starts in order and the bounds of runs that agree: run i is from bounds[i] to bounds[i + 1].
    """
    order = starts.copy()
    level = np.zeros(len(order), np.int8)  # characters that a small segment's windows are known to share
    small_at: list[tuple[int, int, int]] = []
    ends = np.cumsum(sizes)
    todo = [(int(b - n), int(b), 0) for b, n in zip(ends, sizes)]
    while todo:
        low, high, depth = todo.pop()
        if high - low <= SMALL or depth == SHALLOW // CHAR:
            small_at.append((low, high, depth))
            continue
        part = order[low:high]
        key = chars[part + depth * CHAR]
        pivot = np.sort(key[:: max(1, len(key) // 9)])[4]
        less, equal = key < pivot, key == pivot
        order[low:high] = np.concatenate((part[less], part[equal], part[~less & ~equal]))
        a = low + int(np.count_nonzero(less))
        b = a + int(np.count_nonzero(equal))
        todo += [(x, y, d) for x, y, d in ((low, a, depth), (a, b, depth + 1), (b, high, depth)) if x < y]
    small_at.sort()
    run = np.zeros(len(order), np.int64)
    for i, (low, high, depth) in enumerate(small_at):
        run[low:high], level[low:high] = i, depth
    for depth in range(SHALLOW // CHAR):
        open_ = np.flatnonzero(level <= depth)
        if not len(open_):
            continue
        key = chars[order[open_] + depth * CHAR]
        by = np.lexsort((key, run[open_]))
        order[open_] = order[open_][by]
        key, own = key[by], run[open_]  # runs lie one behind another, so theirs stay in place
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (key[1:] != key[:-1])))
        fresh = np.zeros(len(order), bool)
        fresh[open_] = new
        fresh[1:] |= run[1:] != run[:-1]
        fresh[0] = True
        run = np.cumsum(fresh) - 1
    return order, np.append(np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1]))), len(order))


def equal_windows(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows of each segment in order, and for each the number of its class of equal ones within the segment.

    data holds CHAR spare bytes behind the last window; classes are numbered in the order of the windows.
    """
    if not len(starts):
        return starts, starts
    chars = characters(np.frombuffer(data, np.uint8))
    order, bounds = shallow(chars, starts, sizes)
    new = np.zeros(len(order), bool)
    new[bounds[:-1]] = True
    count = np.diff(bounds)
    twos = bounds[:-1][count == 2]
    if len(twos):
        a, b = order[twos], order[twos + 1]
        apart, swap = np.zeros(len(twos), bool), np.zeros(len(twos), bool)
        for depth in [*range(SHALLOW, WINDOW - CHAR, CHAR), WINDOW - CHAR]:
            x, y = chars[a + depth], chars[b + depth]
            swap |= ~apart & (x > y)
            apart |= x != y
        order[twos], order[twos + 1] = np.where(swap, b, a), np.where(swap, a, b)
        new[twos + 1] = apart
    for low, high in zip(bounds[:-1][count > 2].tolist(), bounds[1:][count > 2].tolist()):
        members = order[low:high].tolist()
        trie = BlindTrie(data, members[0])
        for start in members[1:]:
            trie.insert(start)
        at = low
        for leaf in trie.leaves():
            order[at : at + len(leaf)] = leaf
            new[at], new[at + 1 : at + len(leaf)] = True, False
            at += len(leaf)
    return order, np.cumsum(new) - 1
