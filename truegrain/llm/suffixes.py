"""Deep-shallow sorting of suffixes that are cut at a fixed length.

The shallow part is a multikey quicksort: a range of suffixes is parted in three by the
eight bytes at its depth, smaller, equal and greater than those of a pivot; the equal part
goes on eight bytes deeper. All ranges are parted at the same time, as array operations.
Ranges that still have several suffixes at the shallow depth have a long common prefix;
each of those is ordered by a blind trie, which compares a new suffix with one other only
and finds its place from the first byte in which the two differ.
"""

from __future__ import annotations

import numpy as np

#: Bytes that the quicksort looks at, a multiple of 8.
SHALLOW = 32


class BlindTrie:
    """Suffixes by the places in which they branch; equal ones share a leaf."""

    __slots__ = ("root",)

    def __init__(self):
        self.root = None  # a leaf is (bytes, [members]); a branch [place, {byte: child}]

    def insert(self, suffix: bytes, member: int) -> None:
        node = self.root
        if node is None:
            self.root = (suffix, [member])
            return
        # Down without comparing: by the bytes in which others branch.
        while type(node) is list:
            place, children = node
            node = children.get(suffix[place]) or next(iter(children.values()))
        text, members = node
        if text == suffix:
            members.append(member)
            return
        # The first byte that differs, by halving.
        low, high = 0, len(suffix)
        while high - low > 1:
            middle = (low + high) // 2
            if text[low:middle] == suffix[low:middle]:
                low = middle
            else:
                high = middle
        # Down again to where the branch at this place belongs.
        parent, key, node = None, 0, self.root
        while type(node) is list and node[0] < low:
            parent, key = node, suffix[node[0]]
            node = node[1][key]
        leaf = (suffix, [member])
        if type(node) is list and node[0] == low:
            node[1][suffix[low]] = leaf
            return
        branch = [low, {text[low]: node, suffix[low]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[1][key] = branch

    def classes(self) -> list[list[int]]:
        """Members of equal suffixes together, in ascending order of the suffixes."""
        found, stack = [], [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if type(node) is list:
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                found.append(node[1])
        return found


def _eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number in which the first byte counts most."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)]).astype(np.uint64)
    found = np.zeros(len(raw), np.uint64)
    for i in range(8):
        found |= padded[i : i + len(raw)] << np.uint64(8 * (7 - i))
    return found


def shallow_sort(
    raw: np.ndarray, places: np.ndarray, order: np.ndarray, starts: np.ndarray, shallow: int = SHALLOW
) -> tuple[np.ndarray, np.ndarray]:
    """``order`` sorted inside its ranges by the first ``shallow`` bytes, and where each run of equal ones begins.

    ``order`` indexes ``places``; its ranges begin at ``starts``.
    """
    eights = _eights(raw)
    order = order.copy()
    sizes = np.diff(np.append(starts, len(order)))
    depths = np.zeros(len(starts), np.int64)
    done = [np.zeros(0, np.int64)]
    while len(starts):
        open_ = (sizes > 1) & (depths < shallow)
        done.append(starts[~open_])
        starts, sizes, depths = starts[open_], sizes[open_], depths[open_]
        if not len(starts):
            break
        ends = np.cumsum(sizes)
        own = np.repeat(np.arange(len(starts)), sizes)
        at = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        keys = eights[places[order[at]] + depths[own]]
        three = np.stack([keys[ends - sizes], keys[ends - sizes + sizes // 2], keys[ends - 1]])
        pivots = np.sort(three, axis=0)[1][own]
        side = own * 3 + 1
        side += keys > pivots
        side -= keys < pivots
        order[at] = order[at[np.argsort(side, kind="stable")]]
        counts = np.bincount(side, minlength=3 * len(starts))
        parts = np.arange(3 * len(starts))
        first = np.repeat(starts - (ends - sizes), 3) + np.cumsum(counts) - counts
        depth = np.repeat(depths, 3) + 8 * (parts % 3 == 1)
        full = counts > 0
        starts, sizes, depths = first[full], counts[full], depth[full]
    return order, np.sort(np.concatenate(done))


def suffix_classes(
    raw: bytes, places: np.ndarray, length: int, buckets: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The order of the ``length`` bytes at each of ``places``, and a number of each that equal ones share.

    Numbers ascend in that order. Suffixes of different ``buckets`` are known to differ;
    they are ordered by bucket first. Every place must have ``length`` bytes after it.
    """
    count = len(places)
    if buckets is None:
        order, starts = np.arange(count), np.zeros(min(count, 1), np.int64)
    else:
        order = np.argsort(buckets, kind="stable")
        sorted_ = buckets[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if count else np.zeros(0, np.int64)
    shallow = min(SHALLOW, length // 8 * 8)
    order, starts = shallow_sort(np.frombuffer(raw, np.uint8), places, order, starts, shallow)
    sizes = np.diff(np.append(starts, count))
    # Runs of one are classes; deep runs become as many as the trie finds.
    change = np.zeros(count, np.int64)
    change[starts] = 1
    deep = np.flatnonzero(sizes > 1)
    texts = places + shallow
    for start, size in zip(starts[deep].tolist(), sizes[deep].tolist()):
        part = order[start : start + size].tolist()
        trie = BlindTrie()
        insert = trie.insert
        for member, place in zip(part, texts[part].tolist()):
            insert(raw[place : place + length - shallow], member)
        if type(trie.root) is list:
            classes = trie.classes()
            order[start : start + size] = [m for c in classes for m in c]
            at = start
            for c in classes[:-1]:
                at += len(c)
                change[at] = 1
    numbers = np.empty(count, np.int64)
    numbers[order] = np.cumsum(change) - 1
    return order, numbers
