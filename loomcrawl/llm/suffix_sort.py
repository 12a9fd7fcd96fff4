"""Deep-shallow sorting of many groups of byte strings at once.

A multikey quicksort orders every group to a shallow depth: strings are split in three by a pivot's next
eight bytes, those equal to it move on by eight bytes, and all groups take each step together in numpy. What
still shares its first bytes then, a group with a long common prefix, is ordered by a blind trie.
"""

from __future__ import annotations

import numpy as np

LANE = 8


def multikey_quicksort(lanes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in the order of (group, their lanes), and for each place the number of its run of equal rows.

    lanes: a row a string, eight bytes a number, the first byte highest; group: a number for each row.
    """
    order = np.argsort(group, kind="stable")
    run = np.cumsum(np.concatenate(([0], np.diff(group[order]) != 0)))
    depth = np.zeros(run[-1] + 1 if len(run) else 0, np.int64)
    while True:
        size = np.bincount(run, minlength=len(depth))
        live = (size > 1) & (depth < lanes.shape[1])
        at = np.flatnonzero(live[run])
        if not len(at):
            return order, run
        first = np.cumsum(size) - size
        of = run[at]
        value = lanes[order[at], depth[of]]
        pivot = lanes[order[first + size // 2], np.minimum(depth, lanes.shape[1] - 1)][of]
        side = (value == pivot) + 2 * (value > pivot)
        order[at] = order[at][np.lexsort((side, of))]
        # a run in three: its parts keep their depth, the equal one goes on
        part = 3 * run
        part[at] = np.sort(3 * of + side)
        edge = np.concatenate(([True], part[1:] != part[:-1]))
        equal = live[part[edge] // 3] & (part[edge] % 3 == 1)
        depth = depth[part[edge] // 3] + equal
        run = np.cumsum(edge) - 1


def common_prefix(a: bytes, b: bytes) -> int:
    if a == b:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


class BlindTrie:
    """Strings of one length, known by the bytes at which they branch; a whole string is compared once an insertion.

    A node is [depth, {byte: node or leaf}], a leaf the list of the places of equal strings.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, [0]
        for i in range(1, len(strings)):
            self._add(i)

    def _add(self, i: int) -> None:
        s, node = self.strings[i], self.root
        while len(node) == 2 and isinstance(node[1], dict):  # any leaf below agrees as far as s goes along
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        shared = common_prefix(s, other)
        if shared == len(s):
            node.append(i)
            return
        parent, node = None, self.root
        while len(node) == 2 and isinstance(node[1], dict) and node[0] < shared:
            parent, node = node, node[1][s[node[0]]]
        if len(node) == 2 and isinstance(node[1], dict) and node[0] == shared:
            node[1][s[shared]] = [i]
            return
        branch = [shared, {s[shared]: [i], other[shared]: node}]
        if parent is None:
            self.root = branch
        else:
            parent[1][s[parent[0]]] = branch

    def order(self) -> list[int]:
        """Places of the strings in their order."""
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if len(node) == 2 and isinstance(node[1], dict):
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]
            else:
                out += node
        return out


def deep_shallow(strings: np.ndarray, group: np.ndarray, shallow: int) -> np.ndarray:
    """The order of rows of bytes within their groups (groups by number); shallow: bytes that quicksort looks at."""
    n = min(shallow, strings.shape[1]) // LANE
    lanes = np.ascontiguousarray(strings[:, : n * LANE]).view(">u8").astype(np.uint64)
    order, run = multikey_quicksort(lanes, group)
    size = np.bincount(run) if len(run) else np.empty(0, np.int64)
    first = np.cumsum(size) - size
    rest = np.ascontiguousarray(strings[:, n * LANE :])
    for k in np.flatnonzero(size > 1).tolist():
        here = slice(first[k], first[k] + size[k])
        some = order[here]
        order[here] = some[BlindTrie([r.tobytes() for r in rest[some]]).order()]
    return order


def shared_with_previous(strings: np.ndarray, group: np.ndarray, order: np.ndarray) -> np.ndarray:
    """In the order: how many first bytes each row shares with the one before it; -1 where its group begins."""
    out = np.full(len(order), -1, np.int64)
    for k in range(1, len(order), 1 << 14):
        a, b = order[k - 1 : k - 1 + (1 << 14)], order[k : k + (1 << 14)]
        unlike = strings[a[: len(b)]] != strings[b]
        shared = np.where(unlike.any(axis=1), unlike.argmax(axis=1), strings.shape[1])
        out[k : k + len(b)] = np.where(group[a[: len(b)]] == group[b], shared, -1)
    return out
