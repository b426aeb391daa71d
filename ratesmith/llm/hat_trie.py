"""A HAT-trie that counts keys of word ids within bounded memory.

Keys are rows of 64-bit word ids, seen as big-endian bytes, so the order of
bytes is the order of ids.  Under a shallow trie over the leading bytes hang
hash containers; a container that grows too large bursts into a trie node
with smaller containers.  When all containers together hold too many keys,
the largest whole subtrees are taken out as sorted runs, until half is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Keys of one container, and of the whole trie before it spills.
BURST_KEYS, SPILL_KEYS = 8192, 1 << 18

Run = tuple[np.ndarray, np.ndarray]


class _Node(dict):
    """Children by the next byte: nodes or containers (plain dicts)."""


class HatTrie:
    """Counts of rows of ``width`` word ids."""

    def __init__(self, width: int, burst: int = BURST_KEYS, spill: int = SPILL_KEYS):
        self.width, self.burst, self.spill = width, burst, spill
        self.root, self.size = _Node(), 0

    def add(self, columns: list[np.ndarray]) -> tuple[list[bytes], list[int]]:
        """Count one key per row of the columns; returns the distinct keys and
        a row of each."""
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for column in columns:
            ordered = column[order]
            new[1:] |= ordered[1:] != ordered[:-1]
        first = np.flatnonzero(new)
        rows = order[first]
        raw = np.stack([c[rows] for c in columns], axis=1).astype(">u8").tobytes()
        step = 8 * self.width
        keys = [raw[i:i + step] for i in range(0, len(raw), step)]
        if keys:
            counts = np.diff(np.append(first, len(order))).tolist()
            self._insert(self.root, 0, keys, counts, np.frombuffer(raw, np.uint8).reshape(-1, step))
        return keys, rows.tolist()

    def overflow(self) -> Iterator[Run]:
        """The runs to spill now, if the trie is too full."""
        if self.size > self.spill:
            yield from self._spill(self.spill // 2)

    def drain(self) -> Iterator[Run]:
        """All that is left, as runs."""
        yield from self._spill(0)

    def _insert(self, node: _Node, depth: int, keys: list[bytes], counts: list[int],
                matrix: np.ndarray) -> None:
        column = matrix[:, depth]
        cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            byte = int(column[lo])
            child = node.get(byte)
            if isinstance(child, _Node):
                self._insert(child, depth + 1, keys[lo:hi], counts[lo:hi], matrix[lo:hi])
                continue
            if child is None:
                child = node[byte] = {}
            before, get = len(child), child.get
            for key, n in zip(keys[lo:hi], counts[lo:hi], strict=True):
                child[key] = get(key, 0) + n
            self.size += len(child) - before
            if len(child) > self.burst and depth + 1 < 8 * self.width:
                node[byte] = self._burst(child, depth + 1)

    def _burst(self, container: dict[bytes, int], depth: int) -> _Node:
        node = _Node()
        for key, n in container.items():
            node.setdefault(key[depth], {})[key] = n
        return node

    def _items(self, child: dict) -> Iterator[tuple[bytes, int]]:
        if isinstance(child, _Node):
            for below in child.values():
                yield from self._items(below)
        else:
            yield from child.items()

    def _count(self, child: dict) -> int:
        if isinstance(child, _Node):
            return sum(self._count(below) for below in child.values())
        return len(child)

    def _spill(self, most: int) -> Iterator[Run]:
        sizes = sorted(((self._count(c), b) for b, c in self.root.items()), reverse=True)
        taken: list[int] = []
        for size, byte in sizes:
            if self.size <= most:
                break
            taken.append(byte)
            self.size -= size
        keys: list[bytes] = []
        counts: list[int] = []
        for byte in sorted(taken):
            for key, n in self._items(self.root.pop(byte)):
                keys.append(key)
                counts.append(n)
        if keys:
            rows = np.frombuffer(b"".join(keys), ">u8").reshape(-1, self.width).astype(np.uint64)
            order = np.lexsort(rows.T[::-1])
            yield rows[order], np.array(counts, np.int64)[order]
