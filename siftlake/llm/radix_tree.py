"""An adaptive radix tree over byte strings: nodes of four layouts that grow with their number of children, compressed paths."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

# How many children the layouts hold.
SIZES = (4, 16, 48, 256)


class Sorted:
    """Up to 4 or 16 children: their bytes in order, and the children in the same order."""

    __slots__ = ("room", "keys", "kids")

    def __init__(self, room: int):
        self.room, self.keys, self.kids = room, bytearray(), []

    def find(self, byte: int):
        at = bisect_left(self.keys, byte)
        return self.kids[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, kid):
        """Add or replace a child; the layout that holds it now."""
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.kids[at] = kid
            return self
        if len(self.keys) == self.room:
            grown = Sorted(SIZES[1]) if self.room == SIZES[0] else Indexed()
            for old, child in self.items():
                grown.put(old, child)
            return grown.put(byte, kid)
        self.keys.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def items(self) -> Iterator:
        return zip(self.keys, self.kids, strict=True)


class Indexed:
    """Up to 48 children: for each byte the place of its child, counted from 1."""

    __slots__ = ("places", "kids")

    def __init__(self):
        self.places, self.kids = bytearray(256), []

    def find(self, byte: int):
        place = self.places[byte]
        return self.kids[place - 1] if place else None

    def put(self, byte: int, kid):
        if place := self.places[byte]:
            self.kids[place - 1] = kid
            return self
        if len(self.kids) == SIZES[2]:
            grown = Direct()
            for old, child in self.items():
                grown.put(old, child)
            return grown.put(byte, kid)
        self.kids.append(kid)
        self.places[byte] = len(self.kids)
        return self

    def items(self) -> Iterator:
        return ((byte, self.kids[place - 1]) for byte, place in enumerate(self.places) if place)


class Direct:
    """A place for every byte."""

    __slots__ = ("kids",)

    def __init__(self):
        self.kids = [None] * SIZES[3]

    def find(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def items(self) -> Iterator:
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


class Node:
    """``path``: the bytes that all keys below share after the byte that leads here; ``value`` of the key that ends here."""

    __slots__ = ("path", "below", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.below, self.value = path, None, value

    def put(self, byte: int, kid: Node) -> None:
        self.below = (self.below or Sorted(SIZES[0])).put(byte, kid)


def _shared(a: bytes, key: bytes, at: int) -> int:
    """How many bytes ``a`` shares with ``key`` from ``at`` on."""
    if key.startswith(a, at):
        return len(a)
    low, high = 0, min(len(a), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Tree:
    """Keys and their values. A key may begin with another."""

    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        if self.root is None:
            self.root = Node(key, value)
            return
        node, above, by, at = self.root, None, 0, 0
        while True:
            n = _shared(node.path, key, at)
            if n < len(node.path):
                split = Node(node.path[:n])
                split.put(node.path[n], node)
                node.path = node.path[n + 1 :]
                if above is None:
                    self.root = split
                else:
                    above.put(by, split)
                node = split
            at += n
            if at == len(key):
                node.value = value
                return
            kid = node.below.find(key[at]) if node.below is not None else None
            if kid is None:
                node.put(key[at], Node(key[at + 1 :], value))
                return
            above, by, node, at = node, key[at], kid, at + 1

    def find(self, key: bytes):
        node, at = self.root, 0
        while node is not None:
            if not key.startswith(node.path, at):
                return None
            at += len(node.path)
            if at == len(key):
                return node.value
            node, at = node.below.find(key[at]) if node.below is not None else None, at + 1
        return None
