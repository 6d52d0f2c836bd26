"""Compressed (radix) trie of byte strings whose terminals hold the least id of their string.

An edge carries as many bytes as its strings share; a node has a child per next byte.  Inserting a string that is
there already adds no node, so the memory follows the distinct strings.  Any byte string is allowed, the empty
one and one that is a prefix of others too.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator


class Node:
    __slots__ = ("label", "children", "least", "groups")

    def __init__(self, label: bytes) -> None:
        self.label = label
        self.children: dict[int, Node] | None = None
        self.least: int | None = None
        self.groups: array | None = None  # the groups that ended here; None: not a terminal


def shared(a: bytes, b: bytes, at: int) -> int:
    """Number of leading bytes that ``a`` and ``b[at:]`` share."""
    low, high = 0, min(len(a), len(b) - at)
    if a[:high] == b[at:at + high]:
        return high
    while low + 1 < high:  # a[:low] agrees, a[:high] does not
        middle = (low + high) // 2
        if a[low:middle] == b[at + low:at + middle]:
            low = middle
        else:
            high = middle
    return low


class Trie:
    def __init__(self) -> None:
        self.root = Node(b"")
        self.nodes = 1

    def insert(self, text: bytes, group: int, least: int | None) -> None:
        """Ends ``group``, whose smallest id is ``least`` (None: no id), at the terminal of ``text``."""
        node, at = self.root, 0
        while at < len(text):
            if node.children is None:
                node.children = {}
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.nodes += 1
            elif not text.startswith(child.label, at):
                k = shared(child.label, text, at)
                upper = Node(child.label[:k])
                upper.children = {child.label[k]: child}
                child.label = child.label[k:]
                node.children[text[at]] = child = upper
                self.nodes += 1
            at += len(child.label)
            node = child
        if node.groups is None:
            node.groups = array("q")
        node.groups.append(group)
        if least is not None and (node.least is None or least < node.least):
            node.least = least

    def terminals(self) -> Iterator[tuple[array, int | None]]:
        """(groups, least id) of every string, in byte order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.groups is not None:
                yield node.groups, node.least
            if node.children:
                stack.extend(node.children[b] for b in sorted(node.children, reverse=True))
