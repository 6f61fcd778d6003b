"""A compressed radix trie over byte strings that can put subtrees on disk."""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Callable, Iterator
from typing import Any

Merge = Callable[[Any, Any], Any]


class _Node:
    __slots__ = ("children", "label", "payload", "spill")

    def __init__(self, label: bytes, payload: Any = None):
        self.label = label
        self.payload = payload
        self.children: dict[int, _Node] = {}
        self.spill = None


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of `a` and `b[at:]`, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _unspilled(node: _Node) -> Iterator[tuple[bytes, Any]]:
    """What a subtree has on disk; the file goes."""
    file, node.spill = node.spill, None
    with file:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


class Patricia:
    """Maps byte strings to payloads; `merge` joins the payloads of equal strings.

    Beyond `budget` bytes of labels the largest subtree below the first fork goes
    to a file in the task's own folder. Later strings that reach it are appended
    there, and its contents are built into a trie of their own at the end.
    """

    def __init__(self, merge: Merge, budget: int = 256 << 20):
        self.merge, self.budget, self.held = merge, budget, 0
        self.root = _Node(b"")

    def insert(self, key: bytes, payload: Any) -> Any:
        """The merged payload, or None if the string went to disk."""
        node, at = self.root, 0
        while True:
            if node.spill:
                pickle.dump((key[at:], payload), node.spill)
                return None
            if at == len(key):
                node.payload = payload if node.payload is None else self.merge(node.payload, payload)
                return node.payload
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = _Node(key[at:], payload)
                self.held += len(key) - at + 200
                if self.held > self.budget:
                    self._spill()
                return payload
            if key.startswith(child.label, at):
                at += len(child.label)
                node = child
                continue
            same = _common(child.label, key, at)
            fork = _Node(child.label[:same])
            child.label = child.label[same:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            self.held += 200
            at += same
            node = fork

    def items(self) -> Iterator[Any]:
        """The payload of every string, spilled ones included."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node.payload is not None:
                yield node.payload
            stack.extend(node.children.values())
            if node.spill:
                yield from self._reread(node)

    def _reread(self, node: _Node) -> Iterator[Any]:
        sub = Patricia(self.merge, self.budget)
        for key, payload in _unspilled(node):
            sub.insert(key, payload)
        yield from sub.items()

    def _spill(self) -> None:
        while self.held > self.budget // 2:
            node = self.root
            while len(live := [c for c in node.children.values() if not c.spill]) == 1 and not node.payload:
                if not live[0].children:
                    break
                node = live[0]
            sized = [(self._size(c), c) for c in live if c.children]
            if not sized:
                # Only single strings are left below this fork: each must be held whole anyway.
                self.budget = max(self.budget, 2 * self.held)
                return
            freed, child = max(sized, key=lambda x: x[0])
            file = tempfile.TemporaryFile(dir=os.environ.get("TMPDIR"))
            for entry in self._entries(child):
                pickle.dump(entry, file)
            child.children, child.payload, child.spill = {}, None, file
            self.held -= freed

    def _size(self, top: _Node) -> int:
        """Bytes held below `top`."""
        size, stack = 0, [top]
        while stack:
            children = stack.pop().children.values()
            size += sum(len(c.label) + 200 for c in children)
            stack.extend(children)
        return size

    def _entries(self, top: _Node) -> Iterator[tuple[bytes, Any]]:
        """Strings below `top`, without its own label, one at a time."""
        stack = [(top, b"")]
        while stack:
            node, prefix = stack.pop()
            if node.payload is not None:
                yield prefix, node.payload
            if node.spill:
                for key, payload in _unspilled(node):
                    yield prefix + key, payload
            stack.extend((child, prefix + child.label) for child in node.children.values())
