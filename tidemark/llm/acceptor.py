"""Minimal acceptors of word lists, and their composition with a one-edit transducer.

An acceptor holds many lists at once, each behind an initial state of its own. States
with the same right language are one state, found level by level from the longest
words' ends by 128-bit fingerprints of (final, arcs). Each state knows how many words
lie behind it and each arc how many come before it, so that the sum along a path is
the word's place in its sorted list.

The transducer copies symbols, makes one edit (replaces a symbol, or leaves one out)
and copies on. A pair of words has one accepting path: the edit is made where the two
first differ. States of the composition are (state, edited, state); all of one level
are moved on together as arrays, and those whose two sides cannot end together, by
the lengths or the next symbols behind them, are dropped.
"""

from __future__ import annotations

import numpy as np

def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A well-spread 64-bit value of each number."""
    x = x.astype(np.uint64) + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _each(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: the group of every member, and its place in it."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _rolled(mask: np.ndarray) -> np.ndarray:
    return (mask << np.uint64(1)) | (mask >> np.uint64(63))


def _bit(n: np.ndarray) -> np.ndarray:
    return np.uint64(1) << (n & 63).astype(np.uint64)


class Acceptor:
    """Of `words`, a matrix of symbols (from 1, 0 behind the end), sorted by (`lists`,
    symbols) and distinct; `lists` numbers the list of each row from 0."""

    def __init__(self, words: np.ndarray, lists: np.ndarray):
        n, width = words.shape
        self.symbols = int(words.max(initial=0)) + 1
        lengths = (words > 0).sum(axis=1)
        same = (words[1:] == words[:-1]) & (words[1:] > 0)
        common = np.concatenate([[-1], np.where(np.diff(lists) > 0, -1, np.cumprod(same, axis=1).sum(axis=1))])
        self._known: dict[tuple[int, int], int] = {}
        self._parts: list[tuple[np.ndarray, ...]] = []
        below = (np.empty(0, np.int64),) * 2  # rows and states of the nodes one level further down
        self.final, self.count, self.ends, self.next = (np.empty(0, t) for t in (bool, np.int64, np.uint64, np.uint64))
        for depth in range(width, -1, -1):
            rows = np.flatnonzero(lengths >= depth)
            opens = rows[common[rows] < depth]  # the first row of every node, in order
            below = opens, self._level(depth, opens, lengths, words, *below)
        self.initial = below[1]  # one node of depth 0 a list
        self._arcs()

    def _level(self, depth, opens, lengths, words, children, child_state):
        """States of the nodes that start at rows `opens`."""
        final = lengths[opens] == depth
        parent = np.searchsorted(opens, children, side="right") - 1
        symbol = words[children, depth] if len(children) else np.empty(0, np.int64)
        arc = child_state * self.symbols + symbol
        prints = []
        for seed in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03):
            summed = np.where(final, np.uint64(seed >> 1), np.uint64(0))
            np.add.at(summed, parent, _mixed(arc, seed))
            prints.append(summed)
        both = np.stack(prints, axis=1)
        order = np.lexsort((both[:, 1], both[:, 0]))
        sorted_prints = both[order]
        fresh = np.concatenate([[True], (sorted_prints[1:] != sorted_prints[:-1]).any(axis=1)])
        kind = np.empty(len(opens), np.int64)
        kind[order] = np.cumsum(fresh) - 1
        which = order[fresh]
        ids, new = np.empty(len(which), np.int64), []
        for i in np.argsort(which).tolist():  # new states are numbered in the order of their nodes
            known = len(self._known)
            ids[i] = self._known.setdefault(tuple(both[which[i]].tolist()), known)
            if ids[i] == known:
                new.append(which[i])
        state = ids[kind]
        if new:
            self._add(np.array(new), final, parent, symbol, child_state, state)
        return state

    def _add(self, nodes, final, parent, symbol, child_state, state) -> None:
        """New states with the arcs of the nodes that stand for them."""
        held = np.isin(parent, nodes)
        of, target, symbol = np.searchsorted(nodes, parent[held]), child_state[held], symbol[held]
        # Arcs come in the order of their rows, which is that of their symbols.
        size = self.count[target]
        before = np.cumsum(size) - size
        first = np.searchsorted(of, of)
        self._parts.append((state[nodes][of], symbol, target, before - before[first] + final[nodes][of]))
        count, ends, follow = final[nodes].astype(np.int64), final[nodes].astype(np.uint64), np.zeros(len(nodes), np.uint64)
        np.add.at(count, of, size)
        np.bitwise_or.at(ends, of, _rolled(self.ends[target]))
        np.bitwise_or.at(follow, of, _bit(symbol))
        self.final = np.concatenate([self.final, final[nodes]])
        self.count = np.concatenate([self.count, count])
        self.ends = np.concatenate([self.ends, ends])
        self.next = np.concatenate([self.next, follow])

    def _arcs(self) -> None:
        of, symbol, target, offset = (np.concatenate(x).astype(np.int64) for x in zip(*self._parts))
        order = np.argsort(of * self.symbols + symbol)
        self.key = (of * self.symbols + symbol)[order]
        self.symbol, self.target, self.offset = symbol[order], target[order], offset[order]
        self.fan = np.bincount(of, minlength=len(self.final))
        self.first = np.cumsum(self.fan) - self.fan

    def along(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All arcs of the states: which state of the argument, and the arc."""
        group, place = _each(self.fan[state])
        return group, self.first[state][group] + place

    def step(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The arc that reads the symbol, or -1."""
        wanted = state * self.symbols + symbol
        at = np.minimum(np.searchsorted(self.key, wanted), max(len(self.key) - 1, 0))
        return np.where(self.key[at] == wanted, at, -1) if len(self.key) else np.full(len(state), -1)


def one_edit_pairs(acceptor: Acceptor, base: np.ndarray, longest: np.ndarray, within: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (longer, shorter) of all pairs of words in one list that one edit at a
    place below `within` turns into each other, the first or only longer one having
    `longest` symbols. For each list: `base` is its first row. Words of a list have
    `longest` symbols or one less. The caller tells pairs of the two lengths apart."""
    a = acceptor
    out: list[tuple[np.ndarray, np.ndarray]] = []
    state, row, left, room = a.initial, base, longest, within
    edited = _none()
    while len(state) or len(edited[0]):
        edited = _copied(a, edited, out)
        live = room > 0
        state, row, left, room = state[live], row[live], left[live], room[live]
        group, arc = a.along(state)
        to, at, gone, over = a.target[arc], row[group] + a.offset[arc], left[group] - 1, room[group] - 1
        made = [edited]
        # Two arcs of one state: a symbol is replaced.
        fan = a.fan[state]
        place = np.arange(len(arc)) - np.repeat(np.cumsum(fan) - fan, fan)
        one, further = _each(fan[group] - place - 1)
        two = one + 1 + further
        made.append((to[one], at[one], to[two], at[two], gone[one], np.full(len(one), -1)))
        # An arc and the state itself: the symbol is left out, and not read next.
        made.append((to, at, state[group], row[group], gone, a.symbol[arc]))
        edited = _possible(a, tuple(np.concatenate(x) for x in zip(*made)))
        state, row, left, room = to, at, gone, over
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _none() -> tuple[np.ndarray, ...]:
    return (np.empty(0, np.int64),) * 6


def _possible(a: Acceptor, pairs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Those whose sides can both end after the symbols left."""
    one, _, two, _, left, _ = pairs
    both = a.ends[one] & a.ends[two] & _bit(left)
    ends = a.final[one] & a.final[two]
    kept = (both != 0) & (ends | ((a.next[one] & a.next[two]) != 0))
    return tuple(x[kept] for x in pairs)


def _copied(a: Acceptor, pairs: tuple[np.ndarray, ...], out: list) -> tuple[np.ndarray, ...]:
    """Report edited pairs that end here, and read one symbol on both sides of the others."""
    one, at_one, two, at_two, left, barred = pairs
    # The same right language on both sides: every word of it.
    alike = one == two
    group, more = _each(a.count[one[alike]])
    out.append((at_one[alike][group] + more, at_two[alike][group] + more))
    ends = ~alike & a.final[one] & a.final[two]
    out.append((at_one[ends], at_two[ends]))
    one, at_one, two, at_two, left, barred = (x[~alike] for x in pairs)
    group, arc = a.along(one)
    other = a.step(two[group], a.symbol[arc])
    met = (other >= 0) & (a.symbol[arc] != barred[group])
    group, arc, other = group[met], arc[met], other[met]
    moved = a.target[arc], at_one[group] + a.offset[arc], a.target[other], at_two[group] + a.offset[other]
    return _possible(a, (*moved, left[group] - 1, np.full(len(group), -1)))
