"""A context-mixing range coder for token ids.

Ids are cut into blocks that are coded alone. The frequencies of an id mix three
predictions: how often it occurs among all blocks of the call (order 0, known to both
sides), and the ids last seen after the previous one and the previous two ids (orders
1 and 2), which add weight to the id they expect, the more the more often they were
right. What orders 1 and 2 have seen starts anew in each block.

All blocks of a call advance together, one numpy lane each and one id at a time, so
the coder costs array operations instead of a loop over ids. Positions within the
coding interval are whole numbers below 2**53 held as doubles, whose division is the
fast one; a quotient of such numbers below 2**48 cannot round up to the next whole
number.
"""

from __future__ import annotations

import zlib

import numpy as np

SLOTS = 1024  # contexts a block remembers, by order
# Weight of a prediction, in multiples of the order-0 total, by how often it was right.
WEIGHTS = np.array([0, 0.2, 0.5, 1, 2, 5, 12, 24], np.float64)
SURE, BITS = len(WEIGHTS) - 1, (len(WEIGHTS) - 1).bit_length()
# What that number changes by after a wrong prediction, and after a right one.
CHANGE = np.array([0] + [-1] * SURE + [1] * SURE + [0], np.int32)
SCALE = 20  # bits of the order-0 total, if the ids are not too many
WORD, LOW, TOP = 2.0**16, 2.0**32, 2.0**48
HEAD = 3  # 16-bit words that open a block's code


def starts(symbols: int, counts: np.ndarray | None = None) -> np.ndarray:
    """Where each id begins on the order-0 scale, and its end: shares by `counts`, one
    at least, whose sum is a power of two. Without counts all ids are alike."""
    if symbols > 1 << 22:
        raise ValueError("too many ids for the coding interval")
    counts = np.ones(symbols, np.int64) if counts is None else np.asarray(counts, np.int64)
    scale = 1 << max(SCALE, symbols.bit_length() + 1)
    # Shares of a sum of 32 bits at most, so that the products fit 63.
    counts = counts >> max(0, int(counts.sum()).bit_length() - 32)
    sizes = 1 + counts * (scale - symbols) // max(1, int(counts.sum()))
    sizes[np.argmax(sizes)] += scale - int(sizes.sum())
    return np.concatenate([[0], np.cumsum(sizes)])


class _Model:
    """Predictions of all lanes, those of order 1 in the first row and those of order 2
    in the second; the `active` lanes come first."""

    def __init__(self, lanes: int, symbols: int, counts: np.ndarray | None):
        whole = starts(symbols, counts)
        self.scale = float(whole[-1])
        self.start, self.size = whole[:-1].astype(np.float64), np.diff(whole).astype(np.float64)
        self.weights = np.floor(WEIGHTS * self.scale)
        self.first_slot = np.arange(2 * lanes).reshape(2, lanes) * SLOTS
        # Expected id and, in the lowest bits, how sure it is.
        self.cells = np.zeros(2 * lanes * SLOTS, np.int32)
        self.last, self.second = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def look(self, active: int) -> np.ndarray:
        """Let orders 1 and 2 say what they expect next; the total of the frequencies."""
        mixed = self.last[:active] * 40503
        self.slots = np.empty((2, active), np.int64)
        np.right_shift(mixed, 4, out=self.slots[0])
        np.right_shift(mixed + self.second[:active], 3, out=self.slots[1])
        self.slots &= SLOTS - 1
        self.slots += self.first_slot[:, :active]
        self.found = self.cells.take(self.slots)
        self.held = self.found & SURE
        self.expected = self.found >> BITS
        self.added = self.weights.take(self.held)
        return self.added[0] + self.added[1] + self.scale

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of ids among the mixed frequencies."""
        self.right = self.expected == ids
        below, equal = self.added * (self.expected < ids), self.added * self.right
        return self.start.take(ids) + below[0] + below[1], self.size.take(ids) + equal[0] + equal[1]

    def plain(self, aim: np.ndarray) -> np.ndarray:
        """A place among the mixed frequencies on the order-0 scale: what a prediction
        has added lies at the start of its id and is taken out again."""
        (one, two), (first, second) = self.expected, self.added
        for begin, added in ((self.start.take(two) + first * (one < two), second), (self.start.take(one), first)):
            aim = np.minimum(aim, np.maximum(aim - added, begin))
        return aim

    def learn(self, ids: np.ndarray, active: int) -> None:
        """A right prediction gets surer, a wrong one less so, and then gives way."""
        state = self.held + (SURE + 1) * self.right
        self.cells[self.slots] = np.where(state > 0, self.found + CHANGE.take(state), (ids << BITS) + 1)
        self.second[:active] = self.last[:active] * 48271
        self.last[:active] = ids


def _shape(n: int, block: int) -> tuple[int, int, int]:
    """Blocks, steps, and the length of the last block."""
    blocks = max(1, -(-n // block))
    return blocks, min(n, block), n - (blocks - 1) * block


def encode(ids: np.ndarray, block: int, symbols: int, counts: np.ndarray | None = None) -> list[bytes]:
    """The code of each block of `block` ids; the last one may be shorter. `counts`
    says how often each id occurs, nearly or at all."""
    n = len(ids)
    if not n:
        return []
    if int(ids.min()) < 0 or int(ids.max()) >= symbols:
        raise ValueError("an id outside the vocabulary")
    blocks, steps, rest = _shape(n, block)
    grid = np.zeros(blocks * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(blocks, steps).T)
    model = _Model(blocks, symbols, counts)
    low, span = np.zeros(blocks), np.full(blocks, TOP - 1)
    # No id costs more than two words.
    room = 2 * steps + 2 * HEAD
    out, first = np.zeros(blocks * room, np.uint16), np.arange(blocks) * room
    at = first.copy()

    def carry(place: np.ndarray) -> None:
        while len(place):
            out[place] += np.uint16(1)
            place = place[out[place] == 0] - 1

    for step in range(steps):
        active = blocks if step < rest else blocks - 1
        symbol = grid[step, :active]
        now_low, now_span = low[:active], span[:active]
        unit = np.floor(now_span / model.look(active))
        start, size = model.interval(symbol)
        now_low += unit * start
        np.multiply(unit, size, out=now_span)
        over = np.flatnonzero(now_low >= TOP)
        if len(over):
            carry(at[over] - 1)
            low[over] -= TOP
        small = np.flatnonzero(now_span < LOW)
        while len(small):
            own, place = low[small], at[small]
            word = np.floor(own / LOW)
            out[place] = word
            at[small] = place + 1
            low[small] = (own - word * LOW) * WORD
            span[small] *= WORD
            small = small[span[small] < LOW]
        model.learn(symbol, active)
    for _ in range(HEAD):
        word = np.floor(low / LOW)
        out[at] = word
        at += 1
        low = (low - word * LOW) * WORD
    return [out[a:b].astype("<u2").tobytes() for a, b in zip(first.tolist(), at.tolist())]


def decode(codes: list[bytes], n: int, block: int, symbols: int, counts: np.ndarray | None = None) -> np.ndarray:
    """The ids that `encode` made `codes` from."""
    if not n:
        return np.zeros(0, np.int64)
    blocks, steps, rest = _shape(n, block)
    words = [np.frombuffer(c, "<u2") for c in codes]
    longest = max(map(len, words)) + 4
    given = np.zeros(blocks * longest)
    for i, w in enumerate(words):
        given[i * longest : i * longest + len(w)] = w
    model = _Model(blocks, symbols, counts)
    ids_at = np.repeat(np.arange(symbols, dtype=np.int32), model.size.astype(np.int64))
    at = np.arange(blocks) * longest
    code, span = np.zeros(blocks), np.full(blocks, TOP - 1)
    for _ in range(HEAD):
        code = code * WORD + given[at]
        at = at + 1
    grid = np.zeros((steps, blocks), np.int64)
    for step in range(steps):
        active = blocks if step < rest else blocks - 1
        now_code, now_span = code[:active], span[:active]
        total = model.look(active)
        unit = np.floor(now_span / total)
        aim = np.minimum(np.floor(now_code / unit), total - 1)
        symbol = ids_at.take(model.plain(aim).astype(np.int64))
        start, size = model.interval(symbol)
        now_code -= unit * start
        np.multiply(unit, size, out=now_span)
        small = np.flatnonzero(now_span < LOW)
        while len(small):
            place = at[small]
            code[small] = code[small] * WORD + given[place]
            at[small] = place + 1
            span[small] *= WORD
            small = small[span[small] < LOW]
        grid[step, :active] = symbol
        model.learn(symbol, active)
    return grid.T.reshape(-1)[:n]


def checksum(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids).astype("<u4").tobytes())
