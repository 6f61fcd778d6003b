"""Where the pieces of a byte-level BPE start, found without a regular expression.

Each code point gets a class from a table, and a few neighbouring comparisons turn
classes into symbols of a small automaton. Every symbol is a function from states
to states; functions compose associatively, so prefixes are found by a blocked
scan: rows of symbols are composed side by side, the rows' functions are scanned
the same way, and each row then runs from its true entry state.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np

# The white space of Unicode, and the contractions of the pattern.
WHITE_SPACE = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006,
    0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")

# Symbols. A white-space symbol is LAST if a visible character follows it.
LETTER, NUMBER, OTHER, SHORT, LONG, LAST_SPACE, LAST_WHITE, WHITE, END = range(9)
# States: what the piece that holds the latest character may still take in.
NOTHING, LETTERS, NUMBERS, OTHERS, PREFIX, WHITES, ONE_MORE, TWO_MORE = range(8)
SYMBOLS, STATES = 9, 8
SEPARATOR = 0x110000


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether this character starts a piece."""
    if symbol == LETTER:
        if state in (ONE_MORE, TWO_MORE):
            return (NOTHING if state == ONE_MORE else ONE_MORE), False
        return LETTERS, state not in (LETTERS, PREFIX)
    if symbol == NUMBER:
        return NUMBERS, state not in (NUMBERS, PREFIX)
    if symbol in (OTHER, SHORT, LONG):
        if state in (OTHERS, PREFIX):
            return OTHERS, False
        return {OTHER: OTHERS, SHORT: ONE_MORE, LONG: TWO_MORE}[symbol], True
    if symbol == LAST_SPACE:
        return PREFIX, True
    if symbol == WHITE:
        return WHITES, state != WHITES
    return NOTHING, True


@functools.cache
def _tables():
    """Step and start tables by state and symbol; the functions that symbols
    generate, their composition, and what each makes of a state."""
    step = np.array([[_step(s, y)[0] for y in range(SYMBOLS)] for s in range(STATES)], np.uint8)
    start = np.array([[_step(s, y)[1] for y in range(SYMBOLS)] for s in range(STATES)])
    known = {tuple(range(STATES)): 0}
    queue = list(known)
    for f in queue:
        for y in range(SYMBOLS):
            g = tuple(int(step[s, y]) for s in f)
            if g not in known:
                known[g] = len(known)
                queue.append(g)
    functions = np.array(queue, np.uint8)
    compose = np.array([[known[tuple(int(g[s]) for s in f)] for g in queue] for f in queue], np.uint16)
    symbol = np.array([known[tuple(int(x) for x in step[:, y])] for y in range(SYMBOLS)], np.uint16)
    return step, start, functions, compose, symbol


@functools.cache
def code_point_classes() -> np.ndarray:
    """Symbol of each code point, apart from its neighbours."""
    table = np.full(SEPARATOR + 1, OTHER, np.uint8)
    kinds = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(SEPARATOR)).encode(), np.uint8)
    table[:SEPARATOR][kinds == ord("L")] = LETTER
    table[:SEPARATOR][kinds == ord("N")] = NUMBER
    table[list(WHITE_SPACE)] = LAST_WHITE
    table[0x20] = LAST_SPACE
    table[SEPARATOR] = END
    return table


def symbols(points: np.ndarray) -> np.ndarray:
    """Automaton symbols of code points that end with a separator."""
    out = code_point_classes()[points]
    blank = (out == LAST_SPACE) | (out == LAST_WHITE)
    more = blank.copy()
    more[:-1] &= blank[1:] | (out[1:] == END)
    out[more] = WHITE
    marks = np.flatnonzero(points == ord("'"))
    after = points[np.minimum(marks + 1, len(points) - 1)]
    then = points[np.minimum(marks + 2, len(points) - 1)]
    for letter in ONE_LETTER:
        out[marks[after == ord(letter)]] = SHORT
    for a, b in TWO_LETTERS:
        out[marks[(after == ord(a)) & (then == ord(b))]] = LONG
    return out


def _entries(functions: np.ndarray, compose: np.ndarray, width: int = 64) -> np.ndarray:
    """Composition of all functions before each one, by a scan in rows."""
    if len(functions) <= width:
        out, so_far = np.zeros(len(functions), np.uint16), 0
        for i, f in enumerate(functions.tolist()):
            out[i] = so_far
            so_far = int(compose[so_far, f])
        return out
    rows = -(-len(functions) // width)
    grid = np.zeros(rows * width, np.uint16)
    grid[: len(functions)] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    total = np.zeros(rows, np.uint16)
    for column in grid:
        total = compose[total, column]
    so_far = _entries(total, compose, width)
    out = np.empty((width, rows), np.uint16)
    for i, column in enumerate(grid):
        out[i] = so_far
        so_far = compose[so_far, column]
    return out.T.reshape(-1)[: len(functions)]


def piece_starts(points: np.ndarray, width: int = 256) -> np.ndarray:
    """Offsets at which pieces start. `points`: code points of texts that each end
    with a SEPARATOR; a separator is a piece of its own."""
    step, start, functions, compose, symbol = _tables()
    given = symbols(points)
    rows = -(-len(given) // width)
    grid = np.full(rows * width, END, np.uint8)
    grid[: len(given)] = given
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    # Composing with a symbol's function, by function and symbol, as one flat table.
    onward = np.ascontiguousarray(compose[:, symbol]).reshape(-1)
    total = np.zeros(rows, np.intp)
    for column in grid:
        total = onward.take(total * SYMBOLS + column)
    state = functions[_entries(total.astype(np.uint16), compose), NOTHING]
    flat_step, flat_start = step.reshape(-1), start.reshape(-1)
    starts = np.empty((width, rows), bool)
    for i, column in enumerate(grid):
        at = state * np.uint8(SYMBOLS) + column
        flat_start.take(at, out=starts[i], mode="clip")
        state = flat_step.take(at)
    return np.flatnonzero(np.ascontiguousarray(starts.T).reshape(-1)[: len(given)])
