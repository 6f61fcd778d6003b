"""Words of whole texts by Arrow kernels, and pieces of batches by size."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BYTES_AT_ONCE = 8 << 20
ROWS_AT_ONCE = 20_000


class Words(NamedTuple):
    """Every word of some texts, in order."""

    row: np.ndarray  # the text it is in
    index: np.ndarray  # which of `spelled` it is
    spelled: pa.Array


def words_of(texts: pa.Array, apart: str) -> Words:
    """The words between matches of `apart` in the texts, A-Z lower-cased. A null
    text has none."""
    parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=apart)
    flat = pc.list_flatten(parts)
    held = pc.not_equal(flat, "")
    coded = flat.filter(held).dictionary_encode()
    rows = pc.list_parent_indices(parts).filter(held)
    return Words(rows.to_numpy(), coded.indices.to_numpy(), coded.dictionary)


def in_pieces(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """The batches in pieces that hold a few million bytes in column `at`; a longer
    text is a piece of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(), dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right"))
            last = min(max(last, first + 1), first + ROWS_AT_ONCE)
            yield batch.slice(first, last - first)
            first = last
