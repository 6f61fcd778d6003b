"""Byte-level BPE: whole texts to ids with offsets, and ids back to bytes.

Pieces are located by `pretokens`; each distinct piece is merged once per worker
and kept in a bounded cache. Ranks travel with the task, so executors need no
vocabulary file.

Defined results: null text counts as empty; an empty text has no ids; decoding a
null list gives null, an id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import claim, in_arrow, whole_text
from tidemark.llm.pretokens import SEPARATOR, code_point_classes, piece_starts

CACHED_PIECES = 250_000
CHARS_AT_ONCE = 1 << 21


@functools.lru_cache(maxsize=2)
def _vocabulary(data: bytes) -> tuple[dict[bytes, int], list[bytes]]:
    ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return ranks, tokens


def merged(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one piece: the adjacent pair of lowest rank is joined first, the
    leftmost of equals, until no pair has a rank."""
    if piece in ranks:
        return (ranks[piece],)
    if len(piece) > 100:
        return _merged_long(piece, ranks)
    none = len(ranks) + 256
    get = ranks.get
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (best := min(pairs)) < none:
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
    return tuple([ranks[p] for p in parts])


def _merged_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same with a heap of pairs, for pieces of any length."""
    n = len(piece)
    ends, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that starts at i
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        middle = ends[i]
        if middle is None or middle >= n or ends[middle] != end:
            continue
        ends[i], ends[middle] = end, None
        if end < n:
            before[end] = i
            if (r := ranks.get(piece[i : ends[end]])) is not None:
                heapq.heappush(heap, (r, i, ends[end]))
        if i and (r := ranks.get(piece[before[i] : end])) is not None:
            heapq.heappush(heap, (r, before[i], end))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : ends[i]]])
        i = ends[i]
    return tuple(out)


class _Cache(dict):
    """Piece -> ids; emptied when full, so that memory stays bounded."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= CACHED_PIECES:
            self.clear()
        ids = merged(piece.encode(), self.ranks)
        if len(piece) < 100:
            self[piece] = ids
        return ids


@functools.lru_cache(maxsize=2)
def _cache(data: bytes) -> _Cache:
    return _Cache(_vocabulary(data)[0])


def encode_texts(texts: list[str], data: bytes) -> Iterator[np.ndarray]:
    """Ids of each text."""
    find = _cache(data).__getitem__
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4").copy()
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    points[ends] = SEPARATOR
    starts = piece_starts(points)
    cut = np.searchsorted(starts, ends).tolist()
    marks = starts.tolist()
    first = 0
    for last in cut:
        # The piece at `last` is the separator.
        pieces = [joined[a:b] for a, b in zip(marks[first:last], marks[first + 1 : last + 1])]
        yield np.fromiter(chain.from_iterable(map(find, pieces)), np.int32)
        first = last + 1


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=ends[1:])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32, copy=False)))


def decode_ids(ids: np.ndarray, offsets: np.ndarray, tokens: list[bytes]) -> bytes:
    """The bytes of ids whose offsets must fit them."""
    if len(ids) and not 0 <= ids.min() <= ids.max() < len(tokens):
        raise ValueError("an id outside the vocabulary")
    whole = b"".join(map(tokens.__getitem__, ids.tolist()))
    if len(ids) and offsets[-1] + len(tokens[ids[-1]]) != len(whole):
        raise ValueError("offsets that do not fit their ids")
    return whole


def _forget() -> None:
    _cache.cache_clear()
    code_point_classes.cache_clear()


def _encoder(data: bytes, names: list[str], decoded: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("byte_bpe", _forget)
        tokens = _vocabulary(data)[1]
        lengths = np.array([len(t) for t in _vocabulary(data)[1]], np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            first = 0
            while first < len(texts):
                last, chars = first, 0
                while last < len(texts) and (last == first or chars + len(texts[last]) < CHARS_AT_ONCE):
                    chars += len(texts[last])
                    last += 1
                ids = list(encode_texts(texts[first:last], data))
                offsets = [np.cumsum(lengths[i]) - lengths[i] for i in ids]
                rest = [c.slice(first, last - first) for c in batch.columns[1:]]
                back = [pa.array([decode_ids(i, o, tokens) for i, o in zip(ids, offsets)], pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([*rest, _lists(ids), _lists(offsets), *back], names)
                first = last

    return run


def encode(docs: DataFrame, ranks_path: str, id: str = "doc_id", text: str = "text", decoded: bool = False) -> DataFrame:
    """`id`, ids array<int>, offsets array<int>: where in the UTF-8 text each id's bytes start.

    With `decoded`, also what the ids decode to, before they leave the task."""
    read = docs.select(whole_text(text).alias("body"), F.col(id))
    kind = read.schema[1].dataType.simpleString()
    names = [id, "ids", "offsets", *(["decoded"] if decoded else [])]
    schema = f"`{id}` {kind}, ids array<int>, offsets array<int>" + (", decoded binary" if decoded else "")
    return in_arrow(read, _encoder(Path(ranks_path).read_bytes(), names, decoded), schema)


def _decoder(data: bytes, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(data)[1]
        for batch in batches:
            ids, offsets = batch.column("ids"), batch.column("offsets")
            flat, marks = (c.values.to_numpy(zero_copy_only=False) for c in (ids, offsets))
            spans = zip(ids.is_valid().to_pylist(), *(x for c in (ids, offsets) for x in (c.offsets[:-1].to_pylist(), c.offsets[1:].to_pylist())))
            out = [decode_ids(flat[a:b], marks[c:d], tokens) if ok else None for ok, a, b, c, d in spans]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names)

    return run


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """Adds `decoded` binary to the rows of `encode`."""
    names = [*encoded.columns, "decoded"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"
    return in_arrow(encoded, _decoder(Path(ranks_path).read_bytes(), names), schema)


def token_digests(docs: DataFrame, ranks_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, n_tokens, and digests of the ids and of the bytes they decode to."""
    return encode(docs, ranks_path, id, text, decoded=True).select(
        id,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
