"""Token ids in files of coded blocks, and back.

Documents are sorted by identifier over ranges; every range writes segments, one
file row each, which hold whole documents: a header, the document table, the list
of ids in use by falling frequency and these frequencies, the block table with a
checksum for each block, and the code of `range_coder`. Spark's writer commits the rows, so a lost
executor leaves no half-written file. Readers need nothing but a segment; where it
starts in the corpus follows from the totals of the segments before it.

Words that white space separates are encoded alone, as this vocabulary never joins
across it, and plain words as their runs of letters or marks and single digits, which
are what its own pattern cuts them into; bounded caches per worker spare the
tokenizers library repeats.

Defined results: null text counts as empty; every document gets the end id, so an
empty one has one id; null identifiers come first. Strings that look like special
tokens are ordinary text.
"""

from __future__ import annotations

import functools
import json
import os
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count
from operator import attrgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm import range_coder
from tidemark.llm.common import in_arrow, whole_text

MAGIC = b"TMTK\x02"
# Magic, documents, ids, block length, ids in use, blocks, bytes of the frequencies.
HEADER = struct.Struct("<5sIQIIII")
SEGMENT_TOKENS = 1 << 22
LONGEST_BLOCK, SHORTEST_BLOCK, LANES = 2048, 128, 2048
CHARS_AT_ONCE = 1 << 22
# Words that are forgotten are put together from their pieces again, at little cost.
CACHED_WORDS, CACHED_PIECES = 500_000, 800_000

FILE_ROW = "shard int, part int, n_docs long, n_tokens long, segment binary"
DOC_ROW = "doc_id long, shard int, part int, offset long, n_tokens long, ids_crc32 long"


# What this vocabulary does before it merges. A plain word consists of Latin-1 letters,
# digits and marks without an apostrophe: composing changes nothing in it, and the
# pattern cuts it where one of these kinds ends, and at every digit.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PLAIN = "^[!-&(-~À-ÖØ-öø-ÿ]+$"
PIECE = "([a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+)"


class _Ids:
    """Text -> place; texts met for the first time wait in `new`. Places lead to ids."""

    def __init__(self):
        self.place = defaultdict(count().__next__)
        self.new: list[str] = []
        self.first, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, np.int32), 0

    def places(self, texts: pa.Array) -> np.ndarray:
        """The place of each text; every distinct one is looked up once."""
        coded = texts.dictionary_encode()
        known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        before = len(self.place)
        found = np.fromiter(map(self.place.__getitem__, known), np.int64, len(known))
        self.new += [known[i] for i in np.flatnonzero(found >= before).tolist()]
        return found.take(coded.indices.to_numpy())

    def waiting(self) -> tuple[list[str], int]:
        """The texts that wait, and the place of the first; they wait no longer."""
        new, self.new = self.new, []
        if len(self.place) > len(self.first):
            more = np.zeros(len(self.place), np.int64)
            self.first, self.length = np.concatenate([self.first, more]), np.concatenate([self.length, more])
        return new, len(self.place) - len(new)

    def put(self, places: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(ids), len(self.flat)), np.int32)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.first[places], self.length[places] = self.used + np.cumsum(lengths) - lengths, lengths
        self.used += len(ids)

    def take(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of places in a row, and where those of each place end."""
        length = self.length.take(places)
        ends = np.cumsum(length)
        shift = np.repeat(self.first.take(places) - (ends - length), length)
        return self.flat.take(shift + np.arange(len(shift))), ends


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts between spaces, and where those of each text end."""
    lists = pc.split_pattern(texts, " ")
    return lists.flatten(), np.cumsum(pc.list_value_length(lists).to_numpy())


def _up_to(ends: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many ids each run of places has, by the ends of places and of runs."""
    return np.diff(np.concatenate([[0], ends])[cuts], prepend=0)


class _Encoder:
    """Ids of texts by way of their words."""

    def __init__(self, data: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(data)
        before = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        cut = {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
        marks = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        self.plain = spec["normalizer"] == NORMALIZER and before == [cut, marks]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # Characters as the merges know them, by the library's own table.
        self.written = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.words, self.pieces = _Ids(), _Ids()

    def _learn(self) -> None:
        """Ids of the words that wait."""
        new, first = self.words.waiting()
        texts = pa.array(new, pa.large_string())
        plain = np.zeros(len(new), bool)
        if self.plain:
            plain = pc.match_substring_regex(texts, PLAIN).to_numpy(zero_copy_only=False)
            self._learn_plain(texts.filter(pa.array(plain)), first + np.flatnonzero(plain))
        rest = np.flatnonzero(~plain)
        found = [e.ids for e in self.tokenizer.encode_batch_fast([new[i] for i in rest], add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.words.put(first + rest, lengths, np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum())))

    def _learn_plain(self, texts: pa.Array, places: np.ndarray) -> None:
        if len(self.pieces.place) > CACHED_PIECES:
            self.pieces = _Ids()
        cut = pc.ascii_rtrim(pc.replace_substring_regex(pc.utf8_lower(texts), PIECE, "\\1 "), " ")
        parts, cuts = _split(cut)
        at = self.pieces.places(parts)
        new, first = self.pieces.waiting()
        # One flat list: a list for each piece would keep the garbage collector busy.
        found, so_far, merged, id_of = [], [0], self.tokenizer.model.tokenize, attrgetter("id")
        for p in new:
            found.extend(map(id_of, merged(p if p.isascii() else p.translate(self.written))))
            so_far.append(len(found))
        self.pieces.put(first + np.arange(len(new)), np.diff(so_far), np.array(found, np.int32))
        ids, ends = self.pieces.take(at)
        self.words.put(places, _up_to(ends, cuts), ids)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        if len(self.words.place) > CACHED_WORDS:
            self.words = _Ids()
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        parts, cuts = _split(pc.replace_substring(texts, "\n", " "))
        places = self.words.places(parts)
        if self.words.new:
            self._learn()
        ids, ends = self.words.take(places)
        return ids, _up_to(ends, cuts)


@functools.lru_cache(maxsize=1)
def _encoder(data: bytes) -> _Encoder:
    return _Encoder(data)


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One segment."""
    n = len(ids)
    block = min(LONGEST_BLOCK, max(SHORTEST_BLOCK, -(-n // LANES)))
    frequency = np.bincount(ids)
    used = np.argsort(-frequency, kind="stable")[: np.count_nonzero(frequency)]
    rank = np.zeros(len(frequency), np.int32)
    rank[used] = np.arange(len(used))
    ranks = rank[ids]
    table = zlib.compress(frequency[used].astype("<u8").tobytes())
    codes = range_coder.encode(ranks, block, len(used), frequency[used])
    sums = [zlib.crc32(c) for c in codes]
    body = b"".join(
        [
            np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            counts.astype("<u4").tobytes(),
            used.astype("<u4").tobytes(),
            table,
            np.array([len(c) for c in codes], "<u4").tobytes(),
            np.array(sums, "<u4").tobytes(),
            *codes,
        ]
    )
    head = HEADER.pack(MAGIC, len(doc_ids), n, block, len(used), len(codes), len(table))
    return head + struct.pack("<I", zlib.crc32(head + body[: len(body) - sum(map(len, codes))])) + body


def unpack(segment: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """What `pack` was given. A damaged segment raises."""
    magic, n_docs, n, block, n_used, n_blocks, n_table = HEADER.unpack_from(segment)
    at = HEADER.size + 4
    if magic != MAGIC:
        raise ValueError("not a token segment")

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(segment, kind, count, at)
        at += out.nbytes
        return out

    known, doc_ids, counts, used = take("u1", n_docs), take("<i8", n_docs), take("<u4", n_docs), take("<u4", n_used)
    table = take("u1", n_table)
    sizes, sums = take("<u4", n_blocks), take("<u4", n_blocks)
    if zlib.crc32(segment[: HEADER.size] + segment[HEADER.size + 4 : at]) != struct.unpack_from("<I", segment, HEADER.size)[0]:
        raise ValueError("a damaged segment header")
    codes = []
    for i, (size, good) in enumerate(zip(sizes.tolist(), sums.tolist())):
        codes.append(segment[at : at + size])
        at += size
        if zlib.crc32(codes[-1]) != good:
            raise ValueError(f"damaged block {i}")
    counts_of = np.frombuffer(zlib.decompress(table), "<u8")
    ranks = range_coder.decode(codes, n, block, n_used, counts_of)
    return [d if k else None for k, d in zip(known.tolist(), doc_ids.tolist())], counts.astype(np.int64), used[ranks]


def _writer(data: bytes, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, part = _encoder(data), TaskContext.get().partitionId(), 0
        docs, counts, ids, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            packed = pack(docs, np.concatenate(counts), np.concatenate(ids))
            row = ([shard], [part], [len(docs)], [held], [packed])
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                ["shard", "part", "n_docs", "n_tokens", "segment"],
            )

        for batch in batches:
            own, texts, first = batch.column(0).to_pylist(), batch.column(1), 0
            chars = np.cumsum(pc.utf8_length(texts).to_numpy())
            while first < len(own):
                so_far = chars[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(chars, so_far + CHARS_AT_ONCE)))
                found, lengths = encoder.encode(texts.slice(first, last - first))
                found = np.insert(found, np.cumsum(lengths), end)
                docs += own[first:last]
                counts.append(lengths + 1)
                ids.append(found)
                held += len(found)
                first = last
                if held >= SEGMENT_TOKENS:
                    yield segment()
                    docs, counts, ids, held, part = [], [], [], 0, part + 1
        if docs:
            yield segment()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write `docs` to files under `path`, in ascending order of `id`, and return
    what is read from there: a row per segment."""
    ordered = docs.select(F.col(id).cast("long").alias("id"), whole_text(text).alias("body"))
    ordered = ordered.repartitionByRange("id").sortWithinPartitions("id")
    rows = in_arrow(ordered, _writer(Path(tokenizer_path).read_bytes(), end), FILE_ROW)
    rows.write.option("compression", "none").parquet(path)
    return docs.sparkSession.read.schema(FILE_ROW).parquet(path)


def _reader(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, part, segment in zip(*(batch.column(c).to_pylist() for c in ("shard", "part", "segment"))):
                doc_ids, counts, ids = unpack(segment)
                ends, raw, n = np.cumsum(counts), ids.astype("<u4").tobytes(), len(doc_ids)
                sums = [zlib.crc32(raw[4 * (b - c) : 4 * b]) for b, c in zip(ends.tolist(), counts.tolist())]
                columns = [
                    pa.array(doc_ids, pa.int64()), pa.array([shard] * n, pa.int32()), pa.array([part] * n, pa.int32()),
                    pa.array(ends - counts), pa.array(counts), pa.array(sums, pa.int64()),
                ]
                names = ["doc_id", "shard", "part", "offset", "n_tokens", "ids_crc32"]
                if with_ids:
                    bounds = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the files."""
    documents = in_arrow(files.select("shard", "part", "segment"), _reader(with_ids), DOC_ROW + (", ids array<int>" if with_ids else ""))
    sizes = files.select(F.col("shard").alias("of_shard"), F.col("part").alias("of_part"), F.col("n_tokens").alias("size"))
    zero = F.lit(0).cast("long")
    earlier = (Window.unboundedPreceding, -1)
    # One row per shard meets in one task, and the segments of a shard in another.
    shards = sizes.groupBy(F.col("of_shard").alias("in_shard")).agg(F.sum("size").alias("shard_size"))
    shards = shards.select("in_shard", F.coalesce(F.sum("shard_size").over(Window.orderBy("in_shard").rowsBetween(*earlier)), zero).alias("base"))
    within = Window.partitionBy("of_shard").orderBy("of_part").rowsBetween(*earlier)
    starts = sizes.withColumn("inner", F.coalesce(F.sum("size").over(within), zero)).join(shards, F.col("of_shard") == F.col("in_shard"))
    starts = starts.select("of_shard", "of_part", (F.col("base") + F.col("inner")).alias("first"))
    found = documents.join(starts, (F.col("shard") == F.col("of_shard")) & (F.col("part") == F.col("of_part")))
    return found.select("doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
