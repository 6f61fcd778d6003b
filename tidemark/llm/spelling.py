"""Spelling variants: words one edit apart, and the form each of them stands for.

Words are counted in Arrow batches, a partial count a batch. Near words are found by
composing the minimal acceptor of the vocabulary with a one-edit transducer and the
acceptor again (`acceptor.py`), a partition of initial states at a time.

A partition is the words of at most m symbols (m or m - 1) that share their first `a`
and their last `b` symbols; it looks for pairs whose longer word has m symbols and
that first differ between them. It starts as all words of two neighbouring lengths.
One that holds more than PARTITION_CELLS symbols is halved: the first difference lies
in the second half of what is open, then the words share the first half as well, or in
the first half, then they share the second. So no pair is lost or met twice, and the
largest part is no larger than the limit, or else its words differ in one place only
and are no more than there are symbols.

Forms lead to ever more frequent words, by a factor of two at least, so chains are
short; roots are found by doubling pointers, each round written to the shared folder.

Defined results: a null text has no words; a null identifier counts as an empty one;
repeated rows count again; an empty table has no words.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.acceptor import Acceptor, one_edit_pairs
from tidemark.llm.common import claim, encoded, in_arrow, staged
from tidemark.llm.words import in_pieces, words_of

# Fixed value: what lies between words, once A-Z are lower-cased.
APART = "[^a-zÀ-ÿ]+"
PARTITION_CELLS = 1 << 16
CELLS_AT_ONCE = 1 << 21
BROADCAST_ROWS = 500_000


# -- words and their counts --------------------------------------------------------


@lru_cache(maxsize=256)
def _behind(n: int) -> np.ndarray:
    """By place and value of a byte of a CRC: what it adds once `n` bytes follow."""
    zeros = bytes(n)
    bits = [zlib.crc32(zeros, 1 << k) ^ zlib.crc32(zeros) for k in range(32)]
    table = np.zeros((4, 256), np.uint32)
    for k, bit in enumerate(bits):
        table[k // 8] ^= np.where(np.arange(256) >> (k % 8) & 1, np.uint32(bit), np.uint32(0)).astype(np.uint32)
    return table


def joined_crc(before: np.ndarray, sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of two strings put together, from that of each and the bytes of the second."""
    out = sums.astype(np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for first, last in zip(cuts, np.append(cuts[1:], len(order))):
        at = order[first:last]
        table, crc = _behind(int(lengths[at[0]])), before[at]
        for byte in range(4):
            out[at] ^= table[byte][(crc >> np.uint32(8 * byte)) & np.uint32(255)]
    return out


def _counter(shortest: int, one_in: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("spelling", _behind.cache_clear)
        for piece in in_pieces(batches, 1):
            row, index, dictionary = words_of(piece.column(1), APART)
            if not len(row):
                continue
            owners = [f"{'' if i is None else i}:".encode() for i in piece.column(0).to_pylist()]
            owner_sums = np.array([zlib.crc32(o) for o in owners], np.uint32)
            sums = np.array([zlib.crc32(w) for w in encoded(dictionary)], np.uint32)
            h = joined_crc(owner_sums[row], sums[index], pc.binary_length(dictionary).to_numpy()[index])
            cut = h % np.uint32(one_in) == 0
            counts = np.bincount(index[~cut], minlength=len(dictionary))
            shorter: Counter[str] = Counter()
            for word, at in zip(dictionary.take(pa.array(index[cut])).to_pylist(), h[cut].tolist()):
                at %= len(word)
                shorter[word[:at] + word[at + 1 :]] += 1
            long = (counts > 0) & (pc.utf8_length(dictionary).to_numpy() >= shortest)
            made = [w for w in shorter if len(w) >= shortest]
            words = pa.concat_arrays([dictionary.filter(pa.array(long)), pa.array(made, pa.string())])
            yield pa.RecordBatch.from_arrays([words, pa.array(np.append(counts[long], [shorter[w] for w in made]).astype(np.int64))], ["word", "n"])

    return run


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, one_in: int = 97, id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: words of at least `shortest` symbols seen at least `least` times. One
    run in `one_in`, by the CRC-32 of identifier and run, loses a symbol."""
    read = docs.select(F.col(id).cast("string"), F.coalesce(F.col(text).cast("string"), F.lit("")))
    counted = in_arrow(read, _counter(shortest, one_in), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# -- near words --------------------------------------------------------------------

PART = ("m", "a", "b")


def _part() -> Column:
    """What names a partition: lengths, then the shared beginning and end."""
    word, a, b = F.col("word"), F.col("a"), F.col("b")
    end = F.when(b > 0, F.substring(word, F.length(word) - b + 1, b)).otherwise(F.lit(""))
    return F.concat_ws("|", *PART, F.substring(word, F.lit(1), a), end)


def _open() -> Column:
    return F.col("m") - F.col("a") - F.col("b")


def _halved(rows: DataFrame) -> DataFrame:
    middle = (F.col("a") + F.floor(_open() / 2)).cast("int")
    halves = F.array(
        F.struct(middle.alias("a"), F.col("b").alias("b")),
        F.struct(F.col("a").alias("a"), (F.col("m") - middle).alias("b")),
    )
    return rows.select("word", "n", "m", F.explode(halves).alias("half")).select("word", "n", "m", "half.a", "half.b")


def _partitions(words: DataFrame, cells: int) -> DataFrame:
    """word, n, m, a, b, part: every word in each partition that it takes part in."""
    length = F.length("word")
    lengths = F.array(length, length + 1)
    rows = words.select("word", "n", F.explode(lengths).alias("m"), F.lit(0).alias("a"), F.lit(0).alias("b"))
    ready = None
    while True:
        rows = staged(rows.withColumn("part", _part()), "partitions")
        large = rows.where(_open() > 1).groupBy(F.xxhash64("part").alias("hash"))
        # Partitions whose hashes meet are halved together, which changes no pair.
        large = staged(large.agg(F.sum(_open() + 1).alias("cells"), F.count(F.lit(1)).alias("rows")).where((F.col("cells") > cells) & (F.col("rows") > 1)), "large")
        n_large = large.count()
        found = large.select("hash")
        found = F.broadcast(found) if n_large <= BROADCAST_ROWS else found
        on = (F.xxhash64(rows["part"]) == found["hash"]) & (F.col("m") - F.col("a") - F.col("b") > 1)
        done = rows.join(found, on, "left_anti")
        ready = done if ready is None else ready.unionByName(done)
        if not n_large:
            return ready
        rows = _halved(rows.join(found, on, "left_semi"))


def _matrix(words: list[str], starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols from `starts` to `ends` of each word, numbered from 1 in code point
    order, a row each with 0 behind, and how many they are."""
    whole = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    sizes = ends - starts
    width = int(sizes.max(initial=0))
    columns = np.arange(width)
    inside = columns < sizes[:, None]
    at = (np.cumsum(whole) - whole + starts)[:, None] + columns
    used, numbered = np.unique(points, return_inverse=True)
    out = np.zeros((len(words), width), np.uint16 if len(used) < 65_535 else np.int64)
    out[inside] = (numbered + 1)[at[inside]]
    return out, sizes


def pairs_of(words: list[str], parts: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all pairs of near words that the partitions, numbered from 0 in
    ascending order by `parts`, look for."""
    lengths = np.array([len(w) for w in words], np.int64)
    # One symbol of the shared end says whether a difference could lie further on.
    symbols, sizes = _matrix(words, a, lengths - b + (b > 0))
    order = np.lexsort((*(symbols[:, i] for i in range(symbols.shape[1] - 1, -1, -1)), parts))
    symbols, of = symbols[order], parts[order]
    base = np.flatnonzero(np.diff(of, prepend=-1))
    head = order[base]
    open_ = (m - a - b)[head]
    one, two = one_edit_pairs(Acceptor(symbols.astype(np.int64), of), base, open_ + (b[head] > 0), open_)
    one, two = order[one], order[two]
    met = (lengths[one] == m[one]) | (lengths[two] == m[two])
    return one[met], two[met]


def _pairer(cells: int):
    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        parts = rows.column("part").combine_chunks()
        new = np.append(True, pc.not_equal(parts.slice(1), parts.slice(0, len(parts) - 1)).to_numpy(zero_copy_only=False))
        number = np.cumsum(new) - 1
        # A word alone has no near word here.
        shared = np.bincount(number)[number] > 1
        if not shared.any():
            return
        rows = rows.filter(pa.array(shared))
        _, number = np.unique(number[shared], return_inverse=True)
        word, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
        one, two = pairs_of(word.to_pylist(), number, *(rows.column(c).to_numpy().astype(np.int64) for c in PART))
        here, there = pa.array(np.append(one, two)), pa.array(np.append(two, one))
        made = [word.take(here), word.take(there), n.take(there)]
        yield pa.RecordBatch.from_arrays(made, ["word", "near", "near_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("spelling", _behind.cache_clear)
        held, size = [], 0
        for batch in batches:
            for piece in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                held.append(piece)
                size += int(np.sum(pc.utf8_length(piece.column("word")).to_numpy())) + piece.num_rows
                if size < cells:
                    continue
                # The last partition may go on in the next batch.
                rows = pa.Table.from_batches(held)
                last = pc.index(rows.column("part"), rows.column("part")[-1]).as_py()
                yield from found(rows.slice(0, last)) if last else ()
                held = rows.slice(last).to_batches()
                size = int(pc.sum(pc.utf8_length(rows.slice(last).column("word"))).as_py() or 0) + rows.num_rows - last
        if held:
            yield from found(pa.Table.from_batches(held))

    return run


def near_words(words: DataFrame, cells: int = PARTITION_CELLS) -> DataFrame:
    """word, near, near_n: all pairs of distinct words (word, n) one edit apart, both ways."""
    parts = _partitions(words, cells).repartition("part").sortWithinPartitions("part", "word")
    kind = words.schema["n"].dataType.simpleString()
    return in_arrow(parts, _pairer(CELLS_AT_ONCE), f"word string, near string, near_n {kind}")


# -- forms and roots ---------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of the chain of forms that starts at each word of `forms`."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        step = now.join(up, F.col("root") == F.col("at"), "left")
        now = staged(step.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def spelling_forms(counts: DataFrame, times: int = 2, cells: int = PARTITION_CELLS) -> DataFrame:
    """word, form, root, n, n_near, form_n for words (word, n). A word's form is its most
    frequent near word (ties: the first in code point order) that is at least `times` as
    frequent; its root ends the chain of forms."""
    words = staged(counts.select("word", "n"), "words")
    best = near_words(words, cells).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(best.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    likely = -F.col("best.less") >= F.col("n") * times
    formed = staged(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(likely, F.col("best.near")).alias("form"), F.when(likely, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.where("form IS NOT NULL")).withColumnRenamed("word", "of")
    out = formed.join(roots, F.col("word") == F.col("of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
