"""Language identification with hyperdimensional profiles.

Every letter owns a random vector of +1 and -1, fixed by its code point. The three
letters of a trigram are permuted by their place (cyclic shifts) and bound by
multiplication; a text is the bundle (sum) of its trigrams, and a language the
bundle of its training texts. Texts are compared with languages by cosine.

Bundles are whole numbers, so partial sums of tasks add up to the same profile in
any order. What reaches the driver is one vector per language.

Defined results: null texts and texts without a letter are `und` with score 0; the
same holds when no labelled text was there to learn from. Letter case is folded,
runs of other characters count as one boundary. Ties go to the smaller language.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import claim, in_arrow

DIMENSIONS = 1024
SEED = 9
UNKNOWN = "und"
CHARS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 2048
CACHED_TRIGRAMS = 1 << 15
DENSE_CODES = 1 << 18
# Vectors that have nothing in common lie about 1 / sqrt(DIMENSIONS) from a right angle.
# A language is told from chance three times that away. Clean texts scatter more around
# what is expected of them, as their trigrams are no independent draws: on labelled rows
# the lowest thousandth lies within seven times that. A trigram counts for two at most, the
# least that natural languages have: a narrow vocabulary has more, and says less of others.
NOISE, SCATTER, MOST_EXPECTED = 3 / DIMENSIONS**0.5, 7 / DIMENSIONS**0.5, 2 / DIMENSIONS**0.5
BOUNDARY = 0x20
BITS = 21  # of a code point


@functools.cache
def _fold() -> np.ndarray:
    """Lower-case letter for letters, the boundary for anything else."""
    table = np.full(0x110000, BOUNDARY, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha() and unicodedata.category(char)[0] == "L":
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


@functools.lru_cache(maxsize=4096)
def _letter(point: int) -> np.ndarray:
    return (np.random.default_rng([SEED, point]).integers(0, 2, DIMENSIONS) * 2 - 1).astype(np.int8)


def _vector(key: int) -> np.ndarray:
    """Bound vector of the trigram packed in `key`."""
    mask = (1 << BITS) - 1
    a, b, c = key >> 2 * BITS, key >> BITS & mask, key & mask
    return np.roll(_letter(a), 2) * np.roll(_letter(b), 1) * _letter(c)


class _Rows:
    """Vectors of the trigrams met so far, as rows of one matrix; emptied when full."""

    def __init__(self):
        self.at: dict[int, int] = {}
        self.matrix = np.empty((CACHED_TRIGRAMS, DIMENSIONS), np.int8)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if len(self.at) + len(keys) > CACHED_TRIGRAMS:
            self.at.clear()
        known, out = self.at, np.empty(len(keys), np.intp)
        for i, key in enumerate(keys.tolist()):
            row = known.get(key)
            if row is None:
                row = known[key] = len(known)
                self.matrix[row] = _vector(key)
            out[i] = row
        return out


@functools.cache
def _rows() -> _Rows:
    return _Rows()


def bundle(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of the trigrams' vectors, in pieces that the cache can hold."""
    total, step = np.zeros(DIMENSIONS), CACHED_TRIGRAMS // 4
    for i in range(0, len(keys), step):
        rows = _rows().find(keys[i : i + step])
        part = counts[i : i + step]
        # Whole numbers stay exact in single precision below 2**24.
        kind = np.float32 if part.sum() < 1 << 24 else np.float64
        total += part.astype(kind) @ _rows().matrix[rows].astype(kind)
    return total


def trigrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Packed trigrams and their counts, per text; none for texts without letters."""
    joined = " ".join(["", *texts, ""])
    points = _fold()[np.frombuffer(joined.encode("utf-32-le"), "<u4")]
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    # Of a run of boundaries the last one stays.
    stays = (points != BOUNDARY) | np.append(points[1:] != BOUNDARY, True)
    place = np.cumsum(stays) - stays
    points = points[stays]
    alphabet = np.unique(points)
    size = len(alphabet)
    index = np.searchsorted(alphabet, points) if size < 1 << 16 else None
    dense = size**3 <= DENSE_CODES
    letters = alphabet.astype(np.int64)
    small = index.astype(np.int64)
    codes = (small[:-2] * size + small[1:-1]) * size + small[2:] if len(small) > 2 else np.zeros(0, np.int64)
    for i in range(len(texts)):
        # The text lies between the boundaries at starts[i] and starts[i + 1], or
        # what is left of the runs they belong to.
        a, b = place[starts[i]], place[starts[i + 1]] + 1
        own = codes[a : max(a, b - 2)]
        if not len(own):
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        if dense:
            table = np.bincount(own)
            found = np.flatnonzero(table)
            counts = table[found]
        else:
            found, counts = np.unique(own, return_counts=True)
        first, second, third = found // (size * size), found // size % size, found % size
        yield (letters[first] << 2 * BITS) | (letters[second] << BITS) | letters[third], counts


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    group, chars = [], 0
    for text in texts:
        group.append(text)
        chars += len(text)
        if chars >= CHARS_AT_ONCE:
            yield group
            group, chars = [], 0
    if group:
        yield group


def _forget() -> None:
    for cached in (_rows, _fold, _letter):
        cached.cache_clear()


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim("langid", _forget)
    sums: dict[str, np.ndarray] = {}
    sizes: dict[str, int] = {}

    def add(lang: str, counted: dict[int, int]) -> None:
        keys = np.fromiter(counted.keys(), np.int64, len(counted))
        counts = np.fromiter(counted.values(), np.int64, len(counted))
        sums[lang] = sums.get(lang, 0) + bundle(keys, counts)
        sizes[lang] = sizes.get(lang, 0) + int(counts.sum())

    seen: dict[str, dict[int, int]] = {}
    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), iter(batch.column(1).to_pylist())
        for group in _groups(texts):
            for keys, counts in trigrams(group):
                lang = next(langs)
                held = seen.setdefault(lang, {})
                get = held.get
                for key, n in zip(keys.tolist(), counts.tolist()):
                    held[key] = get(key, 0) + n
                if len(held) > CACHED_TRIGRAMS:
                    add(lang, seen.pop(lang))
    for lang, counted in seen.items():
        add(lang, counted)
    if sums:
        yield pa.RecordBatch.from_arrays(
            # The number of trigrams follows the sums.
            [pa.array(list(sums)), pa.array([np.append(s, sizes[x]).astype(np.int64) for x, s in sums.items()], pa.list_(pa.int64()))],
            ["lang", "sums"],
        )


class Profiles(dict[str, np.ndarray]):
    """Unit vectors by language. `expected` is the cosine that one trigram of a language
    has with its profile on average, the smallest of the languages."""

    expected: float = 0.0


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Unit vectors of the languages that `docs` is labelled with. Rows without
    text or label teach nothing. The driver gets DIMENSIONS numbers a language."""
    read = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, F.col(lang).cast("string"))
    sums = in_arrow(read, _learn, "lang string, sums array<long>")
    total = (
        sums.select("lang", F.posexplode("sums").alias("i", "n"))
        .groupBy("lang", "i")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.array_sort(F.collect_list(F.struct("i", "n"))).alias("sums"))
    )
    found, expected = {}, []
    for row in total.collect():
        *vector, size = (x.n for x in row.sums)
        if norm := np.linalg.norm(vector):
            found[row.lang] = np.array(vector, np.float64) / norm
            expected.append(float(norm / DIMENSIONS**0.5 / size))
    profiles = Profiles(sorted(found.items()))
    profiles.expected = min(expected, default=0.0)
    return profiles


def least_score(profiles: Profiles, n: str = "n_trigrams") -> Column:
    """The score below which a text of `n` distinct trigrams is in no known language.

    Clean texts are expected at sqrt(n) times what one trigram has; the bound lies
    SCATTER below, and at NOISE once that is far enough from chance. It grows steadily
    with the text; of a few trigrams, which cannot be told from chance, it asks nothing.
    """
    return F.least(F.lit(NOISE), F.sqrt(n) * min(profiles.expected, MOST_EXPECTED) - SCATTER)


def _identifier(profiles: dict[str, np.ndarray], text_at: int, carried: list[str]):
    langs = list(profiles)
    matrix = np.array([profiles[x] for x in langs])

    def one(keys: np.ndarray, counts: np.ndarray) -> tuple[str, float, int]:
        if not len(keys) or not langs:
            return UNKNOWN, 0.0, len(keys)
        vector = bundle(keys, counts)
        norm = np.linalg.norm(vector)
        cosines = matrix @ vector / norm if norm else np.zeros(len(langs))
        best = int(np.argmax(cosines))
        return langs[best], float(min(1.0, max(0.0, cosines[best]))), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("langid", _forget)
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            given = batch.column(0)
            texts = (text or "" for text in given.field(text_at).to_pylist())
            found = [one(*t) for group in _groups(texts) for t in trigrams(group)]
            kept = pa.StructArray.from_arrays([given.field(i) for i in range(len(carried))], carried) if carried else given
            yield pa.RecordBatch.from_arrays(
                [kept, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.int64())],
                ["doc", "lang_pred", "score", "n_trigrams"],
            )

    return run


def identified(docs: DataFrame, profiles: dict[str, np.ndarray], text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """struct `doc` of the columns `carry` (all by default), lang_pred, score and n_trigrams (distinct ones)."""
    carry = docs.columns if carry is None else carry
    sent = carry if text in carry else [*carry, text]
    read = docs.select(F.struct(*sent).alias("doc"))
    kind = docs.select(F.struct(*carry).alias("doc")).schema[0].dataType.simpleString()
    run = _identifier(profiles, sent.index(text), [] if sent == carry else carry)
    return in_arrow(read, run, f"doc {kind}, lang_pred string, score double, n_trigrams long")


def held_out(id: str = "doc_id") -> Column:
    """The third of all documents that nothing is learned from."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit("")).cast("binary")) % 3 == 1
