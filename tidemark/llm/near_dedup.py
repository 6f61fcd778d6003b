"""Near duplicates: banded MinHash candidates, sequential Bayesian verification.

1. Every text becomes its set of word shingles, a MinHash signature and a
   fingerprint of the set. Texts of one set are one node.
2. Bands of the signature name buckets. Every member of a bucket is compared with
   a few pivots, which joins most near copies into components. What then still
   shares a bucket with another component visits packs: bounded blocks of the
   bucket's members of about one size, against all of which it is compared in one
   step. Visitors first come with their signature and their prefix, the rarest
   shingles of their set, of which two linked sets share one. Only packs in which a
   member passes both tests are visited with the text. No pair that could join two
   components is left out, and no pairs of a group are made; a group of templates
   that are alike but not linked costs texts only where their rare shingles meet.
3. A pair's signatures are compared a batch at a time. After each batch the pair
   is dropped if the posterior probability that its similarity reaches the
   threshold is below `miss`. Survivors are decided on their full sets.

A pair at the threshold shares no band with probability (1 - t**ROWS)**BANDS,
1.2e-7 at 0.8. Signatures keep 16 bits a hash, which can only add candidates.

Shingles are compared by 64-bit hashes. Defined results: null text counts as
empty; texts without words are linked with nothing; texts with fewer words than a
shingle have one shingle, the whole sequence. A null identifier is larger than
any other. The first row of the smallest identifier of a component stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import claim, in_arrow, staged
from tidemark.llm.components import components

ROWS, BANDS = 5, 40
HASHES = ROWS * BANDS
BATCH = 20
MISS = 1e-9
SEED = 4
PIVOTS = 4
# A pack holds about so many members, and so many shingles, and is copied for every
# so many visitors.
PACK, PACK_SHINGLES, VISITORS = 256, 1 << 19, 4096
# Shingles are ordered by how often their cell of hashes occurs, then by hash. Any
# order is right; rare ones first let few sets meet.
CELL_BITS = 18
CACHED_WORDS = 200_000
ROWS_AT_ONCE = 2048
ODD = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_words = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles. Words are what ASCII white
    space separates; A-Z are lowered."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(k, len(hashes))
    with np.errstate(over="ignore"):
        found = np.full(len(hashes) - width + 1, width, np.uint64)
        for i in range(width):
            found = _mixed(found * ODD + hashes[i : len(hashes) - width + 1 + i])
    return np.unique(found)


@lru_cache(maxsize=1)
def _family() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1), rng.integers(0, 1 << 32, HASHES, np.uint32)


def signature(found: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function, folded to 16 bits."""
    odd, add = _family()
    low = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    folded = (found >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(folded), 256):
        np.minimum(low, (folded[i : i + 256, None] * odd + add).min(0), out=low)
    return (low ^ (low >> np.uint32(16))).astype(np.uint16)


def _signer(k: int, text_at: int, id_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dedup", _words.clear)
        row = TaskContext.get().partitionId() << 33
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            doc = batch.column(0)
            sizes, prints, signs = [], [], []
            for text in doc.field(text_at).to_pylist():
                found = shingle_set(text, k)
                sizes.append(len(found))
                prints.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                signs.append(signature(found).tobytes() if len(found) else None)
            rows = pa.array(range(row, row + len(sizes)), pa.int64())
            row += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [doc, rows, doc.field(id_at).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())],
                ["doc", "row", "id", "n", "fp", "sig"],
            )

    return run


@lru_cache(maxsize=8)
def least_matches(percent: int, miss: float) -> tuple[int, ...]:
    """By number of batches: the fewest matches at which the posterior chance of
    reaching the threshold, with all similarities alike before, is `miss`."""
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        # The tail of a beta distribution is that of a binomial with one more draw.
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        out.append(m)
    return tuple(out)


def _survivors(percent: int, miss: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dedup", _words.clear)
        least = least_matches(percent, miss)
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int32)
            for i, needed in enumerate(least):
                part = slice(i * BATCH, (i + 1) * BATCH)
                matches[alive] += (a[alive, part] == b[alive, part]).sum(1, dtype=np.int32)
                alive = alive[matches[alive] >= needed]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return run


def _verifier(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dedup", _words.clear)
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            linked = []
            columns = (batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))
            for a, b, text_a, text_b in zip(*columns):
                if len(sets) > 512:
                    sets.clear()
                for node, text in ((a, text_a), (b, text_b)):
                    if node not in sets:
                        sets[node] = shingle_set(text, k)
                x, y = sets[a], sets[b]
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _on(table: DataFrame, side: DataFrame, test: Column, how: str = "inner") -> DataFrame:
    """A join whose sides both grow with the table: shuffled at every size."""
    return table.join(side.hint("merge"), test, how)


def _linked(pairs: DataFrame, nodes: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) with `linked`; pairs the posterior rules out are not in it."""

    def with_column(table: DataFrame, end: str, column: str) -> DataFrame:
        side = nodes.select(F.col("node").alias(f"at_{end}"), F.col(column).alias(f"{column}_{end}"))
        return _on(table, side, F.col(end) == F.col(f"at_{end}")).drop(f"at_{end}")

    signed = with_column(with_column(pairs, "a", "sig"), "b", "sig").select("a", "b", "sig_a", "sig_b")
    left = staged(in_arrow(signed, _survivors(percent, miss), "a long, b long"), "near-survivors")
    texts = with_column(with_column(left, "a", "text"), "b", "text").select("a", "b", "text_a", "text_b")
    return staged(in_arrow(texts, _verifier(k, percent), "a long, b long, linked boolean"), "near-verified")


def _grown(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, comp) after the links (a, b) have joined components."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(f"at_{end}"), F.col("comp").alias(f"comp_{end}"))
        ends = ends.join(own, F.col(end) == F.col(f"at_{end}"))
    roots = components(ends.select(F.col("comp_a").alias("u"), F.col("comp_b").alias("v")))
    grown = labels.join(roots, F.col("comp") == F.col("u"), "left").select("node", F.coalesce("root", "comp").alias("comp"))
    return staged(grown, "near-labels")


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, comp, most) of the buckets that hold several components; `most`
    is the component with most members there."""
    own = labels.select(F.col("node").alias("of"), "comp")
    labelled = _on(members, own, F.col("node") == F.col("of")).select("key", "node", "comp")
    sizes = labelled.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least"))
    several = sizes.groupBy(F.col("key").alias("in_key")).agg(
        F.count(F.lit(1)).alias("comps"), F.max_by("comp", F.struct("size", "comp")).alias("most"), F.min("least").alias("least")
    )
    several = several.where("comps > 1")
    return staged(_on(labelled, several, F.col("key") == F.col("in_key")).select("key", "node", "comp", "most", "least"), "near-open")


def _pivot_pairs(members: DataFrame) -> DataFrame:
    """Distinct (a, b): members of a bucket and its PIVOTS first ones, in one order
    of all nodes, so that the buckets of one group choose the same pivots. A node
    gathers its buckets' pivots before pairs are made, as near copies share many."""
    place = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(SEED), "node"), "node")
    first = members.withColumn("place", F.row_number().over(place)).where(F.col("place") <= PIVOTS)
    lists = first.groupBy(F.col("key").alias("in_key")).agg(F.collect_list("node").alias("list"))
    met = _on(members, lists, F.col("key") == F.col("in_key")).groupBy("node").agg(F.collect_set("list").alias("lists"))
    others = F.filter(F.array_distinct(F.flatten("lists")), lambda p: p != F.col("node"))
    return met.select("node", F.explode(others).alias("p")).select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b")).distinct()


def least_shared(size: np.ndarray | int, other: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that sets of these sizes share if they are linked."""
    return -(-percent * (size + other) // (100 + percent))


def prefix(found: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a set, in the order of all, that suffice for any partner:
    the smallest it may have is `percent` of its size."""
    order = np.lexsort((found, counts[found >> np.uint64(64 - CELL_BITS)]))
    least = least_shared(len(found), -(-percent * len(found) // 100), percent)
    return found[order[: len(found) - least + 1]]


def _cells(k: int):
    """Shingles a cell of hashes, for the texts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dedup", _words.clear)
        counts = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts += np.bincount((shingle_set(text, k) >> np.uint64(64 - CELL_BITS)).astype(np.intp), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["cell", "n"])

    return run


def _prefixes(k: int, percent: int, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dedup", _words.clear)
        for batch in batches:
            found = (shingle_set(text, k) for text in batch.column("text").to_pylist())
            firsts = [prefix(f, counts, percent).tobytes() for f in found]
            columns = [batch.column(c) for c in ("node", "n", "sig")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(firsts, pa.binary())], ["node", "n", "sig", "prefix"])

    return run


def _profiles(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """(node, n, sig, prefix). What reaches the driver is one count a cell, of which
    there are 2**CELL_BITS at any size of the table."""
    cells = in_arrow(nodes.select("text"), _cells(k), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = cells.toArrow()
    counts = np.zeros(1 << CELL_BITS, np.int32)
    counts[found["cell"].to_numpy()] = np.minimum(found["n"].to_numpy(), np.iinfo(np.int32).max)
    read = nodes.select("node", "n", "sig", "text")
    return staged(in_arrow(read, _prefixes(k, percent, counts), "node long, n long, sig binary, prefix binary"), "near-profiles")


def _visits(left: DataFrame, profiles: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(home, node, comp) of the members of each pack and of the nodes that must be
    compared with them.

    Nodes with one smallest bucket mate form a pack group, cut by size, so that linked
    sets lie in neighbouring classes, and then by hash into parts. A node outside the
    largest component of a bucket visits the groups of all that bucket's members; of
    any two members in different components one is outside."""
    size_class = F.floor(F.log("n") / math.log(100 / percent * (1 + 1e-6)))
    classes = profiles.select(F.col("node").alias("of"), "n", size_class.alias("class"))
    group = left.groupBy(F.col("node").alias("member")).agg(F.min("least").alias("pack"), F.first("comp").alias("own"))
    group = _on(group, classes, F.col("member") == F.col("of")).drop("of")
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / PACK, F.sum("n") / PACK_SHINGLES))
    sizes = group.groupBy(F.col("pack").alias("of_pack"), F.col("class").alias("of_class")).agg(parts.alias("parts"))
    part = F.pmod(F.xxhash64(F.lit(SEED), "member"), "parts")
    same = (F.col("pack") == F.col("of_pack")) & (F.col("class") == F.col("of_class"))
    grouped = staged(
        _on(group, sizes, same).select("member", "own", "pack", "class", F.xxhash64("pack", "class", part).alias("home")),
        "near-packs",
    )
    met = _on(left.select("key", "node"), grouped.select("member", "pack", "class"), F.col("node") == F.col("member"))
    present = met.select(F.col("key").alias("in_key"), "pack", F.col("class").alias("in_class")).distinct()
    outside = _on(left.where("comp != most").select("key", "node", "comp"), classes, F.col("node") == F.col("of"))
    outside = outside.select("key", "node", "comp", F.explode(F.expr("sequence(class - 1, class + 1)")).alias("class"))
    visitors = _on(outside, present, (F.col("key") == F.col("in_key")) & (F.col("class") == F.col("in_class")))
    visitors = visitors.select("node", "comp", "pack", "class").distinct()
    homes = grouped.select(F.col("pack").alias("of_pack"), F.col("class").alias("of_class"), "home").distinct()
    visitors = staged(_on(visitors, homes, same).select("home", "node", "comp"), "near-visitors")
    return grouped.select("home", F.col("member").alias("node"), F.col("own").alias("comp")), visitors


def _hosted(members: DataFrame, visitors: DataFrame, bodies: DataFrame) -> DataFrame:
    """Members and visitors of the packs that have visitors, with their columns of
    `bodies`, in the order of (home, slice, visit). Many visitors of a pack are cut
    into slices, and each slice gets the members."""
    slices = visitors.groupBy(F.col("home").alias("at")).agg(F.ceil(F.count(F.lit(1)) / VISITORS).alias("slices"))
    own = F.pmod(F.xxhash64(F.lit(SEED + 1), "node"), "slices")
    come = _on(visitors, slices, F.col("home") == F.col("at")).select("home", own.alias("slice"), F.lit(1).alias("visit"), "node", "comp")
    each = F.explode(F.expr("sequence(0L, slices - 1)"))
    stay = _on(members, slices, F.col("home") == F.col("at")).select("home", each.alias("slice"), F.lit(0).alias("visit"), "node", "comp")
    named = bodies.withColumnRenamed("node", "of")
    rows = _on(stay.unionByName(come), named, F.col("node") == F.col("of")).drop("of")
    return rows.repartition("home", "slice").sortWithinPartitions("home", "slice", "visit", "node")


def _flat(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values in order, their arrays, and their places there."""
    lengths = [len(a) for a in arrays]
    owner, place = np.repeat(np.arange(len(arrays)), lengths), np.concatenate([np.arange(n) for n in lengths])
    flat = np.concatenate(arrays)
    order = np.argsort(flat, kind="stable")
    return flat[order], owner[order], place[order]


def _met(index: tuple[np.ndarray, np.ndarray, np.ndarray], found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in `found`, place in the index) of all equal values."""
    low, high = np.searchsorted(index[0], found, "left"), np.searchsorted(index[0], found, "right")
    n = high - low
    at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return np.repeat(np.arange(len(found)), n), at


class _Profiles:
    """The members of a pack by signature and prefix."""

    def __init__(self, percent: int, least: tuple[int, ...]):
        self.percent, self.least = percent, least
        self.rows: list[tuple] = []
        self.index = None

    def add(self, node: int, comp: int, *body) -> None:
        self.rows.append((comp, *body))

    def asked(self, node: int, comp: int, n: int, sig: bytes, first: bytes) -> bool:
        """Whether a member of another component may be linked with the visitor."""
        if self.index is None:
            comps, sizes, signs, firsts = zip(*self.rows)
            self.comp, self.size = np.array(comps), np.array(sizes)
            self.matrix = np.frombuffer(b"".join(signs), np.uint16).reshape(-1, HASHES)
            self.index = _flat([np.frombuffer(f, np.uint64) for f in firsts])
        fits = 100 * np.minimum(self.size, n) >= self.percent * np.maximum(self.size, n)
        alive = np.flatnonzero(fits & (self.comp != comp))
        own, matches = np.frombuffer(sig, np.uint16), np.zeros(len(alive), np.int32)
        for i, needed in enumerate(self.least):
            if not len(alive):
                return False
            part = slice(i * BATCH, (i + 1) * BATCH)
            matches += (self.matrix[alive, part] == own[part]).sum(1, dtype=np.int32)
            keep = matches >= needed
            alive, matches = alive[keep], matches[keep]
        left = np.zeros(len(self.size), bool)
        left[alive] = True
        here, at = _met(self.index, np.frombuffer(first, np.uint64))
        owner, there = self.index[1][at], self.index[2][at]
        # Of linked sets, the first shingle in common has all the others behind it.
        shared = least_shared(n, self.size[owner], self.percent)
        return bool((left[owner] & (here <= n - shared) & (there <= self.size[owner] - shared)).any())


class _Texts:
    """The members of a pack, with an index from shingles to those that have them."""

    def __init__(self, k: int, percent: int):
        self.k, self.percent = k, percent
        self.rows: list[tuple] = []
        self.index = None

    def add(self, node: int, comp: int, text: str) -> None:
        self.rows.append((node, comp, shingle_set(text, self.k)))

    def links(self, node: int, comp: int, text: str) -> list[int]:
        """Members of other components that the visitor is linked with."""
        if self.index is None:
            nodes, comps, sets = zip(*self.rows)
            self.node, self.comp = np.array(nodes), np.array(comps)
            self.size, self.index = np.array([len(s) for s in sets]), _flat(sets)
        found = shingle_set(text, self.k)
        both = np.bincount(self.index[1][_met(self.index, found)[1]], minlength=len(self.size))
        near = 100 * both >= self.percent * (len(found) + self.size - both)
        return self.node[near & (self.comp != comp)].tolist()


def _by_pack(batches: Iterator[pa.RecordBatch], new, meet, columns: tuple[str, ...]) -> Iterator[list]:
    """What `meet` (pack, home, visitor) finds, a batch at a time; members go into the
    pack that `new` makes. One pack is held at a time."""
    here, pack = None, None
    for batch in batches:
        found = []
        for home, part, visit, *row in zip(*(batch.column(c).to_pylist() for c in ("home", "slice", "visit", "node", "comp", *columns))):
            if (home, part) != here:
                here, pack = (home, part), new()
            if visit:
                found += meet(pack, home, row)
            else:
                pack.add(*row)
        yield found


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names)


def _asking(percent: int, miss: float):
    """The visits (home, node, comp) that texts are needed for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = least_matches(percent, miss)

        def meet(pack: _Profiles, home: int, row: list) -> list[tuple]:
            return [(home, row[0], row[1])] if pack.asked(*row) else []

        for found in _by_pack(batches, lambda: _Profiles(percent, least), meet, ("n", "sig", "prefix")):
            yield _table(found, ["home", "node", "comp"])

    return run


def _host(k: int, percent: int):
    """Links between the visitors of each pack and its members, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("near_dedup", _words.clear)

        def meet(pack: _Texts, home: int, row: list) -> list[tuple]:
            return [(row[0], other) for other in pack.links(*row)]

        for found in _by_pack(batches, lambda: _Texts(k, percent), meet, ("text",)):
            yield _table(found, ["a", "b"])

    return run


def _links_of_packs(left: DataFrame, nodes: DataFrame, k: int, percent: int, miss: float) -> DataFrame:
    """Links (a, b) between the components of open buckets."""
    own = left.select(F.col("node").alias("of")).distinct()
    bodies = staged(_on(nodes, own, F.col("node") == F.col("of"), "left_semi"), "near-open-nodes")
    profiles = _profiles(bodies, k, percent)
    members, visitors = _visits(left, profiles, percent)
    asked = in_arrow(_hosted(members, visitors, profiles), _asking(percent, miss), "home long, node long, comp long")
    asked = staged(asked, "near-asked")
    rows = _hosted(members, asked, bodies.select("node", "text"))
    return staged(in_arrow(rows, _host(k, percent), "a long, b long").distinct(), "near-visits")


def _components_of(signed: DataFrame, heads: DataFrame, text: str, k: int, percent: int, miss: float) -> DataFrame:
    """(node, comp) for the nodes that share a bucket with others."""
    width = 2 * ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * width + 1, F.lit(width)))
    )
    own = heads.select("node")
    named = _on(signed.select("row", "sig"), own, F.col("row") == F.col("node"), "left_semi").select(
        F.col("row").alias("node"), F.explode(bands).alias("key")
    )
    shared = named.groupBy(F.col("key").alias("in_key")).agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = staged(_on(named, shared, F.col("key") == F.col("in_key")).select("key", "node"), "near-members")
    labels = staged(members.select("node").distinct().withColumn("comp", F.col("node")), "near-labels")
    found = labels.select(F.col("node").alias("of"))
    nodes = signed.select(F.col("row").alias("node"), "n", "sig", F.col("doc").getField(text).alias("text"))
    nodes = staged(_on(nodes, found, F.col("node") == F.col("of"), "left_semi"), "near-nodes")

    pairs = staged(_pivot_pairs(members), "near-pairs")
    labels = _grown(labels, _linked(pairs, nodes, k, percent, miss).where("linked"))
    left = _open_buckets(members, labels)
    return _grown(labels, _links_of_packs(left, nodes, k, percent, miss))


def near_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80, miss: float = MISS,
    carry: list[str] | None = None,
) -> DataFrame:
    """struct `doc` of the columns `carry` (all by default), n_shingles,
    component_id and kept, one row per input row."""
    carry = docs.columns if carry is None else carry
    read = docs.select(F.struct(*carry).alias("doc"))
    kind = read.schema[0].dataType
    schema = f"doc {kind.simpleString()}, row long, id long, n long, fp binary, sig binary"
    signed = staged(in_arrow(read, _signer(k, carry.index(text), carry.index(id)), schema), "near-signed")

    best = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    heads = staged(
        signed.where("fp IS NOT NULL").groupBy("fp").agg(F.min("row").alias("node"), F.min(best).alias("best")), "near-heads"
    )
    labels = _components_of(signed, heads, text, k, percent, miss)

    own = labels.select(F.col("node").alias("of"), "comp")
    rooted = heads.join(own, F.col("node") == F.col("of"), "left").select("fp", "best", F.coalesce("comp", "node").alias("root"))
    top = rooted.groupBy(F.col("root").alias("at")).agg(F.min("best").alias("top"))
    verdict = rooted.join(top, F.col("root") == F.col("at")).select(F.col("fp").alias("of_fp"), "top")
    return _on(signed, verdict, F.col("fp") == F.col("of_fp"), "left").select(
        "doc",
        F.col("n").alias("n_shingles"),
        F.when(F.col("of_fp").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("top.row"), F.lit(True)).alias("kept"),
    )


def distinct_enough(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay: one of each component, all columns."""
    return near_groups(docs, **options).where("kept").select("doc.*")
