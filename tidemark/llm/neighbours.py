"""Approximate nearest neighbours by NN-descent.

Equal vectors are one node. Nodes start with neighbours from runs of a projected
order; then, round by round, the neighbours of each node are introduced to each
other: a join brings their vectors together, and whoever is nearer than a node's
furthest neighbour takes its place. Only pairs with a neighbour that came in the
last round are looked at. A query node is searched greedily: the nearest unexpanded
nodes of its beam are joined with the graph, until the whole beam is expanded.

The graph and the search use the vectors as they were given, and distances in double
precision, so that members of a dense group are told apart; the best of a beam get
their score from the rows themselves. Every join is on a node, lists are bounded by NEIGHBOURS, INTRODUCED
and BEAM, and of a group of equal vectors only as many members travel as a result
can name.

Defined results: vectors that are null, zero, of another length than most, or that
hold a null or a component that is not finite take no part, nor do rows without
an identifier. Fewer candidates than wanted give fewer rows; none give no rows.
Ties go to the smaller identifier. Recall is measured in the tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import dropped, in_arrow, ship, staged
from tidemark.llm.spans import let

NEIGHBOURS = 24
INTRODUCED = 16  # of those that name a node as theirs
PARTS = 4  # rows that the links of a node are dealt over, so that a batch of them stays small
OFFERED = 8  # nearest ones that a node is offered by one introduction
ROUNDS = 6
SETTLED = 0.02  # share of neighbours that changed, below which rounds end
RUN, ORDERS = 64, 2
BEAM, EXPANDED = 512, 128
NODES_A_TASK = 20_000
EXACT = 64
SEED = 10
NEAREST_ROWS = "node long, ids array<long>, far array<double>, fresh array<boolean>"


def usable(embedding: Column) -> Column:
    """Whether a vector takes part."""
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & (F.size(embedding) > 0) & good & F.exists(embedding, lambda x: x != 0)


def _unpack(vectors: pa.Array, layout: np.dtype) -> np.ndarray:
    # The values of a binary column lie in one buffer, here all of one length.
    (size,) = layout.shape
    raw = np.frombuffer(vectors.buffers()[2] or b"", layout.base, len(vectors) * size, vectors.offset * layout.itemsize)
    return raw.reshape(-1, size).astype(np.float64)


def _packer(layout: np.dtype):
    """Vectors as bytes that lose nothing, and their place in the projected orders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = np.array(batch.column("vec").to_pylist(), np.float64)
            rng = np.random.default_rng([SEED, whole.shape[1]])
            codes = []
            for _ in range(ORDERS):
                planes = rng.standard_normal((whole.shape[1], 24))
                codes.append(((whole / np.abs(whole).max()) @ planes > 0) @ (1 << np.arange(24)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([r.tobytes() for r in whole.astype(layout.base)], pa.binary()),
                 pa.array([list(c) for c in zip(*(c.tolist() for c in codes))], pa.list_(pa.int64()))],
                ["node", "bytes", "codes"],
            )

    return run


def _grouped(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    return starts, np.diff(np.append(starts, len(rows)))


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _best(node: np.ndarray, other: np.ndarray, far: np.ndarray, fresh: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The `most` nearest distinct others of each node; of repeats the settled one."""
    keep = node != other
    node, other, far, fresh = node[keep], other[keep], far[keep], fresh[keep]
    order = np.lexsort((fresh, other, node))
    node, other, far, fresh = node[order], other[order], far[order], fresh[order]
    keep = np.append(True, (node[1:] != node[:-1]) | (other[1:] != other[:-1])) if len(node) else np.zeros(0, bool)
    node, other, far, fresh = node[keep], other[keep], far[keep], fresh[keep]
    order = np.lexsort((other, far, node))
    node, other, far, fresh = node[order], other[order], far[order], fresh[order]
    starts, lengths = _grouped(node)
    keep = np.arange(len(node)) - np.repeat(starts, lengths) < most
    return node[keep], other[keep], far[keep], fresh[keep]


def _list_rows(node: np.ndarray, other: np.ndarray, far: np.ndarray, fresh: np.ndarray) -> Iterator[pa.RecordBatch]:
    starts, lengths = _grouped(node)
    for i in range(0, len(starts), 4096):
        a, n = starts[i], lengths[i : i + 4096]
        part = slice(a, a + n.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(node[starts[i : i + 4096]]), _lists(other[part], n, pa.int64()), _lists(far[part], n, pa.float64()),
             _lists(fresh[part], n, pa.bool_())],
            ["node", "ids", "far", "fresh"],
        )


def _squared(vectors: np.ndarray) -> np.ndarray:
    """Squared distances within each group of a (groups, members, size) array."""
    # Seen from a member, near ones do not drown in their distance from the origin.
    vectors = vectors - vectors[:, :1]
    square = np.einsum("gmd,gmd->gm", vectors, vectors)
    return np.maximum(square[:, :, None] + square[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1), 0)


def _starter(layout: np.dtype):
    """Neighbours within runs of RUN rows of an order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def near(nodes: np.ndarray, vectors: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(nodes), RUN):
                # A short last run goes back into the one before.
                a = max(0, min(i, len(nodes) - RUN))
                own, far = nodes[a : a + RUN], _squared(vectors[None, a : a + RUN])[0]
                n = len(own)
                yield from _list_rows(
                    *_best(np.repeat(own, n), np.tile(own, n), far.reshape(-1), np.ones(n * n, bool), NEIGHBOURS)
                )

        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("node").to_numpy(), _unpack(batch.column("bytes"), layout)))
            if sum(len(n) for n, _ in held) >= 64 * RUN:
                yield from near(*(np.concatenate(x) for x in zip(*held)))
                held = []
        if held:
            yield from near(*(np.concatenate(x) for x in zip(*held)))

    return run


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Rows in tables that never split a run of equal `column`."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        values = rest.column(column).to_numpy()
        last = np.searchsorted(values != values[-1], False) if values[0] == values[-1] else len(values) - np.argmax((values != values[-1])[::-1])
        if last and len(values) >= 4096:
            yield rest.slice(0, last).combine_chunks()
            rest = rest.slice(last)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _introducer(layout: np.dtype):
    """Members of each node meet; offers are merged per task before they leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        offers: list[tuple[np.ndarray, ...]] = []
        count = 0
        for table in _runs(batches, "at"):
            at, member = table.column("at").to_numpy(), table.column("member").to_numpy()
            # Who names a node and is named by it comes twice, last as a fresh one if it is.
            last = np.append((at[1:] != at[:-1]) | (member[1:] != member[:-1]), True)
            table = table.filter(pa.array(last)).combine_chunks()
            at, member = at[last], member[last]
            radius, fresh = table.column("radius").to_numpy(), table.column("fresh").to_numpy()
            vectors = _unpack(table.column("bytes").combine_chunks(), layout)
            starts, lengths = _grouped(at)
            for i in range(0, len(starts), 256):
                first, n = starts[i : i + 256], lengths[i : i + 256]
                width = int(n.max())
                place = first[:, None] + np.minimum(np.arange(width)[None, :], n[:, None] - 1)
                real = np.arange(width)[None, :] < n[:, None]
                far, own, new = _squared(vectors[place]), member[place], fresh[place]
                shut = ~(real[:, :, None] & real[:, None, :] & (new[:, :, None] | new[:, None, :]))
                shut |= own[:, :, None] == own[:, None, :]
                far[shut | (far >= radius[place][:, :, None])] = np.inf
                if width > OFFERED:
                    pick = np.argpartition(far, OFFERED, axis=2)[:, :, :OFFERED]
                    value, other = np.take_along_axis(far, pick, 2), np.take_along_axis(np.broadcast_to(own[:, None, :], far.shape), pick, 2)
                else:
                    value, other = far, np.broadcast_to(own[:, None, :], far.shape)
                ok = np.isfinite(value)
                offers.append((np.broadcast_to(own[:, :, None], value.shape)[ok], other[ok], value[ok]))
                count += len(offers[-1][0])
                if count > 1_500_000:
                    yield from merged(offers)
                    offers, count = [], 0
        if offers:
            yield from merged(offers)

    def merged(offers: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        node, other, far = (np.concatenate(x) for x in zip(*offers))
        yield from _list_rows(*_best(node, other, far, np.ones(len(node), bool), NEIGHBOURS))

    return run


def _flat(table: pa.Table) -> tuple[np.ndarray, ...]:
    ids = table.column("ids").combine_chunks()
    lengths = np.diff(ids.offsets.to_numpy())
    node = np.repeat(table.column("node").to_numpy(), lengths)
    far = table.column("far").combine_chunks().flatten().to_numpy()
    fresh = table.column("fresh").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return node, ids.flatten().to_numpy(), far, fresh


def _joiner(most: int):
    """Lists of one node into one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, "node"):
            yield from _list_rows(*_best(*_flat(table), most))

    return run


def _by(df: DataFrame, tasks: int, *columns: str) -> DataFrame:
    """Rows of one value of the first column together, in the order of all, in as many
    tasks as there is work for: rounds are many, and every task starts a worker."""
    return df.repartition(columns[0]).coalesce(tasks).sortWithinPartitions(*columns)


def _merged_lists(lists: DataFrame, most: int, tasks: int) -> DataFrame:
    return in_arrow(_by(lists, tasks, "node"), _joiner(most), NEAREST_ROWS)


def neighbour_graph(small: DataFrame, layout: np.dtype, tasks: int) -> DataFrame:
    """node, ids, far, fresh: the neighbours of each node, nearest first, with
    squared distances, from rows (node, bytes, codes)."""
    graph = None
    for order in range(ORDERS):
        in_order = small.withColumn("code", F.col("codes")[order]).repartitionByRange("code", "node").coalesce(tasks).sortWithinPartitions("code", "node")
        lists = in_arrow(in_order.select("node", "bytes"), _starter(layout), NEAREST_ROWS)
        graph = lists if graph is None else graph.unionByName(lists)
    graph = staged(_merged_lists(graph, NEIGHBOURS, tasks), "graph")
    vectors = small.select(F.col("node").alias("of"), "bytes")
    for turn in range(ROUNDS):
        edges = graph.select("node", F.posexplode(F.arrays_zip("ids", "fresh")).alias("i", "e")).select(
            "node", F.col("e.ids").alias("id"), F.col("e.fresh").alias("fresh")
        )
        chosen = Window.partitionBy("id").orderBy(F.xxhash64(F.lit(turn), "node"), "node")
        back = edges.withColumn("n", F.row_number().over(chosen)).where(F.col("n") <= INTRODUCED)
        meeting = edges.select(F.col("node").alias("at"), F.col("id").alias("member"), "fresh").unionByName(
            back.select(F.col("id").alias("at"), F.col("node").alias("member"), "fresh")
        )
        # A full list takes only nearer ones, a short one any.
        radius = graph.select(
            F.col("node").alias("of"), F.when(F.size("far") >= NEIGHBOURS, F.element_at("far", -1)).otherwise(float("inf")).alias("radius")
        )
        known = vectors.join(radius, "of")
        meeting = meeting.join(known, F.col("member") == F.col("of")).select("at", "member", "fresh", "radius", "bytes")
        offers = in_arrow(_by(meeting, tasks, "at", "member", "fresh"), _introducer(layout), NEAREST_ROWS)
        settled = graph.withColumn("fresh", F.transform("fresh", lambda _: F.lit(False)))
        after = staged(_merged_lists(settled.unionByName(offers), NEIGHBOURS, tasks), "graph")
        dropped(graph)
        graph = after
        changed = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x))), F.sum(F.size("fresh"))).collect()[0]
        if not changed[1] or changed[0] < SETTLED * changed[1]:
            break
    return graph


def _searcher(layout: np.dtype):
    """Distances of a query to the neighbours of the nodes it expands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            query = _unpack(batch.column("q_bytes"), layout)
            ids, packed = batch.column("links"), batch.column("link_bytes")
            for i in range(0, batch.num_rows, 512):
                part = ids.slice(i, 512)
                lengths = np.diff(part.offsets.to_numpy())
                vectors = _unpack(packed.slice(i, 512).flatten(), layout)
                far = np.square(vectors - np.repeat(query[i : i + 512], lengths, axis=0)).sum(1)
                node = np.repeat(batch.column("q").slice(i, 512).to_numpy(), lengths)
                yield from _list_rows(*_sorted(node, part.flatten().to_numpy(), far))

    return run


def _sorted(node: np.ndarray, other: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort((other, far, node))
    return node[order], other[order], far[order], np.ones(len(order), bool)


def search(graph: DataFrame, small: DataFrame, queries: DataFrame, layout: np.dtype, tasks: int) -> DataFrame:
    """node, ids, far, fresh: the beam of each query node, from (node) rows. A node
    is not in its own beam."""
    spark = graph.sparkSession
    vectors = small.select(F.col("node").alias("of"), "bytes")
    edges = graph.select("node", F.explode(F.arrays_zip("ids", "far")).alias("e")).select("node", F.col("e.ids").alias("id"), F.col("e.far").alias("far"))
    nearest = Window.partitionBy("id").orderBy("far", "node")
    back = edges.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= NEIGHBOURS)
    both = edges.select("node", "id").unionByName(back.select(F.col("id").alias("node"), F.col("node").alias("id"))).distinct()
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS))
    linked = both.join(vectors, F.col("id") == F.col("of")).groupBy(F.col("node").alias("u"), part.alias("p")).agg(F.collect_list(F.struct("id", "bytes")).alias("l"))
    # Written in buckets of the node, so that no round of the search moves the graph.
    name = f"graph_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = linked.select("u", F.col("l.id").alias("links"), F.col("l.bytes").alias("link_bytes")).repartition("u")
    try:
        dealt.write.bucketBy(buckets, "u").saveAsTable(name)
        return _searched(spark.table(name), vectors, queries, layout, tasks)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _searched(links: DataFrame, vectors: DataFrame, queries: DataFrame, layout: np.dtype, tasks: int) -> DataFrame:
    asked = staged(
        queries.join(vectors, F.col("node") == F.col("of")).select("node", F.col("bytes").alias("q_bytes")).coalesce(tasks), "asked"
    )
    beam, written = asked.select("node", F.array("node").alias("ids"), F.array(F.lit(0.0)).alias("far"), F.array(F.lit(True)).alias("fresh")), None
    while True:
        # A beam is sorted, so its first unexpanded entries are the nearest.
        ahead = F.slice(F.filter(F.arrays_zip("ids", "fresh"), lambda e: e["fresh"]), 1, EXPANDED)["ids"]
        front = beam.select("node", F.explode(ahead).alias("u")).join(asked.withColumnRenamed("node", "q"), F.col("node") == F.col("q"))
        met = front.select("q", "q_bytes", F.col("u").alias("v")).join(links, F.col("v") == F.col("u")).coalesce(tasks)
        offers = in_arrow(met.select("q", "q_bytes", "links", "link_bytes"), _searcher(layout), NEAREST_ROWS)
        spent = beam.select(
            "node",
            "ids",
            "far",
            let(ahead, lambda a: F.zip_with("ids", "fresh", lambda x, f: f & ~F.array_contains(a, x))).alias("fresh"),
        )
        beam = staged(_merged_lists(spent.unionByName(offers), BEAM, tasks), "beam")
        if written is not None:
            dropped(written)
        written = beam
        if beam.where(F.exists("fresh", lambda x: x)).isEmpty():
            return beam


def nearest(table: DataFrame, queries: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of `table` where
    `queries` holds, its `k` nearest other rows by Euclidean distance."""
    ship(table.sparkSession)
    rows = table.select(
        F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), F.coalesce(queries, F.lit(False)).alias("asked")
    )
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    size = sizes[0]["size"] if sizes else 1
    # Single precision holds what came in it; anything else is kept in double.
    single = table.select(vector).schema[0].dataType.simpleString() == "array<float>"
    layout = np.dtype(("<f4" if single else "<f8", (size,)))
    keyed = rows.where(F.size("vec") == size).withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(SEED), "vec")})
    # Of equal vectors the first k + 1 are enough to answer any query.
    place = Window.partitionBy("k1", "k2").orderBy("id")
    first = keyed.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k + 1)
    members = staged(first.select("k1", "k2", "place", "id", F.when(F.col("place") == 1, F.col("vec")).alias("vec")), "members")
    heads = members.where("place = 1").select(F.col("id").alias("node"), F.col("k1").alias("h1"), F.col("k2").alias("h2"), "vec")
    small = staged(in_arrow(heads.select("node", "vec"), _packer(layout), "node long, bytes binary, codes array<long>"), "small")

    asked = keyed.where("asked").select("id", "k1", "k2")
    same = (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2"))
    asking = staged(asked.join(heads.drop("vec"), same).select("id", "node"), "asking")
    tasks = max(2 * table.sparkSession.sparkContext.defaultParallelism, small.count() // NODES_A_TASK)
    beams = search(neighbour_graph(small, layout, tasks), small, asking.select("node").distinct(), layout, tasks)

    found = beams.select("node", F.explode(F.concat(F.array("node"), F.slice("ids", 1, EXACT))).alias("hit"))
    exact = found.join(heads.select(F.col("node").alias("a"), F.col("vec").alias("a_vec")), F.col("node") == F.col("a"))
    exact = exact.join(heads.select(F.col("node").alias("b"), F.col("vec").alias("b_vec"), "h1", "h2"), F.col("hit") == F.col("b"))
    score = F.sqrt(F.aggregate(F.zip_with("a_vec", "b_vec", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    scored = exact.select("node", score.alias("score"), "h1", "h2").join(members.select("k1", "k2", "id"), same)
    lists = scored.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(F.struct("score", "id"))), 1, k + 1).alias("l"))
    answers = asking.withColumnRenamed("node", "at").join(lists, F.col("at") == F.col("node"))
    others = F.slice(F.filter("l", lambda x: x["id"] != F.col("id")), 1, k)
    return answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("i", "x")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("x.id").alias(id), F.col("x.score").alias("score")
    )
