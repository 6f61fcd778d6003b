"""Exact duplicates by Patricia-trie owners.

1. Each input partition inserts its texts into a trie. Rows of equal text in one
   partition share a representative, so a group that holds a third of the table
   leaves at most one text per partition.
2. The representatives are dealt out by length and content hash. The owner of a
   partition inserts their whole byte strings into a trie whose terminal nodes
   hold the best identifier and the group's size. Beyond its budget an owner
   spills subtrees.
3. The owners' verdicts, one short row per representative, go back to the rows.

Defined results: null text counts as empty; a null identifier is worse than any
other; of rows that share both text and identifier one is kept, the first read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import claim, encoded, in_arrow, staged, whole_text
from tidemark.llm.patricia import Patricia

LOCAL_BUDGET = 32 << 20
OWNER_BUDGET = 256 << 20
ROWS = 2048

LOCAL = "row long, id long, rep long, sha string, body binary, length long, best long, best_row long, n long"
OWNED = "rep long, keep_id long, keep_row long, group_size long"


def _better(a: tuple, b: tuple, largest: bool) -> bool:
    """Whether (id, row) `a` beats `b`: nulls lose, ties go to the earlier row."""
    if a[0] is None or b[0] is None:
        return (a[0] is not None, -a[1]) > (b[0] is not None, -b[1])
    return ((a[0] if largest else -a[0]), -a[1]) > ((b[0] if largest else -b[0]), -b[1])


def _merger(largest: bool):
    """Payload: [representatives, best id, its row, rows]."""

    def merge(old: list, new: list) -> list:
        old[0].extend(new[0])
        old[3] += new[3]
        if _better((new[1], new[2]), (old[1], old[2]), largest):
            old[1], old[2] = new[1], new[2]
        return old

    return merge


def _blank(n: int, *types: pa.DataType) -> list[pa.Array]:
    return [pa.nulls(n, t) for t in types]


def _local(largest: bool):
    fields = [("row", pa.int64()), ("id", pa.int64()), ("rep", pa.int64()), ("sha", pa.string()), ("body", pa.binary()),
              ("length", pa.int64()), ("best", pa.int64()), ("best_row", pa.int64()), ("n", pa.int64())]
    names, (I, S, B) = [f for f, _ in fields], (pa.int64(), pa.string(), pa.binary())
    merge = _merger(largest)

    def keep_first(old: list, new: list) -> list:
        reps = old[0]
        merge(old, new)
        del reps[1:]
        return old

    def leads(held: dict[int, tuple[bytes, str]], trie: Patricia) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for (rep,), best, best_row, n in trie.items():
            body, sha = held.pop(rep)
            out.append((rep, sha, body, len(body), best, best_row, n))
            size += len(body)
            if len(out) == ROWS or size > 16 << 20:
                yield lead_batch(out)
                out, size = [], 0
        if out:
            yield lead_batch(out)

    def lead_batch(out: list[tuple]) -> pa.RecordBatch:
        rep, sha, body, length, best, best_row, n = zip(*out)
        return pa.RecordBatch.from_arrays(
            [*_blank(len(out), I, I), pa.array(rep, I), pa.array(sha, S), pa.array(body, B), pa.array(length, I),
             pa.array(best, I), pa.array(best_row, I), pa.array(n, I)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("exact_dedup", lambda: None)
        row = TaskContext.get().partitionId() << 33
        trie, held, whole = Patricia(keep_first, 1 << 62), {}, 0
        for batch in batches:
            ids, bodies = batch.column(0).to_pylist(), encoded(batch.column(1))
            reps, shas, first = [], [], row
            for id, body in zip(ids, bodies):
                sha = hashlib.sha256(body).hexdigest()
                rep = trie.insert(body, [[row], id, row, 1])[0][0]
                if rep == row:
                    held[rep] = (body, sha)
                    whole += len(body)
                reps.append(rep)
                shas.append(sha)
                row += 1
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(first, row), I), batch.column(0).cast(I), pa.array(reps, I), pa.array(shas, S),
                 *_blank(n, B, I, I, I, I)], names)
            # Texts with a long beginning in common add little to the trie, but are held whole.
            if trie.held + whole > 2 * LOCAL_BUDGET:
                yield from leads(held, trie)
                trie, held, whole = Patricia(keep_first, 1 << 62), {}, 0
        yield from leads(held, trie)

    return run


def _owner(largest: bool, budget: int):
    names = ["rep", "keep_id", "keep_row", "group_size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("exact_dedup", lambda: None)
        trie = Patricia(_merger(largest), budget)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for rep, body, best, best_row, n in zip(*columns):
                trie.insert(body, [[rep], best, best_row, n])
        out: list[tuple] = []
        for reps, best, best_row, n in trie.items():
            out.extend((rep, best, best_row, n) for rep in reps)
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    return run


def duplicate_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest", budget: int = OWNER_BUDGET
) -> DataFrame:
    """One row per input row: `id`, keep_id, group_size, kept, text_sha256.

    `keep` ("largest" or "smallest") says which identifier of a group stays.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    largest = keep == "largest"
    read = docs.select(F.col(id).cast("long").alias("id"), whole_text(text).alias("body"))
    local = staged(in_arrow(read, _local(largest), LOCAL), "exact-local")
    leads = local.where("body IS NOT NULL").select("rep", "body", "best", "best_row", "n", "length", "sha")
    owned = in_arrow(
        leads.repartition("length", "sha").select("rep", "body", "best", "best_row", "n"), _owner(largest, budget), OWNED
    )
    rows = local.where("row IS NOT NULL").select("row", "id", "rep", "sha")
    return rows.join(owned, "rep").select(
        F.col("id").alias(id),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest") -> DataFrame:
    """The rows of `docs` whose text stays, all columns, each kept document once."""


    def named(sha: Column) -> Column:
        """A document by text and identifier; one column, so that one shuffle serves
        both the join and the removal of repeated rows."""
        return F.concat_ws(":", sha, F.coalesce(F.col(id).cast("long").cast("string"), F.lit("-")))

    stays = duplicate_groups(docs, id, text, keep).where("kept").select(named(F.col("text_sha256")).alias("_stays"))
    tagged = docs.withColumn("_document", named(F.sha2(whole_text(text), 256)))
    found = tagged.join(stays.hint("merge"), F.col("_document") == F.col("_stays"), "left_semi")
    return found.dropDuplicates(["_document"]).drop("_document")
