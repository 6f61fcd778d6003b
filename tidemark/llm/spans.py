"""Where patterns match, in code points, as array expressions.

Spark gives the text of all matches but not their places. Splitting at the same
pattern gives what lies between them, and lengths add up to places. Sums run in
chunks, so that a text with very many matches costs little more than its length.

Patterns must not match the empty string. For spans of any length, repeated groups
are possessive: the JVM follows other repeated groups by recursion.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

CHUNK = 512
SPAN = "struct<start:int,end:int,hit:string,part:string>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, which is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def _running(pairs: Column, base: Column) -> Column:
    """Spans of (hit, gap, part) triples, the first gap starting at `base`."""

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"), x["part"].alias("part"))
        return F.struct(end.alias("at"), F.concat(so_far["out"], F.array(span)).alias("out"))

    return F.aggregate(pairs, F.struct(base.alias("at"), _none(SPAN).alias("out")), step, lambda s: s["out"])


def _prefix(lengths: Column) -> Column:
    """Sum of all earlier elements, for each element."""
    return F.aggregate(
        lengths,
        F.struct(F.lit(0).alias("at"), _none("int").alias("out")),
        lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
        lambda s: s["out"],
    )


def _placed(pairs: Column) -> Column:
    def chunk(c: Column) -> Column:
        return F.slice(pairs, c * CHUNK + 1, F.lit(CHUNK))

    chunks = F.sequence(F.lit(0), ((F.size(pairs) - 1) / CHUNK).cast("int"))
    lengths = F.transform(chunks, lambda c: F.aggregate(chunk(c), F.lit(0), lambda s, x: s + F.length(x["gap"]) + F.length(x["hit"])))
    return let(_prefix(lengths), lambda bases: F.flatten(F.transform(chunks, lambda c: _running(chunk(c), bases[c]))))


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """array<struct<start, end, hit, part>> of all matches, leftmost first, none
    overlapping; `part` is the text of `group`. The end is exclusive."""

    def place(hits: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
        # The last gap has no match behind it.
        triples = F.zip_with(
            F.arrays_zip(hits.alias("hit"), parts.alias("part")),
            F.slice(gaps, F.lit(1), F.size(hits)),
            lambda x, gap: F.struct(x["hit"].alias("hit"), gap.alias("gap"), x["part"].alias("part")),
        )
        return F.when(F.size(hits) == 0, _none(SPAN)).otherwise(let(triples, _placed))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def kind_of(spans: Column, kind: str, rank: int) -> Column:
    """The spans as struct<rank, kind, start, end, hit>."""
    return F.transform(
        spans,
        lambda x: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit")),
    )


def in_order(spans: Column, *fields: str) -> Column:
    """Sorted by the fields named."""
    keyed = F.transform(spans, lambda x: F.struct(*(x[f].alias(f"by_{f}") for f in fields), x["end"].alias("by_end"), x.alias("span")))
    return F.transform(F.array_sort(keyed), lambda x: x["span"])


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def characters(text: Column) -> Column:
    return F.split(text, "")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
