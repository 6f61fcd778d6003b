"""Secrets in whole texts, by DataFrame functions alone.

Base spans are assignments, access keys and hexadecimal strings. On top of them
candidate strings are judged by the Shannon entropy of a sliding window: one count
per character of the candidate's class, raised for the character that enters and
lowered for the one that leaves. A candidate is harmless if its whole shape is (an
identifier, a path of words), or if every window of it touches a placeholder, a run
or a sequence. What overlaps a base span is not reported again; what such a
candidate holds beside its base spans is judged on its own. A candidate without a
letter or without a digit is taken for a word or a number (about one random string
of 20 characters in thirty has no digit).

Defined results: null text counts as empty and has no spans; places are code
points, the end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import whole_text
from tidemark.llm.spans import characters, in_order, kind_of, let, located

# The base patterns in the JVM's syntax. A run is matched from its first character on.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_base64")

CANDIDATE = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{20,}+"
WINDOW = 20
# Class -> its characters and the bits a window must reach.
CLASSES = {
    "entropy_hex": ("0123456789abcdef", 3.0),
    "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 3.9),
}
WORD = r"(?:[A-Z]?[a-z]{1,15}+[0-9]{0,4}+|[A-Z]{1,15}+[0-9]{0,4}+|[0-9]{1,4}+)"
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    # No window lies clear of these.
    rf"^(?:.{{0,{WINDOW - 1}}}?(?:(?i:example|sample|placeholder|changeme|dummy|redacted|0123456789|abcdefghij)|(.)\1{{7,}}+))++.{{0,{WINDOW - 1}}}$",
    # A path: words with a short number behind, and numbers, to the very end.
    rf"^(?=[^/]*+/)[/_=+-]*+(?:{WORD}(?:[/_=+-]++|$))++$",
)


def window_entropy(text: Column, alphabet: str, bits: float, window: int = WINDOW) -> Column:
    """struct<from, to>: the part of `text` covered by windows of at least `bits`
    bits a character; from is null if there is none."""
    weights = F.array(*(F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 2)))

    def scan(place: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            entering, leaving = place[i], F.when(i >= window, place[i - window]).otherwise(F.lit(-1))

            def lowered(up: Column) -> Column:
                raised = F.transform(s["counts"], lambda n, k: n + F.when(k == entering, 1).otherwise(0))
                return let(
                    raised,
                    lambda c: F.struct(
                        F.transform(c, lambda n, k: n - F.when(k == leaving, 1).otherwise(0)).alias("counts"),
                        (up + F.when(leaving >= 0, weights[c[leaving] - 1] - weights[c[leaving]]).otherwise(0.0)).alias("sum"),
                    ),
                )

            up = s["sum"] + weights[s["counts"][entering] + 1] - weights[s["counts"][entering]]

            def mark(now: Column) -> Column:
                high = (i >= window - 1) & (F.lit(math.log2(window)) - now["sum"] / window >= bits)
                return F.struct(
                    now["counts"].alias("counts"),
                    now["sum"].alias("sum"),
                    F.when(s["from"].isNull() & high, i - (window - 1)).otherwise(s["from"]).alias("from"),
                    F.when(high, i + 1).otherwise(s["to"]).alias("to"),
                )

            return let(lowered(up), mark)

        start = F.struct(
            F.array_repeat(F.lit(0), len(alphabet)).alias("counts"),
            F.lit(0.0).alias("sum"),
            F.lit(None).cast("int").alias("from"),
            F.lit(None).cast("int").alias("to"),
        )
        return F.aggregate(
            F.sequence(F.lit(0), F.size(place) - 1), start, step, lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to"))
        )

    return let(F.transform(characters(text), lambda c: F.instr(F.lit(alphabet), c) - 1), scan)


def _beside(candidates: Column, base: Column) -> Column:
    """The candidates, cut where base spans overlap them."""

    def pieces(x: Column) -> Column:
        inside = F.filter(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

        def cut(near: Column) -> Column:
            starts = F.array_distinct(F.concat(F.array(x["start"]), F.transform(near, lambda b: b["end"])))
            free = F.filter(starts, lambda s: (s < x["end"]) & ~F.exists(near, lambda b: (b["start"] <= s) & (s < b["end"])))

            def piece(s: Column) -> Column:
                later = F.filter(F.transform(near, lambda b: b["start"]), lambda e: e >= s)
                end = F.least(F.array_min(later), x["end"])
                return let(end, lambda e: F.struct(s.alias("start"), e.alias("end"), F.substring(x["hit"], s - x["start"] + 1, e - s).alias("hit")))

            return F.filter(F.transform(free, piece), lambda p: p["end"] - p["start"] >= WINDOW)

        return let(inside, cut)

    def overlapped(x: Column) -> Column:
        return F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    whole = F.transform(
        F.filter(candidates, lambda x: ~overlapped(x)),
        lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["hit"].alias("hit")),
    )
    return F.concat(whole, F.flatten(F.transform(F.filter(candidates, overlapped), pieces)))


def _entropy_spans(candidates: Column) -> Column:
    """Candidates of high entropy that nothing explains, as spans."""

    def open_question(x: Column) -> Column:
        harmless = F.lit(False)
        for pattern in ALLOWED:
            harmless = harmless | x["hit"].rlike(pattern)
        return x["hit"].rlike("[0-9]") & x["hit"].rlike("[A-Za-z]") & ~harmless

    def judge(x: Column) -> Column:
        is_hex = x["hit"].rlike("^[0-9a-fA-F]+$")
        hex_class, wide_class = CLASSES["entropy_hex"], CLASSES["entropy_base64"]
        found = F.when(is_hex, window_entropy(F.lower(x["hit"]), *hex_class)).otherwise(window_entropy(x["hit"], *wide_class))
        kind = F.when(is_hex, F.lit("entropy_hex")).otherwise(F.lit("entropy_base64"))
        rank = F.when(is_hex, F.lit(3)).otherwise(F.lit(4))
        return let(
            found,
            lambda w: F.struct(
                rank.alias("rank"),
                kind.alias("kind"),
                (x["start"] + w["from"]).alias("start"),
                (x["start"] + w["to"]).alias("end"),
                F.substring(x["hit"], w["from"] + 1, w["to"] - w["from"]).alias("hit"),
            ),
        )

    return F.filter(F.transform(F.filter(candidates, open_question), judge), lambda x: x["start"].isNotNull())


def secret_spans(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, base and spans: array<struct<rank, kind, start, end, hit>> by start,
    then kind; base holds the three base kinds only. A candidate that overlaps base
    spans is judged by what they leave of it, piece by piece."""
    body = F.col("_body")
    assigned = F.filter(located(body, ASSIGN, 2), lambda x: F.length(x["part"]) >= 6)
    return (
        docs.select(F.col(id), whole_text(text).alias("_body"))
        .withColumn(
            "base",
            in_order(
                F.concat(
                    kind_of(assigned, "assign", 0),
                    kind_of(located(body, ACCESS), "access", 1),
                    kind_of(located(body, HEX), "hex", 2),
                ),
                "start",
                "rank",
            ),
        )
        .withColumn("_candidates", located(body, CANDIDATE))
        .withColumn("_pieces", _beside(F.col("_candidates"), F.col("base")))
        .withColumn("spans", in_order(F.concat("base", _entropy_spans(F.col("_pieces"))), "start", "rank"))
        .select(id, "base", "spans")
    )
