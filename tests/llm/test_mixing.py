"""Temperature mixing against plain arithmetic."""

import hashlib
import math
from collections import defaultdict

import pytest

from tidemark.llm import queries
from tidemark.llm.mixing import BLOCK_ROWS, bisected_exponent, mixed_documents, mixture


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def shares(spark, tokens):
    every = sum(tokens)
    return spark.createDataFrame([(f"s{i}", float(t), t / every) for i, t in enumerate(tokens)], "source string, tokens double, share double")


def entropy(tokens, a):
    w = [t**a for t in tokens if t]
    return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)


@pytest.mark.parametrize("target", [0.9, 0.99])
def test_exponent_meets_the_entropy(spark, target):
    tokens = [5000, 900, 700, 30, 0]
    a = bisected_exponent(shares(spark, tokens), entropy=target)
    assert entropy(tokens, a) >= target * math.log(4) > entropy(tokens, a + 1e-5)


def test_exponent_meets_the_repetition_limit(spark):
    tokens = [5000, 900, 700, 30]
    a = bisected_exponent(shares(spark, tokens), max_epochs=4.0)
    most = (30 / 5000) ** (a - 1)
    assert most <= 4.0 < (30 / 5000) ** (a - 1e-5 - 1)


def test_exponent_at_the_ends(spark):
    assert bisected_exponent(shares(spark, [10, 10, 10]), entropy=0.9) == 1.0
    assert bisected_exponent(shares(spark, [10, 20]), entropy=1.1) == 0.0
    assert bisected_exponent(shares(spark, [10, 20]), max_epochs=100.0) == 0.0
    with pytest.raises(ValueError):
        bisected_exponent(shares(spark, [1]), entropy=0.5, max_epochs=2.0)


def key(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def by_hand(rows, max_epochs):
    """Copies of each (doc_id, source) for one block a source."""
    docs = [(i, s, len((t or "").split())) for i, t, s in rows]
    tokens = defaultdict(int)
    for _, s, n in docs:
        tokens[s] += n
    live = {s: t for s, t in tokens.items() if t}
    low, high = 0.0, 1.0
    ratio = max(live.values()) / min(live.values())
    for _ in range(25):
        mid = (low + high) / 2
        low, high = (low, mid) if (1 - mid) * math.log(ratio) <= math.log(max_epochs) else (mid, high)
    a = high if ratio**1.0 > max_epochs else 0.0
    per = {s: t ** (a - 1) for s, t in live.items()}
    epochs = {s: round(p / min(per.values()), 9) for s, p in per.items()}
    out = {}
    for s in tokens:
        e = epochs.get(s, 1.0)
        room, filled = (e - math.floor(e)) * tokens[s], 0
        for i, _, n in sorted((d for d in docs if d[1] == s), key=lambda d: key(f"doc42:{d[0]}")):
            filled += n
            more = filled <= room and (room > 0 or tokens[s] > 0)
            out[i, s] = math.floor(e) + (1 if more and n + filled > 0 else 0)
    return out


def test_copies_follow_the_budget(spark):
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(700)] + [(1000 + i, "w " * 3, "small") for i in range(40)]
    got = {(r.doc.doc_id, r.source): r.copies for r in mixture(frame(spark, rows), max_epochs=2.5).collect()}
    assert got == by_hand(rows, 2.5)
    assert min(got.values()) == 1 and max(got.values()) == 3


def test_blocks_are_cut_within_the_budget(spark):
    rows = [(i, "w " * (1 + i % 5), "hot") for i in range(3 * BLOCK_ROWS)] + [(10_000 + i, "w w", "cold") for i in range(50)]
    got = mixture(frame(spark, rows), entropy=0.9, budget=0.5).collect()
    used, epochs = defaultdict(int), {}
    every = sum(r.n_tokens for r in got)
    for r in got:
        used[r.source] += r.copies * r.n_tokens
        epochs[r.source] = r.weight * 0.5 * every
    assert len({r.block for r in got if r.source == "hot"}) > 1
    for s, wanted in epochs.items():
        assert wanted - 6 <= used[s] <= wanted


def test_awkward_rows(spark, awkward, awkward_rows):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    mixed = mixed_documents(docs, max_epochs=2.0)
    assert mixed.columns == docs.columns
    got = [(str(r.doc_id), r.text, r.source) for r in mixed.collect()]
    assert set(got) == {(str(i), t, s) for i, t, _, s in awkward_rows}
    assert len(got) >= len(awkward_rows)


def test_empty_table(spark, empty):
    assert queries.op2_mixing(spark, empty).collect() == []
