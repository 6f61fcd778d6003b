"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import queries
from tidemark.llm.acceptor import Acceptor
from tidemark.llm.spelling import joined_crc, near_words, pairs_of, spelling_forms, word_counts


def near(x, y):
    if len(x) < len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(x) == len(y) + 1 and any(x[:i] + x[i + 1 :] == y for i in range(len(x)))


def counted(rows, shortest=5, least=3, one_in=97):
    found = Counter()
    for doc_id, text, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += len(run) >= shortest
    return {w: n for w, n in found.items() if n >= least}


def formed(words):
    """word -> (form, root, n, n_near, form_n)."""
    close = defaultdict(list)
    names = sorted(words)
    for i, x in enumerate(names):
        for y in names[:i]:
            if near(x, y):
                close[x].append(y)
                close[y].append(x)
    form = {}
    for w in names:
        best = min(close[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), words[w], len(close[w]), words.get(form[w])) for w in names}


def result(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("one_in", [97, 2])
def test_words_and_forms_equal_brute_force(spark, awkward, awkward_rows, one_in):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    counts = word_counts(docs, shortest=3, least=2, one_in=one_in)
    words = counted(awkward_rows, 3, 2, one_in)
    assert {r.word: r.n for r in counts.collect()} == words
    assert result(spelling_forms(counts)) == formed(words)


@pytest.mark.parametrize("cells", [1 << 16, 40])
def test_partitions_lose_and_repeat_no_pair(spark, cells):
    """Many words share beginnings and ends, so that partitions are halved again and again."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abàÿ") for _ in range(rng.randint(1, 6))) for _ in range(300)}
    words |= {"inter" + w for w in words} | {w + "ation" for w in words} | {"x" * 400, "x" * 399, "x" * 200 + "y" + "x" * 199}
    table = spark.createDataFrame([(w, i) for i, w in enumerate(sorted(words))], "word string, n long")
    got = [(r.word, r.near) for r in near_words(table, cells).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(x, y) for x in words for y in words if abs(len(x) - len(y)) < 2 and near(x, y)}


def test_composition_of_many_lists_at_once():
    rng = random.Random(1)
    for trial in range(60):
        letters = "abàÿcdefghijklmnopqrstuvw"[: rng.choice([2, 3, 20])]
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(2, 60))})
        rows = [(m, w) for m in range(1, 9) for w in words if len(w) in (m, m - 1)]
        m, zero = np.array([r[0] for r in rows]), np.zeros(len(rows), np.int64)
        one, two = pairs_of([w for _, w in rows], np.unique(m, return_inverse=True)[1], m, zero, zero)
        got = [frozenset((rows[i][1], rows[j][1])) for i, j in zip(one, two)]
        assert len(got) == len(set(got)), trial
        assert set(got) == {frozenset((x, y)) for x in words for y in words if x != y and near(x, y)}, trial


def test_acceptor_is_minimal():
    """tap, taps, top, tops: one state for each distinct set of endings."""
    words = np.array([[4, 1, 2, 0], [4, 1, 2, 3], [4, 5, 2, 0], [4, 5, 2, 3]])
    acceptor = Acceptor(words, np.zeros(4, np.int64))
    assert len(acceptor.final) == 5 and len(acceptor.key) == 5
    assert acceptor.count[acceptor.initial].tolist() == [4]


def test_crcs_of_joined_strings():
    rng = random.Random(2)
    one, two = ([bytes(rng.randrange(256) for _ in range(rng.randint(0, 40))) for _ in range(300)] for _ in range(2))
    made = joined_crc(*(np.array([zlib.crc32(x) for x in side], np.uint32) for side in (one, two)), np.array([len(x) for x in two]))
    assert made.tolist() == [zlib.crc32(x + y) for x, y in zip(one, two)]


def test_chains_lead_to_the_last_form(spark):
    words = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "abbbb": 16, "bbbbb": 32, "bbbbc": 31, "zzzzz": 3}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = result(spelling_forms(table))
    assert got == formed(words)
    assert got["aaaaa"][1] == "bbbbb" and got["bbbbc"][0] is None and got["zzzzz"][:2] == (None, "zzzzz")


def test_query_on_real_rows_and_on_none(spark, sf, empty):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    words = counted(rows)
    got = result(queries.op13_spelling(spark, sf))
    assert {w: v[2] for w, v in got.items()} == words
    for w in random.Random(0).sample(sorted(words), 150):
        close = [x for x in words if x != w and abs(len(x) - len(w)) < 2 and near(x, w)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        assert got[w][3] == len(close) and got[w][0] == (best if best and words[best] >= 2 * words[w] else None)
    assert result(queries.op13_spelling(spark, empty)) == {}
