"""Hyperdimensional language profiles: exact bundles and held-out accuracy."""

import zlib
from collections import Counter

import numpy as np

from tidemark.llm import langid, queries


def by_hand(text):
    folded = "".join(c.lower() if c.isalpha() else " " for c in text)
    padded = " " + " ".join(folded.split()) + " "
    if not padded.strip():
        return np.zeros(langid.DIMENSIONS)
    total = np.zeros(langid.DIMENSIONS)
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        total += np.roll(langid._letter(ord(a)), 2).astype(int) * np.roll(langid._letter(ord(b)), 1) * langid._letter(ord(c))
    return total


def test_bundles_equal_plain_sums():
    texts = ["Avec le chat.", "", "!!", "x", "  Two  words, Été!  ", "漢字かな", "a" * 5000, "Was ist das?", "12 x 3"]
    for text, (keys, counts) in zip(texts, langid.trigrams(texts)):
        assert (langid.bundle(keys, counts) == by_hand(text)).all(), text


def test_a_text_does_not_depend_on_its_group():
    texts = ["Avec le chat.", "漢字 und mehr", "plain words here"]
    together = [dict(zip(k.tolist(), c.tolist())) for k, c in langid.trigrams(texts)]
    alone = [dict(zip(k.tolist(), c.tolist())) for t in texts for k, c in langid.trigrams([t])]
    assert together == alone


def test_held_out_accuracy(spark, sf):
    rows = {r.doc_id: r for r in queries.op9_language_id(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(rows) == len(docs)
    right = Counter()
    for d in docs:
        r = rows[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.held_out and len(d.text) >= 100:
            right[r.lang_pred == d.lang] += 1
    assert right[True] / sum(right.values()) > 0.97


def test_nothing_is_learned_from_the_held_out_third(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    from pyspark.sql import functions as F

    docs.withColumn("lang", F.when(langid.held_out(), "wrong").otherwise(F.col("lang"))).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(queries.op9_language_id(spark, str(tmp_path)).collect()) == sorted(queries.op9_language_id(spark, sf).collect())


def test_awkward_rows(spark, awkward, awkward_rows):
    got = queries.op9_language_id(spark, awkward).collect()
    assert Counter(str(r.doc_id) for r in got) == Counter(str(r[0]) for r in awkward_rows)
    letters = {str(i): bool(t) and any(c.isalpha() for c in t) for i, t, *_ in awkward_rows}
    for r in got:
        assert (r.lang_pred == "und") == (not letters[str(r.doc_id)])
        assert r.lang_pred != "und" or r.score == 0


def test_nothing_to_learn_from(spark, empty):
    assert queries.op9_language_id(spark, empty).collect() == []
    docs = spark.createDataFrame([(1, "words", None), (2, None, "en")], "doc_id long, text string, lang string")
    profiles = langid.fit_profiles(docs)
    assert profiles == {}
    assert {(r.lang_pred, r.score) for r in langid.identified(docs, profiles).collect()} == {("und", 0.0)}


def test_rows_equal_plain_profiles_and_cosines(spark, awkward, awkward_rows, sf, tmp_path):
    """Every row of the query against bundles, profiles and cosines made by hand."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) < 3000")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    rows += [(50_000_000 + i, t, lang) for i, (_, t, lang, *_) in enumerate(awkward_rows) if not t or len(t) < 3000]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    vectors = {i: by_hand(t) if t else np.zeros(langid.DIMENSIONS) for i, t, _ in rows}
    sums = {}
    for i, t, lang in rows:
        if t is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            sums[lang] = sums.get(lang, 0) + vectors[i]
    plain = {lang: v / np.linalg.norm(v) for lang, v in sorted(sums.items()) if np.any(v)}
    got = {r.doc_id: r for r in queries.op9_language_id(spark, str(tmp_path)).collect()}
    assert got.keys() == vectors.keys()
    for i, vector in vectors.items():
        if not np.any(vector):
            continue
        cosines = {lang: float(p @ vector / np.linalg.norm(vector)) for lang, p in plain.items()}
        assert abs(got[i].score - max(0.0, min(1.0, max(cosines.values())))) < 1e-9
        assert cosines[got[i].lang_pred] >= max(cosines.values()) - 1e-12
