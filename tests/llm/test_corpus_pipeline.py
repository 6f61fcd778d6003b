"""The whole pipeline against a plain version of every stage."""

import hashlib
import random
from collections import Counter

from test_dedup import near_by_hand
from test_mixing import by_hand as copies_by_hand

import corpus_pipeline
from tidemark.llm import langid
from tidemark.llm.byte_bpe import _vocabulary, encode_texts


def test_stages_and_rows(spark, awkward, awkward_rows):
    rows = [r for r in awkward_rows if r[1] and any(c.isalpha() for c in r[1])]
    best = {}
    for r in rows:
        if r[1] not in best or (r[0] is not None and (best[r[1]][0] is None or r[0] > best[r[1]][0])):
            best[r[1]] = r
    rows = list(best.values())
    component = {i: c for i, _, c in near_by_hand(rows, 5)}
    rows = [r for r in rows if component[str(r[0])] == str(r[0])]
    copies = copies_by_hand([(i, t, s) for i, t, _, s in rows], 2.0)
    data = open(corpus_pipeline.RANKS, "rb").read()
    expected = Counter()
    for i, t, _, s in rows:
        ids = next(encode_texts([t], data)).tolist()
        expected[i, len(ids), hashlib.sha256(t.encode()).hexdigest()] += copies[i, s]

    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, awkward)
        assert docs.columns == columns, name
    got = corpus_pipeline.run(spark, awkward).collect()
    assert Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in got) == expected
    tokens = _vocabulary(data)[1]
    assert all(hashlib.sha256(b"".join(tokens[i] for i in r.ids)).hexdigest() == r.decoded_sha256 for r in got)


def test_clean_documents_of_the_tables_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.known_language(spark, docs, sf)
    gone = docs.select("text").exceptAll(kept.select("text")).collect()
    assert all(len(r.text.split()) < 3 for r in gone)


def test_empty_table(spark, empty):
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_stage_names_follow_the_order():
    assert [n.split()[0] for n, _ in corpus_pipeline.STAGES] == ["language", "exact", "MinHash", "mixing", "byte-level"]


FOREIGN = [
    "Быстрая коричневая лиса прыгает через ленивую собаку и бежит дальше по широкому полю",
    "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και φεύγει μακριά",
    "빠른 갈색 여우가 게으른 개를 뛰어넘어 넓은 들판으로 멀리 달려간다 그리고 다시 돌아오지 않는다",
    "الثعلب البني السريع يقفز فوق الكلب الكسول ثم يركض بعيدا في الحقل الواسع",
    "Быстрая коричневая лиса прыгает",
    "Η γρήγορη καφέ αλεπού πηδάει",
]


def test_unlearned_languages_and_junk_go_short_clean_texts_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(4)
    junk = ["".join(rng.choice("qwxzjkvbpyfghmc ") for _ in range(200)) for _ in range(5)]
    words = docs.where("length(text) > 2000").orderBy("doc_id").first().text.split()
    short = [" ".join(words[i : i + n]) for i, n in ((0, 1), (1, 2), (3, 4), (7, 12))]
    short = [t for t in short if any(c.isalpha() for c in t)]
    assert len(short) == 4
    added = spark.createDataFrame([(10_000_000 + i, t, None) for i, t in enumerate(FOREIGN + junk + short)], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(added), sf).where("doc_id >= 10000000").collect()
    assert {r.text for r in kept} == set(short)


def test_the_bound_grows_steadily_and_spares_clean_pieces(spark, sf):
    """Pieces of clean texts of any length stay, but for a thousandth or so."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang IS NOT NULL").select("doc_id", "text", "lang")
    profiles = langid.fit_profiles(docs)
    bounds = spark.range(1, 200).select(langid.least_score(profiles, "id").alias("b")).collect()
    steps = [b.b - a.b for a, b in zip(bounds, bounds[1:])]
    assert min(steps) >= 0 and max(steps) < 0.05 and bounds[0].b < 0 and bounds[-1].b == langid.NOISE
    rng, pieces = random.Random(5), []
    for i, r in enumerate(docs.collect()):
        words = r.text.split()
        for n in (1, 2, 4, 6, 8, 12):
            at = rng.randrange(max(1, len(words) - n + 1))
            pieces.append((i, " ".join(words[at : at + n]), r.lang))
    pieces = spark.createDataFrame([p for p in pieces if any(c.isalpha() for c in p[1])], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(pieces), sf).count() - docs.count()
    assert kept >= 0.99 * pieces.count()
