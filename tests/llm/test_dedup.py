"""Exact and near duplicates against plain Python."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import near_dedup, queries
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import distinct_documents, duplicate_groups
from tidemark.llm.near_dedup import distinct_enough, near_groups
from tidemark.llm.patricia import Patricia


def documents(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


# -- the trie --------------------------------------------------------------------


@pytest.mark.parametrize("budget", [1 << 30, 4_000, 300])
def test_trie_counts_strings_with_and_without_spilling(budget):
    rng = np.random.default_rng(0)
    keys = [bytes(rng.integers(97, 100, rng.integers(0, 12), dtype=np.uint8)) for _ in range(4000)]
    keys += [b"shared prefix " * 50 + k for k in keys[:500]]
    trie = Patricia(lambda a, b: (a[0], a[1] + b[1]), budget)
    for key in keys:
        trie.insert(key, (key, 1))
    assert dict(trie.items()) == Counter(keys)


def test_trie_of_nothing_and_of_the_empty_string():
    trie = Patricia(lambda a, b: a + b)
    assert list(trie.items()) == []
    trie.insert(b"", 1)
    trie.insert(b"", 2)
    assert list(trie.items()) == [3]


# -- exact -----------------------------------------------------------------------


def exact_by_hand(rows, keep):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    best = {t: (max if keep == "largest" else min)((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        (str(i), str(best[t]), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids
    )


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("budget", [1 << 28, 2_000])
def test_exact_groups(spark, awkward, awkward_rows, keep, budget):
    got = duplicate_groups(documents(spark, awkward), keep=keep, budget=budget).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == exact_by_hand(awkward_rows, keep)
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len({t or "" for _, t, *_ in awkward_rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_keeps_all_columns_and_each_text_once(spark, awkward, awkward_rows):
    docs = documents(spark, awkward)
    kept = distinct_documents(docs)
    assert kept.columns == docs.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter({t or "" for _, t, *_ in awkward_rows})


def test_exact_rejects_an_unknown_rule(spark, awkward):
    with pytest.raises(ValueError):
        duplicate_groups(documents(spark, awkward), keep="first")


def test_long_beginnings_in_common_are_sent_on_in_time(spark, monkeypatch):
    """Texts that share 20 kB are held whole; what is held decides when they leave."""
    import pyarrow as pa

    from tidemark.llm import exact_dedup

    class Context:
        partitionId = staticmethod(lambda: 0)
        get = classmethod(lambda cls: cls)

    monkeypatch.setattr(exact_dedup, "TaskContext", Context)
    monkeypatch.setattr(exact_dedup, "LOCAL_BUDGET", 1 << 20)
    texts = ["same beginning " * 1400 + str(i) for i in range(1000)]
    batches = (pa.RecordBatch.from_arrays([pa.array([i]), pa.array([t])], ["id", "body"]) for i, t in enumerate(texts))
    waiting = most = 0
    for out in exact_dedup._local(True)(batches):
        leads = out.column("body").null_count < out.num_rows
        waiting = waiting + 21_000 if not leads else 0
        most = max(most, waiting)
    assert most < 3 << 20


# -- components ------------------------------------------------------------------


def test_components_of_a_chain_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(3, 3), (300, 200), (200, 250), (None, 4)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    expected = {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(8, 60)}, 250: 200, 300: 200}
    assert {r.u: r.root for r in got} == expected


def test_components_of_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# -- near ------------------------------------------------------------------------


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_by_hand(rows, k, percent=80):
    """(id, size, component) of each row, all pairs compared."""
    sets = [shingles(t, k) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and find(i) != find(j):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None and (least[find(i)] is None or doc_id < least[find(i)]):
            least[find(i)] = doc_id
    return sorted((str(r[0]), len(s), str(least[find(i)])) for i, (r, s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize("k", [2, 5])
def test_near_groups(spark, awkward, awkward_rows, k):
    got = near_groups(documents(spark, awkward), k=k).select("doc.doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_by_hand(awkward_rows, k)
    classes = Counter(r.component_id for r in got if r.kept and r.n_shingles)
    assert set(classes.values()) == {1}


def test_near_keeps_all_columns(spark, awkward):
    docs = documents(spark, awkward)
    assert distinct_enough(docs, k=5).columns == docs.columns


def test_near_query_on_real_rows(spark, sf):
    docs = [(r.doc_id, r.text) for r in documents(spark, sf).select("doc_id", "text").collect()]
    got = queries.op4_near_dedup(spark, sf).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_by_hand(docs, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_posterior_rule_never_asks_more_than_a_certain_link_has():
    least = near_dedup.least_matches(80, 1e-9)
    assert list(least) == sorted(least)
    assert all(0 <= m < 0.8 * (i + 1) * near_dedup.BATCH for i, m in enumerate(least))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    b = np.concatenate([a[:600], rng.integers(0, 1 << 63, 300, dtype=np.uint64)])
    share = (near_dedup.signature(np.unique(a)) == near_dedup.signature(np.unique(b))).mean()
    assert abs(share - 0.5) < 0.12


def test_empty_tables(spark, empty):
    assert queries.op3_exact_dedup(spark, empty).collect() == []
    assert queries.op4_near_dedup(spark, empty).collect() == []
    assert distinct_documents(documents(spark, empty)).collect() == []


def test_many_near_copies_cost_few_comparisons(spark, monkeypatch):
    """One large group: pairs stay a small multiple of its members."""
    rng = np.random.default_rng(1)
    words = np.array([f"w{i}" for i in range(5000)])
    base = rng.choice(words, 200)
    rows = []
    for i in range(600):
        own = base.copy()
        own[rng.integers(0, 200, rng.integers(1, 9))] = rng.choice(words)
        rows.append((i, " ".join(own)))
    seen = []
    verify = near_dedup._linked
    monkeypatch.setattr(near_dedup, "_linked", lambda pairs, *a: seen.append(pairs.count()) or verify(pairs, *a))
    got = near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=2).select("component_id").distinct().count()
    assert got == len({c for _, _, c in near_by_hand(rows, 2)})
    assert sum(seen) < 30 * len(rows)


def templates(n, own, seed=5, length=240):
    """Texts with a common frame, of which a share `own` is a text's own words."""
    rng = np.random.default_rng(seed)
    frame = [f"w{i}" for i in rng.integers(0, 5000, length)]
    cut = round(length * own)
    return [(i, " ".join(frame[cut:] + [f"own{i}x{j}" for j in range(cut)])) for i in range(n)]


def scattered(n, seed=6, length=200):
    """Texts about as far from each other as the threshold."""
    rng = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(5000)])
    base, rows = rng.choice(words, length), []
    for i in range(n):
        text = base.copy()
        at = rng.choice(length, rng.integers(4, 16), replace=False)
        text[at] = rng.choice(words, len(at))
        rows.append((i, " ".join(text[: rng.integers(length - 20, length)])))
    return rows


@pytest.mark.parametrize("n", [200, 400])
def test_texts_visit_only_where_a_link_is_possible(spark, monkeypatch, n):
    """Templates just under the threshold meet in every bucket, but no text is sent."""
    rows, sent = templates(n, 0.12), []
    hosted = near_dedup._hosted

    def counted(members, visitors, bodies):
        sent.append((set(bodies.columns), visitors.count()))
        return hosted(members, visitors, bodies)

    monkeypatch.setattr(near_dedup, "_hosted", counted)
    got = near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=2).select("doc.doc_id", "n_shingles", "component_id").collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_by_hand(rows, 2)
    (profiles, visits), (texts, with_text) = sent
    assert "text" not in profiles and "text" in texts
    assert visits <= n * -(-n // 64) and with_text == 0


@pytest.mark.parametrize("limits", [{}, {"PACK": 16, "VISITORS": 8}, {"PACK_SHINGLES": 500}])
def test_groups_around_the_threshold_equal_all_pairs(spark, monkeypatch, limits):
    rows = scattered(300) + [(1000 + i, t) for i, t in templates(40, 0.1)] + [(2000 + i, t) for i, t in templates(40, 0.11, 7)]
    for name, value in limits.items():
        monkeypatch.setattr(near_dedup, name, value)
    monkeypatch.setattr(near_dedup, "PIVOTS", 1)  # leaves more to the packs
    got = near_groups(spark.createDataFrame(rows, "doc_id long, text string"), k=2).select("doc.doc_id", "n_shingles", "component_id").collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == near_by_hand(rows, 2)


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(8)
    counts = rng.integers(0, 3, 1 << near_dedup.CELL_BITS).astype(np.int32)
    for _ in range(300):
        x = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 60), dtype=np.uint64) * np.uint64(2))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.93], rng.integers(0, 1 << 63, rng.integers(0, 5), dtype=np.uint64)]))
        if not len(y):
            continue
        both = len(np.intersect1d(x, y))
        if 100 * both < 80 * (len(x) + len(y) - both):
            continue
        pack = near_dedup._Profiles(80, (0,) * (near_dedup.HASHES // near_dedup.BATCH))
        sig = bytes(2 * near_dedup.HASHES)
        pack.add(1, 1, len(x), sig, near_dedup.prefix(x, counts, 80).tobytes())
        assert pack.asked(2, 2, len(y), sig, near_dedup.prefix(y, counts, 80).tobytes())
        assert not pack.asked(3, 1, len(y), sig, near_dedup.prefix(y, counts, 80).tobytes())
