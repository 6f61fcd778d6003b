import random

import pytest

CLASHING = (
    "id row rep best n sha body length kept keep_id group_size text_sha256 doc node sig fp n_shingles component_id tokens key block copies "
    "weight epochs share ids offsets decoded lang_pred score held_out _body place range at n_words n_features rank bucket slot shard word form root"
).split()


@pytest.fixture(scope="session", autouse=True)
def scratch(spark, tmp_path_factory):
    """A shared folder for staged tables, where the session names none."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


def _words(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


VOCABULARY = [a + b for a in ("ka", "lo", "mi", "tu", "re", "sa", "vi", "no") for b in ("rin", "da", "sol", "pe", "", "tak")]


@pytest.fixture(scope="session")
def awkward_rows():
    """(doc_id, text, lang, source): nulls, copies, near copies, long texts."""
    rng = random.Random(5)
    rows = [(1000, None, "en", "a"), (1001, "", None, None), (None, "no name here at all", "en", "b"), (1002, "  \t\n", "xx", "a"),
            (1003, "solo", None, "a"), (1004, "Solo", "en", None), (1005, "!!! 123 ???", "en", "a"), (1006, "é ö \U0001f600 漢字", None, "c"),
            (1007, _words(rng, 40_000), "en", "a"), (1008, "x" * 120_000, "en", "c"), (1009, None, None, None)]
    rows += [rows[0], rows[4], (1010, "no name here at all", "en", "b")]
    base = _words(rng, 120)
    rows += [(i, base, "en", "hot") for i in range(200)]
    for i in range(200, 330):
        words = base.split()
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(len(words))] = rng.choice(VOCABULARY)
        rows.append((i, " ".join(words), "en", "hot"))
    rows += [(i, _words(rng, rng.randint(1, 60)), rng.choice(["en", "fr", None]), rng.choice("abc")) for i in range(330, 420)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows, tmp_path_factory):
    """The same as a table with further columns whose names the operators use."""
    path = str(tmp_path_factory.mktemp("awkward"))
    extra = ", ".join(f"{c} string" for c in CLASHING)
    data = [(*row, *(f"{c}!" for c in CLASHING)) for row in awkward_rows]
    spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, {extra}").repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


def pytest_collection_modifyitems(items):
    for item in items:
        if "/llm/" in str(item.fspath):
            item.add_marker("llm")


def pytest_configure(config):
    config.addinivalue_line("markers", "llm: operators for training text")
