"""Secrets and personal data against plain regular expressions, code point by code point."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii, queries, secret_scan as secrets
from tidemark.llm.spans import located


def base_secrets(text):
    found = []
    pattern = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for rank, (kind, regex, ok) in enumerate(
        [
            ("assign", pattern, lambda m: len(m[2]) >= 6),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
            ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24),
        ]
    ):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(regex, text, re.A) if ok(m)]
    return [f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found)]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_personal(text):
    def bare(m):
        return re.sub("[^0-9]", "", m[0])

    found = []
    for rank, (kind, regex, ok) in enumerate(
        [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(bare(m)) <= 19 and luhn(bare(m))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(bare(m)) <= 15),
        ]
    ):
        found += [(rank, m.start(), m.end(), kind) for m in re.finditer(regex, text, re.A) if ok(m)]
    return [f"{kind}:{start}:{end}" for _, start, end, kind in sorted(found)]


def entropy(window):
    return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())


def added_secrets(text):
    base = [tuple(map(int, s.split(":")[1:])) for s in base_secrets(text)]
    candidates = []
    for m in re.finditer(r"[A-Za-z0-9+/=_-]{20,}", text, re.A):
        covered = [any(a <= i < b for a, b in base) for i in range(m.start(), m.end())]
        runs = "".join("x" if c else "." for c in covered)
        candidates += [(m.start() + r.start(), m[0][r.start() : r.end()]) for r in re.finditer(r"\.{20,}", runs)]
    out = []
    for start, hit in candidates:
        if any(re.search(p, hit) for p in secrets.ALLOWED):
            continue
        if not (re.search("[0-9]", hit) and re.search("[A-Za-z]", hit)):
            continue
        kind = "entropy_hex" if re.fullmatch("[0-9a-fA-F]+", hit) else "entropy_base64"
        folded = hit.lower() if kind == "entropy_hex" else hit
        bits = secrets.CLASSES[kind][1]
        high = [i for i in range(len(hit) - 19) if entropy(folded[i : i + 20]) >= bits - 1e-9]
        if high:
            out.append(f"{kind}:{start + high[0]}:{start + high[-1] + 20}")
    return out


def pieces(seed, parts, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(n)]


SECRET_PARTS = [
    "password", "Token", "api_key", "APIKEY", "secret", '"', "'", " ", "=", ":", "é", "\U0001f600", "abc", "x", "token=secr",
    "AKIA", "AKIAIOSF", "ODNN7EXAMPLE", "ABCD1234", "deadbeef", "0123456789abcdef", "g", "\n", "aZ3/kQ9+x", "L0pW7uYt", "-", "_", "==",
]
PERSON_PARTS = [
    "joe", "@", ".", "a-b", "mail.com", "_x", "%", "1", "25", "256", "0007", "192.168", "4111111111111111", "4111 1111 1111 1111",
    "-", " ", "+", "+49", "(0)", "é", "\U0001f600", "378282246310005", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000",
    "123-45-6789", "ssn ", "visa ", "\n", "version ",
]


@pytest.fixture(scope="module")
def texts(spark, sf):
    real = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    odd = ["", None, "a" * 40_000, "1" * 30_000, "1 " * 20_000, "a." * 20_000, "x@" + "a." * 20_000 + "b", "+1" + " 2" * 20_000,
           "0f" * 20_000, "token " + " " * 20_000 + "= abcdefgh", "a1B2" * 3_000, "1.2.3.4 " * 1_500, "a@b.cc_x@d.ee",
           "secret=token: abcdefgh", "'password': hunter22"]
    return real + odd + pieces(1, SECRET_PARTS, 1500) + pieces(2, PERSON_PARTS, 1500)


def rows(spark, tmp_path, texts, query):
    """Result by document, from a table with extra and clashing columns."""
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, spans string, base long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return {r.doc_id: r for r in query(spark, str(tmp_path)).collect()}


def sha(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_secrets_equal_brute_force(spark, tmp_path, texts):
    found = rows(spark, tmp_path, texts, queries.op7_secrets)
    assert len(found) == len(texts)
    for i, text in enumerate(t or "" for t in texts):
        base = base_secrets(text)
        assert found[i].base_sha256 == sha(base), text[:200]
        assert (found[i].n_assign, found[i].n_access, found[i].n_hex) == tuple(
            sum(s.startswith(k) for s in base) for k in ("assign", "access", "hex")
        )
        spans = found[i].spans.split(",") if found[i].spans else []
        assert [s for s in spans if not s.startswith("entropy")] == base
        assert [s for s in spans if s.startswith("entropy")] == added_secrets(text), text[:200]


def test_personal_data_equals_brute_force(spark, tmp_path, texts):
    found = rows(spark, tmp_path, texts, queries.op8_pii)
    assert len(found) == len(texts)
    for i, text in enumerate(t or "" for t in texts):
        base = base_personal(text)
        assert found[i].base_sha256 == sha(base), text[:200]
        spans = found[i].spans.split(",") if found[i].spans else []
        assert [s for s in spans if s.split(":")[0] in ("email", "ip", "card", "phone")] == base
        assert (found[i].n_email, found[i].n_ip, found[i].n_card, found[i].n_phone) == tuple(
            sum(s.startswith(k + ":") for s in base) for k in ("email", "ip", "card", "phone")
        )
        assert len(found[i].scores.split(",") if found[i].scores else []) == len(spans)


def spans_of(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return [(x.kind, x.hit, x.score) for x in pii.personal_spans(docs).collect()[0].spans]


def test_checksums_and_context_move_scores(spark):
    assert spans_of(spark, "GB82 WEST 1234 5698 7654 32") == [("iban", "GB82 WEST 1234 5698 7654 32", 0.9)]
    assert spans_of(spark, "GB82 WEST 1234 5698 7654 33") == []
    assert spans_of(spark, "123-45-6789") == []
    assert spans_of(spark, "ssn: 123-45-6789") == [("social", "123-45-6789", 0.6)]
    assert spans_of(spark, "amex 378282246310005") == [("short_card", "378282246310005", 0.6)]
    assert spans_of(spark, "378282246310005") == []
    assert [x[2] for x in spans_of(spark, "server 10.0.0.1")] == [0.9]
    assert [x[2] for x in spans_of(spark, "version 10.0.0.1")] == [0.3]


def test_window_entropy_of_a_class(spark):
    text = "aaaaaaaaaaaaaaaaaaaaQ7x2Lm9Zp4Rt6Vw8Yb3KccccccccccccccccccccccZ1"
    wanted = [i for i in range(len(text) - 19) if entropy(text[i : i + 20]) >= 3.9]
    alphabet, bits = secrets.CLASSES["entropy_base64"]
    got = spark.range(1).select(secrets.window_entropy(F.lit(text), alphabet, bits).alias("w")).collect()[0].w
    assert (got["from"], got["to"]) == (wanted[0], wanted[-1] + 20)


def test_many_matches_keep_their_places(spark):
    text = "é1" * 5_000
    spans = spark.createDataFrame([(text,)], "t string").select(located(F.col("t"), "[0-9]").alias("s")).collect()[0].s
    assert [x.start for x in spans] == list(range(1, 10_000, 2))


def test_empty_table(spark, tmp_path):
    assert rows(spark, tmp_path, [], queries.op7_secrets) == {}
    assert {r.doc_id for r in queries.op8_pii(spark, str(tmp_path)).collect()} == set()


def test_long_random_secrets_are_no_paths(spark):
    rng = random.Random(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = ["".join(rng.choice(letters) for _ in range(n)) for n in (64, 172, 344, 1600) for _ in range(25)]
    keys += [k[:60] + word + k[60:] for k, word in zip(keys[25:], ("sample", "aaaaaaaa", "Dummy", "//"))]
    paths = ["/usr/local/lib/python3/site-packages/foo", "/home/user1/projects/my-repo/src/main", "a/Example1/of/some_words/v2", "sample-9f8e7d6c5b4a3210"]
    docs = spark.createDataFrame(list(enumerate(keys + paths)), "doc_id long, text string")
    found = {r.doc_id: r for r in secrets.secret_spans(docs).collect()}
    assert [i for i in range(len(keys)) if not any(s.kind == "entropy_base64" for s in found[i].spans)] == []
    assert [found[len(keys) + i].spans for i in range(len(paths))] == [[]] * len(paths)


def test_secrets_beside_a_base_span(spark):
    one, two = "Zx9Lm2Qp7Rt4Vw8Yb3Kd6Hf1", "+Gj5Ns0Tc8Ua2Xe7Po4Wi9/k"
    known = "AKIA" + "ABCD" * 5
    text = f"é {one}_{known}{two} end"
    row = secrets.secret_spans(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert [(s.kind, s.hit) for s in row.spans] == [("entropy_base64", one + "_"), ("access", known), ("entropy_base64", two)]
    assert all(text[s.start : s.end] == s.hit for s in row.spans)
    assert [s.kind for s in row.base] == ["access"]


@pytest.mark.parametrize(
    "text, hit",
    [
        ("IBAN ES9121000418450200051332 BIC CAIXESBB", "ES9121000418450200051332"),
        ("ES91 2100 0418 4502 0005 1332 BIC X", "ES91 2100 0418 4502 0005 1332"),
        ("account AT611904300234573201 A", "AT611904300234573201"),
        ("NO9386011117947 AND BE68539007547034 12", "NO9386011117947"),
        ("FR14 2004 1010 0505 0001 3M02 606 77 BIC", "FR14 2004 1010 0505 0001 3M02 606"),
    ],
)
def test_account_numbers_end_where_their_country_says(spark, text, hit):
    assert ("iban", hit) in [x[:2] for x in spans_of(spark, text)]


def test_account_number_behind_another(spark):
    text = "DE89370400440532013000 AT611904300234573201 BIC"
    assert [x[1] for x in spans_of(spark, text) if x[0] == "iban"] == ["DE89370400440532013000", "AT611904300234573201"]
