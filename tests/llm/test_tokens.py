"""Byte-level BPE and token files against the libraries they stand for."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidemark.llm import byte_bpe, queries, range_coder, token_files
from tidemark.llm.pretokens import SEPARATOR, piece_starts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def words_library():
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    return t


def odd_texts():
    rng = random.Random(1)
    letters = "ab'stmdrevl l  \n\t　\xa0\x1c\x00019²½éÉ漢\U0001f600!?.-_"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [
        "", "'s's'll've", "a" * 5000, " " * 1000 + "x", "x" + " " * 300, "aé" * 3000 + "'s", "<|endoftext|>", "ab" * 70, "'", " '", "\n's",
    ]


# -- byte-level BPE --------------------------------------------------------------


def test_ids_equal_the_library(library):
    data, texts = open(RANKS, "rb").read(), odd_texts()
    for i in range(0, len(texts), 700):
        part = texts[i : i + 700]
        for text, ids in zip(part, byte_bpe.encode_texts(part, data)):
            assert ids.tolist() == library.encode_ordinary(text), text


def test_scan_does_not_depend_on_its_width():
    text = "".join(odd_texts()[:200])
    points = np.append(np.frombuffer(text.encode("utf-32-le"), "<u4"), SEPARATOR).astype(np.uint32)
    starts = [piece_starts(points, width).tolist() for width in (3, 64, 256, 1 << 16)]
    assert all(s == starts[0] for s in starts)


def test_long_pieces_merge_like_short_ones():
    ranks, _ = byte_bpe._vocabulary(open(RANKS, "rb").read())
    rng = random.Random(2)
    for _ in range(200):
        piece = "".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 90))).encode()
        if piece not in ranks:
            assert byte_bpe.merged(piece, ranks) == byte_bpe._merged_long(piece, ranks)


def test_bpe_query(spark, awkward, awkward_rows, library):
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op5_byte_bpe(spark, awkward).collect())
    expected = []
    for doc_id, text, *_ in awkward_rows:
        ids = library.encode_ordinary(text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (text or "").encode())]
        expected.append((str(doc_id), len(ids), *digests))
    assert got == sorted(expected)


def test_offsets_find_every_token_in_the_text(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet").where("length(text) < 1000")
    tokens = byte_bpe._vocabulary(open(RANKS, "rb").read())[1]
    texts = {r.doc_id: (r.text or "").encode() for r in docs.select("doc_id", "text").collect()}
    for r in byte_bpe.encode(docs, RANKS).collect():
        assert all(texts[r.doc_id][o : o + len(tokens[i])] == tokens[i] for i, o in zip(r.ids, r.offsets))


def test_decoding_refuses_unknown_ids(spark):
    bad = spark.createDataFrame([(1, [10**6], [0])], "doc_id long, ids array<int>, offsets array<int>")
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(bad, RANKS).collect()


def test_decoding_null_ids_gives_null(spark):
    rows = spark.createDataFrame([(1, None, None), (2, [], [])], "doc_id long, ids array<int>, offsets array<int>")
    assert {r.doc_id: r.decoded for r in byte_bpe.decode(rows, RANKS).collect()} == {1: None, 2: b""}


# -- the range coder -------------------------------------------------------------


@pytest.mark.parametrize("symbols", [1, 2, 16, 17, 300, 4097, 49_408])
@pytest.mark.parametrize("kind", ["even", "skewed", "one", "repeating"])
def test_blocks_round_trip(symbols, kind):
    rng = np.random.default_rng(symbols)
    for n, block in ((1, 4), (9, 4), (5000, 64), (4000, 4000)):
        ids = {
            "even": rng.integers(0, symbols, n),
            "skewed": np.minimum(rng.geometric(0.1, n), symbols - 1),
            "one": np.full(n, symbols - 1),
            "repeating": np.arange(n) % min(symbols, 7),
        }[kind]
        codes = range_coder.encode(ids, block, symbols)
        assert len(codes) == -(-n // block)
        assert (range_coder.decode(codes, n, block, symbols) == ids).all()


def test_blocks_are_independent():
    ids = np.random.default_rng(0).integers(0, 900, 4096)
    codes = range_coder.encode(ids, 512, 900)
    assert codes[3] == range_coder.encode(ids[3 * 512 : 4 * 512], 512, 900)[0]
    assert (range_coder.decode(codes[3:4], 512, 512, 900) == ids[3 * 512 : 4 * 512]).all()


def test_predictions_pay():
    ids = np.tile(np.random.default_rng(0).integers(0, 3000, 50), 80)
    assert len(range_coder.encode(ids, 4000, 3000)[0]) < 0.25 * 2 * len(ids)


def test_segments_round_trip_and_notice_damage():
    rng = np.random.default_rng(4)
    ids, counts = rng.integers(0, 49_408, 3000), np.array([1000, 1, 1999])
    packed = token_files.pack([7, None, -3], counts, ids)
    back = token_files.unpack(packed)
    assert back[0] == [7, None, -3] and (back[1] == counts).all() and (back[2] == ids).all()
    for at in (30, len(packed) - 5):
        hurt = bytearray(packed)
        hurt[at] ^= 1
        with pytest.raises(ValueError, match="damaged"):
            token_files.unpack(bytes(hurt))


@pytest.mark.parametrize("symbols", [1, 700, 49_408])
def test_counts_shape_the_code_and_round_trip(symbols):
    rng = np.random.default_rng(symbols)
    ids = np.minimum(rng.geometric(0.02, 20_000) - 1, symbols - 1)
    counts = np.bincount(ids, minlength=symbols)
    codes = range_coder.encode(ids, 512, symbols, counts)
    assert (range_coder.decode(codes, len(ids), 512, symbols, counts) == ids).all()
    share = counts[counts > 0] / len(ids)
    bits = -(share * np.log2(share)).sum()
    # Close to the entropy of ids that no context foretells; far from it without counts.
    assert sum(map(len, codes)) * 8 < len(ids) * (bits * 1.05 + 0.3)
    whole = range_coder.starts(symbols, counts)
    assert (np.diff(whole) > 0).all() and whole[-1] == 1 << 20


def test_starts_hold_very_large_counts():
    for counts in ([1 << 62, 1, 0], [0, 0, 0], [3, (1 << 40) + 1, 1 << 40]):
        whole = range_coder.starts(3, np.array(counts))
        assert (np.diff(whole) > 0).all() and whole[-1] == 1 << 20


def test_an_id_is_coded_in_one_step(monkeypatch):
    """One look at the predictions for each id of a lane, whatever the vocabulary."""
    looks, look = [], range_coder._Model.look
    monkeypatch.setattr(range_coder._Model, "look", lambda self, active: looks.append(active) or look(self, active))
    ids = np.random.default_rng(3).integers(0, 49_408, 4 * 256)
    codes = range_coder.encode(ids, 256, 49_408)
    assert looks == [4] * 256
    assert (range_coder.decode(codes, len(ids), 256, 49_408) == ids).all() and len(looks) == 512


# -- token files -----------------------------------------------------------------


def by_library(rows, library):
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_file_query_on_real_rows(spark, sf, words_library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op1_token_files(spark, sf).collect())
    assert got == by_library(rows, words_library)


def test_awkward_files_and_small_segments(spark, awkward, awkward_rows, words_library, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    files = token_files.write_token_files(docs, f"{tmp_path}/files", WORDS)
    got = token_files.read_token_files(files, with_ids=True).collect()
    expected = by_library([r[:2] for r in awkward_rows], words_library)
    # Rows of one identifier may stand in either order; their starts then differ.
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(a), c, d) for a, _, c, d in expected)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == r.n_tokens and r.ids[-1] == 2
        at += r.n_tokens


def test_words_of_a_small_cache_are_learned_again(words_library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 5)
    encoder = token_files._Encoder(open(WORDS, "rb").read())
    texts = [t for t in odd_texts()[:300]]
    for i in range(0, 300, 7):
        ids, lengths = encoder.encode(texts[i : i + 7])
        expected = [words_library.encode(t, add_special_tokens=False).ids for t in texts[i : i + 7]]
        assert ids.tolist() == [x for e in expected for x in e] and lengths.tolist() == [len(e) for e in expected]


def test_plain_words_are_cut_like_the_library_cuts_them(words_library):
    rng = random.Random(5)
    letters = "abzAZéÉßØøÿ×÷ªµ0479!~'`^{-<|>=\u0301\u0338\u0130\u03a3漢"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    texts += ["Don't", "'s", "a's", "A=\u0338b", "E\u0301a", "H\u0331", "<|endoftext|>", "x" * 3000, "9" * 50, "ÀÉ'll,", "Straße!!!1"]
    encoder = token_files._Encoder(open(WORDS, "rb").read())
    assert encoder.plain
    ids, lengths = encoder.encode(texts)
    expected = [words_library.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(e) for e in expected] and ids.tolist() == [x for e in expected for x in e]


def test_pieces_of_a_small_cache_are_learned_again(words_library, monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 3)
    monkeypatch.setattr(token_files, "CACHED_PIECES", 5)
    encoder = token_files._Encoder(open(WORDS, "rb").read())
    texts = [f"{a}{i % 13}{b} stone{i % 7}" for i, (a, b) in enumerate(zip("riverstonebridge" * 9, ".,!?ZÉ" * 24))]
    for i in range(0, len(texts), 5):
        ids, _ = encoder.encode(texts[i : i + 5])
        assert ids.tolist() == [x for t in texts[i : i + 5] for x in words_library.encode(t, add_special_tokens=False).ids]


def test_pieces_are_merged_once():
    """Words that differ in case and marks alone cost the library nothing anew."""
    encoder = token_files._Encoder(open(WORDS, "rb").read())
    encoder.encode(["river stone . , ! 1 2"])
    known = len(encoder.pieces.place)
    encoder.encode(["River, STONE! river. Stone12!"])
    assert len(encoder.pieces.place) == known and len(encoder.words.place) > known


def test_empty_tables(spark, empty):
    assert queries.op1_token_files(spark, empty).collect() == []
    assert queries.op5_byte_bpe(spark, empty).collect() == []
