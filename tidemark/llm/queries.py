"""The registered queries of this folder and their SQL twins."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.byte_bpe import token_digests
from tidemark.llm.exact_dedup import duplicate_groups
from tidemark.llm.langid import fit_profiles, held_out, identified
from tidemark.llm.mixing import mixture
from tidemark.llm.near_dedup import near_groups
from tidemark.llm.neighbours import nearest
from tidemark.llm.pii import BASE, personal_spans
from tidemark.llm.resampling import importance_ranks
from tidemark.llm.secret_scan import secret_spans
from tidemark.llm.sharding import row_place, row_size, write_shards
from tidemark.llm.spans import count_of, written
from tidemark.llm.spelling import spelling_forms, word_counts
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.llm.warc import derivatives, responses
from tidemark.session import shared_dir


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    files = write_token_files(_table(spark, sf, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(files)


def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixture(_table(spark, sf, "documents"), entropy=0.95, budget=1.0, carry=["doc_id"])
    return mixed.select("doc.doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "epochs", "block", "copies")


def op3_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_groups(_table(spark, sf, "documents"), keep="largest")


def op4_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    groups = near_groups(_table(spark, sf, "documents"), k=2, percent=80, carry=["doc_id", "text"])
    return groups.select("doc.doc_id", "n_shingles", "component_id", (F.col("doc.doc_id") == F.col("component_id")).alias("kept"))


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return token_digests(_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op6_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    made = derivatives(responses(_table(spark, sf, "pages")))
    return made.withColumns({kind: F.col(kind).cast("string") for kind in ("metadata", "conversion")})


def op7_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_spans(_table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        *(count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = personal_spans(_table(spark, sf, "documents"))
    base = F.filter("spans", lambda x: x["rank"] < BASE)
    scores = F.transform("spans", lambda x: x["score"].cast("string"))
    return found.select(
        "doc_id",
        *(count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.array_join(scores, ",").alias("scores"),
    )


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").withColumn("held_out", held_out())
    profiles = fit_profiles(docs.where("NOT held_out"))
    return identified(docs, profiles, carry=["doc_id", "held_out"]).select("doc.doc_id", "doc.held_out", "lang_pred", "score")


def op10_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(_table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_resampling(spark: SparkSession, sf: str) -> DataFrame:
    docs, target = (_table(spark, sf, t) for t in ("documents", "benchmark"))
    ranked = importance_ranks(docs, target, percent=10, least_words=20, max_n=1, seed=2024, carry=["doc_id"])
    return ranked.select("doc.doc_id", "n_features", "weight", "score", "rank")


def op12_sharding(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    placed = write_shards(_table(spark, sf, "documents"), path, shards=24, seed=2024, place=row_place())
    text = F.col("doc.text")
    return placed.select(
        "doc.doc_id",
        row_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_forms(word_counts(_table(spark, sf, "documents"), shortest=5, least=3, one_in=97), times=2)


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_mixing": op2_mixing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_near_dedup": op4_near_dedup,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_secrets": op7_secrets,
    "op8_pii": op8_pii,
    "op9_language_id": op9_language_id,
    "op10_nearest": op10_nearest,
    "op11_resampling": op11_resampling,
    "op12_sharding": op12_sharding,
    "op13_spelling": op13_spelling,
}

# CRC-32 by a table made from its polynomial; {0} is the column of strings.
_CRC_TABLE = """crc AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
                FROM range(256) r(i)))"""
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex({0}), '..'), lambda h: ('0x' || h)::BIGINT)),
                           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op2_mixing": """
        WITH RECURSIVE rows AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
                   ('0x' || substr(md5('doc42:' || doc_id), 1, 15))::BIGINT AS key
            FROM documents),
        shares AS (
            SELECT source, sum(n_tokens)::DOUBLE AS tokens, count(*) AS n_rows,
                   sum(n_tokens)::DOUBLE / sum(sum(n_tokens)) OVER () AS share
            FROM rows GROUP BY source),
        listed AS (SELECT list(ln(share)) AS l, 0.95::DOUBLE * ln(count(*)) AS target FROM shares WHERE tokens > 0),
        tries AS (
            SELECT 0 AS k, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 1.0::DOUBLE AS a, l, target FROM listed
            UNION ALL
            SELECT k + 1, CASE WHEN good THEN a ELSE low END, CASE WHEN good THEN high ELSE a END,
                   CASE WHEN good THEN a + high ELSE low + a END / 2, l, target
            FROM (
                SELECT *, ln(z) - m / z >= target AS good
                FROM (
                    SELECT *, list_sum(list_transform(l, lambda x: exp(a * x))) AS z,
                           list_sum(list_transform(l, lambda x: exp(a * x) * a * x)) AS m
                    FROM tries))
            WHERE k < 26),
        exponent AS (SELECT CASE WHEN max(low) FILTER (k = 1) = 1 THEN 1.0 ELSE max(low) FILTER (k = 26) END AS a FROM tries),
        weighted AS (
            SELECT *, round(weight / share, 9) AS epochs
            FROM (
                SELECT *, heated / sum(heated) OVER () AS weight
                FROM (SELECT s.*, exp(e.a * ln(share)) AS heated FROM shares s, exponent e))),
        bits AS (SELECT greatest(0, ceil(log2(max(n_rows) / 1024)))::INT AS bits FROM shares),
        keyed AS (SELECT r.*, key >> (60 - bits) AS block FROM rows r, bits),
        cells AS (
            SELECT source, block, sum(n_tokens) AS cell,
                   ('0x' || substr(md5('block42:' || source || ':' || block), 1, 15))::BIGINT AS ord
            FROM keyed GROUP BY source, block),
        placed AS (
            SELECT c.source, c.block, cell, weight, epochs, floor(epochs) AS whole,
                   (epochs - floor(epochs)) * tokens - coalesce(sum(cell) OVER (
                       PARTITION BY c.source ORDER BY ord, c.block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room
            FROM cells c JOIN weighted w USING (source))
        SELECT doc_id, source, n_tokens, round(weight, 9) AS weight, epochs, block,
               (whole + CASE WHEN room >= cell OR filled <= room THEN 1 ELSE 0 END)::BIGINT AS copies
        FROM (
            SELECT k.*, cell, weight, epochs, whole, room,
                   sum(n_tokens) OVER (PARTITION BY source, block ORDER BY key) AS filled
            FROM keyed k JOIN placed USING (source, block))
    """,
    "op3_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
        FROM (
            SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256,
                   max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
            FROM documents
            WINDOW same AS (PARTITION BY coalesce(text, '')))
    """,
    "op11_resampling": f"""
        WITH {_CRC_TABLE},
        words AS (
            SELECT 0 AS side, doc_id, rowid AS row, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
            FROM (SELECT doc_id, text, row_number() OVER () AS rowid FROM documents)
            UNION ALL
            SELECT 1, NULL, NULL, unnest(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark),
        spelled AS (SELECT word, {_CRC.format('word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM words), crc),
        counts AS (
            SELECT bucket, count(*) FILTER (side = 0)::DOUBLE AS s, count(*) FILTER (side = 1)::DOUBLE AS t
            FROM words JOIN spelled USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain
            FROM counts),
        sums AS (
            SELECT row, count(*) AS n_features, sum(gain)::BIGINT AS weight
            FROM words JOIN spelled USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
        scored AS (
            SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
            FROM (SELECT doc_id, row_number() OVER () AS row FROM documents) LEFT JOIN sums USING (row))
        SELECT doc_id, n_features, weight, score,
               CASE WHEN place <= (10 * n) // 100 THEN place END AS rank
        FROM (
            SELECT *, count(*) FILTER (n_features >= 20) OVER () AS n,
                   CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place
            FROM scored)
    """,
    "op13_spelling": f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
        hashed AS (SELECT run, n, {_CRC.format("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM runs, crc),
        results AS (
            SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
            FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cuts AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) u(i)),
        pairs AS (
            SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word != b.word
            UNION
            SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
            UNION
            SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n
            FROM pairs GROUP BY word),
        formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
            FROM words LEFT JOIN best USING (word)),
        chains AS (
            SELECT word, word AS root FROM formed
            UNION ALL
            SELECT c.word, f.form FROM chains c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL),
        roots AS (SELECT c.word, c.root FROM chains c JOIN formed f ON c.root = f.word WHERE f.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
    """,
}
