"""WARC derivatives: metadata and plain-text conversion records of responses.

A response record is read back from its bytes. Its derivatives name it in
WARC-Refers-To, keep its target, date and payload digest, and have digests of
their own blocks. Identifiers follow from content, so a task that runs again
writes the same records.

Defined results: a null page is an empty one; a null address leaves the target
out; header lines keep their order and repeats; payloads are read as UTF-8.
Repeated pages give equal records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.html_text import plain_text

VERSION = "WARC/1.1"
END = "\r\n"
DATE = "2024-01-01T00:00:00Z"
HTTP = ("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8")


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def record_id(*parts: Column) -> Column:
    """A URN from a hash of the parts."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", *(F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))),
        F.lit(">"),
    )


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws(END, F.lit(VERSION), *(F.concat(F.lit(f"{name}: "), value) for name, value in fields))


def record(block: Column, block_digest: Column, *fields: tuple[str, Column]) -> Column:
    """Bytes of one record."""
    length = F.octet_length(block).cast("string")
    head = _lines(*fields, ("WARC-Block-Digest", block_digest), ("Content-Length", length))
    return F.concat(head, F.lit(END + END), block, F.lit(END + END)).cast("binary")


def responses(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """`id` and record: a response record for each page."""
    body = F.coalesce(F.col(html), F.lit(""))
    given = pages.select(F.col(id).alias("_id"), F.col(url).alias("_url"), body.alias("_body"))
    http = F.concat(F.lit(END.join(HTTP) + END), F.lit("Content-Length: "), F.octet_length("_body").cast("string"))
    # Digests are columns of their own, so that each is worked out once.
    blocks = given.withColumns({"_payload": digest(F.col("_body")), "_block": F.concat(http, F.lit(END + END), "_body")})
    blocks = blocks.withColumn("_digest", digest(F.col("_block")))
    own = record_id(F.lit("response"), F.coalesce("_url", F.lit("")), F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_payload"))
    return blocks.select(
        F.col("_id").alias(id),
        record(
            F.col("_block"),
            F.col("_digest"),
            ("WARC-Type", F.lit("response")),
            ("WARC-Record-ID", own),
            ("WARC-Date", F.lit(date)),
            ("WARC-Target-URI", F.col("_url")),
            ("Content-Type", F.lit("application/http;msgtype=response")),
            ("WARC-Payload-Digest", F.col("_payload")),
        ).alias("record"),
    )


def _field(name: str) -> Column:
    """Value of the first header line of that name; null if there is none."""
    value = F.regexp_extract("_head", rf"(?im)^{name}:[\x20\x09]*+([^\r\n]*+)", 1)
    return F.when(F.col("_head").rlike(rf"(?im)^{name}:"), value)


def derivatives(records: DataFrame, id: str = "page_id", column: str = "record") -> DataFrame:
    """`id`, response_id, target_uri, payload_digest, metadata_id, metadata,
    conversion_id, conversion and text, one row per response record. The records
    are bytes; those of another type give no row."""
    whole = F.col(column).cast("string")
    parted = records.select(F.col(id), F.split(whole, END + END, 3).alias("_parts")).select(
        id,
        F.col("_parts")[0].alias("_head"),
        F.coalesce(F.get("_parts", F.lit(1)), F.lit("")).alias("_http"),
        # The record ends with two line ends of its own.
        F.regexp_replace(F.coalesce(F.get("_parts", F.lit(2)), F.lit("")), r"\r\n\r\n\z", "").alias("_body"),
    )
    read = parted.where(F.lower(_field("WARC-Type")) == "response").select(
        id,
        _field("WARC-Record-ID").alias("response_id"),
        _field("WARC-Target-URI").alias("target_uri"),
        _field("WARC-Date").alias("date"),
        F.coalesce(_field("WARC-Payload-Digest"), digest(F.col("_body"))).alias("payload_digest"),
        "_http",
        plain_text(F.col("_body")).alias("text"),
        F.regexp_extract("_body", r"(?is)<title\b[^<>]*+>([^<]*+)", 1).alias("_title"),
        F.regexp_extract("_body", r"(?is)<html\b[^<>]*?\blang=[\"']?([A-Za-z-]+)", 1).alias("_lang"),
        F.regexp_count("_body", F.lit(r"(?i)<a\b[^<>]*?\bhref\b")).alias("_links"),
    )
    lines = F.filter(F.split("_http", END), lambda x: x != "")
    fields = F.concat_ws(
        END,
        F.transform(F.slice(lines, 1, 1), lambda x: F.concat(F.lit("source-status: "), x)),
        F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: F.concat(F.lit("source-header: "), x)),
        F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")),
        F.concat(F.lit("title: "), F.trim(F.regexp_replace("_title", r"\s++", " "))),
        F.concat(F.lit("language: "), F.when(F.col("_lang") != "", F.col("_lang"))),
        F.concat(F.lit("links: "), F.col("_links").cast("string")),
        F.concat(F.lit("text-length: "), F.length("text").cast("string")),
    )
    made = read.withColumn("_fields", F.concat(fields, F.lit(END)))
    made = made.withColumns({"_metadata_digest": digest(F.col("_fields")), "_conversion_digest": digest(F.col("text"))})
    for kind in ("metadata", "conversion"):
        made = made.withColumn(f"{kind}_id", record_id(F.lit(kind), F.col("response_id"), F.col(f"_{kind}_digest")))
    return made.select(
        id, "response_id", "target_uri", "payload_digest",
        "metadata_id", _derived("metadata", F.col("_fields"), "application/warc-fields"),
        "conversion_id", _derived("conversion", F.col("text"), "text/plain;charset=utf-8"),
        "text",
    )


def _derived(kind: str, block: Column, content_type: str) -> Column:
    return record(
        block,
        F.col(f"_{kind}_digest"),
        ("WARC-Type", F.lit(kind)),
        ("WARC-Record-ID", F.col(f"{kind}_id")),
        ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To", F.col("response_id")),
        ("WARC-Refers-To-Payload-Digest", F.col("payload_digest")),
        ("Content-Type", F.lit(content_type)),
    ).alias(kind)
