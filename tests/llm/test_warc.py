"""WARC derivatives read back by hand, and text against a plain parser."""

import hashlib
import html
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.llm.html_text import plain_text
from tidemark.llm.warc import derivatives, responses


def parsed(record):
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    assert lines[0] == "WARC/1.1" and rest[n:] == b"\r\n\r\n"
    return fields, rest[:n]


def sha(data):
    return "sha256:" + hashlib.sha256(data).hexdigest()


class Words(HTMLParser):
    def __init__(self):
        super().__init__()
        self.hidden, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")

    def handle_data(self, data):
        if not self.hidden:
            self.words += data.split()


def check(row, url, page):
    response, block = parsed(bytes(row.record))
    body = block.partition(b"\r\n\r\n")[2]
    assert body.decode() == (page or "") and response["WARC-Payload-Digest"] == sha(body)
    for kind in ("metadata", "conversion"):
        fields, own = parsed(bytes(row[kind]))
        assert fields["WARC-Type"] == kind and fields["WARC-Record-ID"] == row[f"{kind}_id"]
        assert fields["WARC-Refers-To"] == response["WARC-Record-ID"] == row.response_id
        assert fields["WARC-Refers-To-Payload-Digest"] == sha(body) == row.payload_digest
        assert fields["WARC-Block-Digest"] == sha(own)
        assert fields.get("WARC-Target-URI") == url
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", row[f"{kind}_id"])
        if kind == "conversion":
            assert own.decode() == row.text
        else:
            assert b"source-header: Content-Type: text/html" in own and sha(body).encode() in own


def test_records_of_real_and_awkward_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()
    odd = [(-1, None, "<p>a"), (-2, "http://x/", None), (None, "http://y/", ""), (-3, "http://z/", "<b>" + "long " * 50_000), (-4, "u", "<!-- open"), (-4, "u", "<!-- open")]
    rows = [tuple(p) for p in pages] + odd
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, record string, text string")
    made = responses(table)
    joined = made.join(derivatives(made).withColumnRenamed("page_id", "p"), F.col("page_id").eqNullSafe(F.col("p"))).dropDuplicates(["page_id"])
    by_id = {r[0]: r for r in rows}
    found = joined.collect()
    assert len(found) == len(by_id)
    for row in found:
        check(row, *by_id[row.page_id][1:])
    assert derivatives(made).count() == len(rows)


def test_text_has_the_words_a_parser_finds(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    for row in pages.select("html", plain_text(F.col("html")).alias("text")).collect():
        reader = Words()
        reader.feed(row.html)
        reader.close()
        assert "".join(row.text.split()) == "".join("".join(reader.words).split())


def text_of(spark, page):
    return spark.createDataFrame([(page,)], "h string").select(plain_text(F.col("h")).alias("t")).collect()[0].t


def test_markup_rules(spark):
    assert text_of(spark, "a<br>b<script>x<y</script>c") == "a\nb c"
    assert text_of(spark, '<p title="1>2">x</p>&lt;b&gt; &amp;lt;') == "x\n<b> &lt;"
    assert text_of(spark, "&#65;&#x1F600;&#0;&#xD800;&#233;") == "A\U0001f600��é"
    assert text_of(spark, "1 < 2 and 3 > 2") == html.unescape("1 &lt; 2 and 3 &gt; 2")
    assert text_of(spark, "") == "" and text_of(spark, None) is None
    assert text_of(spark, "<p " + "a='b' " * 20_000 + ">x") == "x"


def test_other_records_give_no_row(spark):
    rows = spark.createDataFrame([(1, bytearray(b"WARC/1.1\r\nWARC-Type: request\r\n\r\nGET /\r\n\r\n")), (2, None)], "page_id long, record binary")
    assert derivatives(rows).collect() == []


def test_empty_table(spark, empty):
    assert queries.op6_warc_derivatives(spark, empty).collect() == []


@pytest.mark.parametrize("piece", ['<p "', "<p '", "<html ", "<script ", "<a x", "<title ", "<!x", "</p ", "< <", "<p>x "])
def test_markup_that_never_closes_costs_one_pass(spark, piece):
    """A page of 1 MB in seconds; searched again from every tag it would take hours."""
    start = time.time()
    row = derivatives(responses(spark.createDataFrame([(1, "http://a.b/c", piece * (1_000_000 // len(piece)))], "page_id long, url string, html string"))).collect()[0]
    assert row.response_id and time.time() - start < 30


def test_repeated_pages_and_clashing_columns(spark):
    rows = [(1, "http://a.b/c", "<p>x</p>", "t", 5)] * 3 + [(2, None, None, "t", 5)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, record int")
    got = derivatives(responses(table)).collect()
    assert [r.page_id for r in got].count(1) == 3 and len({r.conversion_id for r in got if r.page_id == 1}) == 1
