import base64
import hashlib
import html
import re

import pytest
from pyspark.sql import functions as F

from lognorm.llm import warc

PAGES = [
    (1, "http://a/", "<html lang='en'><head><title> A &amp; B\n</title></head><body><p>One<b>two</b></p><script>var x='<p>';</script>"
                     "<style>p{}</style><!-- <p>no</p> --><div>3 &lt; 4 &#233;&#x1F600;&eacute;&nosuch; &amp;lt; &</div></body></html>"),
    (2, None, None), (3, "", ""), (4, "u", "no tags, just text  with\t\tspaces\n\n\nand lines"), (5, "u", "<script>never closed"),
    (6, "u", "<p>" + "word " * 50_000), (1, "http://a/", "twice"), (None, "n", "<br>x<br/>y<unknown z='>'>"), (7, "u", "&#0;&#xD800;&#99999999;&#x110000;"),
    (8, "u", "WARC/1.0\r\nWARC-Type: fake\r\n\r\nbody")]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*p, None, None) for p in PAGES], "page_id long, url string, html string, block string, record_id string")


def test_plain_text(spark, pages):
    got = {(r.page_id, r.html): r.t for r in pages.select("page_id", "html", warc.plain_text(F.coalesce("html", F.lit(""))).alias("t")).collect()}
    text = lambda i: next(v for (k, _), v in got.items() if k == i)
    assert got[1, PAGES[0][2]] == "Onetwo\n3 < 4 é😀é&nosuch; &lt; &"
    assert text(2) == text(3) == "" and text(4) == "no tags, just text with spaces\nand lines"
    assert text(6) == ("word " * 50_000).strip() and text(None) == "x\ny'>"
    assert text(7) == "&#0;&#xD800;&#99999999;&#x110000;"


def test_references_decode_as_the_standard_library_does(spark):
    names = [f"&{n};" for n in sorted(html.entities.name2codepoint)] + ["&#65;", "&#x41;", "&#X1f600;", "a&b", "&amp;amp;"]
    rows = spark.createDataFrame([(n,) for n in names], "t string").select("t", warc._entities(F.col("t")).alias("d")).collect()
    assert [r.d for r in rows] == [html.unescape(r.t) for r in rows]


def test_links_headers_and_digests(spark, pages):
    source = warc.responses(pages)
    made = warc.derivatives(source, ["page_id"])
    given = {r.record_id: r for r in source.collect()}
    rows = made.collect()
    assert len(rows) == 2 * len(PAGES) and {r.warc_type for r in rows} == {"metadata", "conversion"}
    import base64
    import hashlib

    sha = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b.encode()).digest()).decode()
    by = {}
    for r in rows:
        assert r.refers_to in given and r.target_uri == given[r.refers_to].target_uri and r.date == given[r.refers_to].date
        assert r.block_digest == sha(r.block) and r.content_length == len(r.block.encode())
        assert re.fullmatch(r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-3[0-9a-f]{3}-a[0-9a-f]{3}-[0-9a-f]{12}>", r.record_id)
        by.setdefault(r.refers_to, {})[r.warc_type] = r
    for refers, pair in by.items():
        fields = dict(x.split(": ", 1) for x in pair["metadata"].block.split("\r\n") if not x.startswith("source-http") and ": " in x)
        src = given[refers]
        assert fields["source-record-id"] == refers and fields["conversion-record-id"] == pair["conversion"].record_id
        assert fields["source-block-digest"] == src.block_digest == sha(src.block)
        assert fields["source-payload-digest"] == src.payload_digest
        assert [x[13:] for x in pair["metadata"].block.split("\r\n") if x.startswith("source-http: ")] == warc.HTTP_HEADERS.split("\r\n")
    again = sorted(r.record_id for r in warc.derivatives(warc.responses(pages)).collect())
    assert again == sorted(r.record_id for r in rows)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_files_read_back(spark, pages, tmp_path, compression):
    source = warc.responses(pages.where("page_id IS NULL OR page_id <> 8")).drop("page_id")
    records = source.unionAll(warc.derivatives(source))
    warc.write_warc(records, f"{tmp_path}/w", compression)
    back = warc.read_warc(spark, f"{tmp_path}/w")
    assert back.where("NOT complete").count() == 0
    assert sorted(map(str, back.drop("complete").collect())) == sorted(map(str, records.collect()))


def test_a_payload_with_the_separator_shows_as_incomplete(spark, pages, tmp_path):
    warc.write_warc(warc.responses(pages.where("page_id = 8")).drop("page_id"), f"{tmp_path}/w")
    assert warc.read_warc(spark, f"{tmp_path}/w").where("NOT complete").count() >= 1


def test_other_records_and_empty_tables(spark, pages):
    source = warc.responses(pages)
    assert warc.derivatives(source.withColumn("warc_type", F.lit("request"))).count() == 0
    assert warc.derivatives(source.limit(0)).count() == 0
    odd = source.limit(1).withColumn("block", F.lit("no head at all"))
    assert warc.derivatives(odd).where("warc_type = 'conversion'").collect()[0].block == "no head at all"


def test_digests_convert_few_pieces_and_hidden_parts_share_one_search(spark):
    texts = ["", "ä", "<!-- a --><p>b<SCRIPT>x</Script ><noscript>n</noscript>c<head>h</head>d<style>", "a<b <!- c -->", "x" * 5_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    digest = warc.sha1_digest(F.col("t"))
    assert str(digest).count("conv(") == 3
    got = df.select("t", digest, F.regexp_replace("t", warc.HIDDEN, " "), F.regexp_replace("t", warc.HIDDEN_AT_ONCE, " ")).collect()
    for t, d, plain, at_once in got:
        assert d == "sha1:" + base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() and plain == at_once
