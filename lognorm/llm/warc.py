"""WARC derivatives: each response gives a linked metadata record and a plain-text conversion record.

Both derived records carry ``WARC-Refers-To`` with the response's identifier, its target and
date, and block digests of their own; the metadata block keeps the source's status line, HTTP
headers and digests word for word, and names the conversion made beside it. Identifiers are
name-based, so a repeated run, or a task run twice, gives the same records.

All steps are column expressions: no Python, no shuffle. Files are plain WARC text, written and
read by Spark's text source with the record's first line as separator, so a file is read in
splits and a record is one row.

A null page gives a response with an empty payload; a null url an empty target. Equal rows give
equal records. Texts are UTF-8; a payload that itself holds the separator line breaks when a
file is read back, which its ``complete`` flag then shows (length against Content-Length).
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.0"
DATE = "1970-01-01T00:00:00Z"
HTTP_HEADERS = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
COLUMNS = ["record_id", "warc_type", "refers_to", "target_uri", "date", "content_type", "content_length",
           "block_digest", "payload_digest", "block"]

#: Removed with their content, then tags that end a line, then all other tags.
HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>|<noscript\b.*?</noscript\s*>"
BREAKS = (r"(?i)</?(?:p|div|br|hr|h[1-6]|li|ul|ol|dl|dt|dd|tr|td|th|table|article|section|header|footer|nav|aside|main|"
          r"title|body|html|blockquote|pre|figure|form)\b[^>]*>")
TAGS = r"</?[A-Za-z!?][^>]*>"
#: The same alternatives behind their common ``<``, which is what a search has to look for.
HIDDEN_AT_ONCE = "(?is)<(?:" + HIDDEN.removeprefix("(?is)<").replace("|<", "|") + ")"
ENTITY = r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,7});"
#: The named characters of HTML 4, as HTML 5 reads them, from the standard library.
ENTITIES = {n: html.entities.html5[n + ";"] for n in sorted(html.entities.name2codepoint)}
TITLE = r"(?is)<title\b[^>]*>(.*?)</title"
LANGUAGE = r"(?is)<html\b[^>]*\slang=[\x22']?([A-Za-z0-9-]+)"


def sha1_digest(data: Column) -> Column:
    """``sha1:`` and the digest in base 32, as WARC files write it: at most 60 bits at a time."""
    digest = F.sha1(data.cast("binary"))
    parts = [F.lpad(F.conv(F.substring(digest, at, size), 16, 32), size * 4 // 5, "0") for at, size in ((1, 15), (16, 15), (31, 10))]
    return F.concat(F.lit("sha1:"), F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32))


def name_id(*parts: Column) -> Column:
    """A name-based (version 3) UUID of the parts."""
    h = F.md5(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    cut = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)),
                      F.concat(F.lit("a"), F.substring(h, 18, 3)), F.substring(h, 21, 12))
    return F.concat(F.lit("<urn:uuid:"), cut, F.lit(">"))


def responses(pages: DataFrame, url: str = "url", payload: str = "html", key: str = "page_id", date: str = DATE,
              http_headers: str = HTTP_HEADERS) -> DataFrame:
    """Response records of fetched pages: (key, ``COLUMNS``)."""
    target, body = F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(payload), F.lit(""))
    block = F.concat(F.lit(http_headers + "\r\n\r\n"), body)
    return pages.select(
        F.col(key), name_id(F.lit("response"), F.col(key), target).alias("record_id"), F.lit("response").alias("warc_type"),
        F.lit(None).cast("string").alias("refers_to"), target.alias("target_uri"), F.lit(date).alias("date"),
        F.lit("application/http; msgtype=response").alias("content_type"), F.octet_length(block).cast("long").alias("content_length"),
        sha1_digest(block).alias("block_digest"), sha1_digest(body).alias("payload_digest"), block.alias("block"))


def _entities(text: Column) -> Column:
    """Character references decoded once, from left to right; unknown ones stay."""
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])

    def one(piece: Column) -> Column:
        name = F.regexp_extract(piece, ENTITY, 1)
        digits = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8)).cast("long")
        number = F.when(name.startswith("#"), digits)
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).when(name != "", F.element_at(names, name))
        return F.when(char.isNotNull(), F.concat(char, F.substr(piece, F.length(name) + 2))).otherwise(F.concat(F.lit("&"), piece))

    def joined(pieces: Column) -> Column:
        rest = F.transform(F.slice(pieces, 2, F.size(pieces) - 1), one)
        return F.when(F.size(pieces) == 1, F.get(pieces, F.lit(0))).otherwise(F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, "")))

    # The lambda binds the pieces, so that the text they come from is made once.
    return F.get(F.transform(F.array(F.split(text, "&", -1)), joined), F.lit(0))


def plain_text(page: Column) -> Column:
    """Visible text of an HTML page, a line for each block."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace(page, HIDDEN_AT_ONCE, " "), BREAKS, "\n"), TAGS, "")
    text = F.regexp_replace(_entities(text), "[ \\t\\r\\f\\u000B\\u00A0]{2,}|[\\t\\r\\f\\u000B\\u00A0]", " ")
    return F.regexp_replace(F.regexp_replace(text, " ?\\n[ \\n]*", "\n"), "^[ \\n]+|[ \\n]+$", "")


def _split(block: Column) -> tuple[Column, Column]:
    """HTTP head and payload of a response block; without an empty line all is payload."""
    at = F.instr(block, "\r\n\r\n")
    return (F.when(at > 0, F.substr(block, F.lit(1), at - 1)).otherwise(F.lit("")),
            F.when(at > 0, F.substr(block, at + 4)).otherwise(block))


def derivatives(records: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, ``COLUMNS``): a metadata and a conversion record for each response; other records give none."""
    source = records.where("warc_type = 'response'")
    block = F.coalesce(F.col("block").cast("string"), F.lit(""))
    head, page = _split(block)
    conversion, metadata = (name_id(F.lit(kind), F.col("record_id")) for kind in ("conversion", "metadata"))
    title = F.regexp_replace(F.regexp_replace(_entities(F.regexp_extract(page, TITLE, 1)), "[ \\t\\r\\n]+", " "), "^ | $", "")
    fields = F.concat(
        F.lit("source-record-id: "), F.col("record_id"), F.lit("\r\nconversion-record-id: "), conversion,
        F.lit("\r\nsource-block-digest: "), F.coalesce("block_digest", F.lit("")),
        F.lit("\r\nsource-payload-digest: "), F.coalesce("payload_digest", F.lit("")),
        F.lit("\r\nsource-content-length: "), F.octet_length(block).cast("string"),
        F.lit("\r\ntitle: "), title, F.lit("\r\nlanguage: "), F.regexp_extract(page, LANGUAGE, 1),
        F.lit("\r\n"), F.regexp_replace(head, "(?m)^", "source-http: "), F.lit("\r\n"))
    made = F.array(
        F.struct(metadata.alias("record_id"), F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(conversion.alias("record_id"), F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), plain_text(page).alias("block")))
    each = source.select(*keys, F.col("record_id").alias("refers_to"), "target_uri", "date", F.explode(made).alias("r"))
    digest = sha1_digest(F.col("r.block"))
    return each.select(
        *keys, "r.record_id", "r.warc_type", "refers_to", "target_uri", "date", "r.content_type",
        F.octet_length("r.block").cast("long").alias("content_length"), digest.alias("block_digest"), digest.alias("payload_digest"), "r.block")


def as_text(records: DataFrame) -> DataFrame:
    """One column, ``value``: each record with its WARC headers."""
    line = lambda name, c: F.coalesce(F.concat(F.lit(f"\r\n{name}: "), F.when(F.col(c).cast("string") != "", F.col(c).cast("string"))), F.lit(""))
    return records.select(F.concat(
        F.lit(VERSION), line("WARC-Type", "warc_type"), line("WARC-Record-ID", "record_id"), line("WARC-Refers-To", "refers_to"),
        line("WARC-Target-URI", "target_uri"), line("WARC-Date", "date"), line("WARC-Block-Digest", "block_digest"),
        line("WARC-Payload-Digest", "payload_digest"), line("Content-Type", "content_type"), line("Content-Length", "content_length"),
        F.lit("\r\n\r\n"), F.coalesce("block", F.lit("")), F.lit("\r\n")).alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """A folder of WARC files, one for each partition."""
    as_text(records).write.option("lineSep", "\r\n").option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(``COLUMNS``, complete) of the records in the files; header names in any case."""
    rows = spark.read.option("lineSep", VERSION + "\r\n").text(path).where("value <> ''")
    at = F.instr("value", "\r\n\r\n")
    head = F.concat(F.lit("\r\n"), F.substr("value", F.lit(1), at - 1), F.lit("\r\n"))
    field = lambda name: F.regexp_extract("head", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)
    rows = rows.select(head.alias("head"), F.substr("value", at + 4).alias("rest"))
    found = rows.select(
        field("WARC-Record-ID").alias("record_id"), F.lower(field("WARC-Type")).alias("warc_type"),
        F.nullif(field("WARC-Refers-To"), F.lit("")).alias("refers_to"), field("WARC-Target-URI").alias("target_uri"),
        field("WARC-Date").alias("date"), field("Content-Type").alias("content_type"),
        field("Content-Length").try_cast("long").alias("content_length"), field("WARC-Block-Digest").alias("block_digest"),
        field("WARC-Payload-Digest").alias("payload_digest"), F.col("rest").cast("binary").alias("rest"))
    return found.select(
        *COLUMNS[:-1], F.substring("rest", F.lit(1), F.coalesce(F.col("content_length"), F.length("rest")).cast("int")).cast("string").alias("block"),
        F.coalesce(F.length("rest") >= F.col("content_length"), F.lit(False)).alias("complete"))
