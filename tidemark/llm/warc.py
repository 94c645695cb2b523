"""Derivatives of web captures: metadata and plain-text conversion records of response records.

A record is a row: type, id, the id it refers to, target, date, content type, digests, block. The derivatives
keep the identifier of the response they come from (``WARC-Refers-To``), its target, date, headers and
payload digest. DataFrame functions only; records can be written as WARC text files by Spark's own writer.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.let import let

CRLF = "\r\n"
VERSION = "WARC/1.1"
# Elements without running text, and elements that end a line.
HIDDEN = ("script", "style", "noscript", "template", "head")
BREAKS = ("p", "br", "div", "li", "ul", "ol", "tr", "table", "h1", "h2", "h3", "h4", "h5", "h6", "article", "section",
          "nav", "header", "footer", "blockquote", "pre", "title", "hr", "dd", "dt", "figure", "main", "aside")
# Named characters in daily use, looked up first; a no-break space and a line end are read as a space.
FREQUENT = ("amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "reg", "trade", "middot", "bull", "hellip", "ndash", "mdash", "lsquo",
            "rsquo", "ldquo", "rdquo", "laquo", "raquo", "euro", "deg", "times")
NAMES = {name[:-1]: char.replace("\xa0", " ").replace("\n", " ") for name, char in html5.items() if name.endswith(";")}
# Numbers 128 to 159 mean the characters of windows-1252, where it has one.
WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}
SPACES = (10, 13, 160)
UNKNOWN = "\ufffd"
REFERENCE = r"^(#0*[0-9]{1,7}|#[xX]0*[0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def record_id(*parts: Column) -> Column:
    """A reproducible identifier: a UUID made of the first half of a SHA-256 of the parts."""
    h = F.sha2(F.concat_ws("\n", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def title_of(html: Column) -> Column:
    return F.trim(characters(_spaces(F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)</title", 1))))


def links_of(html: Column) -> Column:
    """Targets of the links in their order, each once: quoted or not, character references read."""
    found = F.regexp_extract_all(html, F.lit(LINK), F.lit(1))
    return F.array_distinct(F.transform(found, lambda x: characters(F.regexp_replace(x, "^[\"']|[\"']$", ""))))


LINK = r"""(?i)<a[ \t\r\n\f](?:[^>]*?[ \t\r\n\f])?href[ \t\r\n\f]*=[ \t\r\n\f]*("[^"]*"|'[^']*'|[^ \t\r\n\f"'>]+)"""


def _lookup(names: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in names.items() for x in pair])


def _named(name: Column) -> Column:
    frequent = {n: NAMES[n] for n in FREQUENT}
    every = F.from_json(F.lit(json.dumps(NAMES)), "map<string,string>")  # folded to one constant
    return F.coalesce(F.try_element_at(_lookup(frequent), name), F.try_element_at(every, name))


def _numbered(name: Column) -> Column:
    digits = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2)))

    def char(n: Column) -> Column:
        # The byte order mark in front keeps the decoder from reading a character as one.
        plain = F.decode(F.unhex(F.concat(F.lit("0000FEFF"), F.lpad(F.hex(n), 8, "0"))), "UTF-32")
        return F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit(UNKNOWN)).when(
            n.between(128, 159), F.try_element_at(_lookup(WINDOWS), n)).when(n.isin(*SPACES), F.lit(" ")).otherwise(plain)

    return let(digits.cast("int"), char)


def characters(text: Column) -> Column:
    """Character references read once: decimal, hexadecimal and all named ones, each with its semicolon. Unknown ones stay."""
    def meant(piece: Column) -> Column:
        def read(name: Column) -> Column:
            char = F.when(name.startswith("#"), _numbered(name)).when(name != "", _named(name))
            return let(char, lambda c: F.when(c.isNull(), F.concat(F.lit("&"), piece)).otherwise(
                F.concat(c, F.substr(piece, F.length(name) + 2))))
        return let(F.regexp_extract(piece, REFERENCE, 1), read)

    def joined(pieces: Column) -> Column:
        return F.concat(F.get(pieces, F.lit(0)), F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), meant), ""))

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), let(F.split(t, "&"), joined)).otherwise(t))


def _spaces(text: Column) -> Column:
    # A single space is left alone.
    return F.regexp_replace(text, r"[ \t\r\f\x0B]{2,}|[\t\r\f\x0B]", " ")


def plain_text(html: Column) -> Column:
    """Running text: hidden elements and comments go, block elements end lines, other tags go, character references are
    read, white space is folded, empty lines go. Comments and hidden elements are told apart where they begin: a comment
    that begins inside a script belongs to the script."""
    text = F.regexp_replace(html, rf"(?is)<!--.*?-->|<({'|'.join(HIDDEN)})(?:\s[^>]*)?>.*?</\1\s*>", "")
    text = F.regexp_replace(text, r"[\r\n]+", " ")
    text = F.regexp_replace(text, rf"(?i)</?(?:{'|'.join(BREAKS)})(?:\s[^>]*)?/?>", "\n")
    text = F.regexp_replace(text, r"<[A-Za-z/!?][^>]*>", "")
    text = F.regexp_replace(_spaces(characters(text)), r" ?\n[ \n]*", "\n")
    return F.trim(F.trim(text, F.lit("\n")))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records of captured pages: page_id, url, html. Null html is an empty payload; a null url stays null."""
    payload = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length(payload).cast("string"), F.lit(CRLF))
    return pages.select(
        F.col("page_id"), record_id(F.lit("response"), F.col("page_id"), F.col("url"), payload).alias("record_id"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.lit("application/http;msgtype=response").alias("content_type"),
        head.alias("http_headers"), payload.alias("payload"), digest(payload).alias("payload_digest"))


def derivatives(records: DataFrame) -> DataFrame:
    """Two records for each response: ``metadata`` and ``conversion``.

    Columns: page_id, warc_type, record_id, refers_to, target_uri, date, content_type, payload_digest (of the response),
    block_digest, content_length, block. The metadata block names the source's identifier, its HTTP headers, title,
    distinct links and sizes as header lines; the conversion block is the plain text. Empty or null payloads give
    an empty conversion; a null target or date stays null. Responses that repeat have equal derivatives; other columns
    are ignored. Very long payloads are read whole. An empty table gives an empty result. No shuffle.
    """
    source = records.select(
        "page_id", "record_id", "target_uri", "date", F.coalesce("http_headers", F.lit("")).alias("http_headers"),
        F.coalesce("payload", F.lit("")).alias("html"), "payload_digest")
    read = source.withColumns({"plain": plain_text(F.col("html")), "title": title_of(F.col("html")), "links": links_of(F.col("html"))})
    lines = F.concat(
        F.lit("source-record-id: "), F.coalesce("record_id", F.lit("")), F.lit(CRLF), F.col("http_headers"),
        F.lit("title: "), F.regexp_replace("title", r"[\r\n]+", " "), F.lit(CRLF),
        F.lit("text-length: "), F.octet_length("plain").cast("string"), F.lit(CRLF),
        F.array_join(F.transform("links", lambda x: F.concat(F.lit("outlink: "), x, F.lit(CRLF))), ""))
    made = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"), lines.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("plain").alias("block")))
    return read.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", "payload_digest",
                       F.inline(made)).select(
        "page_id", "warc_type", record_id(F.col("warc_type"), F.col("refers_to")).alias("record_id"), "refers_to", "target_uri",
        "date", "content_type", "payload_digest", digest(F.col("block")).alias("block_digest"),
        F.octet_length("block").cast("long").alias("content_length"), "block")


def as_warc(records: DataFrame) -> DataFrame:
    """One column ``value``: each derivative as the text of a WARC record (headers, empty line, block)."""
    def line(name: str, column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.concat(F.lit(f"{name}: "), F.col(column).cast("string"), F.lit(CRLF))).otherwise("")

    return records.select(F.concat(
        F.lit(VERSION + CRLF), line("WARC-Type", "warc_type"), line("WARC-Record-ID", "record_id"), line("WARC-Refers-To", "refers_to"),
        line("WARC-Target-URI", "target_uri"), line("WARC-Date", "date"), line("WARC-Payload-Digest", "payload_digest"),
        line("WARC-Block-Digest", "block_digest"), line("Content-Type", "content_type"), line("Content-Length", "content_length"),
        F.lit(CRLF), F.col("block")).alias("value"))


def write_warc(records: DataFrame, folder: str, compression: str = "none") -> None:
    """Write derivatives as WARC files, one a partition. Spark ends each record with the two line ends of the format."""
    as_warc(records).write.option("lineSep", CRLF + CRLF).option("compression", compression).text(folder)
