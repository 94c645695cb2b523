import hashlib
from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from tidemark.llm.warc import BREAKS, characters, derivatives, plain_text, responses, title_of, write_warc


class Reader(HTMLParser):
    """Running text by the library parser: an independent second way."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style", "noscript", "template", "head")
        if tag in BREAKS:
            self.out.append("\n")

    def handle_startendtag(self, tag, attrs):
        if tag in BREAKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style", "noscript", "template", "head")
        if tag in BREAKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data.replace("\n", " ").replace("\r", " "))


def read(html):
    reader = Reader()
    reader.feed(html)
    reader.close()
    lines = [" ".join(x.replace("\xa0", " ").split(" ")) for x in "".join(reader.out).split("\n")]
    return "\n".join(x for x in (" ".join(line.split()) for line in lines) if x)


PAGES = [(1, "http://a.example/", "<html><head><title> A  title </title></head><body><p>One<br>two &amp; three</p><!-- no --><div>4 &lt; 5</div></body>"),
         (2, None, "<p>no url</p><a href='/x'>x</a> <a class=c href=\"/y\">y</a><a href='/x'>again</a>"), (3, "u", None), (4, "u", ""),
         (5, "u", "<script>var t='<p>';</script>plain\n\ntext &nbsp; end<STYLE >p{}</STYLE>"), (None, "u", "<ul><li>a<li>b</ul>"),
         (6, "u", "a < b and c > d"), (8, "u", "caf&eacute; &#8217; &#x2014; &#X1F600; &#128; &ngE; &#0; &unknown; &amp;lt; &; & &#xZ; R&D; x&nbsp;y &NewLine; z&#65279;"),
         (9, "u", "<script>a<!-- </script>kept<!-- <script> -->this<a href=/p/1?a=1&amp;b=2>1</a><a\nclass=x href = 'q r'>2</a><a data-href=no>3</a>"), (7, "é", "<p title='x'>é</p>"), (7, "é", "<p title='x'>é</p>")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, block string")


def test_text_is_that_of_a_parser(spark, sf, pages):
    given = spark.read.parquet(f"{sf}/pages.parquet").select("html").unionByName(pages.select("html")).where("html is not null")
    for r in given.select("html", plain_text(given.html).alias("plain"), title_of(given.html).alias("title")).collect():
        assert r.plain == read(r.html)
    assert pages.where("page_id = 1").select(title_of(pages.html)).first()[0] == "A title"


def test_records_are_linked_and_whole(pages):
    sources = {r.record_id: r for r in responses(pages).collect()}
    got = derivatives(responses(pages)).collect()
    assert len(got) == 2 * len(PAGES)
    for r in got:
        source = sources[r.refers_to]
        assert (r.page_id, r.target_uri, r.date, r.payload_digest) == (source.page_id, source.target_uri, source.date, source.payload_digest)
        assert source.payload_digest == "sha256:" + hashlib.sha256(source.payload.encode()).hexdigest()
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode()) and r.record_id not in sources
        if r.warc_type == "conversion":
            assert r.block == read(source.payload)
        else:
            assert source.http_headers in r.block and f"source-record-id: {source.record_id}\r\n" in r.block
    links = next(r.block for r in got if r.page_id == 2 and r.warc_type == "metadata")
    assert [x for x in links.split("\r\n") if x.startswith("outlink")] == ["outlink: /x", "outlink: /y"]


def test_a_very_long_page(spark):
    html = "<p>" + "caf&eacute; <b>x</b>\n<br>" * 200_000 + "</p>"
    got = derivatives(responses(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")))
    assert got.where("warc_type = 'conversion'").first().block == "\n".join(["caf\u00e9 x"] * 200_000)


def test_every_named_reference(spark):
    """All names of the standard library's table, in one page."""
    names = [n for n, c in html5.items() if n.endswith(";") and c not in ("\xa0", "\n")]
    page = "|".join(f"&{n}" for n in names)
    got = spark.createDataFrame([(page,)], "html string").select(characters(F.col("html")).alias("t")).first().t
    assert got == "|".join(html5[n] for n in names)


def test_links(pages):
    links = next(r.block for r in derivatives(responses(pages)).collect() if r.page_id == 9 and r.warc_type == "metadata")
    assert [x for x in links.split("\r\n") if x.startswith("outlink")] == ["outlink: /p/1?a=1&b=2", "outlink: q r"]


def test_empty_table(spark, pages):
    assert derivatives(responses(pages.where("false"))).collect() == []


def test_written_files_read_back(spark, pages, tmp_path):
    records = derivatives(responses(pages))
    write_warc(records, str(tmp_path / "warc"))
    found = []
    for part in (tmp_path / "warc").glob("part-*"):
        data = part.read_bytes()
        while data:
            head, data = data.split(b"\r\n\r\n", 1)
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.1"
            fields = dict(x.split(": ", 1) for x in lines[1:])
            n = int(fields["Content-Length"])
            block, data = data[:n], data[n:]
            assert data.startswith(b"\r\n\r\n")
            data = data[4:]
            found.append((fields["WARC-Type"], fields["WARC-Record-ID"], fields["WARC-Refers-To"], fields.get("WARC-Target-URI"), block.decode()))
    assert sorted(found, key=repr) == sorted(((r.warc_type, r.record_id, r.refers_to, r.target_uri, r.block) for r in records.collect()), key=repr)
