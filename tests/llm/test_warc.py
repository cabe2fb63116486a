import gzip
import html.parser
import re

import pytest

from retainspark.llm import warc

PAGE = ("<!DOCTYPE html><html><head><title>A &amp; B\n title</title><style>p{x}</style></head><body><script>var a='</p>';</script>"
        "<h1>Head</h1><p>One <b>bold</b> word &lt;kept&gt; &copy; 2&nbsp;x.<br>next<!-- gone --> line</p>"
        "<a class=c href='/x?a=1&amp;b=2'>l1</a> <a HREF=\"y\">l2</a><ul><li>i1<li>i2</ul></body></html>")


class Reader(html.parser.HTMLParser):
    """Another way to a page's text."""

    BLOCK = {"p", "div", "br", "li", "ul", "h1", "h2", "article", "nav", "footer", "html", "body", "section"}
    SKIP = {"script", "style", "head", "noscript", "template"}

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.off = [], 0
        self.feed(page)
        self.close()
        lines = [re.sub(r"\s+", " ", x).strip() for x in "".join(self.out).split("\n")]
        self.text = "\n".join(x for x in lines if x)

    def handle_starttag(self, tag, attrs):
        self.off += tag in self.SKIP
        self.out.append("\n" if tag in self.BLOCK else "")

    def handle_endtag(self, tag):
        self.off -= tag in self.SKIP
        self.out.append("\n" if tag in self.BLOCK else "")

    def handle_data(self, data):
        if not self.off:
            self.out.append(data)


@pytest.fixture
def pages(spark):
    def make(rows, schema="page_id long, url string, html string"):
        return spark.createDataFrame(rows, schema)
    return make


def test_plain_text():
    assert warc.plain_text(PAGE) == "Head\nOne bold word <kept> © 2 x.\nnext line\nl1 l2\ni1\ni2"
    assert warc.plain_text("") == "" and warc.plain_text("a < b & c") == "a < b & c"
    assert warc.plain_text("x<script>never closed") == "x"


@pytest.mark.parametrize("head, title", [
    ("<html><head><title>t</title><body>", "t"), ("<head><meta charset=x><title>t <b>u</b> </title><link href=a>", "t u"),
    ("<html><HEAD lang=x><title>t</title ><style>p{x}</style><script>'<body>'</script></body><!-- </head> -->", "t"),
    ("<title>t</title>", "t"), ("<html><head>", None), ("<head><title>not closed</head><body>", None), ("<head><title>not closed", None),
    ("<html><head><title>t</title></head><body>", "t"), ("<head></head><body>", None)])
def test_a_page_whose_head_is_not_closed_keeps_its_body(head, title):
    page = head + "<p>All the text</p><a href=x>l</a></body></html>"
    assert warc.plain_text(page) == "All the text\nl"
    notes, _ = warc.derive("u", page, warc.HEAD, warc.DATE)
    assert notes["n_links"] == 1 and b"outlink: x" in notes["record"]
    assert title is None or f"title: {title}".encode() in notes["record"]


def test_text_of_every_page_matches_a_parser(spark, sf_dir):
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        assert warc.plain_text(r.html) == Reader(r.html).text, r.page_id


def test_records_link_and_keep_the_source(pages):
    df = pages([(1, "http://x/", PAGE, "HTTP/1.1 404 Gone\r\nServer: s\r\nX-Y: z", "2024-01-02T03:04:05Z")],
               "page_id long, url string, html string, http string, date string")
    rows = {r.record_type: r for r in warc.derivatives(df, http_col="http", date_col="date").collect()}
    assert set(rows) == {"metadata", "conversion"}
    for kind, r in rows.items():
        head, block, rest = warc.parse(bytes(r.record))
        assert rest == b"" and head["WARC-Type"] == kind and head["WARC-Record-ID"] == r.record_id
        assert head["WARC-Refers-To"] == r.refers_to and head["WARC-Refers-To-Target-URI"] == "http://x/"
        assert head["WARC-Date"] == head["WARC-Refers-To-Date"] == "2024-01-02T03:04:05Z"
        assert head["WARC-Source-Payload-Digest"] == warc.digest(PAGE.encode()) == r.source_payload_digest
        assert head["WARC-Block-Digest"] == warc.digest(block) == r.block_digest and len(block) == r.block_length
    text = warc.parse(bytes(rows["conversion"].record))[1]
    notes = warc.parse(bytes(rows["metadata"].record))[1].decode().split("\r\n")
    assert text.decode() == warc.plain_text(PAGE)
    assert "httpStatus: HTTP/1.1 404 Gone" in notes and "httpHeader: X-Y: z" in notes and "title: A & B title" in notes
    assert "outlink: /x?a=1&b=2" in notes and "outlink: y" in notes and rows["metadata"].n_links == 2
    assert f"conversionDigest: {warc.digest(text)}" in notes and f"sourceRecord: {rows['metadata'].refers_to}" in notes
    assert rows["metadata"].refers_to == rows["conversion"].refers_to and rows["metadata"].record_id != rows["conversion"].record_id


def test_special_rows(pages):
    rows = [(1, None, None), (2, "", ""), (3, "http://a\nb", "x"), (4, "u", "t"), (4, "u", "t"), (None, "u", "t"),
            (5, "long", "<p>é word</p>" * 40_000)]
    df = pages([(*r, 0, 0) for r in rows], "page_id long, url string, html string, record int, c0 int")
    out = warc.derivatives(df).collect()
    assert len(out) == 14 and all(r.c0 == 0 for r in out)
    for r in out:
        head, block, rest = warc.parse(bytes(r.record))
        assert rest == b"" and len(block) == r.block_length
    same = {(r.record_type, r.record_id) for r in out if r.url == "u"}
    assert len(same) == 2
    assert {r.block_length for r in out if r.page_id in (1, 2) and r.record_type == "conversion"} == {0}
    assert warc.parse(bytes(next(r.record for r in out if r.page_id == 3)))[0]["WARC-Target-URI"] == "http://a b"


def test_files_and_empty_table(spark, pages, tmp_path):
    df = warc.derivatives(pages([(i, f"http://x/{i}", PAGE) for i in range(20)]).repartition(3))
    files = warc.write_files(df, f"file://{tmp_path}/w").collect()
    assert sum(f.records for f in files) == 40
    seen = set()
    for f in files:
        data = gzip.decompress((tmp_path / "w" / f.file).read_bytes())
        while data:
            head, _, data = warc.parse(data)
            seen.add(head["WARC-Record-ID"])
    assert len(seen) == 40
    assert warc.derivatives(pages([])).count() == 0
    assert warc.write_files(warc.derivatives(pages([])), f"file://{tmp_path}/e").count() == 0


@pytest.mark.parametrize("unit", ["<a ", "<b", "<title>", "<script ", "<a x", "</title ", "<!-", "<a href=\"", "<a href='>", "<p", "</script "])
@pytest.mark.parametrize("end", ["", ">", "</title>"])
def test_malformed_pages_take_linear_time(unit, end):
    import time
    page = "<p>T</p>" + unit * ((1 << 20) // len(unit)) + end
    start = time.process_time()
    records = warc.derive("u", page, warc.HEAD, warc.DATE)
    assert time.process_time() - start < 2 and len(records) == 2


@pytest.mark.parametrize("n", [20, 2000, 200_000])
def test_a_long_title_is_no_text(n):
    assert warc.plain_text("<title>a <b>" + "x" * n + "</title><p>T</p>") == "T"
    assert warc.scan("<title>a <b>" + "x" * n + "</title><p>T</p>")[1] == "a " + "x" * n


def test_links_and_odd_tags():
    kept, title = warc.scan("<a href=\"x>y\">1</a><a name=z>2<a HREF = u>3<a href='v w'/><A hreflang=q href=>4<!-- <a href=no> --><a href=\"open>5</a>")
    assert warc.links(kept) == ["x>y", "u", "v w", '"open'] and title == ""
    assert warc.plain_text("1 < 2 <b>x</b> <c") == "1 < 2 x <c"
    assert warc.plain_text("a<!-- b") == "a" and warc.plain_text("a > b <!-- c") == "a > b"
    assert warc.plain_text("<title>t</title>a<style>b</style >c<title>d") == "a c"


def test_source_ids_digests_and_bytes_are_preserved(spark):
    body = "<html><title>Caf\xe9</title><p>d\xe9j\xe0 vu</p>".encode("latin-1")
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\nX-A: b\r\n"
    rows = [(1, "u", body, head, "2024-01-02T03:04:05Z", "<urn:uuid:1>", "sha1:AAA"), (2, "u", body, head, None, None, None),
            (3, "u", None, "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=nonsense\r\n", None, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html binary, http string, date string, id string, digest string")
    out = {(r.page_id, r.record_type): r for r in warc.derivatives(df, http_col="http", date_col="date", id_col="id", digest_col="digest").collect()}
    one, two = out[1, "conversion"], out[2, "conversion"]
    assert one.refers_to == "<urn:uuid:1>" and one.source_payload_digest == "sha1:AAA"
    assert two.source_payload_digest == warc.digest(body) and two.refers_to.startswith("<urn:uuid:")
    for r in (one, two):
        headers, block, rest = warc.parse(bytes(r.record))
        assert block.decode() == "d\xe9j\xe0 vu" and rest == b"" and headers["WARC-Refers-To"] == r.refers_to
        assert headers["WARC-Source-Payload-Digest"] == r.source_payload_digest
    notes = bytes(out[1, "metadata"].record).decode()
    assert "title: Caf\xe9\r\n" in notes and "httpHeader: X-A: b" in notes and "WARC-Date: 2024-01-02T03:04:05Z" in notes
    assert out[3, "conversion"].block_length == 0 and out[3, "conversion"].source_payload_digest == warc.digest(b"")
