import hashlib
import json
import random
import re
import time
from html.parser import HTMLParser

import pytest
from llm_cases import clashing

from hourlake.llm import warc
from hourlake.llm.tables import new_folder

SCHEMA = "page_id BIGINT, url STRING, html STRING"
PAGES = [
    (1, "http://a.example/ä", "<html><head><title>T &amp; x</title></head><body><p>one<br>two &lt;3</p>"
        "<script>no()</script><a href='/l?x=1'>link</a><!-- gone --></body></html>"),
    (2, None, None),
    (3, "http://b.example/", ""),
    (4, "http://c.example/", "plain\r\n\r\nWARC/1.1\r\n\r\n text   <b>x"),
    (4, "http://c.example/", "plain\r\n\r\nWARC/1.1\r\n\r\n text   <b>x"),
    (None, "http://d.example/", "<p>" * 20000 + "long"),
]


def test_derivatives_refer_to_their_responses(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    responses = {r["record_id"]: r for r in warc.responses_of(pages).collect()}
    found = warc.derivatives(warc.responses_of(pages)).collect()
    assert len(found) == 12 and len(responses) == 5
    for r in found:
        source = responses[r["refers_to"]]
        assert (r["target_uri"], r["date"]) == (source["target_uri"], source["date"])
        assert r["block_digest"] == warc.digest(r["block"])
        assert r["source_digest"] == source["payload_digest"]
        if r["record_type"] == "metadata":
            told = json.loads(r["block"])["source"]
            assert told["WARC-Record-ID"] == source["record_id"]
            assert told["WARC-Block-Digest"] == source["block_digest"]
    kinds = [r["record_type"] for r in found]
    assert kinds.count("metadata") == kinds.count("conversion") == 6


def test_text_title_and_links():
    page = PAGES[0][2]
    assert warc.visible_text(page) == "one\ntwo <3\nlink"
    block = b"HTTP/1.1 404 Gone\r\nX-A: b:c\r\n\r\n" + page.encode()
    response = dict.fromkeys(warc.RECORDS.names) | {"record_id": "<r>", "date": "d", "block": block}
    metadata, conversion = warc.derived(response)
    told = json.loads(metadata["block"])
    assert told["http"] == {"status": "HTTP/1.1 404 Gone", "headers": {"x-a": "b:c"}}
    assert told["html"] == {"title": "T & x", "links": ["/l?x=1"]}
    assert conversion["block"] == b"one\ntwo <3\nlink"
    assert warc.split_http(b"no head") == ("", {}, b"no head")


def test_files_are_warc_and_read_back_whole(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    records = warc.responses_of(pages).union(warc.derivatives(warc.responses_of(pages)))
    folder = new_folder(spark, "warc-test")
    warc.write_warc(records, folder)
    wanted = sorted(tuple(r) for r in records.fillna("").collect())
    found = sorted(tuple(r) for r in warc.read_warc(spark, folder).fillna("").collect())
    assert found == wanted
    text = b"".join(r[0] for r in spark.read.format("binaryFile").load(folder).select("content").collect())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: ") and text.endswith(b"\r\n\r\n")


def test_query_rows(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    found = warc.page_derivatives(pages).collect()
    assert len(found) == 12
    for r in found:
        assert hashlib.sha1(r["content"].encode()).digest() == __import__("base64").b32decode(r["block_digest"][5:])
    assert warc.page_derivatives(pages.limit(0)).count() == 0


class Brute(HTMLParser):
    """Text, title and links of a page by the library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden, self.titles, self.links = [], [], [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href"][:1]
        if tag == "title":
            self.titles.append("")
        if self.hidden or tag in warc._HIDDEN:
            self.hidden.append(tag)
        self.out.append("\n" if tag in warc._LINE and not self.hidden else "")

    def handle_endtag(self, tag):
        if self.hidden:
            self.out.append(" ")
            self.hidden.pop()
        elif tag in warc._LINE:
            self.out.append("\n")

    def handle_comment(self, data):
        self.out.append("" if self.hidden else " ")

    def handle_data(self, data):
        if self.hidden and self.hidden[-1] == "title" and len(self.titles) == 1:
            self.titles[0] += data
        if not self.hidden:
            self.out.append(data)

    def text(self):
        lines = (re.sub(r"[ \t\r\f\v ]+", " ", x).strip() for x in "".join(self.out).split("\n"))
        return "\n".join(x for x in lines if x)


def random_page(seed):
    draw = random.Random(seed)
    words = ["one", "&amp;", "zwei &lt; 3", "é", "a  b", "\n", "&#x41;", "5 > 4"]

    def text():
        return " ".join(draw.choice(words) for _ in range(draw.randrange(4)))

    def inside(depth):
        parts = [text()]
        for _ in range(draw.randrange(4) if depth else 0):
            tag = draw.choice(["p", "div", "b", "SPAN", "h2", "li", "a", "script", "style", "!--", "br"])
            if tag == "!--":
                parts.append(f"<!-- {draw.choice(['x', '<p>no', 'a > b'])} -->")
            elif tag in ("script", "style"):
                parts.append(f"<{tag}>if (a < b) 'x'</{tag} >")
            elif tag == "br":
                parts.append("<br/>")
            elif tag == "a":
                link = draw.choice(["/x", "http://h/?a=1#b", "a>b" if draw.random() < 0.2 else "y z"])
                parts.append(f"<a class='c' HREF = \"{link}\">{text()}</a>")
            else:
                parts.append(f"<{tag} id='i{depth}'>{inside(depth - 1)}</{tag}>")
            parts.append(text())
        return "".join(parts)

    return f"<!doctype html><html><head><title>{text()}</title><style>p > a</style></head><body>{inside(4)}</body></html>"


def test_pages_read_like_a_parser_does():
    for seed in range(300):
        page = random_page(seed)
        brute = Brute(page)
        if "a>b" not in page:
            assert warc.visible_text(page) == brute.text(), page
        assert warc.links_of(page) == brute.links, page
        assert warc.title_of(page) == re.sub(r"[ \t\r\f\v ]+", " ", brute.titles[0]).strip(), page


@pytest.mark.parametrize("part", ["<script>", "<!--", "<a ", "<a href='", "<title>", "</script", "<", "<p", "<head><a href=\"x"])
def test_pages_of_unclosed_marks_take_no_longer_than_others(part):
    page = part * ((2 << 20) // len(part))
    started = time.process_time()
    warc.visible_text(page), warc.links_of(page), warc.title_of(page)
    assert time.process_time() - started < 4


def test_headers_are_one_line_and_records_are_told_apart(spark):
    rows = [
        (1, "http://a/\r\n\r\nWARC/1.1\r\n", "x"), (2, "http://b/\x00\x7f\t", "y"), (3, "http://c/", "first"),
        (3, "http://c/", "second"), (None, None, "one"), (None, None, "two"), (None, "None", "one"),
    ]
    pages = clashing(spark.createDataFrame(rows, SCHEMA), "record_id", "block", "date")
    found = warc.page_derivatives(pages).collect()
    assert len(found) == 14 == len({r["record_id"] for r in found})
    assert len({r["refers_to"] for r in found}) == 7
    assert {r["target_uri"] for r in found} == {
        "http://a/%0D%0A%0D%0AWARC/1.1%0D%0A", "http://b/%00%7F%09", "http://c/", None, "None",
    }
    records = warc.responses_of(pages).withColumn("target_uri", warc.F.lit("a\r\n\r\nb"))
    folder = new_folder(spark, "warc-test")
    warc.write_warc(records, folder)
    assert {r["target_uri"] for r in warc.read_warc(spark, folder).collect()} == {"a%0D%0A%0D%0Ab"}


def test_a_record_without_length_says_so():
    with pytest.raises(ValueError, match="the record at byte 0 has no length"):
        list(warc.parse_warc(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n"))
