"""WARC derivatives: metadata and plain-text conversion records of response records.

A response record is rows of named headers and a block of HTTP head and body. From each one come

* a ``metadata`` record: JSON of the response's WARC headers, HTTP status and headers, title, links
  and lengths,
* a ``conversion`` record: the page's visible text,

both with ``WARC-Refers-To`` the response's id, its target address and date, digests of their own
blocks, the payload digest of the source, and, in the metadata, its digests and headers. Records are written as WARC
files by Spark's text writer: a record ends with two empty lines, which is the line separator here.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourlake.llm.tables import as_bytes, bounded, new_folder

VERSION = "WARC/1.1"
#: Date of responses whose source has none.
NO_DATE = "1970-01-01T00:00:00Z"
#: Records of a written file.
FILE_RECORDS = 20_000

RECORDS = T.StructType(
    [
        T.StructField("record_id", T.StringType(), False),
        T.StructField("record_type", T.StringType(), False),
        T.StructField("refers_to", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("date", T.StringType(), False),
        T.StructField("content_type", T.StringType(), False),
        T.StructField("block_digest", T.StringType(), False),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("source_digest", T.StringType()),
        T.StructField("block", T.BinaryType(), False),
    ]
)

# Elements whose content isn't shown, and elements that end a line.
_HIDDEN = ("script", "style", "noscript", "template", "head")
_LINE = "p div br li ul ol h1 h2 h3 h4 h5 h6 tr table section article nav header footer blockquote pre".split()
# End of fixed values.
_UNSEEN = re.compile(rf"(?i)<(?:!--|({'|'.join(_HIDDEN)})\b)")
_LINE_TAG = re.compile(rf"(?i)</?(?:{'|'.join(_LINE)})\b[^>]*>")
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_CLOSING = {name: re.compile(rf"(?i)</{name}\s*>") for name in (*_HIDDEN, "title")}
_TITLE, _LINK, _HREF = re.compile("(?i)<title"), re.compile(r"(?i)<a\b"), re.compile(r"(?i)\bhref\s*=\s*")
#: Runs of blanks but the single space, which stays as it is.
_BLANKS = re.compile(r"[\t\r\f\v][ \t\r\f\v]*| [ \t\r\f\v]+")
_CONTROL = re.compile("[\x00-\x1f\x7f]")


def digest(data: bytes) -> str:
    """SHA-1 in base 32, as WARC files have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_name(*parts: str) -> str:
    """A record id that is the same whenever it is built from the same parts."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(31).join(parts))}>"


def _shown(page: str) -> str:
    """A page with a blank in place of each comment and hidden element. A closing mark that isn't found from
    one place on isn't looked for again, so unclosed ones, which stay, cost no more than others."""
    out, begin, at, missing = [], 0, 0, set()
    while opening := _UNSEEN.search(page, at):
        at, name = opening.end(), (opening[1] or "").lower()
        if name in missing:
            continue
        if name:
            closing = _CLOSING[name].search(page, at)
            end = closing.end() if closing else -1
        else:
            end = page.find("-->", at) + 3 if page.find("-->", at) >= 0 else -1
        if end < 0:
            missing.add(name)
            continue
        out += [page[begin : opening.start()], " "]
        begin = at = end
    return "".join([*out, page[begin:]])


def visible_text(page: str) -> str:
    """Text of a page, a line for each block element, blanks run together, no empty lines.

    Tags are looked for up to the last closing bracket only: there each opening one is closed, so a search never
    runs on in vain.
    """
    shown = _shown(page)
    last = shown.rfind(">") + 1
    text = _TAG.sub("", _LINE_TAG.sub("\n", shown[:last])) + shown[last:]
    lines = (line.strip() for line in one_blank(html.unescape(text)).split("\n"))
    return "\n".join(line for line in lines if line)


def one_blank(text: str) -> str:
    """Each run of blanks as one space; most texts have none that differs."""
    return _BLANKS.sub(" ", text) if "  " in text or any(c in text for c in "\t\r\f\v") else text


def title_of(page: str) -> str | None:
    """The text of the first title element, if it is closed."""
    opening = _TITLE.search(page)
    begin = page.find(">", opening.end()) if opening else -1
    closing = _CLOSING["title"].search(page, begin) if begin >= 0 else None
    return one_blank(html.unescape(page[begin + 1 : closing.start()])).strip() if closing else None


def links_of(page: str) -> list[str]:
    """The values of ``href`` in the tags of links, in order, each part of the page looked at once."""
    found, at, missing = [], 0, set()
    while (link := _LINK.search(page, at)) and (close := page.find(">", link.end())) >= 0:
        at = close + 1
        href = _HREF.search(page, link.end(), close)
        if not href:
            continue
        quote = page[href.end()]
        end = page.find(quote, href.end() + 1) if quote in "\"'" and quote not in missing else -1
        if end >= 0:
            found.append(page[href.end() + 1 : end])
            at = max(at, end + 1)
        elif quote in "\"'":
            missing.add(quote)
        elif value := page[href.end() : close].split(maxsplit=1):
            found.append(value[0])
    return found


def header_value(value: str) -> str:
    """A header's value on one line: control characters are percent-encoded."""
    return _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", value)


def split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    """Status line, headers by lower-case name and body of an HTTP response."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return "", {}, block
    status, *lines = head.decode("latin-1").split("\r\n")
    pairs = (line.partition(":") for line in lines)
    return status, {name.strip().lower(): value.strip() for name, _, value in pairs}, body


def _responses_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for page_id, url, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}"
            block = head.encode() + b"\r\n\r\n" + body
            rows.append(
                {
                    # Two captures of a page, and pages without id or url, differ by their bodies.
                    "record_id": record_name("response", repr(page_id), repr(url), digest(body)),
                    "record_type": "response",
                    "refers_to": None,
                    "target_uri": None if url is None else header_value(url),
                    "date": NO_DATE,
                    "content_type": "application/http; msgtype=response",
                    "block_digest": digest(block),
                    "payload_digest": digest(body),
                    "source_digest": None,
                    "block": block,
                }
            )
        yield _batch(rows)


_KINDS = pa.schema(
    [pa.field(f.name, pa.binary() if f.name == "block" else pa.string(), f.nullable) for f in RECORDS]
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=_KINDS)


def derived(response: dict) -> tuple[dict, dict]:
    """The metadata and the conversion record of one response record."""
    status, headers, body = split_http(response["block"])
    page = body.decode("utf-8", "replace")
    text = visible_text(page).encode()
    source = {
        "WARC-Record-ID": response["record_id"],
        "WARC-Date": response["date"],
        "WARC-Target-URI": response["target_uri"],
        "WARC-Block-Digest": response["block_digest"],
        "WARC-Payload-Digest": response["payload_digest"],
        "Content-Type": response["content_type"],
    }
    described = {
        "source": source,
        "http": {"status": status, "headers": headers},
        "html": {
            "title": title_of(page),
            "links": links_of(page),
        },
        "body_length": len(body),
        "text_length": len(text),
    }
    blocks = (
        ("metadata", "application/json", json.dumps(described, ensure_ascii=False).encode()),
        ("conversion", "text/plain; charset=utf-8", text),
    )
    return tuple(
        {
            "record_id": record_name(kind, response["record_id"]),
            "record_type": kind,
            "refers_to": response["record_id"],
            "target_uri": response["target_uri"],
            "date": response["date"],
            "content_type": content_type,
            "block_digest": digest(block),
            "payload_digest": None,
            "source_digest": response["payload_digest"],
            "block": block,
        }
        for kind, content_type, block in blocks
    )


def _derive_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [d for r in batch.to_pylist() if r["record_type"] == "response" for d in derived(r)]
        yield _batch(rows)


def responses_of(pages: DataFrame) -> DataFrame:
    """Response records of pages (``page_id``, ``url``, ``html``); other columns are ignored.

    A null page is an empty body, a null url a record without target. Control characters of a url are
    percent-encoded, as a header is one line. Ids come from page_id, url and body, so repeated rows have equal
    records, and two captures of one page have not.
    """
    rows = pages.select(F.col("page_id").cast("string"), "url", as_bytes("html").alias("body"))
    return bounded(rows).mapInArrow(_responses_task, RECORDS)


def derivatives(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of the response records; other records have none.

    A block without an HTTP head counts as body alone. Repeated responses have repeated derivatives.
    """
    return bounded(records.select(*RECORDS.names)).mapInArrow(_derive_task, RECORDS)


#: WARC headers of the columns of a record, in the order in which they are written.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "refers_to": "WARC-Refers-To",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "content_type": "Content-Type",
    "block_digest": "WARC-Block-Digest",
    "payload_digest": "WARC-Payload-Digest",
    "source_digest": "WARC-Source-Payload-Digest",
}


def write_warc(records: DataFrame, folder: str) -> None:
    """Write records as WARC files. Headers that are null are left out; control characters in their values
    are percent-encoded."""

    def value(column: str) -> Column:
        encoded = F.transform(
            F.split(F.col(column), ""),
            lambda c: F.when(
                c.rlike("^[\\x00-\\x1f\\x7f]$"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))
            ).otherwise(c),
        )
        return F.when(F.col(column).rlike("[\\x00-\\x1f\\x7f]"), F.array_join(encoded, "")).otherwise(F.col(column))

    lines = [
        F.concat(F.lit(f"{name}: "), value(column), F.lit("\r\n")) for column, name in HEADERS.items()
    ]
    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        *(F.coalesce(line, F.lit("")) for line in lines),
        F.concat(F.lit("Content-Length: "), F.length("block").cast("string"), F.lit("\r\n\r\n")),
    )
    whole = F.concat(head.cast("binary"), F.col("block")).cast("string").alias("value")
    writer = records.select(whole).write.option("lineSep", "\r\n\r\n")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def parse_warc(data: bytes) -> Iterator[dict]:
    """Records of one WARC file, by their stated lengths; digests are checked."""
    columns = {name.lower(): column for column, name in HEADERS.items()}
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        pairs = (line.partition(": ") for line in lines)
        headers = {name.lower(): value for name, _, value in pairs}
        begin = end + 4
        if not headers.get("content-length", "").isdigit():
            raise ValueError(f"the record at byte {at} has no length")
        block = data[begin : begin + int(headers["content-length"])]
        record = {column: headers.get(name) for name, column in columns.items()} | {"block": block}
        if record["block_digest"] != digest(block):
            raise ValueError(f"wrong digest of {record['record_id']}")
        yield record
        at = begin + len(block) + 4


def _parse_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            yield _batch(list(parse_warc(content.as_py())))


def read_warc(spark, folder: str) -> DataFrame:
    """Records of WARC files; each file has a bounded number of records and is read by one task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(_parse_task, RECORDS)


def page_derivatives(pages: DataFrame) -> DataFrame:
    """Derivatives of all pages, from the WARC files they were written to."""
    folder = new_folder(pages.sparkSession, "warc-derivatives")
    write_warc(derivatives(responses_of(pages)), folder)
    records = read_warc(pages.sparkSession, folder)
    return records.select(
        *(c for c in RECORDS.names if c != "block"),
        F.length("block").cast("bigint").alias("block_length"),
        F.decode("block", "UTF-8").alias("content"),
    )
