"""WARC derivatives: from response records, the metadata and plain-text conversion records that refer to them.

Records follow WARC/1.1. A derivative keeps the response's id in ``WARC-Refers-To``, its target, its date and its payload
digest; the metadata record lists the source's HTTP headers, the title and the outlinks, and the conversion record holds the
text. All ids are named from the content, so a task that runs again writes the same records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import spread

_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace
_BLOCKS = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul title option".split())
_SILENT = frozenset("script style noscript template svg head".split())
_LINKS = frozenset(("a", "area"))
#: Bytes of records and texts that a worker hands over at once.
BATCH_BYTES = 2 << 20
_TAG_SPACE, _ATTR_NAME = r"[ \t\n\r\f]", r"[a-zA-Z][-a-zA-Z0-9_:.]*+"
#: The text before a tag, and the tag if it is plain: letters and digits in its name, attributes that are bare or have a value in
#: quotes or without odd characters, no slash at the end. The standard library's parser reads these alike.
_PLAIN = re.compile(rf"""([^<]*+)<(?:/([a-zA-Z][a-zA-Z0-9]*+)|([a-zA-Z][a-zA-Z0-9]*+)((?:{_TAG_SPACE}++{_ATTR_NAME}(?:=(?:"[^"]*+"|'[^']*+'|[^\s"'<>=`]++))?+)*+)){_TAG_SPACE}*+>""")
_ATTRIBUTES = re.compile(rf"""{_TAG_SPACE}++({_ATTR_NAME})(?:=(?:"([^"]*+)"|'([^']*+)'|([^\s"'<>=`]++)))?+""")
_CDATA_ENDS = {x: re.compile(rf"</\s*{x}\s*>", re.I | re.A) for x in HTMLParser.CDATA_CONTENT_ELEMENTS}
#: A link from the root whose segments are neither dots nor empty, without parameters, query or fragment.
_ROOTED = re.compile(r"(?:/(?!\.{1,2}(?:/|\Z))[^\x00-\x20/?#;]++)++")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, chr(0).join(parts))}>"


def build_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record; a line break within a value becomes a space, so that no value ends its header."""
    lines = ["WARC/1.1", *(f"{k}: {' '.join(v.split())}" for k, v in [*headers, ("Content-Length", str(len(block)))])]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(headers, block) of each record of a file, plain or of gzip members; ends at what isn't a whole record.

    Members are unpacked as they are read, so no more than one record is held beside the file's own bytes.
    """
    raw = io.BytesIO(data)
    file = gzip.GzipFile(fileobj=raw) if data[:2] == b"\x1f\x8b" else raw
    while True:
        try:
            line = file.readline()
            while line in (b"\r\n", b"\n"):  # the two line ends after a block
                line = file.readline()
            if not line.startswith(b"WARC/"):
                return
            headers = []
            while (line := file.readline()) not in (b"\r\n", b"\n", b""):
                k, _, v = line.decode("utf-8", "surrogateescape").partition(":")
                headers.append((k.strip(), v.strip()))
            size = int(dict((k.lower(), v) for k, v in headers).get("content-length", "0"))
            block = file.read(size) if size >= 0 else b""
        except (EOFError, OSError, ValueError, zlib.error):  # a member or a length that is broken
            return
        if not line or len(block) < size:
            return
        yield headers, block


def response_record(key: str, url: str, payload: bytes, date: str, http_headers: list[tuple[str, str]]) -> bytes:
    head = "HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*http_headers, ("Content-Length", str(len(payload)))]) + "\r\n"
    block = head.encode() + payload
    own = digest(payload)
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key, url, own)), ("WARC-Date", date), ("WARC-Target-URI", url)]
    return build_record([*headers, ("WARC-Payload-Digest", own), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response")], block)


class _Page(HTMLParser):
    """Collects text, title and links. What stands in a silent element is dropped when that ends, or when the body begins;
    an element that never ends silences nothing, scripts and styles apart.

    ``feed`` takes a whole page, once. Plain tags are read here, one match each; the parser's own methods read all else.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.links, self.title, self.open, self.in_title = [], [], [], [], False

    def feed(self, data):
        self.rawdata, i, unescape = data, 0, entities.unescape
        while True:
            if m := _PLAIN.match(data, i):
                text, end, tag, attrs = m.groups()
                if text:
                    self.handle_data(unescape(text))
                i = m.end()
                if end:
                    self.handle_endtag(end.lower())
                    continue
                tag = tag.lower()
                self.handle_starttag(tag, [(k.lower(), unescape(a or b or c)) for k, a, b, c in _ATTRIBUTES.findall(attrs)] if attrs and tag in _LINKS else ())
                if tag not in _CDATA_ENDS:
                    continue
            else:
                start = data.find("<", i)
                if text := data[i:] if start < 0 else data[i:start]:
                    self.handle_data(unescape(text))
                i = -1 if start < 0 else self._odd(data, start)
                if i < 0:  # the end, or what isn't whole: the parser decides what becomes of the rest
                    self.rawdata = ""
                    return super().feed(data[start:]) if start >= 0 else None
                if not (tag := self.cdata_elem):
                    continue
                self.clear_cdata_mode()
            end = _CDATA_ENDS[tag].search(data, i)
            if not end:
                self.rawdata = ""
                self.set_cdata_mode(tag)
                return super().feed(data[i:])
            self.handle_data(data[i : end.start()])
            self.handle_endtag(tag)
            i = end.end()

    def _odd(self, data: str, i: int) -> int:
        """Where the markup that begins at ``i`` ends, -1 if it doesn't: the same choice as the parser's own."""
        if data[i + 1 : i + 2].isascii() and data[i + 1 : i + 2].isalpha():
            return self.parse_starttag(i)
        if data.startswith("</", i):
            return self.parse_endtag(i)
        if data.startswith("<!--", i):
            return self.parse_comment(i)
        if data.startswith("<?", i):
            return self.parse_pi(i)
        if data.startswith("<!", i):
            return self.parse_html_declaration(i)
        if i + 1 == len(data):
            return -1
        self.handle_data("<")
        return i + 1

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.open:  # the head's end tag may be missing
            del self.parts[self.open[0][1] :]
            self.open = []
        if tag in _SILENT:
            self.open.append((tag, len(self.parts)))
        if tag == "title":
            self.in_title = True
        if tag in _BLOCKS:
            self.parts.append("\n")
        if tag in _LINKS and (href := dict(attrs).get("href")):
            self.links.append(href)

    def handle_startendtag(self, tag, attrs):
        if tag not in _SILENT:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        at = max((i for i, (name, _) in enumerate(self.open) if name == tag), default=None) if self.open else None
        if at is not None:
            del self.parts[self.open[at][1] :]
            del self.open[at:]
        if tag == "title":
            self.in_title = False
        if tag in _BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data):
        (self.title if self.in_title else self.parts).append(data)

    def close(self):
        super().close()
        for name, start in self.open:
            if name in ("script", "style"):
                del self.parts[start:]
                break


def page_text(html: str, url: str = "") -> tuple[str, str, list[str]]:
    """(text, title, links) of a page: a line for each block, single spaces, no scripts, styles or head; links are whole."""
    page = _Page()
    try:
        page.feed(html)
        page.close()
        raw = "".join(page.parts)
    except (AssertionError, ValueError):  # markup that the parser gives up on
        raw = entities.unescape(re.sub(r"<[^>]*>", " ", html))
    lines = (" ".join(x.split()) for x in raw.split("\n") if x)
    return "\n".join(x for x in lines if x), " ".join("".join(page.title).split()), _whole_links(url, page.links)


def _whole_links(url: str, found: list[str]) -> list[str]:
    """Distinct links as ``urljoin`` completes them; those that it can't read stay as they are."""
    links, root = {}, None
    for x in dict.fromkeys(x.strip() for x in found):
        try:
            if _ROOTED.fullmatch(x):  # all that stands before such links is alike
                if root is None:
                    root = urljoin(url, "/")
                x = root + x[1:]
            else:
                x = urljoin(url, x)
        except ValueError:
            pass
        links[x] = None
    return list(links)


def _charset(http: list[tuple[str, str]]) -> str:
    found = re.search(r"charset=\"?([\w.:-]+)", dict((k.lower(), v) for k, v in http).get("content-type", ""))
    try:
        "".encode(found[1]) if found else None
    except LookupError:
        found = None
    return found[1] if found else "utf-8"


def derive(record: bytes) -> list[dict]:
    """The metadata and the conversion record of every response in ``record``, with what they say as fields."""
    out = []
    for headers, block in parse_records(record):
        h = {k.lower(): v for k, v in headers}
        if h.get("warc-type") != "response":
            continue
        head, _, payload = block.partition(b"\r\n\r\n")
        status, *lines = head.decode("latin-1").split("\r\n")
        http = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)]
        source, url, payload_digest = h.get("warc-record-id", ""), h.get("warc-target-uri", ""), digest(payload)
        text, title, links = page_text(payload.decode(_charset(http), "replace"), url)
        fields = [("source-status", status), *((f"source-header-{k.lower()}", v) for k, v in http), ("title", title), *(("outlink", x) for x in links)]
        meta = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
        for kind, body, mime in (("metadata", meta, "application/warc-fields"), ("conversion", text.encode("utf-8", "surrogatepass"), "text/plain; charset=UTF-8")):
            own, block_digest = record_id(kind, source, payload_digest), digest(body)
            common = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source), ("WARC-Date", h.get("warc-date", "")), ("WARC-Target-URI", url)]
            whole = build_record([*common, ("WARC-Source-Payload-Digest", payload_digest), ("WARC-Block-Digest", block_digest), ("Content-Type", mime)], body)
            intact = h.get("warc-payload-digest", payload_digest) == payload_digest
            out.append({"record_type": kind, "record_id": own, "refers_to": source, "target_uri": url, "date": h.get("warc-date", ""), "source_digest": payload_digest, "source_intact": intact, "block_digest": block_digest, "content_length": len(body), "n_links": len(links), "body": body.decode("utf-8", "replace"), "record": whole})
    return out


_HTTP = [("Content-Type", "text/html; charset=UTF-8")]
_FIELDS = pa.schema([("page_id", pa.int64()), *[(n, pa.string()) for n in ("record_type", "record_id", "refers_to", "target_uri", "date", "source_digest")], ("source_intact", pa.bool_()), ("block_digest", pa.string()), ("content_length", pa.int64()), ("n_links", pa.int64()), ("body", pa.string()), ("record", pa.binary())])
_RESPONSE = pa.schema([("page_id", pa.int64()), ("record", pa.binary())])
_KINDS = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean", pa.binary(): "binary"}
_DDL = ", ".join(f"{f.name} {_KINDS[f.type]}" for f in _FIELDS)


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches that hold about ``BATCH_BYTES`` each, or one row that is longer."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["record"]) + len(row.get("body", "")) + 400
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _page_responses(batch: pa.RecordBatch, date: str) -> Iterator[tuple[int | None, bytes]]:
    for i, u, x in zip(*batch.columns, strict=True):
        key = i.as_py()
        yield key, response_record("" if key is None else str(key), u.as_py() or "", (x.as_py() or "").encode("utf-8", "surrogatepass"), date, _HTTP)


def _narrow(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    return spread(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")))


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, record``: every page as a response record.

    Null and empty pages have an empty payload, null addresses are empty, null ids are empty in the record's name. Pages of
    any length are one record; repeated rows give equal records; an empty table gives an empty result; other columns, of
    whatever name, are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(({"page_id": i, "record": r} for b in batches for i, r in _page_responses(b, date)), _RESPONSE)

    return _narrow(pages, id_col, url_col, html_col).mapInArrow(run, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows, metadata and conversion, for every response in the ``record`` of (page_id, record).

    ``source_intact`` tells whether the payload has the digest that its response names. Null, empty and broken records and
    those of other types give no row; records of any length are read whole; repeated responses give equal records; an empty
    table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(({"page_id": i.as_py(), **d} for b in batches for i, r in zip(*b.columns, strict=True) for d in derive(r.as_py() or b"")), _FIELDS)

    return records.select("page_id", "record").mapInArrow(run, _DDL)


def page_derivatives(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``derivatives(responses(pages))`` in one pass: a task has one Python worker, and no record travels between two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(({"page_id": i, **d} for b in batches for i, r in _page_responses(b, date) for d in derive(r)), _FIELDS)

    return _narrow(pages, id_col, url_col, html_col).mapInArrow(run, _DDL)


def write_warc(records: DataFrame, folder: str) -> int:
    """Write the ``record`` column as one .warc.gz file a task, a gzip member a record, into a folder that all executors mount.

    A task writes under a name of its own and renames the file when it is whole, so a repeated task leaves one file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        target = os.path.join(folder, f"part-{task.partitionId():06d}.warc.gz")
        own, n = f"{target}.{task.taskAttemptId()}", 0
        with open(own, "wb") as f:
            for b in batches:
                for r in b.column(0):
                    if r.is_valid:
                        member = io.BytesIO()
                        with gzip.GzipFile(fileobj=member, mode="wb", mtime=0) as z:
                            z.write(r.as_py())
                        f.write(member.getvalue())
                        n += 1
        os.replace(own, target)
        yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    os.makedirs(folder, exist_ok=True)
    return int(records.select("record").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id`` (null) and ``record`` of every record in .warc and .warc.gz files, through Spark's own file reader."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for b in batches:
            for raw in b.column(0):
                for headers, block in parse_records(raw.as_py()):
                    yield {"page_id": None, "record": build_record([x for x in headers if x[0].lower() != "content-length"], block)}

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda batches: _batches(records(batches), _RESPONSE), "page_id long, record binary")
