"""WARC derivatives: ``metadata`` and ``conversion`` records of responses.

A response (URL, HTTP head, HTML payload) keeps its record id and payload digest where
they are given, and else gets ones that depend on its content alone; its derivatives get
ids that depend on that id, so a repeated run links the same records.  Both refer to the response by WARC-Refers-To and carry
its target, date and payload digest on; the conversion record holds the page's
plain text, the metadata record the response's HTTP headers, title, links and
digests as warc-fields.  Digests are labelled SHA-1 in base 32.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from retainspark.llm.common import by_bytes, materialise, require

NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")
HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: WARC-Date of responses without one.
DATE = "1970-01-01T00:00:00Z"

#: Where text stops for a while, a head's title among it.  </head> may be left out, so a head
#: has no end to look for; its other tags hold no text.
_SPECIAL = re.compile(r"<!--|<(script|style|noscript|template|title)\b[^>]*>", re.I)
_CLOSING = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template")}
_TITLE_END = re.compile(r"</title\b[^>]*>", re.I)
_ANY_TAG = re.compile(r"</?[a-z]", re.I)
_BREAK = re.compile(r"</?(?:p|div|br|hr|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|aside|main|pre|"
                    r"blockquote|form|title|dl|dt|dd|figure|figcaption)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z!?][^>]*>")
_BLANKS = re.compile(r"[^\S\n]+")
_ANCHOR = re.compile(r"<a\b[^>]*>", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"[^\s>]+")
_CHARSET = re.compile(r"^content-type:[^\r\n]*?charset\s*=\s*[\"']?([\w.:-]+)", re.I | re.M)


def _closed(text: str) -> tuple[str, str]:
    """``text`` up to its last ``>``, and the rest, which holds no whole tag: in the first part the
    search for the end of a tag never fails, so a pass over it takes linear time."""
    cut = text.rfind(">") + 1
    return text[:cut], text[cut:]


def _without_tags(text: str) -> str:
    head, tail = _closed(text)
    return _TAG.sub("", head) + tail


def scan(page: str) -> tuple[str, str]:
    """The page without comments, scripts, styles and titles (a space in place of each), and
    its first title.  One pass; a title that is closed nowhere ends at the first tag, anything
    else that isn't closed takes the rest of the page."""
    head, tail = _closed(page)
    parts, at, title, end = [], 0, None, _TITLE_END.search(head)
    while m := _SPECIAL.search(head, at):
        parts += [head[at:m.start()], " "]
        name = (m[1] or "").lower()
        if name == "title":
            if end and end.start() < m.end():
                end = _TITLE_END.search(head, m.end())
            if end:
                title = head[m.end():end.start()] if title is None else title
                at = end.end()
            else:
                tag = _ANY_TAG.search(page, m.end())
                at = tag.start() if tag else len(page)
        elif name:
            close = _CLOSING[name].search(head, m.end())
            at = close.end() if close else len(page)
        else:
            close = page.find("-->", m.end())
            at = close + 3 if close >= 0 else len(page)
        if at >= len(head):
            break
    parts.append(head[at:])
    rest = tail[max(at - len(head), 0):]
    comment = rest.find("<!--")
    parts.append(rest if comment < 0 else rest[:comment] + " ")
    return "".join(parts), _one_line(html.unescape(_without_tags(title))) if title else ""


def _text(kept: str) -> str:
    head, tail = _closed(kept)
    text = _without_tags(_BREAK.sub("\n", head) + tail)
    lines = (_BLANKS.sub(" ", x).strip() for x in html.unescape(text).split("\n"))
    return "\n".join(x for x in lines if x)


def plain_text(page: str) -> str:
    """Text of a page: comments, title, scripts and styles dropped, block tags as
    line breaks, other tags removed, references resolved once, blanks squeezed,
    empty lines dropped.  A tag that is never closed is text."""
    return _text(scan(page)[0])


def links(kept: str) -> list[str]:
    """Targets of the anchors, in order; a quoted one may hold ``>``."""
    head, _ = _closed(kept)
    out, at, missing = [], 0, set()
    while m := _ANCHOR.search(head, at):
        at = m.end()
        href = _HREF.search(head, m.start(), m.end())
        if not href:
            continue
        quote, first = head[href.end():href.end() + 1], href.end()
        close = head.find(quote, first + 1) if quote in ("'", '"') and quote not in missing else -1
        if close >= 0:
            value, at = head[first + 1:close], max(at, close + 1)
        else:
            missing.update(quote if quote in ("'", '"') else ())
            bare = _BARE.match(head, first)
            if not bare:
                continue
            value = bare[0]
        out.append(_one_line(html.unescape(value)))
    return out


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(parts))}>"


def _one_line(value: str) -> str:
    """A header value cannot hold a line break."""
    return " ".join(value.split())


def serialise(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record; Content-Length is added last."""
    lines = ["WARC/1.1", *[f"{k}: {_one_line(v)}" for k, v in headers], f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers and block of the first record, and what follows it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(headers["Content-Length"])
    return headers, rest[:size], rest[size + 4:]


def _decoded(payload: bytes, http_head: str) -> str:
    """The payload by the charset that its head names, UTF-8 where it names none or an unknown one."""
    named = _CHARSET.search(http_head)
    try:
        return payload.decode(named[1] if named else "utf-8", "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive(url: str, page: str | bytes, http_head: str, date: str, source_id: str | None = None,
           source_digest: str | None = None) -> list[dict]:
    """The response's metadata and conversion records.  ``page`` as bytes is the payload as it
    came; ``source_id`` and ``source_digest`` are the response record's own id and payload
    digest, and are made from the content where they are missing."""
    payload = page.encode() if isinstance(page, str) else page
    http_head = http_head.rstrip("\r\n") + "\r\n"
    payload_digest = source_digest or digest(payload)
    response_block = http_head.encode() + b"\r\n" + payload
    source = source_id or record_id("response", url, date, payload_digest, digest(response_block))
    shared = [("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Refers-To", source),
              ("WARC-Refers-To-Target-URI", url), ("WARC-Refers-To-Date", date)]
    kept, title = scan(page if isinstance(page, str) else _decoded(page, http_head))
    text, targets = _text(kept).encode(), links(kept)
    status, *fields = http_head.splitlines()
    notes = [("sourceRecord", source), ("sourcePayloadDigest", payload_digest),
             ("sourceBlockDigest", digest(response_block)), ("sourceLength", str(len(response_block))),
             ("httpStatus", _one_line(status)), *[("httpHeader", _one_line(x)) for x in fields if x.strip()],
             ("title", title), ("conversionDigest", digest(text)), *[("outlink", x) for x in targets]]
    block = "".join(f"{k}: {v}\r\n" for k, v in notes).encode()
    out = []
    for kind, mime, data in (("metadata", "application/warc-fields", block), ("conversion", "text/plain; charset=utf-8", text)):
        own = record_id(kind, source)
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own), *shared, ("WARC-Block-Digest", digest(data)),
                   ("WARC-Payload-Digest", digest(data)), ("WARC-Source-Payload-Digest", payload_digest), ("Content-Type", mime)]
        out.append({"record_type": kind, "record_id": own, "refers_to": source, "source_payload_digest": payload_digest,
                    "block_digest": digest(data), "block_length": len(data), "n_links": len(targets),
                    "record": serialise(headers, data)})
    return out


ADDED = {"record_type": pa.string(), "record_id": pa.string(), "refers_to": pa.string(),
         "source_payload_digest": pa.string(), "block_digest": pa.string(), "block_length": pa.int64(),
         "n_links": pa.int64(), "record": pa.binary()}


def derivatives(pages: DataFrame, url_col: str = "url", html_col: str = "html", http_col: str | None = None,
                date_col: str | None = None, keep: list[str] | None = None, id_col: str | None = None,
                digest_col: str | None = None) -> DataFrame:
    """Two rows per response: ``pages`` (or its columns ``keep``) with the columns
    of ``ADDED``; ``record`` holds the whole serialised record.  Input columns of
    these names are replaced.

    A binary ``html_col`` is the payload as it came: its digest is that of the bytes, and its text
    is read by the charset of the HTTP head.  ``id_col`` and ``digest_col`` name the source
    records' own ids and payload digests, which are carried on unchanged; without them, and where
    they are null or empty, both are made from the content.

    A page is read in one pass that takes linear time and memory whatever its tags
    look like, so very long and malformed pages are whole.  Null URLs, pages and HTTP heads count as empty (``HEAD`` where no column is
    named), null dates as ``DATE``.  An empty page gives a conversion record with
    an empty block.  Equal responses have equal records; rows are not merged.  An
    empty table gives an empty result."""
    require(pages, [c for c in (url_col, html_col, http_col, date_col, id_col, digest_col) if c])
    rest = [c for c in (pages.columns if keep is None else keep) if c not in ADDED]
    text = lambda c, none: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c else F.lit(none)
    date = F.coalesce(F.col(f"`{date_col}`").cast("string"), F.lit(DATE)) if date_col else F.lit(DATE)
    raw = pages.schema[html_col].dataType.simpleString() == "binary"
    body = F.coalesce(F.col(f"`{html_col}`"), F.lit(b"")) if raw else text(html_col, "").cast("binary")
    rows = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], text(url_col, ""),
                        body, text(http_col, HEAD), date, text(id_col, ""), text(digest_col, ""))
    n = len(rest)
    rows = rows.toDF(*[f"c{i}" for i in range(n)], "url", "html", "http", "date", "source", "digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(batches, n + 1):
            cells = zip(*(b.column(n + k).to_pylist() for k in range(6)), strict=True)
            found = [r for u, x, h, d, s, p in cells for r in derive(u, x if raw else x.decode(), h, d, s, p)]
            twice = pa.array([i for i in range(b.num_rows) for _ in range(2)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i).take(twice) for i in range(n)], *[pa.array([r[c] for r in found], k) for c, k in ADDED.items()]],
                names=[*[f"c{i}" for i in range(n)], *ADDED])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    schema = ", ".join([*[f"c{i} {kinds[c]}" for i, c in enumerate(rest)], "record_type string, record_id string, refers_to "
                        "string, source_payload_digest string, block_digest string, block_length long, n_links long, record binary"])
    return rows.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(rest)], *ADDED)


def write_files(records: DataFrame, folder: str) -> DataFrame:
    """Write ``record`` cells to ``.warc.gz`` files below ``folder``, one per
    partition and a gzip member per record; returns ``(file, records)``.  A file
    appears when complete; empty partitions write none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        task = TaskContext.get()
        name = f"part-{task.partitionId():08d}.warc.gz"
        store.create_dir(path, recursive=True)
        draft, count = f"{path}/.{name}.{task.taskAttemptId()}", 0
        with store.open_output_stream(draft, compression=None) as out:
            for b in batches:
                for r in b.column(0).to_pylist():
                    out.write(gzip.compress(r, mtime=0))
                    count += 1
        if count:
            store.move(draft, f"{path}/{name}")
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [count]})
        else:
            store.delete_file(draft)

    return materialise(records.select("record").mapInArrow(run, "file string, records long"), "warc-files")
