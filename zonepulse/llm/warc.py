"""WARC derivatives: a metadata and a plain-text conversion record for every response.

Both records name the response they come from in WARC-Refers-To and repeat its target, date, payload digest and headers in
fields of their own (Source-Payload-Digest, Source-Header-...). The metadata record's block lists the source's headers and sizes and links to
the conversion record; the conversion record's block is the text.
Identifiers are derived from content, so a task that runs again writes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.arrays import slices, small_batches

VERSION = "WARC/1.1"
#: Parts lines of text while tags are taken out.
LINE = "\0"
#: Markup that leaves no text, and tags that end a line of text.
OPENER = re.compile(r"(?i)<!--|<(script|style|noscript|template|head)\b")
CLOSERS = {kind: re.compile(rf"(?i)</{kind}\s*>") for kind in ("script", "style", "noscript", "template", "head")} | {"": re.compile("-->")}
BREAK = re.compile(r"(?i)</?(?:p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|article|section|header|footer|nav|aside|blockquote|pre|form|hr|title|body|html)\b[^<>]*>")
#: What cannot stand in the name of a field.
FIELD = re.compile(r"[^A-Za-z0-9_-]")
TAG = re.compile(r"<[a-zA-Z/!?][^<>]*>")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(map(str, parts)))}>"


def without_dropped(markup: str) -> str:
    """The markup without comments, and with line signs for scripts and the like; an opener that nothing closes stays, as a tag like others.

    Each closer is looked for from where the last one ended, and no more once there is none, so time is linear in the page.
    """
    out, kept, at, missing = [], 0, 0, set()
    while found := OPENER.search(markup, at):
        at, kind = found.end(), (found[1] or "").lower()
        end = None if kind in missing else CLOSERS[kind].search(markup, at)
        if end:
            out += [markup[kept : found.start()], LINE if kind else ""]
            kept = at = end.end()
        else:
            missing.add(kind)
    return "".join([*out, markup[kept:]])


def plain_text(markup: str) -> str:
    """All text of a page, one line per block, white space within lines (line ends of the source too) as single spaces."""
    bare = TAG.sub("", BREAK.sub(LINE, without_dropped(markup.replace(LINE, " "))))
    lines = (" ".join(x.split()) for x in html.unescape(bare).split(LINE))
    return "\n".join(x for x in lines if x)


def header_block(fields: list[tuple[str, str]]) -> bytes:
    clean = ((k, v.replace("\r", " ").replace("\n", " ")) for k, v in fields)
    return "".join([VERSION, "\r\n", *(f"{k}: {v}\r\n" for k, v in clean), "\r\n"]).encode("utf-8", "surrogatepass")


def record(kind: str, own: str, source: dict, content_type: str, block: bytes) -> bytes:
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source["record_id"]), ("WARC-Target-URI", source["uri"]),
        ("WARC-Date", source["date"]), ("WARC-Block-Digest", digest(block)), ("Source-Payload-Digest", source["payload_digest"]),
        *((f"Source-Header-{FIELD.sub('-', k)}", v) for k, v in source["headers"]), ("Content-Type", content_type), ("Content-Length", str(len(block))),
    ]
    return header_block(fields) + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, rest = raw.split(b"\r\n\r\n", 1)
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    return fields, rest[: int(fields["Content-Length"])]


def derive(source: dict) -> tuple[bytes, bytes]:
    """The metadata and the conversion record of a response given as record_id, uri, date, headers, payload, payload_digest."""
    text = plain_text(source["payload"].decode("utf-8", "replace")).encode()
    to_text, to_meta = record_id("conversion", source["record_id"]), record_id("metadata", source["record_id"])
    fields = [
        ("source-payload-digest", source["payload_digest"]), ("source-content-length", str(len(source["payload"]))),
        ("conversion-record-id", to_text), ("conversion-payload-digest", digest(text)), ("conversion-length", str(len(text))),
        *((f"source-header-{FIELD.sub('-', k).lower()}", v.replace("\r", " ").replace("\n", " ")) for k, v in source["headers"]),
    ]
    meta = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    return record("metadata", to_meta, source, "application/warc-fields", meta), record("conversion", to_text, source, "text/plain; charset=utf-8", text)


def responses(pages: DataFrame, date: str) -> DataFrame:
    """Pages (page_id, url, html) as responses (page_id, record_id, uri, date, headers, payload, payload_digest)."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                ids, urls = part.column("page_id").to_pylist(), [u or "" for u in part.column("url").to_pylist()]
                payload = [(h or "").encode("utf-8", "surrogatepass") for h in part.column("html").to_pylist()]
                digests = [digest(p) for p in payload]
                heads = [[("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(p)))] for p in payload]
                names = [record_id("response", i, u, d) for i, u, d in zip(ids, urls, digests, strict=True)]
                pairs = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array(names), pa.array(urls, pa.string()), pa.array([date] * len(ids)), pa.array([[{"name": k, "value": v} for k, v in h] for h in heads], pairs), pa.array(payload, pa.binary()), pa.array(digests)],
                    names=["page_id", "record_id", "uri", "date", "headers", "payload", "payload_digest"],
                )

    bare = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return bare.mapInArrow(run, "page_id long, record_id string, uri string, date string, headers array<struct<name:string,value:string>>, payload binary, payload_digest string")


FIELDS = "page_id long, record_type string, record_id string, refers_to string, target_uri string, source_digest string, block_digest string, content_length long, n_chars long"


def derivatives(found: DataFrame, keep_records: bool = True) -> DataFrame:
    """Two rows per response: its metadata and its conversion record, with the serialised ``record`` if kept.

    A null or empty payload gives an empty conversion block and a full metadata record; null urls are empty targets; repeated
    responses repeat their records, identifiers included; other columns are ignored. n_chars counts the code points of
    the block.
    """
    small_batches(found.sparkSession)
    fields = FIELDS + ", record binary" * keep_records

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "record_id", "uri", "date", "headers", "payload", "payload_digest"]
        for batch in batches:
            for part in slices(batch, "payload"):
                rows = []
                for x in part.select(names).to_pylist():
                    source = x | {"payload": x["payload"] or b"", "headers": [(h["name"] or "", h["value"] or "") for h in x["headers"] or []]}
                    source |= {"uri": x["uri"] or "", "date": x["date"] or "", "payload_digest": x["payload_digest"] or digest(source["payload"])}
                    for raw in derive(source):
                        head, block = parse(raw)
                        row = [x["page_id"], head["WARC-Type"], head["WARC-Record-ID"], head["WARC-Refers-To"], head["WARC-Target-URI"], head["Source-Payload-Digest"], head["WARC-Block-Digest"], len(block), len(block.decode())]
                        rows.append([*row, raw] if keep_records else row)
                kinds = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=[f.split()[0] for f in fields.split(", ")])

    return found.mapInArrow(run, fields)
