"""Legacy archive converter: ARC files to WARC files, and readers of both.

Method: an ARC file opens with a ``filedesc:`` record whose body names the
version and the fields of a URL record line.  Version 1 lines have five fields
(URL, IP address, date, content type, length), version 2 lines ten (with result
code, checksum, location, offset and file name).  Each record's body is cut by
its declared length; from it the equivalent WARC record is synthesised: a
repeatable identifier (UUID5 of URL, date and content), an ISO timestamp, the
record type (warcinfo, response, resource or revisit) and SHA-256 digests of
block and payload.

Archives are gzip files with one member per record, written by the executors
into the shared folder through ``pyarrow.fs`` under a name of their own; only
the names in the returned manifest (a table Spark commits) count, so a retried
or speculative task leaves at most an unused file behind.

Defined cases: a null payload is the empty one; a null or blank URL becomes
``urn:page:<id>``, spaces in a URL are percent-encoded; duplicate ids each give
a record; a null id is kept as null; empty tables give no archive; a record
whose declared length runs past the file raises ``ValueError``.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written

#: Field names of URL record lines by version of the ARC format (fixed values of that format).
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Record:
    """One record of either format: header fields in order, and the block."""

    headers: dict[str, str]
    block: bytes = b""
    version: int = field(default=0)

    def payload(self) -> bytes:
        """The block behind its HTTP header, or the whole block where there is none."""
        if self.block.startswith(b"HTTP/"):
            return self.block.partition(b"\r\n\r\n")[2]
        return self.block

    def http(self) -> dict[str, str]:
        """HTTP header fields of the block, names in lower case."""
        if not self.block.startswith(b"HTTP/"):
            return {}
        lines = self.block.partition(b"\r\n\r\n")[0].decode("latin-1").split("\r\n")[1:]
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def write_arc(records: Iterable[tuple[str, str, str, str, bytes]], version: int, name: str = "legacy.arc") -> bytes:
    """An ARC file of (url, ip, 14-digit date, content type, body) records."""
    desc = f"{version} 0 arqueo\n{' '.join(FIELDS[version])}\n".encode()
    out, date = io.BytesIO(), "20000101000000"

    def put(url: str, ip: str, at: str, kind: str, body: bytes) -> None:
        line = [url, ip, at, kind] + (["200", "-", "-", str(out.tell()), name] if version == 2 else []) + [str(len(body))]
        out.write(" ".join(line).encode() + b"\n" + body + b"\n")

    put(f"filedesc://{name}", "0.0.0.0", date, "text/plain", desc)
    for url, ip, at, kind, body in records:
        put(url.replace("%", "%25").replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D"), ip, at, kind, body)
    return out.getvalue()


def read_arc(data: bytes) -> Iterator[Record]:
    """Records of an ARC file; the field names come from the file's own version block."""
    at, names, version = 0, FIELDS[1], 1
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"no end of the record line at {at}")
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if line.startswith("filedesc:"):
            # its own line has the fields of its version: five or ten
            count = len(line.split(" "))
            names = FIELDS[2] if count == len(FIELDS[2]) else FIELDS[1]
        parts = line.split(" ")
        if len(parts) < len(names):
            raise ValueError(f"{len(parts)} fields where version {version} has {len(names)}: {line[:200]!r}")
        if len(parts) > len(names):  # blanks inside the content type or the URL
            parts = [parts[0], *parts[1:3], " ".join(parts[3:len(parts) - len(names) + 4]), *parts[len(parts) - len(names) + 4:]]
        headers = dict(zip(names, parts))
        size = int(headers["Archive-length"])
        block = data[end + 1:end + 1 + size]
        if len(block) < size:
            raise ValueError(f"declared length {size} at {at} runs past the end of the file")
        at = end + 1 + size
        if line.startswith("filedesc:"):
            rows = block.decode("utf-8", "replace").split("\n")
            version = int(rows[0].split(" ")[0])
            names = rows[1].strip().split(" ") if len(rows) > 1 and rows[1].strip() else FIELDS[version]
        yield Record(headers, block, version)


def timestamp(date: str) -> str:
    """14-digit date (shorter ones padded) as the ISO form of WARC."""
    d = (date + "00000101000000"[len(date):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def to_warc(record: Record) -> Record:
    """The WARC record equivalent to an ARC record."""
    url, block = record.headers["URL"], record.block
    payload = record.payload()
    digest = hashlib.sha256(payload).hexdigest()
    http = record.http()
    if url.startswith("filedesc:"):
        kind, content = "warcinfo", "application/warc-fields"
        block = f"software: arqueo\r\nformat: WARC File Format 1.1\r\noriginal-arc-version: {record.version}\r\n".encode()
    elif not block.startswith(b"HTTP/"):
        kind, content = "resource", record.headers["Content-type"]
    elif "x-refers-to" in http:
        kind, content, digest = "revisit", "application/http; msgtype=response", http["x-payload-sha256"]
    else:
        kind, content = "response", "application/http; msgtype=response"
    date = timestamp(record.headers["Archive-date"])
    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {date} {kind} {digest}')}>", "WARC-Date": date}
    if kind == "warcinfo":
        headers["WARC-Filename"] = url.partition("://")[2] + ".warc.gz"
    else:
        headers |= {"WARC-Target-URI": url, "WARC-IP-Address": record.headers["IP-address"], "WARC-Payload-Digest": f"sha256:{digest}"}
    if kind == "revisit":
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": f"<urn:page:{http['x-refers-to']}>"}
    headers |= {"WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type": content, "Content-Length": str(len(block))}
    return Record(headers, block)


def warc_member(record: Record) -> bytes:
    """A WARC record as one gzip member (no time stamp: the same record gives the same bytes)."""
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in record.headers.items()) + "\r\n"
    return gzip.compress(head.encode() + record.block + b"\r\n\r\n", compresslevel=1, mtime=0)


def read_warc(stream) -> Iterator[Record]:
    """Records of an open, unzipped WARC stream, one at a time; a block's digest must be the declared one."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            k, _, v = line.decode("utf-8").partition(":")
            headers[k.strip()] = v.strip()
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"declared length {size} runs past the end of the file")
        if (want := headers.get("WARC-Block-Digest")) and want != f"sha256:{hashlib.sha256(block).hexdigest()}":
            raise ValueError(f"wrong block digest in {headers.get('WARC-Record-ID')}")
        yield Record(headers, block)


def http_block(body: bytes, page_id, refers_to=None, digest: str = "") -> bytes:
    """HTTP response with the body, or for a revisit its header alone (full length and digest kept there)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\nX-Page-Id: {'' if page_id is None else page_id}\r\n"
    if refers_to is not None:
        return (head + f"X-Refers-To: {refers_to}\r\nX-Payload-Sha256: {digest}\r\n\r\n").encode()
    return head.encode() + b"\r\n" + body


def mark_revisits(pages: DataFrame, least_bytes: int = 100, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` as (page_id, url, payload, payload_digest, refers_to): refers_to is set where an equal payload of at
    least ``least_bytes`` has a smaller id.

    Digests that occur once are dropped before the join; the rest is a written table of (digest, smallest id), so both
    sides of the join come straight from their exchange and a hot payload's rows can be split among tasks.
    """
    p = pages.select(F.col(id_col).alias("page_id"), F.col("url").cast("string").alias("url"),
                     F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8").alias("payload"))
    p = p.withColumn("payload_digest", F.sha2("payload", 256))
    large = F.octet_length("payload") >= least_bytes
    first = (p.where(large).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
             .where("n > 1 AND first IS NOT NULL").select("payload_digest", "first"))
    out = p.join(written(first, "payloads"), "payload_digest", "left")
    refers = F.when(large & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))), F.col("first"))
    return out.select("page_id", "url", "payload", "payload_digest", refers.alias("refers_to"))


def write_archives(marked: DataFrame, folder: str, records_per_archive: int = 2_000, date: str = "20240101000000") -> DataFrame:
    """Write rows of :func:`mark_revisits` as archives; the manifest (path, records), written as a table.

    Each batch of rows becomes an ARC file (even batches version 1, odd ones version 2) that is parsed and converted
    record by record; an archive takes ``records_per_archive`` records at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        store.create_dir(root, recursive=True)
        for k, pdf in enumerate(batches):
            for lo in range(0, len(pdf), records_per_archive):
                part = pdf.iloc[lo:lo + records_per_archive]
                rows = []
                for page, url, payload, digest, refers in part.itertuples(index=False):
                    url = url if isinstance(url, str) and url.strip() else f"urn:page:{page}"
                    rows.append((url, "0.0.0.0", date, "text/html", http_block(payload, page, refers, digest)))
                path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                with store.open_output_stream(path, compression=None) as out:
                    for record in read_arc(write_arc(rows, 1 + k % 2)):
                        out.write(warc_member(to_warc(record)))
                yield pd.DataFrame({"path": [path], "records": [len(rows)]})

    # ids go through pandas as text: a column of integers with a null would be one of floats
    ids = {c: F.col(c).cast("string") for c in ("page_id", "refers_to")}
    rows = marked.withColumns(ids).select("page_id", "url", "payload", "payload_digest", "refers_to")
    return written(rows.mapInPandas(run, "path string, records bigint"), "manifest")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Rows of the page records in the archives: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    ``payloads``: with the stored payload as well (null for revisits).  The payload digest of a response is computed
    from its block and must equal the declared one.
    """

    def rows(path: str, store) -> Iterator[tuple]:
        with store.open_input_stream(path, compression=None) as raw, gzip.open(raw) as stream:
            for r in read_warc(io.BufferedReader(stream)):
                kind = r.headers["WARC-Type"]
                if kind == "warcinfo":
                    continue
                http, payload = r.http(), r.payload()
                digest = r.headers["WARC-Payload-Digest"].partition(":")[2]
                if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"wrong payload digest in {r.headers['WARC-Record-ID']}")
                refers = r.headers.get("WARC-Refers-To", "").removeprefix("<urn:page:").rstrip(">")
                url = r.headers["WARC-Target-URI"].replace("%0D", "\r").replace("%0A", "\n").replace("%20", " ").replace("%25", "%")
                yield (http["x-page-id"] or None, url, int(http["content-length"]), digest, kind, refers or None,
                       payload if payloads and kind == "response" else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        for pdf in batches:
            for path in pdf["path"]:
                yield pd.DataFrame(list(rows(path, store)), columns=names)

    schema = "page_id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"
    n = max(manifest.sparkSession.sparkContext.defaultParallelism, 1)
    out = manifest.select("path").repartition(n * 4, "path").mapInPandas(run, schema)
    out = out.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")})
    return out if payloads else out.drop("payload")


def convert_pages(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Pages through ARC to WARC archives in the shared folder, read back."""
    folder = scratch(pages.sparkSession, "warc")
    return read_archives(write_archives(mark_revisits(pages), folder), folder, payloads)
