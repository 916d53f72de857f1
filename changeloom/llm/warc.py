"""WARC archives of pages, found again through an index.

Writing: one file per task, every record compressed by itself, named by a new random name, so that a task that is
run again never touches a file that counts. What a task writes it also lists: file, offset, length, URL
and digest of every record. The index is the list of the tasks that succeeded.

Reading: the wanted rows of the index are dealt by stretches of files, put in order, and neighbouring
byte ranges are read in one go. Nothing is read but the ranges of wanted records.

Pages with equal payloads of at least ``LEAST_REVISIT`` bytes are stored once: the one with the smallest id
is a response, the others are revisits that name it.

Files go through Arrow's file systems, so the folder may be in any store that they know by its URI.

Defined cases: a null html is an empty payload; a null url an empty one, line ends in it are spelt %0D and %0A.
A page without id is a response. Rows that repeat the smallest id are responses all. Other columns are
ignored; an empty table gives empty archives.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ..sources.workspace import workspace, written

LEAST_REVISIT = 100
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_DDL = "page_id long, file string, offset long, length long, url string, digest string, record_type string, refers_to long"


def _record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One record, compressed as a gzip member."""
    name = "none" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    press = zlib.compressobj(1, zlib.DEFLATED, 31)
    return press.compress("\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n") + press.flush()


def parsed(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, headers of the HTTP message, and what follows those."""
    text = zlib.decompress(raw, 31)
    head, _, rest = text.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record at this place")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    http, _, body = rest[: int(headers["Content-Length"])].partition(b"\r\n\r\n")
    return headers, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), body


def revisits(pages: DataFrame) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages whose payload one with a smaller id has."""
    rows = pages.filter(f"payload_bytes >= {LEAST_REVISIT} and page_id is not null").select("page_id", "digest")
    first = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).filter("refers_to < last")
    return rows.join(first.drop("last"), "digest").filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the archives of ``pages(page_id, url, html)`` and returns their index."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", "url", "html", F.sha2(payload.cast("binary"), 256).alias("digest"), F.octet_length(payload).alias("payload_bytes")
    )
    rows = rows.join(revisits(rows), ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "refers_to")

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        system.create_dir(root, recursive=True)
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        try:
            for batch in batches:
                offsets, lengths, types, urls = [], [], [], []
                for lo in range(0, batch.num_rows, 256):
                    for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns)):
                        url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
                        raw = _record(page_id, url, (html or "").encode(), digest, refers_to)
                        out = out or system.open_output_stream(f"{root}/{name}", compression=None)
                        out.write(raw)
                        offsets.append(at)
                        lengths.append(len(raw))
                        urls.append(url)
                        types.append("response" if refers_to is None else "revisit")
                        at += len(raw)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array([f"{folder}/{name}"] * batch.num_rows, pa.string()), pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.int64()), pa.array(urls, pa.string()), batch.column(3), pa.array(types, pa.string()), batch.column(4),
                    ],
                    names=["page_id", "file", "offset", "length", "url", "digest", "record_type", "refers_to"],
                )
        finally:
            if out is not None:
                out.close()

    return written(rows.mapInArrow(store, INDEX_DDL), "warc-index")


def ranges(offset: np.ndarray, length: np.ndarray, gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int]]:
    """Runs ``(first, end)`` of records in order of offset that are read in one go."""
    out, first = [], 0
    for k in range(1, len(offset) + 1):
        if k == len(offset) or offset[k] - (offset[k - 1] + length[k - 1]) > gap or offset[k] + length[k] - offset[first] > most:
            out.append((first, k))
            first = k
    return out


def read(index: DataFrame) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload`` of the records in the index.

    The payload of a response and its digest are what was read; a revisit has no payload of its own,
    its digest and size are those of the headers that it repeats.
    """

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, source = None, None
        for batch in batches:
            files, offset, length = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            edges = [k for k in range(len(files)) if k == 0 or files[k] != files[k - 1]] + [len(files)]
            for lo, hi in zip(edges, edges[1:]):
                if files[lo] != name:
                    if source is not None:
                        source.close()
                    name = files[lo]
                    system, path = fs.FileSystem.from_uri(name if "://" in name else f"file://{name}")
                    source = system.open_input_file(path)
                for a, b in ranges(offset[lo:hi], length[lo:hi]):
                    a, b = a + lo, b + lo
                    raw = source.read_at(int(offset[b - 1] + length[b - 1] - offset[a]), int(offset[a]))
                    rows = []
                    for k in range(a, b):
                        headers, http, body = parsed(raw[offset[k] - offset[a] : offset[k] - offset[a] + length[k]])
                        page = headers["WARC-Record-ID"][len("<urn:page:") : -1]
                        refers = headers.get("WARC-Refers-To")
                        own = headers["WARC-Type"] == "response"
                        rows.append((
                            None if page == "none" else int(page), headers["WARC-Target-URI"], headers["WARC-Type"],
                            int(refers[len("<urn:page:") : -1]) if refers else None,
                            hashlib.sha256(body).hexdigest() if own else headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                            len(body) if own else int(http["Content-Length"]), body if own else None,
                        ))
                    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        names=["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"],
                    )
        if source is not None:
            source.close()

    wanted = index.select("file", "offset", "length").repartition("file", F.expr(f"offset div {READ_BYTES}")).sortWithinPartitions("file", "offset")
    return wanted.mapInArrow(
        fetch, "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
    )


def archive(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` below the shared folder and reads all of them back through the index."""
    return read(write(pages, workspace(pages.sparkSession, "warc")))


ORACLE = """
WITH rows AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(encode(coalesce(html, ''))) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM rows WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, rows.payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM rows LEFT JOIN firsts ON rows.payload_digest = firsts.payload_digest AND payload_bytes >= 100
"""
