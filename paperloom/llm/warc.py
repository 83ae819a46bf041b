"""WARC archives with an index: write records, then read back byte ranges.

Every task writes one archive of gzip members to the shared folder and returns one
index row per record (file, offset, length, URL, digest). An archive's name is
drawn afresh by each attempt, and only the index of the attempt that succeeded is
kept, so a lost executor leaves at most an unreferenced file. Reading sorts the
selected index rows, cuts each archive into stretches of bounded size, and joins
neighbouring ranges into one read.

Null payloads are empty. Of records with equal payloads of at least ``revisit_from``
bytes the one with the largest id is the response, the others revisit it; smaller
ones are all responses. Several rows of that largest id and payload are all responses. Null URLs are written as empty targets, white space at a URL's
ends is not kept; a null id is a record without a page number. Other columns are not archived.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import lean, materialize, scratch_path

INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
STRETCH, GAP = 4 << 20, 64 << 10
READ = 32 << 20  # bytes of archives that a task reads


def with_digests(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, payload, digest, size."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"), F.length(payload).cast("long").alias("size"))


def mark_revisits(pages: DataFrame, revisit_from: int = 1000) -> DataFrame:
    """Adds ``target``: the page that a record revisits, else null.

    The payloads are shuffled once, by a join that splits hot digests.
    """
    known = pages.where(F.col("size") >= revisit_from).groupBy("digest").agg(F.max("page_id").alias("target"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = pages.join(known, "digest", "left")
    return joined.withColumn("target", F.when((F.col("size") >= revisit_from) & (F.col("target") != F.col("page_id")), F.col("target")))


def _name(page: object) -> str:
    return "<urn:page:none>" if page is None or pd.isna(page) else f"<urn:page:{int(page)}>"


def record_bytes(page: object, url: str, payload: bytes, digest: str, target: object) -> bytes:
    revisit = not (target is None or pd.isna(target))
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    uri = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_name(target)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the rows of ``mark_revisits`` and returns the index, kept in the shared folder."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, offset, file = None, 0, f"{root}/{uuid.uuid4().hex}.warc.gz"
        try:
            for pdf in batches:
                rows = []
                for page, url, payload, digest, target in zip(pdf.page_id, pdf.url, pdf.payload, pdf.digest, pdf.target):
                    out = out or store.open_output_stream(file, compression=None)
                    data = _member(record_bytes(page, url, payload, digest, target))
                    out.write(data)
                    kind = "response" if target is None or pd.isna(target) else "revisit"
                    rows.append((file, offset, len(data), url, digest, page, kind))
                    offset += len(data)
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")])
        finally:
            if out:
                out.close()

    columns = ["page_id", "url", "payload", "digest", "target"]
    return materialize(pages.select(*columns).mapInPandas(lean(write), INDEX), "warc-index")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-cased names) and block of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is wrong")
    return headers, rest[:size]


def _page(name: str | None) -> int | None:
    tail = (name or "").rpartition(":")[2].rstrip(">")
    return int(tail) if tail.lstrip("-").isdigit() else None


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the index rows name, checked against their digests."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, _ = fs.FileSystem.from_uri(folder)
        for pdf in batches:
            file, offset, length = pdf.file.to_numpy(), pdf.offset.to_numpy(), pdf.length.to_numpy()
            i = 0
            while i < len(pdf):
                j, end = i, offset[i] + length[i]
                while j + 1 < len(pdf) and file[j + 1] == file[i] and 0 <= offset[j + 1] - end <= GAP and offset[j + 1] + length[j + 1] - offset[i] <= STRETCH:
                    j += 1
                    end = offset[j] + length[j]
                with store.open_input_file(file[i]) as f:
                    data = f.read_at(int(end - offset[i]), int(offset[i]))
                rows = []
                for k in range(i, j + 1):
                    headers, block = parse_record(zlib.decompress(data[offset[k] - offset[i] : offset[k] - offset[i] + length[k]], 31))
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                        raise ValueError("a WARC payload does not match its digest")
                    rows.append((_page(headers["warc-record-id"]), headers["warc-target-uri"], kind, _page(headers.get("warc-refers-to")), size, digest, payload))
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})
                i = j + 1

    stretch = (F.col("offset") / STRETCH).cast("long")
    tasks = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // READ))  # by what is read, not by the index's own size
    dealt = index.select("file", "offset", "length").repartition(tasks, "file", stretch).sortWithinPartitions("file", "offset")
    return dealt.mapInPandas(lean(read), RECORDS)


def archive_round_trip(pages: DataFrame, revisit_from: int = 1000) -> DataFrame:
    """Writes every page, then reads all archives back."""
    folder = scratch_path(pages.sparkSession, "warc")
    index = write_archives(mark_revisits(with_digests(pages), revisit_from), folder)
    return read_records(index, folder)
