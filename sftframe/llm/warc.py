"""Web archives: write one record per page, then read chosen records back by their byte ranges.

Each task writes one file of gzip members, one per record, into a shared folder, and gives one index row per record:
file, offset, length, URL, digest.  The index is written by Spark; files that no index row names belong to lost
tasks and are never read.  Reading sorts the chosen index rows by place, joins neighbouring ranges into bounded
reads, and parses the records in them.

Of pages with equal payloads of at least ``REVISIT_BYTES``, the one with the largest id is a response and the others
are revisits that name it; all other pages are responses.  A null payload is an empty one.  A page without id is never
named by a revisit while another has an id; if none has, all are responses.  Rows that repeat id and payload are all
what one of them is.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftframe.llm import textcore as X
from sftframe.session import shared_folder

REVISIT_BYTES = 1000
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
DATE = "2000-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "urn:page:"

_INDEX = "page_id string, url string, digest string, record_type string, file string, offset long, length long"
_RECORD = (
    "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"
)


def _schema(text: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in text.split(", "))])


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record, without compression: warc header, http header and, for a response, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_URN}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_URN}{refers_to}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one uncompressed record; the digest of a response is made anew and compared."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    length = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    urn = lambda name: fields[name].strip("<>").removeprefix(_URN) if name in fields else None
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of record {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": urn("WARC-Record-ID") or None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        "refers_to": urn("WARC-Refers-To"),
        "payload_bytes": length,
        "payload_digest": digest,
        "payload": payload if response else None,
    }


def _writer(folder: str):
    schema = _schema(_INDEX)

    def run(batches):
        store, root = pafs.FileSystem.from_uri(folder)
        name, out, at = f"part-{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*(batch.column(k) for k in range(5))):
                payload = (payload.as_py() or "").encode()
                page_id, url, digest, refers_to = page_id.as_py(), url.as_py(), digest.as_py(), refers_to.as_py()
                member = gzip.compress(record(page_id, url, payload, digest, refers_to), 4, mtime=0)
                if out is None:
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                out.write(member)
                rows.append((page_id, url, digest, "response" if refers_to is None else "revisit", name, at, len(member)))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if out is not None:
            out.close()

    return run


#: Bytes of archive that a reading task is given.
TASK_BYTES = 32 << 20


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Write a record per page below ``folder`` and return the stored index."""
    body = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").alias("id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("body"))
    keyed = rows.withColumn("digest", F.sha1("body"))
    large = keyed.where(F.octet_length("body") >= least).select("id", "digest")
    groups = large.groupBy("digest").agg(F.max("id").alias("response"), F.count("*").alias("n")).where("n > 1 and response is not null")
    revisits = large.join(groups.select("digest", "response"), "digest").where(~F.col("id").eqNullSafe(F.col("response")))
    revisits = revisits.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "response").distinct()
    records = keyed.join(revisits, F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left").select(
        F.col("id").cast("string"), "url", "body", "digest", F.col("response").cast("string").alias("refers_to")
    )
    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return X.stored(records.mapInArrow(_writer(folder), _INDEX), "warc-index")


def ranges(offsets: list[int], lengths: list[int], gap: int = GAP_BYTES, limit: int = READ_BYTES) -> list[tuple[int, int, int, int]]:
    """Sorted byte ranges joined into reads: ``(start, end, first record, record after the last)``."""
    reads: list[tuple[int, int, int, int]] = []
    for k, (start, size) in enumerate(zip(offsets, lengths)):
        if reads and start - reads[-1][1] <= gap and start + size - reads[-1][0] <= limit:
            reads[-1] = (reads[-1][0], max(reads[-1][1], start + size), reads[-1][2], k + 1)
        else:
            reads.append((start, start + size, k, k + 1))
    return reads


def _reader(folder: str, payloads: bool):
    schema = _schema(_RECORD)

    def read(store, path, offsets, lengths):
        with store.open_input_file(path) as source:
            for start, end, first, last in ranges(offsets, lengths):
                data = source.read_at(end - start, start)
                yield [parse(zlib.decompress(data[o - start : o - start + n], wbits=31)) for o, n in zip(offsets[first:last], lengths[first:last])]

    def run(batches):
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            files, offsets, lengths = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(files):
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                for records in read(store, f"{root}/{files[at]}", offsets[at:end], lengths[at:end]):
                    if not payloads:
                        records = [r | {"payload": None} for r in records]
                    yield pa.RecordBatch.from_pylist(records, schema=schema)
                at = end

    return run


def read_archive(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Read the records that the rows of ``index`` name, in order of their place within a stretch of a file.

    Stretches of ``TASK_BYTES`` are dealt out over as many tasks as the records' bytes ask for: an index row is small,
    what it stands for is not.
    """
    places = index.select("file", "offset", "length", F.floor(F.col("offset") / TASK_BYTES).alias("stretch"))
    size = places.agg(F.sum("length")).first()[0] or 0
    tasks = X.task_count(index.sparkSession, size, TASK_BYTES)
    places = places.repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset").drop("stretch")
    return places.mapInArrow(_reader(folder, payloads), _RECORD)


def digest(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, read all records back, and report what the archive says."""
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    index = write_archive(pages, folder)
    found = read_archive(index, folder, payloads=False)
    return found.select(
        F.col("page_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )
