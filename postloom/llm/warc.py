"""Web archives: a writer, and a sequential reader.

An archive is a file of gzip members, one per WARC record. The reader inflates it chunk by chunk, takes each record's
headers and as many bytes as they announce, and checks the digests. A payload that another record already has in full
is written as a revisit, which names that record and carries headers only.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postloom.llm.common import arrow_map, utf8
from postloom.session import materialize, scratch_path

SMALLEST = 100
ROLL_BYTES = 64 << 20
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

_END = b"\r\n\r\n"


def _head(first: str, fields: Iterable[tuple[str, object]]) -> bytes:
    lines = [first, *(f"{k}: {v}" for k, v in fields if v is not None)]
    return "\r\n".join(lines).encode() + _END


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, first: int | None) -> bytes:
    """One gzip member. ``first`` names the page that has the payload in full; then ``payload`` is not written."""
    block = _head("HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", size)])
    block += payload if first is None else b""
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    fields = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Profile", None if first is None else PROFILE),
        ("WARC-Refers-To", None if first is None else f"<urn:page:{first}>"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    return gzip.compress(_head("WARC/1.1", fields) + block + _END, mtime=0)


def members(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """Contents of each gzip member of a stream that arrives in chunks of any size."""
    inflate, parts = None, []
    for chunk in chunks:
        while chunk:
            if inflate is None:
                inflate, parts = zlib.decompressobj(wbits=31), []
            parts.append(inflate.decompress(chunk))
            chunk = inflate.unused_data
            if inflate.eof:
                yield b"".join(parts)
                inflate = None
    if inflate is not None:
        raise ValueError("the archive ends inside a record")


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def _page(uri: str | None) -> int | None:
    name = (uri or "").strip("<>").rpartition(":")[2]
    return None if name in ("", "none") else int(name)


def parse(content: bytes) -> dict:
    """A record's fields, its framing and digests verified."""
    head, mark, rest = content.partition(_END)
    fields = _fields(head)
    length = int(fields["content-length"])
    if not head.startswith(b"WARC/1.") or not mark or rest[length:] != _END:
        raise ValueError(f"broken framing in {fields.get('warc-record-id')}")
    block = rest[:length]
    if fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"wrong block digest in {fields['warc-record-id']}")
    http, _, payload = block.partition(_END)
    size, kind = int(_fields(http)["content-length"]), fields["warc-type"]
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"wrong payload digest in {fields['warc-record-id']}")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def _write(batches, folder, roll):
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    task, made, out, held = TaskContext.get().partitionId(), [], None, 0
    # The name is new in every attempt; only the files of attempts that succeeded are ever named to a reader.
    for batch in batches:
        columns = [batch.column(c) for c in ("page_id", "url", "payload", "size", "digest", "first")]
        for values in zip(*columns):
            if out is None:
                name = f"{base}/part-{task:06d}-{uuid.uuid4().hex}.warc.gz"
                out, held, n = store.open_output_stream(name, compression=None), 0, 0
            data = record(*(v.as_py() for v in values))
            out.write(data)
            held += len(data)
            n += 1
            if held >= roll:
                out.close()
                made.append((f"{folder}/{name.rpartition('/')[2]}", n, held))
                out = None
    if out is not None:
        out.close()
        made.append((f"{folder}/{name.rpartition('/')[2]}", n, held))
    if made:
        yield dict(zip(("path", "records", "bytes"), map(list, zip(*made))))


def write_archives(pages: DataFrame, folder: str, smallest: int = SMALLEST, roll: int = ROLL_BYTES) -> DataFrame:
    """Write a record per row of ``pages(page_id, url, html)`` into archives under ``folder``, a URI that executors
    share, and return ``(path, records, bytes)`` of every archive. Runs as a job.

    Null html is an empty payload. Of equal payloads of at least ``smallest`` bytes the one with the smallest page_id
    is a response, the others revisit it; a row repeated with that page_id is a response again, and rows without
    page_id are responses. No rows give no archive.
    """
    spark = pages.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    # With scheme and host, so that tasks open the same file system.
    folder = files.makeQualified(path).toString()
    payload = F.coalesce(utf8(F.col("html")), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    same = rows.filter(F.col("size") >= smallest).groupBy("digest").agg(F.min("page_id").alias("low"), F.count("*").alias("n"))
    same = materialize(same.filter("n > 1 and low is not null").drop("n"), "payloads")
    first = F.when(F.col("page_id") != F.col("low"), F.col("low"))
    typed = rows.join(same, "digest", "left").select(
        "page_id", "url", F.when(first.isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"), "size", "digest",
        first.alias("first"),
    )
    return materialize(arrow_map(typed, partial(_write, folder=folder, roll=roll), "path string, records long, bytes long"), "archives")


def _chunks(path):
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name, compression=None) as stream:
        while data := stream.read(CHUNK):
            yield data


def _read(batches, with_payload):
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * with_payload
    for batch in batches:
        for source in batch.column(0).to_pylist():
            rows, held = [], 0
            chunks = _chunks(source) if isinstance(source, str) else iter([source])
            for content in members(chunks):
                rows.append(parse(content))
                held += len(content) if with_payload else 500
                if held >= 8 << 20:
                    yield {c: [r[c] for r in rows] for c in names}
                    rows, held = [], 0
            if rows:
                yield {c: [r[c] for r in rows] for c in names}


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of ``archives``, whose first column is a path that executors can open, or the bytes of an archive
    (as Spark's ``binaryFile`` source gives them). A broken record is an error.

    ``(page_id, url, record_type, refers_to, payload_bytes, payload_digest)`` and, on request, ``payload`` (null in a
    revisit). Size and digest are those of the full payload in revisits too.
    """
    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return arrow_map(archives, partial(_read, with_payload=with_payload), schema + ", payload binary" * with_payload)


def roundtrip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read all of them back."""
    spark = pages.sparkSession
    archives = write_archives(pages, scratch_path(spark, "warc"))
    spread = archives.select("path").repartition(max(1, min(archives.count(), spark.sparkContext.defaultParallelism * 4)))
    return read_archives(spread, with_payload)
