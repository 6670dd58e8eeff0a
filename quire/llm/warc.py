"""WARC archives with revisit resolution.

``deduplicate`` finds payloads that repeat by shuffling headers (digest, id, length) only, then writes archives in which one
record per repeated payload is a response and the others are revisit records that refer to it. The decisions, one row for each
payload that repeats, are broadcast to where the payloads were read; only if there are more than ``FIRSTS`` of them are rows
shuffled by digest. ``read_archives`` reads the archives back, and ``resolve`` joins revisit records to their originals.

Defined cases: a null payload is empty; payloads under ``min_bytes`` are always responses; a null id loses to any other id and
rows that share the smallest id of a payload are all responses; a null or odd URL is percent-encoded; an empty table gives
archives without records; extra columns are ignored. Archives hold real WARC/1.1 records, each its own gzip member, and are
written to the shared folder under names that hold the task attempt, so a repeated task leaves a file that no manifest names.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from urllib.parse import quote

import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import arrow_map, cut, light, remove, shared_dir, slices

MIN_BYTES = 100
ARCHIVE_BYTES = 32 << 20
#: Most payloads that repeat of which the decisions (40 bytes each) are broadcast.
FIRSTS = 500_000
DATE = "2024-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page_id: int | None, digest: str) -> str:
    """The same for every run, so that archives are the same whichever executor writes them."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, original: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit has no payload."""
    body = HTTP % len(payload) + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "about:blank", safe="/:?#[]@!$&'()*+,;=%~-._")),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        *([("WARC-Refers-To", f"<{record_id(original, digest)}>"), ("WARC-Profile", PROFILE)] if revisit else []),
        *([("X-Page-Id", str(page_id))] if page_id is not None else []),
        ("Content-Length", str(len(body))),
    ]
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode() + body + b"\r\n\r\n"


def parse(stream) -> tuple[dict[str, str], bytes] | None:
    """The next record of a binary stream: named fields in lower case and the block; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields["content-length"])
    block = stream.read(size)
    if len(block) != size:
        raise ValueError("the archive ends within a record")
    return fields, block


def first_pages(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """From headers (digest, page_id, n_bytes): digest and first_id of payloads that more than one row has."""
    return pages.where(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1 AND first_id IS NOT NULL").drop("n")


def new_folder(spark) -> str:
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"


def deduplicate(pages: DataFrame, min_bytes: int = MIN_BYTES, archive_bytes: int = ARCHIVE_BYTES, folder: str | None = None) -> DataFrame:
    """From page_id, url and payload (binary) write archives, to a new folder of the shared storage if none is given; their manifest:
    path, n_records, n_bytes."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("payload", F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    firsts = cut(first_pages(rows.select(F.unhex("digest").alias("digest"), "page_id", "n_bytes"), min_bytes)).withColumnRenamed("digest", "key")
    decided = rows.join(light(firsts, FIRSTS), F.unhex("digest") == F.col("key"), "left").select("page_id", "url", "payload", "digest", "first_id", (F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"))
    folder = folder or new_folder(pages.sparkSession)
    return cut(arrow_map(decided, "path string, n_records long, n_bytes long", lambda batches: _write(batches, folder, archive_bytes)))


def _write(batches, folder, archive_bytes):
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
    paths, counts, sizes, sink = [], [], [], None
    for batch in slices(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sink is None:
                paths.append(f"{folder}/{name}-{len(paths):04d}.warc.gz")
                counts.append(0)
                sizes.append(0)
                sink = store.open_output_stream(f"{root}/{paths[-1].rpartition('/')[2]}", compression=None)
            pack = zlib.compressobj(1, wbits=31)
            data = pack.compress(record(*row[:5], row[5])) + pack.flush()
            sink.write(data)
            counts[-1] += 1
            sizes[-1] += len(data)
            if sizes[-1] >= archive_bytes:
                sink.close()
                sink = None
    if sink is not None:
        sink.close()
    yield [paths, counts, sizes]


class Members(io.RawIOBase):
    """The bytes of concatenated gzip members."""

    def __init__(self, raw):
        self.raw, self.unpack, self.rest = raw, zlib.decompressobj(wbits=31), b""

    def readable(self):
        return True

    def readinto(self, out):
        while True:
            data = self.rest or self.raw.read(1 << 16)
            if not data:
                return 0
            got = self.unpack.decompress(data, len(out))
            self.rest = self.unpack.unconsumed_tail
            if self.unpack.eof:
                self.rest, self.unpack = self.unpack.unused_data, zlib.decompressobj(wbits=31)
            if got:
                out[: len(got)] = got
                return len(got)


def _read(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            store, inner = pyarrow.fs.FileSystem.from_uri(path)
            out, size = [], 0
            with store.open_input_stream(inner, compression=None) as raw:
                stream = io.BufferedReader(Members(raw), 1 << 16)
                while (found := parse(stream)) is not None:
                    fields, block = found
                    payload = block.partition(b"\r\n\r\n")[2]
                    page, revisit = fields.get("x-page-id"), fields["warc-type"] == "revisit"
                    digest = fields["warc-payload-digest"].partition(":")[2]
                    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
                    out.append((None if page is None else int(page), fields["warc-record-id"][1:-1], fields["warc-type"], digest, None if revisit else len(payload), fields["warc-refers-to"][1:-1] if revisit else None, fields["warc-target-uri"], None if revisit else payload))
                    size += len(payload)
                    if size > 8 << 20:
                        yield list(map(list, zip(*out, strict=True)))
                        out, size = [], 0
            if out:
                yield list(map(list, zip(*out, strict=True)))


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the archives that a manifest names: page_id, record_id, record_type, digest, n_bytes (null for a
    revisit), refers_to_record, uri, payload (null for a revisit)."""
    n = max(1, manifest.count())
    schema = "page_id long, record_id string, record_type string, digest string, n_bytes long, refers_to_record string, uri string, payload binary"
    return arrow_map(manifest.select("path").repartition(min(n, 4096), "path"), schema, _read)


def resolve(records: DataFrame) -> DataFrame:
    """Join revisit records to the responses they refer to; the length and the page come from there."""
    heads = records.drop("payload")
    again = heads.where("record_type = 'revisit'")
    asked = again.select(F.col("refers_to_record").alias("record_id")).distinct()
    originals = heads.where("record_type = 'response'").join(asked, "record_id", "left_semi").groupBy("record_id").agg(F.max("n_bytes").alias("o_bytes"), F.max("page_id").alias("o_page"))
    revisits = again.join(light(cut(originals), FIRSTS).withColumnRenamed("record_id", "refers_to_record"), "refers_to_record", "left")
    own = heads.where("record_type = 'response'").select("page_id", F.col("n_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(revisits.select("page_id", F.col("o_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.col("o_page").alias("refers_to")))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """pages written to deduplicated archives, read back and resolved; the archives are deleted then."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", F.col("html").cast("binary").alias("payload"))
    folder = new_folder(spark)
    heads = cut(read_archives(deduplicate(pages, folder=folder)).drop("payload"))
    remove(spark, folder)
    return resolve(heads.withColumn("payload", F.lit(None).cast("binary")))


SQL = {
    "op9_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS n, sha256(payload) AS digest FROM p),
f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first_id,
             count(*) OVER (PARTITION BY digest) AS copies FROM h),
d AS (SELECT *, (first_id IS NOT NULL AND copies > 1 AND page_id IS DISTINCT FROM first_id) AS again FROM f)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to FROM d"""
}
