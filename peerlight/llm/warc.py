"""WARC archives of crawled pages, and their records as chunk rows with running digests."""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerlight.llm.common import materialize, slices
from peerlight.sources.snapshots import shared_folder

DATE = "1970-01-01T00:00:00Z"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def plan_records(pages: DataFrame, revisit_bytes: int = 1000) -> DataFrame:
    """Pages with payload_bytes, payload_digest, record_type and refers_to.

    Of rows with equal payloads of at least `revisit_bytes`, that with the largest page_id is the
    response and others revisit it; rows that repeat this page_id, and rows of a payload none of
    whose pages has an id, are responses too. The largest id per digest is found by partial sums, and
    only digests that occur twice are joined back, so one payload in a third of all rows is no hot task.
    """
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).select(
        "*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha1("html").alias("payload_digest")
    )
    twice = (
        page.filter(F.col("payload_bytes") >= revisit_bytes)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1 and first is not null")
        .select("payload_digest", "first")
    )
    revisit = F.coalesce(F.col("first") != F.coalesce("page_id", F.col("first") - 1), F.lit(False))
    return (
        page.join(materialize(twice), "payload_digest", "left")
        .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisit, F.col("first")))
        .drop("first")
    )


def _header(record: dict, length: int) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {record['record_type']}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(record['url'] or '').replace(chr(13), '%0D').replace(chr(10), '%0A')}",
        f"WARC-Payload-Digest: sha1:{record['payload_digest']}",
        f"X-Payload-Length: {record['payload_bytes']}",
    ]
    if record["page_id"] is not None:
        lines.append(f"X-Page-ID: {record['page_id']}")
    if record["refers_to"] is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Page-ID: {record['refers_to']}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {length}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_warc(records: DataFrame, folder: str) -> DataFrame:
    """Write planned records to one gzip archive per partition below `folder`; return (path, records).

    Every record is a gzip member of its own. A task writes under a fresh name and only returned
    names belong to the archive set, so a lost executor's half file is never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        path, count, out = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, None
        for whole in batches:
            for batch in slices(whole, "html"):
                for record in batch.to_pylist():
                    out = out or store.open_output_stream(path, compression=None)
                    payload = record["html"].encode()
                    block = HEAD % len(payload) + (payload if record["record_type"] == "response" else b"")
                    out.write(gzip.compress(_header(record, len(block)) + block + b"\r\n\r\n", 1, mtime=0))
                    count += 1
        if out:
            out.close()
            yield pa.record_batch({"path": [f"{path}"], "records": pa.array([count], pa.int64())})

    columns = ["page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return materialize(records.select(*columns).mapInArrow(run, "path string, records long"))


CHUNKS = (
    "archive string, record long, chunk int, page_id long, record_type string, refers_to long, "
    "declared_bytes long, declared_digest string, data binary, running_bytes long, running_digest string"
)


def read_chunks(spark: SparkSession, archives: DataFrame, folder: str, chunk_bytes: int = 1 << 18) -> DataFrame:
    """One row per (archive, record, chunk) of the payloads, at most `chunk_bytes` each.

    A chunk row carries the bytes and SHA-1 of its payload so far, so the last one has those of the
    whole. Payloads are streamed: neither the reader nor any row holds more than a chunk. A record with an
    empty payload, and a revisit, has one empty chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as raw:
                    for row in _stream(gzip.GzipFile(fileobj=io.BufferedReader(raw, 1 << 20)), path, chunk_bytes):
                        rows.append(row)
                        size += len(row["data"]) + 300
                        if size >= 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _CHUNK_ROWS)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _CHUNK_ROWS)

    # Path rows are tiny, so a shuffle sized by bytes would give all archives to one task; a stated number does not.
    return archives.select("path").repartition(max(1, archives.count()), "path").mapInArrow(run, CHUNKS)


_CHUNK_ROWS = pa.schema(
    [
        ("archive", pa.string()),
        ("record", pa.int64()),
        ("chunk", pa.int32()),
        ("page_id", pa.int64()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("declared_bytes", pa.int64()),
        ("declared_digest", pa.string()),
        ("data", pa.binary()),
        ("running_bytes", pa.int64()),
        ("running_digest", pa.string()),
    ]
)


def _stream(source, path: str, chunk_bytes: int) -> Iterator[dict]:
    """Chunk rows of all records of one decompressed archive."""
    number = 0
    while line := source.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{path}: record {number} does not begin with a version line")
        fields: dict[str, str] = {}
        while (line := source.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        rest = int(fields["content-length"])
        while rest and (line := source.readline()):
            rest -= len(line)
            if line == b"\r\n":
                break
        digest, done, chunk = hashlib.sha1(), 0, 0
        base = {
            "archive": path,
            "record": number,
            "page_id": int(fields["x-page-id"]) if "x-page-id" in fields else None,
            "record_type": fields["warc-type"],
            "refers_to": int(fields["x-refers-to-page-id"]) if "x-refers-to-page-id" in fields else None,
            "declared_bytes": int(fields["x-payload-length"]),
            "declared_digest": fields["warc-payload-digest"].partition(":")[2],
        }
        while rest or not chunk:
            data = source.read(min(rest, chunk_bytes))
            if rest and not data:
                raise ValueError(f"{path}: record {number} ends early")
            rest -= len(data)
            done += len(data)
            digest.update(data)
            yield base | {"chunk": chunk, "data": data, "running_bytes": done, "running_digest": digest.hexdigest()}
            chunk += 1
        source.readline()
        source.readline()
        number += 1


def records_of(chunks: DataFrame) -> DataFrame:
    """One row per record from its chunk rows: payload length and digest, read or (revisits) declared.

    A response whose streamed payload differs from what its header declares stops the job.
    """
    last = F.max_by(F.struct("running_bytes", "running_digest"), "chunk")
    record = chunks.groupBy("archive", "record").agg(
        *[F.first(c).alias(c) for c in ("page_id", "record_type", "refers_to", "declared_bytes", "declared_digest")],
        F.sum(F.octet_length("data")).alias("read_bytes"),
        last.alias("last"),
    )
    intact = (
        (F.col("record_type") == "revisit")
        | (F.col("last.running_digest") == F.col("declared_digest"))
        & (F.col("last.running_bytes") == F.col("declared_bytes"))
        & (F.col("read_bytes") == F.col("declared_bytes"))
    )
    return record.select(
        "page_id",
        F.col("declared_bytes").alias("payload_bytes"),
        F.when(intact, F.col("declared_digest"))
        .otherwise(F.raise_error(F.concat(F.lit("damaged record in "), "archive")).cast("string"))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def warc_round_trip(pages: DataFrame, revisit_bytes: int = 1000, chunk_bytes: int = 1 << 18) -> DataFrame:
    """Write all pages to archives in the shared folder, read them back, one row per page row.

    NULL html is an empty payload, NULL urls are empty, NULL page ids come back as NULL; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/peerlight/warc-{uuid.uuid4().hex}"
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
    store, root = fs.FileSystem.from_uri(uri)
    store.create_dir(root, recursive=True)
    archives = write_warc(plan_records(pages, revisit_bytes), uri)
    return records_of(read_chunks(spark, archives, uri, chunk_bytes))
