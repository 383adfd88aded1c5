"""WARC archives: monolithic writer, normaliser to one member per record with an offset index, reader."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterline.llm.common import scratch_path, small, stage, text_of

#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 100
#: Bytes of records after which a task opens a new archive.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP = 16 + zlib.MAX_WBITS
MOST_TASKS = 20_000


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = {"WARC-Type": kind, **headers, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, html: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with the payload after an HTTP head, or a revisit with the head alone."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    headers = {
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or f"urn:page:{page_id}", safe=":/?#[]@!$&'()*+,;=%~"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Payload-Length": str(len(html)),
    }
    if revisit:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    return record("revisit" if revisit else "response", headers, head if revisit else head + html)


def parse(data: bytes | memoryview) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one whole record."""
    head, _, rest = bytes(data).partition(b"\r\n\r\n")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    return headers, rest[: int(headers["content-length"])]


def records_of(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of an inflated stream, one at a time; its bytes are looked at once."""
    held, need, seen = bytearray(), 0, 0
    for chunk in chunks:
        held += chunk
        while True:
            if not need:
                end = held.find(b"\r\n\r\n", max(0, seen - 3))
                if end < 0:
                    seen = len(held)
                    break
                length = next(line for line in bytes(held[:end]).split(b"\r\n") if line.lower().startswith(b"content-length:"))
                need = end + 4 + int(length.split(b":")[1]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = seen = 0
    if held:
        raise ValueError("an archive ends inside a record")


def inflated(stream, size: int = CHUNK) -> Iterator[bytes]:
    """Chunks, of bounded size, of a gzip file of any number of members, in one pass."""
    engine = zlib.decompressobj(GZIP)
    while data := stream.read(size):
        while data:
            yield engine.decompress(data, 4 * size)
            data = engine.unconsumed_tail
            if engine.eof:
                data, engine = engine.unused_data, zlib.decompressobj(GZIP)
    yield engine.flush()


def filesystem(root: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; Spark's names of one store (s3a, s3n) are that store."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", root))


def opened(root: str) -> tuple[fs.FileSystem, str]:
    store, path = filesystem(root)
    store.create_dir(path, recursive=True)
    return store, path


def write_archives(pages: DataFrame, root: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """path of every monolithic archive: whole files of one gzip stream under root.

    pages has page_id, url, html (binary), digest, refers_to, revisit. A task names its files by its own
    attempt, and only files of attempts that ended well are in the result, so lost executors leave at most
    files that nothing names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(root)
        context, out, engine, n, paths = TaskContext.get(), None, None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    paths.append(f"{folder}/{context.partitionId():06d}-{context.taskAttemptId()}-{len(paths):04d}.warc.gz")
                    out, engine, n = store.open_output_stream(paths[-1], compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP), 0
                    out.write(engine.compress(record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": DATE, "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")))
                data = page_record(row["page_id"], row["url"], row["html"], row["digest"], row["refers_to"], row["revisit"])
                out.write(engine.compress(data))
                n += len(data)
                if n >= archive_bytes:
                    out.write(engine.flush())
                    out.close()
                    out = None
        if out is not None:
            out.write(engine.flush())
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["path"])

    return stage(pages.select("page_id", "url", "html", "digest", "refers_to", "revisit").mapInArrow(run, "path string"), "archives")


def spread(paths: DataFrame) -> DataFrame:
    """A task for each file, as far as that is reasonable."""
    return paths.repartition(max(1, min(paths.count(), MOST_TASKS)))


def normalize(paths: DataFrame, root: str) -> DataFrame:
    """path, index, records of every archive of paths, rewritten under root.

    Each archive is inflated once, as a stream; every record becomes a gzip member of its own; the sidecar
    index has a JSON line per record: offset, length, id, type, digest. An empty payload is a record like any
    other; one record at a time is held, so a task needs as much memory as its longest one; equal records stay
    records of their own; no paths give no archives; a null path is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = opened(root)
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                name = f"{folder}/{path.rsplit('/', 1)[1].removesuffix('.warc.gz')}-{TaskContext.get().taskAttemptId()}"
                at, lines = 0, []
                with store.open_input_stream(path, compression=None) as source, store.open_output_stream(f"{name}.warc.gz", compression=None) as out:
                    for data in records_of(inflated(source)):
                        headers, _ = parse(data[: data.find(b"\r\n\r\n") + 4])
                        engine = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
                        member = engine.compress(data) + engine.flush()
                        out.write(member)
                        lines.append(json.dumps({"offset": at, "length": len(member), "id": headers["warc-record-id"], "type": headers["warc-type"], "digest": headers.get("warc-payload-digest")}))
                        at += len(member)
                with store.open_output_stream(f"{name}.idx", compression=None) as out:
                    out.write("".join(f"{line}\n" for line in lines).encode())
                rows.append((f"{name}.warc.gz", f"{name}.idx", len(lines)))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["path", "index", "records"])

    return stage(spread(paths).mapInArrow(run, "path string, index string, records long"), "normalized")


def read_archives(archives: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to (and payload) of the page records.

    Every record is read at its offset in the index and inflated alone. A response's payload is measured
    and its digest checked against the header; a revisit has both in its headers, and no payload. A null page_id
    comes back null, an empty payload with 0 bytes; repeated records are a row each; no archives give no rows.
    """

    def number(urn: str) -> int | None:
        text = urn.strip("<>").removeprefix("urn:page:")
        return None if text == "None" else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = filesystem(root)
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_stream(index, compression=None) as f:
                    lines = [json.loads(x) for x in f.read().decode().splitlines()]
                rows, held = [], 0
                with store.open_input_file(path) as f:
                    for line in lines:
                        if line["type"] not in ("response", "revisit"):
                            continue
                        f.seek(line["offset"])
                        headers, block = parse(zlib.decompress(f.read(line["length"]), GZIP))
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest, revisit = headers["warc-payload-digest"].removeprefix("sha256:"), headers["warc-type"] == "revisit"
                        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {line['id']} in {path} doesn't have its digest")
                        n = int(headers["warc-payload-length"]) if revisit else len(payload)
                        rows.append((number(headers["warc-record-id"]), n, digest, headers["warc-type"], number(headers["warc-refers-to"]) if revisit else None, None if revisit else payload))
                        held += len(payload) * with_payload
                        if held > ARCHIVE_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: 5 + with_payload]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=False)], names=names[: len(kinds)])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    return spread(archives.select("path", "index")).mapInArrow(run, schema)


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, html (binary), digest, refers_to, revisit of pages(page_id, url, html).

    Of equal payloads of at least LEAST_REVISIT bytes, the row with the least page_id is the response; rows
    that repeat that id are responses too; null ids come last. Digests are counted where the pages are;
    those that repeat are broadcast if few, else met in a join that can be split.
    """
    hashed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", text_of("html").cast("binary").alias("html")).withColumn("digest", F.sha2("html", 256))
    seen = hashed.filter(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n"))
    again = stage(seen.filter("_n > 1 AND refers_to IS NOT NULL").drop("_n"), "repeated-payloads")
    joined = hashed.join(small(again), "digest", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return joined.withColumn("revisit", revisit).withColumn("refers_to", F.when(F.col("revisit"), F.col("refers_to")))


def archive(pages: DataFrame, root: str | None = None) -> tuple[DataFrame, str]:
    """The normalised archives of pages (path, index, records) and the root under which they lie.

    Null html is empty, null urls are named after the page, repeated pages are records each; an empty table
    gives no archives. The monolithic files are deleted once every one is rewritten.
    """
    spark = pages.sparkSession
    root = root or scratch_path(spark, "warc")
    paths = write_archives(with_revisits(pages), f"{root}/monolithic")
    done = normalize(paths, f"{root}/members")
    store, folder = opened(f"{root}/monolithic")
    store.delete_dir(folder)
    return done, root


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives, normalised and read back: see archive and read_archives for edge cases."""
    archives, root = archive(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return read_archives(archives, root)


SQL = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= {LEAST_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM hashed
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""
