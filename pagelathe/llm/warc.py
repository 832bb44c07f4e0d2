"""WARC archives and the chunked record table.

Payloads are written as response records, repeated payloads as revisit records
that name the response.  Archives are read as a stream into rows of (record
identifier, chunk number): a payload of any size passes through in chunks, each
with the bytes and the digest so far, so that no reader holds a whole record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelathe.llm.common import new_folder, staged, store_of

VERSION = b"WARC/1.1"
#: Bytes of a chunk row, and of one read from a file.
CHUNK = 262_144
READ = 262_144
LEVEL = 5
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELDS = "record_id string, chunk_no bigint, record_type string, page_key string, url string, refers_to_id string, declared_digest string, bytes_so_far bigint, digest_so_far string, last boolean"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def records_of(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0) -> DataFrame:
    """Rows to be written: page_key, url, sha1, size, type, copy, payload (null for revisits).

    Of equal payloads of at least ``least`` bytes the row with the largest id is
    the response (a null id is below all others, equal ids leave one) and the
    others revisit it; smaller payloads are all responses.  Repeated payloads
    are found on digests alone; only responses carry their payload.
    """
    rows = pages.select(F.col(id_col).alias("page_key"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload")).select(
        "*", F.unhex(F.sha1("payload")).alias("sha1"), F.octet_length("payload").cast("bigint").alias("size")
    )
    heads = rows.select("page_key", "url", "sha1", "size")
    # One row for each page and payload, with the number of identical rows.
    groups = staged(heads.where(F.col("size") >= least).groupBy("sha1", "page_key", "url").agg(F.count("*").alias("rows"), F.first("size").alias("size")), "payloads")
    # Payloads that occur more than once, their winner, and whether identical rows compete.
    repeated = staged(
        groups.groupBy("sha1")
        .agg(F.max(F.struct("page_key", "url")).alias("winner"), F.max_by("rows", F.struct("page_key", "url")).alias("winner_rows"), F.sum("rows").alias("n"))
        .where("n > 1"),
        "repeated",
    )
    split = rows.join(repeated, "sha1", "left")
    first = split.where(F.col("winner").isNull() | (F.col("size") < least) | (F.struct("page_key", "url").eqNullSafe(F.col("winner")) & (F.col("winner_rows") == 1)))
    tied = split.where((F.col("size") >= least) & F.struct("page_key", "url").eqNullSafe(F.col("winner")) & (F.col("winner_rows") > 1)).dropDuplicates(["sha1"])
    names = ["page_key", "url", "sha1", "size", "payload"]
    # Small payloads may repeat as responses and so need numbers of their own.
    responses = first.select(*names).unionByName(tied.select(*names)).select("*", F.lit("response").alias("type"), F.when(F.col("size") < least, F.uuid()).otherwise("").alias("copy"))
    is_winner = F.struct("page_key", "url").eqNullSafe(F.col("winner"))
    revisits = (
        groups.join(repeated.select("sha1", "winner"), "sha1")
        .withColumn("others", F.col("rows") - F.when(is_winner, 1).otherwise(0))
        .where("others > 0")
        .select("page_key", "url", "sha1", "size", F.lit(None).cast("binary").alias("payload"), F.lit("revisit").alias("type"), F.explode(F.sequence(F.lit(1).cast("bigint"), "others").cast("array<string>")).alias("copy"))
    )
    return responses.unionByName(revisits)


def record_id(kind: str, sha1: bytes, key: object, copy: str) -> str:
    """A response is known by its payload, so that revisits can name it."""
    name = f"response:{sha1.hex()}:{copy}" if kind == "response" else f"revisit:{sha1.hex()}:{key}:{copy}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _head(kind: str, key, url: str | None, sha1: bytes, copy: str, length: int) -> bytes:
    lines = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(kind, sha1, (key, url), copy)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{_base32(sha1)}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {length}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + " ".join(url.split()))
    if key is not None:
        lines.append(f"X-Page-Key: {key}")
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id('response', sha1, None, '')}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n"


def write_warc(pages: DataFrame, folder: str, **options) -> DataFrame:
    """Write one gzip member per record; returns the manifest (file, n_records).

    Only files in the manifest count; what a lost task left is not read.
    """
    records = records_of(pages, **options).select("page_key", "url", "sha1", "type", "copy", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, n = None, 0
        for batch in batches:
            for i in range(batch.num_rows):
                if sink is None:
                    store, at = store_of(folder)
                    store.create_dir(at, recursive=True)
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    sink = store.open_output_stream(f"{at}/{name}", compression=None)
                key, url, sha1, kind, copy, payload = (batch.column(c)[i] for c in range(6))
                body = payload.as_buffer() if payload.is_valid else pa.py_buffer(b"")
                squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                sink.write(squeeze.compress(_head(kind.as_py(), key.as_py(), url.as_py(), sha1.as_py(), copy.as_py(), body.size)))
                for start in range(0, body.size, CHUNK):
                    sink.write(squeeze.compress(body.slice(start, min(CHUNK, body.size - start))))
                sink.write(squeeze.compress(b"\r\n\r\n") + squeeze.flush())
                n += 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([n], pa.int64())})

    return staged(records.mapInArrow(write, "file string, n_records bigint"), "manifest")


def _plain(file) -> Iterator[bytes]:
    """The decompressed bytes of a file of gzip members, piece by piece."""
    member = zlib.decompressobj(31)
    while data := file.read(READ):
        while data:
            got = member.decompress(data, READ)
            if got:
                yield got
            if member.eof:
                data, member = member.unused_data, zlib.decompressobj(31)
            else:
                data = member.unconsumed_tail


def chunks_of(file, size: int = CHUNK) -> Iterator[tuple[dict, int, bytes, int, str, bool]]:
    """(head, chunk number, bytes, bytes so far, digest so far, last) of every record."""
    pieces, held = _plain(file), b""

    def more() -> bool:
        nonlocal held
        piece = next(pieces, None)
        held += piece or b""
        return piece is not None

    while held or more():
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                raise ValueError("a record head has no end")
        lines = held[:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        head = dict(x.split(": ", 1) for x in lines[1:])
        held, left, number, seen, digest = held[end + 4 :], int(head["Content-Length"]), 0, 0, hashlib.sha1()
        while True:
            while len(held) < min(left, size) and more():
                pass
            take = held[: min(left, size)]
            if len(take) < min(left, size):
                raise ValueError("a record is cut off")
            held, left, seen = held[len(take) :], left - len(take), seen + len(take)
            digest.update(take)
            yield head, number, take, seen, _base32(digest.digest()), left == 0
            number += 1
            if not left:
                break
        while len(held) < 4 and more():
            pass
        if held[:4] != b"\r\n\r\n":
            raise ValueError("a record does not end where it should")
        held = held[4:]


def read_chunks(manifest: DataFrame, folder: str, size: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in a manifest.

    One row per record and chunk, an empty payload has one empty chunk;
    ``digest_so_far`` (base32 SHA-1) and ``bytes_so_far`` of the last chunk are
    those of the payload.  A row holds ``size`` bytes at most; ``with_data``
    False leaves the bytes out.
    """
    tasks = max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4)

    def row(head: dict, number: int, data: bytes, seen: int, digest: str, last: bool) -> tuple:
        known = (head["WARC-Record-ID"], number, head["WARC-Type"], head.get("X-Page-Key"), head.get("WARC-Target-URI"), head.get("WARC-Refers-To"), head.get("WARC-Payload-Digest", "").removeprefix("sha1:"), seen, digest, last)
        return (*known, data) if with_data else known

    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    names = [x.split()[0] for x in FIELDS.split(", ")] + ["data"]

    def pack(lot: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*lot, strict=True), kinds, strict=False)], names[: len(lot[0])])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = store_of(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                lot, held = [], 0
                with store.open_input_stream(f"{at}/{name}", compression=None) as file:
                    for x in chunks_of(file, size):
                        lot.append(row(*x))
                        held += len(x[2]) * with_data + 512
                        if held >= 4 * CHUNK:
                            yield pack(lot)
                            lot, held = [], 0
                if lot:
                    yield pack(lot)

    return manifest.repartition(tasks, "file").mapInArrow(read, FIELDS + ", data binary" * with_data)


def payloads(chunks: DataFrame) -> DataFrame:
    """One row per record from the chunk table, revisits with their response's payload.

    record_id, page_key, payload_bytes, payload_digest, record_type, refers_to.
    """
    ends = staged(chunks.where("last").select("record_id", "record_type", "page_key", "refers_to_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest")), "records")
    target = ends.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_id"), F.col("page_key").alias("refers_to"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d"))
    found = ends.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest").join(target, "refers_to_id", "left")
    columns = ["record_id", "page_key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        ends.where("record_type = 'response'")
        .withColumn("refers_to", F.lit(None).cast("string"))
        .select(columns)
        .unionByName(found.withColumnsRenamed({"b": "payload_bytes", "d": "payload_digest"}).select(columns))
    )


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Write the archives below the shared folder, read them back, one row per page."""
    folder = new_folder(pages.sparkSession, "warc")
    return payloads(read_chunks(write_warc(pages, folder, **options), folder, with_data=False))


def gunzip(data: bytes) -> bytes:
    """Whole small archives, for tests."""
    return gzip.decompress(data)
